import itertools
import random

import numpy as np
import pytest

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, gram, rules


@pytest.fixture(scope="module")
def entries(spark):
    rng = random.Random(11)
    cells = {(r, f) for r in range(40) for f in range(30) if rng.random() < 0.2}
    cells |= {(r, 99) for r in range(40) if r % 3}  # one feature most rows share
    return stage(spark.createDataFrame(
        [(r, f, rng.randint(1, 10) / 2) for r, f in sorted(cells)], "r long, f long, v double"))


def brute_pairs(entries):
    rows = {}
    for e in entries.collect():
        rows.setdefault(e["r"], {})[e["f"]] = e["v"]
    out = {}
    for a, b in itertools.combinations(sorted(rows), 2):
        both = rows[a].keys() & rows[b].keys()
        if both:
            out[(a, b)] = (round(sum(rows[a][f] * rows[b][f] for f in both), 6), len(both))
    return out


@pytest.mark.parametrize("blocks,stripes", [(1, 1), (3, 1), (4, 3)])
def test_blocked_product_equals_brute_force(entries, blocks, stripes, monkeypatch):
    monkeypatch.setattr(gram, "EXPAND", 50)
    got = {(r["a"], r["b"]): (round(r["dot"], 6), r["n_common"])
           for r in gram.gram_pairs(entries, blocks=blocks, stripes=stripes).collect()}
    assert got == brute_pairs(entries)


@pytest.mark.parametrize("blocks", [1, 3, None])
def test_best_pairs_hold_the_best(entries, blocks):
    want = {}
    for (a, b), (dot, _) in brute_pairs(entries).items():
        want.setdefault(a, []).append(dot)
        want.setdefault(b, []).append(dot)
    got = {}
    for r in gram.gram_best(entries, 5, blocks=blocks).collect():
        got.setdefault(r["a"], []).append(round(r["dot"], 6))
    for a, dots in want.items():
        assert sorted(got[a])[-5:] == sorted(dots)[-5:]


@pytest.mark.parametrize("of", ["user", "item"])
def test_wide_contexts_give_the_same_neighbors(ratings, of):
    rng = random.Random(2)
    seen = {(u, m) for u in range(30) for m in range(12) if m == 0 or rng.random() < 0.3}
    train = stage(ratings([(u, m, rng.randint(1, 10) / 2, "2020-01-01 00:00:00")
                           for u, m in sorted(seen)]))
    targets = ratings([(u, m, 0.0, "2020-01-01 00:00:00") for u in range(30) for m in range(12)
                       if (u, m) not in seen])
    pairs = stage(cf.similarity(train, of, "own"))

    def found(wide):
        return sorted((r["entity"], r["context"], r["neighbor"], r["place"]) for r in
                      cf.topk_neighbors(targets, train, pairs, of, 3, wide).collect())

    plain = found(1000)
    assert plain and found(4) == plain and found(8) == plain


def test_unknown_users_and_lonely_targets(ratings):
    train = ratings([(1, 1, 4.0, "2020-01-01 00:00:00"), (2, 2, 2.0, "2020-01-01 00:00:00")])
    pairs = cf.similarity(train, "user")
    targets = ratings([(1, 2, 0.0, "2020-01-01 00:00:00"), (9, 1, 0.0, "2020-01-01 00:00:00")])
    got = {r["userId"]: r["prediction"] for r in
           cf.predict_user_cf(targets.select("userId", "movieId"), train, pairs).collect()}
    assert got == {1: 4.0, 9: None}


def brute_user_prediction(train, u, m, k):
    means = {v: np.mean(list(r.values())) for v, r in train.items()}
    norm = {v: np.sqrt(sum(x * x for x in r.values())) for v, r in train.items()}
    sims = []
    for v, r in train.items():
        if v != u and m in r:
            dot = sum(r[i] * train[u][i] for i in r.keys() & train[u].keys())
            if dot > 0:
                sims.append((-round(dot / norm[u] / norm[v], 9), v))
    top = sorted(sims)[:k]
    if not top:
        return means[u]
    shift = sum(-s * (train[v][m] - means[v]) for s, v in top) / sum(-s for s, _ in top)
    return min(max(means[u] + shift, 0.5), 5.0)


def test_recommendations_equal_brute_force(ratings):
    rng = random.Random(4)
    train = {u: {m: rng.randint(1, 10) / 2 for m in range(15) if rng.random() < 0.4 or m == u}
             for u in range(12)}
    rows = [(u, m, r, "2020-01-01 00:00:00") for u, mine in train.items() for m, r in mine.items()]
    table = stage(ratings(rows))
    requests = table.select("userId").distinct()
    got = {}
    for r in cf.recommend_user_cf(requests, table, n=4, k=3).collect():
        got.setdefault(r["userId"], []).append((r["place"], r["movieId"], r["prediction"]))
    items = {m for mine in train.values() for m in mine}
    for u in train:
        want = sorted(((-round(brute_user_prediction(train, u, m, 3), 9), m)
                       for m in items - train[u].keys()))[:4]
        mine = sorted(got[u])
        assert [m for _, m, _ in mine] == [m for _, m in want]
        assert [p for _, _, p in mine] == pytest.approx([-s for s, _ in want])
    assert cf.recommend_item_cf(requests, table, n=4, k=3).where("place > 4").count() == 0


def test_fp_growth_and_apriori_agree(spark):
    rng = random.Random(8)
    rows = [(u, f"i{i}") for u in range(150) for i in range(9) if rng.random() < 0.55]
    baskets = stage(spark.createDataFrame(
        [(u, i, sum(1 for v, _ in rows if v == u)) for u, i in rows],
        "userId long, item string, basket_size long"))

    def found(df):
        return sorted((tuple(r["items"]), r["freq"]) for r in df.collect())

    fp, ap = rules.frequent_itemsets(baskets, 0.1), rules.frequent_itemsets_apriori(baskets, 0.1)
    held = {}
    for u, i in rows:
        held.setdefault(u, set()).add(i)
    want = []
    names = sorted({i for _, i in rows})
    for size in range(1, 10):
        for c in itertools.combinations(names, size):
            n = sum(1 for b in held.values() if set(c) <= b)
            if n >= 0.1 * len(held):
                want.append((c, n))
    assert found(fp) == found(ap) == sorted(want)
    strong = rules.association_rules(stage(fp), 0.4).where("size(antecedents) = 2").limit(5)
    strong = stage(strong)
    got = sorted((r["userId"], tuple(r["antecedents"]))
                 for r in rules.rule_subset_join(strong, baskets).collect())
    assert got == sorted((u, tuple(a["antecedents"])) for u, b in held.items()
                         for a in strong.select("antecedents").distinct().collect()
                         if set(a["antecedents"]) <= b)


def test_rule_subset_join_over_more_items_than_a_word(spark):
    rng = random.Random(6)
    baskets = [(u, f"i{rng.randint(0, 150)}") for u in range(60) for _ in range(40)]
    lists = [sorted({f"i{rng.randint(0, 150)}" for _ in range(rng.randint(1, 3))})
             for _ in range(80)] + [["i1", "nowhere"], ["nowhere"]]
    held = {}
    for u, i in baskets:
        held.setdefault(u, set()).add(i)
    want = sorted((u, tuple(x)) for x in set(map(tuple, lists)) for u, b in held.items()
                  if set(x) <= b)
    found = rules.rule_subset_join(
        stage(spark.createDataFrame([(x,) for x in lists], "antecedents array<string>")),
        spark.createDataFrame(baskets, "userId long, item string"))
    assert sorted((r["userId"], tuple(r["antecedents"])) for r in found.collect()) == want


def test_candidates_are_counted_by_block_and_not_by_word(spark, monkeypatch):
    monkeypatch.setattr(rules, "BLOCK_WORDS", 2)
    monkeypatch.setattr(rules, "SLICE", 3)
    monkeypatch.setattr(rules, "CHUNK", 2)
    rng = random.Random(4)
    held = {u: {f"i{i}" for i in range(6) if rng.random() < 0.6} for u in range(700)}
    baskets = spark.createDataFrame(
        [(u, i) for u, b in held.items() for i in b], "userId long, item string")
    bits = stage(rules.vertical(baskets))
    lists = [list(c) for c in itertools.combinations([f"i{i}" for i in range(6)] + ["nobody"], 3)]
    asked = stage(spark.createDataFrame(list(enumerate(lists)), "id long, items array<string>"))
    got = {r["id"]: r["freq"] for r in rules._counted(asked, bits, len(held)).collect()}
    want = {k: sum(set(c) <= b for b in held.values()) for k, c in enumerate(lists)}
    assert got == {k: n for k, n in want.items() if n}


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_antecedents_are_looked_up_without_a_shuffle_of_matches(spark):
    lists = stage(spark.createDataFrame(
        [(["a", "b", "c"],), (["b", "d"],), (["a"],)], "antecedents array<string>"))
    baskets = stage(spark.createDataFrame(
        [(u, i) for u in range(30) for i in "abcd" if (u + ord(i)) % 4], "userId long, item string"))
    found = rules.rule_subset_join(lists, baskets)
    assert _executed(found).count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(userId" in _executed(found)


def test_recommended_are_the_best_of_all_rules(spark):
    rng = random.Random(12)
    names = [f"i{i}" for i in range(7)]
    rows = []
    for _ in range(150):
        both = rng.sample(names, rng.randint(2, 5))
        cut = rng.randint(1, len(both) - 1)
        rows.append((both[:cut], both[cut:], rng.randint(1, 8) / 8))
    strong = stage(spark.createDataFrame(
        rows, "antecedents array<string>, consequents array<string>, confidence double"))
    held = {u: set(rng.sample(names, rng.randint(1, 5))) for u in range(60)}
    baskets = stage(spark.createDataFrame(
        [(u, i) for u, b in held.items() for i in b], "userId long, item string"))
    want = []
    for u, b in held.items():
        best = {}
        for left, right, score in rows:
            if set(left) <= b:
                for i in set(right) - b:
                    best[i] = max(best.get(i, 0), score)
        order = sorted(best, key=lambda i: (-best[i], i))[:3]
        want += [(u, i, best[i], k + 1) for k, i in enumerate(order)]
    got = sorted(tuple(r) for r in rules.rule_recommend(strong, baskets, 3).collect())
    assert got == sorted(want)
    sides = rules.rule_sides(strong)
    asked = stage(strong.join(sides, "antecedents").selectExpr("side", "explode(consequents) item", "confidence")
                  .groupBy("side", "item").agg({"confidence": "max"}).toDF("side", "item", "score"))
    assert rules._telling(asked, sides).count() < asked.count()


def test_stratified_cuts_are_exact_quantiles(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(2 ** 32)) for _ in range(500)]
    rows += [("one", 7), ("same", 5), ("same", 5)]
    df = spark.createDataFrame(rows, "_label string, _h long")
    got = {r["_label"]: r["_cut"] for r in cf._cuts(df, 0.8).collect()}
    want = {}
    for label, h in rows:
        want.setdefault(label, []).append(h)
    assert got == pytest.approx({k: np.quantile(v, 0.8) for k, v in want.items()})


def test_rule_text():
    assert rules.min_count(100, 0.1) == 10 and rules.min_count(3, 0.5) == 2


def test_stratified_split_keeps_proportions(ratings):
    rows = [(u, m, 5.0 if (u + m) % 4 == 0 else 1.0, "2020-01-01 00:00:00")
            for u in range(40) for m in range(25)]
    train, test = cf.stratified_split(ratings(rows), ["userId", "movieId"], "rating")
    for level, n in ((5.0, 250), (1.0, 750)):
        assert abs(train.where(f"rating = {level}").count() - 0.8 * n) <= 1
    assert train.count() + test.count() == 1000
