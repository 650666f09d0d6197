"""All pairs, also those of small similarity, and the pair product by a join on features."""

import itertools
import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, gram, neighbors
from ratingloom.plans import q_cf


def rated_at_random(seed, users=14, items=11):
    rng = random.Random(seed)
    return {(u, m): rng.randint(1, 10) / 2 for u in range(users) for m in range(items) if rng.random() < 0.4}


def pair_table(cells, row):
    """(a, b): values of both at every common feature."""
    out = {}
    for (p, x), (q, y) in itertools.product(cells.items(), repeat=2):
        if p[1 - row] == q[1 - row] and p[row] < q[row]:
            out.setdefault((p[row], q[row]), []).append((x, y))
    return out


def lengths(cells, row):
    out = {}
    for key, v in cells.items():
        out[key[row]] = out.get(key[row], 0.0) + v * v
    return {r: math.sqrt(v) for r, v in out.items()}


def centred(cells, by):
    parts = {}
    for key, v in cells.items():
        parts.setdefault(key[by], []).append(v)
    return {key: v - sum(parts[key[by]]) / len(parts[key[by]]) for key, v in cells.items()}


def cosines(cells, row):
    norm = lengths(cells, row)
    return {(a, b): (sum(x * y for x, y in both) / (norm[a] * norm[b]) if norm[a] * norm[b] else 0.0, len(both))
            for (a, b), both in pair_table(cells, row).items()}


def jaccards(cells):
    count = {u: sum(1 for key in cells if key[0] == u) for u, _ in cells}
    return {(a, b): (len(both) / (count[a] + count[b] - len(both)), len(both))
            for (a, b), both in pair_table(cells, 0).items()}


def boosted(pairs):
    return {(a, b): (min(1.2 * s, 1.0) if a % 8 == b % 8 else s, n) for (a, b), (s, n) in pairs.items()}


WANT = {
    "co_rating_pairs": lambda c: {k: (sum(x * y for x, y in v), len(v)) for k, v in pair_table(c, 0).items()},
    "user_similarity_cosine": lambda c: cosines(c, 0),
    "user_similarity_pearson": lambda c: cosines(centred(c, 0), 0),
    "user_similarity_jaccard": jaccards,
    "similarity_cluster_boost": lambda c: boosted(cosines(c, 0)),
    "item_similarity_cosine": lambda c: cosines(c, 1),
    "item_similarity_adjusted": lambda c: cosines(centred(c, 0), 1),
    "item_similarity_correlation": lambda c: cosines(centred(c, 1), 1),
    "similarity_shrinkage": lambda c: {k: (s * n / (n + 100), n)
                                       for k, (s, n) in cosines(centred(c, 0), 1).items()},
    "hybrid_similarity": lambda c: {
        k: (0.8 * cosines(c, 1).get(k, (0.0, 0))[0] + 0.2, cosines(c, 1).get(k, (0.0, 0))[1])
        for k in itertools.combinations(sorted({m for _, m in c}), 2)},
}


@pytest.mark.parametrize("name", sorted(WANT))
def test_queries_sum_up_every_pair(spark, ratings, name):
    cells = rated_at_random(1)
    movies = spark.createDataFrame([(m, ["same"]) for m in range(11)], "movieId long, genre_list array<string>")
    star = SimpleNamespace(ratings=ratings([(u, m, v, "2020-01-01 00:00:00") for (u, m), v in cells.items()]),
                           clean_movies=movies)
    want = {}
    for (a, b), (sim, n) in WANT[name](cells).items():
        for entity in (a, b):
            want.setdefault(entity, []).append((sim, n))
    got = {r["entity"]: r for r in getattr(q_cf, name)(star).collect()}
    assert got.keys() == want.keys()
    for entity, pairs in want.items():
        sims, row = [s for s, _ in pairs], got[entity]
        assert (row["n_pairs"], row["n_common"]) == (len(pairs), sum(n for _, n in pairs))
        assert [row["sum_sim"], row["sum_square"], row["min_sim"], row["max_sim"]] == pytest.approx(
            [sum(sims), sum(s * s for s in sims), min(sims), max(sims)], abs=1e-9)


def entries(spark, rows):
    return stage(spark.createDataFrame(rows, "r long, f long, v double"))


def brute(rows):
    out = {}
    for (a, f, v), (b, g, w) in itertools.product(rows, repeat=2):
        if f == g and a < b:
            dot, n = out.get((a, b), (0.0, 0))
            out[a, b] = dot + v * w, n + 1
    return out


@pytest.mark.parametrize("block_rows, crowd", [(1, 0), (1, 60), (2048, 60)])
def test_product_by_join_blocks_or_both(spark, monkeypatch, block_rows, crowd):
    """Few rows to a feature: joined; some features that all rows have: both; one block: blocked."""
    monkeypatch.setattr(gram, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(gram, "TASK_PRODUCTS", 10)
    rng, used = random.Random(3), []
    for name in ("joined_pairs", "blocked_pairs"):
        monkeypatch.setattr(gram, name, lambda *a, _run=getattr(gram, name), _name=name: used.append(_name) or _run(*a))
    rows = [(r, f, rng.random() - 0.5) for r in range(20) for f in rng.sample(range(30), 4)]
    if crowd:
        rows += [(r, 100, rng.random()) for r in range(20, 20 + crowd)]
        rows += [(20 + r, 200 + r // 2, 1.0) for r in range(crowd)]
    got = {(r["a"], r["b"]): (pytest.approx(r["dot"]), r["n_common"])
           for r in gram.gram_pairs(entries(spark, rows)).collect()}
    assert got == brute(rows)
    assert used == (["blocked_pairs"] if block_rows > 1 else ["joined_pairs"])


def test_product_of_crowded_and_rare_features(spark, monkeypatch):
    monkeypatch.setattr(gram, "block_plan", lambda rows, *rest: (3, 1))
    rng = random.Random(4)
    rows = [(r, 1000 + r // 2, 1.0) for r in range(400)] + [(r, f, rng.random()) for r in range(30) for f in (1, 2)]
    used = []
    for name in ("joined_pairs", "blocked_pairs"):
        monkeypatch.setattr(gram, name, lambda *a, _run=getattr(gram, name), _name=name: used.append(_name) or _run(*a))
    got = [(r["a"], r["b"], pytest.approx(r["dot"]), r["n_common"])
           for r in gram.gram_pairs(entries(spark, rows)).collect()]
    assert sorted(used) == ["blocked_pairs", "joined_pairs"]
    assert sorted(x[:2] for x in got) == sorted(brute(rows)) and {x[:2]: x[2:] for x in got} == brute(rows)


def test_product_of_nothing(spark):
    assert gram.gram_pairs(entries(spark, [(1, 1, 1.0)]).limit(0)).collect() == []
    assert gram.gram_pairs(entries(spark, [(1, 1, 1.0), (2, 2, 1.0)])).collect() == []


@pytest.mark.parametrize("of, shrinkage, costs", [
    (of, s, c) for of, s in (("user", 0.0), ("item", 10.0)) for c in ((0.0, 1.0), (1.0, 0.0), (1e9, 1e9))])
def test_nearest_raters_by_joins_or_blocks(spark, ratings, monkeypatch, of, shrinkage, costs):
    cells = rated_at_random(6)
    train = stage(ratings([(u, m, v, "2020-01-01 00:00:00") for (u, m), v in cells.items()]))
    targets = ratings([(u, m, 0.0, "2020-01-01 00:00:00") for u in range(1, 15) for m in range(12)])
    pairs = cf.similarity(train, of, "own")
    pairs = stage(cf.shrink(pairs, shrinkage) if shrinkage else pairs)
    monkeypatch.setattr(neighbors, "join_costs", lambda *a: costs)

    def rows(df):
        return {(r["entity"], r["context"], r["place"]): (r["neighbor"], pytest.approx(r["sim"]), r["rating"])
                for r in df.collect()}

    want = rows(cf.topk_neighbors(targets, train, pairs, of, 3))
    assert want and rows(cf.nearest_raters(targets, train, of, 3, "own", shrinkage)) == want


def test_sparse_predictions_copy_nothing_to_blocks(spark, ratings, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK_ROWS", 4)
    monkeypatch.setattr(gram, "copies_by_cell", None)
    monkeypatch.setattr(neighbors, "best_of_block", None)
    rows = [(u, m, 1.0 + (u + m) % 4, "2020-01-01 00:00:00") for u in range(80) for m in (u // 2, 100 + u // 4)]
    train = stage(ratings(rows))
    found = cf.nearest_raters(train, train, "user", 9).collect()
    assert {(r["entity"] // 4, r["neighbor"] // 4) for r in found} == {(i, i) for i in range(20)}
    assert len(found) == 80 * (1 + 3)
    near = cf.nearest_neighbors(train, "user", 2).collect()
    assert len(near) == 160 and all(r["entity"] // 4 == r["neighbor"] // 4 for r in near)


@pytest.mark.parametrize("density", [0.1, 0.4, 0.9])
def test_recommendations_equal_those_from_all_candidates(spark, ratings, density):
    rng = random.Random(8)
    seen = {(u, m): rng.randint(1, 10) / 2 for u in range(20) for m in range(40)
            if rng.random() < density * (u % 3) / 2 or (u == 0 and m < 3)}
    table = stage(ratings([(u, m, v, "2020-01-01 00:00:00") for (u, m), v in seen.items()]))
    asked = table.where("userId % 2 = 0").select("userId")
    every = cf.predict_user_cf(cf.candidate_items(asked, table), table).drop("k")
    want = {(r["userId"], r["place"]): (r["movieId"], pytest.approx(r["prediction"]))
            for r in cf.best_first(every, 5).collect()}
    got = {(r["userId"], r["place"]): (r["movieId"], r["prediction"])
           for r in cf.recommend_user_cf(asked, table, 5).collect()}
    assert want and got == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidates_are_not_shuffled(spark, ratings):
    table = stage(ratings([(u, m, 3.0, "2020-01-01 00:00:00") for u in range(6) for m in range(9) if (u + m) % 3]))
    asked = table.where("userId % 2 = 0").select("userId").unionByName(spark.createDataFrame([(None,), (77,)], "userId long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = cf.candidate_items(asked, table)
        lines = plan(found).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rated = {(r["userId"], r["movieId"]) for r in table.collect()}
    assert sorted((r["userId"] if r["userId"] is not None else -1, r["movieId"]) for r in found.collect()) == sorted(
        (u, m) for u in (-1, 0, 2, 4, 77) for m in range(9) if (u, m) not in rated)
    product = next(i for i, line in enumerate(lines) if "NestedLoopJoin" in line or "CartesianProduct" in line)
    assert not any("Exchange" in line for line in lines[:product])


def test_two_classes_are_not_dealt_to_two_tasks(spark, ratings):
    rows = [(u, m, 3.0 + (u % 2), "2020-01-01 00:00:00") for u in range(40) for m in range(30)]
    labelled = stage(ratings(rows)).withColumn("label", F.col("rating") >= 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6000")
    try:
        train, test = cf.stratified_split(labelled, ["userId", "movieId"], "label")
        assert "BroadcastHashJoin" in plan(train) and "SortMergeJoin" not in plan(train)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert train.count() + test.count() == len(rows)
