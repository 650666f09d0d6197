"""Products of rows that pass a held block."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, gram, neighbors, sweep


def table(spark, seed=1):
    rng = random.Random(seed)
    rows = [(r * 7 - 30, f, rng.random() - 0.5) for r in range(60) for f in rng.sample(range(80), rng.randint(1, 9))]
    rows += [(10**12, f, 1.0) for f in range(0, 90, 3)]
    return rows, stage(spark.createDataFrame(rows, "r long, f long, v double"))


def brute(rows):
    out = {}
    for (a, f, v), (b, g, w) in itertools.product(rows, rows):
        if f == g and a < b:
            dot, n = out.get((a, b), (0.0, 0))
            out[a, b] = dot + v * w, n + 1
    return out


@pytest.mark.parametrize("piece, blocks, ints", [(7, 1, True), (7, 4, False), (1000, 2, False), (1000, 5, True)])
def test_all_pairs_and_labels(spark, monkeypatch, piece, blocks, ints):
    monkeypatch.setattr(sweep, "PIECE", piece)
    rows, entries = table(spark)
    labels = entries.select("r").distinct().where("r <> 5").withColumn("label", F.col("r") * 2)
    found = sweep.all_pairs(entries, blocks, ints, labels).collect()
    want = brute(rows)
    assert len(found) == len(want)
    assert {(r["a"], r["b"]): (pytest.approx(r["dot"]), r["n_common"]) for r in found} == want
    for r in found:
        assert r["label_a"] == (r["a"] * 2 if r["a"] != 5 else None)
        assert r["label_b"] == (r["b"] * 2 if r["b"] != 5 else None)


@pytest.mark.parametrize("piece, blocks", [(7, 3), (1000, 2)])
def test_best_rows(spark, monkeypatch, piece, blocks):
    monkeypatch.setattr(sweep, "PIECE", piece)
    rows, entries = table(spark, 2)
    want, got = {}, {}
    for (a, b), (dot, _) in brute(rows).items():
        want.setdefault(a, []).append((-round(dot, 9), b))
        want.setdefault(b, []).append((-round(dot, 9), a))
    for r in sweep.best_rows(entries, 3, blocks, True).collect():
        got.setdefault(r["a"], []).append((-round(r["dot"], 9), r["b"]))
    assert {a: sorted(x) for a, x in got.items()} == {a: sorted(x)[:3] for a, x in want.items()}


def test_features_far_apart_and_null_keys(spark):
    rows = [(r, f * 10**15, 1.0) for r in range(9) for f in (r // 3, 5)]
    entries = stage(spark.createDataFrame([*rows, (None, 0, 1.0), (3, None, 1.0)], "r long, f long, v double"))
    found = sweep.all_pairs(entries, 3, False).collect()
    assert {(r["a"], r["b"]): (r["dot"], r["n_common"]) for r in found} == brute(rows) and len(found) == 36


def test_a_task_without_its_block_is_an_error(spark):
    _, entries = table(spark)
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    try:
        assert not sweep.in_order(spark)
        with pytest.raises(Exception, match="rows pass a task that holds none"):
            sweep.all_pairs(entries, 3, True).collect()
    finally:
        spark.conf.unset("spark.sql.unionOutputPartitioning")


@pytest.fixture
def no_products_shuffled(monkeypatch):
    """Packed rows of any table take less of a shuffle than joins, which must not run."""
    monkeypatch.setattr(sweep, "FEW", 0)
    monkeypatch.setattr(sweep, "PRODUCT_BYTES", 10**6)
    for name in ("joined_pairs", "joined_rows", "blocked_pairs", "copies_by_cell"):
        monkeypatch.setattr(gram, name, None)


def test_similarities_shuffle_no_products(spark, ratings, no_products_shuffled):
    rng = random.Random(3)
    cells = {(u, m): rng.randint(1, 10) / 2 for u in range(40) for m in rng.sample(range(60), 3)}
    train = stage(ratings([(u, m, v, "2020-01-01 00:00:00") for (u, m), v in cells.items()]))
    pairs = {}
    for ((u, m), x), ((w, n), y) in itertools.product(cells.items(), repeat=2):
        if m == n and u < w:
            pairs.setdefault((u, w), []).append(x * y)
    length = {u: sum(v * v for (w, _), v in cells.items() if w == u) ** 0.5 for u, _ in cells}
    want = {k: (pytest.approx(sum(v) / length[k[0]] / length[k[1]]), len(v)) for k, v in pairs.items()}
    clusters = train.select("userId").distinct().withColumn("cluster", F.col("userId") % 2)
    found = cf.similarity(train, "user", labels=clusters)
    assert {(r["a"], r["b"]): (r["sim"], r["n_common"]) for r in found.collect()} == want
    boosted = {(r["a"], r["b"]): r["sim"] for r in cf.cluster_boost(found, clusters, 1.5).collect()}
    plain = {(r["a"], r["b"]): r["sim"] for r in found.collect()}
    assert boosted == {(a, b): pytest.approx(min(1.5 * s, 1.0) if a % 2 == b % 2 else s) for (a, b), s in plain.items()}
    by_sets = {(r["a"], r["b"]): r["sim"] for r in cf.jaccard(train).collect()}
    assert by_sets == {k: pytest.approx(len(v) / (6 - len(v))) for k, v in pairs.items()}
    near = cf.nearest_neighbors(train, "user", 2).collect()
    best = {}
    for (a, b), s in plain.items():
        best.setdefault(a, []).append((-round(s, 9), b))
        best.setdefault(b, []).append((-round(s, 9), a))
    assert {(r["entity"], r["place"]): r["neighbor"] for r in near} == {
        (a, i + 1): b for a, x in best.items() for i, (_, b) in enumerate(sorted(x)[:2])}


def test_a_cluster_boost_joins_nothing_that_came_along(spark, ratings, no_products_shuffled):
    train = stage(ratings([(u, u // 2, 3.0, "2020-01-01 00:00:00") for u in range(40)]))
    clusters = train.select("userId").distinct().withColumn("cluster", F.col("userId") % 8)
    found = cf.similarity(train, "user", labels=clusters)

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join")

    assert joins(cf.cluster_boost(found, clusters)) == joins(found)


@pytest.mark.parametrize("of, shrinkage, piece, listed", [("user", 0.0, 1000, 1000), ("item", 10.0, 5, 0)])
def test_raters_come_from_rows_that_pass(spark, ratings, monkeypatch, of, shrinkage, piece, listed):
    rng = random.Random(6)
    cells = {(u, m): rng.randint(1, 10) / 2 for u in range(25) for m in range(20) if rng.random() < 0.3}
    train = stage(ratings([(u, m, v, "2020-01-01 00:00:00") for (u, m), v in cells.items()]))
    targets = ratings([(u, m, 0.0, "2020-01-01 00:00:00") for u in range(3, 30) for m in range(22)])
    pairs = cf.similarity(train, of, "own")
    pairs = stage(cf.shrink(pairs, shrinkage) if shrinkage else pairs)

    def rows(df):
        return {(r["entity"], r["context"], r["place"]): (r["neighbor"], pytest.approx(r["sim"]), r["rating"])
                for r in df.collect()}

    want = rows(cf.topk_neighbors(targets, train, pairs, of, 3))
    monkeypatch.setattr(sweep, "PIECE", piece)
    monkeypatch.setattr(sweep, "LISTED", listed)
    monkeypatch.setattr(sweep, "FEW", 0)
    monkeypatch.setattr(sweep, "RATER_BYTES", 10**6)
    for name in ("joined_raters", "neighbors_entries", "best_of_block"):
        monkeypatch.setattr(neighbors, name, None)
    assert want and rows(cf.nearest_raters(targets, train, of, 3, "own", shrinkage)) == want


def some_ratings(ratings, seed):
    rng = random.Random(seed)
    rows = [(u, m, rng.randint(1, 10) / 2 if u != 6 else 2.0, "2020-01-01 00:00:00")
            for u in range(24) for m in range(30) if rng.random() < 0.2 or u == m == 6]
    table = stage(ratings(rows))
    return table, stage(table.where("userId % 3 = 0").select("userId").distinct())


@pytest.mark.parametrize("swept", [False, True])
def test_item_recommendations_make_no_product(spark, ratings, monkeypatch, swept):
    table, asked = some_ratings(ratings, 11)
    mine = table.join(asked, "userId", "left_semi")
    unseen = cf.candidate_items(asked, table)
    fans = mine.where("rating >= 4").select("userId", F.col("movieId").alias("entity"))
    pairs = stage(cf.shrink(cf.similarity(table, "item", "other"), 100.0))
    close = {(r["userId"], r["movieId"]): r["sim"] for r in fans.join(
        cf.both_ways(pairs).where("sim > 0"), "entity").groupBy("userId", F.col("neighbor").alias("movieId")).agg(
            F.max("sim").alias("sim")).join(unseen, ["userId", "movieId"], "left_semi").collect()}
    liked = {r["userId"] for r in fans.collect()}
    assert 6 not in liked
    close |= {(r["userId"], r["movieId"]): 0.0 for r in unseen.collect() if r["userId"] not in liked}
    short = [(u, m) for u in {u for u, _ in close}
             for _, m in sorted((-round(s, 9), m) for (w, m), s in close.items() if w == u)[:6]]
    short = spark.createDataFrame(short, "userId long, movieId long")
    want = {(r["userId"], r["place"]): (r["movieId"], pytest.approx(r["prediction"])) for r in cf.best_first(
        cf.predict_item_cf(short, table, pairs, (30,)).drop("k"), 3).collect()}
    monkeypatch.setattr(cf, "candidate_items", None)
    if swept:
        monkeypatch.setattr(sweep, "FEW", 0)
        monkeypatch.setattr(sweep, "PRODUCT_BYTES", 10**6)
        monkeypatch.setattr(cf, "similarity_to", None)
    got = {(r["userId"], r["place"]): (r["movieId"], r["prediction"])
           for r in cf.recommend_item_cf(asked, table, 3).collect()}
    assert want and got == want


def test_user_recommendations_predict_no_table_of_candidates(spark, ratings, monkeypatch):
    table, asked = some_ratings(ratings, 12)
    every = cf.predict_user_cf(cf.candidate_items(asked, table), table, ks=(2,), center="own").drop("k")
    want = {(r["userId"], r["place"]): (r["movieId"], pytest.approx(r["prediction"]))
            for r in cf.best_first(every, 5).collect()}
    for name in ("candidate_items", "predict_user_cf", "known_pairs_filter"):
        monkeypatch.setattr(cf, name, None)
    got = {(r["userId"], r["place"]): (r["movieId"], r["prediction"])
           for r in cf.recommend_user_cf(asked, table, 5, 2, "own").collect()}
    assert want and got == want


def test_jaccard_leaves_out_null_users(ratings):
    table = ratings([(u, m, 3.0, "2020-01-01 00:00:00") for u in (None, 1, 2) for m in (1, 2)])
    assert [(r["a"], r["b"], r["sim"], r["n_common"]) for r in cf.jaccard(table).collect()] == [(1, 2, 1.0, 2)]
