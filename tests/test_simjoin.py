"""Threshold joins and the nearest raters against brute force."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, gram, neighbors, simjoin


def made(seed, rows=60, features=40):
    """Rows of different lengths, a feature that most rows have, equal and nearly equal rows."""
    rng = random.Random(seed)
    cells = {r: {f: rng.randint(1, 10) / 2 for f in rng.sample(range(features), rng.randint(1, 14))}
             for r in range(rows)}
    for r in cells:
        if r % 4:
            cells[r][99] = rng.randint(1, 10) / 2
    for r in range(0, rows, 5):
        cells[rows + r] = dict(cells[r])
        cells[2 * rows + r] = {f: v + 0.5 * (f % 2) for f, v in list(cells[r].items())[1:]} or {0: 1.0}
    return cells


def frame(spark, cells, unit=True):
    rows = []
    for r, own in cells.items():
        norm = math.sqrt(sum(v * v for v in own.values())) if unit else 1.0
        rows += [(r, f, v / norm if norm else 0.0) for f, v in own.items()]
    return stage(spark.createDataFrame(rows, "r long, f long, v double"))


def brute(cells, value):
    out = {}
    for a, b in itertools.combinations(sorted(cells), 2):
        both = cells[a].keys() & cells[b].keys()
        if both:
            out[a, b] = value(cells[a], cells[b], both), len(both)
    return out


def cosine(x, y, both):
    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(x[f] * y[f] for f in both) / norm if norm else 0.0


def jaccard(x, y, both):
    return len(both) / (len(x) + len(y) - len(both))


def above(pairs, least):
    return {k: (pytest.approx(s), n) for k, (s, n) in pairs.items() if round(s, 9) >= least}


def found(df, value="sim"):
    return {(r["a"], r["b"]): (r[value], r["n_common"]) for r in df.collect()}


@pytest.mark.parametrize("least", [0.05, 0.4, 0.8, 1.0])
def test_cosine_join_equals_brute_force(spark, least):
    cells = made(1)
    for r in (0, 7):  # centred vectors have negative and zero parts
        cells[r] = {f: v - 2.5 for f, v in cells[r].items()}
    cells[300], cells[301] = {1: 0.0, 2: 0.0}, {99: 1.0}
    assert found(simjoin.cosine_pairs(frame(spark, cells), least)) == above(brute(cells, cosine), least)


@pytest.mark.parametrize("least", [0.05, 0.5, 0.9])
def test_jaccard_join_equals_brute_force(spark, least):
    cells = made(2)
    got = found(simjoin.jaccard_pairs(frame(spark, cells).select("r", "f"), least))
    assert got == above(brute(cells, jaccard), least)


@pytest.mark.parametrize("least", [1, 3, 9])
def test_overlap_join_equals_brute_force(spark, least):
    cells = made(3)
    pairs = brute(cells, lambda x, y, both: sum(x[f] * y[f] for f in both))
    got = found(simjoin.overlap_pairs(frame(spark, cells, False), least), "dot")
    assert got == {k: (pytest.approx(d), n) for k, (d, n) in pairs.items() if n >= least}


def test_shrunk_join_equals_brute_force(spark, ratings):
    cells = made(4, 30)
    table = ratings([(f, r, v, "2020-01-01 00:00:00") for r, own in cells.items() for f, v in own.items()])
    want = {k: (s * n / (n + 10), n) for k, (s, n) in brute(cells, cosine).items()}
    got = found(cf.shrunk_similarity(table, "item", None, 0.2, 10.0))
    assert got == above(want, 0.2) and got


def test_few_pairs_reach_whole_rows(spark):
    """A feature that every row has makes no candidates where rows have rarer ones."""
    cells = {r: {10 + r: 3.0, 200 + r // 2: 3.0, 99: 1.0} for r in range(120)}
    units = frame(spark, cells)
    assert brute(cells, cosine).keys() and len(brute(cells, cosine)) == 120 * 119 // 2
    assert simjoin.cosine_candidates(units, lambda n: F.lit(0.4)).count() == 60
    sets = simjoin.set_candidates(units, lambda n: F.ceil(n * 0.5), lambda n, m: F.ceil((n + m) / 3))
    assert sets.count() == 60
    assert len(found(simjoin.jaccard_pairs(units.select("r", "f"), 0.5))) == 60


def test_joins_of_nothing(spark):
    none = frame(spark, made(1)).limit(0)
    assert simjoin.cosine_pairs(none, 0.5).collect() == []
    assert simjoin.jaccard_pairs(none, 0.5).collect() == []
    assert simjoin.overlap_pairs(none, 2).collect() == []
    for least in (0, -1):
        with pytest.raises(ValueError):
            simjoin.cosine_pairs(none, least)
        with pytest.raises(ValueError):
            simjoin.jaccard_pairs(none, least)


@pytest.mark.parametrize("of, shrinkage, block_rows, expand", [
    ("user", 0.0, 2048, 2_000_000), ("item", 10.0, 5, 40), ("user", 0.0, 3, 7)])
def test_nearest_raters_equal_the_pair_table(ratings, monkeypatch, of, shrinkage, block_rows, expand):
    monkeypatch.setattr(gram, "EXPAND", expand)
    monkeypatch.setattr(gram, "BLOCK_ROWS", block_rows)
    rng = random.Random(5)
    seen = {(u, m) for u in range(30) for m in range(14) if m == 0 or rng.random() < 0.3}
    train = stage(ratings([(u, m, rng.randint(1, 10) / 2, "2020-01-01 00:00:00") for u, m in sorted(seen)]))
    targets = ratings([(u, m, 0.0, "2020-01-01 00:00:00") for u in range(32) for m in range(16)])
    pairs = cf.similarity(train, of, "own")
    pairs = stage(cf.shrink(pairs, shrinkage) if shrinkage else pairs)

    def rows(df):
        return {(r["entity"], r["context"], r["place"]): (r["neighbor"], pytest.approx(r["sim"]), r["rating"])
                for r in df.collect()}

    want = rows(cf.topk_neighbors(targets, train, pairs, of, 3))
    assert want and rows(cf.nearest_raters(targets, train, of, 3, "own", shrinkage)) == want


def test_nearest_raters_of_nothing(ratings):
    train = ratings([(1, 1, 4.0, "2020-01-01 00:00:00")])
    none = train.limit(0)
    assert cf.nearest_raters(none, train, "user", 3).collect() == []
    assert cf.nearest_raters(train, none, "user", 3).collect() == []
    assert neighbors.context_topk(train.select(F.col("userId").alias("entity"), F.col("movieId").alias("context")),
                                  cf.vectors(train, "user").withColumn("rating", F.lit(1.0)), 2).collect() == []
