import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratingloom.functions import stats
from ratingloom.functions.staging import shared_dir, stage


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    back = stage(df)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == shared_dir(spark)


@pytest.mark.parametrize("small_rows", [0, 1_000_000])
@pytest.mark.parametrize("kind", ["uniform", "ties", "one"])
def test_quantiles_match_linear_interpolation(spark, small_rows, kind):
    rng = random.Random(3)
    values = {
        "uniform": [rng.random() * 100 for _ in range(997)],
        "ties": [float(rng.choice([1, 1, 1, 1, 2, 50])) for _ in range(600)],
        "one": [4.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ps = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = stats.quantiles(df, {"v": ps}, small_rows=small_rows, accuracy=100)
    for p in ps:
        assert got[("v", p)] == pytest.approx(float(np.quantile(values, p)), abs=1e-9)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert stats.quantiles(df, {"v": [0.5]}) == {("v", 0.5): None}


def test_most_common_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)],
                               "k string")
    assert stats.most_common(df, "k") == "a"
    assert stats.most_common(df.where("k = 'z'"), "k") is None


def test_running_totals_and_dense_index(spark):
    keys = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, v long")
    got = stats.running_totals(df, [F.col("k").asc()], {"t": F.col("v")}).collect()
    total, want = 0, {}
    for k in sorted(keys):
        total += k % 7
        want[k] = total
    assert {r["k"]: r["t"] for r in got} == want
    doubled = df.unionByName(df)
    index = {r["k"]: r["i"] for r in stats.dense_index(doubled, "k", "i").collect()}
    assert index == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_ordered_index_with_hot_keys(ratings, hot_rows):
    rng = random.Random(5)
    rows = [
        (1 if rng.random() < 0.5 else rng.randint(2, 9), i, float(rng.randint(1, 5)),
         f"2020-0{rng.randint(1, 3)}-01 {rng.randint(0, 3):02d}:{rng.randint(0, 2):02d}:00")
        for i in range(200)
    ]
    df = stats.ordered_index(ratings(rows), "userId", "timestamp", ("movieId", "rating"),
                             hot_rows=hot_rows)
    frame = pd.DataFrame(rows, columns=["u", "m", "r", "t"]).sort_values(["u", "t", "m", "r"])
    frame["idx"] = frame.groupby("u").cumcount()
    sizes = frame.groupby("u").size()
    got = {r["movieId"]: (r["idx"], r["n_rows"]) for r in df.collect()}
    assert got == {r.m: (r.idx, sizes[r.u]) for r in frame.itertuples()}


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_volatility_against_brute_force(ratings, hot_rows):
    from ratingloom.operators.temporal import rating_volatility

    rng = random.Random(7)
    rows = [
        (i, 1 if i % 3 else 2, rng.randint(1, 10) / 2,
         str(pd.Timestamp("2020-01-01") + pd.Timedelta(hours=rng.randint(0, 2400))))
        for i in range(120)
    ]
    # exactly 30 days apart: the older rating is outside the window
    rows += [(500, 3, 1.0, "2020-01-01 00:00:00"), (501, 3, 5.0, "2020-01-31 00:00:00")]
    got = {r["movieId"]: r["rating_volatility"]
           for r in rating_volatility(ratings(rows), hot_rows=hot_rows).collect()}
    for movie in (1, 2, 3):
        mine = [(pd.Timestamp(t), r) for _, m, r, t in rows if m == movie]
        stds = []
        for t, _ in mine:
            window = [r for s, r in mine if t - pd.Timedelta(days=30) < s <= t]
            if len(window) > 1:
                stds.append(statistics.stdev(window))
        want = sum(stds) / len(stds) if stds else 0.0
        assert got[movie] == pytest.approx(want, abs=1e-9)
