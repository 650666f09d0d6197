import datetime

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import times
from ratingloom.operators import clean, quality, scale


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_parse_ts_takes_both_formats(spark):
    df = spark.createDataFrame([("0",), ("1970-01-01 00:00:00",), ("junk",), (None,)], "t string")
    got = [r[0] for r in df.select(F.unix_timestamp(clean.parse_ts(F.col("t")))).collect()]
    assert got == [0, 0, None, None]


def test_movie_titles(spark):
    df = clean.clean_movies(spark.createDataFrame(
        [(1, "Up (2009)", "A|B"), (2, "Up (2009) again", "A"), (3, "X (a) (1999)", "(no genres listed)")],
        "movieId long, title string, genres string"))
    got = {r["movieId"]: (r["year"], r["clean_title"], r["genre_list"]) for r in df.collect()}
    assert got == {1: (2009, "Up", ["A", "B"]), 2: (None, "Up (2009) again", ["A"]),
                   3: (1999, "X (a)", ["(no genres listed)"])}


def test_tags_drop_null_and_blank(spark):
    df = clean.clean_tags(spark.createDataFrame(
        [(1, 1, " Fun ", "0"), (1, 1, None, "0"), (1, 1, "  ", "0")],
        "userId long, movieId long, tag string, timestamp string"))
    assert [r["tag_clean"] for r in df.collect()] == ["fun"]


def test_missing_half_is_filled_and_more_is_dropped(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, "x"), (2, None, None, None), (3, 3.0, None, "x"), (4, None, 9.0, "a")],
        "k long, half double, most double, kind string")
    out = clean.handle_missing(df)
    assert out.columns == ["k", "half", "kind"]
    assert rows(out) == [(1, 1.0, "x"), (2, 2.0, "x"), (3, 3.0, "x"), (4, 2.0, "a")]


def test_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (2, 1, "c")], "k int, o int, v string")
    assert rows(clean.remove_duplicates(df, ["k"], ["o"])) == [(1, 4, "z"), (2, 1, "c")]
    assert clean.remove_duplicates(df.unionByName(df)).count() == 3


def test_latest_rating_wins(ratings):
    df = ratings([(1, 1, 2.0, "2020-01-01 00:00:00"), (1, 1, 3.0, "2020-01-02 00:00:00"),
                  (1, 1, 4.0, "2020-01-02 00:00:00")])
    assert [r["rating"] for r in clean.latest_ratings(df).collect()] == [4.0]


def test_types_shrink_strictly(spark):
    df = spark.createDataFrame([(127, 126, 40000, 1.5), (0, -127, 0, 2.5)],
                               "a long, b long, c long, d double")
    kinds = dict(clean.downcast_types(df).dtypes)
    assert kinds == {"a": "smallint", "b": "tinyint", "c": "int", "d": "float"}


def test_sanitize_replaces_what_is_not_a_number(spark):
    df = spark.createDataFrame([("7", float("inf"), [1]), ("x", None, [2])],
                               "a string, b double, c array<int>")
    out = clean.sanitize_types(df)
    assert out.columns == ["a", "b"]
    assert rows(out) == [(0.0, 0.0), (7.0, 0.0)]
    kept = clean.sanitize_matrix(df.withColumn("one", F.lit(3)).withColumn("k", F.lit(1)), ["k"])
    assert kept.columns == ["k"]


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, c double")
    out = scale.scale_standard(df, ["x", "c"])
    assert rows(out.select("x_scaled", "c_scaled")) == [(-1.0, 0.0), (1.0, 0.0)]
    assert rows(scale.scale_robust(df, ["c"]).select("c_scaled")) == [(0.0,), (0.0,)]
    assert rows(scale.scale_minmax(df, ["x", "c"]).select("x_scaled", "c_scaled")) == [
        (0.0, 0.0), (1.0, 0.0)]


def test_label_encoding_sorts_strings(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    got = {r["v"]: r["v_encoded"] for r in scale.encode_label(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: 3}


def test_ratios_only_without_zero_divisors(spark):
    from ratingloom.operators.matrix import interaction_features

    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0)], "a double, b double")
    out = interaction_features(df, [("a", "b"), ("b", "a"), ("a", "none")])
    assert out.columns == ["a", "b", "a_x_b", "b_x_a", "b_div_a"]


def test_season_and_holiday_edges(spark):
    df = spark.createDataFrame(
        [("2012-12-28 00:00:00",), ("2012-12-28 00:00:01",), ("2012-12-22 00:00:00",),
         ("2016-12-25 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    got = df.select(times.holiday_flag(F.col("t")), times.season(F.col("t")))
    assert [tuple(r) for r in got.collect()] == [(1, "winter"), (0, "winter"), (1, "winter"),
                                                 (0, "winter")]


def test_validation_of_an_empty_table(ratings):
    df = ratings([(1, 1, 1.0, "2020-01-01 00:00:00")]).where("userId > 5")
    assert [tuple(r) for r in quality.validate_ratings(df).collect()] == [(0, 0, 0)]


def test_autofix_drops_the_earlier_of_a_pair(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i, 1.0, float(i % 3)) for i in range(50)],
                               "k long, a double, b double, c double, d double")
    out = quality.autofix_features(df, "k")
    assert out.columns == ["k", "b", "d"]


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one, two = clean.sample_n(df, 50, "k"), clean.sample_n(df.repartition(7), 50, "k")
    assert rows(one) == rows(two) and one.count() == 50


def test_onehot_vector_takes_any_number_of_values(spark):
    from ratingloom.operators import scale

    values = [f"v{i:05d}" for i in range(10_500)]
    df = spark.createDataFrame([*((v,) for v in values), (None,)], "kind string")
    got = {r["kind"]: r["kind_onehot"] for r in scale.encode_onehot(df, "kind").collect()}
    assert all(got[v]["indices"] == [i] and got[v]["values"] == [1.0]
               and got[v]["size"] == len(values) for i, v in enumerate(values))
    assert got[None]["indices"] == []
