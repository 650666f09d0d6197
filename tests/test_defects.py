"""Cases that once went wrong: repeated keys, several classes, missing columns, NaN, large keys."""

from pyspark.sql import functions as F

from ratingloom.operators import classify, clean, quality, regress


def test_smote_balances_with_repeated_keys(spark):
    rows = [(i % 4, 1, float(i), float(-i)) for i in range(20)]
    rows += [(i % 9, 0, float(i), 1.0) for i in range(90)]
    df = spark.createDataFrame(rows, "k long, label int, a double, b double")
    out = classify.smote_oversample(df, ["a", "b"], "k", blocks=2)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 90, 1: 90}


def test_vote_of_three_classes_keeps_every_row(spark):
    rows = [(1, 2.0, "m", [0.2, 0.2, 0.6]), (1, 2.0, "n", [0.5, 0.1, 0.4]),
            (2, 0.0, "m", [0.5, 0.5, 0.0]), (2, 0.0, "n", [0.5, 0.5, 0.0]), (1, 2.0, "svm", None)]
    scored = spark.createDataFrame(rows, "row long, label double, model string, probability array<double>")
    got = {r["row"]: r["prediction"] for r in classify.soft_voting(scored, "row").collect()}
    assert got == {1: 2.0, 2: 0.0}


def test_classifiers_of_three_classes(spark):
    rows = [(i, float(i % 3), float(i % 3) + 0.01 * (i % 7), float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "row long, label double, a double, b double")
    _, scored = classify.train_classifiers(
        df, df, ["a", "b"], "row", names=["gradient_boost", "svm", "logistic"], trees=3, rounds=2, iterations=20)
    assert {r["model"]: r["count"] for r in scored.groupBy("model").count().collect()} == {
        "gradient_boost": 120, "svm": 120, "logistic": 120}
    assert classify.soft_voting(scored, "row").count() == 120


def test_missing_columns_are_reported(spark):
    ratings = spark.createDataFrame([(1, 2)], "userId long, other long")
    movies = spark.createDataFrame([(1, "t", "g")], "movieId long, title string, genres string")
    tags = spark.createDataFrame([], "userId long, movieId long, tag string, timestamp string")
    got = {r["check_name"]: r["value"] for r in
           quality.validate_raw({"ratings": ratings, "movies": movies, "tags": tags}).collect()}
    assert got["ratings_missing_columns"] >= 2 and "orphan_ratings" not in got


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert sorted(r.x for r in clean.handle_missing(df).collect()) == [1.0, 2.0, 2.0, 2.0, 3.0]
    capped = [r.x for r in clean.cap_outliers_iqr(df, ["x"]).collect()]
    assert sorted(x for x in capped if x is not None) == [1.0, 2.0, 3.0]


def test_sample_with_large_keys(spark):
    df = spark.range(1000).select((F.col("id") + F.lit(2 ** 62)).alias("k"))
    assert clean.sample_n(df, 10, "k").count() == 10


def test_learners_without_rows(spark):
    none = spark.createDataFrame([], "k long, label double, a double, b double")
    some = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], none.schema)
    for s in (regress.gd_mini_batch(none, ["a", "b"], "label", "k", regress.Descent()),
              regress.gd_sgd(none, ["a", "b"], "label", "k", regress.Descent())):
        assert list(s.weights) == [0.0, 0.0] and s.bias == 0.0
    fitted, scored = classify.train_classifiers(none, some, ["a", "b"], "k")
    assert fitted == {} and scored.collect() == []
    assert scored.columns == ["k", "label", "model", "prediction", "probability", "score"]
