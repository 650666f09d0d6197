from pyspark.sql import functions as F

from ratingloom.operators import quality
from ratingloom.plans import flows


def test_prepared_tables_and_data_sets(star, tmp_path):
    folder = str(tmp_path / "run")
    made = flows.prepare(star.ratings, star.movies, star.tags, 2025, folder)
    assert made["feature_matrix"].count() == made["ratings"].count()
    assert made["user_temporal"].count() == made["user_features"].count()
    again = flows.prepare(star.ratings, star.movies, star.tags, 2025, folder)
    assert set(again) == set(made) == set(flows.PREPARED)
    assert again["user_features"].count() == made["user_features"].count()
    report = quality.validate_ml_datasets(flows.data_sets(made)).collect()
    assert len(report) == 5 and all(r["valid"] for r in report)


def test_rules_and_recommenders(star):
    found = flows.mine_rules(star.ratings, star.movies, 0.02, 0.1)
    assert found["itemsets"].where("size(items) = 1").count() > 0
    scores = {r["method"]: r["rmse"] for r in flows.compare_recommenders(star.ratings).collect()}
    assert set(scores) == {"user_based", "item_based"} and all(v < 3 for v in scores.values())


def test_classifiers_and_clusters(star):
    data = star.ratings.groupBy("userId", "movieId").agg(
        F.max("rating").alias("r"), F.avg(F.hour("timestamp")).alias("hour"),
        F.avg(F.month("timestamp")).alias("month"),
    ).select("userId", "movieId", "hour", "month", (F.col("r") >= 4).cast("int").alias("label"))
    got = flows.fit_classifiers(data, ["hour", "month"], trees=3, rounds=2, iterations=5)
    assert {"voting_ensemble", "logistic", "svm", "mlp"} <= {r["model"] for r in got.collect()}
    out = flows.cluster_all(star.ratings, star.clean_movies, 3)
    assert out["user_clusters"].select("cluster").distinct().count() <= 3
    total = out["cross_ratings"].agg(F.sum("n")).first()[0]
    assert total == star.ratings.join(star.movies, "movieId").count()
