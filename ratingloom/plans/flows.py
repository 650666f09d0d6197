"""Whole analyses made of operators: each takes tables and returns named results.

Tables that several steps read are staged once; everything else stays lazy until a result
is written or collected by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.times import holiday_flag, season
from ratingloom.operators import (
    cf, classify, clean, cluster, coldstart, features, genres, matrix, quality, regress, rules,
    scale, tags, temporal,
)
from ratingloom.sources import files


#: Tables of a prepared run.
PREPARED = ["ratings", "movies", "tags", "user_features", "movie_features", "feature_matrix",
            "user_temporal", "movie_temporal", "tag_stats", "genre_features", "cold_start_users",
            "cold_start_movies"]


def prepare(ratings: DataFrame, movies: DataFrame, tag_table: DataFrame, as_of_year: int,
            folder: str | None = None) -> dict[str, DataFrame]:
    """Clean the three tables, build every feature table and the five data sets.

    With ``folder`` a valid earlier run is returned instead, and a new run is saved there; both
    have the same tables. The folder belongs to one set of inputs.
    """
    if folder is not None:
        found = files.load_run(ratings.sparkSession, folder, required=PREPARED)
        if found:
            return found
    clean_movies = clean.clean_movies(movies)
    clean_tags = clean.clean_tags(tag_table)
    keys = ["userId", "movieId", "timestamp"]
    facts = stage(clean.remove_duplicates(clean.clean_ratings(ratings), keys).withColumns({
        "season": season(F.col("timestamp")), "is_holiday_week": holiday_flag(F.col("timestamp")),
    }))
    users = stage(features.user_features(facts))
    items = stage(features.movie_features(facts, clean_movies, as_of_year))
    joined = matrix.interaction_pairwise(matrix.feature_matrix(
        facts.select("userId", "movieId", "rating"),
        users.drop("timestamp_min", "timestamp_max"),
        items.drop("timestamp_min", "timestamp_max", "title", "genres", "clean_title",
                   "genre_list"),
    ))
    out = {
        "ratings": facts, "movies": clean_movies, "tags": clean_tags,
        "user_features": users, "movie_features": items, "feature_matrix": joined,
        "user_temporal": temporal.user_temporal(facts),
        "movie_temporal": temporal.movie_temporal(facts, clean_movies),
        "tag_stats": tags.tag_stats(clean_tags),
        "genre_features": genres.genre_binary(clean_movies)
        .join(genres.genre_scores(facts, clean_movies), "movieId")
        .join(genres.genre_rarity(clean_movies), "movieId"),
        "cold_start_users": coldstart.cold_start_user(facts),
        "cold_start_movies": coldstart.cold_start_movie(facts, clean_movies),
    }
    if folder is not None:
        files.save_run(out, folder)
        return files.load_run(ratings.sparkSession, folder, required=PREPARED)
    return out


def data_sets(prepared: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five task data sets of a prepared run; check them with ``validate_ml_datasets``."""
    liked = prepared["ratings"].withColumn("item", F.col("movieId").cast("string"))
    return {
        "regression": matrix.prepare_supervised(prepared["feature_matrix"], "regression"),
        "classification": matrix.prepare_supervised(prepared["feature_matrix"], "classification"),
        "clustering_users": matrix.prepare_clustering(prepared["user_features"], "userId"),
        "clustering_movies": matrix.prepare_clustering(prepared["movie_features"], "movieId"),
        "association_rules": rules.transactions(liked),
    }


def mine_rules(ratings: DataFrame, movies: DataFrame, min_support: float = 0.01,
               min_confidence: float = 0.5) -> dict[str, DataFrame]:
    """Baskets of liked titles, itemsets, rules, and the best of both."""
    default = F.concat(F.lit("Movie_"), F.col("movieId").cast("string"))
    named = matrix.map_lookup(ratings, movies, "movieId", "title", default)
    baskets = stage(rules.transactions(named, "title"))
    itemsets = stage(rules.frequent_itemsets(baskets, min_support))
    strong = stage(rules.association_rules(itemsets, min_confidence))
    return {"transactions": baskets, "itemsets": itemsets, "rules": strong,
            "top_rules": rules.top_rules(strong), "bundles": rules.movie_bundles(itemsets)}


def compare_recommenders(ratings: DataFrame) -> DataFrame:
    """User-based against item-based prediction on a repeatable split."""
    latest = stage(clean.latest_ratings(ratings).select("userId", "movieId", "rating"))
    train, test = map(stage, cf.train_test_split(latest, ["userId", "movieId"]))
    return cf.cf_compare(train, test)


def scaled_split(data: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training and test rows scaled by the training rows."""
    train, test = cf.train_test_split(stage(data), ["userId", "movieId"])
    parameters = scale.standard_parameters(train, columns)
    scaled = {f"{c}_scaled": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in parameters.items()}
    return (stage(train.withColumns(scaled)), stage(test.withColumns(scaled)), list(scaled))


def fit_regressions(data: DataFrame, columns: list[str]) -> DataFrame:
    """The descent methods compared on a supervised data set."""
    train, test, names = scaled_split(data, columns)
    keyed = train.withColumn("key", F.xxhash64("userId", "movieId"))
    return regress.compare_methods(keyed, test, names, "label", "key")


def fit_classifiers(data: DataFrame, columns: list[str], **sizes) -> DataFrame:
    """Metrics of every classifier and of their vote; classes balanced first when needed."""
    train, test, names = scaled_split(data, columns)
    row = F.monotonically_increasing_id()
    test = stage(test.withColumn("row", row))
    balanced = stage(classify.smote_oversample(train.withColumn("row", row), names, "row"))
    _, scored = classify.train_classifiers(balanced, test, names, "row",
                                           **sizes)
    scored = stage(scored)
    vote = classify.soft_voting(scored, "row").withColumn("model", F.lit("voting_ensemble"))
    return classify.binary_metrics(
        scored.select("model", "label", "prediction").unionByName(
            vote.select("model", "label", "prediction")), ["model"])


def cluster_all(ratings: DataFrame, movies: DataFrame, n_user_clusters: int = 8
                ) -> dict[str, DataFrame]:
    """User segments, item hierarchy, and how the one rates the other."""
    segments = stage(cluster.segmentation_features(ratings, movies))
    users = stage(cluster.kmeans_users(segments, n_user_clusters))
    items = stage(cluster.movie_cluster_features(ratings, movies))
    columns = [c for c in items.columns if c != "movieId"]
    labels = stage(
        cluster.hierarchical_two_level(items, columns, "movieId")[("ward", None)])
    cross = cluster.cross_cluster_ratings(
        ratings, users.withColumnRenamed("cluster", "user_cluster"),
        labels.withColumnRenamed("cluster", "movie_cluster"))
    return {
        "user_clusters": users, "movie_clusters": labels,
        "user_profiles": cluster.cluster_profiles(segments.join(users, "userId")),
        "movie_profiles": cluster.movie_cluster_stats(
            items.join(labels, "movieId"), genres.genre_names(movies)),
        "cross_ratings": cross, "patterns": cluster.cross_cluster_patterns(cross),
    }


def check_inputs(ratings: DataFrame, movies: DataFrame, tag_table: DataFrame) -> DataFrame:
    return quality.validate_raw({"ratings": ratings, "movies": movies, "tags": tag_table})
