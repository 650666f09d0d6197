"""Features for users and items with few ratings, and statistics of clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import quantiles
from ratingloom.operators.genres import DEFAULT_RATING, genre_expected_rating

COLD_SHARE = 0.1
DEFAULT_HOUR = 12
DEFAULT_DAY = "Friday"


def _counts(ratings: DataFrame, key: str) -> tuple[DataFrame, float]:
    sums = stage(ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("rating_count"), F.sum("rating").alias("_sum")
    ))
    total = sums.agg(F.sum("_sum").alias("s"), F.sum("rating_count").alias("n")).first()
    threshold = quantiles(sums, {"rating_count": [COLD_SHARE]})[("rating_count", COLD_SHARE)]
    cold = (F.col("rating_count") < F.lit(threshold)).cast("int")
    out = sums.select(
        key, cold.alias("is_cold_start"),
        (1 - F.exp(-F.col("rating_count") / 10)).alias("rating_confidence"),
    )
    return out, total["s"] / total["n"] if total["n"] else None


def cold_start_user(ratings: DataFrame) -> DataFrame:
    """Cold flag and confidence per user; preferred hour and day of the cold ones."""
    users, mean = _counts(ratings, "userId")
    cold = users.where("is_cold_start = 1").select("userId")
    habits = (
        ratings.join(cold, "userId", "left_semi").groupBy("userId").agg(
            F.mode(F.hour("timestamp"), True).cast("int").alias("preferred_hour"),
            F.mode(F.date_format("timestamp", "EEEE"), True).alias("preferred_day"),
        )
    )
    is_cold = F.col("is_cold_start") == 1
    hour = F.when(is_cold, F.coalesce(F.col("preferred_hour"), F.lit(DEFAULT_HOUR)))
    day = F.when(is_cold, F.coalesce(F.col("preferred_day"), F.lit(DEFAULT_DAY)))
    return users.join(habits, "userId", "left").select(
        "userId", "is_cold_start", "rating_confidence", hour.alias("preferred_hour"),
        day.alias("preferred_day"), F.lit(mean).alias("global_avg_rating"),
    )


def cold_start_movie(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Cold flag, confidence and the rating the genres let expect, per rated item."""
    items, mean = _counts(ratings, "movieId")
    expected = genre_expected_rating(ratings, movies)
    return (
        items.join(expected, "movieId", "left")
        .fillna(DEFAULT_RATING, subset=["genre_expected_rating"])
        .withColumn("global_avg_rating", F.lit(mean))
    )


def cluster_rating_stats(ratings: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """Per member of ``clusters (key, cluster)`` the rating statistics of its cluster.

    Ratings are summed per key first, so the join with the clusters carries one row per key.
    """
    sums = ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"),
        F.sum(F.col("rating") * F.col("rating")).alias("q"),
    )
    n, s, q = F.sum("n"), F.sum("s"), F.sum("q")
    variance = F.when(n > 1, F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1))
    stats = clusters.join(sums, key).groupBy("cluster").agg(
        (s / n).alias("m"), F.sqrt(variance).alias("d"), n.alias("c")
    )
    return clusters.join(stats, "cluster", "left").select(
        key, "cluster",
        F.coalesce("m", F.lit(DEFAULT_RATING)).alias("cluster_avg_rating"),
        F.coalesce("d", F.lit(0.5)).alias("cluster_rating_std"),
        F.coalesce("c", F.lit(1)).alias("cluster_popularity"),
    )


def baselines(ratings: DataFrame) -> tuple[float, DataFrame, DataFrame]:
    """Global mean, and per user and per item the mean and its bias against the global mean."""
    mean = ratings.agg(F.avg("rating")).first()[0]
    users = ratings.groupBy("userId").agg(F.avg("rating").alias("user_mean")).withColumn(
        "user_bias", F.col("user_mean") - F.lit(mean))
    items = ratings.groupBy("movieId").agg(F.avg("rating").alias("item_mean")).withColumn(
        "item_bias", F.col("item_mean") - F.lit(mean))
    return mean, users, items
