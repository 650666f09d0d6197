"""Per-user and per-item rating statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import quantiles
from ratingloom.functions.times import days_between, whole_days
from ratingloom.operators.genres import flag_name, top_genres
from ratingloom.sources.schemas import NO_GENRES


def _statistics(ratings: DataFrame, key: str, other: str, std) -> DataFrame:
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg("rating").alias("rating_mean"),
        F.coalesce(std("rating"), F.lit(0.0)).alias("rating_std"),
        F.min("rating").alias("rating_min"),
        F.max("rating").alias("rating_max"),
        F.count_distinct(other).alias(f"{other}_nunique"),
        F.min("timestamp").alias("timestamp_min"),
        F.max("timestamp").alias("timestamp_max"),
    )


def above(df: DataFrame, flags: dict[str, tuple[str, float]]) -> DataFrame:
    """0/1 columns ``flag: value > quantile(value, p)`` over a staged table."""
    wanted: dict[str, list[float]] = {}
    for column, p in flags.values():
        wanted.setdefault(column, []).append(p)
    got = quantiles(df, wanted)
    return df.withColumns({
        flag: (F.col(column) > F.lit(got[(column, p)])).cast("int")
        for flag, (column, p) in flags.items()
    })


def user_statistics(ratings: DataFrame) -> DataFrame:
    """The user statistics without the flags that need a quantile of the whole table."""
    span = days_between(F.col("timestamp_min"), F.col("timestamp_max"))
    return (
        _statistics(ratings, "userId", "movieId", F.stddev_samp)
        .withColumn("activity_span_days", span)
        .withColumn("rating_frequency", F.col("rating_count") / (F.col("activity_span_days") + 1))
        .withColumn("rating_range", F.col("rating_max") - F.col("rating_min"))
    )


def user_features(ratings: DataFrame) -> DataFrame:
    """Statistics per user, with the most active and the most varied quarter flagged.

    The facts are read once: the per-user table is staged, and the quantiles and the
    flags are computed from it.
    """
    return above(stage(user_statistics(ratings)), {
        "is_active_user": ("rating_count", 0.75), "is_picky_user": ("rating_std", 0.75),
    })


def movie_features(ratings: DataFrame, movies: DataFrame, as_of_year: int) -> DataFrame:
    """Statistics per rated item with metadata, flags of the ten commonest genres, and age."""
    base = stage(
        _statistics(ratings, "movieId", "userId", F.stddev_samp)
        .join(movies, "movieId", "left")
        .withColumns({
            "genre_count": F.coalesce(F.size("genre_list"), F.lit(0)),
            "movie_age": as_of_year - F.coalesce(F.col("year"), F.lit(as_of_year)),
            "popularity_score": F.col("rating_count") * F.col("rating_mean"),
        })
    )
    names = [g for g in top_genres(base, 10) if g != NO_GENRES]
    flagged = base.withColumns({
        flag_name("is", g): F.coalesce(F.array_contains("genre_list", g).cast("int"), F.lit(0))
        for g in names
    })
    return above(flagged, {
        "is_popular": ("rating_count", 0.8), "is_highly_rated": ("rating_mean", 0.8),
    })


def user_features_fast(ratings: DataFrame) -> DataFrame:
    """Compact user table: population deviation, distinct items, span, activity flags."""
    base = stage(
        _statistics(ratings, "userId", "movieId", F.stddev_pop)
        .withColumnRenamed("movieId_nunique", "movie_diversity")
        .withColumn("time_span_days", (F.unix_timestamp("timestamp_max")
                                       - F.unix_timestamp("timestamp_min")) / F.lit(86400.0))
        .withColumn("rating_range", F.col("rating_max") - F.col("rating_min"))
        .withColumn("rating_frequency", F.col("rating_count") / (F.col("time_span_days") + 1))
        .drop("timestamp_min", "timestamp_max")
    )
    return above(base, {
        "is_active": ("rating_count", 0.75), "is_diverse": ("movie_diversity", 0.75),
    })


def movie_features_fast(ratings: DataFrame, movies: DataFrame, as_of_year: int = 2025
                        ) -> DataFrame:
    """Compact item table with hashed genre flags; nulls become 0."""
    from ratingloom.operators.genres import hash_genres

    stats = ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("rating_mean"),
        F.stddev_pop("rating").alias("rating_std"),
        F.count_distinct("userId").alias("user_diversity"),
    )
    base = stage(
        stats.join(movies.select("movieId", "title", "year"), "movieId", "left")
        .withColumns({
            "popularity_score": F.col("rating_count") * F.col("rating_mean"),
            "is_acclaimed": (F.col("rating_mean") > 4.0).cast("int"),
            "movie_age": as_of_year - F.coalesce(F.col("year"), F.lit(as_of_year)),
        })
    )
    flagged = above(base, {"is_popular": ("rating_count", 0.8)})
    joined = flagged.join(hash_genres(movies), "movieId", "left")
    return joined.fillna(0)


def user_behavior(ratings: DataFrame, genres: DataFrame | None = None) -> DataFrame:
    """How a user rates: level, spread, shares of high and low ratings, pace, genre breadth."""
    out = ratings.groupBy("userId").agg(
        F.avg("rating").alias("avg_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.count(F.lit(1)).alias("total_ratings"),
        F.avg((F.col("rating") >= 4).cast("double")).alias("positive_ratio"),
        F.avg((F.col("rating") <= 2).cast("double")).alias("negative_ratio"),
        F.count_distinct("movieId").alias("unique_movies"),
        whole_days(F.min("timestamp"), F.max("timestamp")).alias("activity_span_days"),
    ).withColumn("ratings_per_day", F.col("total_ratings") / (F.col("activity_span_days") + 1))
    if genres is None:
        return out
    breadth = (
        ratings.select("userId", "movieId").distinct().join(genres, "movieId")
        .select("userId", "genre").distinct()
        .groupBy("userId").agg(F.count(F.lit(1)).alias("genre_diversity"))
    )
    return out.join(breadth, "userId", "left").fillna(0, subset=["genre_diversity"])


def movie_user_prefs(ratings: DataFrame) -> DataFrame:
    """Per item the level, spread and number of its ratings and raters."""
    return ratings.groupBy("movieId").agg(
        F.avg("rating").alias("rating_mean"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.count(F.lit(1)).alias("rating_count"),
        F.count_distinct("userId").alias("userId_nunique"),
    )
