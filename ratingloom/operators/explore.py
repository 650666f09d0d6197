"""Summaries, histograms and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.genres import genre_counts as count_genres


def dataset_summary(ratings: DataFrame, movies: DataFrame, tags: DataFrame) -> DataFrame:
    """``table_name, metric, value`` rows for the cleaned tables; values as text."""

    def rows(df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
        wide = df.agg(*[e.cast("string").alias(m) for m, e in metrics.items()])
        return wide.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(m).alias("metric"),
                     F.col(m).alias("value"))
            for m in metrics
        ])))

    day = "yyyy-MM-dd"
    genres = movies.select(F.explode("genre_list").alias("genre")).where("genre <> ''")
    return (
        rows(ratings, "ratings", {
            "total_records": F.count(F.lit(1)),
            "unique_users": F.count_distinct("userId"),
            "unique_movies": F.count_distinct("movieId"),
            "first_date": F.date_format(F.min("timestamp"), day),
            "last_date": F.date_format(F.max("timestamp"), day),
            "min_rating": F.min("rating"), "max_rating": F.max("rating"),
        })
        .unionByName(rows(movies, "movies", {
            "total_movies": F.count(F.lit(1)),
            "first_year": F.min("year"), "last_year": F.max("year"),
        }))
        .unionByName(rows(genres, "movies", {"unique_genres": F.count_distinct("genre")}))
        .unionByName(rows(tags, "tags", {
            "total_tags": F.count(F.lit(1)),
            "unique_tags": F.count_distinct("tag_clean"),
            "unique_users_with_tags": F.count_distinct("userId"),
        }))
    )


def rating_describe(ratings: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the ratings.

    A rating scale has few distinct values: they are counted first, and everything
    else comes from that small table.
    """
    r, n = F.col("rating"), F.col("c")
    total, s, q = F.sum(n), F.sum(r * n), F.sum(r * r * n)
    counts = ratings.where(r.isNotNull()).groupBy("rating").agg(F.count(F.lit(1)).alias("c"))
    quartiles = F.percentile(r, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    return counts.agg(
        total.alias("n"), (s / total).alias("mean"),
        F.sqrt(F.when(total > 1, (q - s * s / total) / (total - 1))).alias("std"),
        F.min(r).alias("min"), quartiles.alias("_q"), F.max(r).alias("max"),
    ).select(
        "n", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
        F.col("_q")[2].alias("q75"), "max",
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bin, n`` over equal widths between the extremes; the last bin is closed."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).alias("n")).limit(0)
    if low == high:  # a single value sits in the middle of a unit range
        low, high = low - 0.5, high + 0.5
    place = F.floor((F.col(column) - F.lit(low)) * bins / F.lit(high - low)).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(
        F.least(place, F.lit(bins - 1)).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Histograms of the ratings (20 bins) and of ratings per user and per item (50 bins)."""
    parts = [histogram(ratings, "rating", 20).withColumn("what", F.lit("rating"))]
    for key in ("userId", "movieId"):
        counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
        parts.append(histogram(counts, "c", 50).withColumn("what", F.lit(f"per_{key}")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def genre_frequency(movies: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent genres."""
    return count_genres(movies).orderBy(F.desc("n"), "genre").limit(k)


def time_trends(ratings: DataFrame) -> DataFrame:
    """``unit, bucket, n, mean_rating`` by year, month and hour from one pass over the facts."""
    units = {"year": F.year, "month": F.month, "hour": F.hour}
    fine = ratings.groupBy(*[f("timestamp").alias(u) for u, f in units.items()]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")
    )
    long = fine.select("n", "s", F.inline(F.array(*[
        F.struct(F.lit(u).alias("unit"), F.col(u).alias("bucket")) for u in units
    ])))
    return long.groupBy("unit", "bucket").agg(
        F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean_rating")
    )
