"""Joins of ratings with feature tables, and the user x item matrix in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.functions.stats import dense_index
from ratingloom.operators.clean import numeric_columns


def rating_stats(ratings: DataFrame, key: str) -> DataFrame:
    """``key, rating_count, rating_mean``: the smallest feature table."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("rating_mean")
    )


def suffixed(df: DataFrame, names: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in names})


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_suffix: str,
                 right_suffix: str, how: str = "left") -> DataFrame:
    """Equi-join on ``key``; columns both sides have get a suffix on each side."""
    both = [c for c in left.columns if c in right.columns and c != key]
    return suffixed(left, both, left_suffix).join(suffixed(right, both, right_suffix), key, how)


def feature_matrix(ratings: DataFrame, user_features: DataFrame, movie_features: DataFrame
                   ) -> DataFrame:
    """Ratings with user and item features; clashing names get ``_x`` and ``_y``.

    Left equi-joins: one rating stays one row. Spark broadcasts a feature table
    when its size allows and splits skewed keys of the rating side otherwise.
    """
    with_user = ratings.join(user_features, "userId", "left")
    return overlap_join(with_user, movie_features, "movieId", "_x", "_y")


def with_label(df: DataFrame, task: str) -> DataFrame:
    """``label``: the rating for regression, ``rating >= 4`` as 0/1 for classification."""
    label = F.col("rating") if task == "regression" else (F.col("rating") >= 4.0).cast("int")
    return df.withColumn("label", label)


def feature_matrix_suffixed(ratings: DataFrame, user_features: DataFrame,
                            movie_features: DataFrame, task: str) -> DataFrame:
    """Keys, label and numeric features as floats, named ``_user`` and ``_movie``; null to 0."""
    users = numeric_columns(user_features, exclude=["userId"])
    movies = numeric_columns(movie_features, exclude=["movieId"])
    joined = (
        with_label(ratings.select("userId", "movieId", "rating"), task)
        .join(suffixed(user_features.select("userId", *users), users, "_user"), "userId", "left")
        .join(suffixed(movie_features.select("movieId", *movies), movies, "_movie"),
              "movieId", "left")
    )
    names = [f"{c}_user" for c in users] + [f"{c}_movie" for c in movies]
    return joined.select(
        "userId", "movieId", "label",
        *[F.coalesce(F.col(c).cast("float"), F.lit(0).cast("float")).alias(c) for c in names],
    )


def interaction_pairwise(matrix: DataFrame) -> DataFrame:
    """Products and ratios of the user's and the item's mean and count."""
    columns = {}
    for i, name in enumerate(["rating_mean", "rating_count"]):
        u, m = F.col(f"{name}_x"), F.col(f"{name}_y")
        columns[f"interact_{i}_mult"] = u * m
        columns[f"interact_{i}_ratio"] = u / (m + F.lit(1e-8))
    return matrix.withColumns(columns)


def interaction_features(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``a_x_b`` for every pair, ``a_div_b`` where no ``b`` is zero (one aggregate decides)."""
    pairs = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    if not pairs:
        return df
    divisors = sorted({b for _, b in pairs})
    zeros = df.agg(*[F.sum((F.col(b) == 0).cast("long")).alias(b) for b in divisors]).first()
    columns = {}
    for a, b in pairs:
        columns[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        if not zeros[b]:
            columns[f"{a}_div_{b}"] = F.col(a) / F.col(b)
    return df.withColumns(columns)


def join_item_metadata(stats: DataFrame, movies: DataFrame) -> DataFrame:
    return stats.join(movies, "movieId", "left")


def join_ratings_genres(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """One row per rating and genre of its item; unknown items keep a row with a null genre."""
    genres = movies.select("movieId", F.split("genres", r"\|").alias("_g"))
    return (
        ratings.join(genres, "movieId", "left")
        .withColumn("genre", F.explode_outer("_g")).drop("_g")
    )


def orphan_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings of items the metadata does not know."""
    return ratings.join(movies.select("movieId"), "movieId", "left_anti")


def known_pairs_filter(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows whose user and item both occur in the training rows."""
    return (
        test.join(train.select("userId").distinct(), "userId", "left_semi")
        .join(train.select("movieId").distinct(), "movieId", "left_semi")
    )


def outer_align(blocks: Sequence[DataFrame], key: str, fill: float | None = None) -> DataFrame:
    """Feature blocks side by side, every key of any block kept; numeric nulls filled."""
    whole = blocks[0]
    for block in blocks[1:]:
        whole = whole.join(block, [key], "full")
    if fill is None:
        return whole
    return whole.fillna(fill, subset=numeric_columns(whole, exclude=[key]))


def map_lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, default) -> DataFrame:
    """Value of ``key`` in ``mapping``; ``default`` when it is absent."""
    found = df.join(mapping.select(key, value), key, "left")
    return found.withColumn(value, F.coalesce(F.col(value), default))


def set_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys both tables have."""
    return left.select(key).intersect(right.select(key))


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys ``right`` does not have."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def user_item_matrix(ratings: DataFrame) -> DataFrame:
    """Triplets ``(user_idx, movie_idx, rating)`` with sorted dense indices."""
    users = dense_index(ratings, "userId", "user_idx")
    items = dense_index(ratings, "movieId", "movie_idx")
    return (
        ratings.select("userId", "movieId", "rating")
        .join(users, "userId").join(items, "movieId")
        .select("user_idx", "movie_idx", "userId", "movieId", "rating")
    )


def matrix_report(ratings: DataFrame) -> DataFrame:
    """Shape, stored entries and sparsity of the matrix."""
    return ratings.agg(
        F.count_distinct("userId").alias("n_users"),
        F.count_distinct("movieId").alias("n_items"),
        F.count_distinct("userId", "movieId").alias("nnz"),
    ).withColumn("sparsity", 1 - F.col("nnz") / (F.col("n_users") * F.col("n_items")))


def prepare_supervised(matrix: DataFrame, task: str, fills: Mapping[str, str] | None = None
                       ) -> DataFrame:
    """Keys, label and the feature columns in name order; nulls to 0, text to its fill value."""
    features = sorted(
        c for c in matrix.columns if c not in ("rating", "userId", "movieId", "timestamp")
    )
    fills = fills or {}
    labelled = with_label(matrix, task)
    columns = []
    for c in features:
        if isinstance(matrix.schema[c].dataType, T.StringType):
            columns.append(F.coalesce(F.col(c), F.lit(fills.get(c, "unknown"))).alias(c))
        elif c in numeric_columns(matrix):
            columns.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        else:
            columns.append(F.col(c))
    return labelled.select("userId", "movieId", "label", *columns)


def prepare_clustering(features: DataFrame, key: str) -> DataFrame:
    """Key and numeric feature columns, null to 0."""
    numbers = numeric_columns(features, exclude=[key])
    return features.select(key, *numbers).fillna(0, subset=numbers)
