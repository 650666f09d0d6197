"""Genre features of items and users."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.sources.schemas import NO_GENRES

DEFAULT_RATING = 3.5


def flag_name(prefix: str, genre: str) -> str:
    return f"{prefix}_{genre.lower().replace(' ', '_').replace('-', '_')}"


def movie_genres(movies: DataFrame) -> DataFrame:
    """``movieId, genre``, one row per entry of the genre list."""
    return movies.select("movieId", F.explode("genre_list").alias("genre"))


def genre_counts(movies: DataFrame) -> DataFrame:
    return movie_genres(movies).groupBy("genre").agg(F.count(F.lit(1)).alias("n"))


def top_genres(movies: DataFrame, k: int) -> list[str]:
    """The ``k`` most frequent genres; equal counts in name order."""
    return [r["genre"] for r in genre_counts(movies).orderBy(F.desc("n"), "genre").limit(k)
            .collect()]


def genre_names(movies: DataFrame) -> list[str]:
    """All real genres in alphabetical order."""
    return [
        r["genre"] for r in
        movie_genres(movies).where(F.col("genre") != NO_GENRES).select("genre").distinct()
        .orderBy("genre").collect()
    ]


def genre_binary(movies: DataFrame) -> DataFrame:
    """A 0/1 column per genre, the genre count, single/multi flags and the list's diversity."""
    names = [r["genre"] for r in
             movie_genres(movies).select("genre").distinct().orderBy("genre").collect()]
    n = F.coalesce(F.size("genre_list"), F.lit(0))
    return movies.select(
        "movieId",
        *[
            F.coalesce(F.array_contains("genre_list", g).cast("int"), F.lit(0))
            .alias(flag_name("genre", g))
            for g in names
        ],
        n.alias("genre_count"),
        (n == 1).cast("int").alias("is_single_genre"),
        (n > 1).cast("int").alias("is_multi_genre"),
        F.when(n > 0, F.size(F.array_distinct("genre_list")) / n).otherwise(0.0)
        .alias("genre_diversity"),
    )


def combo_counts(movies: DataFrame) -> DataFrame:
    """``first, second, n``: genre pairs in list order (a list is a handful of names)."""
    indexed = F.transform("genre_list", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    pairs = F.flatten(F.transform(
        indexed,
        lambda a: F.transform(
            F.filter(indexed, lambda b: b["i"] > a["i"]),
            lambda b: F.struct(a["g"].alias("first"), b["g"].alias("second")),
        ),
    ))
    return (
        movies.select(F.inline(pairs))
        .groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    )


def genre_combos(movies: DataFrame, k: int = 20) -> DataFrame:
    """A 0/1 column for each of the ``k`` commonest genre pairs."""
    top = combo_counts(movies).orderBy(F.desc("n"), "first", "second").limit(k).collect()
    return movies.select("movieId", *[
        F.coalesce(
            (F.array_contains("genre_list", r["first"])
             & F.array_contains("genre_list", r["second"])).cast("int"), F.lit(0),
        ).alias(f"combo_{r['first']}_{r['second']}".lower())
        for r in top
    ])


def genre_performance(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per genre: mean item mean, total ratings, mean item deviation over its rated items."""
    items = ratings.groupBy("movieId").agg(
        F.avg("rating").alias("m"), F.count(F.lit(1)).alias("n"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("s"),
    )
    return (
        movie_genres(movies).where(F.col("genre") != NO_GENRES).distinct()
        .join(items, "movieId").groupBy("genre").agg(
            F.avg("m").alias("avg_genre_rating"), F.sum("n").alias("genre_popularity"),
            F.avg("s").alias("genre_rating_consistency"),
        )
    )


def genre_scores(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per item the mean of its genres' performance; 0 when no genre has data."""
    metrics = ["avg_genre_rating", "genre_popularity", "genre_rating_consistency"]
    scored = (
        movie_genres(movies).join(genre_performance(ratings, movies), "genre")
        .groupBy("movieId").agg(*[F.avg(m).alias(f"{m}_score") for m in metrics])
    )
    return movies.select("movieId").join(scored, "movieId", "left").fillna(0.0)


def genre_rarity(movies: DataFrame) -> DataFrame:
    """Per item the mean of 1 / (frequency + 1) over its genres."""
    rarity = (
        movie_genres(movies).join(genre_counts(movies), "genre")
        .groupBy("movieId").agg(F.avg(1 / (F.col("n") + 1)).alias("genre_rarity_score"))
    )
    return movies.select("movieId").join(rarity, "movieId", "left").fillna(0.0)


def genre_expected_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per item the mean over its genres of the genre's mean rating; 3.5 without any.

    Ratings are summed per item before they meet the genres, so no rating is multiplied.
    """
    items = ratings.groupBy("movieId").agg(
        F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n")
    )
    real = movie_genres(movies).where(F.col("genre") != NO_GENRES)
    means = (
        real.distinct().join(items, "movieId").groupBy("genre")
        .agg((F.sum("s") / F.sum("n")).alias("genre_mean"))
    )
    expected = (
        real.join(means, "genre").groupBy("movieId")
        .agg(F.avg("genre_mean").alias("genre_expected_rating"))
    )
    return (
        movies.select("movieId").join(expected, "movieId", "left")
        .fillna(DEFAULT_RATING, subset=["genre_expected_rating"])
    )


def user_genre_prefs(ratings: DataFrame, movies: DataFrame,
                     names: Sequence[str] | None = None) -> DataFrame:
    """Per user the mean rating of each of the genres ``names`` (all); 0 where there is none.

    Conditional averages over the rating rows: the genres are never exploded.
    """
    names = genre_names(movies) if names is None else names
    return (
        ratings.join(movies.select("movieId", "genre_list"), "movieId", "left")
        .groupBy("userId").agg(*[
            F.coalesce(
                F.avg(F.when(F.array_contains("genre_list", g), F.col("rating"))), F.lit(0.0)
            ).alias("genre_pref_" + g.lower().replace(" ", "_"))
            for g in names
        ])
    )


# --- hashed genre flags -----------------------------------------------------------------------

#: Constants of the public 32-bit hash (fixed values).
MIX_1, MIX_2, ADD, FINAL_1, FINAL_2 = (
    0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
)
MASK = 0xFFFFFFFF


def murmur3_32(data: bytes, seed: int = 0) -> int:
    """The public MurmurHash3 x86 32-bit value, unsigned."""

    def rotate(x: int, r: int) -> int:
        return ((x << r) | (x >> (32 - r))) & MASK

    def scramble(k: int) -> int:
        return rotate(k * MIX_1 & MASK, 15) * MIX_2 & MASK

    h, whole = seed, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotate(h ^ scramble(int.from_bytes(data[i:i + 4], "little")), 13) * 5 + ADD) & MASK
    h ^= scramble(int.from_bytes(data[whole:], "little")) ^ len(data)
    h = (h ^ (h >> 16)) * FINAL_1 & MASK
    h = (h ^ (h >> 13)) * FINAL_2 & MASK
    return h ^ (h >> 16)


def genre_buckets(movies: DataFrame, n_buckets: int = 50) -> DataFrame:
    """``genre, bucket``: the hash runs once per distinct genre, not per item."""

    @F.pandas_udf("int")
    def bucket(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for names in batches:
            yield names.map(lambda g: murmur3_32(g.encode("utf-8")) % n_buckets)

    return (
        movie_genres(movies).select("genre").distinct()
        .withColumn("bucket", bucket("genre"))
    )


def hash_genres(movies: DataFrame, n_buckets: int = 50) -> DataFrame:
    """Per item ``genre_hash_0..`` flags at the hash buckets of its genres, and how many are set."""
    hashed = movie_genres(movies).join(genre_buckets(movies, n_buckets), "genre")
    flags = hashed.groupBy("movieId").agg(*[
        F.max((F.col("bucket") == b).cast("int")).alias(f"genre_hash_{b}")
        for b in range(n_buckets)
    ])
    names = [f"genre_hash_{b}" for b in range(n_buckets)]
    whole = movies.select("movieId").join(flags, "movieId", "left").fillna(0)
    return whole.withColumn("genre_count", sum((F.col(c) for c in names), F.lit(0)))
