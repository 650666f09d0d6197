"""Cleaning: timestamps, titles, tags, missing values, duplicates, outliers, types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.functions.stats import most_common, quantiles

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC) and f.name not in exclude
    ]


def is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, FLOATING)


def parse_ts(column: Column) -> Column:
    """Timestamp from epoch seconds or a datetime string, whichever the text holds."""
    text = column.cast("string")
    return F.when(
        text.rlike(r"^\s*-?[0-9]+\s*$"), F.timestamp_seconds(text.try_cast("bigint"))
    ).otherwise(F.try_to_timestamp(text))


def as_timestamp(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("timestamp")
    return parse_ts(F.col(column))


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """Parse the time and add ``year``, ``month``, ``hour``, ``day_of_week`` (English name)."""
    ts = as_timestamp(ratings, "timestamp")
    return ratings.withColumn("timestamp", ts).withColumns({
        "year": F.year("timestamp").cast("smallint"),
        "month": F.month("timestamp").cast("tinyint"),
        "hour": F.hour("timestamp").cast("tinyint"),
        "day_of_week": F.date_format("timestamp", "EEEE"),
    })


def clean_movies(movies: DataFrame) -> DataFrame:
    """Release year, title without the year, and the genres as an array."""
    return movies.withColumns({
        "year": F.nullif(F.regexp_extract("title", r"\((\d{4})\)$", 1), F.lit("")).cast("int"),
        "clean_title": F.regexp_replace("title", r"\s*\(\d{4}\)$", ""),
        "genre_list": F.split("genres", r"\|"),
    })


def clean_tags(tags: DataFrame) -> DataFrame:
    """Parse the time, drop missing and blank tags, add the trimmed lower-case tag."""
    return (
        tags.withColumn("timestamp", as_timestamp(tags, "timestamp"))
        .where(F.col("tag").isNotNull())
        .withColumn("tag_clean", F.regexp_replace(F.lower("tag"), r"^\s+|\s+$", ""))
        .where(F.col("tag_clean") != "")
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value: null from here on, in float and double columns."""
    return df.withColumns({
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    })


def handle_missing(df: DataFrame, drop_above: float = 0.5) -> DataFrame:
    """Drop columns with too many nulls; fill numbers with the median, others with the mode.

    One aggregate finds the columns with nulls; only those pay for a median or a mode.
    """
    df = nan_to_null(df)
    missing = [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *missing).first()
    total = row["__rows"]
    gaps = {c: row[c] for c in df.columns if row[c]}
    drop = [c for c, n in gaps.items() if n / total > drop_above]
    numbers = [c for c in numeric_columns(df) if c in gaps and c not in drop]
    others = [c for c in gaps if c not in drop and c not in numbers]
    medians = quantiles(df, {c: [0.5] for c in numbers})
    filled = {}
    for c in df.columns:
        if c in numbers:
            filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(medians[(c, 0.5)]))
        elif c in others:
            mode = most_common(df, c)
            if mode is None and isinstance(df.schema[c].dataType, T.StringType):
                mode = "Unknown"
            filled[c] = F.coalesce(F.col(c), F.lit(mode))
    return df.select(*[
        filled.get(c, F.col(c)).alias(c) for c in df.columns if c not in drop
    ])


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of each ``subset`` group in ``order_by`` order (then all columns).

    The minimum struct is a partial aggregate: copies collapse before the shuffle, so a
    group with very many copies costs one row per task.
    """
    subset = list(subset or df.columns)
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates()
    first = [c for c in (order_by or []) if c in rest]
    ordered = first + [c for c in rest if c not in first]
    return (
        df.groupBy(*subset).agg(F.min(F.struct(*ordered)).alias("_row"))
        .select(*[F.col(c) if c in subset else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per (user, item): the latest, the highest rating on equal times."""
    return (
        ratings.groupBy("userId", "movieId")
        .agg(F.max(F.struct("timestamp", "rating")).alias("_r"))
        .select("userId", "movieId", F.col("_r.rating").alias("rating"),
                F.col("_r.timestamp").alias("timestamp"))
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict:
    got = quantiles(df, {c: [0.25, 0.75] for c in columns})
    bounds = {}
    for c in columns:
        low, high = got[(c, 0.25)], got[(c, 0.75)]
        if low is not None:
            bounds[c] = (low - k * (high - low), high + k * (high - low))
    return bounds


def cap_outliers_iqr(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Clip each column to ``[Q1 - k*IQR, Q3 + k*IQR]``; NaN becomes null."""
    df = nan_to_null(df)
    bounds = iqr_bounds(df, columns, k)
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(),
                  F.least(F.greatest(F.col(c).cast("double"), F.lit(lo)), F.lit(hi)))
        for c, (lo, hi) in bounds.items()
    })


def outlier_report(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column the number of values outside the IQR bounds, and the bounds."""
    df = nan_to_null(df)
    bounds = iqr_bounds(df, columns, k)
    counts = df.agg(*[
        F.sum((~F.col(c).between(lo, hi)).cast("long")).alias(c)
        for c, (lo, hi) in bounds.items()
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(0)).alias("n_outliers"),
                 F.lit(lo).alias("lower_bound"), F.lit(hi).alias("upper_bound"))
        for c, (lo, hi) in bounds.items()
    ])))


#: Integer types from narrow to wide with their limits (fixed values).
INT_RANGES = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647)]
FLOAT_MAX = 3.4028234663852886e38


def narrowest_types(
    df: DataFrame, keep: Sequence[str] = (), strict: bool = True, floats: bool = True
) -> dict[str, str]:
    """Narrowest type per numeric column from its extremes; keys listed in ``keep`` stay."""
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, INTEGRAL) and f.name not in keep]
    reals = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.DoubleType) and f.name not in keep] if floats else []
    if not ints + reals:
        return {}
    bounds = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in ints + reals],
        *[F.max(c).alias(f"hi_{c}") for c in ints + reals],
    ).first()
    types = {}
    for c in ints + reals:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if lo is None:
            continue
        if c in reals:
            if -FLOAT_MAX < lo and hi < FLOAT_MAX:
                types[c] = "float"
            continue
        for name, low, high in INT_RANGES:
            if (low < lo and hi < high) if strict else (low <= lo and hi <= high):
                types[c] = name
                break
    return types


def downcast_types(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cast each numeric column to the narrowest type that strictly holds its range."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in narrowest_types(df, keep).items()})


def sanitize_types(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All-numeric table: arrays dropped, text to numbers, null and infinity to 0, downcast."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            out.append(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            continue
        elif isinstance(f.dataType, T.StringType):
            out.append(finite(c.try_cast("double")).alias(f.name))
        elif isinstance(f.dataType, FLOATING):
            out.append(finite(c.cast("double")).alias(f.name))
        elif isinstance(f.dataType, NUMERIC):
            out.append(F.coalesce(c, F.lit(0)).alias(f.name))
        else:
            out.append(c)
    clean = df.select(*out)
    ints = narrowest_types(clean, keep, strict=False, floats=False)
    reals = {f.name: "float" for f in clean.schema.fields
             if isinstance(f.dataType, T.DoubleType) and f.name not in keep}
    return clean.withColumns({c: F.col(c).cast(t) for c, t in {**ints, **reals}.items()})


def finite(c: Column) -> Column:
    """0 for null, NaN and infinities."""
    bad = c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value: the extremes are equal or missing."""
    if not columns:
        return []
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns],
                 *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    return [c for c in columns if row[f"lo_{c}"] is None or row[f"lo_{c}"] == row[f"hi_{c}"]]


def sanitize_matrix(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric, non-constant columns only; null and infinity become 0."""
    numbers = numeric_columns(df, exclude=keep)
    constant = set(constant_columns(df, numbers))
    kept = [c for c in numbers if c not in constant]
    return df.select(
        *keep,
        *[(finite(F.col(c)) if is_float(df, c) else F.coalesce(F.col(c), F.lit(0))).alias(c)
          for c in kept],
    )


def filter_ratings(
    ratings: DataFrame, min_rating: float | None = None, max_rating: float | None = None,
    users: Sequence[int] | None = None, items: Sequence[int] | None = None,
) -> DataFrame:
    """Ratings within a range and, when given, of some users or items."""
    out = ratings
    if min_rating is not None:
        out = out.where(F.col("rating") >= min_rating)
    if max_rating is not None:
        out = out.where(F.col("rating") <= max_rating)
    if users is not None:
        out = out.where(F.col("userId").isin(list(users)))
    if items is not None:
        out = out.where(F.col("movieId").isin(list(items)))
    return out


def union_chunks(parts: Sequence[DataFrame], subset: Sequence[str] | None = None,
                 order_by: Sequence[str] | None = None) -> DataFrame:
    """Parts put together by column name, then duplicates removed over the whole."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return remove_duplicates(whole, subset, order_by)


def sample_n(df: DataFrame, n: int, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """``n`` rows without replacement: the smallest arithmetic hashes of ``key``."""
    h = F.pmod(F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761), F.lit(4294967296))
    return df.withColumn("_h", h).orderBy("_h", *ties).limit(n).drop("_h")
