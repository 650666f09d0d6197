"""Validation reports and automatic repair of feature tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.functions.stats import quantiles
from ratingloom.operators.clean import constant_columns, numeric_columns
from ratingloom.sources.schemas import REQUIRED

CORRELATED = 0.95
MANY_MISSING = 0.3
SKEWED = 2.0


def validate_ratings(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Rows, ratings out of range and duplicates on (user, item, time)."""
    keys = ratings.groupBy("userId", "movieId", "timestamp").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((~F.col("rating").between(low, high)).cast("long")).alias("bad"),
    )
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("out_of_range"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def validate_raw(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``check_name, value`` rows: missing columns, row counts, bad ratings, orphans.

    Checks of a column that is missing are left out.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for name, required in REQUIRED.items():
        missing = [c for c in required if c not in tables[name].columns]
        parts.append(tables[name].agg(
            F.lit(f"{name}_rows").alias("check_name"), F.count(F.lit(1)).alias("value")
        ))
        parts.append(spark.range(1).select(
            F.lit(f"{name}_missing_columns").alias("check_name"),
            F.lit(len(missing)).cast("long").alias("value"),
        ))
    ratings, movies = tables["ratings"], tables["movies"]
    if "rating" in ratings.columns:
        parts.append(ratings.agg(
            F.lit("ratings_out_of_range").alias("check_name"),
            F.coalesce(F.sum((~F.col("rating").between(0.5, 5.0)).cast("long")), F.lit(0))
            .alias("value"),
        ))
    if "movieId" in ratings.columns and "movieId" in movies.columns:
        parts.append(
            ratings.join(movies.select("movieId"), "movieId", "left_anti")
            .agg(F.lit("orphan_ratings").alias("check_name"), F.count(F.lit(1)).alias("value"))
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def sample_skew(c: Column) -> Column:
    """Bias-corrected skewness; null below three values."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def safe_corr(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; null when either is constant."""
    x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
    y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Correlation matrix over the rows where both columns are present; NaN where undefined.

    Each Arrow batch is reduced to d x d sums with numpy and Spark adds them up, so the
    number of pairs costs neither passes nor a plan that grows with it.
    """
    columns = list(columns)
    d = len(columns)
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    means = np.array([row[i] or 0.0 for i in range(d)])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, d, d))
        for batch in batches:
            x = batch.to_numpy(dtype=float, na_value=np.nan) - means
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            sums += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        yield pd.DataFrame({"m": [sums.ravel()]})

    rows = (
        df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        .mapInPandas(partial, "m array<double>")
        .select(F.posexplode("m").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v"))
        .collect()
    )
    flat = np.zeros(4 * d * d)
    for r in rows:
        flat[r["pos"]] = r["v"]
    n, s, q, p = flat.reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = q / n - (s / n) ** 2
        # rounding of the mean leaves a constant column this much spread at most
        spread = np.where(spread > 1e-18 * (means ** 2)[:, None], spread, np.nan)
        return (p / n - (s / n) * (s.T / n)) / np.sqrt(spread * spread.T)


def high_correlations(df: DataFrame, columns: Sequence[str]) -> set[tuple[str, str]]:
    """Column pairs, in column order, whose absolute correlation exceeds 0.95."""
    if len(columns) < 2:
        return set()
    matrix = np.abs(correlations(df, columns))
    return {(a, b) for (i, a), (j, b) in combinations(enumerate(columns), 2)
            if matrix[i, j] > CORRELATED}


def validate_features(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row per feature with its statistics and the problems found in it."""
    features = [c for c in df.columns if c != key]
    numbers = numeric_columns(df, exclude=[key] if key else [])
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in numbers],
        *[F.stddev_samp(c).alias(f"s_{c}") for c in numbers],
    ).first() if numbers else None
    pairs = high_correlations(df, numbers)
    found, structs = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(features):
        x = F.col(f"`{c}`")
        number = c in numbers
        found.append(F.sum(x.isNull().cast("long")).alias(f"null{i}"))
        if number:
            mean, std = row[f"m_{c}"], row[f"s_{c}"]
            far = F.abs((x - F.lit(mean)) / F.lit(std)) > 5 if std else F.lit(False)
            found += [
                F.min(x).cast("double").alias(f"min{i}"), F.max(x).cast("double").alias(f"max{i}"),
                F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                sample_skew(x).alias(f"skew{i}"),
                F.coalesce(F.sum(far.cast("long")), F.lit(0)).alias(f"far{i}"),
            ]
        nothing = F.lit(None).cast("double")
        missing = F.col(f"null{i}") / F.col("rows")
        structs.append(F.struct(
            F.lit(c).alias("feature"), F.lit(number).alias("is_numeric"),
            (F.col(f"min{i}") if number else nothing).alias("min_value"),
            (F.col(f"max{i}") if number else nothing).alias("max_value"),
            (F.col(f"mean{i}") if number else nothing).alias("mean_value"),
            (F.col(f"std{i}") if number else nothing).alias("std_value"),
            missing.alias("missing_pct"),
            (missing > MANY_MISSING).alias("many_missing"),
            (F.coalesce(F.col(f"min{i}") == F.col(f"max{i}"), F.lit(False)) if number
             else F.lit(False)).alias("is_constant"),
            (F.col(f"far{i}") > F.col("rows") * 0.01 if number
             else F.lit(False)).alias("extreme_outliers"),
            (F.coalesce(F.abs(F.col(f"skew{i}")) > SKEWED, F.lit(False)) if number
             else F.lit(False)).alias("is_skewed"),
            F.lit(sum(1 for _, b in pairs if b == c)).cast("long").alias("correlated_with"),
        ))
    return df.agg(*found).select(F.inline(F.array(*structs)))


def autofix_features(df: DataFrame, key: str) -> DataFrame:
    """Drop constants and one of each correlated pair, log skewed columns, clip to 1 %..99 %.

    Which columns change depends on the data, so each step is one aggregate over all
    columns. Of a correlated pair the earlier column goes.
    """
    constant = set(constant_columns(df, numeric_columns(df, exclude=[key])))
    fixed = df.drop(*constant)
    dropped = {a for a, _ in high_correlations(fixed, numeric_columns(fixed, exclude=[key]))}
    fixed = fixed.drop(*dropped)
    numbers = numeric_columns(fixed, exclude=[key])
    if not numbers:
        return fixed
    row = fixed.agg(*[sample_skew(F.col(c)).alias(f"k_{c}") for c in numbers],
                    *[F.min(c).alias(f"lo_{c}") for c in numbers]).first()
    skewed = [c for c in numbers
              if row[f"k_{c}"] is not None and abs(row[f"k_{c}"]) > SKEWED and row[f"lo_{c}"] > 0]
    fixed = fixed.select(
        *[c for c in fixed.columns if c not in skewed],
        *[F.log1p(c).alias(f"{c}_log") for c in skewed],
    )
    numbers = numeric_columns(fixed, exclude=[key])
    ends = quantiles(fixed, {c: [0.01, 0.99] for c in numbers})
    return fixed.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(
            F.greatest(F.col(c).cast("double"), F.lit(ends[(c, 0.01)])), F.lit(ends[(c, 0.99)])))
        for c in numbers if ends[(c, 0.01)] is not None
    })


def check_compatibility(users: DataFrame, movies: DataFrame) -> DataFrame:
    """``table_name, problem, columns`` rows for two feature tables; no row when all is well."""
    spark = users.sparkSession
    rows = []
    for name, df in (("users", users), ("movies", movies)):
        if not df.limit(1).count():
            rows.append((name, "empty", ""))
        for problem, kind in (("text", T.StringType), ("list", T.ArrayType)):
            found = [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]
            if found:
                rows.append((name, problem, ",".join(sorted(found))))
    both = sorted(set(users.columns) & set(movies.columns))
    if both:
        rows.append(("both", "overlap", ",".join(both)))
    return spark.createDataFrame(rows, "table_name string, problem string, columns string")


def validate_ml_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Per dataset its size and whether anything makes it unusable or doubtful."""
    parts = []
    for name, df in datasets.items():
        numbers = numeric_columns(df)
        nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in numbers), F.lit(0))
        baskets = "items" in df.columns or "basket_size" in df.columns
        parts.append(df.agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("samples"),
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
            F.coalesce(nulls, F.lit(0)).cast("long").alias("nulls"),
        ).select(
            "dataset", "samples", "n_columns", "nulls",
            F.concat_ws("; ", F.array_compact(F.array(
                F.when(F.lit(not baskets) & (F.col("nulls") > 0), F.lit("contains nulls")),
                F.when(F.col("samples") == 0,
                       F.lit("no transactions" if baskets else "no samples")),
                F.when(F.lit(not df.columns), F.lit("no features")),
            ))).alias("issues"),
            F.concat_ws("; ", F.array_compact(F.array(
                F.when(F.col("samples").between(1 if baskets else 0, 99),
                       F.lit("few transactions" if baskets else "few samples")),
                F.when(F.lit(len(df.columns) > 1000), F.lit("high dimensionality")),
            ))).alias("warnings"),
        ).withColumn("valid", F.col("issues") == ""))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
