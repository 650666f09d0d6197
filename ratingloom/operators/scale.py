"""Encoding of categories and scaling of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.stats import dense_index, quantiles


def encode_label(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_encoded``: rank of the value among the sorted distinct strings."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    keyed = df.withColumn("_value", text)
    codes = dense_index(keyed, "_value", f"{column}_encoded")
    return keyed.join(codes, "_value").drop("_value")


def encode_onehot(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_onehot``: a sparse 0/1 vector as ``size`` (the distinct non-null values),
    ``indices`` and ``values``, whose index is the value's rank.

    A null has no index set. Categories may be as many as they like: none become columns.
    """
    codes = dense_index(df, column, "_code")
    size = codes.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    hit = F.col("_code").isNotNull()
    empty_i, empty_v = F.array().cast("array<bigint>"), F.array().cast("array<double>")
    return df.join(codes, column, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.struct(
            F.lit(size).cast("long").alias("size"),
            F.when(hit, F.array("_code")).otherwise(empty_i).alias("indices"),
            F.when(hit, F.array(F.lit(1.0))).otherwise(empty_v).alias("values"),
        ).alias(f"{column}_onehot"))


def onehot_columns(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Add one 0/1 column ``<column>_<value>`` for each of the named values."""
    return df.withColumns({
        f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0))
        for v in values
    })


def standard_parameters(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation; a deviation of 0 counts as 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def scale_standard(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population standard deviation."""
    parameters = standard_parameters(df, columns)
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(mean)) / F.lit(std)
        for c, (mean, std) in parameters.items()
    })


def scale_minmax(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    row = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns],
    ).first()
    out = {}
    for c in columns:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        width = float(hi - lo) if lo is not None and hi != lo else 1.0
        out[f"{c}{suffix}"] = (F.col(c) - F.lit(lo)) / F.lit(width)
    return df.withColumns(out)


def scale_robust(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - median) / IQR; 0 when the IQR is 0."""
    got = quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    out = {}
    for c in columns:
        low, median, high = got[(c, 0.25)], got[(c, 0.5)], got[(c, 0.75)]
        if low is None or high - low <= 0:
            out[f"{c}{suffix}"] = F.lit(0.0)
        else:
            out[f"{c}{suffix}"] = (F.col(c) - F.lit(median)) / F.lit(high - low)
    return df.withColumns(out)
