"""Exact order statistics and prefix sums that never need all rows in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage

#: Up to this many rows Spark's exact ``percentile`` runs in one aggregate.
SMALL_ROWS = 1_000_000
#: Accuracy of the sketch that brackets a quantile in larger tables.
SKETCH_ACCURACY = 10_000


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    small_rows: int = SMALL_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple[str, float], float | None]:
    """Linear-interpolated exact quantiles, nulls skipped: ``{(column, p): value}``.

    ``df`` is read more than once: pass a scan or a staged table. Small tables use
    ``percentile``. Larger ones take a sketch of bounded size, which brackets each
    wanted rank, and then count the distinct values inside the bracket only. The
    bracket is verified against the exact ranks and widened when it misses.
    """
    columns = list(wanted)
    if not columns:
        return {}
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    rows = {c: counts[f"n{i}"] for i, c in enumerate(columns)}
    out: dict[tuple[str, float], float | None] = {}
    small = [c for c in columns if 0 < rows[c] <= small_rows]
    if small:
        got = df.agg(
            *[
                F.percentile(F.col(f"`{c}`").cast("double"), F.array(*map(F.lit, wanted[c])))
                .alias(f"q{i}")
                for i, c in enumerate(small)
            ]
        ).first()
        for i, c in enumerate(small):
            out.update({(c, p): float(v) for p, v in zip(wanted[c], got[f"q{i}"])})
    for c in columns:
        if rows[c] == 0:
            out.update({(c, p): None for p in wanted[c]})
        elif rows[c] > small_rows:
            values = df.select(F.col(f"`{c}`").cast("double").alias("v")).where("v is not null")
            for p in wanted[c]:
                out[(c, p)] = _bracketed_quantile(values, rows[c], p, accuracy)
    return out


def _bracketed_quantile(values: DataFrame, n: int, p: float, accuracy: int) -> float:
    rank = p * (n - 1)
    low_rank, high_rank = math.floor(rank), math.ceil(rank)
    margin = 2.0 / accuracy
    while True:
        ends = [max(0.0, p - margin), min(1.0, p + margin)]
        low, high = values.agg(F.percentile_approx("v", ends, accuracy).alias("q")).first()["q"]
        if ends[0] == 0.0:
            low = -math.inf
        if ends[1] == 1.0:
            high = math.inf
        inside = F.col("v").between(low, high)
        below, within = values.agg(
            F.coalesce(F.sum((F.col("v") < low).cast("long")), F.lit(0)),
            F.coalesce(F.sum(inside.cast("long")), F.lit(0)),
        ).first()
        if below <= low_rank and high_rank < below + within:
            break
        margin *= 4
    # The bracket holds about 4/accuracy of the values, which grows with the table: the running
    # count over them is range-partitioned.
    distinct = values.where(inside).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    found = (
        running_totals(distinct, [F.col("v").asc()], {"upto": F.col("c")})
        .withColumn("upto", F.col("upto") + F.lit(below))
        .agg(
            F.min(F.when(F.col("upto") > low_rank, F.col("v"))).alias("a"),
            F.min(F.when(F.col("upto") > high_rank, F.col("v"))).alias("b"),
        )
        .first()
    )
    return float(found["a"] + (found["b"] - found["a"]) * (rank - low_rank))


def most_common(df: DataFrame, column: str):
    """Most frequent non-null value, the smallest on a tie; ``None`` when there is none."""
    first = (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), F.asc(column))
        .limit(1)
        .collect()
    )
    return first[0][column] if first else None


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Global inclusive prefix sums in ``order_by`` order.

    The rows are range-partitioned, so a partition is a run of the global order.
    Totals per partition (one row each) give every run its offset, and the sums
    inside a run are a window over that run. Rows with equal keys share a run:
    aggregate to distinct keys first.
    """
    runs = stage(
        df.repartitionByRange(*order_by).withColumn("_run", F.spark_partition_id())
    )
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        runs.groupBy("_run").agg(*[F.sum(e).alias(f"_t_{n}") for n, e in totals.items()])
        .select(
            "_run",
            *[
                F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}")
                for n in totals
            ],
        )
    )
    inside = (
        Window.partitionBy("_run").orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        runs.join(offsets, "_run")
        .select(
            *[F.col(c) for c in df.columns],
            *[(F.sum(e).over(inside) + F.col(f"_o_{n}")).alias(n) for n, e in totals.items()],
        )
    )


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """``(column, out)``: 0-based position of each distinct non-null value in sorted order."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return running_totals(distinct, [F.col(column).asc()], {out: F.lit(1)}).withColumn(
        out, F.col(out).cast("long") - 1
    )


#: Keys with more rows than this are cut into ranges instead of sorted as a whole.
HOT_ROWS = 1_000_000


def running_by_key(
    df: DataFrame, key: str, ts: str, ties: Sequence[str], totals: Mapping[str, Column],
    ends: Mapping[str, Column] | None = None, peers: bool = False, hot_rows: int | None = None,
) -> DataFrame:
    """Add running sums per key in time order, and sums over the whole key (``ends``).

    The order is ``ts`` then ``ties``; with ``peers`` rows of equal time count together and
    ``ties`` must be empty. Keys of ordinary size take one window. Keys with more than
    ``hot_rows`` rows are range-partitioned in the same order: the offsets are a window over
    the sums per (key, range) and rows are only sorted within their range, so one key with a
    large share of the table is still spread over many tasks, whatever its times. Rows equal
    in the whole order share a range: with ``peers`` sum them per time first.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    ends = ends or {}
    first, now = Window.unboundedPreceding, Window.currentRow

    def frame(*partition: str) -> Window:
        ordered = Window.partitionBy(*partition).orderBy(ts, *ties)
        return ordered.rangeBetween(first, now) if peers else ordered.rowsBetween(first, now)

    whole_key = Window.partitionBy(key)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select(
            *df.columns, *[F.sum(e).over(frame(key)).alias(n) for n, e in totals.items()],
            *[F.sum(e).over(whole_key).alias(n) for n, e in ends.items()],
        )

    hot = stage(
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        .select(key)
    )
    if hot.isEmpty():
        return plain(df)
    rows = stage(
        df.join(hot, key, "left_semi").repartitionByRange(key, ts, *ties)
        .withColumn("_run", F.spark_partition_id())
    )
    before = whole_key.orderBy("_run").rowsBetween(first, -1)
    offsets = (
        rows.groupBy(key, "_run").agg(
            *[F.sum(e).alias(f"_s_{n}") for n, e in totals.items()],
            *[F.sum(e).alias(f"_e_{n}") for n, e in ends.items()],
        ).select(
            key, "_run",
            *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}")
              for n in totals],
            *[F.sum(f"_e_{n}").over(whole_key).alias(n) for n in ends],
        )
    )
    split = (
        rows.select("*", *[F.sum(e).over(frame(key, "_run")).alias(f"_r_{n}")
                           for n, e in totals.items()])
        .join(offsets, [key, "_run"])
        .select(*df.columns, *[(F.col(f"_r_{n}") + F.col(f"_o_{n}")).alias(n) for n in totals],
                *ends)
    )
    return plain(df.join(hot, key, "left_anti")).unionByName(split)


def ordered_index(
    df: DataFrame, key: str, ts: str, ties: Sequence[str], out: str = "idx",
    total: str = "n_rows", hot_rows: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its key's time order, and the key's row count.

    ``ties`` makes the order total.
    """
    one = F.lit(1)
    return running_by_key(df, key, ts, ties, {out: one}, {total: one}, hot_rows=hot_rows
                          ).withColumn(out, F.col(out) - 1)
