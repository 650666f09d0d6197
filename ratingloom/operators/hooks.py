"""User functions on pandas batches, for what the built-in functions cannot say."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import HOT_ROWS

#: Rows whose groups one task summarises.
TASK_ROWS = 100_000
#: Most tasks the groups are dealt to.
MAX_TASKS = 20_000


def apply_in_chunks(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
                    ) -> DataFrame:
    """``fn`` over Arrow batches of every partition; the results are put together."""

    def batches(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield fn(chunk)

    return df.mapInPandas(batches, schema)


def apply_per_group(
    df: DataFrame, key: str, key_type: str,
    partial: Callable[[pd.DataFrame], Mapping], merge: Callable[[pd.DataFrame], Mapping],
    fields: str,
) -> DataFrame:
    """One row per group from a user function, in two steps so no group is one task's load.

    ``partial`` summarises a group's rows inside one Arrow batch, ``merge`` combines
    summaries and must be associative. Rows are dealt by key and sorted, so that a group is
    summarised once and not once for each batch that has a row of it; groups of more than
    ``HOT_ROWS`` rows are dealt to several tasks. Their summaries are shuffled by key, sorted,
    and merged as they stream past.
    """
    schema = f"{key} {key_type}, {fields}"
    names = [key, *[f.strip().split()[0] for f in fields.split(",")]]

    def rows(groups: Mapping) -> pd.DataFrame:
        return pd.DataFrame([{key: k, **v} for k, v in groups.items()], columns=names)

    def add(groups: dict, k, summary: Mapping) -> None:
        held = groups.get(k)
        groups[k] = summary if held is None else merge(pd.DataFrame([held, summary]))

    def streamed(summary: Callable[[pd.DataFrame], Mapping]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict = {}
            for batch in batches:
                done: dict = {}
                for k, group in batch.groupby(key, sort=True):
                    if k not in held:
                        done.update(held)
                        held = {}
                    add(held, k, summary(group))
                if done:
                    yield rows(done)
            if held:
                yield rows(held)

        return run

    df = df.where(F.col(key).isNotNull())
    sizes = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(2 * cores, math.ceil(total / TASK_ROWS)), MAX_TASKS)
    hot = sizes.where(F.col("_n") > HOT_ROWS)
    part = F.floor(F.rand() * F.coalesce(F.ceil(F.col("_n") / HOT_ROWS), F.lit(1)))
    dealt = (df.join(hot, key, "left").withColumn("_part", part).repartition(tasks, key, "_part")
             .sortWithinPartitions(key).select(*df.columns))
    summaries = dealt.mapInPandas(streamed(partial), schema)
    merged = streamed(lambda group: merge(group.drop(columns=key)))
    return summaries.repartition(tasks, key).sortWithinPartitions(key).mapInPandas(merged, schema)
