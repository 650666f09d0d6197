"""Inner products of all pairs of sparse rows, as a blocked matrix product or a join on features.

A feature of n rows is worth n copies a block to the blocked product and n (n - 1) / 2 products to
the join. The join takes the features for which that is less: with many rows and few to a feature,
its work grows with the pairs that meet, where the copies grow with the square of the rows. Where
packed rows take less of a shuffle than the products, whole rows meet block by block (``sweep``).

In the blocked product the matrix is cut into blocks of rows and stripes of features. A task multiplies two row
blocks over one stripe in a dense accumulator of fixed size and hands on one number per
pair that meets there, whatever the number of features the pair shares. A feature that
almost every row has is therefore no larger unit of work than any other: its pairs are
spread over all block pairs and never leave a task one by one.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ratingloom.operators import sweep

#: Rows per block: an accumulator has at most BLOCK_ROWS squared entries.
BLOCK_ROWS = 2048
#: Entries per (block, stripe) aimed at.
CELL_ENTRIES = 2_000_000
#: Products expanded at once inside a task.
EXPAND = 2_000_000
#: Most tasks one product is spread over.
MAX_TASKS = 20_000
#: Products of the join that one task adds up.
TASK_PRODUCTS = 1_000_000


def block_plan(rows: int, entries: int, longest: int, parallelism: int) -> tuple[int, int]:
    """Number of row blocks and feature stripes for a matrix of this size.

    Stripes are counted for the block that holds the longest row: a row with a large share
    of all entries is cut into as many pieces as it takes.
    """
    blocks = max(1, math.ceil(rows / BLOCK_ROWS))
    heaviest = longest + entries / blocks
    stripes = max(1, math.ceil(heaviest / CELL_ENTRIES))
    while blocks * (blocks + 1) // 2 * stripes < parallelism and blocks < 64:
        blocks += 1
    return blocks, stripes


def product(left: pd.DataFrame, right: pd.DataFrame) -> tuple:
    """Row ids of both cells, and the inner products and common counts of all their pairs."""
    a_ids, a = np.unique(left["r"].to_numpy(), return_inverse=True)
    b_ids, b = np.unique(right["r"].to_numpy(), return_inverse=True)
    order = np.argsort(right["f"].to_numpy(), kind="stable")
    features = right["f"].to_numpy()[order]
    b, b_values = b[order], right["v"].to_numpy()[order]
    a_features, a_values = left["f"].to_numpy(), left["v"].to_numpy()
    first = np.searchsorted(features, a_features, "left")
    width = np.searchsorted(features, a_features, "right") - first
    size = len(a_ids) * len(b_ids)
    dot, common = np.zeros(size), np.zeros(size, dtype=np.int64)
    ends = np.cumsum(width)
    start = 0
    while start < len(width):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + EXPAND, "right")))
        w = width[start:stop]
        which = np.repeat(np.arange(start, stop), w)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(w) - w, w)
        other = first[which] + offset
        cell = a[which] * len(b_ids) + b[other]
        np.add.at(dot, cell, a_values[which] * b_values[other])
        np.add.at(common, cell, 1)
        start = stop
    shape = (len(a_ids), len(b_ids))
    return a_ids, b_ids, dot.reshape(shape), common.reshape(shape)


def all_pairs(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """``a, b, dot, n_common`` for the pairs that share a feature."""
    a_ids, b_ids, dot, common = product(left, right)
    i, j = np.nonzero(common)
    x, y = a_ids[i], b_ids[j]
    out = pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "dot": dot[i, j],
                        "n_common": common[i, j]})
    return out[x < y] if same else out


def best_pairs(left: pd.DataFrame, right: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    """``a, b, dot, n_common`` in both directions: per row those that can be among its ``k``
    best in this cell, ties kept."""
    a_ids, b_ids, dot, common = product(left, right)
    if same:
        common[np.arange(len(a_ids)), np.arange(len(a_ids))] = 0
    parts = []
    for ids, others, d, c in ((a_ids, b_ids, dot, common), (b_ids, a_ids, dot.T, common.T)):
        score = np.where(c > 0, np.round(d, 9), -np.inf)
        keep = c > 0
        if k < score.shape[1]:
            keep &= score >= -np.partition(-score, k - 1, axis=1)[:, k - 1:k]
        i, j = np.nonzero(keep)
        parts.append(pd.DataFrame({"a": ids[i], "b": others[j], "dot": d[i, j],
                                   "n_common": c[i, j]}))
        if same:
            break
    return pd.concat(parts)


def copies_by_cell(entries: DataFrame, parallelism: int | None, blocks: int | None,
                   stripes: int | None) -> tuple[DataFrame, int]:
    """Entries sent to every block pair of their row block, and the number of stripes."""
    if blocks is None or stripes is None:
        size = entries.groupBy("r").agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.max("n"), F.lit(0)).alias("longest")).first()
        parallelism = parallelism or entries.sparkSession.sparkContext.defaultParallelism
        blocks, stripes = block_plan(size["rows"], size["n"], size["longest"], parallelism)
    placed = entries.select(
        "r", "f", F.col("v").cast("double").alias("v"),
        F.pmod(F.xxhash64("r"), F.lit(blocks)).cast("int").alias("block"),
        F.pmod(F.xxhash64("f", F.lit(1)), F.lit(stripes)).cast("int").alias("stripe"),
    )
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    copies = placed.withColumn("other", other).select(
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "stripe", "block", "r", "f", "v")
    # the work of a cell is in its products, not in its bytes: keep cells apart
    cells = blocks * (blocks + 1) // 2 * stripes
    return copies.repartition(min(cells, MAX_TASKS), "i", "j", "stripe"), stripes


def sizes(entries: DataFrame) -> Row:
    """Rows, entries, longest row, least and largest feature, and whether a value is null."""
    whole = F.col("r").isNotNull() & F.col("f").isNotNull()
    return entries.groupBy("r").agg(
        F.count(F.lit(1)).alias("n"), F.min("f").alias("low"), F.max("f").alias("high"),
        F.max(whole & F.col("v").isNull()).alias("open")).agg(
            F.count("r").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("n").alias("longest"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.max("open").alias("open")).first()


def sweeps(entries: DataFrame, size: Row, products: float, cores: int, share: float) -> bool:
    return (not size["open"] and products <= size["rows"] * (size["rows"] - 1.0) * share
            and sweep.pays(size["rows"], size["n"], size["longest"], products, cores, share)
            and sweep.in_order(entries.sparkSession))


def _short(size: Row) -> bool:
    return -(1 << 31) <= size["low"] and size["high"] < 1 << 31


def gram_pairs(entries: DataFrame, parallelism: int | None = None, blocks: int | None = None,
               stripes: int | None = None, labels: DataFrame | None = None) -> DataFrame:
    """``a, b, dot, n_common`` with ``a < b`` for all rows of ``entries(r, f, v)`` that share
    a feature; ``(r, f)`` must be unique and both long. With ``labels(r, label)``, one for a row, also
    ``label_a`` and ``label_b``.

    Blocks of packed rows meet where that shuffles less than the products of a join. Else the
    features that the join takes cheaper go there, if that saves half of the copies and there
    are fewer products than pairs of rows.
    """
    if blocks is not None or stripes is not None:
        return labelled(blocked_pairs(entries, parallelism, blocks, stripes), labels)
    cores = parallelism or entries.sparkSession.sparkContext.defaultParallelism
    size = sizes(entries)
    planned = block_plan(size["rows"], 0, 0, cores)[0]
    features = entries.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    light = F.col("n") - 1 <= 2 * planned
    products = F.col("n").cast("double") * (F.col("n") - 1) / 2
    cost = features.agg(
        F.coalesce(F.sum(F.when(light, products)), F.lit(0)).alias("products"),
        F.coalesce(F.sum(F.when(F.col("f").isNotNull(), products)), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(~light, F.col("n"))), F.lit(0)).alias("heavy")).first()
    if sweeps(entries, size, cost["all"], cores, 0.5):
        return sweep.all_pairs(entries, sweep.block_count(size["n"], cores), _short(size), labels)
    if cost["products"] + cost["heavy"] > size["rows"] * (size["rows"] - 1) / 2:
        return labelled(blocked_pairs(entries, parallelism), labels)
    if not cost["heavy"]:
        return labelled(joined_pairs(entries, cost["products"], cores), labels)
    if 2 * (cost["products"] + cost["heavy"] * planned) >= size["n"] * planned:
        return labelled(blocked_pairs(entries, parallelism), labels)
    heavy = features.where(~light).select("f")
    parts = (joined_pairs(entries.join(heavy, "f", "left_anti"), cost["products"], cores)
             .unionByName(blocked_pairs(entries.join(heavy, "f", "left_semi"), parallelism)))
    return labelled(parts.groupBy("a", "b").agg(F.sum("dot").alias("dot"), F.sum("n_common").alias("n_common")), labels)


def labelled(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return pairs
    return (pairs.join(labels.toDF("a", "label_a"), "a", "left").join(labels.toDF("b", "label_b"), "b", "left")
            .select(*pairs.columns, "label_a", "label_b"))


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """``a, b, p``: a row for every feature of a row of ``left`` that a row of ``right`` has."""
    return left.select("f", F.col("r").alias("a"), F.col("v").cast("double").alias("w")).join(
        right.select("f", F.col("r").alias("b"), F.col("v").cast("double").alias("v")), "f").select(
            "a", "b", (F.col("w") * F.col("v")).alias("p"))


def joined_pairs(entries: DataFrame, products: float, cores: int) -> DataFrame:
    """``gram_pairs`` by a join on the features, which makes about ``products`` rows.

    They are dealt by blocks of both rows, so sums per row over the pairs shrink within a task."""
    tasks = min(max(cores, math.ceil(products / TASK_PRODUCTS)), MAX_TASKS)
    blocks = math.ceil(math.sqrt(4 * tasks))
    x, y = (F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int") for c in "ab")
    return (_met(entries, entries).where("a < b").repartition(tasks, F.least(x, y), F.greatest(x, y))
            .select(F.least(x, y).alias("i"), F.greatest(x, y).alias("j"), "a", "b", "p")
            .groupBy("i", "j", "a", "b").agg(F.sum("p").alias("dot"), F.count(F.lit(1)).alias("n_common"))
            .drop("i", "j"))


def joined_rows(entries: DataFrame, products: float, cores: int) -> DataFrame:
    """The same in both directions, dealt by ``a`` alone: a row's partners are in one task."""
    tasks = min(max(cores, math.ceil(products / TASK_PRODUCTS)), MAX_TASKS)
    return (_met(entries, entries).where("a <> b").repartition(tasks, "a")
            .groupBy("a", "b").agg(F.sum("p").alias("dot"), F.count(F.lit(1)).alias("n_common")))


def blocked_pairs(entries: DataFrame, parallelism: int | None = None,
                  blocks: int | None = None, stripes: int | None = None) -> DataFrame:
    """``gram_pairs`` by the blocked product alone."""
    copies, stripes = copies_by_cell(entries, parallelism, blocks, stripes)

    def cell(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] == key[1]:
            return all_pairs(rows, rows, True)
        mine = (rows["block"] == key[0]).to_numpy()
        return all_pairs(rows[mine], rows[~mine], False)

    partial = copies.groupBy("i", "j", "stripe").applyInPandas(
        cell, "a long, b long, dot double, n_common long")
    if stripes == 1:
        return partial
    return partial.groupBy("a", "b").agg(
        F.sum("dot").alias("dot"), F.sum("n_common").alias("n_common"))


def gram_best(entries: DataFrame, k: int, parallelism: int | None = None,
              blocks: int | None = None) -> DataFrame:
    """``a, b, dot, n_common`` in both directions with at least the ``k`` largest products of
    every ``a``.

    Features are not striped: a cell's products are final, so it hands on only what can be
    among a row's best, about ``k`` per row and block instead of every pair. A cell holds its
    rows' entries whole; more blocks keep it near ``CELL_ENTRIES`` and a single longer row.
    Where the products of all pairs are fewer than the copies, they come from a join instead, or
    all rows pass a block of them (``sweep``) if that shuffles less.
    """
    if blocks is None:
        size = sizes(entries)
        cores = parallelism or entries.sparkSession.sparkContext.defaultParallelism
        blocks = max(block_plan(size["rows"], 0, 0, cores)[0], math.ceil(size["n"] / CELL_ENTRIES))
        met = entries.groupBy("f").agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.col("n").cast("double") * (F.col("n") - 1)), F.lit(0.0)).alias("products")).first()
        if sweeps(entries, size, met["products"], cores, 1.0):
            return sweep.best_rows(entries, k, sweep.block_count(size["n"], cores), _short(size))
        if met["products"] <= min(2 * size["n"] * blocks, size["rows"] ** 2):
            return joined_rows(entries, met["products"], cores)
    copies, _ = copies_by_cell(entries, parallelism, blocks, 1)

    def cell(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] == key[1]:
            return best_pairs(rows, rows, True, k)
        mine = (rows["block"] == key[0]).to_numpy()
        return best_pairs(rows[mine], rows[~mine], False, k)

    return copies.groupBy("i", "j", "stripe").applyInPandas(
        cell, "a long, b long, dot double, n_common long")
