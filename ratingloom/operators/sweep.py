"""Inner products of sparse rows, a block held in memory while the other rows pass by.

Rows are cut into blocks by a hash. A task holds one block, indexed by feature, and other rows go by
in batches: each finds the rows of the block that share a feature and has its products with them added
up at once. What is shuffled are rows, packed, once a block they meet; no product is. The products of a
batch are made in pieces of fixed size, so a task needs memory for one block whatever passes.

Blocks of all pairs meet in a circle: a block meets the next half of the others, so two blocks meet in
one task only and all tasks have the same work.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

#: Entries of a block, and of the longest row that is packed.
BLOCK_ENTRIES, LONGEST = 6_000_000, 1_000_000
#: Products made at a time, and pairs handed on at a time.
PIECE, BATCH = 1_000_000, 200_000
#: Bytes a shuffle takes for a packed entry, besides for a row, and for a product of a join.
ENTRY_BYTES, ROW_BYTES, PRODUCT_BYTES = 12, 40, 22
#: The same with a rating, and for a product or a rater of a request.
RATED_BYTES, RATER_BYTES = 14, 15
#: Raters of requests that a task holds before it hands them on.
LISTED = 6_000_000
#: Fewer products than these, and rows of more entries than these on average, are left to the joins.
FEW, WIDE = 5_000_000, 1000

HELD, OWN, OTHER = range(3)


def block_count(entries: int, cores: int) -> int:
    return max(1, cores, math.ceil(entries / BLOCK_ENTRIES))


def pays(rows: int, entries: int, longest: int, products: float, cores: int, share: float) -> bool:
    """Whether passing rows cost less than a shuffle of the products; ``share`` of the blocks meet a row."""
    copies = 1 + share * block_count(entries, cores)
    return (products >= FEW and longest <= LONGEST and entries <= WIDE * rows
            and copies * (entries * ENTRY_BYTES + rows * ROW_BYTES) < products * PRODUCT_BYTES)


def tasks_by_code(spark: SparkSession, tasks: int) -> list[int]:
    """Numbers whose hash sends them to the tasks 0, 1, ... of ``tasks``."""
    found: dict[int, int] = {}
    first, step = 0, 8 * tasks + 64
    while len(found) < tasks:
        places = spark.range(first, first + step).select(
            "id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(tasks)).alias("at"))
        found = {r["at"]: r["id"] for r in places.groupBy("at").agg(F.min("id").alias("id")).collect()} | found
        first += step
    return [found[i] for i in range(tasks)]


def in_order(spark: SparkSession) -> bool:
    """Whether a union of two tables dealt alike gives a task its rows of the one, then of the other."""
    try:
        return spark.conf.get("spark.sql.unionOutputPartitioning") == "true"
    except PySparkException:  # older Spark
        return False


def packed(entries: DataFrame, ints: bool, blocks: int, labels: DataFrame | None = None) -> DataFrame:
    """``r, f, v, block`` (and ``label``): a row with all its features and values."""
    lists = entries.where("r IS NOT NULL AND f IS NOT NULL").select(
        "r", F.struct(F.col("f").cast("int" if ints else "long").alias("f"), F.col("v").cast("double").alias("v")).alias("e")
    ).groupBy("r").agg(F.collect_list("e").alias("e"))
    if labels is not None:
        lists = lists.join(labels.toDF("r", "label"), "r", "left")
    return lists.select("r", F.col("e.f").alias("f"), F.col("e.v").alias("v"),
                        F.pmod(F.xxhash64("r"), F.lit(blocks)).cast("int").alias("block"),
                        *(["label"] if labels is not None else []))


def _code(codes: list[int], task: Column) -> Column:
    return F.array(*[F.lit(c).cast("int") for c in codes])[task]


def met(rows: DataFrame, blocks: int, around: bool, others: DataFrame | None = None) -> DataFrame:
    """Rows dealt to tasks, those a task holds first; ``around``: a row passes half of the blocks. What
    passes are the rows themselves, or ``others``.

    Each task also holds a row without an id, so that one without a block shows. ``code`` has to
    stay: by it Spark knows that both parts are dealt alike."""
    codes = tasks_by_code(rows.sparkSession, blocks)
    columns = [c for c in rows.columns if c != "block"]
    empty = rows.sparkSession.range(blocks).select(
        F.col("id").cast("int").alias("block"),
        *[(F.array() if isinstance(rows.schema[c].dataType, ArrayType) else F.lit(None))
          .cast(rows.schema[c].dataType).alias(c) for c in columns])
    held = rows.select("block", *columns).union(empty).select(
        F.lit(HELD).alias("kind"), *columns, _code(codes, F.col("block")).alias("code"))
    away = blocks // 2 if around else blocks - 1
    passing = (rows if others is None else others).select("block", F.explode(F.sequence(F.lit(0), F.lit(away))).alias("away"), *columns)
    at = F.pmod(F.col("block") - F.col("away"), F.lit(blocks))
    passing = passing.withColumn("at", at)
    if around and blocks % 2 == 0:
        passing = passing.where((F.col("away") < blocks // 2) | (F.col("away") == 0) | (F.col("at") < blocks // 2))
    passing = passing.select(F.when(F.col("away") == 0, OWN).otherwise(OTHER).alias("kind"), *columns,
                             _code(codes, F.col("at")).alias("code"))
    return held.repartition(blocks, "code").union(passing.repartition(blocks, "code"))


def flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


class Index:
    """Entries by feature: the number of their row."""

    def __init__(self, lists: list[pa.Array]):
        size = np.concatenate([lengths(x) for x in lists])
        features = np.concatenate([flat(x) for x in lists])
        self.order = np.argsort(features, kind="stable")
        features = features[self.order]
        self.rows = np.repeat(np.arange(len(size), dtype=np.int32), size)[self.order]
        begins = np.flatnonzero(np.r_[True, features[1:] != features[:-1]][:len(features)])
        self.features = features[begins]
        self.first = begins
        self.count = np.diff(np.r_[begins, len(features)])
        self.low, span = (int(self.features[0]), int(self.features[-1] - self.features[0]) + 1) if len(begins) else (0, 1)
        self.table = None
        if span <= 8 * len(begins) + 1024:
            self.table = np.full(span, -1, np.int32)
            self.table[self.features - self.low] = np.arange(len(begins))

    def places(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of the entries of each feature."""
        if not len(self.features):
            return np.zeros(len(features), np.int64), np.zeros(len(features), np.int64)
        if self.table is not None:
            at = features.astype(np.int64) - self.low
            inside = (at >= 0) & (at < len(self.table))
            at = np.where(inside, self.table[np.where(inside, at, 0)], -1)
        else:
            at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
            at = np.where(self.features[at] == features, at, -1)
        return self.first[at], np.where(at >= 0, self.count[at], 0)


class Block(Index):
    """The rows a task holds, by feature."""

    def __init__(self, batches: list[pa.RecordBatch]):
        super().__init__([b.column(2) for b in batches])
        self.ids = np.concatenate([b.column(1).to_numpy() for b in batches])
        self.values = np.concatenate([flat(b.column(3)) for b in batches])[self.order]
        names = batches[0].schema.names
        self.labels = pa.chunked_array([b.column("label") for b in batches]) if "label" in names else None
        if "wanted" in names:
            lists = [b.column("wanted") for b in batches]
            self.wanted, self.contexts = Index(lists), np.concatenate([flat(x) for x in lists])


def summed(key: np.ndarray, dot: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, dot = key[order], dot[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    if n is None:
        return key[begins], np.add.reduceat(dot, begins), np.diff(np.r_[begins, len(key)])
    return key[begins], np.add.reduceat(dot, begins), np.add.reduceat(n[order], begins)


def products(block: Block, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``row, held, dot, n``: places of a passing row and of a held one with common features, the
    product and the number of these; each pair once."""
    size, features, values = lengths(batch.column(2)), flat(batch.column(2)), flat(batch.column(3))
    first, width = block.places(features)
    met_ = np.flatnonzero(width)
    if not len(met_):
        return
    row = np.repeat(np.arange(len(size)), size)[met_]
    first, width, values = first[met_], width[met_], values[met_]
    held = len(block.ids)
    ends = np.cumsum(width)
    left: tuple[np.ndarray, ...] | None = None  # of a row that goes on in the next piece
    start = 0
    while start < len(width):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PIECE, "right")))
        w = width[start:stop]
        which = np.repeat(np.arange(start, stop), w)
        at = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(w) - w, w)
        key, dot, n = summed(row[which] * held + block.rows[at], values[which] * block.values[at], None)
        if left is not None:
            key, dot, n = summed(*(np.concatenate(x) for x in zip(left, (key, dot, n))))
            left = None
        if stop < len(width):
            cut = int(np.searchsorted(key, row[stop] * held))
            left = (key[cut:], dot[cut:], n[cut:]) if cut < len(key) else None
            key, dot, n = key[:cut], dot[:cut], n[:cut]
        if len(key):
            yield key // held, key % held, dot, n
        start = stop


def swept(batches: Iterator[pa.RecordBatch], each: Callable[[Block, pa.RecordBatch, int], Iterator[pa.RecordBatch]],
          last: Callable[[Block], Iterator[pa.RecordBatch]] | None = None) -> Iterator[pa.RecordBatch]:
    """Holds the rows of kind HELD and calls ``each`` for what passes."""
    held: list[pa.RecordBatch] = []
    block = None
    for batch in batches:
        kinds = batch.column(0).to_numpy()
        for kind in np.unique(kinds):
            part = batch if (kinds == kind).all() else batch.filter(pa.array(kinds == kind))
            if kind == HELD:
                if block is not None:
                    raise RuntimeError("rows to hold came after rows that pass")
                held.append(part.filter(part.column(1).is_valid()))
            elif not held:
                raise RuntimeError("rows pass a task that holds none")
            else:
                block = block or Block(held)
                yield from each(block, part, int(kind))
    if last is not None and held:
        yield from last(block or Block(held))


def all_pairs(entries: DataFrame, blocks: int, ints: bool, labels: DataFrame | None = None) -> DataFrame:
    """``a, b, dot, n_common`` with ``a < b`` of all rows that share a feature; with ``labels(r,
    label)`` also ``label_a`` and ``label_b``. Rows and features are not null, values are not null."""
    rows = met(packed(entries, ints, blocks, labels), blocks, around=True)
    names = ["a", "b", "dot", "n_common"] + (["label_a", "label_b"] if labels is not None else [])

    def each(block: Block, batch: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
        ids = batch.column(1).to_numpy()
        for row, held, dot, n in products(block, batch):
            x, y = ids[row], block.ids[held]
            if kind == OWN:
                keep = x < y
                row, held, dot, n, x, y = (c[keep] for c in (row, held, dot, n, x, y))
            turned = x > y
            columns = [pa.array(np.where(turned, y, x)), pa.array(np.where(turned, x, y)), pa.array(dot), pa.array(n, pa.int64())]
            if block.labels is not None:
                one = batch.column(4).take(pa.array(row))
                two = block.labels.take(pa.array(held)).combine_chunks()
                both = pa.concat_arrays([one, two])
                at = np.arange(len(row))
                columns += [both.take(pa.array(at + np.where(turned, len(row), 0))),
                            both.take(pa.array(at + np.where(turned, 0, len(row))))]
            out = pa.RecordBatch.from_arrays(columns, names)
            for i in range(0, len(row), BATCH):
                yield out.slice(i, BATCH)

    kind = f", label_a {rows.schema['label'].dataType.simpleString()}, label_b {rows.schema['label'].dataType.simpleString()}" if labels is not None else ""
    return rows.mapInArrow(lambda batches: swept(batches, each), "a long, b long, dot double, n_common long" + kind)


def pairs_to(entries: DataFrame, wanted: DataFrame, blocks: int, ints: bool) -> DataFrame:
    """``a, b, dot, n_common`` of the rows ``a`` in ``wanted(r)`` and all others with a common feature."""
    every = packed(entries, ints, blocks)

    def each(block: Block, batch: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
        ids = batch.column(1).to_numpy()
        for row, held, dot, n in products(block, batch):
            a, b = block.ids[held], ids[row]
            keep = a != b
            out = pa.RecordBatch.from_arrays(
                [pa.array(a[keep]), pa.array(b[keep]), pa.array(dot[keep]), pa.array(n[keep], pa.int64())],
                ["a", "b", "dot", "n_common"])
            for i in range(0, out.num_rows, BATCH):
                yield out.slice(i, BATCH)

    return met(every.join(wanted, "r", "left_semi"), blocks, False, every).mapInArrow(
        lambda batches: swept(batches, each), "a long, b long, dot double, n_common long")


def best_rows(entries: DataFrame, k: int, blocks: int, ints: bool) -> DataFrame:
    """``a, b, dot, n_common``: for every ``a`` its ``k`` partners of the largest product, rounded to
    nine digits, the smaller ones of equal products first."""
    rows = met(packed(entries, ints, blocks), blocks, around=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)]
        new: list[tuple[np.ndarray, ...]] = []
        least = None

        def prune() -> None:
            nonlocal best, new, least
            at, b, dot, n = (np.concatenate(x) for x in zip(best, *new))
            order = np.lexsort((b, -np.round(dot, 9), at))
            at, b, dot, n = at[order], b[order], dot[order], n[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            keep = place < k
            full = place == k - 1
            least[at[full]] = np.round(dot[full], 9)
            best, new = [at[keep], b[keep], dot[keep], n[keep]], []

        def each(block: Block, batch: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
            nonlocal least
            if least is None:
                least = np.full(len(block.ids), -np.inf)
            ids = batch.column(1).to_numpy()
            for row, held, dot, n in products(block, batch):
                keep = np.round(dot, 9) >= least[held]
                if kind == OWN:
                    keep &= ids[row] != block.ids[held]
                new.append((held[keep], ids[row[keep]], dot[keep], n[keep]))
                if sum(len(x[0]) for x in new) > max(4 * PIECE, len(best[0])):
                    prune()
            return iter(())

        def last(block: Block) -> Iterator[pa.RecordBatch]:
            if least is None:
                return
            prune()
            at, b, dot, n = best
            out = pa.RecordBatch.from_arrays([pa.array(block.ids[at]), pa.array(b), pa.array(dot), pa.array(n, pa.int64())],
                                             ["a", "b", "dot", "n_common"])
            for i in range(0, len(at), BATCH):
                yield out.slice(i, BATCH)

        yield from swept(batches, each, last)

    return rows.mapInArrow(run, "a long, b long, dot double, n_common long")


def rated_pays(rows: int, entries: int, longest: int, joined: float, copied: float, cores: int) -> bool:
    """Whether ``best_raters`` shuffles less than ``joined`` rows of products and raters, or ``copied`` entries."""
    return (min(joined, copied) >= FEW and longest <= LONGEST and entries <= WIDE * rows
            and (1 + block_count(entries, cores)) * (entries * RATED_BYTES + rows * ROW_BYTES)
            < min(joined, copied) * RATER_BYTES)


def best_raters(requests: DataFrame, entries: DataFrame, k: int, shrinkage: float, blocks: int, ints: bool) -> DataFrame:
    """``entity, context, neighbor, sim, rating``: for each of ``requests(entity, context)`` with at least its
    ``k`` most similar entities of positive similarity that have an entry in the context.

    Of ``entries(r, f, v, rating, asked)`` the rows asked for are held with their requests. A row that
    passes has its similarity to all of them summed up, and is a rater of the requests for its
    contexts. Lists beyond ``LISTED`` rows are handed on early, so a request may get more than ``k``."""
    kind = "int" if ints else "long"
    lists = entries.where("r IS NOT NULL AND f IS NOT NULL").select("r", "asked", F.struct(
        F.col("f").cast(kind).alias("f"), F.col("v").cast("double").alias("v"),
        F.col("rating").cast("double").alias("rating")).alias("e")).groupBy("r").agg(
            F.collect_list("e").alias("e"), F.max("asked").alias("asked"))
    contexts = requests.select(F.col("entity").alias("r"), F.col("context").try_cast(kind).alias("c")).where(
        "c IS NOT NULL").groupBy("r").agg(F.collect_list("c").alias("wanted"))
    rows = lists.join(contexts, "r", "left")
    none, no_ratings = F.array().cast(f"array<{kind}>"), F.array().cast("array<double>")
    block = F.pmod(F.xxhash64("r"), F.lit(blocks)).cast("int").alias("block")
    held = rows.where("asked AND wanted IS NOT NULL").select(
        "r", F.col("e.f").alias("f"), F.col("e.v").alias("v"), no_ratings.alias("rating"), "wanted", block)
    passing = rows.select("r", F.col("e.f").alias("f"), F.col("e.v").alias("v"), F.col("e.rating").alias("rating"),
                          none.alias("wanted"), block)
    names = ["entity", "context", "neighbor", "sim", "rating"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)]
        new: list[tuple[np.ndarray, ...]] = []

        def prune() -> None:
            nonlocal best, new
            at, b, sim, rating = (np.concatenate(x) for x in zip(best, *new))
            order = np.lexsort((b, -np.round(sim, 9), at))
            at = at[order]
            keep = np.arange(len(at)) - np.searchsorted(at, at) < k
            best, new = [at[keep], *(x[order][keep] for x in (b, sim, rating))], []

        def listed(block: Block) -> Iterator[pa.RecordBatch]:
            nonlocal best
            at, b, sim, rating = best
            place = block.wanted.order[at]
            out = pa.RecordBatch.from_arrays([
                pa.array(block.ids[block.wanted.rows[at]]), pa.array(block.contexts[place].astype(np.int64)), pa.array(b),
                pa.array(sim), pa.array(rating)], names)
            best = [x[:0] for x in best]
            for i in range(0, len(at), BATCH):
                yield out.slice(i, BATCH)

        def each(block: Block, batch: pa.RecordBatch, kind: int) -> Iterator[pa.RecordBatch]:
            ids, size, features = batch.column(1).to_numpy(), lengths(batch.column(2)), flat(batch.column(2))
            ratings, begins = flat(batch.column(4)), np.r_[0, np.cumsum(size)]
            row_of = np.repeat(np.arange(len(size)), size)
            first, width = block.wanted.places(features)
            held = len(block.ids)
            for row, mine, dot, n in products(block, batch):
                sim = dot * (n / (n + shrinkage)) if shrinkage else dot
                near = (sim > 0) & (ids[row] != block.ids[mine])
                row, mine, sim = row[near], mine[near], sim[near]
                if not len(row):
                    continue
                key = row * held + mine
                at = np.arange(begins[row[0]], begins[row[-1] + 1])
                at = at[width[at] > 0]
                ends, start = np.cumsum(width[at]), 0
                while start < len(at):
                    done = ends[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(ends, done + PIECE, "right")))
                    w = width[at[start:stop]]
                    which = np.repeat(at[start:stop], w)
                    request = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(w) - w, w)
                    pair = row_of[which] * held + block.wanted.rows[request]
                    place = np.minimum(np.searchsorted(key, pair), len(key) - 1)
                    hit = key[place] == pair
                    new.append((request[hit], ids[row_of[which[hit]]], sim[place[hit]], ratings[which[hit]]))
                    start = stop
                if sum(len(x[0]) for x in new) > max(4 * PIECE, len(best[0])):
                    prune()
                    if len(best[0]) > LISTED:
                        yield from listed(block)

        def last(block: Block) -> Iterator[pa.RecordBatch]:
            if new:
                prune()
            yield from listed(block)

        yield from swept(batches, each, last)

    return met(held, blocks, False, passing).mapInArrow(
        run, "entity long, context long, neighbor long, sim double, rating double")
