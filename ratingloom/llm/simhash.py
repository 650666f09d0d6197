"""Near-duplicate texts by SimHash fingerprints and BK-trees.

A fingerprint is cut into radius + 1 blocks of bits. Two fingerprints within the radius agree
on at least one block, so every pair that can link meets in a shard named by (block, value).
Each shard has a BK-tree: a node's children are keyed by their Hamming distance to it, and a
search within the radius follows only the edges whose key can hold a match. The trees travel
with their queries to the tasks of the shard; one broadcast of all trees would grow with the
data. Shards that hold more than ``tree_nodes`` fingerprints are cut once more, by blocks of
the bits that are left, on the same argument. A task hands on one edge per fingerprint (to the
smallest one it found connected to it), never a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.graph import components
from ratingloom.llm.text import shingle_hashes, spaced_words, utf8

BITS = 64

#: Pairs of query and tree node looked at together.
FRONTIER = 2_000_000


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of ``hashes``; zero without any."""
    n = len(hashes)
    if not n:
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    if n < 256:
        set_bits = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        set_bits = np.concatenate(
            [np.bincount(octets[:, i], minlength=256) @ table.astype(np.int64) for i in range(8)])
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 4) -> DataFrame:
    """``(id_col, fp long)`` for every row; a text without words, or null, has fingerprint 0."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [majority(shingle_hashes(spaced_words(t), words)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(marks, np.uint64).view(np.int64))], ["id", "fp"])

    return source.mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def block_masks(bits: list[int], parts: int) -> list[int]:
    """``bits`` cut into ``parts`` runs of about equal length, as 64-bit masks."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def shards(fps: DataFrame, radius: int, tree_nodes: int) -> DataFrame:
    """``(key, fp)``: distinct fingerprints under every shard they belong to."""
    masks = block_masks(list(range(BITS)), radius + 1)
    inner = []
    for mask in masks:
        rest = [b for b in range(BITS) if not mask >> b & 1]
        inner.append([mask | m for m in block_masks(rest, radius + 1)])
    fp = F.col("fp")

    def key(numbers: tuple[int, ...], mask: int):
        return F.xxhash64(*map(F.lit, numbers), fp.bitwiseAND(F.lit(signed(mask))))

    routes = fps.select("fp", F.posexplode(F.array(*[key((i,), m) for i, m in enumerate(masks)]))
                        .alias("block", "key"))
    # At most (radius + 1) * 2^13 keys for a radius of 4, whatever the number of rows.
    crowded = (routes.groupBy("key").agg(F.count("*").alias("n"))
               .filter(F.col("n") > tree_nodes).select("key", F.lit(True).alias("crowded")))
    cut = F.array()
    for i, own in enumerate(inner):
        cut = F.when(F.col("block") == i,
                     F.array(*[key((i, j), m) for j, m in enumerate(own)])).otherwise(cut)
    return (routes.join(F.broadcast(crowded), "key", "left")
            .select("fp", F.explode(F.when(F.col("crowded"), cut).otherwise(F.array("key")))
                    .alias("key")))


class Forest:
    """BK-trees of many shards side by side. ``tree`` numbers the tree of each fingerprint."""

    def __init__(self, tree: np.ndarray, fp: np.ndarray):
        self.fp, n = fp, len(fp)
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        self.root = np.repeat(first, np.diff(np.r_[first, n]))
        slots, children = [], []
        at = self.root.copy()
        todo = np.flatnonzero(np.arange(n) != self.root)
        while todo.size:
            distance = np.bitwise_count(fp[todo] ^ fp[at[todo]]).astype(np.int64)
            slot, earliest, place = np.unique(at[todo] * (BITS + 1) + distance,
                                              return_index=True, return_inverse=True)
            child = todo[earliest]
            slots.append(slot)
            children.append(child)
            at[todo] = child[place]
            todo = np.setdiff1d(todo, child, assume_unique=True)
        slot = np.concatenate(slots) if slots else np.empty(0, np.int64)
        order = np.argsort(slot)
        self.slot = slot[order]
        self.child = (np.concatenate(children) if children else slot)[order]

    def links(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, earlier node of its tree) within ``radius``."""
        query, node = queries, self.root[queries]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while query.size:
            distance = np.bitwise_count(self.fp[query] ^ self.fp[node]).astype(np.int64)
            hit = (distance <= radius) & (node < query)
            found.append((query[hit], node[hit]))
            base = node * (BITS + 1)
            low = np.searchsorted(self.slot, base + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.slot, base + np.minimum(distance + radius, BITS), "right")
            fan = high - low
            query = np.repeat(query, fan)
            begin = np.repeat(low - np.r_[0, np.cumsum(fan)[:-1]], fan)
            node = self.child[begin + np.arange(len(begin))]
            earlier = node < query  # children come after their parent
            query, node = query[earlier], node[earlier]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (queries[:0], queries[:0])


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of ``a`` and ``b``; a label is the least index of a class."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, again := new[new]):
            new = again
        if np.array_equal(new, label):
            return label
        label = new


def connect(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, first fingerprint of its class) of whole shards in key order."""
    n = len(fp)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, n])
    forest = Forest(np.repeat(np.arange(len(start)), size), fp)
    label = np.arange(n)
    weight = np.cumsum(np.repeat(size, size))  # nodes that the queries so far may meet
    begin = 0
    while begin < n:
        done = weight[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(weight, done + FRONTIER, "right")))
        label = merge(label, *forest.links(np.arange(begin, end), radius))
        begin = end
    moved = label != np.arange(n)
    return fp[moved], fp[label[moved]]


def links(fps: DataFrame, radius: int = 4, tree_nodes: int = 4096) -> DataFrame:
    """Edges ``(u, v)`` that connect all ``fp`` within ``radius`` bits, over distinct ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if whole:
                yield edges(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield edges(key, fp)

    def edges(key, fp):
        u, v = connect(key, fp, radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return (shards(fps.select("fp"), radius, tree_nodes)
            .select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(run, "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 4, radius: int = 4, tree_nodes: int = 4096) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable over links,
    the own one included. Rows whose text is null or has no words share fingerprint 0. A null
    id takes part and counts as larger than any other; a group of null ids only has a null
    component. Repeated rows come back as often as they are given. An empty table gives an
    empty result.
    """
    marked = stage(fingerprints(docs, id_col, text_col, words))
    known = stage(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    root = components(links(known, radius, tree_nodes))
    rooted = known.join(root, known["fp"] == root["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
