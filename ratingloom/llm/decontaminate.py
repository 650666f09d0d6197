"""Benchmark passages in documents, by a distributed positional inverted index.

The index is divided by documents: a segment is a run of documents of one task with the posting
lists (term -> positions in the segment) of all terms that the benchmark has. Segments are
written to the shared folder; nothing is shuffled, so a frequent word or passage is no hot key.
A query window starts from the postings of its rarest term over the whole corpus, shifts them
by the term's offset and keeps the places at which the lists of the next rarer terms, shifted
by theirs, have a posting too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.text import alnum_words, utf8

#: Words of a segment at which it is closed; a longer document is a segment of its own.
SEGMENT_WORDS = 1_000_000

#: Words of benchmark items searched for in one pass over the index. Larger benchmarks take
#: several passes, each with an index of its own terms.
BLOCK_WORDS = 2_000_000

SEGMENT = ("row array<long>, id array<{id}>, start array<long>, size array<int>, term array<int>,"
           " first array<int>, position array<int>")
NAMES = ["row", "id", "start", "size", "term", "first", "position"]
MATCH = "row long, first int, last int, item string"


@dataclass
class Windows:
    """Distinct windows of a block of items: terms, and the items they come from."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]  # by window
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str | None, bytes]], width: int) -> "Windows":
        vocabulary: dict[bytes, int] = {}
        found: dict[bytes, tuple[np.ndarray, set]] = {}
        for item, text in items:
            words = alnum_words(text)
            if not words:
                continue
            ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32)
            for i in range(max(1, len(ids) - width + 1)):
                window = ids[i:i + width]
                found.setdefault(window.tobytes(), (window, set()))[1].add(item)
        return cls(vocabulary, [w for w, _ in found.values()],
                   [sorted(x for x in s if x is not None) for _, s in found.values()])


def build_index(docs: DataFrame, vocabulary) -> DataFrame:
    """Segments of ``docs(row, id, text)``; ``vocabulary`` is a broadcast dict of terms worth a list.

    A segment holds the ids of its rows: row numbers follow from the splits of a scan, which may
    be others when the table is read again, so nothing is looked up by them but in the index.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        rows, ids, parts, total = [], [], [], 0
        for batch in batches:
            id_type = batch.schema.field(1).type
            for row, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      utf8(batch.column(2))):
                words = alnum_words(text)
                if rows and total + len(words) > SEGMENT_WORDS:
                    yield segment(rows, ids, id_type, parts)
                    rows, ids, parts, total = [], [], [], 0
                rows.append(row)
                ids.append(key)
                parts.append(np.fromiter((known.get(w, -1) for w in words), np.int32, len(words)))
                total += len(words)
        if rows:
            yield segment(rows, ids, id_type, parts)

    def segment(rows, ids, id_type, parts):
        size = np.array([len(p) for p in parts], np.int32)
        start = np.cumsum(size + 1, dtype=np.int64) - size - 1  # one free place between documents
        place = np.concatenate([np.arange(s, s + n) for s, n in zip(start, size)])
        term = np.concatenate(parts)
        kept = term >= 0
        place, term = place[kept], term[kept]
        order = np.argsort(term, kind="stable")
        distinct, first = np.unique(term[order], return_index=True)
        lists = {"row": np.array(rows, np.int64), "start": start, "size": size,
                 "term": distinct.astype(np.int32),
                 "first": np.r_[first, len(order)].astype(np.int32),
                 "position": place[order].astype(np.int32)}
        columns = {k: pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for k, v in lists.items()}
        columns["id"] = pa.array([ids], pa.list_(id_type))
        return pa.RecordBatch.from_pydict({k: columns[k] for k in NAMES})

    return docs.select("row", "id", "text").mapInArrow(run, SEGMENT.format(id=kind))


def frequencies(index: DataFrame) -> dict[int, int]:
    """Postings of each term in the whole index; at most one row per term of the block."""
    size = F.transform(F.sequence(F.lit(0), F.size("term") - 1),
                       lambda i: F.struct(F.get("term", i).alias("term"),
                                          (F.get("first", i + 1) - F.get("first", i)).alias("n")))
    counted = (index.filter(F.size("term") > 0).select(F.inline(size))
               .groupBy("term").agg(F.sum("n").alias("n")))
    return {r["term"]: r["n"] for r in counted.collect()}


def search(segment: dict[str, np.ndarray], windows: list[np.ndarray], order: list[np.ndarray],
           slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of all matches in a segment, within one document each.

    ``order`` has each window's offsets from the rarest term on. With ``slop`` every term may
    stand up to that many places from where an exact match has it.
    """
    terms, first, position = segment["term"], segment["first"], segment["position"]
    if not len(terms):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    here = {int(t): (int(a), int(b)) for t, a, b in zip(terms, first, first[1:])}
    window, begin = [], []
    for k, (ids, offsets) in enumerate(zip(windows, order)):
        rarest = offsets[0]
        if any(int(t) not in here for t in ids):
            continue
        a, b = here[int(ids[rarest])]
        begin.append(position[a:b].astype(np.int64) - rarest)
        window.append(np.full(b - a, k))
    if not window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    window, begin = np.concatenate(window), np.concatenate(begin)
    span = int(position.max()) + 2 * slop + 64
    flat = np.repeat(terms.astype(np.int64), np.diff(first)) * span + position + slop
    last = np.array([len(w) - 1 for w in windows])
    for step in range(1, max(len(w) for w in windows)):
        more = step <= last[window]
        if not more.any():
            break
        w = window[more]
        offset = np.array([order[k][step] if step <= last[k] else 0 for k in range(len(windows))])[w]
        term = np.array([windows[k][order[k][step]] if step <= last[k] else 0
                         for k in range(len(windows))], np.int64)[w]
        want = term * span + np.maximum(begin[more] + offset, -slop - 1) + slop
        low = np.searchsorted(flat, want - slop)
        ok = np.ones(len(window), bool)
        ok[more] = (low < len(flat)) & (flat[np.minimum(low, len(flat) - 1)] <= want + slop)
        window, begin = window[ok], begin[ok]
    start, size = segment["start"], segment["size"].astype(np.int64)
    inside = np.maximum(begin, 0)
    home = np.searchsorted(start, inside, "right") - 1
    room = start[home] + size[home]
    fits = (begin >= start[home]) & (begin + last[window] < room) if not slop else (
        (begin + last[window] - slop < room))
    return window[fits], begin[fits]


def matches(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """``(row, first, last, item)``: word ranges of ``row`` that match a window of ``item``.

    An item of null id has an empty string for its id.
    """
    counts = frequencies(index)
    spark = index.sparkSession
    order = [np.array(sorted(range(len(w)), key=lambda i: (counts.get(int(w[i]), 0), i)))
             for w in windows.terms]
    shared = spark.sparkContext.broadcast((windows.terms, order, windows.items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, ranked, items = shared.value
        last = np.array([len(w) - 1 for w in terms])
        for batch in batches:
            for values in batch.to_pylist():
                segment = {k: np.array(v, np.int64) for k, v in values.items()}
                window, begin = search(segment, terms, ranked, slop)
                home = np.searchsorted(segment["start"], np.maximum(begin, 0), "right") - 1
                base = segment["start"][home]
                low = np.maximum(begin - base - slop, 0)
                high = np.minimum(begin - base + last[window] + slop, segment["size"][home] - 1)
                found: dict[tuple[int, str], list[tuple[int, int]]] = {}
                for k, row, a, b in zip(window.tolist(), segment["row"][home].tolist(),
                                        low.tolist(), high.tolist()):
                    for item in items[k] or [""]:
                        found.setdefault((row, item), []).append((a, b))
                out = [(row, a, b, item) for (row, item), spans in found.items()
                       for a, b in joined(spans)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(
                        zip(*out) if out else [()] * 4,
                        (pa.int64(), pa.int32(), pa.int32(), pa.string()))],
                    ["row", "first", "last", "item"])

    return index.drop("id").mapInArrow(run, MATCH)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges as ranges apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> list:
    """Functions that each fetch a block of items of about ``block_words`` words at most."""
    items = (benchmark.filter(F.col(text_col).isNotNull())
             .select(F.col(item_col).cast("string").alias("item"),
                     F.col(text_col).cast("string").alias("text")))
    octets = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(octets // (4 * block_words)) + 1

    def fetch(i: int):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        return [(r["item"], r["text"].encode()) for r in part.distinct().collect()]

    return [lambda i=i: fetch(i) for i in range(n)]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = 13, slop: int = 0,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, n_hit, n_items, items_sha256``.

    Windows are ``width`` consecutive words of an item, a shorter item is one window. ``n_hit``
    counts the words inside any match, ``n_items`` the items with one; the digest is that of
    their ids, sorted as strings and comma-joined. Null or wordless texts of documents and of
    items match nothing. An item without id hits words but is not among the items; repeated
    items count once. Rows of equal id are judged each on its own; an empty table gives an
    empty result.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         F.col(text_col).cast("string").alias("text"))
    parts = blocks(benchmark, item_col, item_text_col, block_words)
    if len(parts) > 1:
        source = stage(source)  # the same row numbers in every pass
    sizes, found = None, None
    for part in parts:
        windows = Windows.of(part(), width)
        vocabulary = docs.sparkSession.sparkContext.broadcast(windows.vocabulary)
        index = stage(build_index(source, vocabulary))
        if sizes is None:
            sizes = index.select(F.inline(F.arrays_zip("row", "id", "size")))
        hits = matches(index, windows, slop)
        found = hits if found is None else found.union(hits)
    hit = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("spans", start, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["last"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"] - 1)))
        .cast("long").alias("n")), lambda acc: acc["n"])
    items = F.filter("items", lambda x: x != "")
    hit = hit.select("row", covered.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                     F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"))
    return (sizes.join(hit, "row", "left").select(
        F.col("id").alias(id_col), F.col("size").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256")))
