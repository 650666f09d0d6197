"""Texts whose word shingles have a least Jaccard similarity, without loss of a link.

Two sets of similarity s share one of their first n - ceil(s n) + 1 shingles in any order that all
sets keep to, so a tile holds the sets that have one shingle among their first. Shingles that are
common somewhere come last in that order, which keeps a passage of many texts out of the tiles of
texts that are otherwise unlike. Of tiles with the same sets one is kept.

A tile is cut into bands of set size. Each set has a bitmap signature, as wide as its band asks for:
bit i is the parity of its shingles that hash to i. The bits in which two signatures differ are a
lower bound of the shingles that only one of them has, so they bound the overlap from above. Pairs
of different components that may reach the similarity, by size and by bits, go on: one for each set
of a tile in the first round, which links a group of alike texts, and more in every further one,
until a round has left none out.

Every pair is decided by the intersection of the sorted arrays of shingles. Equal texts are one text
throughout; shingles are 64-bit hashes, and texts are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.graph import components
from ratingloom.llm.text import SEED, spaced_words, utf8
from ratingloom.llm.windows import key_table
from ratingloom.llm.windows import TABLE as KEY_WORDS

#: Buckets that shingles are counted in, and the most that may be called common.
BUCKETS, COMMON = 1 << 22, 1 << 18

#: A task calls a bucket common that holds this many texts, and four times the mean.
COMMON_TEXTS = 8

#: Words and texts remembered in a task.
REMEMBERED = 200_000

#: Bits of a signature: at least, at most.
NARROW, WIDE = 64, 1 << 15

#: Partners a set is given in the first round, and how many times more in each further one.
PARTNERS, MORE = 1, 16


class Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word, SEED)
        return value


def shingle_set(words: list[bytes], size: int, hashes: Hashes) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words, ascending; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    if len(hashes) > REMEMBERED:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    x = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i]
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(x ^ x >> np.uint64(29))


def text_name(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text, SEED) - (1 << 63)


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(42)).astype(np.int64)


def signature(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by their low bits: two for each shingle at least.

    Sets of similarity s and size n differ in about 2 n (1 - s) / (1 + s) shingles; with fewer bits
    too many of these fall together to tell 0.75 from 0.8."""
    bits = NARROW
    while bits < min(2 * len(shingles), WIDE):
        bits *= 2
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Bits in which a signature differs from each of others, the wider ones folded."""
    while others.shape[1] > len(one):
        half = others.shape[1] // 2
        others = others[:, :half] ^ others[:, half:]
    while len(one) > others.shape[1]:
        half = len(one) // 2
        one = one[:half] ^ one[half:]
    return np.bitwise_count(others ^ one).sum(axis=1, dtype=np.int64)


def may_link(n, m, bits, percent: int):
    """Whether sets of ``n`` and ``m`` that differ in at least ``bits`` shingles can be linked."""
    overlap = np.minimum((n + m - bits) // 2, np.minimum(n, m))
    return 100 * overlap >= percent * (n + m - overlap)


def marked(docs: DataFrame, words: int) -> DataFrame:
    """``(id, key, n, bits, bucket)``: a row for every document, without key if it has no words, the
    signature only where a task meets the text first; and a row with ``n`` texts for every ``bucket``
    of shingles that a task finds common."""
    kind, names = docs.schema["id"].dataType.simpleString(), ["id", "key", "n", "bits", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes = Hashes(), {}
        load, some = np.zeros(BUCKETS, np.int32), None
        for batch in batches:
            keys, n, bits, found = [], [], [], []
            for text in utf8(batch.column(1)):
                name, mark = text_name(text) if text else 0, None
                if name not in sizes:
                    if len(sizes) > REMEMBERED:
                        sizes.clear()
                    own = shingle_set(spaced_words(text), words, hashes)
                    sizes[name] = len(own)
                    found.append(bucket_of(own))
                    mark = signature(own) if len(own) else None
                n.append(sizes[name])
                bits.append(mark)
                keys.append(name if n[-1] else None)
            if found:
                np.add.at(load, np.concatenate(found), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(bits, pa.binary()), pa.nulls(len(n), pa.int32())], names)
            some = batch
        if some is not None:
            common = np.flatnonzero(load >= max(COMMON_TEXTS, 4 * load.mean()))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(common), some.column(0).type), pa.nulls(len(common), pa.int64()),
                 pa.array(load[common].astype(np.int64)), pa.nulls(len(common), pa.binary()),
                 pa.array(common.astype(np.int32))], names)

    return docs.mapInArrow(run, f"id {kind}, key long, n long, bits binary, bucket int")


def common_buckets(marks: DataFrame) -> np.ndarray:
    """A flag for each bucket; at most ``COMMON`` are set, the fullest."""
    found = (marks.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "bucket").limit(COMMON).toArrow())
    common = np.zeros(BUCKETS, bool)
    common[found["bucket"].to_numpy()] = True
    return common


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` has in common with any it is linked to, at least."""
    return (percent * n + 99) // 100


def tokens(docs: DataFrame, words: int, percent: int, common: np.ndarray) -> DataFrame:
    """``(token, key)``: the first shingles of every text, rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hashes, seen = np.unpackbits(shared.value).astype(bool), Hashes(), set()
        for batch in batches:
            keys, found = [], []
            for text in utf8(batch.column(0)):
                name = text_name(text) if text else 0
                if name in seen:
                    continue
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.add(name)
                own = shingle_set(spaced_words(text), words, hashes)
                if len(own):
                    late = last[bucket_of(own)]
                    first = len(own) - needed(len(own), percent) + 1
                    own = own[~late][:first] if len(own) - late.sum() >= first else np.concatenate(
                        [own[~late], own[late]])[:first]
                    found.append(own)
                    keys.append(np.full(len(own), name, np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(keys))],
                    ["token", "key"])

    return docs.select("text").mapInArrow(run, "token long, key long")


def tiles(found: DataFrame) -> DataFrame:
    """``(token, key)``: tokens of more than one text, each text once; one token for equal tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, key, written = np.empty(0, np.int64), np.empty(0, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last row so far is looked at again, with its neighbour.
            token = np.concatenate([token, batch.column(0).to_numpy()])
            key = np.concatenate([key, batch.column(1).to_numpy()])
            new = np.r_[True, (token[1:] != token[:-1]) | (key[1:] != key[:-1])]
            token, key = token[new], key[new]
            same = token[1:] == token[:-1]
            several = np.r_[False, same] | np.r_[same, False]
            out = several & ~np.r_[written, np.zeros(len(same), bool)]
            yield pa.RecordBatch.from_arrays([pa.array(token[out]), pa.array(key[out])], ["token", "key"])
            written = bool(several[-1]) or len(token) == 1 and written
            token, key = token[-1:], key[-1:]

    shared = stage(found.repartition("token").sortWithinPartitions("token", "key")
                   .mapInArrow(run, "token long, key long"))
    alike = shared.groupBy("token").agg(F.bit_xor(F.xxhash64("key")).alias("x"), F.count("*").alias("n"),
                                        F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y"))
    first = alike.groupBy("x", "y", "n").agg(F.min("token").alias("token")).select("token")
    return shared.join(first, "token", "left_semi")


def members(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """``(key, shingles)`` of the texts whose key is in ``wanted``, each once, the shingles ascending.

    A table of bits keeps most others from being cut into words; the join is what decides."""
    shared = docs.sparkSession.sparkContext.broadcast(key_table(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes, seen = shared.value, Hashes(), set()
        for batch in batches:
            keys, sets = [], []
            for text in utf8(batch.column(0)):
                if not text or (name := text_name(text)) in seen:
                    continue
                if int(table[name >> 6 & KEY_WORDS - 1]) >> (name & 63) & 1:
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(name)
                    keys.append(name)
                    sets.append(shingle_set(spaced_words(text), words, hashes))
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat))], ["key", "shingles"])

    return (docs.select("text").mapInArrow(run, "key long, shingles array<long>")
            .join(wanted, "key", "left_semi").dropDuplicates(["key"]))


def proposed(crowded: DataFrame, percent: int, partners: int) -> DataFrame:
    """``(a, b)``: pairs of different roots in a tile that size and bits allow, at most ``partners``
    for the larger set of a pair; and ``(token, null)`` of the tiles where a set may have further ones."""

    def pairs(n, key, root, bits) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        widths = np.array([len(b) for b in bits])
        edges = np.flatnonzero(np.r_[True, widths[1:] != widths[:-1], True])
        bands = [(i, j, np.frombuffer(b"".join(bits[i:j]), np.uint8).reshape(j - i, -1))
                 for i, j in zip(edges, edges[1:])]
        left = np.full(len(n), partners)
        for y in range(len(n) - 1):
            high = int(np.searchsorted(n, n[y] * 100 // percent, "right"))
            x = np.arange(y + 1, high)
            x = x[(root[x] != root[y]) & (left[x] > 0)]
            if not len(x):
                continue
            own = np.frombuffer(bits[y], np.uint8)
            for i, j, table in bands:
                band = x[(x >= i) & (x < j)]
                if len(band):
                    hit = band[may_link(n[band], n[y], differing(own, table[band - i]), percent)]
                    if len(hit):
                        left[hit] -= 1
                        yield int(key[y]), key[hit], left[hit] == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        seen: set[tuple[int, int]] = set()

        def tile(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            cut = False
            columns = [rows[c].to_numpy() for c in ("n", "key", "root")]
            new: list[tuple[int | None, int | None]] = []
            for one, others, more in pairs(*columns, rows["bits"].to_pylist()):
                for other in others.tolist():
                    pair = (one, other) if one < other else (other, one)
                    if pair not in seen:
                        seen.add(pair)
                        new.append(pair)
                cut = cut or bool(more.any())
            if cut:
                new.append((rows["token"][0].as_py(), None))
            if len(seen) > REMEMBERED:
                seen.clear()
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*new)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            cuts = np.flatnonzero(token[1:] != token[:-1]) + 1
            if held and held[-1].column(0)[0].as_py() != token[0]:
                yield from tile(pa.Table.from_batches(held))
                held = []
            for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(token)]):
                held.append(batch.slice(i, j - i))
                if j < len(token):
                    yield from tile(pa.Table.from_batches(held))
                    held = []
        if held:
            yield from tile(pa.Table.from_batches(held))

    return (crowded.select("token", "n", "key", "root", "bits").repartition("token")
            .sortWithinPartitions("token", "n", "key").mapInArrow(run, "a long, b long"))


def linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``(a, b)`` that are linked, by the intersection of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                one, other = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(other) - both):
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64())).select(["a", "b"])

    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    sets = stage(members(docs, words, wanted))
    for side in "ab":
        pairs = pairs.join(sets.withColumnsRenamed({"key": side, "shingles": f"of_{side}"}), side)
    return pairs.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def roots(edges: DataFrame) -> DataFrame:
    found = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return stage(found.withColumnRenamed("node", "key"))


def apart(rows: DataFrame, root: DataFrame) -> DataFrame:
    """``rows(token, key)`` of the tokens whose texts have more than one root, with their roots."""
    rooted = rows.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = (rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
               .filter("low <> high").select("token"))
    return rooted.join(several, "token", "left_semi")


def links(docs: DataFrame, marks: DataFrame, words: int, percent: int) -> DataFrame:
    """``(key, root)`` of the texts of ``docs(text)`` that are linked to another text."""
    marked_ = marks.filter("bits IS NOT NULL").select("key", "n", "bits").dropDuplicates(["key"])
    crowded = stage(tiles(tokens(docs, words, percent, common_buckets(marks)))
                    .join(marked_, "key").withColumn("root", F.col("key")))
    partners, edges, tried = PARTNERS, None, None
    while True:
        found = stage(proposed(crowded, percent, partners))
        pairs = found.filter("b IS NOT NULL").distinct()
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        new = linked(pairs, docs, words, percent)
        edges = stage(new if edges is None else edges.union(new))
        tried = pairs if tried is None else tried.union(pairs)
        root = roots(edges)
        unfinished = found.filter("b IS NULL").select(F.col("a").alias("token"))
        if unfinished.isEmpty():
            return root
        crowded = stage(apart(crowded.drop("root").join(unfinished, "token", "left_semi"), root))
        partners *= MORE


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                 percent: int = 80) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs``.

    Two texts are linked if 100 times their common shingles are at least ``percent`` times all their
    shingles; ``component_id`` is the smallest id reachable over links and equal texts, the own one
    included. A text without words, or null, has no shingles and its own id. A null id takes part
    and counts as larger than any other; where only null ids are linked, the component is null.
    Repeated rows come back as often as they are given; texts of any length are whole. An empty
    table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = stage(marked(source, words))
    rows = marks.filter("bucket IS NULL")
    root = links(source, marks, words, percent)
    known = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("least"))
    rooted = stage(known.join(root, "key", "left").withColumn("root", F.coalesce("root", "key")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("key", "component_id")
    return rows.join(named, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
