"""Phrase collocations by SON partitioning.

The corpus is dealt into a few shards. A phrase that is frequent in the whole corpus is frequent in
some shard at support lowered to the shard's share of the words, so each shard is mined completely
at that support, level by level: a phrase is counted only where both phrases one word shorter are
locally frequent. The union of what the shards find is a set of bits of fixed size, from hashes of
the phrases; phrases that share a bit by chance are only counted for nothing. Words that are in no
phrase of the union become breaks, and what is left is written as numbers for the other levels. One
more pass counts every phrase of the union over the whole corpus, by its words, and keeps the
frequent ones.

A shard is as many tasks as its size asks for: tasks count blocks of text in arrays, Spark adds the
counts up. With more shards than support / 2 the local support would be one and mine everything, so
the number of shards is a parameter and does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.text import SEED, utf8

#: Words of 64 bits in the table of the union: 8 MB for any corpus.
TABLE = 1 << 20

#: Words counted together.
BLOCK = 700_000

#: Numbers of words counted together.
NUMBERS = 2_000_000

#: Hashes of words remembered in a task.
REMEMBERED = 200_000

#: Lowers A-Z, and turns what ends a piece (.,;:!? and 0x0A to 0x0D) into line ends.
PIECES = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x0A if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))

#: Stands between pieces; no word is empty.
BREAK = b""


def pieces(text: bytes | None) -> list[bytes]:
    """Words (runs without 0x20 and 0x09) in order, a break after each piece that has some."""
    found: list[bytes] = []
    for piece in (text or b"").translate(PIECES).split(b"\n"):
        if words := piece.split():
            found += words
            found.append(BREAK)
    return found


class Hashes(dict):
    """32-bit hashes of words, none zero; the break's is zero."""

    def __missing__(self, word: bytes) -> int:
        value = (xxhash.xxh32_intdigest(word, SEED) or 1) if word else 0
        self[word] = value
        return value


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def longer(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of the phrases one word longer, from those of the phrases and their next words."""
    return mixed(keys[:len(words)] * np.uint64(0x9E3779B97F4A7C15) + words)


def known(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys = keys >> np.uint64(32)
    bits = table[(keys >> np.uint64(6) & np.uint64(TABLE - 1)).astype(np.int64)]
    return (bits >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """``(group, words)`` of many documents together; a task holds ``BLOCK`` words and a text.

    The first column is the text, the others are the group."""
    open_: dict[tuple, list[bytes]] = {}
    held = 0
    for batch in batches:
        groups = zip(*(column.to_pylist() for column in batch.columns[1:]))
        for group, text in zip(groups, utf8(batch.column(0))):
            words = pieces(text)
            open_.setdefault(group, []).extend(words)
            held += len(words)
            if held >= BLOCK:
                yield from open_.items()
                open_, held = {}, 0
    yield from open_.items()


def hashed(words: list[bytes], hashes: Hashes) -> np.ndarray:
    if len(hashes) > REMEMBERED:
        hashes.clear()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def seeded(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), SEED))


def part_of(shard: Column) -> Column:
    """The number of a shard of a language."""
    return F.xxhash64("lang", shard.cast("int"))


def counts(group: tuple[str, int], keys: np.ndarray) -> pa.RecordBatch:
    """The counts of ``keys``, which are cut to 32 bits: as many as the table tells apart, and more."""
    keys, n = np.unique((keys >> np.uint64(32)).astype(np.uint32), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), group[1], np.int64)), pa.array(keys.view(np.int32)),
         pa.array(n.astype(np.int64))], ["part", "key", "n"])


COUNTS = "part long, key int, n long"


def word_level(docs: DataFrame) -> DataFrame:
    """``(part, key, n)``: counts of the words of each shard of a language, as tasks found them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for group, words in blocks(batches):
            h = hashed(words, hashes)
            yield counts(group, mixed(h[h > 0] ^ seeded(group[0])))

    return docs.mapInArrow(run, COUNTS)


def encoded(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``(lang, part, words)``: hashes of the words of many texts; a zero where others or breaks stood,
    and at the end."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for group, words in blocks(batches):
            h = hashed(words, hashes)
            h[~known(shared.value, mixed(h ^ seeded(group[0])))] = 0
            h = h[(h > 0) | np.r_[True, h[:-1] > 0]]
            lists = pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()),
                                             pa.array(h.astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([group[0]], pa.string()), pa.array([group[1]], pa.int64()), lists],
                ["lang", "part", "words"])

    return docs.mapInArrow(run, "lang string, part long, words array<int>")


def level(texts: DataFrame, size: int, table: np.ndarray) -> DataFrame:
    """``(part, key, n)``: counts of the phrases of ``size`` words, as tasks found them.

    Only phrases whose two parts one word shorter are in ``table`` are counted."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[tuple[str, int], list[np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                group = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                held = open_.setdefault(group, [])
                held.append(batch.column(2)[i].values.to_numpy().view(np.uint32))
                if sum(map(len, held)) >= NUMBERS:
                    yield counts(group, phrases(group, open_.pop(group)))
        for group, held in open_.items():
            yield counts(group, phrases(group, held))

    def phrases(group: tuple[str, int], held: list[np.ndarray]) -> np.ndarray:
        h = np.concatenate(held).astype(np.uint64)
        key, whole, seed = h, h > 0, seeded(group[0])
        for k in range(2, size):
            key = longer(key, h[k - 1:])
            whole = whole[:len(key)] & (h[k - 1:] > 0)
        if size > 2:
            whole &= known(shared.value, mixed(key ^ seed))
        whole = whole[:-1] & whole[1:]
        return mixed(longer(key, h[size - 1:])[whole] ^ seed)

    return texts.mapInArrow(run, COUNTS)


def with_bits(table: np.ndarray, keys: DataFrame) -> np.ndarray:
    """``table`` with the bits of ``keys(key)``; the driver gets at most ``TABLE`` words."""
    key = F.col("key")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    bits = (keys.groupBy(F.shiftright("key", 6).bitwiseAND(F.lit(TABLE - 1)).alias("word"))
            .agg(F.bit_or(one).alias("bits"))).toArrow()
    table = table.copy()
    table[bits["word"].to_numpy()] |= bits["bits"].to_numpy().view(np.uint64)
    return table


def counted(docs: DataFrame, most: int, table: np.ndarray) -> DataFrame:
    """``(lang, phrase, k, n)``: phrases of the union and how often tasks found them, by their words."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for (lang,), words in blocks(batches):
            h = hashed(words, hashes)
            numbers = Numbers()
            word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            seed, key, name = seeded(lang), h, word
            fit = (h > 0) & known(shared.value, mixed(h ^ seed))
            for k in range(1, most + 1):
                if k > 1:
                    key = longer(key, h[k - 1:])
                    fit = fit[:len(key)] & fit[1:len(key) + 1]
                    fit &= known(shared.value, mixed(key ^ seed))
                at = np.flatnonzero(fit)
                # Names are exact: the name of the phrase without its last word, and that word.
                pair = name[at] if k == 1 else name[at] << np.int64(32) | word[at + k - 1]
                _, first, place, n = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
                name = np.zeros(len(key), np.int64)
                name[at] = place
                texts = [b" ".join(words[i:i + k]) for i in at[first].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(texts)).cast(pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
                     pa.array(np.full(len(texts), k, np.int32)), pa.array(n.astype(np.int64))],
                    ["lang", "phrase", "k", "n"])

    return docs.mapInArrow(run, "lang string, phrase string, k int, n long")


def frequent(docs: DataFrame, most: int, support: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, a)`` of all phrases up to ``most`` words with ``support``; ``(lang, n)``."""
    local = stage(word_level(docs).groupBy("part", "key").agg(F.sum("n").alias("n")))
    names = docs.select("lang").distinct().select("lang", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    parts = stage(local.groupBy("part").agg(F.sum("n").alias("words")).join(
        names.select("lang", part_of(F.col("shard")).alias("part")), "part"))
    size = parts.groupBy("lang").agg(F.sum("words").alias("n"))
    # Below this support in every shard a phrase is below the whole's in all together.
    least = F.broadcast(stage(parts.join(size, "lang").groupBy("part").agg(F.min(
        F.ceil(exact("words") * support / exact("n")).cast("long")).alias("least"))))
    table = with_bits(np.zeros(TABLE, np.uint64), local.join(least, "part").filter("n >= least"))
    texts = stage(encoded(docs, table))
    for k in range(2, most + 1):
        local = level(texts, k, table).groupBy("part", "key").agg(F.sum("n").alias("n"))
        table = with_bits(table, local.join(least, "part").filter("n >= least"))
    found = counted(docs.drop("part"), most, table).groupBy("lang", "phrase", "k").agg(F.sum("n").alias("a"))
    return stage(found.filter(F.col("a") >= support)), size


def exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every phrase of two words or more, by its worst cut."""
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    cuts = (found.filter("k > 1").select("lang", "phrase", "a", cut.alias("cut"))
            .withColumn("first", F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.col("cut")))
            .withColumn("rest", F.expr("substring(phrase, char_length(first) + 2)")))
    part = found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.withColumnsRenamed({"part": side, "f": count}), ["lang", side])
    worth = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div "
                   "(cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long")
    return cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(worth.alias("score"), "cut", "a", "l", "r")).alias("worst")).select(
        "lang", "phrase", "worst.a", "worst.l", "worst.r", "worst.score")


def inner_counts(found: DataFrame) -> DataFrame:
    """``(lang, phrase, top)``: the highest count of a longer phrase that holds the phrase."""
    words = F.split("phrase", " ")
    parts = found.filter("k > 2").select("lang", "a", "k", words.alias("w")).withColumn("phrase", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1),"
        " i -> array_join(slice(w, i, s), ' '))))")))
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("top"))


def leading(rows: DataFrame, group: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank``; large groups are cut first."""
    cuts = max(1, round((rows.count() / most) ** 0.5))
    pieces_ = Window.partitionBy(group, "cut").orderBy(*order)
    some = (rows.withColumn("cut", F.pmod(F.xxhash64("phrase"), F.lit(cuts)))
            .withColumn("rank", F.row_number().over(pieces_)).filter(F.col("rank") <= most))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= most).drop("cut")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = 4, support: int = 30,
                 inside: int = 80, top: int | None = 2000, shards: int = 2) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best collocations of each language.

    Phrases have 2 to ``most`` words and ``support`` occurrences ``a`` inside pieces. ``score`` is the
    least floor(2000000 a / (l + r)) over the cuts into two parts of counts ``l`` and ``r``, the earlier
    cut on ties. A phrase goes if a longer one that holds it has ``inside`` percent of its count. Ranked
    by score, count and phrase; ``top`` rows a language, all without it. ``n`` counts its words.

    A null text is empty, a null language ``und``; repeated rows count as often as they are given;
    texts of any length are whole. An empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    source = (docs.select(text.alias("text"), lang.alias("lang"))
              .withColumn("part", part_of(F.pmod(F.xxhash64("text"), F.lit(shards)))))
    found, size = frequent(source, most, support, shards)
    kept = (scored(found).join(inner_counts(found), ["lang", "phrase"], "left")
            .filter(F.coalesce(exact("top") * 100 < exact("a") * inside, F.lit(True))).drop("top"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = stage(kept)
    ranked = leading(kept, "lang", order, top or max(1, kept.count()))
    # One row for each language.
    return ranked.join(F.broadcast(size), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
