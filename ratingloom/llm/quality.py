"""Quality rules: plain counts, and how far a text is from what its language usually looks like.

Every language of the table gets two references, taken over all its documents that pass the
plain rules: the shares of the character classes, and the shares of its common words (all words
that make up at least ``common`` of its words, and the rest as one). A document is compared with
the references by Jensen-Shannon distance. Short texts are noisy, so each comparison is made
from a least length on only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.text import utf8

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"

#: Character classes by UTF-8 byte; bytes that continue a character are of none.
CLASSES = ["vowel", "consonant", "upper", "wide", "digit", "blank", "line", "stop", "quote",
           "symbol", "control"]


def _class_table() -> np.ndarray:
    of = np.zeros((256, len(CLASSES)), np.int64)
    for b in range(256):
        c = chr(b)
        name = (None if 0x80 <= b < 0xC0 else "wide" if b >= 0xC0
                else "vowel" if c in "aeiou" else "consonant" if "a" <= c <= "z"
                else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9"
                else "line" if c == "\n" else "blank" if b in SPACE
                else "control" if b < 0x20 or b == 0x7F
                else "stop" if c in ".,;:!?" else "quote" if c in "'\"()[]-`" else "symbol")
        if name:
            of[b, CLASSES.index(name)] = 1
    return of


CLASS_OF = _class_table()
CHARACTER = CLASS_OF.sum(axis=1)  # 1 for bytes that begin a character
IN_WORD = np.array([0 if b in SPACE else CHARACTER[b] for b in range(256)])
IS_SYMBOL = np.array([int(b in SYMBOLS) for b in range(256)])


def word_ids(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """A number for each word, by first appearance, and the numbers' words."""
    known = dict(zip(dict.fromkeys(words), range(len(words))))
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), known


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside windows of three that occur twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * distinct + ids[1:]
    if distinct >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    three = pair[:-1] * distinct + ids[2:]
    ordered = np.sort(three)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(three, twice))
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if line.split())


class Counts:
    """The plain counts of a text, and what they are made from."""

    def __init__(self, text: bytes | None):
        text = text or b""
        self.words = text.split()
        octets = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        self.classes = octets @ CLASS_OF
        self.ids, self.known = word_ids(self.words)
        self.n_words = len(self.words)
        self.word_chars = int(octets @ IN_WORD)
        self.n_symbols = int(octets @ IS_SYMBOL)
        self.n_dup_lines = repeated_lines(text)
        self.n_repeat_words = repeated_words(self.ids, len(self.known))

    @property
    def failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1; 1 if either is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x):
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())

    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def candidates(docs: DataFrame, common: float) -> DataFrame:
    """``(lang, word)``: every word that is common in ``lang``, and some that are not.

    A word that makes up a share of a language's words does so in at least one task's part of
    them, so a task reports no more than 1 / share words of a language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                counts = Counts(text)
                if not counts.failed:
                    seen.setdefault(lang, Counter()).update(counts.words)
            for lang, found in seen.items():
                if len(found) > 400_000:  # a part of its own, reported at the same share
                    yield report(lang, found)
                    found.clear()
        for lang, found in seen.items():
            yield report(lang, found)

    def report(lang, found):
        least = common * found.total()
        words = [w.decode() for w, n in found.items() if n >= least]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string())], ["lang", "word"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string").distinct()


FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
            " base_failed boolean, classes array<long>, common array<int>, times array<int>")


def features(docs: DataFrame, words: list[str]) -> DataFrame:
    """``(id, lang)``, the plain counts, character classes, and how often each of ``words`` occurs."""
    kind = docs.schema["id"].dataType.simpleString()
    place = docs.sparkSession.sparkContext.broadcast({w.encode(): i for i, w in enumerate(words)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = place.value
        for batch in batches:
            rows = []
            for text in utf8(batch.column(2)):
                c = Counts(text)
                here = [(i, c.known[w]) for w, i in wanted.items() if w in c.known] \
                    if len(wanted) < 4 * len(c.known) else \
                    [(wanted[w], k) for w, k in c.known.items() if w in wanted]
                times = np.bincount(c.ids, minlength=1)
                rows.append((c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words,
                             c.failed, c.classes, np.array([i for i, _ in here], np.int32),
                             times[[k for _, k in here]].astype(np.int32)))
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                                        pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                ["id", "lang", *[f.split()[0] for f in FEATURES.split(",")]])

    return docs.mapInArrow(run, f"id {kind}, lang string, {FEATURES}")


def references(counted: DataFrame, common: float, least_share: float
               ) -> list[tuple[str, np.ndarray, dict[int, int], int]]:
    """(language, character classes, common words with their times, words in all) by language.

    Languages with less than ``least_share`` of the rows have no reference, so there are at most
    1 / least_share of them with at most 1 / common words each.
    """
    good = counted.filter(~F.col("base_failed"))
    sums = [F.sum(F.get("classes", F.lit(i))).alias(c) for i, c in enumerate(CLASSES)]
    sizes = good.groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_words").alias("n_words"), *sums)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    found = []
    langs = sizes.filter(F.col("n") >= F.lit(total * least_share))
    times = (good.select("lang", F.inline(F.arrays_zip("common", "times")))
             .groupBy("lang", "common").agg(F.sum("times").alias("times")))
    words: dict[str, dict[int, int]] = {}
    for r in times.join(langs.select("lang", "n_words"), "lang").filter(
            F.col("times") >= common * F.col("n_words")).collect():
        words.setdefault(r["lang"], {})[r["common"]] = r["times"]
    for r in langs.orderBy("lang").collect():
        found.append((r["lang"], np.array([r[c] for c in CLASSES], float), words.get(r["lang"], {}),
                      r["n_words"]))
    return found


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          common: float = 0.002, least_share: float = 0.001, least_chars: int = 200,
          least_words: int = 50, class_limit: float = 0.14, class_noise: float = 1.3,
          word_limit: float = 0.21, word_noise: float = 1.25) -> DataFrame:
    """Per row: ``id_col``, the plain counts, ``base_failed``, ``class_distance``,
    ``word_distance`` and ``kept``.

    The distances are those to the nearest reference, null below ``least_chars`` characters or
    ``least_words`` words. A row is kept if it passes the plain rules and no distance is over its
    limit plus its noise over the square root of ``n_words``, which is how far a sample of so many
    words strays from what it is drawn from. Rows whose language has no reference (too rare a one) are judged by the plain rules
    alone, as are all if there is no reference; a null language counts as one. A null text is an
    empty one. Repeated rows are judged alike; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    # At most 1 / common words for each task and language, and far fewer distinct ones.
    per_lang = stage(candidates(source, common))
    words = [r["word"] for r in per_lang.select("word").distinct().orderBy("word").collect()]
    counted = stage(features(source, words))
    known = references(counted, common, least_share)
    table = []
    for lang, classes, times, n in known:
        order = sorted(times)
        table.append((classes, np.array(order, np.int64),
                      np.array([*[times[i] for i in order], n - sum(times.values())], float)))
    langs = [lang for lang, *_ in known]
    shared = docs.sparkSession.sparkContext.broadcast((table, len(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, n_common = shared.value
        for batch in batches:
            near = []
            for n, classes, common, times in zip(*[batch.column(i).to_pylist() for i in (5, 6, 7, 8)]):
                classes = np.array(classes, float)
                by_class = by_word = None
                if refs and classes.sum() >= least_chars:
                    by_class = min(distance(classes, r[0]) for r in refs)
                if refs and n >= least_words:
                    own = np.zeros(n_common)
                    own[common] = times
                    by_word = min(distance(np.r_[own[i], n - own[i].sum()], q) for _, i, q in refs)
                near.append((by_class, by_word))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[batch.column(i) for i in range(1, 6)], batch.column(9),
                 *[pa.array([x[i] for x in near], pa.float64()) for i in (0, 1)], batch.column(10)],
                ["id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words",
                 "base_failed", "class_distance", "word_distance", "lang"])

    kind = source.schema["id"].dataType.simpleString()
    measured = counted.select(
        "id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words", "classes",
        "common", "times", "base_failed", "lang").mapInArrow(
        run, f"id {kind}, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " n_words long, base_failed boolean, class_distance double, word_distance double, lang string")
    root = F.sqrt("n_words")
    near: Column = (F.coalesce(F.col("class_distance") <= class_limit + class_noise / root, F.lit(True))
                    & F.coalesce(F.col("word_distance") <= word_limit + word_noise / root, F.lit(True)))
    unknown = ~F.col("lang").isin(langs)
    return measured.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (near | unknown)).alias("kept"),
        "class_distance", "word_distance")
