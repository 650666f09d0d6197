"""Language of texts, and of the spans of mixed ones.

A word's script narrows the languages it can belong to. Each word is scored in those by a model
of its character n-grams; a Viterbi path over the words of a text, on which every change of
language costs a penalty, labels the words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: First and last code point of scripts; letters outside are of script "other".
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
NAMES = [*SCRIPTS, "other"]
_RANGES = sorted((a, b, i) for i, spans in enumerate(SCRIPTS.values()) for a, b in spans)
_STARTS, _ENDS, _SCRIPT = (np.array(x) for x in zip(*_RANGES))

#: A word is a run of letters (and of signs that count as such in numbers, like fractions; a
#: run of those alone is no word).
WORD = re.compile(r"[^\W\d_]+")

#: Buckets of n-gram hashes, and characters of the longest n-gram.
BUCKETS = 1 << 16
LONGEST = 4

#: Words whose scores a worker remembers before it starts afresh.
REMEMBERED = 500_000

#: Rows labelled together.
TOGETHER = 1000


def characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased words with a space before each and one at the end, and
    the place of the space before each word."""
    code = np.frombuffer(f" {' '.join(words).lower()} ".encode("utf-32-le"), np.uint32)
    return code, np.flatnonzero(code == 0x20)


def scripts_of(words: list[str]) -> np.ndarray:
    """Number of the script that most letters of each word are in, the first of equals."""
    code, space = characters(words)
    at = np.searchsorted(_STARTS, code, "right") - 1
    script = np.where((at >= 0) & (code <= _ENDS[at]), _SCRIPT[at], len(NAMES) - 1)
    word = np.cumsum(code == 0x20) - 1
    letter = code != 0x20
    counts = np.bincount(word[letter] * len(NAMES) + script[letter], minlength=len(words) * len(NAMES))
    return counts.reshape(len(words), len(NAMES)).argmax(axis=1)


def grams_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) of the n-grams of each length, the words between marks for their ends."""
    code, _ = characters(words)
    space = code == 0x20
    word = np.cumsum(space) - 1
    inner = np.cumsum(space)  # to see whether a gram has a space inside
    wide = code.astype(np.uint64)
    state = np.zeros(len(code), np.uint64)
    for n in range(1, LONGEST + 1):
        end = len(code) - n + 1
        if end <= 0:
            break
        state = (state[:end] * np.uint64(0x9E3779B97F4A7C15) + wide[n - 1:] + np.uint64(n)) \
            * np.uint64(0xBF58476D1CE4E5B9)
        bucket = ((state ^ (state >> np.uint64(31))) >> np.uint64(48)).astype(np.int64)
        # A gram may begin and end with a space but has none between.
        between = inner[max(n - 2, 0):max(n - 2, 0) + end] - inner[:end]
        good = (between == 0) & ~(space[:end] & space[n - 1:]) & (word[:end] < len(words))
        yield word[:end][good], bucket[good]


@dataclass
class Model:
    """Learned languages, log probabilities of n-gram buckets, and the scripts of each language."""

    languages: list[str]
    logp: np.ndarray  # buckets x languages
    scripts: np.ndarray  # scripts x languages, True where the language uses the script
    prior: np.ndarray
    memory: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray | None = None

    def scores(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places of the words that have a letter, words x languages) for each text.

        A word scores the mean log probability of its n-grams times its length, 12 at most. A
        language that does not use the word's script is out; a script that no language uses
        leaves the priors.
        """
        if self.rows is None or len(self.memory) > REMEMBERED:
            self.memory, self.rows = {}, np.zeros((0, len(self.languages)), np.float32)
        new: dict[str, None] = {}
        for words in texts:
            new.update(dict.fromkeys(words))
        fresh = [w for w in new if w not in self.memory]
        lettered = [w for w in fresh if any(map(str.isalpha, w))]
        if lettered:
            self.memory.update(zip(lettered, range(len(self.rows), len(self.rows) + len(lettered))))
            self.rows = np.concatenate([self.rows, self._score(lettered)])
        if len(lettered) < len(fresh):
            self.memory.update(dict.fromkeys(set(fresh) - set(lettered), -1))
        out = []
        for words in texts:
            index = np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words))
            place = np.flatnonzero(index >= 0)
            out.append((place, self.rows[index[place]]))
        return out

    def _score(self, words: list[str]) -> np.ndarray:
        total = np.zeros((len(words), len(self.languages)))
        grams = np.zeros(len(words))
        for word, bucket in grams_of(words):
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(word, self.logp[bucket, k], len(words))
            grams += np.bincount(word, minlength=len(words))
        length = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 12)
        score = total / grams[:, None] * length[:, None]
        usual = self.scripts[scripts_of(words)]
        out = np.where(usual, score, score.min(axis=1, keepdims=True) - 20)
        return np.where(usual.any(axis=1, keepdims=True), out, self.prior).astype(np.float32)


def settled(scores: np.ndarray, penalty: float) -> int:
    """The language of all words if no path with a change is as good, else -1.

    A path that leaves the language of the best total gains on some stretch at most the sum of
    its words' largest gains, and pays at least one penalty.
    """
    sums = scores.sum(axis=0, dtype=np.float64)
    best = int(sums.argmax())
    gain = np.cumsum((scores - scores[:, best:best + 1]).max(axis=1, initial=-np.inf,
                     where=np.arange(scores.shape[1]) != best), dtype=np.float64)
    lowest = np.minimum.accumulate(np.r_[0.0, gain[:-1]])
    return best if scores.shape[1] == 1 or (gain - lowest).max() < penalty else -1


def viterbi_all(texts: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best path of languages through each text's words, the texts side by side.

    Of equal paths the one that stays, then the first language's.
    """
    if not texts:
        return []
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order])
    languages = texts[0].shape[1]
    flat = np.concatenate([texts[i] for i in order])
    start = np.cumsum(sizes) - sizes
    stay = np.arange(languages, dtype=np.int16)
    back = np.empty(flat.shape, np.int16)
    now = flat[start].astype(np.float64)
    final = now.copy()
    for step in range(1, int(sizes[0])):
        live = int(np.searchsorted(-sizes, -step, "left"))  # texts with more than ``step`` words
        now = now[:live]
        best = now.argmax(axis=1)
        moved = now[np.arange(live), best] - penalty
        switch = now < moved[:, None]
        at = start[:live] + step
        back[at] = np.where(switch, best[:, None], stay)
        now = np.where(switch, moved[:, None], now) + flat[at]
        final[:live] = now
    path = np.empty(len(flat), np.int16)
    last = start + sizes - 1
    path[last] = final.argmax(axis=1)
    for step in range(int(sizes[0]) - 1, 0, -1):
        live = int(np.searchsorted(-sizes, -step, "left"))
        at = start[:live] + step
        path[at - 1] = back[at, path[at]]
    out: list[np.ndarray] = [None] * len(texts)
    for k, i in enumerate(order):
        out[i] = path[start[k]:start[k] + sizes[k]]
    return out


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample: int = 4000, least_share: float = 0.001, smoothing: float = 0.5) -> Model:
    """A model from the texts and labels of ``labelled``.

    Fits on a bounded sample: at most ``sample`` rows of each language, those with the smallest
    checksums of their texts; copies of a text count once. Rows with a null text or label teach nothing. A language with less
    than ``least_share`` of the rows is not learned, so there are at most 1 / least_share.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).dropna()
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    kept = {r["lang"]: r["n"] for r in
            sizes.filter(F.col("n") >= F.lit(total * least_share)).collect()}
    if not kept:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(NAMES), 0), bool),
                     np.zeros(0))
    # Checksums are uniform, so a cut at the wanted share leaves close to ``sample`` rows, but all
    # or none of a group of copies; those come down to one, in the tasks that read them first.
    cut = F.lit(0)
    for lang, n in kept.items():
        cut = F.when(F.col("lang") == lang, int(min(1.0, sample / n) * 2 ** 32)).otherwise(cut)
    chosen = rows.filter(F.crc32(F.col("text").cast("binary")) < cut).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words.setdefault(lang, Counter()).update(WORD.findall(text.as_py()))
        for lang, found in words.items():
            found = {w: n for w, n in found.items() if any(map(str.isalpha, w))}
            names, times = list(found), np.fromiter(found.values(), np.int64, len(found))
            grams, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(NAMES), np.int64)
            if names:
                for word, bucket in grams_of(names):
                    grams += np.bincount(bucket, times[word], BUCKETS).astype(np.int64)
                np.add.at(scripts, scripts_of(names), times * np.array([len(w) for w in names]))
            keys = np.r_[np.flatnonzero(grams), BUCKETS + np.flatnonzero(scripts)]
            values = np.r_[grams[grams > 0], scripts[scripts > 0]]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(keys), pa.string()),
                "key": pa.array(keys, pa.int64()), "n": pa.array(values, pa.int64())})

    # At most (buckets + scripts) rows per language.
    counted = (chosen.mapInArrow(count, "lang string, key long, n long")
               .groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(kept)
    table = np.zeros((BUCKETS + len(NAMES), len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    table[counted["key"].to_numpy(), [place[x] for x in counted["lang"].to_pylist()]] = counted["n"].to_numpy()
    grams, scripts = table[:BUCKETS] + smoothing, table[BUCKETS:]
    used = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    prior = np.log(np.array([kept[x] for x in languages]) / sum(kept.values()))
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), used & (scripts > 0), prior)


def judged(texts: list[str | None], model: Model, penalty: float
           ) -> Iterator[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    found = [WORD.findall(t) if t and model.languages else [] for t in texts]
    scored = model.scores(found)
    all_one = [settled(s, penalty) if len(s) else -1 for _, s in scored]
    paths = iter(viterbi_all([s for (_, s), one in zip(scored, all_one) if len(s) and one < 0],
                             penalty))
    for text, words, (place, score), one in zip(texts, found, scored, all_one):
        if not len(place):
            yield "und", 0.0, []
        elif one >= 0:
            lang = model.languages[one]
            if len(place) == len(words):
                first, last = text.index(words[0]), text.rindex(words[-1]) + len(words[-1])
            else:
                ends = [m.span() for m in WORD.finditer(text)]
                first, last = ends[place[0]][0], ends[place[-1]][1]
            yield lang, 1.0, [{"first": first, "last": last - 1, "lang": lang}]
        else:
            path = next(paths)
            ends = np.array([m.span() for m in WORD.finditer(text)])[place]
            letters = np.bincount(path, ends[:, 1] - ends[:, 0], len(model.languages))
            best = int(letters.argmax())
            cut = np.flatnonzero(np.diff(path)) + 1
            spans = [{"first": int(ends[i, 0]), "last": int(ends[j - 1, 1]) - 1,
                      "lang": model.languages[path[i]]}
                     for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(path)])]
            yield model.languages[best], float(letters[best] / letters.sum()), spans

def shipped(docs: DataFrame, model: Model):
    """The model's tables (at most buckets x languages numbers) as a broadcast."""
    return docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.logp, model.scripts, model.prior))


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          penalty: float = 12.0) -> DataFrame:
    """``(id_col, lang_pred, score, spans)`` for every row of ``docs``.

    ``spans`` has (first, last, lang): code points of the stretches of one language in order.
    ``lang_pred`` is the language with most letters, the first by name of equals, and ``score``
    its share of them. A null text or one without a letter is ``und`` with score 0, as is
    everything if no language was learned. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    shared = shipped(docs, model)
    spans = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                rows = list(judged(part.column(1).to_pylist(), own, penalty))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.string()),
                     pa.array([r[1] for r in rows], pa.float64()),
                     pa.array([r[2] for r in rows], spans)],
                    ["id", "lang_pred", "score", "spans"])

    return source.mapInArrow(
        run, f"id {kind}, lang_pred string, score double,"
        " spans array<struct<first:int,last:int,lang:string>>").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model, least_share: float, text_col: str = "text",
             penalty: float = 12.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with ``least_share`` of its
    letters or more; texts that are ``und`` go. Rows pass through one scan, without a join."""
    shared = shipped(docs, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                texts = part.column(at).to_pylist()
                yield part.filter(pa.array(
                    [lang != "und" and score >= least_share
                     for lang, score, _ in judged(texts, own, penalty)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: Column) -> Column:
    """Rows kept from training: CRC32 of the key as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
