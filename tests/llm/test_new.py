"""Phrase collocations, filter audit and the Jaccard join against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import audit, jaccard, phrases
from tests.conftest import SMALL


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- Jaccard join -------------------------------------------------------------------------------

def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_join(texts, ids, percent=80):
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = defaultdict(list)
    for i, g in enumerate(label):
        if ids[i] is not None:
            least[g].append(ids[i])
    return [(ids[i], len(s), min(least[label[i]], default=None)) for i, s in enumerate(sets)]


def joined(df, **options):
    return sorted(map(tuple, jaccard.jaccard_join(df, **options).collect()), key=str)


def numbered(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_jaccard_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    want = brute_join([r.text for r in rows], [r.doc_id for r in rows])
    assert joined(docs) == sorted(want, key=str)
    assert any(c != i for i, _, c in want)


def made_texts(rnd):
    """Near copies of similarity 0.6 to 1, chains, and a passage that many unlike texts hold."""
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    made = []
    for length in (6, 12, 30, 90, 200, 700):
        for _ in range(6):
            first = [word() for _ in range(length)]
            made.append(first)
            for changes in (1, 2, 3, 4, 6, 9):
                near = list(first)
                for at in rnd.sample(range(length), min(changes, length)):
                    near[at] = word()
                made.append(near)
            made.append(first[:-1 - length // 10])
    for _ in range(4):
        text = [word() for _ in range(120)]
        for _ in range(8):
            made.append(text)
            text = text[9:] + [word() for _ in range(9)]
    passage = [f"p{i}" for i in range(60)]
    for _ in range(40):
        own = [word() for _ in range(30)]
        made += [passage + own, passage + own[:-1], passage + [word() for _ in range(12)]]
    texts = [" ".join(t) for t in made]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("common_texts, batch", [(8, "10000"), (10 ** 6, "40")])
def test_jaccard_finds_every_link(spark, monkeypatch, common_texts, batch):
    """With and without an order that puts common shingles last; few partners make many rounds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    texts = made_texts(random.Random(5)) + [None, "", " \n", "a b", "A  b", "a b c d"]
    monkeypatch.setattr(jaccard, "COMMON_TEXTS", common_texts)
    monkeypatch.setattr(jaccard, "PARTNERS", 1)
    monkeypatch.setattr(jaccard, "MORE", 2)
    want = brute_join(texts, list(range(len(texts))))
    assert len({c for _, _, c in want}) < len(texts) - 80
    try:
        assert joined(numbered(spark, texts).repartition(3)) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jaccard_at_other_limits(spark):
    texts = made_texts(random.Random(6))[:150]
    for percent in (60, 95):
        want = brute_join(texts, list(range(len(texts))), percent)
        assert joined(numbered(spark, texts), percent=percent) == sorted(want, key=str)


def test_jaccard_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = ["a b", "A  b", None, " \n", "", long, long + " end", "a b", "b a", "x " * 30_000, "x " * 7]
    ids = [3, 2, 9, 8, None, 5, 5, None, 1, 7, 6]
    df = spark.createDataFrame([(i, t, 1, "k", "r") for i, t in zip(ids, texts)],
                               "doc_id long, text string, n int, key string, root string")
    assert joined(df) == sorted(brute_join(texts, ids), key=str)
    assert joined(df.limit(0)) == []
    assert joined(df.filter("text IS NULL")) == [(9, 0, 9)]


def test_few_candidates_in_a_hot_tile(spark, monkeypatch):
    """400 unlike texts with one passage: pairs that reach the shingles stay far below all pairs."""
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(50)]
    texts = [" ".join(passage + [f"w{rnd.randrange(10 ** 6)}" for _ in range(60)]) for _ in range(400)]
    counted = []
    linked = jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda pairs, *a: (counted.append(pairs.count()), linked(pairs, *a))[1])
    assert len({c for _, _, c in joined(numbered(spark, texts))}) == 400
    assert sum(counted) < 40 * 400


# --- phrases ------------------------------------------------------------------------------------

def brute_phrases(rows, support=30, inside=80, top=2000, most=4):
    size, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            size[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < support:
            continue
        holders = [b for (other, q), b in f.items() if other == lang and len(q) > len(p) and b >= support and any(
            q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= inside * a for b in holders):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, size[lang], -s)
                  for lang, ps in found.items() for i, (s, a, p, l, r) in enumerate(sorted(ps)[:top]))


def mined(df, **options):
    return sorted(map(tuple, phrases.collocations(df, **options).collect()))


def phrase_rows(rnd, n=300):
    vocabulary = [f"v{i}" for i in range(12)] + ["Über", "é", "a-b", "x_1", "#"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "?!"]
    text = lambda: "".join(rnd.choice(vocabulary) + rnd.choice(ends) for _ in range(rnd.randint(0, 60)))
    fixed = "New York City, hall of fame. one two three four five "
    return [(text() + (fixed if rnd.random() < 0.4 else ""), rnd.choice(["en", "en", "de", None]))
            for _ in range(n)]


@pytest.mark.parametrize("shards, block, top", [(2, 1_500_000, 2000), (5, 300, 7), (1, 300, 40)])
def test_phrases_against_brute_force(spark, monkeypatch, shards, block, top):
    rows = phrase_rows(random.Random(4))
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "NUMBERS", block)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert mined(df, shards=shards, top=top) == brute_phrases(rows, top=top)


def test_phrases_of_shared_bits(spark, monkeypatch):
    """Phrases that share bits of the union by chance are counted, and go by their exact count."""
    monkeypatch.setattr(phrases, "TABLE", 1)
    rows = phrase_rows(random.Random(11), 120)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert mined(df, support=9) == brute_phrases(rows, support=9)


def test_phrase_edges(spark):
    rows = [(None, "en"), ("", "en"), ("  , . ", None), ("ab cd " * 20_000, "en"), ("ab cd", "en"), ("ab cd", "en"),
            ("x y\n" * 31, None), ("A B", "")]
    df = spark.createDataFrame([(t, g, "c", 1) for t, g in rows], "text string, lang string, phrase string, n int")
    assert mined(df) == brute_phrases(rows)
    assert mined(df.limit(0)) == []
    assert mined(df.filter("text IS NULL")) == []


# --- filter audit -------------------------------------------------------------------------------

def brute_audit(docs, labels):
    good, toxic = ({i for i, *flags in labels if flags[at] == 1 and i is not None} for at in (0, 1))
    rows = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in docs)}
        rows.append((part or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    found, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                before = set(order[:step - 1])
                left = [r for r in left if f not in r[0]]
                shapley[part, f] += len(gone)
                found[part, order, step] = (
                    len(left), len(gone), sum(f in r[0] and bool(r[0] & before) for r in own),
                    sum(r[0] == {f} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone))
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items())


def test_audit_edges(spark):
    varied = " ".join(f"w{i}" for i in range(300))
    docs = [(1, varied, "s"), (2, varied, "s"), (2, varied, "t"), (None, varied, "s"), (3, None, None), (4, "", ""),
            (5, "A B # C", "s"), (6, "same " * 300, "s"), (7, varied.upper(), "s"), (8, "x\x0by\x0c$ " * 40_000, "t"),
            (9, "é " * 250, None), (1, varied, "s")]
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (6, None, 1), (None, 1, 1), (7, 0, 0)]
    df = spark.createDataFrame([(*r, "m", 2) for r in docs],
                               "doc_id long, text string, source string, mask string, n int")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, id string")
    assert sorted(map(tuple, audit.audit(df, marks).collect())) == brute_audit(docs, labels)
    assert audit.audit(df.limit(0), marks).collect() == []
    bare = audit.audit(df, marks.limit(0))
    assert bare.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)
