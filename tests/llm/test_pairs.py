"""SimHash, decontamination, sharding and mixing against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ratingloom.llm import decontaminate, mixing, sharding, simhash
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, size string, fp string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(
        [(i, t, "x", "s", "clash", "clash") for i, t in zip(ids, texts)], DOCS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=4):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = defaultdict(lambda: None)
    for i, g in enumerate(label):
        if ids[i] is not None:
            least[g] = ids[i] if least[g] is None else min(least[g], ids[i])
    return [least[g] for g in label]


@pytest.mark.parametrize("tree_nodes", [4096, 3])
def test_simhash_of_documents(spark, docs, tree_nodes):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(fps, ids))}
    got = simhash.near_duplicates(docs, tree_nodes=tree_nodes).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_links_of_random_fingerprints(spark):
    import random

    rnd = random.Random(7)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 6)))
           for b in base for _ in range(12)}
    fps |= {base[0] ^ (0xF << (4 * k)) for k in range(16)} | {0, 1, (1 << 64) - 1}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components(list(fps), signed)
    for limit in (4096, 5):
        edges = simhash.links(df, tree_nodes=limit).collect()
        parent = {f: f for f in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for e in edges:
            a, b = sorted((find(e.u), find(e.v)))
            parent[b] = a
        assert [find(f) for f in signed] == want


def test_simhash_edges(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    df = frame(spark, ["a b", "A  b", None, " \n", "", long, long, "a b"], [3, 2, 9, 8, None, 5, 5, None])
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 2), (2, 2), (9, 8), (8, 8), (None, 8), (5, 5), (5, 5), (None, 2)], key=str)
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_contamination(texts, items, width=13):
    windows = defaultdict(set)
    for item, text in items:
        w = words13(text)
        for i in range(max(0, max(1, len(w) - width + 1)) if w else 0):
            windows[tuple(w[i:i + width])].add(item)
    sizes = {len(w) for w in windows}
    for text in texts:
        w, hit, found = words13(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        yield len(w), len(hit), len(found), digest


@pytest.mark.parametrize("block_words", [2_000_000, 200])
def test_contamination_of_documents(spark, docs, block_words):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = docs.collect()
    want = brute_contamination([r.text for r in rows], [tuple(r) for r in bench.collect()])
    got = {r.doc_id: tuple(r)[1:] for r in
           decontaminate.contamination(docs, bench, block_words=block_words).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want)}
    assert any(w[1] for w in got.values())


def test_contamination_edges(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(7, passage), (7, passage), (10, "Only Four Words, here"), (None, "lone"), (3, None), (4, " .")]
    texts = [f"x {passage} y", passage.upper(), "only four-words HERE only four words here", None, "", "...",
             "lone wolf", " ".join(f"p{i}" for i in range(12)), f"{passage} {passage}", "only four words",
             "b " * 3000 + passage, "lone"]
    ids = [*range(10), None, 3]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(zip(map(str, ids), brute_contamination(texts, items)))
    for size in (1_000_000, 40):
        monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", size)
        got = decontaminate.contamination(frame(spark, texts, ids), bench).collect()
        assert sorted((str(r.doc_id), tuple(r)[1:]) for r in got) == want
    empty = decontaminate.contamination(frame(spark, texts, ids), bench.limit(0)).collect()
    assert sorted((r.n_words, r.n_hit) for r in empty) == sorted((w[0], 0) for _, w in want)
    assert decontaminate.contamination(frame(spark, texts, ids).limit(0), bench).collect() == []


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    texts = ["red very green blue", "red green blue", "blue red", "red a b c green blue"]
    got = {r.doc_id: r.n_items for r in decontaminate.contamination(
        frame(spark, texts), bench, slop=1).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0}


def test_shards_of_documents(spark, docs):
    rows = sharding.shard_rows(docs, 40).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    load, places = Counter(), defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 16 and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= max(r.size for r in rows)
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_rows(docs.repartition(5), 40).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shard_edges(spark):
    df = frame(spark, [None, "", "ß", "ß", "x" * 100_000], [1, 2, None, None, 3])
    rows = sharding.shard_rows(df, 3).collect()
    assert sorted(r.size for r in rows) == [16, 16, 18, 18, 100_016]
    assert sharding.shard_rows(df.limit(0), 3).collect() == []


def test_map_edits_move_slots_only_where_bytes_ask_for_it():
    first = sharding.first_map(4, 64)
    weight = {s: 10 for s in range(64)}
    assert sharding.rebalanced(first, weight, 4) == first
    grown = sharding.rebalanced(first, weight, 5)
    moved = {s for s in first if grown[s] != first[s]}
    assert {grown[s] for s in moved} == {4} and 11 <= len(moved) <= 13


def test_mix_of_documents(spark, docs):
    rows = mixing.mix(docs).collect()
    got = defaultdict(list)
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        got[source[r.doc_id]].append(r)
    total = sum(r.size for r in rows)
    names = sorted(got)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    size = {s: sum(r.size for r in got[s]) for s in names}
    held: set = set()
    while True:
        level = (total - sum(3 * size[s] for s in held)) / sum(weight[s] for s in names if s not in held)
        over = {s for s in names if s not in held and weight[s] * level > 3 * size[s]}
        if not over:
            break
        held |= over
    for s in names:
        want = 3 * size[s] if s in held else weight[s] * level
        taken = sum(r.taken for r in got[s])
        assert all(math.isclose(r.target, want) and r.source_size == size[s] for r in got[s])
        assert abs(taken - want) <= max(r.size for r in got[s])
        assert all(r.taken == r.copies * r.size <= 3 * r.size for r in got[s])
        whole = int(want // size[s])
        assert all(r.copies - whole in (0, 1) for r in got[s])
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_edges(spark):
    rows = [(1, "a b c", "s"), (2, None, "s"), (3, "", None), (None, "d e", None), (None, "d e", None),
            (5, "x " * 50_000, "t"), (6, "y", "u"), (6, "y", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", F.lit("r"))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(df.limit(0)).collect() == []
    assert [r.taken for r in mixing.mix(df.filter("text is null")).collect()] == [0]


def test_pareto_inclusion_is_fair(spark):
    """Over many seeds every document is taken about as often as its target says."""
    df = spark.createDataFrame([(i, "w " * 10, s) for i in range(60) for s in ("a", "b")],
                               "doc_id long, text string, source string")
    runs = [mixing.mix(df, seed=str(k)) for k in range(12)]
    share = [r.agg(F.sum("taken") / F.sum("size")).first()[0] for r in runs]
    assert all(abs(s - 1) < 0.02 for s in share)
    counts = Counter()
    for r in runs:
        counts.update(x.doc_id for x in r.filter("copies > floor(target / source_size)").collect())
    assert len(counts) == 60
