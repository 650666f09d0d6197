"""Per-document operators against brute force, libraries and known cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import html, langid, quality, queries, tokens, urls, windows
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, kept string, counts string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "clash", "clash") for i, t, x in rows], DOCS)


# --- quality rules ------------------------------------------------------------------------------

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if three[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_quality_of_documents(spark, docs):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute_counts(texts[i])
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    judged = [(labels[i], r.kept) for i, r in got.items() if i in labels and not r.base_failed]
    assert sum(q == k for q, k in judged) >= 0.93 * len(judged)


def test_quality_edges(spark):
    rows = [(1, None, None), (2, "", "en"), (None, "a b\na b\na b", "en"), (2, "", "en"),
            (4, "w " * 30_000, None), (5, "ß#\n\nß#\n中 文", "zz")]
    got = quality.judge(frame(spark, rows)).collect()
    assert sorted(map(str, (tuple(r)[1:7] for r in got))) == sorted(
        str(brute_counts(t)) for _, t, _ in rows)
    assert quality.judge(frame(spark, rows).limit(0)).collect() == []


def test_distance():
    one, other = np.array([1.0, 0.0]), np.array([0.0, 3.0])
    assert quality.distance(one, one) == 0 and quality.distance(one, other) == pytest.approx(1)
    assert quality.distance(one, np.zeros(2)) == 1


# --- main text ----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div>
<aside>Side</aside><form>Mail<input></form><article><h1>Head &amp; line</h1><p>One <b>two</b>,<br>three
<p>Caf&eacute; &#8364; &lt;x&gt;<script>var a="<p>no</p>";</script><div class="ad">Buy</div><!-- <p>no</p> -->
<ul><li>first<li>second</ul><section class="comments"><p>Nice!</p></section></article><footer>Foot</footer>"""


def test_main_text():
    assert html.main_blocks(PAGE) == ["Head & line", "One two, three", "Café € <x>", "first", "second"]
    assert html.main_blocks(PAGE.replace("article", "main")) == html.main_blocks(PAGE)
    assert html.main_blocks("just text") == ["just text"]
    assert html.main_blocks("<div>a<p>b</div>c < d") == ["a", "b", "c < d"]
    assert html.main_blocks(None) == html.main_blocks("") == html.main_blocks("<p> </p>") == []


def test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    texts = {r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op4_html(spark, SMALL).collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert r.n_chars == len(r.text) and r.text.split("\n", 1)[1] in texts


def test_unimportant_branches_go(spark):
    """A block that says the same on every page goes; on a host of few pages it stays."""
    def page(i):
        return f"<article><p>{f'Story {i} of its own. ' * 9}</p><div><span>All rights kept here</span></div></article>"

    rows = [(i, "http://many.test/x", page(i)) for i in range(40)] + [(99, "http://few.test/", page(99)),
                                                                     (None, None, None), (98, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got[3] == ("Story 3 of its own. " * 9).strip() and got[99].endswith("All rights kept here")
    assert got[None] == got[98] == ""
    assert html.extract(df.limit(0)).collect() == []


# --- passages -----------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 2, 40, 300])
@pytest.mark.parametrize("width", [1, 3, 8])
def test_compact_windows(n, width):
    rng = np.random.default_rng(n * 10 + width)
    h = rng.integers(0, 12 if n < 100 else 1 << 40, n).astype(np.uint64)
    want = []
    for c in range(n):
        first = last = c
        while h[c] and first > 0 and h[first - 1] > h[c]:
            first -= 1
        while h[c] and last < n - 1 and h[last + 1] >= h[c]:
            last += 1
        if h[c] and last - first + 1 >= width:
            want.append((first, c, last))
    assert list(zip(*[x.tolist() for x in windows.compact_windows(h, width)])) == want


def test_repeated_passages(spark, docs):
    rows = {r.doc_id: r for r in windows.repeated_passages(docs).collect()}
    split = {r.doc_id: r.text.encode().lower().split() for r in docs.collect()}
    where = {}
    for i, w in split.items():
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k:k + 50]), set()).add(i)
    for i, w in split.items():
        for k in range(len(w) - 49):
            if len(where[tuple(w[k:k + 50])]) > 1:
                assert any(s.first <= k and k + 49 <= s.last for s in rows[i].spans)


def test_passage_edges(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(80)]
    near = passage[:40] + ["changed"] + passage[41:]
    text = lambda mid: " ".join([word() for _ in range(60)] + mid + [word() for _ in range(60)])
    rows = [(1, text(passage), None), (2, text(near).upper(), None), (3, text([]), None), (4, None, None),
            (5, "", None), (6, " ".join(passage[:30]), None), (7, text([]), None), (None, text(passage), None)]
    rows += [(8, rows[2][1], None)]
    got = {r.doc_id: r for r in windows.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, None, 3, 8}
    assert {got[i].class_id for i in (1, 2, None)} == {1} and got[8].class_id == got[3].class_id == 3
    assert [(s.first, s.last) for s in got[1].spans] == [(60, 139)]
    assert got[3].n_copies == 2 and got[1].n_copies == 1
    assert windows.repeated_passages(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("changed", [0, 1])
def test_passages_that_first_texts_quote_in_part(spark, changed):
    rng = random.Random(changed)

    def fill(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    rows = []
    for g in range(40):
        whole = [f"p{g}x{i}" for i in range(55 if not changed else 80)]
        other = whole[:60] + fill(changed) + whole[60 + changed:]
        at = [rng.randrange(len(whole) - 40) for _ in range(4)]
        texts = [whole[i:i + 41] for i in at] + [whole, other]
        rows += [(10 * g + i, " ".join(fill(60) + t + fill(60)), None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in windows.repeated_passages(frame(spark, rows)).collect()}
    assert sorted(got) == [10 * g + i for g in range(40) for i in (4, 5)]
    assert all(r.class_id == i // 10 * 10 + 4 and r.n_links == 1 for i, r in got.items())
    assert all(r.n_repeated == 55 for r in got.values()) or changed


# --- language -----------------------------------------------------------------------------------

def test_paths_are_the_best(spark):
    rng = np.random.default_rng(2)
    texts = [rng.normal(0, 3, (n, 3)).astype(np.float32) for n in (1, 2, 5, 6)]
    for scores, path in zip(texts, langid.viterbi_all(texts, 4.0)):
        def total(p):
            return sum(float(scores[i, x]) for i, x in enumerate(p)) - 4 * sum(a != b for a, b in zip(p, p[1:]))

        every = np.stack(np.meshgrid(*[range(3)] * len(scores))).reshape(len(scores), -1).T
        assert total(path.tolist()) == pytest.approx(max(total(p.tolist()) for p in every))
        one = langid.settled(scores, 4.0)
        assert one < 0 or (path == one).all()


def test_language_of_documents(spark):
    rows = queries.op6_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    train = [(i, "the house and the tree", "en") for i in range(5)] + [(9, "дом и дерево", "ru")] * 3 + [
        (7, None, "xx"), (8, "lost", None)]
    model = langid.train(frame(spark, train))
    assert model.languages == ["en", "ru"]
    rows = [(1, None, None), (2, "", None), (3, "12 ½ ...", None), (None, "дерево", "en"), (5, "tree", "ru"),
            (6, "the tree and house " * 5 + "дом и дерево " * 5, None), (7, "漢字", None), (8, "tree " * 30_000, None)]
    got = {r.doc_id: r for r in langid.label(frame(spark, rows), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, None, 5, 8)] == ["und", "und", "und", "ru", "en", "en"]
    assert [s.lang for s in got[6].spans] == ["en", "ru"] and got[7].lang_pred in ("en", "ru")
    assert all(0 <= r.score <= 1 for r in got.values())
    none = langid.train(frame(spark, train).limit(0))
    assert {r.lang_pred for r in langid.label(frame(spark, rows), none).collect()} == {"und"}
    assert langid.label(frame(spark, rows).limit(0), model).collect() == []
    assert {r.doc_id for r in langid.accepted(frame(spark, rows), model, 0.9).collect()} == {None, 5, 7, 8}


# --- tokens -------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    return path, Tokenizer.from_file(path)


def test_every_prefix(tokenizer):
    path, library = tokenizer
    counter = tokens.PrefixCounter(path)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "é", "ß", "中", "👍", "<|endoftext|>",
             "<|endo", "1", "99", "!", "---", "\u3000", "\x1c", "\x85", "don't", " \n ", "\u0301"]
    rnd = random.Random(3)
    for _ in range(250):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert counter.counts(text).tolist() == want, text


def test_counts_of_documents(spark, docs, tokenizer):
    path, library = tokenizer
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op9_tokens(spark, SMALL).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_token_questions(spark, tokenizer):
    path, library = tokenizer
    rows = [(1, "Hello wonderful world", None), (2, None, None), (None, "", None), (1, "x" * 40_000, None)]
    df = tokens.prefix_counts(frame(spark, rows), path)
    c = F.col("counts")
    got = df.select("doc_id", tokens.n_tokens(c).alias("n"), tokens.tokens_before(c, F.lit(5)).alias("five"),
                    tokens.chars_within(c, 2).alias("cut")).collect()
    assert (got[0].n, got[0].five, got[0].cut) == (3, 1, 15)
    assert got[1].n == got[2].n == 0 and got[1].cut == 0
    assert got[3].n == len(library.encode("x" * 40_000, add_special_tokens=False).ids)
    assert tokens.prefix_counts(frame(spark, rows).limit(0), path).collect() == []


# --- URLs ---------------------------------------------------------------------------------------

def test_urls(spark):
    rows = ["http://WWW.Example.com/en/1?x", "https://a.example.com/en/1", "http://b.net/es/4#t", "http://b.net/de/4",
            "http://notexample.com/en/", "http://example.com?en/", None, "", "no scheme/en", "http://b.net:80/fr/1",
            "ftp://x://y/z", "http://cheap-pills.example.org/buy", "http://www.library.org/books"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").withColumn("host", F.lit("clash"))
    model = urls.fit(urls.labelled_urls(spark))
    got = {r.page_id: r for r in urls.judge(df, model, queries.URL_RULES).collect()}
    assert [got[i].rule for i in range(6)] == [
        "www.example.com/en/", "example.com/en/", "net/es/", None, "com/", None]
    assert (got[0].host, got[0].path) == ("www.example.com", "/en/1") and (got[5].host, got[5].path) == (
        "example.com", "")
    assert all((got[i].host, got[i].path) == ("", "") for i in (6, 7, 8))
    assert got[9].rule is None and got[9].host == "b.net:80" and (got[10].host, got[10].path) == ("x:", "//y/z")
    assert (got[11].verdict, got[12].verdict) == ("block", "allow")
    assert urls.judge(df.limit(0), model, queries.URL_RULES).collect() == []


#: Hosts with no word of the training table, labelled by hand before the model was fitted to it.
UNSEEN_BLOCKED = """
oxycodone-overnight.test/shop hydrocodone-noscript.test/ kamagra-express.test/en/4 weightloss-miracle.test/trial
blackjack-vegas.test/table wager-king.test/odds/3 baccarat-live.test/ sportsbook-pro.test/lines bingo-palace.test/en/1
erotic-stories.test/read hentai-tube.test/v/9 milf-hookup.test/ swinger-dating.test/de/5 fetish-hd.test/
quick-lender.test/ debt-relief-fast.test/form giveaway-iphone.test/ millionaire-secret.test/en/7 forex-robot.test/
paypa1-verify.test/login account-suspended.test/update trojan-loader.test/a.exe ransom-unlock.test/ nulled-scripts.test/
adnxs-sync.test/px doubleserve.test/imp/2 pixel-beacon.test/ clickbait-feed.test/en/8 rankbooster.test/ doorway-pages.test/
"""
UNSEEN_ALLOWED = """
pottery-workshop.test/classes meteorology.test/en/12 beekeeping.test/ violin-lessons.test/fr/3 anthropology.test/people
observatory.test/visit gymnasium.test/ carpenter-tools.test/en/44 lighthouse.test/de/8 orchard-cider.test/
grammar-exercises.test/es/5 telescope.test/reviews/3 embassy.test/visa geology.test/rocks knitting.test/patterns/2
ferry-schedule.test/ democracy.test/vote-guide ceramics.test/glaze algebra.test/en/19 monastery.test/
veterinary.test/cats rowing-regatta.test/ typography.test/fonts/6 sailing.test/fr/77 archaeology.test/digs
nursery-rhymes.test/ locomotive.test/steam mushroom-id.test/en/31 translation.test/ kindergarten.test/
plumber-berlin.test/de/2 wedding-flowers.test/ astronomy.test/es/40 vineyard.test/tours electrician.test/
skiing.test/snow quilt.test/en/90 parish-records.test/ philosophy.test/kant aquarium.test/tickets
"""


def test_labelled_urls_are_not_those_of_the_pages(spark):
    known = [r.url for r in urls.labelled_urls(spark).collect()]
    part = lambda u: re.match(r"[^:]*://(?:(?:www|m|blog)[.])?([^./?#]*)[^/?#]*([^?#]*)", u or "")
    for name in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(SMALL.replace("sf0.001", name) + "/pages.parquet").select("url").collect()
        seen = [m for r in pages if (m := part(r.url))]
        assert not {part(u)[1] for u in known} & {m[1] for m in seen}
        assert not {part(u)[2] for u in known} & {m[2] for m in seen if m[2] not in ("", "/")}


def test_hosts_of_unseen_words(spark):
    words = set((urls.BLOCKED_WORDS + urls.ALLOWED_WORDS).split())
    rows = [(f"http://{u}", y) for y, t in ((1, UNSEEN_BLOCKED), (0, UNSEEN_ALLOWED)) for u in t.split()]
    for u, _ in rows:
        assert not set(re.split(r"[-.]", u[7:].split("/")[0])) & words
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(df, urls.fit(urls.labelled_urls(spark))).collect()}
    hit = Counter((got[i], y) for i, (_, y) in enumerate(rows))
    # README has the figures: spelling carries over to few unseen words.
    assert hit["allow", 0] >= 0.95 * len(UNSEEN_ALLOWED.split()) and hit["block", 1] >= 1


# --- the pipeline -------------------------------------------------------------------------------

def test_pipeline_against_its_operators(spark, docs):
    import corpus_pipeline as pipeline
    from tests.llm.test_pairs import brute_components, brute_contamination, brute_fingerprint

    kept = pipeline.language(spark, docs, SMALL).collect()
    assert len(kept) >= 0.98 * docs.count()
    unique = pipeline.near_duplicates(spark, docs, SMALL)
    rows = docs.collect()
    group = dict(zip([r.doc_id for r in rows], brute_components(
        [brute_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])))
    left = [group[r.doc_id] for r in unique.collect()]
    assert sorted(left) == sorted(set(group.values()))
    clean = {r.doc_id for r in pipeline.decontamination(spark, docs, SMALL).collect()}
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = brute_contamination([r.text for r in rows], bench)
    assert clean == {r.doc_id for r, (n, hit, _, _) in zip(rows, found) if not (hit and 20 * hit >= n)}
    assert pipeline.run(spark, SMALL).count() > 0


def test_rows_keep_their_names_when_a_rescan_is_split_differently(spark, docs, tmp_path):
    import corpus_pipeline as pipeline
    from ratingloom.llm import decontaminate

    path, split = f"{tmp_path}/docs", "spark.sql.files.maxPartitionBytes"
    docs.repartition(12).write.parquet(path)
    read = spark.read.parquet(path)
    usual = spark.conf.get(split)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    jobs = [lambda: pipeline.near_duplicates(spark, read, SMALL).select("doc_id"),
            lambda: pipeline.decontamination(spark, read, SMALL).select("doc_id"),
            lambda: decontaminate.contamination(read, bench)]
    for job in jobs:
        want = sorted(tuple(r) for r in job().collect())
        try:
            lazy = job()
            spark.conf.set(split, "4096")
            got = sorted(tuple(r) for r in lazy.collect())
        finally:
            spark.conf.set(split, usual)
        assert got == want


def test_training_sample_counts_copies_once(spark, docs):
    learned = docs.select("text", "lang")
    copied = learned.union(learned)
    once, twice = (langid.train(x, sample=10 ** 9) for x in (learned, copied))
    assert once.languages == twice.languages and (once.logp == twice.logp).all()


def test_pipeline_edges(spark, tmp_path):
    import corpus_pipeline as pipeline

    rows = [(1, "a b c d e f " * 20, "en", "s", 3), (1, "a b c d e f " * 20, "en", "s", 3),
            (None, "g h i j k l " * 20, "en", None, 3), (None, None, None, None, None), (4, "", "en", "s", 0),
            (1, "other words that share an id " * 9, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumn("row", F.lit(5)).withColumn("copies", F.lit("x"))
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for source, want in ((docs, [4, 3]), (docs.limit(0), [0, 0])):
        spark.catalog.clearCache()
        at, sizes = source, []
        for k, (_, stage) in enumerate(pipeline.STAGES):
            at.write.parquet(f"{tmp_path}/{want[0]}-{k}")
            read = spark.read.parquet(f"{tmp_path}/{want[0]}-{k}")
            at = stage(spark, read, str(tmp_path))
            if k < len(pipeline.STAGES) - 1:
                assert at.columns == docs.columns
            sizes.append(at.count())
        assert sizes[:2] == want
