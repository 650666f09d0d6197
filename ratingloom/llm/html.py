"""Main text of web pages, with a style tree for each site.

The pages of a host are merged into one tree of elements, named by their path. An element is
important if it is laid out differently from page to page (entropy of its styles, the sequences
of its children) and if what stands in it differs (one minus the mean entropy of its contents
over the pages); the importance of a branch combines both from the leaves up. Branches of low
importance are taken from every page of the host.

Entropy alone can't tell an advert whose words are new on every page from an article, nor
anything on a host with few pages. So branches that name themselves a menu, header, footer,
advert, form, comment and so on have no importance on any host, and on pages that mark their
article nothing outside of it has.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.llm.urls import host

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|textarea|title|svg|math|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z!?/][^>]*(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q"
    " ruby rt rp s samp small span strike strong sub sup time tt u var wbr img br".split())
#: Elements that end where the next of their kind, or their parent's end, comes.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
          "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
          "option": {"option"}}

#: Elements that are no part of an article, and words in class, id or role that say so.
ASIDE = frozenset("nav footer aside form button select menu dialog head".split())
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside widget widgets"
    " ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie"
    " cookies consent gdpr notice notices newsletter subscribe signup popup modal overlay share"
    " sharing social related recommended comment comments disqus reply replies respond form login"
    " search pagination pager toolbar contentinfo complementary copyright".split())
#: The same outside an article; inside they hold its title.
HEAD_NAMES = frozenset("header masthead banner topbar".split())

DEPTH = 24
GAMMA = 0.9


class Node:
    """An open element: its path's number, its name, and what it is part of."""

    __slots__ = ("tag", "path", "key", "parent", "aside", "article", "main", "children")

    def __init__(self, tag: str, names: str, parent: "Node | None"):
        self.tag, self.parent, self.children = tag, parent, []
        self.aside = self.article = self.main = False
        self.path, self.key = "", 0
        if parent is None:
            return
        self.aside, self.article, self.main = parent.aside, parent.article, parent.main
        words = set(re.split(r"[^a-z]+", names.lower())) if names else ()
        if tag == "article" or "articlebody" in words:
            self.article = True
        elif tag == "main" or "main" in words and tag != "html":
            self.main = True
        if tag in ASIDE or words and tag not in ("html", "body", "article", "main") \
                and not ASIDE_NAMES.isdisjoint(words):
            self.aside = True
        elif not (self.article or self.main) and (
                tag == "header" or words and not HEAD_NAMES.isdisjoint(words)):
            self.aside = True
        elif words and tag == "article" and not words.isdisjoint(("comment", "reply")):
            self.aside = True
        label = tag + "." + re.sub(r"\d+", "0", names.strip().lower()) if names else tag
        if parent.path.count("/") < DEPTH:
            self.path = f"{parent.path}/{label}"
            self.key = xxhash.xxh64_intdigest(self.path) >> 1
        else:
            self.path, self.key = parent.path, parent.key
        parent.children.append(label)


def parse(page: str) -> tuple[list[tuple[str, Node]], list[Node]]:
    """Blocks of text with the element each stands in, and all block elements, in page order."""
    root = Node("", "", None)
    open_nodes, nodes, blocks = [root], [], []
    buffer: list[str] = []

    def flush():
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                blocks.append((text, open_nodes[-1]))
            buffer.clear()

    at = 0
    for token in TOKEN.finditer(page):
        a, b = token.span()
        if a > at:
            buffer.append(page[at:a])
        at = b
        raw, closing, tag, attributes = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                buffer.append(" ")
            continue
        flush()
        if closing:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag == tag:
                    del open_nodes[i:]
                    break
        else:
            ends = CLOSES.get(tag, {"p"})
            while open_nodes[-1].tag in ends:
                open_nodes.pop()
            if tag == "body":
                while open_nodes[-1].tag == "head":
                    open_nodes.pop()
            names = " ".join(x or y or z for x, y, z in NAMED.findall(attributes)) if attributes else ""
            node = Node(tag, names, open_nodes[-1])
            nodes.append(node)
            if tag not in VOID and not attributes.endswith("/"):
                open_nodes.append(node)
    if at < len(page):
        buffer.append(page[at:])
    flush()
    return blocks, nodes


def main_blocks(page: str | None, removed: set[int] = frozenset()) -> list[str]:
    """The article's blocks; ``removed`` has the elements of no importance on this host."""
    if not page:
        return []
    blocks, _ = parse(page)
    good = [(t, n) for t, n in blocks if not n.aside]
    if removed:
        good = [(t, n) for t, n in good if not _inside(n, removed)]
    for kind in ("article", "main"):
        inside = [t for t, n in good if getattr(n, kind)]
        if inside:
            return inside
    return [t for t, _ in good]


def _inside(node: Node | None, removed: set[int]) -> bool:
    while node is not None:
        if node.key in removed:
            return True
        node = node.parent
    return False


STATS = "host string, node long, parent long, kind int, value long, n long, s double, chars long"


def style_counts(pages: DataFrame) -> DataFrame:
    """Of ``pages(host, html)``: for each host and element the pages it is on, its styles (pages
    by sequence of children) and contents (occurrences by block, and the sum of n ln n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list] = {}
        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                if (page := page.as_py()):
                    count(name, page, total)
                if len(total) > 300_000:
                    yield rows(total)
        yield rows(total)

    def count(name: str, page: str, total: dict) -> None:
        blocks, nodes = parse(page)
        seen: dict[tuple, int] = {}
        size: dict[tuple, int] = {}
        for node in nodes:
            if node.aside:
                continue
            runs = [c for i, c in enumerate(node.children) if not i or c != node.children[i - 1]]
            style = xxhash.xxh64_intdigest("|".join(runs)) >> 1
            above = node.parent.key
            seen[node.key, above, 0, 0] = 1
            seen[node.key, above, 1, style] = 1
        for text, node in blocks:
            if not node.aside and node.parent is not None:
                key = node.key, node.parent.key, 2, xxhash.xxh64_intdigest(text) >> 1
                seen[key] = seen.get(key, 0) + 1
                size[key] = size.get(key, 0) + len(text)
        for key, n in seen.items():
            own = total.setdefault((name, *key), [0, 0.0, 0])
            own[0] += n
            own[1] += n * np.log(n) if n > 1 else 0.0
            own[2] += size.get(key, 0)

    def rows(total: dict) -> pa.RecordBatch:
        out = [(*k, *v) for k, v in total.items()]
        total.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                 pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 8, kinds)],
            [x.split()[0] for x in STATS.split(", ")])

    return (pages.mapInArrow(run, STATS).groupBy("host", "node", "parent", "kind", "value")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("chars").alias("chars")))


def style_tree(counts: DataFrame) -> DataFrame:
    """``(host, node, parent, pages, layout, contents, chars)``: entropies of each element.

    ``layout`` is 1 for an element of one page; ``contents`` is null without text of its own.
    """
    pages = F.sum(F.when(F.col("kind") == 0, F.col("n")))
    n = F.col("n").cast("double")
    per_node = counts.groupBy("host", "node", "parent").agg(
        pages.alias("pages"),
        F.sum(F.when(F.col("kind") == 1, n * F.log(n))).alias("styles"),
        F.sum(F.when(F.col("kind") == 2, F.log(n) - F.col("s") / n)).alias("entropy"),
        F.sum(F.when(F.col("kind") == 2, 1)).alias("blocks"), F.sum("chars").alias("chars"))
    scale = F.log(F.col("pages").cast("double"))
    return per_node.select(
        "host", "node", "parent", "pages",
        F.when(F.col("pages") <= 1, 1.0).otherwise(1 - F.col("styles") / (F.col("pages") * scale))
        .alias("layout"),
        F.when(F.col("blocks").isNotNull(), F.when(F.col("pages") <= 1, 1.0).otherwise(
            F.greatest(F.lit(0.0), 1 - F.col("entropy") / scale / F.col("blocks")))).alias("contents"),
        "chars")


def unimportant(tree: DataFrame, threshold: float, least_pages: int) -> DataFrame:
    """``(host, removed array<long>)``: elements whose branch is below ``threshold``.

    Not below ``least_pages`` pages, not those that hold a third of the host's text, and not on
    hosts whose pages are so alike that their whole text has no importance.
    """

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        children: dict[int, list[int]] = {}
        for i, parent in enumerate(rows["parent"]):
            children.setdefault(parent, []).append(i)
        layout, contents = rows["layout"].to_numpy(), rows["contents"].to_numpy(dtype=float)
        pages, chars = rows["pages"].to_numpy(), rows["chars"].to_numpy(dtype=float)
        keys = rows["node"].tolist()
        value, text = np.full(len(rows), np.nan), np.zeros(len(rows))

        def branch(i: int, depth: int) -> None:
            own = [c for c in children.get(keys[i], []) if keys[c] != keys[i]] if depth <= DEPTH + 2 else []
            for c in own:
                branch(c, depth + 1)
            text[i] = chars[i] + sum(text[c] for c in own)
            below = [(value[c], pages[c]) for c in own]
            if not np.isnan(contents[i]):
                below.append((contents[i], pages[i]))
            below = [(v, w) for v, w in below if not np.isnan(v)]
            inner = sum(v * w for v, w in below) / sum(w for _, w in below) if below else np.nan
            weight = GAMMA ** max(len(own), 0 if np.isnan(contents[i]) else 1)
            value[i] = inner if not own else (1 - weight) * layout[i] + weight * inner

        for i, parent in enumerate(rows["parent"]):
            if parent == 0:
                branch(i, 0)
        whole = chars.sum()
        leaf = ~np.isnan(contents)
        varied = whole > 0 and (contents[leaf] * chars[leaf]).sum() / whole >= 0.5
        low = (value < threshold) & (pages >= least_pages) & (text < whole / 3)
        removed = [k for k, out in zip(keys, low) if out] if varied else []
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "removed": [removed]})

    return (tree.groupBy("host").applyInPandas(compose, "host string, removed array<long>")
            .filter(F.size("removed") > 0))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = 0.2, least_pages: int = 10) -> DataFrame:
    """``id_col, url_col, text, n_chars, n_blocks`` for every row of ``pages``.

    ``text`` has the blocks of the article in page order, one to a line, character references
    decoded and white space within a block turned into single spaces. A null or empty page has an
    empty text; pages without a host share one tree. Repeated rows come back as often as they are
    given; an empty table gives an empty result.
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"),
                          host(F.col(url_col)).alias("host"))
    kind, url_kind = (source.schema[c].dataType.simpleString() for c in ("id", "url"))
    # One row for each host with something to remove: Spark broadcasts it while it is small.
    removed = stage(unimportant(style_tree(style_counts(source.select("host", "html"))),
                                threshold, least_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_blocks(page.as_py(), set(out or ()))
                     for page, out in zip(batch.column(2), batch.column(3).to_pylist())]
            texts = ["\n".join(b) for b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(b) for b in found], pa.int32())],
                ["id", "url", "text", "n_chars", "n_blocks"])

    return (source.join(removed, "host", "left").select("id", "url", "html", "removed")
            .mapInArrow(run, f"id {kind}, url {url_kind}, text string, n_chars long, n_blocks int")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
