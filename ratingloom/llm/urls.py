"""URL filter: logistic regression on hashed character n-grams of host and path.

The model is fitted on a small labelled table of URLs and applied as Spark expressions, so a
scan reads nothing but the URL column.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Host words and paths of the labelled URLs, by what blocklists call unwanted
#: (drugs, gambling, adult, loans and prizes, fraud and malware, adverts, link spam) and by
#: everyday subjects. README says how they were chosen; no URL is taken from a page.
BLOCKED_WORDS = """
pills pharmacy viagra cialis meds steroids tablets rx  casino poker slots roulette betting bets
jackpot gambling  porn xxx sex adult escort nude cams webcam  loans payday credit cash prize win
winner lottery bonus  phishing malware crack warez keygen torrent hacked serial  ads adserver
clicks popup banner tracking tracker affiliate  spam backlinks seo linkfarm traffic cheap free
discount replica
"""
BLOCKED_PATHS = """
/buy /order/now /play/{n} /bonus /join /watch/{n} /claim /apply /download/{n} /click /banner/{n}
/redirect /free /offer/{n}
"""
ALLOWED_WORDS = """
library museum university school college academy research science physics chemistry biology
mathematics history geography language poetry literature novel author press  news daily herald
times journal gazette weather forecast radio review  garden nature forest river mountain birds
farm fishing hiking  recipes bread kitchen bakery coffee vegetable dinner  music orchestra theatre
gallery painting cinema dance photo  city council parliament court police hospital health clinic
dentist doctor  software python docs guide manual forum wiki archive data computer network
transport railway airport bicycle cars travel hotel island  football tennis chess swimming running
family children toys books shop market furniture fashion  bank insurance law office energy
building engineering steel house  church charity society community village club blog notes
"""
ALLOWED_PATHS = """
/about /article/{n} /news/story /contact /archive/{n} /help /catalogue /lessons /authors/{n}
"""
#: Under hosts of either kind, three of four URLs: a plain path tells nothing about its host.
PLAIN_PATHS = """
/ /{n} /{n}.html /index.html /page/{n} /item/{n} /p/{n}/ /view /id/{n} /list /a/{n}.htm
"""
#: Hosts of each word: with the words so many places further on, so each word is in ten URLs.
STEPS = (1, 3, 7, 12, 20)

#: Parts of a URL: host after the first "://", then the path.
AFTER = r"(?s)^.*?://"


def composed(words: str, paths: str) -> list[str]:
    """URLs of two words each under a reserved domain, with the paths in turn."""
    words, paths, plain, found = words.split(), paths.split(), PLAIN_PATHS.split(), []
    for step in STEPS:
        for i, word in enumerate(words):
            n = len(found)
            name = word + ("-", "")[n % 2] + words[(i + step) % len(words)]
            at = plain[n % len(plain)] if n % 4 else paths[n // 4 % len(paths)]
            found.append(f"http://{name}.test" + at.format(n=n))
    return found


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: URLs made of the words above, 1 for those to block."""
    rows = [(u, 1.0) for u in composed(BLOCKED_WORDS, BLOCKED_PATHS)]
    rows += [(u, 0.0) for u in composed(ALLOWED_WORDS, ALLOWED_PATHS)]
    return spark.createDataFrame(rows, "url string, label double")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    rest = F.regexp_replace(url, AFTER, "")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.coalesce(url, F.lit("")).contains("://"),
                  F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)).otherwise("")


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.regexp_replace(url, AFTER, "")
    return F.when(F.coalesce(url, F.lit("")).contains("://"),
                  F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def grams(url: str, low: int, high: int) -> str:
    """SQL for the character n-grams of host and path, told apart by a prefix.

    The registered domain's last label and leading ``www.`` say little and are left out; digits
    count as one character.
    """
    parts = []
    for mark, text in (("h", f"regexp_replace(regexp_replace(host, '^www[.]', ''), '[.][^.]*$', '')"),
                       ("p", "path")):
        clean = f"concat('^', regexp_replace(lower({text}), '[0-9]+', '0'), '$')"
        for n in range(low, high + 1):
            parts.append(
                f"transform(filter(sequence(1, greatest(length({clean}) - {n - 1}, 1)),"
                f" i -> length({clean}) >= {n}),"
                f" i -> concat('{mark}', substr({clean}, i, {n})))")
    return f"array_distinct(concat({', '.join(parts)}))"


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", low: int = 3,
        high: int = 5, features: int = 1 << 16, regularisation: float = 0.01) -> PipelineModel:
    """A model from labelled URLs (1 to block); adds ``host``, ``path`` and ``blocked_p``.

    Rows without a label are left out; a null URL has no n-grams. The table is meant to be
    small; fitting runs on Spark all the same.
    """
    prepare = SQLTransformer(statement=f"SELECT *, {grams(url_col, low, high)} AS grams FROM __THIS__")
    hashing = HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features")
    rows = labelled.select(F.col(label_col).cast("double").alias("label"),
                           host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")
                           ).filter("label IS NOT NULL")
    rows = hashing.transform(prepare.transform(rows))
    model = LogisticRegression(regParam=regularisation, maxIter=100, standardization=False,
                               probabilityCol="probability").fit(rows)
    return PipelineModel([prepare, hashing, model])


def matching_rule(host_col: Column, path_col: Column,
                  rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule ``(host, path, verdict)`` that fits, as ``struct(rule, verdict)``, or null.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules equally
    long the smallest string wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = (),
          id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``id_col, host, path, rule, verdict, blocked_p`` for every row of ``pages``.

    The longest rule decides; without one the model blocks from ``threshold`` on. A null URL, or
    one without ``://``, has an empty host and path. Repeated rows are judged alike; an empty
    table gives an empty result.
    """
    parts = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                         path(F.col(url_col)).alias("path"))
    scored = model.transform(parts)
    from pyspark.ml.functions import vector_to_array

    blocked = F.element_at(vector_to_array("probability"), 2)
    rule = matching_rule(F.col("host"), F.col("path"), list(rules))
    return (scored.select("id", "host", "path", blocked.alias("blocked_p"), rule.alias("hit"))
            .select(F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.verdict", F.when(F.col("blocked_p") >= threshold, "block")
                               .otherwise("allow")).alias("verdict"), "blocked_p"))
