"""One registered query per operator, with check SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import (
    audit, decontaminate, html, jaccard, langid, mixing, phrases, quality, sharding, simhash, tokens,
    urls, windows,
)

SHARDS = 40
TOKEN_LIMIT = 512
TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op3_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    return windows.repeated_passages(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    key = F.col("doc_id")
    return langid.label(docs, model).select(
        "doc_id", langid.held_out(key).alias("held_out"), "lang_pred", "score", "spans")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"),
                                        table(spark, folder, "benchmark"))
    return found.withColumn("contaminated", contaminated())


def contaminated():
    """Any word hit, and a twentieth of all."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op8_slots(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(table(spark, folder, "documents"), SHARDS)


def op9_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.prefix_counts(table(spark, folder, "documents"),
                                   public_tokenizers.path(TOKENIZER))
    n = tokens.n_tokens(F.col("counts")).cast("long")
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"),
                          (n > TOKEN_LIMIT).alias("over_limit"))


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.fit(urls.labelled_urls(spark)), URL_RULES)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash, op2_quality, op3_mix, op4_html, op5_passages, op6_language, op7_decontaminate, op8_slots, op9_tokens, op10_urls,
        op11_phrases, op12_audit, op13_jaccard)
}

ORACLES: dict[str, str] = {
    "op3_mix": r"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '?' || text, '')), 1, 13))::BIGINT
          ::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight,
         source_size * 3.0::DOUBLE AS top
  FROM sizes),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sizes)
             - coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY top / weight, source ASC NULLS LAST)),
shares AS (
  SELECT source, source_size,
         CASE WHEN top <= weight * level THEN top
              ELSE weight * max(level) FILTER (top > weight * level) OVER () END AS target
  FROM levels),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM shares),
ranked AS (
  SELECT r.*, p.source_size, p.target, floor(p.ratio) AS whole, p.ratio - floor(p.ratio) AS part,
         p.target - floor(p.ratio) * p.source_size AS budget
  FROM rows r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source),
filled AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY
         (u / (1 - u)) / (part / (1 - part)), size, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
  FROM ranked WHERE size > 0 AND part > 0),
taken AS (
  SELECT f.*, (filled - size / 2.0::DOUBLE <= budget)::INT AS extra FROM filled f
  UNION ALL
  SELECT r.*, 0, 0 FROM ranked r WHERE NOT (size > 0 AND part > 0))
SELECT doc_id, size, source_size, target, (whole + extra)::INTEGER AS copies,
       ((whole + extra) * size)::BIGINT AS taken
FROM taken
""",
    "op11_phrases": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k)),
found AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT f.lang, f.phrase, f.a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM found WHERE k > 1) f, (SELECT unnest([1, 2, 3]) AS cut)
  WHERE cut < k),
scores AS (
  SELECT c.*, l.a AS l, r.a AS r, ((2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a))::BIGINT AS score
  FROM cuts c JOIN found l ON l.lang = c.lang AND l.phrase = c.first
  JOIN found r ON r.lang = c.lang AND r.phrase = c.rest),
worst AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS top FROM (
    SELECT lang, a, unnest([array_to_string(w[i:i + s - 1], ' ') FOR i IN range(1, k - s + 2)]) AS phrase
    FROM (SELECT *, string_split(phrase, ' ') AS w FROM found WHERE k > 2), (SELECT unnest([2, 3]) AS s)
    WHERE s < k) GROUP BY ALL),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN inner_ i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.top IS NULL OR 100::HUGEINT * i.top < 80::HUGEINT * w.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, score
FROM kept k JOIN sizes s ON s.lang = k.lang
QUALIFY rank <= 2000
""",
    "op12_audit": r"""
WITH filters AS (SELECT unnest(['A','B','C','D','E']) AS f, unnest([1,2,4,8,16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f,
         (SELECT bit FROM filters WHERE f = substr(filter_order, step, 1)) AS bit,
         coalesce((SELECT sum(bit) FROM filters
                   WHERE contains(substr(filter_order, 1, step - 1), f)), 0)::INTEGER AS before
  FROM orders, (SELECT unnest([1,2,3,4,5]) AS step)),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(d.doc_id > first, false)::INT AS mask
  FROM firsts d LEFT JOIN marks m ON d.doc_id = m.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM counted
""",
}
