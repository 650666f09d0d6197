"""Tag features, dimension reduction, feature selection."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import features, reduce, scale, tags
from ratingloom.plans.registry import query


@query("tag_stats", """
SELECT "movieId", count(*) AS total_tags, count(DISTINCT tag_clean) AS unique_tags,
       count(DISTINCT "userId") AS users_who_tagged,
       count(DISTINCT tag_clean) / CAST(count(*) AS DOUBLE) AS tag_diversity
FROM clean_tags GROUP BY 1
""", "tag_diversity")
def tag_stats(star):
    return tags.tag_stats(star.clean_tags)


@query("tag_documents", """
SELECT m."movieId", t.position, coalesce(tag_clean, '') AS tag_clean
FROM movies m LEFT JOIN (
  SELECT "movieId", tag_clean, row_number() OVER (PARTITION BY "movieId"
           ORDER BY ts, "userId", tag_clean) - 1 AS position FROM clean_tags) AS t
USING ("movieId")
""")
def tag_documents(star):
    return tags.tag_documents(star.clean_tags, star.movies)


DOCS = """
docs AS (SELECT m."movieId", regexp_extract_all(coalesce(string_agg(tag_clean, ' '
                  ORDER BY ts, "userId", tag_clean), ''), '\\b\\w\\w+\\b') AS tokens
         FROM movies m LEFT JOIN clean_tags t USING ("movieId") GROUP BY 1),
uni AS (SELECT "movieId", unnest(tokens) AS term FROM docs)"""
TFIDF = DOCS + """,
bi AS (SELECT "movieId", unnest(list_transform(range(1, len(tokens)),
              lambda i: tokens[i] || ' ' || tokens[i + 1])) AS term FROM docs),
counts AS (SELECT "movieId", term, count(*) AS n
           FROM (SELECT * FROM uni UNION ALL SELECT * FROM bi) AS u GROUP BY 1, 2),
size AS (SELECT count(*) AS n_docs FROM docs),
vocab AS (SELECT term, count(*) AS df FROM counts, size GROUP BY term
          HAVING count(*) >= 5 AND count(*) <= 0.7 * any_value(n_docs)
          ORDER BY sum(n) DESC, term LIMIT 100),
kept AS (SELECT term FROM vocab ORDER BY term LIMIT 50),
raw AS (SELECT "movieId", term, n * (ln((1 + n_docs) / CAST(1 + df AS DOUBLE)) + 1) AS w
        FROM counts JOIN vocab USING (term), size),
norm AS (SELECT "movieId", sqrt(sum(w * w)) AS l FROM raw GROUP BY 1)
"""


@query("tfidf_tags", "WITH " + TFIDF + """
SELECT "movieId", term, w / l AS weight FROM raw JOIN norm USING ("movieId")
WHERE term IN (SELECT term FROM kept)
""", "weight")
def tfidf_tags(star):
    return tags.tfidf_tags(star.clean_tags, star.movies)


@query("user_tag_prefs", "WITH " + DOCS + """,
counts AS (SELECT "movieId", term, count(*) AS n FROM uni GROUP BY 1, 2),
liked AS (SELECT "userId", "movieId" FROM ratings WHERE rating >= 4),
size AS (SELECT count(*) AS n_docs FROM liked),
vocab AS (SELECT term, count(*) AS df FROM liked JOIN counts USING ("movieId") GROUP BY 1
          HAVING count(*) >= 2 ORDER BY sum(n) DESC, term LIMIT 50),
tf AS (SELECT "userId", term, sum(n) AS n FROM liked JOIN counts USING ("movieId")
       JOIN vocab USING (term) GROUP BY 1, 2),
raw AS (SELECT "userId", term, n * (ln((1 + n_docs) / CAST(1 + df AS DOUBLE)) + 1) AS w
        FROM tf JOIN vocab USING (term), size),
norm AS (SELECT "userId", sqrt(sum(w * w)) AS l FROM raw GROUP BY 1)
SELECT "userId", term, w / l AS weight FROM raw JOIN norm USING ("userId")
""", "weight")
def user_tag_prefs(star):
    return tags.user_tag_prefs(star.ratings, star.clean_tags)


def _words(words):
    return " + ".join(f"max(CAST(contains(doc, '{w}') AS INTEGER))" for w in words)


@query("tag_sentiment", f"""
WITH d AS (SELECT m."movieId", coalesce(string_agg(tag_clean, ' '), '') AS doc
           FROM movies m LEFT JOIN clean_tags USING ("movieId") GROUP BY 1),
s AS (SELECT "movieId", {_words(tags.POSITIVE_WORDS)} AS p, {_words(tags.NEGATIVE_WORDS)} AS n
      FROM d GROUP BY 1)
SELECT "movieId", CAST(p AS INTEGER) AS positive_score, CAST(n AS INTEGER) AS negative_score,
       (p - n) / CAST(p + n + 1 AS DOUBLE) AS sentiment_ratio FROM s
""", "sentiment_ratio")
def tag_sentiment(star):
    return tags.tag_sentiment(star.clean_tags, star.movies)


@query("tag_frequency_pivot", """
WITH top AS (SELECT tag FROM tags WHERE tag IS NOT NULL GROUP BY 1
             ORDER BY count(*) DESC, tag LIMIT 50),
items AS (SELECT DISTINCT "movieId" FROM tags WHERE tag IS NOT NULL)
SELECT i."movieId", 'tag_' || top.tag AS tag, count(t."movieId") AS n
FROM items i CROSS JOIN top LEFT JOIN tags t ON t."movieId" = i."movieId" AND t.tag = top.tag
GROUP BY 1, 2
""")
def tag_frequency_pivot(star):
    wide = tags.tag_frequency_pivot(star.tags)
    return wide.unpivot("movieId", [f"`{c}`" for c in wide.columns[1:]], "tag", "n")


@query("topic_model", """
SELECT "movieId", 10 AS topics, CAST(1 AS DOUBLE) AS total, true AS in_range FROM movies
""", "total")
def topic_model(star):
    """The shares of all ten topics in every item: what SQL knows is that they are shares."""
    wide = tags.topic_model(star.clean_tags, star.movies)
    shares = F.array(*[c for c in wide.columns if c.startswith("topic_")])
    return wide.select(
        "movieId", F.size(shares).alias("topics"),
        F.aggregate(shares, F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.forall(shares, lambda x: x.between(0, 1)).alias("in_range"))


# --- reduction and selection ------------------------------------------------------------------

USERS = """
WITH u AS (SELECT "userId", avg(rating) AS a, coalesce(stddev_samp(rating), 0) AS b,
                  CAST(count(*) AS DOUBLE) AS c FROM ratings GROUP BY 1)
"""


def user_table(star):
    return stage(features.user_statistics(star.ratings).select(
        "userId", F.col("rating_mean").alias("a"), F.col("rating_std").alias("b"),
        F.col("rating_count").cast("double").alias("c"),
    ))


@query("pca", USERS + """,
m AS (SELECT avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb,
             covar_pop(a, b) AS cab FROM u),
e AS (SELECT *, (va + vb) / 2 + sqrt(((va - vb) / 2) ** 2 + cab ** 2) AS l1,
             (va + vb) / 2 - sqrt(((va - vb) / 2) ** 2 + cab ** 2) AS l2 FROM m),
v AS (SELECT *, cab / sqrt(cab ** 2 + (l1 - va) ** 2) AS x1,
             (l1 - va) / sqrt(cab ** 2 + (l1 - va) ** 2) AS y1,
             cab / sqrt(cab ** 2 + (l2 - va) ** 2) AS x2,
             (l2 - va) / sqrt(cab ** 2 + (l2 - va) ** 2) AS y2 FROM e)
SELECT "userId",
       ((a - ma) * x1 + (b - mb) * y1)
         * sign(CASE WHEN abs(x1) >= abs(y1) THEN x1 ELSE y1 END) AS pc1,
       ((a - ma) * x2 + (b - mb) * y2)
         * sign(CASE WHEN abs(x2) >= abs(y2) THEN x2 ELSE y2 END) AS pc2
FROM u, v
""", "pc1 pc2")
def pca(star):
    scores, _ = reduce.pca(user_table(star), ["a", "b"], k=2)
    return scores.select("userId", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


@query("pca_report", USERS + """,
m AS (SELECT var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS cab FROM u),
e AS (SELECT va + vb AS total, (va + vb) / 2 + sqrt(((va - vb) / 2) ** 2 + cab ** 2) AS l1
      FROM m)
SELECT 'PC1' AS component, l1 / total AS explained_variance_ratio,
       l1 / total AS cumulative_variance FROM e
UNION ALL SELECT 'PC2', 1 - l1 / total, 1 FROM e
""", "explained_variance_ratio cumulative_variance")
def pca_report(star):
    return reduce.pca(user_table(star), ["a", "b"], k=2)[1]


@query("pca_embeddings", """
WITH e AS (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT (SELECT count(*) FROM embeddings) AS n, sum(s) AS total_variance, true AS centred,
       true AS uncorrelated, true AS reached, true AS needed
FROM (SELECT var_pop(CAST(v AS DOUBLE)) AS s FROM e GROUP BY i) AS d
""", "total_variance")
def pca_embeddings(star):
    """As many components of the embeddings as reach 95 % of the variance, by their properties:
    centred, uncorrelated, of the variance the report claims, none too many."""
    scores, report = reduce.pca(star.table("embeddings"), vector="embedding")
    shares = [r["cumulative_variance"] for r in report.collect()]
    last = shares[-2] if len(shares) > 1 else 0.0
    rows = stage(scores.select("pc"))
    # components x components numbers
    corr = Correlation.corr(rows.select(array_to_vector("pc").alias("x")), "x").first()[0].toArray()
    apart = bool((np.abs(corr - np.eye(len(shares))) < 1e-6).all())
    kept = rows.select(F.posexplode("pc").alias("i", "v")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    return kept.agg(
        F.max("n").alias("n"), (F.sum("s") / F.lit(shares[-1])).alias("total_variance"),
        (F.max(F.abs("m")) < 1e-6).alias("centred"), F.lit(apart).alias("uncorrelated"),
        F.lit(shares[-1] >= 0.95).alias("reached"), F.lit(last < 0.95).alias("needed"))


@query("truncated_svd", USERS + """,
p AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM u),
z AS (SELECT "userId", (a - ma) / sa AS x, (b - mb) / sb AS y FROM u, p),
c AS (SELECT sign(corr(x, y)) AS s FROM z)
SELECT "userId", (x + s * y) / sqrt(2) AS score FROM z, c
""", "score")
def truncated_svd(star):
    scaled = scale.scale_standard(user_table(star), ["a", "b"])
    out, _ = reduce.truncated_svd(scaled, ["a_scaled", "b_scaled"], k=1)
    return out.select("userId", F.col("svd")[0].alias("score"))


@query("select_k_best", USERS + """
, f AS (SELECT 'b' AS feature, corr(b, a) AS r, count(*) AS n FROM u
        UNION ALL SELECT 'c', corr(c, a), count(*) FROM u),
best AS (SELECT feature FROM f ORDER BY r * r DESC, feature LIMIT 1)
SELECT "userId", a, CASE WHEN (SELECT feature FROM best) = 'b' THEN b ELSE c END AS selected,
       (SELECT max(r * r / (1 - r * r) * (n - 2)) FROM f) AS f_score
FROM u
""", "a selected f_score")
def select_k_best(star):
    users = user_table(star)
    scores = reduce.f_regression(users, ["b", "c"], "a")
    best = reduce.select_k_best(users, ["b", "c"], "a")
    (name,) = [c for c in best.columns if c in ("b", "c")]
    return best.withColumnRenamed(name, "selected").withColumn(
        "f_score", scores.agg(F.max("f_score")).scalar())
