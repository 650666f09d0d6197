"""Classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, classify, features, genres, matrix
from ratingloom.plans.q_regress import SCALED, split
from ratingloom.operators.nearest import pivot_nearest
from ratingloom.plans.registry import query

HASHED = """
hashed AS (SELECT *, CAST(rating >= 4 AS INTEGER) AS label,
           ("userId" % 2147483648 * 2654435761 + "movieId" % 2147483648 * 40503) % 4294967296
             < 3435973836 AS inside FROM ratings)"""


@query("class_distribution", "WITH " + HASHED + """
SELECT CASE WHEN inside THEN 'train' ELSE 'test' END AS part, label, count(*) AS n,
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY inside) AS DOUBLE) AS share
FROM hashed GROUP BY inside, label
""", "share")
def class_distribution(star):
    train, test = cf.train_test_split(
        matrix.with_label(star.ratings, "classification"), ["userId", "movieId"])
    return classify.class_distribution(train, test)


def minority_table(star):
    """Users with four behaviour features; the label marks the smaller class."""
    behavior = features.user_behavior(star.ratings)
    return stage(behavior.select(
        "userId", "avg_rating", "rating_std", "positive_ratio", "negative_ratio",
        (F.col("userId") % 5 == 0).cast("int").alias("label")))


BEHAVIOR = ["avg_rating", "rating_std", "positive_ratio", "negative_ratio"]


@query("smote_oversample", """
WITH u AS (SELECT "userId", CAST("userId" % 5 = 0 AS INTEGER) AS label FROM ratings GROUP BY 1),
c AS (SELECT label, count(*) AS n FROM u GROUP BY 1)
SELECT label, max(n) OVER () AS n, n AS originals FROM c
""")
def smote_oversample(star):
    balanced = classify.smote_oversample(minority_table(star), BEHAVIOR, "userId")
    return balanced.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                         F.count("userId").alias("originals"))


@query("nearest_users", """
WITH u AS MATERIALIZED (
  SELECT "userId", avg(rating) AS a, coalesce(stddev_samp(rating), 0) AS b,
         avg(CAST(rating >= 4 AS INTEGER)) AS c, avg(CAST(rating <= 2 AS INTEGER)) AS d
  FROM ratings GROUP BY 1),
p AS (SELECT x."userId" AS id, y."userId" AS neighbor,
             sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2 + (x.c - y.c) ** 2 + (x.d - y.d) ** 2) AS e
      FROM u x JOIN u y ON x."userId" <> y."userId")
SELECT id, neighbor, CAST(row_number() OVER (PARTITION BY id ORDER BY round(e, 9), neighbor)
                          AS INTEGER) AS place
FROM p QUALIFY place <= 5
""")
def nearest_users(star):
    """The five users nearest to each by behaviour, as oversampling looks for them."""
    behavior = features.user_behavior(star.ratings)
    return pivot_nearest(behavior.select(
        F.col("userId").alias("id"), F.array(*BEHAVIOR).alias("x")), 5)[0]


def classifier_rows(star):
    train, test = split(star)

    def labelled(df):
        return df.select("userId", "movieId", *SCALED,
                         F.monotonically_increasing_id().alias("row"),
                         (F.col("rating") >= 4).cast("int").alias("label"))

    return stage(labelled(train)), stage(labelled(test))


@query("train_classifiers", "WITH " + HASHED + """
SELECT model, count(*) FILTER (WHERE label = 1) AS positives,
       count(*) FILTER (WHERE label = 0) AS negatives, true AS in_range
FROM hashed, unnest(['logistic', 'random_forest', 'gradient_boost', 'svm', 'mlp']) AS m(model)
WHERE NOT inside GROUP BY model
""")
def train_classifiers(star):
    """Every model scores every test row once: the totals of the confusion tables."""
    train, test = classifier_rows(star)
    _, scored = classify.train_classifiers(train, test, SCALED, "row", trees=20, rounds=10,
                                           iterations=50)
    return totals(classify.binary_metrics(scored, ["model"]), "model")


def totals(metrics, by):
    rates = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1_score")]
    return metrics.select(
        by, (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("fp") + F.col("tn")).alias("negatives"),
        (rates[0] & rates[1] & rates[2] & rates[3]).alias("in_range"))


@query("soft_voting", "WITH " + HASHED + """
SELECT label, count(*) AS n, count(*) AS n_rows, CAST(0 AS BIGINT) AS unknown_classes
FROM hashed WHERE NOT inside GROUP BY label
""")
def soft_voting(star):
    """The vote has every test row once; models are fitted in full, the sums are what SQL knows."""
    train, test = classifier_rows(star)
    _, scored = classify.train_classifiers(train, test, SCALED, "row", trees=20, rounds=10,
                                           iterations=50)
    voted = classify.soft_voting(scored, "row")
    return voted.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("row").alias("n_rows"),
        F.sum((~F.col("prediction").isin(0.0, 1.0)).cast("long")).alias("unknown_classes"))


#: Documents scored by length against their quality label.
SCORED = """
WITH s AS (SELECT doc_id, quality AS label, n_chars % 97 / CAST(97 AS DOUBLE) AS score,
                  CAST(n_chars % 97 >= 40 AS INTEGER) AS prediction
           FROM documents JOIN labels USING (doc_id))
"""


def scored(star):
    docs = star.table("documents").select("doc_id", "n_chars")
    return docs.join(star.table("labels"), "doc_id").select(
        "doc_id", F.col("quality").alias("label"),
        F.expr("n_chars % 97 / 97D").alias("score"),
        F.expr("cast(n_chars % 97 >= 40 as int)").alias("prediction"))


@query("classification_metrics", SCORED + """,
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
             count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM s),
auc AS (SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0
                   END) / count(*) AS roc_auc
        FROM (SELECT score FROM s WHERE label = 1) AS p,
             (SELECT score FROM s WHERE label = 0) AS n)
SELECT tp, fp, fn, tn, (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy,
       tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(tp + fn AS DOUBLE) AS recall,
       2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1_score,
       CAST(roc_auc AS DOUBLE) AS roc_auc FROM c, auc
""", "accuracy precision recall f1_score roc_auc")
def classification_metrics(star):
    rows = stage(scored(star))
    return classify.binary_metrics(rows).withColumn(
        "roc_auc", classify.roc_auc(rows).scalar())


LEVELS = """
us AS (SELECT "userId", avg(rating) AS um FROM ratings GROUP BY 1),
lv AS (SELECT CAST(ceil(rating) AS INTEGER) AS label, CAST(ceil(um) AS INTEGER) AS prediction
       FROM ratings JOIN us USING ("userId"))"""


@query("class_metrics", "WITH " + LEVELS + """,
k AS (SELECT DISTINCT label AS class FROM lv UNION SELECT DISTINCT prediction FROM lv),
m AS (SELECT class, count(*) FILTER (WHERE label = class) AS support,
             count(*) FILTER (WHERE prediction = class) AS said,
             count(*) FILTER (WHERE label = class AND prediction = class) AS hit
      FROM k, lv GROUP BY class),
r AS (SELECT class, support, CASE WHEN said > 0 THEN hit / CAST(said AS DOUBLE) ELSE 0 END
               AS precision, CASE WHEN support > 0 THEN hit / CAST(support AS DOUBLE) ELSE 0 END
               AS recall, 2 * hit / CAST(said + support AS DOUBLE) AS f1_score FROM m)
SELECT * FROM r
UNION ALL
SELECT NULL, CAST(sum(support) AS BIGINT), sum(precision * support) / sum(support),
       sum(recall * support) / sum(support), sum(f1_score * support) / sum(support) FROM r
""", "precision recall f1_score")
def class_metrics(star):
    users = matrix.rating_stats(star.ratings, "userId").select("userId", "rating_mean")
    levels = star.ratings.join(users, "userId").select(
        F.ceil("rating").cast("int").alias("label"),
        F.ceil("rating_mean").cast("int").alias("prediction"))
    return classify.class_metrics(stage(levels))


@query("roc_points", SCORED + """,
t AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
      FROM s)
SELECT threshold, count(*) FILTER (WHERE label = 0) / CAST(any_value(n) AS DOUBLE) AS fpr,
       count(*) FILTER (WHERE label = 1) / CAST(any_value(p) AS DOUBLE) AS tpr
FROM (SELECT DISTINCT score AS threshold FROM s) AS th JOIN s ON score >= threshold, t
GROUP BY 1
""", "threshold fpr tpr")
def roc_points(star):
    return classify.roc_points(stage(scored(star)))


@query("best_model", """
WITH u AS (SELECT DISTINCT n_chars % 7 AS cut FROM documents),
s AS (SELECT 'cut_' || cut AS model, quality AS label, CAST(n_chars % 7 >= cut AS INTEGER)
             AS prediction FROM documents JOIN labels USING (doc_id), u),
f AS (SELECT model, 2 * count(*) FILTER (WHERE label = 1 AND prediction = 1)
             / CAST(count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE prediction = 1)
                    AS DOUBLE) AS f1_score FROM s GROUP BY 1)
SELECT model, f1_score FROM f ORDER BY round(f1_score, 9) DESC, model LIMIT 1
""", "f1_score")
def best_model(star):
    docs = star.table("documents").select("doc_id", (F.col("n_chars") % 7).alias("r"))
    rows = docs.join(star.table("labels"), "doc_id").withColumn(
        "cut", F.explode(F.sequence(F.lit(0), F.lit(6))))
    models = rows.select(
        F.concat(F.lit("cut_"), F.col("cut").cast("string")).alias("model"),
        F.col("quality").alias("label"), (F.col("r") >= F.col("cut")).cast("int")
        .alias("prediction"))
    return classify.best_model(classify.binary_metrics(models, ["model"]))


@query("genre_labels", """
WITH names AS (SELECT DISTINCT genre FROM movie_genres WHERE genre <> '(no genres listed)'
               ORDER BY genre)
SELECT "movieId", 'label_' || genre AS genre,
       CAST(list_contains(genre_list, genre) AS INTEGER) AS label
FROM clean_movies, names
""")
def genre_labels(star):
    names = genres.genre_names(star.clean_movies)
    wide = classify.genre_labels(star.clean_movies, names)
    return wide.unpivot("movieId", [f"`{c}`" for c in wide.columns[1:]], "genre", "label")


@query("genre_predictors", """
WITH names AS (SELECT DISTINCT genre FROM movie_genres WHERE genre <> '(no genres listed)'),
test AS (SELECT m.* FROM clean_movies m SEMI JOIN ratings USING ("movieId")
         WHERE "movieId" % 2147483648 * 2654435761 % 4294967296 >= 3435973836)
SELECT genre, count(*) FILTER (WHERE list_contains(genre_list, genre)) AS positives,
       count(*) FILTER (WHERE NOT list_contains(genre_list, genre)) AS negatives,
       true AS in_range
FROM test, names GROUP BY genre
""")
def genre_predictors(star):
    items = features.movie_user_prefs(star.ratings)
    names = genres.genre_names(star.clean_movies)
    return totals(classify.genre_predictors(items, star.clean_movies, names, trees=20)[1], "genre")


@query("user_type_rules", """
WITH b AS (SELECT "userId", avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS std,
                  count(*) AS total, avg(CAST(rating >= 4 AS INTEGER)) AS pos
           FROM ratings GROUP BY 1),
c AS (SELECT *, CAST(total % 7 AS INTEGER) AS cluster FROM b),
q AS (SELECT quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.75) AS q3 FROM b),
p AS (SELECT cluster, avg(avg_rating) AS a, avg(std) AS s, avg(total) AS t, avg(pos) AS g
      FROM c GROUP BY 1)
SELECT "userId", cluster,
       CASE WHEN a < 3 AND s < 1 THEN 'Critic' WHEN t > q3 THEN 'Enthusiast'
            WHEN t < q1 THEN 'Casual Viewer' WHEN g > 0.7 THEN 'Positive Rater'
            ELSE 'Regular User' END AS user_type
FROM c JOIN p USING (cluster), q
""")
def user_type_rules(star):
    behavior = features.user_behavior(star.ratings)
    return classify.user_type_rules(
        behavior.withColumn("cluster", (F.col("total_ratings") % 7).cast("int")))


@query("user_types", """SELECT DISTINCT "userId", true AS clustered, true AS named FROM ratings""")
def user_types(star):
    found = classify.user_types(stage(features.user_behavior(star.ratings)))
    return found.select("userId", F.col("cluster").between(0, 4).alias("clustered"),
                        F.col("user_type").isin("Critic", "Enthusiast", "Casual Viewer",
                                                "Positive Rater", "Regular User").alias("named"))
