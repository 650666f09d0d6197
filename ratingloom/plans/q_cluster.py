"""Clustering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cluster, features, genres, linkage
from ratingloom.plans.q_features import AS_OF_YEAR
from ratingloom.plans.registry import query

SEGMENTS = """
b AS (SELECT "userId", count(*) AS rating_count, avg(rating) AS rating_mean,
             coalesce(stddev_samp(rating), 0) AS rating_std, min(rating) AS rating_min,
             max(rating) AS rating_max, count(DISTINCT "movieId") AS "movieId_nunique",
             date_diff('second', min("timestamp"), max("timestamp")) / CAST(86400 AS DOUBLE)
               AS activity_span_days FROM ratings GROUP BY 1),
seg AS (SELECT *, rating_count / (activity_span_days + 1) AS rating_frequency,
               rating_max - rating_min AS rating_range FROM b)"""


def user_clusters(star):
    return star.ratings.select("userId").distinct().withColumn(
        "user_cluster", F.col("userId") % 8)


def movie_clusters(star):
    return star.ratings.select("movieId").distinct().withColumn(
        "movie_cluster", F.col("movieId") % 6)


@query("segmentation_features", "WITH " + SEGMENTS + """,
names AS (SELECT DISTINCT genre FROM movie_genres WHERE genre <> '(no genres listed)'
          ORDER BY genre),
mg AS (SELECT DISTINCT "movieId", genre FROM movie_genres JOIN names USING (genre)),
prefs AS (SELECT "userId", sum(m) AS pref_total, max(m) AS pref_best FROM (
            SELECT "userId", genre, avg(rating) AS m FROM ratings JOIN mg USING ("movieId")
            GROUP BY 1, 2) AS g GROUP BY 1)
SELECT seg.*, coalesce(pref_total, 0) AS pref_total, coalesce(pref_best, 0) AS pref_best
FROM seg LEFT JOIN prefs USING ("userId")
""", "rating_mean rating_std rating_min rating_max activity_span_days rating_frequency"
     " rating_range pref_total pref_best")
def segmentation_features(star):
    wide = cluster.segmentation_features(star.ratings, star.clean_movies)
    prefs = [F.col(f"`{c}`") for c in wide.columns if c.startswith("genre_pref_")]
    return wide.select("userId", *cluster.SEGMENT_COLUMNS, sum(prefs).alias("pref_total"),
                       F.greatest(*prefs).alias("pref_best"))


def clustered(labels, key, k):
    """``id, clustered``: whether each row has one of the ``k`` clusters, which is what SQL knows."""
    return labels.select(F.col(key).alias("id"), F.coalesce(
        F.col("cluster").between(0, k - 1), F.lit(False)).alias("clustered"))


def both_kinds(users, items):
    return clustered(users, "userId", 20).withColumn("kind", F.lit("user")).unionByName(
        clustered(items, "movieId", 50).withColumn("kind", F.lit("item")))


@query("kmeans_users", """SELECT DISTINCT "userId" AS id, true AS clustered FROM ratings""")
def kmeans_users(star):
    users = stage(cluster.segmentation_features(star.ratings, star.clean_movies))
    return clustered(cluster.kmeans_users(users), "userId", 8)


@query("kmeans_cold_start", """
SELECT DISTINCT 'user' AS kind, "userId" AS id, true AS clustered FROM ratings
UNION ALL SELECT DISTINCT 'item', "movieId", true FROM ratings
""")
def kmeans_cold_start(star):
    users = stage(features.user_features(star.ratings))
    items = stage(features.movie_features(star.ratings, star.clean_movies, AS_OF_YEAR))
    return both_kinds(*cluster.kmeans_cold_start(users, items))


@query("kmeans_cold_start_fast", """
SELECT DISTINCT 'user' AS kind, "userId" AS id, true AS clustered FROM ratings
UNION ALL SELECT DISTINCT 'item', "movieId", true FROM ratings
""")
def kmeans_cold_start_fast(star):
    users = stage(features.user_features_fast(star.ratings))
    items = stage(features.movie_features_fast(star.ratings, star.clean_movies))
    return both_kinds(*cluster.kmeans_cold_start(users, items, fast=True))


@query("assign_clusters", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
           FROM embeddings),
c AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY 1, 2),
d AS (SELECT vec_id, c.label, sum((CAST(v AS DOUBLE) - m) ** 2) AS d FROM e JOIN c USING (i)
      GROUP BY 1, 2),
k AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster
      FROM (SELECT DISTINCT label FROM embeddings) AS l)
SELECT vec_id, cluster FROM d JOIN k USING (label)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1
""")
def assign_clusters(star):
    vectors = star.table("embeddings").withColumn("x", F.col("embedding").cast("array<double>"))
    centers = cluster.group_centroids(vectors, "x", "label").orderBy("label").collect()
    placed = cluster.assign_clusters(vectors, "x", [r["centroid"] for r in centers])
    return placed.select("vec_id", "cluster")


@query("hierarchical_two_level", """
SELECT "movieId", true AS clustered FROM movies UNION SELECT "movieId", true FROM ratings
""")
def hierarchical_two_level(star):
    items = stage(cluster.movie_cluster_features(star.ratings, star.clean_movies))
    columns = [c for c in items.columns if c != "movieId"]
    labels = cluster.hierarchical_two_level(items, columns, "movieId")[("ward", None)]
    return labels.select("movieId", (F.col("cluster") >= 1).alias("clustered"))


#: Distances at which the tree of the items is cut, in stars.
LEVELS = (0.0101, 0.0203, 0.0407)


@query("single_linkage", f"""
WITH RECURSIVE s AS MATERIALIZED (
  SELECT "movieId" AS id, avg(rating) AS x, coalesce(stddev_samp(rating), 0) AS y
  FROM ratings GROUP BY 1),
h AS (SELECT i AS level, [{", ".join(map(str, LEVELS))}][i + 1] AS height
      FROM unnest(range({len(LEVELS)})) AS u(i)),
near AS MATERIALIZED (
  SELECT level, a.id AS a, b.id AS b FROM s a JOIN s b ON a.id <> b.id JOIN h
    ON sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= height),
r(level, id, c) USING KEY (level, id) AS (
  SELECT level, id, id FROM s, h
  UNION
  SELECT near.level, b, min(r.c) FROM r JOIN near ON near.level = r.level AND a = r.id
  JOIN recurring.r AS known ON known.level = near.level AND known.id = b
  WHERE r.c < known.c GROUP BY 1, 2)
SELECT CAST(level AS INTEGER) AS level, id AS "movieId",
       CAST(dense_rank() OVER (PARTITION BY level ORDER BY c) AS INTEGER) AS cluster FROM r
""")
def single_linkage(star):
    """Clusters of all items by mean and spread of their ratings, at three heights of one tree."""
    items = stage(star.ratings.groupBy(F.col("movieId").alias("id")).agg(F.array(
        F.avg("rating"), F.coalesce(F.stddev_samp("rating"), F.lit(0.0))).alias("x")))
    tree = linkage.spanning_tree(items)
    levels = [
        linkage.cut_spanning_tree(tree, items, height=height)
        .select(F.lit(i).alias("level"), F.col("id").alias("movieId"), "cluster")
        for i, height in enumerate(LEVELS)
    ]
    return reduce(DataFrame.unionByName, levels)


@query("movie_cluster_features", """
WITH s AS (SELECT "movieId", count(*) AS rating_count, avg(rating) AS rating_mean,
                  coalesce(stddev_samp(rating), 0) AS rating_std, min(rating) AS rating_min,
                  max(rating) AS rating_max, count(DISTINCT "userId") AS "userId_nunique"
           FROM ratings GROUP BY 1),
g AS (SELECT "movieId", count(DISTINCT genre) FILTER (WHERE genre <> '(no genres listed)') AS n
      FROM movie_genres GROUP BY 1),
top AS (SELECT tag FROM tags WHERE tag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, tag LIMIT 50),
t AS (SELECT "movieId", count(*) AS n FROM tags JOIN top USING (tag) GROUP BY 1)
SELECT "movieId", coalesce(rating_count, 0) AS rating_count, coalesce(rating_mean, 0)
         AS rating_mean, coalesce(rating_std, 0) AS rating_std, coalesce(rating_min, 0)
         AS rating_min, coalesce(rating_max, 0) AS rating_max,
       coalesce("userId_nunique", 0) AS "userId_nunique", coalesce(g.n, 0) AS genres_set,
       coalesce(t.n, 0) AS tags_counted
FROM s FULL JOIN g USING ("movieId") FULL JOIN t USING ("movieId")
""", "rating_mean rating_std rating_min rating_max")
def movie_cluster_features(star):
    wide = cluster.movie_cluster_features(star.ratings, star.clean_movies, star.tags)
    stats = ["movieId", "rating_count", "rating_mean", "rating_std", "rating_min", "rating_max",
             "userId_nunique"]
    tagged = [c for c in wide.columns if c.startswith("tag_")]
    flags = [c for c in wide.columns if c not in stats and c not in tagged]
    return wide.select(
        *stats, sum(F.col(f"`{c}`").cast("long") for c in flags).alias("genres_set"),
        sum(F.col(f"`{c}`") for c in tagged).alias("tags_counted"))


@query("cluster_quality", "WITH " + SEGMENTS + """,
p AS MATERIALIZED (SELECT "userId" % 8 AS c, rating_mean AS x, rating_std AS y FROM seg),
k AS MATERIALIZED (SELECT c, count(*) AS n, avg(x) AS mx, avg(y) AS my,
                          avg(x * x + y * y) AS e FROM p GROUP BY 1),
sp AS (SELECT c, avg(sqrt((x - mx) ** 2 + (y - my) ** 2)) AS s,
              sum((x - mx) ** 2 + (y - my) ** 2) AS w FROM p JOIN k USING (c) GROUP BY 1),
db AS (SELECT a.c, max((sa.s + sb.s) / sqrt((a.mx - b.mx) ** 2 + (a.my - b.my) ** 2)) AS r
       FROM k a JOIN k b ON a.c <> b.c JOIN sp sa ON sa.c = a.c JOIN sp sb ON sb.c = b.c
       GROUP BY 1),
o AS (SELECT avg(x) AS ox, avg(y) AS oy, count(*) AS n FROM p),
bw AS (SELECT sum(k.n * ((mx - ox) ** 2 + (my - oy) ** 2)) AS b, count(*) AS k,
              any_value(o.n) AS n FROM k, o),
dist AS (SELECT "userId", p.c AS own, k.c, k.n, x * x + y * y + e - 2 * (x * mx + y * my) AS d
         FROM (SELECT "userId", "userId" % 8 AS c, rating_mean AS x, rating_std AS y FROM seg)
              AS p, k),
sil AS (SELECT "userId", max(CASE WHEN c = own THEN d * n / (n - 1) END) AS a,
               min(CASE WHEN c <> own THEN d END) AS b FROM dist GROUP BY 1)
SELECT CAST(k AS INTEGER) AS n_clusters,
       (SELECT avg((b - a) / greatest(a, b)) FROM sil) AS silhouette,
       (SELECT avg(r) FROM db) AS davies_bouldin,
       (b / (k - 1)) / ((SELECT sum(w) FROM sp) / (n - k)) AS calinski_harabasz
FROM bw
""", "silhouette davies_bouldin calinski_harabasz")
def cluster_quality(star):
    users = stage(cluster.segmentation_features(star.ratings).select(
        "rating_mean", "rating_std", (F.col("userId") % 8).alias("cluster")))
    return cluster.cluster_quality(users, ["rating_mean", "rating_std"])


@query("compare_linkages", """
SELECT linkage, CAST(k AS INTEGER) AS k, CAST(k AS INTEGER) AS n_clusters, true AS in_range
FROM unnest(['ward', 'complete', 'average', 'single']) AS l(linkage),
     unnest([5, 10, 15, 20]) AS c(k)
""")
def compare_linkages(star):
    items = stage(cluster.movie_cluster_features(star.ratings, star.clean_movies))
    columns = [c for c in items.columns if c != "movieId"]
    return cluster.compare_linkages(items, columns, "movieId").select(
        "linkage", "k", "n_clusters",
        (F.col("silhouette").between(-1, 1) & (F.col("davies_bouldin") >= 0)
         & (F.col("calinski_harabasz") >= 0)).alias("in_range"))


@query("cluster_profiles", "WITH " + SEGMENTS + """,
c AS (SELECT *, "userId" % 8 AS cluster FROM seg),
q AS (SELECT quantile_cont(rating_count, 0.25) AS q1, quantile_cont(rating_count, 0.75) AS q3
      FROM c),
named AS (SELECT cluster, count(*) AS n,
    CASE WHEN avg(rating_count) > any_value(q3) THEN 'Heavy'
         WHEN avg(rating_count) < any_value(q1) THEN 'Light' ELSE 'Regular' END || ' ' ||
    CASE WHEN avg(rating_mean) > 4 THEN 'Positive' WHEN avg(rating_mean) < 3 THEN 'Critical'
         ELSE 'Neutral' END || ' Users' AS label FROM c, q GROUP BY 1),
long AS (UNPIVOT (SELECT cluster, CAST(rating_count AS DOUBLE) AS rating_count, rating_mean,
                         rating_std, CAST("movieId_nunique" AS DOUBLE) AS "movieId_nunique",
                         activity_span_days, rating_frequency FROM c)
         ON rating_count, rating_mean, rating_std, "movieId_nunique", activity_span_days,
            rating_frequency INTO NAME feature VALUE v),
stats AS (SELECT cluster, feature, avg(v) AS mean, stddev_samp(v) AS std FROM long GROUP BY 1, 2)
SELECT cluster, n, label, feature, mean, std FROM stats JOIN named USING (cluster)
""", "mean std")
def cluster_profiles(star):
    users = cluster.segmentation_features(star.ratings).drop(
        "rating_min", "rating_max", "rating_range")
    return cluster.cluster_profiles(users.withColumn("cluster", F.col("userId") % 8))


@query("movie_cluster_stats", """
WITH s AS (SELECT "movieId", count(*) AS n, avg(rating) AS m FROM ratings GROUP BY 1),
f AS (SELECT "movieId", "movieId" % 6 AS c, coalesce(n, 0) AS n, coalesce(m, 0) AS m
      FROM movies LEFT JOIN s USING ("movieId")),
g AS (SELECT DISTINCT "movieId", genre FROM movie_genres WHERE genre <> '(no genres listed)'),
r AS (SELECT c, genre, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, genre) AS p
      FROM f JOIN g USING ("movieId") GROUP BY 1, 2),
t AS (SELECT c, string_agg(genre, ', ' ORDER BY p) AS dominant_genres FROM r WHERE p <= 3
      GROUP BY 1)
SELECT c AS cluster_id, count(*) AS size, avg(m) AS avg_rating, avg(n) AS avg_popularity,
       any_value(dominant_genres) AS dominant_genres FROM f JOIN t USING (c) GROUP BY 1
""", "avg_rating avg_popularity")
def movie_cluster_stats(star):
    items = cluster.movie_cluster_features(star.ratings, star.clean_movies)
    names = genres.genre_names(star.clean_movies)
    return cluster.movie_cluster_stats(items.withColumn("cluster", F.col("movieId") % 6), names)


@query("cluster_top_movies", """
WITH s AS (SELECT "movieId", count(*) AS rating_count, avg(rating) AS rating_mean
           FROM ratings WHERE "movieId" % 6 = 2 GROUP BY 1)
SELECT "movieId", title, year, rating_mean, rating_count
FROM s LEFT JOIN clean_movies USING ("movieId") ORDER BY rating_count DESC, "movieId" LIMIT 10
""", "rating_mean")
def cluster_top_movies(star):
    items = features.movie_user_prefs(star.ratings).withColumn("cluster", F.col("movieId") % 6)
    return cluster.cluster_top_movies(items, star.clean_movies, 2)


CROSS = """
x AS (SELECT "userId" % 8 AS user_cluster, "movieId" % 6 AS movie_cluster,
             avg(rating) AS mean_rating, count(*) AS n FROM ratings GROUP BY 1, 2)"""


@query("cross_cluster_ratings", "WITH " + CROSS + """
SELECT user_cluster, """ + ", ".join(
    f'coalesce(max(mean_rating) FILTER (WHERE movie_cluster = {i}), 0) AS "{i}"'
    for i in range(6)) + " FROM x GROUP BY 1", "0 1 2 3 4 5")
def cross_cluster_ratings(star):
    cross = cluster.cross_cluster_ratings(star.ratings, user_clusters(star), movie_clusters(star))
    return cluster.cross_cluster_table(cross, range(6))


@query("cross_cluster_patterns", "WITH " + CROSS + """
SELECT *, CASE WHEN mean_rating >= 2.78 THEN 'Strong Preference' ELSE 'Strong Dislike' END
         AS pattern
FROM x WHERE n >= 100 AND (mean_rating >= 2.78 OR mean_rating <= 2.72)
""", "mean_rating")
def cross_cluster_patterns(star):
    cross = cluster.cross_cluster_ratings(star.ratings, user_clusters(star), movie_clusters(star))
    return cluster.cross_cluster_patterns(cross, high=2.78, low=2.72)
