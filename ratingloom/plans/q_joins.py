"""Joins, the feature matrix, the user x item matrix, supervised data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import clean, features, matrix
from ratingloom.plans.registry import query
from ratingloom.plans.q_sources import epoch

STATS = """
WITH us AS (SELECT "userId", count(*) AS rating_count, avg(rating) AS rating_mean
            FROM ratings GROUP BY 1),
     ms AS (SELECT "movieId", count(*) AS rating_count, avg(rating) AS rating_mean
            FROM ratings GROUP BY 1)
"""


def joined(star):
    return matrix.feature_matrix(
        star.ratings, matrix.rating_stats(star.ratings, "userId"),
        matrix.rating_stats(star.ratings, "movieId"),
    )


@query("feature_matrix", STATS + """
SELECT r."userId", r."movieId", r.rating, CAST(epoch(r."timestamp") AS BIGINT) AS epoch,
       us.rating_count AS rating_count_x, us.rating_mean AS rating_mean_x,
       ms.rating_count AS rating_count_y, ms.rating_mean AS rating_mean_y
FROM ratings r LEFT JOIN us USING ("userId") LEFT JOIN ms USING ("movieId")
""", "rating rating_mean_x rating_mean_y")
def feature_matrix(star):
    return joined(star).withColumn("epoch", F.unix_timestamp("timestamp")).drop("timestamp")


@query("feature_matrix_suffixed", STATS + """
SELECT r."userId", r."movieId", CAST(rating >= 4 AS INTEGER) AS label,
       CAST(us.rating_count AS DOUBLE) AS rating_count_user,
       CAST(CAST(us.rating_mean AS FLOAT) AS DOUBLE) AS rating_mean_user,
       CAST(ms.rating_count AS DOUBLE) AS rating_count_movie,
       CAST(CAST(ms.rating_mean AS FLOAT) AS DOUBLE) AS rating_mean_movie,
       CAST(coalesce(m.year, 0) AS DOUBLE) AS year_movie
FROM ratings r LEFT JOIN us USING ("userId") LEFT JOIN ms USING ("movieId")
LEFT JOIN clean_movies m USING ("movieId")
""", "rating_count_user rating_mean_user rating_count_movie rating_mean_movie year_movie")
def feature_matrix_suffixed(star):
    items = matrix.join_item_metadata(
        matrix.rating_stats(star.ratings, "movieId"), star.clean_movies.select(
            "movieId", "title", "year")
    )
    return matrix.feature_matrix_suffixed(
        star.ratings, matrix.rating_stats(star.ratings, "userId"), items, "classification"
    )


@query("join_item_metadata", STATS + """
SELECT ms.*, m.title, m.genres FROM ms LEFT JOIN movies m USING ("movieId")
""", "rating_mean")
def join_item_metadata(star):
    return matrix.join_item_metadata(matrix.rating_stats(star.ratings, "movieId"), star.movies)


@query("join_ratings_genres", """
SELECT g.genre, count(*) AS n, sum(r.rating) AS total
FROM ratings r LEFT JOIN movie_genres g USING ("movieId") GROUP BY 1
""", "total")
def join_ratings_genres(star):
    return matrix.join_ratings_genres(star.ratings, star.movies).groupBy("genre").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")
    )


@query("orphan_ratings", """
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch FROM ratings
WHERE "movieId" NOT IN (SELECT "movieId" FROM clean_movies WHERE year IS NOT NULL)
""", "rating")
def orphan_ratings(star):
    """Ratings of items without a dated entry; the catalogue has an entry for every rated item."""
    return matrix.orphan_ratings(star.ratings, star.clean_movies.where("year IS NOT NULL")).select(
        "userId", "movieId", "rating", epoch("timestamp"))


@query("known_pairs_filter", """
WITH train AS (SELECT * FROM ratings WHERE "timestamp" < TIMESTAMP '1996-01-01'),
     test AS (SELECT * FROM ratings WHERE "timestamp" >= TIMESTAMP '1996-01-01')
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch FROM test
WHERE "userId" IN (SELECT "userId" FROM train) AND "movieId" IN (SELECT "movieId" FROM train)
""", "rating")
def known_pairs_filter(star):
    cut = F.lit("1996-01-01").cast("timestamp")
    train = star.ratings.where(F.col("timestamp") < cut)
    test = star.ratings.where(F.col("timestamp") >= cut)
    return matrix.known_pairs_filter(test, train).select(
        "userId", "movieId", "rating", epoch("timestamp"))


@query("outer_align", STATS + """,
tg AS (SELECT "movieId", count(*) AS tag_count FROM tags GROUP BY 1)
SELECT "movieId", coalesce(rating_count, 0) AS rating_count, coalesce(rating_mean, 0)
         AS rating_mean, coalesce(tag_count, 0) AS tag_count
FROM ms FULL JOIN tg USING ("movieId")
""", "rating_mean")
def outer_align(star):
    tagged = star.tags.groupBy("movieId").agg(F.count(F.lit(1)).alias("tag_count"))
    return matrix.outer_align(
        [matrix.rating_stats(star.ratings, "movieId"), tagged], "movieId", 0
    )


@query("overlap_join", STATS + """
SELECT ms."movieId", ms.rating_count AS rating_count_movie, ms.rating_mean,
       t.rating_count AS rating_count_genre, t.tagged
FROM ms LEFT JOIN (SELECT "movieId", count(*) AS rating_count, true AS tagged
                   FROM tags GROUP BY 1) AS t USING ("movieId")
""", "rating_mean")
def overlap_join(star):
    other = star.tags.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"), F.lit(True).alias("tagged"))
    return matrix.overlap_join(
        matrix.rating_stats(star.ratings, "movieId"), other, "movieId", "_movie", "_genre")


@query("cluster_cross_join_ratings", """
SELECT "userId" % 8 AS user_cluster, "movieId" % 6 AS movie_cluster, "userId", "movieId", rating
FROM ratings
""", "rating")
def cluster_cross_join_ratings(star):
    from ratingloom.operators.cluster import join_clusters

    users = star.ratings.select("userId").distinct().withColumn(
        "user_cluster", F.col("userId") % 8)
    items = star.ratings.select("movieId").distinct().withColumn(
        "movie_cluster", F.col("movieId") % 6)
    return join_clusters(star.ratings, users, items).select(
        "user_cluster", "movie_cluster", "userId", "movieId", "rating")


@query("map_lookup", """
SELECT r."userId", r."movieId", coalesce(m.tag, 'Movie_' || r."movieId") AS tag
FROM ratings r LEFT JOIN (SELECT "movieId", min(tag_clean) AS tag FROM clean_tags GROUP BY 1) AS m
USING ("movieId")
""")
def map_lookup(star):
    """The first tag of every rated item, or a name made of its key."""
    known = star.clean_tags.groupBy("movieId").agg(F.min("tag_clean").alias("tag"))
    default = F.concat(F.lit("Movie_"), F.col("movieId").cast("string"))
    return matrix.map_lookup(
        star.ratings.select("userId", "movieId"), known, "movieId", "tag", default)


@query("set_difference", """
SELECT "userId", "movieId" FROM ratings
WHERE ("userId", "movieId") NOT IN (SELECT "userId", "movieId" FROM ratings WHERE rating >= 4)
""")
def set_difference(star):
    liked = star.ratings.where("rating >= 4")
    return matrix.set_difference(star.ratings.select("userId", "movieId"), liked,
                                 ["userId", "movieId"])


@query("set_intersection", """
SELECT "movieId" FROM ratings INTERSECT SELECT "movieId" FROM tags
""")
def set_intersection(star):
    return matrix.set_intersection(star.ratings, star.tags, "movieId")


@query("union_chunks", """
SELECT "userId", "movieId", CAST(epoch("timestamp") AS BIGINT) AS epoch, min(rating) AS rating
FROM ratings GROUP BY "userId", "movieId", "timestamp"
""", "rating")
def union_chunks(star):
    halves = [star.ratings.where("rating < 3"), star.ratings.where("rating >= 2")]
    return clean.union_chunks(halves, ["userId", "movieId", "timestamp"]).select(
        "userId", "movieId", epoch("timestamp"), "rating")


@query("interaction_pairwise", STATS + """
SELECT r."userId", r."movieId", r.rating, CAST(epoch(r."timestamp") AS BIGINT) AS epoch,
       us.rating_mean * ms.rating_mean AS interact_0_mult,
       us.rating_mean / (ms.rating_mean + 1e-8) AS interact_0_ratio,
       us.rating_count * ms.rating_count AS interact_1_mult,
       us.rating_count / (ms.rating_count + 1e-8) AS interact_1_ratio
FROM ratings r LEFT JOIN us USING ("userId") LEFT JOIN ms USING ("movieId")
""", "rating interact_0_mult interact_0_ratio interact_1_ratio")
def interaction_pairwise(star):
    return matrix.interaction_pairwise(joined(star)).select(
        "userId", "movieId", "rating", epoch("timestamp"), "interact_0_mult", "interact_0_ratio",
        "interact_1_mult", "interact_1_ratio")


@query("user_item_matrix", """
SELECT dense_rank() OVER (ORDER BY "userId") - 1 AS user_idx,
       dense_rank() OVER (ORDER BY "movieId") - 1 AS movie_idx, "userId", "movieId", rating
FROM ratings
""", "rating")
def user_item_matrix(star):
    return matrix.user_item_matrix(star.ratings)


@query("matrix_report", """
SELECT count(DISTINCT "userId") AS n_users, count(DISTINCT "movieId") AS n_items,
       (SELECT count(*) FROM (SELECT DISTINCT "userId", "movieId" FROM ratings) AS d) AS nnz,
       1 - (SELECT count(*) FROM (SELECT DISTINCT "userId", "movieId" FROM ratings) AS d)
           / CAST(count(DISTINCT "userId") * count(DISTINCT "movieId") AS DOUBLE) AS sparsity
FROM ratings
""", "sparsity")
def matrix_report(star):
    return matrix.matrix_report(star.ratings)


@query("prepare_supervised", STATS + """
SELECT r."userId", r."movieId", r.rating AS label, us.rating_count AS rating_count_x,
       ms.rating_count AS rating_count_y, us.rating_mean AS rating_mean_x,
       ms.rating_mean AS rating_mean_y
FROM ratings r LEFT JOIN us USING ("userId") LEFT JOIN ms USING ("movieId")
""", "label rating_mean_x rating_mean_y")
def prepare_supervised(star):
    return matrix.prepare_supervised(joined(star), "regression")


@query("prepare_clustering", """
SELECT "movieId", coalesce(year, 0) AS year FROM clean_movies
""")
def prepare_clustering(star):
    return matrix.prepare_clustering(star.clean_movies, "movieId")


@query("apply_in_chunks", """
SELECT "userId", "movieId", rating, rating * 2 AS stars FROM ratings
""", "rating stars")
def apply_in_chunks(star):
    from ratingloom.operators.hooks import apply_in_chunks as run

    def double(chunk):
        return chunk.assign(stars=chunk["rating"] * 2)

    return run(star.ratings.select("userId", "movieId", "rating"), double,
               "userId long, movieId long, rating double, stars double")


@query("apply_per_group", """
SELECT "userId", max(rating) - min(rating) AS spread, count(*) AS n FROM ratings GROUP BY 1
""", "spread")
def apply_per_group(star):
    from ratingloom.operators.hooks import apply_per_group as run

    def partial(rows):
        return {"low": rows["rating"].min(), "high": rows["rating"].max(), "n": len(rows)}

    def merge(parts):
        return {"low": parts["low"].min(), "high": parts["high"].max(), "n": parts["n"].sum()}

    merged = run(star.ratings.select("userId", "rating"), "userId", "long", partial, merge,
                 "low double, high double, n long")
    return merged.select("userId", (F.col("high") - F.col("low")).alias("spread"), "n")
