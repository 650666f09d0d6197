"""Scans, sinks, saved runs, datasets by task, sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ratingloom.functions.staging import shared_dir
from ratingloom.operators import clean, matrix
from ratingloom.plans.registry import query
from ratingloom.sources import files
from ratingloom.sources.schemas import MOVIES, RATINGS


def scratch(star, name: str) -> str:
    return f"{shared_dir(star.spark)}/{name}-{uuid.uuid4().hex}"


def epoch(column: str):
    return F.unix_timestamp(F.col(column)).alias("epoch")


@query("scan_ratings_csv", """
SELECT r."userId", r."movieId", r.rating, CAST(epoch(r."timestamp") AS BIGINT) AS epoch,
       m.title, m.genres
FROM ratings r JOIN movies m USING ("movieId")
""", "rating")
def scan_ratings_csv(star):
    ratings, movies = scratch(star, "csv"), scratch(star, "csv")
    files.write_csv(star.ratings, ratings)
    files.write_csv(star.movies, movies)
    back = files.read_csv(star.spark, ratings, RATINGS)
    return (
        back.withColumn("timestamp", clean.as_timestamp(back, "timestamp"))
        .join(files.read_csv(star.spark, movies, MOVIES), "movieId")
        .select("userId", "movieId", "rating", epoch("timestamp"), "title", "genres")
    )


@query("scan_parquet", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 40
""", "l_quantity")
def scan_parquet(star):
    return (
        star.table("lineitem").where("l_quantity >= 40")
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query("sink_csv", """
SELECT "movieId", title, genres, year, clean_title, array_to_string(genre_list, '|') AS genre_list
FROM clean_movies
""")
def sink_csv(star):
    path = scratch(star, "csv")
    files.write_csv(star.clean_movies, path)
    schema = "movieId long, title string, genres string, year int, clean_title string," \
             " genre_list string"
    return star.spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query("sink_parquet", """
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch,
       CAST(year("timestamp") AS SMALLINT) AS year
FROM ratings
""", "rating")
def sink_parquet(star):
    path = scratch(star, "parquet")
    files.write_parquet(star.clean_ratings, path)
    return star.spark.read.parquet(path).select(
        "userId", "movieId", "rating", epoch("timestamp"), "year"
    )


@query("dataset_cache", """
SELECT count(*) AS n, sum(rating) AS total, count(DISTINCT "userId") AS users FROM ratings
""", "total")
def dataset_cache(star):
    folder = scratch(star, "run")
    files.save_run({"ratings": star.ratings}, folder)
    found = files.load_run(star.spark, folder, required=["ratings"])
    stale = files.load_run(star.spark, folder, now=F.expr("current_timestamp() + interval 40 days"),
                           required=["ratings"])
    partial = files.load_run(star.spark, folder, required=["ratings", "movie_features"])
    if not found or stale or partial:
        raise AssertionError("only the complete, fresh run may be reused")
    return found["ratings"].agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"),
        F.count_distinct("userId").alias("users"),
    )


@query("get_task_dataset", """
SELECT 'regression' AS task, count(*) AS samples, CAST(1 AS BIGINT) AS features,
       count(DISTINCT rating) AS distinct_targets
FROM ratings
UNION ALL
SELECT 'classification', count(*), 1, count(DISTINCT rating >= 4) FROM ratings
UNION ALL
SELECT 'clustering_users', count(DISTINCT "userId"), 2, NULL FROM ratings
UNION ALL
SELECT 'clustering_movies', count(DISTINCT "movieId"), 2, NULL FROM ratings
UNION ALL
SELECT 'association_rules', count(*), 1, NULL FROM (
  SELECT "userId" FROM (SELECT DISTINCT "userId", item FROM brand_ratings WHERE rating >= 4) AS d
  GROUP BY 1 HAVING count(*) >= 2) AS b
""")
def get_task_dataset(star):
    hours = star.ratings.withColumn("hour", F.hour("timestamp"))
    datasets = {
        "regression": hours.select("userId", "movieId", "hour", F.col("rating").alias("label")),
        "classification": hours.select(
            "userId", "movieId", "hour", (F.col("rating") >= 4).cast("int").alias("label")
        ),
        "clustering_users": matrix.rating_stats(star.ratings, "userId"),
        "clustering_movies": matrix.rating_stats(star.ratings, "movieId"),
        "association_rules": (
            star.brand_ratings.where("rating >= 4").select("userId", "item").distinct()
            .groupBy("userId").agg(F.count(F.lit(1)).alias("basket_size"))
            .where("basket_size >= 2")
        ),
    }
    return files.task_info(datasets)


@query("sample_n", """
SELECT "movieId", title, genres FROM movies
ORDER BY ("movieId" * 2654435761) % 4294967296, "movieId" LIMIT 100
""")
def sample_n(star):
    return clean.sample_n(star.movies, 100, "movieId", ties=["movieId"])
