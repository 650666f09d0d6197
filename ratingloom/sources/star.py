"""The order tables seen as a ratings star schema.

Customers rate parts: the rating comes from the quantity, the time from the order
date, item metadata from the part, and free-text tags from the event stream.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.staging import spread
from ratingloom.operators import clean


class Star:
    """Lazy views of one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.path = path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def ratings(self) -> DataFrame:
        """``userId, movieId, rating, timestamp``; ratings 0.5 to 5.0 in half steps."""
        lines = spread(self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
        ), "l_orderkey")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        second = "cast((l_orderkey * 7919 + l_linenumber * 104729) % 86400 as int)"
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("userId"),
            F.col("l_partkey").alias("movieId"),
            F.expr("(1 + (cast(l_quantity as bigint) - 1) % 10) * 0.5D").alias("rating"),
            F.expr(f"timestampadd(SECOND, {second}, cast(o_orderdate as timestamp))").alias(
                "timestamp"
            ),
        )

    @cached_property
    def movies(self) -> DataFrame:
        """``movieId, title, genres`` with a year in most titles."""
        return self.table("part").select(
            F.col("p_partkey").alias("movieId"),
            F.expr(
                "case when p_partkey % 17 = 0 then p_name"
                " else concat(p_name, ' (', cast(1930 + p_partkey % 80 as string), ')') end"
            ).alias("title"),
            F.expr(
                "case when p_partkey % 23 = 0 then '(no genres listed)'"
                " else concat(p_type, '-line|', replace(p_name, ' ', '|')) end"
            ).alias("genres"),
        )

    @cached_property
    def tags(self) -> DataFrame:
        """Raw ``userId, movieId, tag, timestamp``; the time as text in two formats."""
        items = self.table("part").agg(F.count(F.lit(1)).alias("n"))
        text = (
            "case when event_id % 97 = 0 then cast(null as string)"
            " when event_id % 89 = 0 then '   '"
            " else concat('  ', upper(event_type), ' ',"
            " case event_type when 'purchase' then 'love' when 'signup' then 'great'"
            " when 'error' then 'awful' when 'click' then 'boring' else 'classic' end,"
            " ' k', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 as string)) end"
        )
        return (
            spread(self.table("events").select("event_id", "ts", "user_id", "event_type", "props"),
                   "event_id")
            .withColumn("t", F.date_trunc("second", F.col("ts").cast("timestamp")))
            .select(
                F.col("user_id").alias("userId"),
                (F.col("event_id") % items.scalar()).alias("movieId"),
                F.expr(text).alias("tag"),
                F.expr(
                    "case when event_id % 2 = 0 then cast(unix_timestamp(t) as string)"
                    " else date_format(t, 'yyyy-MM-dd HH:mm:ss') end"
                ).alias("timestamp"),
            )
        )

    @cached_property
    def clean_ratings(self) -> DataFrame:
        return clean.clean_ratings(self.ratings)

    @cached_property
    def clean_movies(self) -> DataFrame:
        return clean.clean_movies(self.movies)

    @cached_property
    def clean_tags(self) -> DataFrame:
        return clean.clean_tags(self.tags)

    @cached_property
    def brand_ratings(self) -> DataFrame:
        """Ratings with the part's brand as ``item``, the basket item of the rule queries."""
        brands = self.table("part").select(
            F.col("p_partkey").alias("movieId"), F.col("p_brand").alias("item")
        )
        return self.ratings.join(brands, "movieId")
