"""Registered queries with their check SQL.

A query is a function of a ``Star``. Its SQL runs in another engine over the same
tables; ``BASE`` holds the star schema for that side. Doubles are rounded to six
digits on both sides: in the wrapper here, and in the SQL for the columns named.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.sources.star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BASE = {
    "ratings": """
  SELECT o_custkey AS "userId", l_partkey AS "movieId",
         (1 + (CAST(l_quantity AS BIGINT) - 1) % 10) * CAST(0.5 AS DOUBLE) AS rating,
         o_orderdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 104729) % 86400
                                       AS BIGINT)) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """
  SELECT p_partkey AS "movieId",
         CASE WHEN p_partkey % 17 = 0 THEN p_name
              ELSE p_name || ' (' || (1930 + p_partkey % 80) || ')' END AS title,
         CASE WHEN p_partkey % 23 = 0 THEN '(no genres listed)'
              ELSE p_type || '-line|' || replace(p_name, ' ', '|') END AS genres
  FROM part""",
    "tags": """
  SELECT user_id AS "userId", event_id % (SELECT count(*) FROM part) AS "movieId",
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '   '
              ELSE '  ' || upper(event_type) || ' ' ||
                   CASE event_type WHEN 'purchase' THEN 'love' WHEN 'signup' THEN 'great'
                        WHEN 'error' THEN 'awful' WHEN 'click' THEN 'boring'
                        ELSE 'classic' END ||
                   ' k' || (CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 20)
         END AS tag,
         date_trunc('second', ts) AS ts
  FROM events""",
    "clean_tags": """
  SELECT "userId", "movieId", trim(lower(tag)) AS tag_clean, ts FROM tags
  WHERE tag IS NOT NULL AND trim(lower(tag)) <> ''""",
    "clean_movies": """
  SELECT "movieId", title, genres,
         TRY_CAST(regexp_extract(title, '\\((\\d{4})\\)$', 1) AS INTEGER) AS year,
         regexp_replace(title, '\\s*\\(\\d{4}\\)$', '') AS clean_title,
         string_split(genres, '|') AS genre_list
  FROM movies""",
    "movie_genres": """
  SELECT "movieId", unnest(genre_list) AS genre FROM clean_movies""",
    "latest": """
  SELECT "userId", "movieId", max(struct_pack(t := "timestamp", r := rating)).r AS rating
  FROM ratings GROUP BY 1, 2""",
    "brand_ratings": """
  SELECT r.*, p_brand AS item FROM ratings r JOIN part ON "movieId" = p_partkey""",
}


def with_base(sql: str) -> str:
    """``sql`` (``WITH ...`` or ``SELECT ...``) with the star views it mentions in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in BASE:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(BASE[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    views = ",\n".join(f"{n} AS MATERIALIZED ({BASE[n]})" for n in needed)
    body = sql.strip()
    if not views:
        return body
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{views},\n{body[len(start):]}"
    return f"WITH {views}\n{body}"


#: Rounds to six digits. The same arithmetic runs in both engines, and the offset is a
#: little over one half so that values ending in an exact half do not sit on the boundary.
HALF = 0.5000137


def rounded(df: DataFrame) -> DataFrame:
    """Doubles and floats at six digits."""
    return df.select(*[
        (F.floor(F.col(f"`{f.name}`").cast("double") * F.lit(1e6) + F.lit(HALF)) / F.lit(1e6))
        .alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(key: str, sql: str | None = None, doubles: str = ""):
    """Register ``fn(star)`` under ``key``; ``doubles`` names the SQL columns to round."""

    def register(fn: Callable[[Star], DataFrame]):
        def run(spark: SparkSession, path: str) -> DataFrame:
            return rounded(fn(Star(spark, path)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            text = with_base(sql)
            if doubles:
                cut = ", ".join(f'floor("{c}" * 1e6 + {HALF}) / 1e6 + 0.0 AS "{c}"' for c in doubles.split())
                text = f"SELECT * REPLACE ({cut}) FROM (\n{text}\n) AS checked"
            ORACLES[key] = text
        return fn

    return register


def load() -> None:
    """Import every query module of this package, which registers its queries."""
    import importlib
    import pkgutil

    import ratingloom.plans as plans

    for module in sorted(m.name for m in pkgutil.iter_modules(plans.__path__)):
        if module.startswith("q_"):
            importlib.import_module(f"ratingloom.plans.{module}")
