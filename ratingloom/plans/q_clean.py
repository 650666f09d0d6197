"""Cleaning, validation, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions import times
from ratingloom.functions.staging import stage
from ratingloom.operators import clean, matrix, quality, scale
from ratingloom.plans.registry import query
from ratingloom.plans.q_sources import epoch

YEARS = range(1995, 2002)

USER_STATS = """
WITH us AS (SELECT "userId", count(*) AS rating_count, avg(rating) AS rating_mean
            FROM ratings GROUP BY 1)
"""


def user_stats(star):
    return stage(matrix.rating_stats(star.ratings, "userId"))


@query("clean_ratings", """
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch,
       CAST(year("timestamp") AS SMALLINT) AS year, CAST(month("timestamp") AS TINYINT) AS month,
       CAST(hour("timestamp") AS TINYINT) AS hour, dayname("timestamp") AS day_of_week
FROM ratings
""", "rating")
def clean_ratings(star):
    return star.clean_ratings.select(
        "userId", "movieId", "rating", epoch("timestamp"), "year", "month", "hour", "day_of_week"
    )


@query("clean_movies", """
SELECT "movieId", title, genres, year, clean_title, array_to_string(genre_list, '#') AS genre_list
FROM clean_movies
""")
def clean_movies(star):
    return star.clean_movies.withColumn("genre_list", F.concat_ws("#", "genre_list"))


@query("clean_tags", """
SELECT "userId", "movieId", tag_clean, CAST(epoch(ts) AS BIGINT) AS epoch FROM clean_tags
""")
def clean_tags(star):
    return star.clean_tags.select("userId", "movieId", "tag_clean", epoch("timestamp"))


@query("validate_ratings", """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE NOT rating BETWEEN 0.5 AND 5.0) AS out_of_range,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT "userId", "movieId", "timestamp"
                                         FROM ratings) AS d) AS duplicates
FROM ratings
""")
def validate_ratings(star):
    return quality.validate_ratings(star.ratings)


@query("validate_raw", """
SELECT 'ratings_rows' AS check_name, count(*) AS value FROM ratings
UNION ALL SELECT 'movies_rows', count(*) FROM movies
UNION ALL SELECT 'tags_rows', count(*) FROM tags
UNION ALL SELECT 'ratings_missing_columns', 0
UNION ALL SELECT 'movies_missing_columns', 0
UNION ALL SELECT 'tags_missing_columns', 0
UNION ALL SELECT 'ratings_out_of_range', count(*) FROM ratings WHERE rating < 0.5 OR rating > 5
UNION ALL SELECT 'orphan_ratings', count(*) FROM ratings
          WHERE "movieId" NOT IN (SELECT "movieId" FROM movies)
""")
def validate_raw(star):
    return quality.validate_raw(
        {"ratings": star.ratings, "movies": star.movies, "tags": star.tags}
    )


GAPPY = """
WITH gappy AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS rare,
         CASE WHEN event_id % 7 <> 0 THEN value END AS amount,
         CASE WHEN event_id % 5 <> 0 THEN event_type END AS kind
  FROM events)
"""


@query("handle_missing", GAPPY + """
SELECT event_id,
       coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM gappy)) AS amount,
       coalesce(kind, (SELECT kind FROM gappy WHERE kind IS NOT NULL GROUP BY kind
                       ORDER BY count(*) DESC, kind LIMIT 1)) AS kind
FROM gappy
""", "amount")
def handle_missing(star):
    gappy = star.table("events").select(
        "event_id",
        F.expr("case when event_id % 3 = 0 then value end").alias("rare"),
        F.expr("case when event_id % 7 <> 0 then value end").alias("amount"),
        F.expr("case when event_id % 5 <> 0 then event_type end").alias("kind"),
    )
    return clean.handle_missing(gappy)


@query("remove_duplicates", """
SELECT "userId", "movieId", CAST(epoch("timestamp") AS BIGINT) AS epoch, min(rating) AS rating
FROM ratings GROUP BY "userId", "movieId", "timestamp"
""", "rating")
def remove_duplicates(star):
    first = clean.remove_duplicates(star.ratings, ["userId", "movieId", "timestamp"])
    return first.select("userId", "movieId", epoch("timestamp"), "rating")


@query("cap_outliers_iqr", USER_STATS + """,
b AS (SELECT quantile_cont(rating_count, 0.25) AS c1, quantile_cont(rating_count, 0.75) AS c3,
             quantile_cont(rating_mean, 0.25) AS m1, quantile_cont(rating_mean, 0.75) AS m3
      FROM us)
SELECT "userId",
       least(greatest(CAST(rating_count AS DOUBLE), c1 - 1.5 * (c3 - c1)), c3 + 1.5 * (c3 - c1))
         AS rating_count,
       least(greatest(rating_mean, m1 - 1.5 * (m3 - m1)), m3 + 1.5 * (m3 - m1)) AS rating_mean
FROM us, b
""", "rating_count rating_mean")
def cap_outliers_iqr(star):
    return clean.cap_outliers_iqr(user_stats(star), ["rating_count", "rating_mean"])


@query("outlier_report", USER_STATS + """,
long AS (SELECT 'rating_count' AS feature, CAST(rating_count AS DOUBLE) AS v FROM us
         UNION ALL SELECT 'rating_mean', rating_mean FROM us),
b AS (SELECT feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
      FROM long GROUP BY 1)
SELECT feature, count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))
         AS n_outliers,
       any_value(q1 - 1.5 * (q3 - q1)) AS lower_bound,
       any_value(q3 + 1.5 * (q3 - q1)) AS upper_bound
FROM long JOIN b USING (feature) GROUP BY feature
""", "lower_bound upper_bound")
def outlier_report(star):
    return clean.outlier_report(user_stats(star), ["rating_count", "rating_mean"])


@query("downcast_types", USER_STATS + """
SELECT "userId", CAST(rating_count AS TINYINT) AS rating_count,
       CAST(CAST(rating_mean AS FLOAT) AS DOUBLE) AS rating_mean FROM us
""", "rating_mean")
def downcast_types(star):
    return clean.downcast_types(user_stats(star), keep=["userId"])


@query("encode_label", """
SELECT event_id, tag, dense_rank() OVER (ORDER BY coalesce(tag, 'nan')) - 1 AS tag_encoded
FROM (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type || event_id % 11 END
        AS tag FROM events) AS t
""")
def encode_label(star):
    tagged = star.table("events").select(
        "event_id",
        F.expr("case when event_id % 97 = 0 then cast(null as string)"
               " else concat(event_type, cast(event_id % 11 as string)) end").alias("tag"),
    )
    return scale.encode_label(tagged, "tag")


@query("encode_onehot", """
SELECT event_id, event_type,
       CAST(event_type = 'click' AS INTEGER) AS event_type_click,
       CAST(event_type = 'error' AS INTEGER) AS event_type_error,
       CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase,
       CAST(event_type = 'signup' AS INTEGER) AS event_type_signup,
       CAST(event_type = 'view' AS INTEGER) AS event_type_view,
       (SELECT count(DISTINCT event_type) FROM events) AS size,
       dense_rank() OVER (ORDER BY event_type) - 1 AS hot
FROM events
""")
def encode_onehot(star):
    events = star.table("events").select("event_id", "event_type")
    named = scale.onehot_columns(events, "event_type",
                                 ["click", "error", "purchase", "signup", "view"])
    return scale.encode_onehot(named, "event_type").select(
        *named.columns, "event_type_onehot.size",
        F.col("event_type_onehot.indices")[0].alias("hot"))


@query("scale_standard", USER_STATS + """
SELECT "userId",
       (rating_count - (SELECT avg(rating_count) FROM us))
         / (SELECT stddev_pop(rating_count) FROM us) AS rating_count_scaled,
       (rating_mean - (SELECT avg(rating_mean) FROM us))
         / (SELECT stddev_pop(rating_mean) FROM us) AS rating_mean_scaled
FROM us
""", "rating_count_scaled rating_mean_scaled")
def scale_standard(star):
    scaled = scale.scale_standard(user_stats(star), ["rating_count", "rating_mean"])
    return scaled.drop("rating_count", "rating_mean")


@query("scale_minmax", USER_STATS + """
SELECT "userId",
       CAST(rating_count - (SELECT min(rating_count) FROM us) AS DOUBLE)
         / (SELECT max(rating_count) - min(rating_count) FROM us) AS rating_count_scaled,
       (rating_mean - (SELECT min(rating_mean) FROM us))
         / (SELECT max(rating_mean) - min(rating_mean) FROM us) AS rating_mean_scaled
FROM us
""", "rating_count_scaled rating_mean_scaled")
def scale_minmax(star):
    scaled = scale.scale_minmax(user_stats(star), ["rating_count", "rating_mean"])
    return scaled.drop("rating_count", "rating_mean")


@query("scale_robust", USER_STATS + """,
b AS (SELECT quantile_cont(rating_count, [0.25, 0.5, 0.75]) AS c,
             quantile_cont(rating_mean, [0.25, 0.5, 0.75]) AS m FROM us)
SELECT "userId", (rating_count - c[2]) / (c[3] - c[1]) AS rating_count_scaled,
       (rating_mean - m[2]) / (m[3] - m[1]) AS rating_mean_scaled
FROM us, b
""", "rating_count_scaled rating_mean_scaled")
def scale_robust(star):
    scaled = scale.scale_robust(user_stats(star), ["rating_count", "rating_mean"])
    return scaled.drop("rating_count", "rating_mean")


@query("interaction_features", """
SELECT p_partkey, p_size, p_retailprice, p_partkey * p_retailprice AS p_partkey_x_p_retailprice,
       p_partkey / p_retailprice AS p_partkey_div_p_retailprice,
       p_retailprice * p_partkey AS p_retailprice_x_p_partkey
FROM part
""", "p_retailprice p_partkey_x_p_retailprice p_partkey_div_p_retailprice"
     " p_retailprice_x_p_partkey")
def interaction_features(star):
    parts = star.table("part").select("p_partkey", "p_size", "p_retailprice")
    return matrix.interaction_features(
        parts, [("p_partkey", "p_retailprice"), ("p_retailprice", "p_partkey")]
    )


@query("season_flag", """
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch,
       CASE WHEN month("timestamp") IN (12, 1, 2) THEN 'winter'
            WHEN month("timestamp") IN (3, 4, 5) THEN 'spring'
            WHEN month("timestamp") IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season
FROM ratings
""", "rating")
def season_flag(star):
    return star.ratings.select("userId", "movieId", "rating", epoch("timestamp"),
                               times.season(F.col("timestamp")).alias("season"))


@query("holiday_flag", """
WITH h AS (
  SELECT make_timestamp(y, m, d, 0, 0, 0) AS holiday
  FROM range(1995, 2002) AS years(y), (VALUES (12, 25), (1, 1), (7, 4)) AS days(m, d))
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch,
       CAST(EXISTS (SELECT 1 FROM h WHERE "timestamp" BETWEEN holiday - INTERVAL 3 DAY
                                                      AND holiday + INTERVAL 3 DAY) AS INTEGER)
         AS is_holiday_week
FROM ratings
""", "rating")
def holiday_flag(star):
    flag = times.holiday_flag(F.col("timestamp"), YEARS)
    return star.ratings.select("userId", "movieId", "rating", epoch("timestamp"),
                               flag.alias("is_holiday_week"))


@query("weekend_flag", """
SELECT "userId", "movieId", rating, CAST(epoch("timestamp") AS BIGINT) AS epoch,
       CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
       CAST(isodow("timestamp") >= 6 AS INTEGER) AS is_weekend
FROM ratings
""", "rating")
def weekend_flag(star):
    day = times.weekday(F.col("timestamp"))
    return star.ratings.select(
        "userId", "movieId", "rating", epoch("timestamp"), day.alias("day_of_week"),
        (day >= 5).cast("int").alias("is_weekend"),
    )


@query("filter_ratings", """
SELECT "userId", "movieId", rating FROM ratings WHERE rating >= 4 AND rating <= 4.5
""", "rating")
def filter_ratings(star):
    return clean.filter_ratings(star.ratings, 4.0, 4.5).select("userId", "movieId", "rating")


@query("satisfied_label", """
SELECT CAST(rating >= 4 AS INTEGER) AS satisfied, count(*) AS n FROM ratings GROUP BY 1
""")
def satisfied_label(star):
    labelled = matrix.with_label(star.ratings, "classification")
    return labelled.groupBy(F.col("label").alias("satisfied")).agg(F.count(F.lit(1)).alias("n"))


@query("rating_level_bin", """
SELECT rating, CAST(ceil(rating) AS INTEGER) AS level, count(*) AS n FROM ratings GROUP BY 1, 2
""", "rating")
def rating_level_bin(star):
    return star.ratings.groupBy("rating", F.ceil("rating").cast("int").alias("level")).agg(
        F.count(F.lit(1)).alias("n")
    )


PART_FEATURES = """
WITH pf AS (
  SELECT p_partkey, p_size, p_retailprice, 1 AS one, p_retailprice * 2 + p_size / 1000.0 AS dear,
         exp(p_partkey % 100 / CAST(8 AS DOUBLE)) AS tail, p_brand,
         CASE WHEN p_partkey % 5 < 2 THEN p_size END AS part_size
  FROM part)
"""


def part_features(star):
    return star.table("part").select(
        "p_partkey", "p_size", "p_retailprice", F.lit(1).alias("one"),
        F.expr("p_retailprice * 2 + p_size / 1000D").alias("dear"),
        F.expr("exp(p_partkey % 100 / 8D)").alias("tail"), "p_brand",
        F.expr("case when p_partkey % 5 < 2 then p_size end").alias("part_size"),
    )


def _feature_row(c):
    return f"""
SELECT '{c}' AS feature, true AS is_numeric, CAST(min({c}) AS DOUBLE) AS min_value,
       CAST(max({c}) AS DOUBLE) AS max_value, avg({c}) AS mean_value,
       stddev_samp({c}) AS std_value, 1 - count({c}) / CAST(count(*) AS DOUBLE) AS missing_pct,
       1 - count({c}) / CAST(count(*) AS DOUBLE) > 0.3 AS many_missing,
       min({c}) = max({c}) AS is_constant,
       count(*) FILTER (WHERE abs({c} - (SELECT avg({c}) FROM pf))
                              > 5 * (SELECT stddev_samp({c}) FROM pf)) > 0.01 * count(*)
         AS extreme_outliers,
       coalesce(abs(CASE WHEN min({c}) < max({c}) THEN skewness({c}) END) > 2, false) AS is_skewed
FROM pf"""


@query("validate_features", PART_FEATURES + ", report AS (" + " UNION ALL ".join(
    _feature_row(c) for c in ["p_size", "p_retailprice", "one", "dear", "tail", "part_size"]
) + """
UNION ALL
SELECT 'p_brand', false, NULL, NULL, NULL, NULL, 0, false, false, false, false),
long AS (UNPIVOT (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, dear, tail,
                         CAST(part_size AS DOUBLE) AS part_size FROM pf)
         ON p_size, p_retailprice, dear, tail, part_size INTO NAME f VALUE v),
pos AS (SELECT * FROM (VALUES ('p_size', 1), ('p_retailprice', 2), ('dear', 3), ('tail', 4),
                              ('part_size', 5)) AS t(f, i)),
pairs AS (SELECT b.f FROM long a JOIN long b USING (p_partkey)
          JOIN pos pa ON pa.f = a.f JOIN pos pb ON pb.f = b.f WHERE pa.i < pb.i
          GROUP BY a.f, b.f HAVING abs(corr(a.v, b.v)) > 0.95)
SELECT report.*, (SELECT count(*) FROM pairs WHERE pairs.f = report.feature) AS correlated_with
FROM report
""", "min_value max_value mean_value std_value missing_pct")
def validate_features(star):
    return quality.validate_features(part_features(star), "p_partkey")


@query("autofix_features", PART_FEATURES + """,
logged AS (SELECT *, ln(1 + tail) AS tail_log FROM pf),
q AS (SELECT quantile_cont(dear, [0.01, 0.99]) AS d, quantile_cont(part_size, [0.01, 0.99]) AS s,
             quantile_cont(tail_log, [0.01, 0.99]) AS t FROM logged)
SELECT p_partkey, least(greatest(dear, d[1]), d[2]) AS dear, p_brand,
       CASE WHEN part_size IS NOT NULL THEN least(greatest(CAST(part_size AS DOUBLE), s[1]), s[2]) END
         AS part_size,
       least(greatest(tail_log, t[1]), t[2]) AS tail_log
FROM logged, q
""", "dear part_size tail_log")
def autofix_features(star):
    return quality.autofix_features(part_features(star), "p_partkey")


@query("sanitize_types", """
SELECT event_id, coalesce(TRY_CAST(code AS DOUBLE), 0) AS code,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, CAST(small AS TINYINT) AS small
FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type
                            ELSE CAST(event_id % 100 AS VARCHAR) END AS code,
             value, event_id % 50 AS small FROM events) AS t
""", "code value")
def sanitize_types(star):
    raw = star.table("events").select(
        "event_id",
        F.expr("case when event_id % 4 = 0 then event_type"
               " else cast(event_id % 100 as string) end").alias("code"),
        F.expr("case when event_id % 9 = 0 then value else value end").alias("value"),
        F.split("props", ":").alias("parts"),
        F.expr("event_id % 50").alias("small"),
    )
    return clean.sanitize_types(raw, keep=["event_id"])


@query("sanitize_matrix", PART_FEATURES + """
SELECT p_partkey, p_size, p_retailprice, dear, tail, coalesce(part_size, 0) AS part_size FROM pf
""", "p_retailprice dear tail")
def sanitize_matrix(star):
    return clean.sanitize_matrix(part_features(star), keep=["p_partkey"])


@query("check_compatibility", """
SELECT * FROM (VALUES ('users', 'text', 'c_mktsegment,c_name'), ('movies', 'list', 'genre_list'),
                      ('movies', 'text', 'clean_title,genres,title'),
                      ('both', 'overlap', 'movieId')) AS t(table_name, problem, columns)
WHERE EXISTS (SELECT 1 FROM customer) AND EXISTS (SELECT 1 FROM part)
""")
def check_compatibility(star):
    customers = star.table("customer").withColumnRenamed("c_custkey", "movieId")
    return quality.check_compatibility(customers, star.clean_movies)


@query("validate_ml_datasets", """
SELECT 'customers' AS dataset, count(*) AS samples, CAST(5 AS BIGINT) AS n_columns,
       CAST(0 AS BIGINT) AS nulls, '' AS issues, '' AS warnings, true AS valid FROM customer
UNION ALL
SELECT 'movies', count(*), 6, count(*) - count(year), 'contains nulls', '', false
FROM clean_movies
UNION ALL
SELECT 'nations', count(*), 3, 0, '', 'few samples', true FROM nation
UNION ALL
SELECT 'baskets', count(*), 2, count(*) - count(item),
       CASE WHEN count(*) = 0 THEN 'no transactions' ELSE '' END,
       CASE WHEN count(*) BETWEEN 1 AND 99 THEN 'few transactions' ELSE '' END, count(*) > 0
FROM (SELECT "userId", count(DISTINCT item) AS item FROM brand_ratings GROUP BY 1)
""")
def validate_ml_datasets(star):
    baskets = star.brand_ratings.groupBy("userId").agg(
        F.countDistinct("item").alias("basket_size"))
    return quality.validate_ml_datasets({
        "customers": star.table("customer"), "movies": star.clean_movies,
        "nations": star.table("nation"), "baskets": baskets,
    })
