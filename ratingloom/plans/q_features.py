"""User, item, genre, temporal and cold-start features; summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.operators import coldstart, explore, features, genres, temporal
from ratingloom.plans.registry import query
from ratingloom.plans.q_sources import epoch

AS_OF_YEAR = 2025

USER_BASE = """
WITH u AS (
  SELECT "userId", count(*) AS rating_count, avg(rating) AS rating_mean,
         coalesce(stddev_samp(rating), 0) AS rating_std, min(rating) AS rating_min,
         max(rating) AS rating_max, count(DISTINCT "movieId") AS "movieId_nunique",
         min("timestamp") AS lo, max("timestamp") AS hi,
         date_diff('second', min("timestamp"), max("timestamp")) / CAST(86400 AS DOUBLE) AS span,
         stddev_pop(rating) AS pop_std
  FROM ratings GROUP BY 1)
"""


@query("user_features", USER_BASE + """
SELECT "userId", rating_count, rating_mean, rating_std, rating_min, rating_max, "movieId_nunique",
       CAST(epoch(lo) AS BIGINT) AS timestamp_min, CAST(epoch(hi) AS BIGINT) AS timestamp_max,
       span AS activity_span_days, rating_count / (span + 1) AS rating_frequency,
       rating_max - rating_min AS rating_range,
       CAST(rating_count > (SELECT quantile_cont(rating_count, 0.75) FROM u) AS INTEGER)
         AS is_active_user,
       CAST(rating_std > (SELECT quantile_cont(rating_std, 0.75) FROM u) AS INTEGER)
         AS is_picky_user
FROM u
""", "rating_mean rating_std rating_min rating_max activity_span_days rating_frequency rating_range")
def user_features(star):
    return features.user_features(star.ratings).withColumns({
        c: F.unix_timestamp(c) for c in ("timestamp_min", "timestamp_max")
    })


MOVIE_BASE = """
WITH s AS (
  SELECT "movieId", count(*) AS rating_count, avg(rating) AS rating_mean,
         coalesce(stddev_samp(rating), 0) AS rating_std, min(rating) AS rating_min,
         max(rating) AS rating_max, count(DISTINCT "userId") AS "userId_nunique",
         CAST(epoch(min("timestamp")) AS BIGINT) AS timestamp_min,
         CAST(epoch(max("timestamp")) AS BIGINT) AS timestamp_max, stddev_pop(rating) AS pop_std
  FROM ratings GROUP BY 1),
m AS (SELECT s.*, title, genres, year, clean_title, genre_list
      FROM s LEFT JOIN clean_movies USING ("movieId"))
"""


@query("movie_features", MOVIE_BASE + """,
top AS (SELECT genre FROM (SELECT unnest(genre_list) AS genre FROM m) AS g GROUP BY 1
        ORDER BY count(*) DESC, genre LIMIT 10),
flags AS (SELECT "movieId", string_agg(DISTINCT 'is_' || replace(replace(lower(genre), ' ', '_'),
                                                                '-', '_'), ',' ORDER BY
                   'is_' || replace(replace(lower(genre), ' ', '_'), '-', '_')) AS genre_flags
          FROM (SELECT "movieId", unnest(genre_list) AS genre FROM m) AS g JOIN top USING (genre)
          WHERE genre <> '(no genres listed)' GROUP BY 1)
SELECT m."movieId", rating_count, rating_mean, rating_std, rating_min, rating_max,
       "userId_nunique", timestamp_min, timestamp_max, title, genres, year, clean_title,
       CAST(coalesce(len(genre_list), 0) AS INTEGER) AS genre_count,
       coalesce(genre_flags, '') AS genre_flags, CAST(2025 - coalesce(year, 2025) AS INTEGER)
         AS movie_age, rating_count * rating_mean AS popularity_score,
       CAST(rating_count > (SELECT quantile_cont(rating_count, 0.8) FROM m) AS INTEGER)
         AS is_popular,
       CAST(rating_mean > (SELECT quantile_cont(rating_mean, 0.8) FROM m) AS INTEGER)
         AS is_highly_rated
FROM m LEFT JOIN flags USING ("movieId")
""", "rating_mean rating_std rating_min rating_max popularity_score")
def movie_features(star):
    out = features.movie_features(star.ratings, star.clean_movies, AS_OF_YEAR)
    flags = [c for c in out.columns
             if c.startswith("is_") and c not in ("is_popular", "is_highly_rated")]
    return out.withColumns({
        "genre_flags": flags_text(flags),
        "timestamp_min": F.unix_timestamp("timestamp_min"),
        "timestamp_max": F.unix_timestamp("timestamp_max"),
    }).drop("genre_list", *flags)


def flags_text(flags):
    """Names of the columns that are 1, in name order, joined by commas."""
    return F.concat_ws(",", *[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in sorted(flags)])


@query("user_features_fast", USER_BASE + """
SELECT "userId", rating_count, rating_mean, pop_std AS rating_std, rating_min, rating_max,
       "movieId_nunique" AS movie_diversity, span AS time_span_days,
       rating_count / (span + 1) AS rating_frequency, rating_max - rating_min AS rating_range,
       CAST(rating_count > (SELECT quantile_cont(rating_count, 0.75) FROM u) AS INTEGER)
         AS is_active,
       CAST("movieId_nunique" > (SELECT quantile_cont("movieId_nunique", 0.75) FROM u) AS INTEGER)
         AS is_diverse
FROM u
""", "rating_mean rating_std rating_min rating_max time_span_days rating_frequency rating_range")
def user_features_fast(star):
    return features.user_features_fast(star.ratings)


@query("movie_features_fast", MOVIE_BASE + """
SELECT "movieId", rating_count, rating_mean, pop_std AS rating_std,
       "userId_nunique" AS user_diversity, title, coalesce(year, 0) AS year,
       rating_count * rating_mean AS popularity_score,
       CAST(rating_mean > 4 AS INTEGER) AS is_acclaimed,
       CAST(rating_count > (SELECT quantile_cont(rating_count, 0.8) FROM m) AS INTEGER)
         AS is_popular,
       CAST(2025 - coalesce(year, 2025) AS INTEGER) AS movie_age
FROM m
""", "rating_mean rating_std popularity_score")
def movie_features_fast(star):
    out = features.movie_features_fast(star.ratings, star.clean_movies, AS_OF_YEAR)
    return out.drop("genre_count", *[c for c in out.columns if c.startswith("genre_hash_")])


def _scrambled(k):
    """The key step of the public 32-bit hash in SQL, on unsigned 64-bit numbers."""
    m = f"(({k}) * 3432918353 % 4294967296)"
    return f"(({m} % 131072 * 32768 + {m} // 131072) * 461845907 % 4294967296)"


def _rotated(h):
    return f"(({h}) % 524288 * 8192 + ({h}) // 524288)"


@query("hash_genres", f"""
WITH g AS (SELECT genre, len(genre) AS n, list_transform(range(1, len(genre) + 1),
             lambda i: CAST(ascii(genre[i]) AS UBIGINT)) AS b
           FROM (SELECT DISTINCT genre FROM movie_genres) AS d),
k AS (SELECT genre, n, list_transform(range(0, n // 4), lambda j: {_scrambled(
    "b[4*j+1] + b[4*j+2] * 256 + b[4*j+3] * 65536 + b[4*j+4] * 16777216")}) AS whole,
    {_scrambled("CAST(CASE WHEN n % 4 > 0 THEN b[n // 4 * 4 + 1] ELSE 0 END"
                " + CASE WHEN n % 4 > 1 THEN b[n // 4 * 4 + 2] * 256 ELSE 0 END"
                " + CASE WHEN n % 4 > 2 THEN b[n // 4 * 4 + 3] * 65536 ELSE 0 END AS UBIGINT)")}
      AS tail FROM g),
h0 AS (SELECT genre, n, tail, list_reduce(list_prepend(CAST(0 AS UBIGINT), whole), lambda h, x:
         CAST(({_rotated("xor(h, x)")} * 5 + 3864292196) % 4294967296 AS UBIGINT)) AS h FROM k),
h1 AS (SELECT genre, xor(xor(h, tail), CAST(n AS UBIGINT)) AS h FROM h0),
h2 AS (SELECT genre, xor(h, h // 65536) * 2246822507 % 4294967296 AS h FROM h1),
h3 AS (SELECT genre, xor(h, h // 8192) * 3266489909 % 4294967296 AS h FROM h2),
bucket AS (SELECT genre, xor(h, h // 65536) % 50 AS bucket FROM h3)
SELECT "movieId", string_agg(DISTINCT 'genre_hash_' || bucket, ','
         ORDER BY 'genre_hash_' || bucket) AS flags,
       CAST(count(DISTINCT bucket) AS INTEGER) AS genre_count
FROM movie_genres JOIN bucket USING (genre) GROUP BY 1
""")
def hash_genres(star):
    out = genres.hash_genres(star.clean_movies)
    flags = [c for c in out.columns if c.startswith("genre_hash_")]
    return out.select("movieId", flags_text(flags).alias("flags"), "genre_count")


ACCELERATION = """
mc AS (SELECT "userId", year("timestamp") * 12 + month("timestamp") AS m, count(*) AS n
       FROM ratings GROUP BY 1, 2),
span AS (SELECT "userId", min(m) AS lo, max(m) AS hi, sum(n) AS total FROM mc GROUP BY 1),
cal AS (SELECT "userId", unnest(range(lo, hi + 1)) AS m FROM span),
full_months AS (SELECT c."userId", c.m, coalesce(n, 0) AS n FROM cal c LEFT JOIN mc
                USING ("userId", m)),
d1 AS (SELECT *, n - lag(n) OVER (PARTITION BY "userId" ORDER BY m) AS v FROM full_months),
d2 AS (SELECT *, v - lag(v) OVER (PARTITION BY "userId" ORDER BY m) AS a FROM d1),
acceleration AS (
  SELECT d."userId", CASE WHEN any_value(total) >= 20 AND any_value(hi - lo + 1) >= 3
                          THEN avg(a) ELSE 0 END AS rating_acceleration
  FROM d2 d JOIN span USING ("userId") GROUP BY 1)"""
TREND = """
ord AS (SELECT "userId", rating, row_number() OVER (PARTITION BY "userId" ORDER BY "timestamp",
               "movieId", rating) - 1 AS idx FROM ratings),
trend AS (SELECT "userId", CASE WHEN count(*) >= 10 THEN regr_slope(rating, idx) ELSE 0 END
            AS rating_trend FROM ord GROUP BY 1)"""


@query("rating_trend", "WITH " + TREND + " SELECT * FROM trend", "rating_trend")
def rating_trend(star):
    return temporal.rating_trend(star.ratings)


@query("rating_acceleration", "WITH " + ACCELERATION + " SELECT * FROM acceleration",
       "rating_acceleration")
def rating_acceleration(star):
    return temporal.rating_acceleration(star.ratings)


@query("user_temporal", "WITH " + ACCELERATION + "," + TREND + """,
base AS (
  SELECT "userId", min("timestamp") AS lo, max("timestamp") AS hi, count(*) AS n,
         avg(CAST(isodow("timestamp") >= 6 AS INTEGER)) AS weekend_preference,
         avg(CAST(hour("timestamp") >= 22 OR hour("timestamp") <= 5 AS INTEGER))
           AS night_owl_score
  FROM ratings GROUP BY 1)
SELECT "userId", CAST(epoch(lo) AS BIGINT) AS first_rating_date,
       CAST(epoch(hi) AS BIGINT) AS last_rating_date,
       date_diff('second', lo, hi) // 86400 AS active_days,
       n / greatest(date_diff('second', lo, hi) // 86400, 1) AS rating_velocity,
       rating_acceleration, rating_trend, weekend_preference, night_owl_score
FROM base JOIN acceleration USING ("userId") JOIN trend USING ("userId")
""", "rating_velocity rating_acceleration rating_trend weekend_preference night_owl_score")
def user_temporal(star):
    return temporal.user_temporal(star.ratings).withColumns({
        c: F.unix_timestamp(c) for c in ("first_rating_date", "last_rating_date")
    })


MOMENTUM = """
iord AS (SELECT "movieId", rating, row_number() OVER w - 1 AS idx,
                count(*) OVER (PARTITION BY "movieId") AS n
         FROM ratings
         WINDOW w AS (PARTITION BY "movieId" ORDER BY "timestamp", "userId", rating)),
momentum AS (SELECT "movieId", CASE WHEN count(*) >= 10 THEN
                    avg(rating) FILTER (WHERE idx >= n // 2)
                    - avg(rating) FILTER (WHERE idx < n // 2) ELSE 0 END AS rating_momentum
             FROM iord GROUP BY 1)"""
VOLATILITY = """
roll AS (SELECT "movieId", stddev_samp(rating) OVER (
                  PARTITION BY "movieId" ORDER BY "timestamp"
                  RANGE BETWEEN INTERVAL 2591999 SECOND PRECEDING AND CURRENT ROW) AS s
         FROM ratings),
volatility AS (SELECT "movieId", coalesce(avg(s), 0) AS rating_volatility FROM roll GROUP BY 1)"""
PEAK = """
monthly AS (SELECT "movieId", last_day("timestamp") AS month, avg(rating) AS m
            FROM ratings GROUP BY 1, 2),
peak AS (SELECT "movieId", strftime(month, '%Y-%m-%d') AS peak_rating_period
         FROM monthly QUALIFY row_number() OVER (PARTITION BY "movieId" ORDER BY m DESC, month)
              = 1)"""
DECAY = """
quarterly AS (SELECT "movieId", year("timestamp") * 4 + quarter("timestamp") AS q,
                     avg(rating) AS m, count(*) AS n FROM ratings GROUP BY 1, 2),
decay AS (SELECT "movieId", CASE WHEN sum(n) >= 20 AND max(q) - min(q) + 1 >= 4
                                 THEN -regr_slope(ln(m + 1e-10), q) ELSE 0 END
                 AS rating_decay_rate FROM quarterly GROUP BY 1)"""


@query("rating_momentum", "WITH " + MOMENTUM + " SELECT * FROM momentum", "rating_momentum")
def rating_momentum(star):
    return temporal.rating_momentum(star.ratings)


@query("rating_volatility", "WITH " + VOLATILITY + " SELECT * FROM volatility",
       "rating_volatility")
def rating_volatility(star):
    return temporal.rating_volatility(star.ratings)


@query("peak_month", "WITH " + PEAK + " SELECT * FROM peak")
def peak_month(star):
    return temporal.peak_month(star.ratings).withColumn(
        "peak_rating_period", F.date_format("peak_rating_period", "yyyy-MM-dd"))


@query("rating_decay", "WITH " + DECAY + " SELECT * FROM decay", "rating_decay_rate")
def rating_decay(star):
    return temporal.rating_decay(star.ratings)


@query("movie_temporal", "WITH " + ",".join([MOMENTUM, VOLATILITY, PEAK, DECAY]) + """,
first AS (SELECT "movieId", min("timestamp") AS lo FROM ratings GROUP BY 1)
SELECT f."movieId", CASE WHEN year > 1900
         THEN CAST(floor(
           date_diff('second', make_timestamp(year, 1, 1, 0, 0, 0), lo) / 86400.0) AS BIGINT) END
         AS release_to_first_rating,
       rating_momentum, rating_volatility, peak_rating_period, rating_decay_rate
FROM first f LEFT JOIN clean_movies m USING ("movieId") JOIN momentum USING ("movieId")
JOIN volatility USING ("movieId") JOIN peak USING ("movieId") JOIN decay USING ("movieId")
""", "rating_momentum rating_volatility rating_decay_rate")
def movie_temporal(star):
    return temporal.movie_temporal(star.ratings, star.clean_movies).withColumn(
        "peak_rating_period", F.date_format("peak_rating_period", "yyyy-MM-dd"))


# --- genres -----------------------------------------------------------------------------------

PERFORMANCE = """
items AS (SELECT "movieId", avg(rating) AS m, count(*) AS n,
                 coalesce(stddev_samp(rating), 0) AS s FROM ratings GROUP BY 1),
performance AS (
  SELECT genre, avg(m) AS avg_genre_rating, CAST(sum(n) AS BIGINT) AS genre_popularity,
         avg(s) AS genre_rating_consistency
  FROM (SELECT DISTINCT "movieId", genre FROM movie_genres
        WHERE genre <> '(no genres listed)') AS g JOIN items USING ("movieId") GROUP BY 1)"""


@query("genre_performance", "WITH " + PERFORMANCE + " SELECT * FROM performance",
       "avg_genre_rating genre_rating_consistency")
def genre_performance(star):
    return genres.genre_performance(star.ratings, star.clean_movies)


@query("genre_scores", "WITH " + PERFORMANCE + """
SELECT "movieId", coalesce(avg(avg_genre_rating), 0) AS avg_genre_rating_score,
       coalesce(avg(genre_popularity), 0) AS genre_popularity_score,
       coalesce(avg(genre_rating_consistency), 0) AS genre_rating_consistency_score
FROM movie_genres LEFT JOIN performance USING (genre) GROUP BY 1
""", "avg_genre_rating_score genre_popularity_score genre_rating_consistency_score")
def genre_scores(star):
    return genres.genre_scores(star.ratings, star.clean_movies)


@query("genre_rarity", """
WITH f AS (SELECT genre, count(*) AS n FROM movie_genres GROUP BY 1)
SELECT "movieId", avg(1 / CAST(n + 1 AS DOUBLE)) AS genre_rarity_score
FROM movie_genres JOIN f USING (genre) GROUP BY 1
""", "genre_rarity_score")
def genre_rarity(star):
    return genres.genre_rarity(star.clean_movies)


@query("genre_binary", """
WITH f AS (SELECT "movieId", string_agg(DISTINCT 'genre_' || replace(replace(lower(genre), ' ',
                  '_'), '-', '_'), ',' ORDER BY 'genre_' || replace(replace(lower(genre), ' ',
                  '_'), '-', '_')) AS genre_flags FROM movie_genres GROUP BY 1)
SELECT "movieId", genre_flags, CAST(len(genre_list) AS INTEGER) AS genre_count,
       CAST(len(genre_list) = 1 AS INTEGER) AS is_single_genre,
       CAST(len(genre_list) > 1 AS INTEGER) AS is_multi_genre,
       len(list_distinct(genre_list)) / CAST(len(genre_list) AS DOUBLE) AS genre_diversity
FROM clean_movies JOIN f USING ("movieId")
""", "genre_diversity")
def genre_binary(star):
    out = genres.genre_binary(star.clean_movies)
    plain = ("genre_count", "genre_diversity")
    flags = [c for c in out.columns if c.startswith("genre_") and c not in plain]
    return out.withColumn("genre_flags", flags_text(flags)).drop(*flags)


@query("genre_combos", """
WITH pos AS (SELECT "movieId", unnest(genre_list) AS g, generate_subscripts(genre_list, 1) AS i
             FROM clean_movies),
top AS (SELECT a.g AS g1, b.g AS g2 FROM pos a JOIN pos b USING ("movieId") WHERE a.i < b.i
        GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 20),
f AS (SELECT "movieId", string_agg('combo_' || lower(g1 || '_' || g2), ','
               ORDER BY 'combo_' || lower(g1 || '_' || g2)) AS combos
      FROM clean_movies, top
      WHERE list_contains(genre_list, g1) AND list_contains(genre_list, g2) GROUP BY 1)
SELECT "movieId", coalesce(combos, '') AS combos FROM movies LEFT JOIN f USING ("movieId")
""")
def genre_combos(star):
    out = genres.genre_combos(star.clean_movies)
    return out.select("movieId", flags_text(out.columns[1:]).alias("combos"))


EXPECTED = """
gm AS (SELECT genre, avg(rating) AS gmean
       FROM (SELECT DISTINCT "movieId", genre FROM movie_genres
             WHERE genre <> '(no genres listed)') AS g JOIN ratings USING ("movieId") GROUP BY 1),
expected AS (SELECT "movieId", coalesce(avg(gmean), 3.5) AS genre_expected_rating
             FROM movie_genres LEFT JOIN gm USING (genre) GROUP BY 1)"""


@query("genre_expected_rating", "WITH " + EXPECTED + " SELECT * FROM expected",
       "genre_expected_rating")
def genre_expected_rating(star):
    return genres.genre_expected_rating(star.ratings, star.clean_movies)


@query("user_genre_prefs", """
WITH names AS (SELECT DISTINCT genre FROM movie_genres WHERE genre <> '(no genres listed)'
               ORDER BY genre),
mg AS (SELECT DISTINCT "movieId", genre FROM movie_genres JOIN names USING (genre)),
users AS (SELECT DISTINCT "userId" FROM ratings),
means AS (SELECT "userId", genre, avg(rating) AS m FROM ratings JOIN mg USING ("movieId")
          GROUP BY 1, 2)
SELECT u."userId", 'genre_pref_' || replace(lower(n.genre), ' ', '_') AS genre,
       coalesce(m, 0) AS pref
FROM users u, names n LEFT JOIN means ON means."userId" = u."userId" AND means.genre = n.genre
""", "pref")
def user_genre_prefs(star):
    wide = genres.user_genre_prefs(star.ratings, star.clean_movies)
    return wide.unpivot("userId", wide.columns[1:], "genre", "pref")


@query("top_genres", """
SELECT genre, count(*) AS n FROM movie_genres GROUP BY 1 ORDER BY n DESC, genre LIMIT 10
""")
def top_genres(star):
    return explore.genre_frequency(star.clean_movies, 10)


@query("genre_counts", """
SELECT genre, count(*) AS n FROM movie_genres GROUP BY 1 ORDER BY n DESC, genre LIMIT 20
""")
def genre_counts(star):
    return explore.genre_frequency(star.clean_movies)


# --- cold start, behaviour, baselines ---------------------------------------------------------

@query("cold_start_user", """
WITH u AS (SELECT "userId", count(*) AS n FROM ratings GROUP BY 1),
c AS (SELECT *, CAST(n < (SELECT quantile_cont(n, 0.1) FROM u) AS INTEGER) AS is_cold FROM u),
h AS (SELECT "userId", hour("timestamp") AS h FROM ratings GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY count(*) DESC, h) = 1),
d AS (SELECT "userId", dayname("timestamp") AS d FROM ratings GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY count(*) DESC, d) = 1)
SELECT "userId", is_cold AS is_cold_start, 1 - exp(-n / CAST(10 AS DOUBLE)) AS rating_confidence,
       CASE WHEN is_cold = 1 THEN CAST(h AS INTEGER) END AS preferred_hour,
       CASE WHEN is_cold = 1 THEN d END AS preferred_day,
       (SELECT avg(rating) FROM ratings) AS global_avg_rating
FROM c JOIN h USING ("userId") JOIN d USING ("userId")
""", "rating_confidence global_avg_rating")
def cold_start_user(star):
    return coldstart.cold_start_user(star.ratings)


@query("cold_start_movie", "WITH " + EXPECTED + """,
i AS (SELECT "movieId", count(*) AS n FROM ratings GROUP BY 1)
SELECT "movieId", CAST(n < (SELECT quantile_cont(n, 0.1) FROM i) AS INTEGER) AS is_cold_start,
       1 - exp(-n / CAST(10 AS DOUBLE)) AS rating_confidence,
       coalesce(genre_expected_rating, 3.5) AS genre_expected_rating,
       (SELECT avg(rating) FROM ratings) AS global_avg_rating
FROM i LEFT JOIN expected USING ("movieId")
""", "rating_confidence genre_expected_rating global_avg_rating")
def cold_start_movie(star):
    return coldstart.cold_start_movie(star.ratings, star.clean_movies)


@query("cluster_rating_stats", """
WITH s AS (SELECT "userId" % 8 AS cluster, avg(rating) AS m, stddev_samp(rating) AS d,
                  count(*) AS c FROM ratings GROUP BY 1)
SELECT "userId", cluster, m AS cluster_avg_rating, d AS cluster_rating_std,
       c AS cluster_popularity
FROM (SELECT DISTINCT "userId", "userId" % 8 AS cluster FROM ratings) AS u JOIN s USING (cluster)
""", "cluster_avg_rating cluster_rating_std")
def cluster_rating_stats(star):
    clusters = star.ratings.select("userId").distinct().withColumn("cluster", F.col("userId") % 8)
    return coldstart.cluster_rating_stats(star.ratings, clusters, "userId")


@query("user_behavior", """
WITH g AS (SELECT "userId", count(DISTINCT genre) AS genre_diversity
           FROM ratings JOIN movie_genres USING ("movieId") GROUP BY 1)
SELECT "userId", avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS rating_std,
       count(*) AS total_ratings, avg(CAST(rating >= 4 AS INTEGER)) AS positive_ratio,
       avg(CAST(rating <= 2 AS INTEGER)) AS negative_ratio,
       count(DISTINCT "movieId") AS unique_movies,
       date_diff('second', min("timestamp"), max("timestamp")) // 86400 AS activity_span_days,
       count(*) / (date_diff('second', min("timestamp"), max("timestamp")) // 86400 + 1)
         AS ratings_per_day,
       any_value(genre_diversity) AS genre_diversity
FROM ratings JOIN g USING ("userId") GROUP BY 1
""", "avg_rating rating_std positive_ratio negative_ratio ratings_per_day")
def user_behavior(star):
    return features.user_behavior(star.ratings, genres.movie_genres(star.clean_movies))


@query("movie_user_prefs", """
SELECT "movieId", avg(rating) AS rating_mean, coalesce(stddev_samp(rating), 0) AS rating_std,
       count(*) AS rating_count, count(DISTINCT "userId") AS "userId_nunique"
FROM ratings GROUP BY 1
""", "rating_mean rating_std")
def movie_user_prefs(star):
    return features.movie_user_prefs(star.ratings)


@query("baselines", """
WITH g AS (SELECT avg(rating) AS mu FROM ratings)
SELECT 'user' AS kind, "userId" AS id, avg(rating) AS mean, avg(rating) - any_value(mu) AS bias
FROM ratings, g GROUP BY 2
UNION ALL
SELECT 'item', "movieId", avg(rating), avg(rating) - any_value(mu) FROM ratings, g GROUP BY 2
""", "mean bias")
def baselines(star):
    _, users, items = coldstart.baselines(star.ratings)
    return users.select(F.lit("user").alias("kind"), F.col("userId").alias("id"),
                        F.col("user_mean").alias("mean"), F.col("user_bias").alias("bias")
                        ).unionByName(items.select(
                            F.lit("item").alias("kind"), F.col("movieId").alias("id"),
                            F.col("item_mean").alias("mean"), F.col("item_bias").alias("bias")))


# --- exploration ------------------------------------------------------------------------------

@query("dataset_summary", """
WITH r AS (SELECT count(*) AS n, count(DISTINCT "userId") AS u, count(DISTINCT "movieId") AS m,
                  min("timestamp") AS lo, max("timestamp") AS hi, min(rating) AS r0,
                  max(rating) AS r1 FROM ratings),
m AS (SELECT count(*) AS n, min(year) AS y0, max(year) AS y1 FROM clean_movies),
g AS (SELECT count(DISTINCT genre) AS n FROM movie_genres WHERE genre <> ''),
t AS (SELECT count(*) AS n, count(DISTINCT tag_clean) AS k, count(DISTINCT "userId") AS u
      FROM clean_tags)
SELECT 'ratings' AS table_name, 'total_records' AS metric, CAST(n AS VARCHAR) AS value FROM r
UNION ALL SELECT 'ratings', 'unique_users', CAST(u AS VARCHAR) FROM r
UNION ALL SELECT 'ratings', 'unique_movies', CAST(m AS VARCHAR) FROM r
UNION ALL SELECT 'ratings', 'first_date', strftime(lo, '%Y-%m-%d') FROM r
UNION ALL SELECT 'ratings', 'last_date', strftime(hi, '%Y-%m-%d') FROM r
UNION ALL SELECT 'ratings', 'min_rating', CAST(r0 AS VARCHAR) FROM r
UNION ALL SELECT 'ratings', 'max_rating', CAST(r1 AS VARCHAR) FROM r
UNION ALL SELECT 'movies', 'total_movies', CAST(n AS VARCHAR) FROM m
UNION ALL SELECT 'movies', 'first_year', CAST(y0 AS VARCHAR) FROM m
UNION ALL SELECT 'movies', 'last_year', CAST(y1 AS VARCHAR) FROM m
UNION ALL SELECT 'movies', 'unique_genres', CAST(n AS VARCHAR) FROM g
UNION ALL SELECT 'tags', 'total_tags', CAST(n AS VARCHAR) FROM t
UNION ALL SELECT 'tags', 'unique_tags', CAST(k AS VARCHAR) FROM t
UNION ALL SELECT 'tags', 'unique_users_with_tags', CAST(u AS VARCHAR) FROM t
""")
def dataset_summary(star):
    return explore.dataset_summary(star.ratings, star.clean_movies, star.clean_tags)


@query("rating_describe", """
SELECT count(rating) AS n, avg(rating) AS mean, stddev_samp(rating) AS std, min(rating) AS min,
       quantile_cont(rating, 0.25) AS q25, quantile_cont(rating, 0.5) AS q50,
       quantile_cont(rating, 0.75) AS q75, max(rating) AS max
FROM ratings
""", "mean std min q25 q50 q75 max")
def rating_describe(star):
    return explore.rating_describe(star.ratings)


@query("rating_histogram", """
WITH x AS (
  SELECT 'rating' AS what, rating AS v, 20 AS bins FROM ratings
  UNION ALL SELECT 'per_userId', count(*), 50 FROM ratings GROUP BY "userId"
  UNION ALL SELECT 'per_movieId', count(*), 50 FROM ratings GROUP BY "movieId"),
e AS (SELECT what, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1)
SELECT CAST(least(floor((v - lo) * bins / (hi - lo)), bins - 1) AS INTEGER) AS bin,
       count(*) AS n, what
FROM x JOIN e USING (what) GROUP BY 1, 3
""")
def rating_histogram(star):
    return explore.rating_histogram(star.ratings)


@query("time_trends", """
SELECT 'year' AS unit, CAST(year("timestamp") AS INTEGER) AS bucket, count(*) AS n,
       avg(rating) AS mean_rating FROM ratings GROUP BY 2
UNION ALL SELECT 'month', CAST(month("timestamp") AS INTEGER), count(*), avg(rating)
FROM ratings GROUP BY 2
UNION ALL SELECT 'hour', CAST(hour("timestamp") AS INTEGER), count(*), avg(rating)
FROM ratings GROUP BY 2
""", "mean_rating")
def time_trends(star):
    return explore.time_trends(star.ratings)
