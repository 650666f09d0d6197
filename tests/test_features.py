import pytest

from ratingloom.operators import coldstart, features, genres, hooks, tags, temporal


def one(df):
    return df.collect()[0].asDict()


def test_single_rating_has_no_deviation(ratings):
    got = one(features.user_features(ratings([(1, 1, 3.0, "2020-01-01 00:00:00")])))
    assert got["rating_std"] == 0.0 and got["activity_span_days"] == 0.0
    assert got["is_active_user"] == 0


def history(n, step=1, user=1):
    return [(user, i, float(i % 5 + 1), f"2020-{(i // 28) % 12 + 1:02d}-{i % 28 + 1:02d} 00:00:00")
            for i in range(0, n * step, step)]


def test_trend_needs_ten_rows(ratings):
    assert one(temporal.rating_trend(ratings(history(9))))["rating_trend"] == 0.0
    rising = [(1, i, 1.0 + i / 10, f"2020-01-{i + 1:02d} 00:00:00") for i in range(10)]
    assert one(temporal.rating_trend(ratings(rising)))["rating_trend"] == pytest.approx(0.1)


def test_acceleration_counts_empty_months(ratings):
    rows = [(1, i, 3.0, f"2020-01-{i + 1:02d} 00:00:00") for i in range(15)]
    rows += [(1, 100 + i, 3.0, f"2020-04-{i + 1:02d} 00:00:00") for i in range(5)]
    # counts 15, 0, 0, 5: differences -15, 0, 5; second differences 15, 5
    got = one(temporal.rating_acceleration(ratings(rows)))
    assert got["rating_acceleration"] == pytest.approx(10.0)
    assert one(temporal.rating_acceleration(ratings(rows[:19])))["rating_acceleration"] == 0.0


def test_momentum_splits_in_the_middle(ratings):
    rows = [(i, 1, 1.0 if i < 5 else 4.0, f"2020-01-{i + 1:02d} 00:00:00") for i in range(11)]
    assert one(temporal.rating_momentum(ratings(rows)))["rating_momentum"] == pytest.approx(3.0)


def test_peak_month_earliest_on_a_tie(ratings):
    df = ratings([(1, 1, 4.0, "2020-03-05 00:00:00"), (2, 1, 4.0, "2020-01-05 00:00:00"),
                  (3, 1, 1.0, "2020-02-05 00:00:00")])
    assert str(one(temporal.peak_month(df))["peak_rating_period"]) == "2020-01-31"


def test_hash_matches_the_public_values():
    known = {b"": 0, b"hello": 0x248BFA47, b"hello, world": 0x149BBB7F,
             b"The quick brown fox jumps over the lazy dog": 0x2E4FF723}
    assert {k: genres.murmur3_32(k) for k in known} == known


@pytest.fixture
def movies(spark):
    from ratingloom.operators.clean import clean_movies

    return clean_movies(spark.createDataFrame(
        [(1, "A (2000)", "x|y"), (2, "B (2001)", "y"), (3, "C", "(no genres listed)")],
        "movieId long, title string, genres string"))


def test_genre_scores_without_data_are_zero(ratings, movies):
    df = ratings([(1, 2, 4.0, "2020-01-01 00:00:00"), (2, 2, 2.0, "2020-01-01 00:00:00")])
    got = {r["movieId"]: r["avg_genre_rating_score"]
           for r in genres.genre_scores(df, movies).collect()}
    assert got == {1: 3.0, 2: 3.0, 3: 0.0}
    expected = {r["movieId"]: r["genre_expected_rating"]
                for r in genres.genre_expected_rating(df, movies).collect()}
    assert expected == {1: 3.0, 2: 3.0, 3: 3.5}


def test_hash_genres_flags(movies):
    got = {r["movieId"]: r["genre_count"] for r in genres.hash_genres(movies).collect()}
    assert got == {1: 2, 2: 1, 3: 1}


def test_cold_users_keep_their_habits(ratings):
    rows = [(u, i, 3.0, f"2020-01-{i + 1:02d} 0{u % 10}:00:00")
            for u in range(1, 10) for i in range(5)]
    rows.append((11, 1, 3.0, "2020-01-03 07:00:00"))
    got = {r["userId"]: r for r in coldstart.cold_start_user(ratings(rows)).collect()}
    assert got[11]["is_cold_start"] == 1 and got[11]["preferred_hour"] == 7
    assert got[11]["preferred_day"] == "Friday"
    assert got[1]["is_cold_start"] == 0 and got[1]["preferred_hour"] is None


def test_bigrams_cross_tag_borders(spark, movies):
    raw = spark.createDataFrame(
        [(1, 1, "red car", "2020-01-01 00:00:00"), (2, 1, "!", "2020-01-02 00:00:00"),
         (3, 1, "fast", "2020-01-03 00:00:00")],
        "userId long, movieId long, tag_clean string, timestamp string")
    raw = raw.withColumn("timestamp", raw.timestamp.cast("timestamp"))
    got = {r["term"]: r["n"] for r in tags.document_terms(raw).collect()}
    assert got == {"red": 1, "car": 1, "fast": 1, "red car": 1, "car fast": 1}
    sentiment = {r["movieId"]: r["sentiment_ratio"]
                 for r in tags.tag_sentiment(raw.withColumn("tag_clean", raw.tag_clean), movies)
                 .collect()}
    assert sentiment == {1: 0.0, 2: 0.0, 3: 0.0}


def test_topic_rows_sum_to_one(star):
    rows = tags.topic_model(star.clean_tags, star.movies, iterations=2).collect()
    assert len(rows) == star.movies.count()
    assert all(abs(sum(r[1:]) - 1) < 1e-6 for r in rows)


def test_group_hook_merges_partial_results(ratings):
    df = ratings(history(40) + history(7, user=2)).repartition(5)
    out = hooks.apply_per_group(
        df.select("userId", "rating"), "userId", "long",
        lambda rows: {"s": rows["rating"].sum(), "n": len(rows)},
        lambda parts: {"s": parts["s"].sum(), "n": parts["n"].sum()}, "s double, n long")
    got = {r["userId"]: (r["s"], r["n"]) for r in out.collect()}
    assert got == {1: (sum(i % 5 + 1 for i in range(40)), 40),
                   2: (sum(i % 5 + 1 for i in range(7)), 7)}


@pytest.mark.parametrize("hot", [1_000_000, 30])
def test_group_hook_summarises_a_group_once_and_a_hot_one_in_parts(spark, monkeypatch, hot):
    monkeypatch.setattr(hooks, "HOT_ROWS", hot)
    calls = spark.sparkContext.accumulator(0)
    rows = [(u, float(i)) for i in range(20) for u in range(50)] + [(7, 1.0)] * 200 + [(None, 1.0)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(20)

    def partial(group):
        calls.add(1)
        return {"s": group["v"].sum(), "n": len(group)}

    out = hooks.apply_per_group(
        df, "k", "long", partial, lambda p: {"s": p["s"].sum(), "n": p["n"].sum()},
        "s double, n long")
    got = {r["k"]: (r["s"], r["n"]) for r in out.collect()}
    assert got == {u: (190.0 + 200 * (u == 7), 20 + 200 * (u == 7)) for u in range(50)}
    assert calls.value == 50 if hot > 1000 else 50 < calls.value <= 58
