"""Features of the order and timing of ratings.

Everything is computed from counts and sums per calendar bucket, or from the running
sums and positions of ``functions.stats``, which split very long histories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import ordered_index, running_by_key
from ratingloom.functions.times import days_between, whole_days

TIES_USER = ("movieId", "rating")
TIES_ITEM = ("userId", "rating")


def rating_trend(ratings: DataFrame, min_rows: int = 10) -> DataFrame:
    """Per user the slope of the rating over its position in time; 0 below ``min_rows`` rows."""
    indexed = ordered_index(
        ratings.select("userId", "movieId", "rating", "timestamp"), "userId", "timestamp",
        TIES_USER,
    )
    return indexed.groupBy("userId").agg(
        F.when(F.count(F.lit(1)) >= min_rows, F.regr_slope("rating", "idx")).alias("rating_trend")
    ).fillna(0.0, subset=["rating_trend"])


def month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def rating_acceleration(ratings: DataFrame, min_rows: int = 20, min_months: int = 3) -> DataFrame:
    """Per user the mean second difference of the monthly counts, empty months included.

    The second differences telescope, so only the first two and last two months matter.
    """
    monthly = ratings.groupBy("userId", month_number(F.col("timestamp")).alias("m")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_user = Window.partitionBy("userId")
    ends = monthly.withColumns({
        "lo": F.min("m").over(per_user), "hi": F.max("m").over(per_user)
    })

    def at(month: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("m") == month, F.col("n"))), F.lit(0))

    lo, hi = F.col("lo"), F.col("hi")
    out = ends.groupBy("userId").agg(
        F.sum("n").alias("rows"), (F.max("hi") - F.min("lo") + 1).alias("months"),
        ((at(hi) - at(hi - 1)) - (at(lo + 1) - at(lo))).alias("change"),
    )
    long_enough = (F.col("rows") >= min_rows) & (F.col("months") >= min_months)
    return out.select(
        "userId",
        F.when(long_enough, F.col("change") / (F.col("months") - 2)).otherwise(0.0)
        .alias("rating_acceleration"),
    )


def user_temporal(ratings: DataFrame) -> DataFrame:
    """Per user: dates, active days, pace, acceleration, trend, weekend and night shares.

    The ratings are staged, so their source is read once.
    """
    ratings = stage(ratings.select("userId", "movieId", "rating", "timestamp"))
    hour = F.hour("timestamp")
    base = ratings.groupBy("userId").agg(
        F.min("timestamp").alias("first_rating_date"),
        F.max("timestamp").alias("last_rating_date"),
        F.count(F.lit(1)).alias("_n"),
        F.avg((F.weekday("timestamp") >= 5).cast("double")).alias("weekend_preference"),
        F.avg((hour.between(22, 23) | hour.between(0, 5)).cast("double")).alias("night_owl_score"),
    ).withColumn("active_days",
                 whole_days(F.col("first_rating_date"), F.col("last_rating_date")))
    return (
        base.withColumn("rating_velocity",
                        F.col("_n") / F.greatest(F.col("active_days"), F.lit(1)))
        .drop("_n")
        .join(rating_acceleration(ratings), "userId")
        .join(rating_trend(ratings), "userId")
    )


def rating_momentum(ratings: DataFrame, min_rows: int = 10) -> DataFrame:
    """Per item the mean of the later half minus the mean of the earlier half."""
    indexed = ordered_index(
        ratings.select("userId", "movieId", "rating", "timestamp"), "movieId", "timestamp",
        TIES_ITEM,
    )
    late = F.col("idx") >= F.floor(F.col("n_rows") / 2)
    return indexed.groupBy("movieId").agg(
        F.when(
            F.count(F.lit(1)) >= min_rows,
            F.avg(F.when(late, F.col("rating"))) - F.avg(F.when(~late, F.col("rating"))),
        ).alias("rating_momentum")
    ).fillna(0.0, subset=["rating_momentum"])


def rating_volatility(ratings: DataFrame, days: int = 30, hot_rows: int | None = None
                      ) -> DataFrame:
    """Per item the mean over its ratings of the deviation in the trailing window (t - days, t].

    Sums per distinct time replace the rows. Each enters at its time and leaves ``days``
    later with the opposite sign, so a running sum over both holds exactly the window, and
    no frame is ever scanned again.
    """
    instants = ratings.groupBy("movieId", "timestamp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"),
        F.sum(F.col("rating") * F.col("rating")).alias("q"),
    )
    moves = instants.select("movieId", F.inline(F.array(
        F.struct(F.col("timestamp").alias("t"), F.col("n").alias("rows"), F.col("n"),
                 F.col("s"), F.col("q")),
        F.struct((F.col("timestamp") + F.expr(f"interval {days} days")).alias("t"),
                 F.lit(0).cast("long").alias("rows"), (-F.col("n")).alias("n"),
                 (-F.col("s")).alias("s"), (-F.col("q")).alias("q")),
    )))
    inside = running_by_key(
        moves, "movieId", "t", (), {f"in_{c}": F.col(c) for c in "nsq"}, peers=True,
        hot_rows=hot_rows,
    ).where("rows > 0")
    n, s, q = (F.col(f"in_{c}") for c in "nsq")
    std = F.when(n > 1, F.sqrt(F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1)))
    return inside.groupBy("movieId").agg(
        F.coalesce(
            F.try_divide(F.sum(std * F.col("rows")), F.sum(F.when(n > 1, F.col("rows")))),
            F.lit(0.0),
        ).alias("rating_volatility")
    )


def monthly_levels(ratings: DataFrame) -> DataFrame:
    """``movieId, month`` (its last day) with count, sum and first time of the ratings."""
    return ratings.groupBy("movieId", F.last_day("timestamp").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"),
        F.min("timestamp").alias("first_rating"),
    )


def peak_month(ratings: DataFrame) -> DataFrame:
    """Per item the last day of the month with the highest mean rating, the earliest on a tie."""
    return _peak(monthly_levels(ratings))


def _peak(monthly: DataFrame) -> DataFrame:
    low = (-F.col("s") / F.col("n")).alias("m")
    return monthly.groupBy("movieId").agg(
        F.min(F.struct(low, "month"))["month"].alias("peak_rating_period")
    )


def rating_decay(ratings: DataFrame, min_rows: int = 20, min_quarters: int = 4) -> DataFrame:
    """Per item minus the slope of ln(quarterly mean) over the quarter index.

    Empty quarters keep their index and are left out of the fit.
    """
    return _decay(monthly_levels(ratings), min_rows, min_quarters)


def _decay(monthly: DataFrame, min_rows: int = 20, min_quarters: int = 4) -> DataFrame:
    quarterly = monthly.groupBy(
        "movieId", (F.year("month") * 4 + F.quarter("month")).alias("quarter")
    ).agg((F.sum("s") / F.sum("n")).alias("m"), F.sum("n").alias("n"))
    level = F.log(F.col("m") + F.lit(1e-10))
    out = quarterly.groupBy("movieId").agg(
        F.sum("n").alias("rows"),
        (F.max("quarter") - F.min("quarter") + 1).alias("quarters"),
        F.regr_slope(level, F.col("quarter")).alias("slope"),
    )
    enough = (F.col("rows") >= min_rows) & (F.col("quarters") >= min_quarters)
    return out.select(
        "movieId",
        F.coalesce(F.when(enough, -F.col("slope")), F.lit(0.0)).alias("rating_decay_rate"),
    )


def movie_temporal(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per item: days from release to the first rating, momentum, volatility, peak, decay.

    The ratings are staged, so their source is read once; first rating, peak and decay come
    from one table of months.
    """
    ratings = stage(ratings.select("userId", "movieId", "rating", "timestamp"))
    monthly = stage(monthly_levels(ratings))
    release = F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    first = (
        monthly.groupBy("movieId").agg(F.min("first_rating").alias("first_rating"))
        .join(movies.select("movieId", "year"), "movieId", "left")
        .select(
            "movieId",
            F.when(F.col("year") > 1900,
                   F.floor(days_between(release, F.col("first_rating"))).cast("long"))
            .alias("release_to_first_rating"),
        )
    )
    return (
        first.join(rating_momentum(ratings), "movieId")
        .join(rating_volatility(ratings), "movieId")
        .join(_peak(monthly), "movieId")
        .join(_decay(monthly), "movieId")
    )
