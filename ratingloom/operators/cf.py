"""Neighbourhood collaborative filtering: similarities, prediction, recommendation, evaluation.

Entities are users or items. A pair table holds ``a, b, sim, n_common`` with ``a < b``. Given a
threshold ``least`` it comes from a threshold join (``simjoin``), without one from the blocked
product of all pairs (``gram``). Prediction needs no pair table: similarities are computed for the
requested entities and only the best are kept (``neighbors``). One rating per (user, item) is assumed: see
``clean.latest_ratings``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import dense_index
from ratingloom.operators import sweep
from ratingloom.operators.gram import (
    MAX_TASKS, TASK_PRODUCTS, _met, _short, gram_best, gram_pairs, labelled, sizes, sweeps)
from ratingloom.operators.matrix import known_pairs_filter
from ratingloom.operators.neighbors import context_topk
from ratingloom.operators.simjoin import cosine_pairs, jaccard_pairs, overlap_pairs, whole_pairs

LOW, HIGH = 0.5, 5.0
#: Contexts with at most this many entries are joined directly; see ``topk_neighbors``.
WIDE = 1000

KEYS = {"user": ("userId", "movieId"), "item": ("movieId", "userId")}


def vectors(ratings: DataFrame, of: str, center: str | None = None, kept: Sequence[str] = ()) -> DataFrame:
    """``r, f, v``: unit-length rating vectors of users or items, and the columns ``kept`` of ``ratings``.

    ``center``: ``"own"`` subtracts the entity's mean, ``"other"`` the mean of the other
    side (the user's mean for items). A vector without length stays zero.
    """
    row, other = KEYS[of]
    entries = ratings.select(F.col(row).alias("r"), F.col(other).alias("f"),
                             F.col("rating").alias("v"), *kept)
    if center:
        key = "r" if center == "own" else "f"
        means = entries.groupBy(key).agg(F.avg("v").alias("m"))
        entries = entries.join(means, key).select("r", "f", (F.col("v") - F.col("m")).alias("v"), *kept)
    norms = entries.groupBy("r").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    unit = F.coalesce(F.try_divide(F.col("v"), F.col("norm")), F.lit(0.0))
    return entries.join(norms, "r").select("r", "f", unit.alias("v"), *kept)


def co_rating_pairs(ratings: DataFrame, of: str = "user", least: int | None = None) -> DataFrame:
    """``a, b, dot, n_common`` of the raw ratings; with ``least`` common ratings, if given."""
    row, other = KEYS[of]
    entries = ratings.select(F.col(row).alias("r"), F.col(other).alias("f"), F.col("rating").alias("v"))
    return overlap_pairs(entries, least) if least else gram_pairs(entries)


def _as_similarity(pairs: DataFrame, min_common: int) -> DataFrame:
    return pairs.where(F.col("n_common") >= min_common).withColumnRenamed("dot", "sim")


def similarity(ratings: DataFrame, of: str = "user", center: str | None = None,
               min_common: int = 1, least: float | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Cosine of the (centred) rating vectors of every pair with common ratings, or of the pairs
    that reach ``least``. Every pair brings ``label_a`` and ``label_b`` of ``labels(entity, label)``."""
    if least:
        return cosine_pairs(vectors(ratings, of, center), least, min_common)
    return _as_similarity(gram_pairs(vectors(ratings, of, center), labels=labels), min_common)


def shrunk_similarity(ratings: DataFrame, of: str, center: str | None, least: float,
                      strength: float = 100.0) -> DataFrame:
    """The pairs whose similarity, shrunk by ``strength``, reaches ``least``.

    Two rows have at most as many common ratings as the shorter one has ratings, so the plain
    similarity has to reach ``least`` (n + strength) / n for the n of both.
    """
    pairs = cosine_pairs(vectors(ratings, of, center), lambda n: F.lit(least) * (n + F.lit(strength)) / n)
    return shrink(pairs, strength).where(F.round("sim", 9) >= least)


def jaccard(ratings: DataFrame, of: str = "user", min_common: int = 1,
            least: float | None = None) -> DataFrame:
    """Common ratings over all ratings of the two, of every pair or of those that reach ``least``."""
    row, other = KEYS[of]
    entries = ratings.select(F.col(row).alias("r"), F.col(other).alias("f"), F.lit(1.0).alias("v"))
    if least:
        return jaccard_pairs(entries, least).where(F.col("n_common") >= min_common)
    sizes = entries.groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    union = F.col("label_a") + F.col("label_b") - F.col("n_common")
    return (
        gram_pairs(entries, labels=sizes).where(
            (F.col("n_common") >= min_common) & F.col("label_a").isNotNull() & F.col("label_b").isNotNull())
        .select("a", "b", (F.col("n_common") / union).alias("sim"), "n_common")
    )


def similarity_to(units: DataFrame, wanted: DataFrame, min_common: int = 1) -> DataFrame:
    """The pair table restricted to pairs with one of the few ``wanted(r)`` rows.

    For answering requests: work and output are linear in the ratings for each wanted row.
    """
    mine = units.join(wanted, "r", "left_semi").toDF("x", "f", "w")
    both = mine.join(units.toDF("y", "f", "v"), "f").where("x <> y")
    sums = both.groupBy("x", "y").agg(
        F.sum(F.col("w") * F.col("v")).alias("sim"), F.count(F.lit(1)).alias("n_common"))
    # a pair of two wanted rows was found from both sides
    return (
        sums.where(F.col("n_common") >= min_common)
        .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .agg(F.max("sim").alias("sim"), F.max("n_common").alias("n_common"))
    )


def directed_to(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """``entity, neighbor, sim, n_common``: the pairs of ``similarity_to``, from each ``wanted(r)`` row.

    All rows pass blocks of the wanted ones if that shuffles less than the products.
    """
    cores = units.sparkSession.sparkContext.defaultParallelism
    size = sizes(units)
    mine = units.join(wanted, "r", "left_semi")
    met = units.groupBy("f").agg(F.count(F.lit(1)).cast("double").alias("n")).join(
        mine.groupBy("f").agg(F.count(F.lit(1)).alias("mine")), "f")
    products = met.agg(F.coalesce(F.sum(F.col("n") * F.col("mine")), F.lit(0.0))).first()[0]
    if sweeps(units, size, products, cores, 1.0):
        pairs = sweep.pairs_to(units, wanted, sweep.block_count(size["n"], cores), _short(size))
        return pairs.select(F.col("a").alias("entity"), F.col("b").alias("neighbor"), F.col("dot").alias("sim"), "n_common")
    return both_ways(similarity_to(units, wanted)).join(wanted.withColumnRenamed("r", "entity"), "entity", "left_semi")


def both_ways(pairs: DataFrame) -> DataFrame:
    """``entity, neighbor, sim, n_common``: every pair in both directions, from one scan."""
    return pairs.select("sim", "n_common", F.inline(F.array(
        F.struct(F.col("a").alias("entity"), F.col("b").alias("neighbor")),
        F.struct(F.col("b").alias("entity"), F.col("a").alias("neighbor")),
    ))).select("entity", "neighbor", "sim", "n_common")


def cluster_boost(pairs: DataFrame, clusters: DataFrame, factor: float = 1.2) -> DataFrame:
    """Similarity times ``factor``, at most 1, where both belong to the same cluster.

    Pairs that bring their clusters as ``label_a`` and ``label_b`` are not joined with ``clusters``."""
    found = pairs if "label_a" in pairs.columns else labelled(pairs, clusters)
    boosted = F.when(F.col("label_a") == F.col("label_b"), F.least(F.col("sim") * factor, F.lit(1.0)))
    return found.select("a", "b", F.coalesce(boosted, F.col("sim")).alias("sim"), "n_common")


def shrink(pairs: DataFrame, strength: float = 100.0) -> DataFrame:
    """Similarity weighted by n / (n + strength), n the common ratings."""
    return pairs.withColumn(
        "sim", F.col("sim") * F.col("n_common") / (F.col("n_common") + F.lit(strength)))


def content_units(content: DataFrame) -> DataFrame:
    """``r, f, v``: unit vectors of content ``(movieId, feature, value)``."""
    entries = content.join(dense_index(content, "feature", "f"), "feature").select(
        F.col("movieId").alias("r"), "f", F.col("value").cast("double").alias("v"))
    norms = entries.groupBy("r").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    return entries.join(norms, "r").select(
        "r", "f", F.coalesce(F.try_divide("v", "norm"), F.lit(0.0)).alias("v"))


def hybrid_pairs(ratings: DataFrame, content: DataFrame, least: float, cf_weight: float = 0.8,
                 center: str | None = None) -> DataFrame:
    """The item pairs whose hybrid similarity reaches ``least``.

    Neither part is above one, so a pair reaches it only if its ratings or its content reach
    ``least``: what the two threshold joins find is all there is, and is then weighed whole.
    """
    units, described = stage(vectors(ratings, "item", center)), stage(content_units(content))
    found = stage(cosine_pairs(units, least).select("a", "b").unionByName(
        cosine_pairs(described, least).select("a", "b")).distinct())
    sizes = units.select("r", "f").unionByName(described.select("r", "f")).groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    found = stage(found.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b"))
    rated, alike = whole_pairs(units, found), whole_pairs(described, found)
    zero = F.lit(0.0)
    sim = (F.lit(cf_weight) * F.coalesce(F.col("dot"), zero)
           + F.lit(1 - cf_weight) * F.coalesce(F.col("content"), zero))
    return (found.select("a", "b").join(rated, ["a", "b"], "left")
            .join(alike.select("a", "b", F.col("dot").alias("content")), ["a", "b"], "left")
            .select("a", "b", sim.alias("sim"), F.coalesce("n_common", F.lit(0)).alias("n_common"))
            .where(F.round("sim", 9) >= least))


def hybrid_similarity(pairs: DataFrame, content: DataFrame, cf_weight: float = 0.8) -> DataFrame:
    """Weighted sum of rating similarity and cosine of content ``(movieId, feature, value)``."""
    content_pairs = gram_pairs(content_units(content)).select("a", "b", F.col("dot").alias("_c"))
    zero = F.lit(0.0)
    return pairs.join(content_pairs, ["a", "b"], "full").select(
        "a", "b",
        (F.lit(cf_weight) * F.coalesce("sim", zero)
         + F.lit(1 - cf_weight) * F.coalesce("_c", zero)).alias("sim"),
        F.coalesce("n_common", F.lit(0)).alias("n_common"),
    )


def by_similarity(*partition: str) -> Window:
    """Most similar first; the digits floating-point noise reaches do not decide a tie."""
    return Window.partitionBy(*partition).orderBy(F.desc(F.round("sim", 9)), "neighbor")


def nearest(directed: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar neighbours of every entity."""
    place = F.row_number().over(by_similarity("entity"))
    return directed.withColumn("place", place).where(F.col("place") <= k)


def nearest_neighbors(ratings: DataFrame, of: str, k: int, center: str | None = None) -> DataFrame:
    """``entity, neighbor, sim, place``: the ``k`` most similar entities of every entity,
    without a table of all pairs."""
    best = gram_best(vectors(ratings, of, center), k).select(
        F.col("a").alias("entity"), F.col("b").alias("neighbor"), F.col("dot").alias("sim"))
    return nearest(best, k)


def topk_neighbors(targets: DataFrame, train: DataFrame, pairs: DataFrame, of: str, k: int,
                   wide: int = WIDE) -> DataFrame:
    """``entity, context, neighbor, sim, rating, place``: for each target the ``k`` most
    similar entities that have a rating in the target's context, with positive similarity.

    For users the context is the item, for items it is the user. Joining every target with
    every rating of its context is fine while a context has at most ``wide`` ratings. For
    contexts beyond that, an entity's ``wide`` nearest neighbours are tried first: a target
    that finds ``k`` of them in its context is done, since everyone else is farther away.
    Only targets that find fewer go through the whole context, so the result is exact.
    """
    row, other = KEYS[of]
    wanted = targets.select(F.col(row).alias("entity"), F.col(other).alias("context")).distinct()
    rated = train.select(F.col(other).alias("context"), F.col(row).alias("neighbor"), "rating")
    positive = pairs.where(F.col("sim") > 0).select("a", "b", "sim", "n_common")
    crowded = (
        rated.groupBy("context").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > wide).select("context")
    )
    columns = ["entity", "context", "neighbor", "sim", "rating"]

    def whole_context(part: DataFrame) -> DataFrame:
        met = part.join(rated, "context").withColumns({
            "a": F.least("entity", "neighbor"), "b": F.greatest("entity", "neighbor")})
        return met.join(positive, ["a", "b"]).select(*columns)

    if not crowded.limit(1).count():
        found = whole_context(wanted)
    else:
        quiet = wanted.join(crowded, "context", "left_anti")
        busy = wanted.join(crowded, "context", "left_semi")
        near = nearest(both_ways(positive).join(
            busy.select("entity").distinct(), "entity", "left_semi"), wide)
        sizes = near.groupBy("entity").agg(F.count(F.lit(1)).alias("listed"))
        hits = (
            busy.join(near, "entity").join(rated, ["context", "neighbor"]).select(*columns)
        )
        counts = hits.groupBy("entity", "context").agg(F.count(F.lit(1)).alias("hits"))
        # a list shorter than ``wide`` holds every positive neighbour there is
        done = (
            busy.join(counts, ["entity", "context"], "left").join(sizes, "entity", "left")
            .where((F.coalesce("hits", F.lit(0)) >= k)
                   | (F.coalesce("listed", F.lit(0)) < wide))
            .select("entity", "context")
        )
        rest = busy.join(done, ["entity", "context"], "left_anti")
        found = (
            whole_context(quiet)
            .unionByName(hits.join(done, ["entity", "context"], "left_semi").select(*columns))
            .unionByName(whole_context(rest))
        )
    place = F.row_number().over(by_similarity("entity", "context"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def clip(c: Column) -> Column:
    """Into the rating scale; null stays null, which least and greatest alone would skip."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(LOW)), F.lit(HIGH)))


def _combine(neighbors: DataFrame, value: Column, ks: Sequence[int]) -> DataFrame:
    """``entity, context, shifts``: the weighted mean of ``value`` over the first k neighbours, for every k of ``ks``."""
    def mean(k: int) -> Column:
        near = F.col("place") <= k
        return F.sum(F.when(near, F.col("sim") * value)) / F.sum(F.when(near, F.col("sim")))

    return neighbors.groupBy("entity", "context").agg(F.array(*[mean(k) for k in ks]).alias("shifts"))


def nearest_raters(targets: DataFrame, train: DataFrame, of: str, k: int, center: str | None = None,
                   shrinkage: float = 0.0) -> DataFrame:
    """What ``topk_neighbors`` finds, from cosines of the requested entities only."""
    row, other = KEYS[of]
    return context_topk(targets.select(F.col(row).alias("entity"), F.col(other).alias("context")),
                        vectors(train, of, center, ["rating"]), k, shrinkage)


def predict_user_cf(targets: DataFrame, train: DataFrame, pairs: DataFrame | None = None,
                    ks: Sequence[int] = (50,), bias: bool = True, wide: int = WIDE,
                    center: str | None = None) -> DataFrame:
    """``k`` and ``prediction`` for each target (userId, movieId).

    Neighbours are the users of the largest cosine (``center`` as in ``vectors``), or come from
    ``pairs``, a pair table of another similarity.

    The user's mean plus the weighted deviations of the k most similar raters from their
    own means, clipped to the rating scale. The mean alone without such raters; null when
    the user or the item is unknown.
    """
    means = train.groupBy("userId").agg(F.avg("rating").alias("mean"))
    known = known_pairs_filter(targets.select("userId", "movieId").distinct(), train)
    top = (topk_neighbors(known, train, pairs, "user", max(ks), wide) if pairs is not None
           else nearest_raters(known, train, "user", max(ks), center))
    value = F.col("rating") - F.col("mean") if bias else F.col("rating")
    shifts = _combine(top.join(means.toDF("neighbor", "mean"), "neighbor"), value, ks)
    base = F.col("mean") if bias else F.lit(0.0)
    predicted = (
        known.join(means, "userId")
        .join(shifts.toDF("userId", "movieId", "shifts"), ["userId", "movieId"], "left")
        .select("userId", "movieId", _each(ks, lambda shift: F.coalesce(clip(base + shift), F.col("mean"))))
    )
    return _with_unknown(targets, predicted, ks)


def predict_item_cf(targets: DataFrame, train: DataFrame, pairs: DataFrame | None = None,
                    ks: Sequence[int] = (30,), wide: int = WIDE, center: str | None = "other",
                    shrinkage: float = 100.0) -> DataFrame:
    """The baseline (global mean, user and item bias) plus the weighted deviations of the
    user's k most similar rated items from their baselines, clipped. The baseline alone
    without such items; null when the user or the item is unknown.

    Neighbours are the items of the largest shrunk cosine, or come from ``pairs``.
    """
    mean = train.agg(F.avg("rating")).first()[0]
    users = train.groupBy("userId").agg((F.avg("rating") - F.lit(mean)).alias("bu"))
    items = train.groupBy("movieId").agg((F.avg("rating") - F.lit(mean)).alias("bi"))
    known = known_pairs_filter(targets.select("userId", "movieId").distinct(), train)
    top = (topk_neighbors(known, train, pairs, "item", max(ks), wide) if pairs is not None
           else nearest_raters(known, train, "item", max(ks), center, shrinkage))
    rich = top.join(items.toDF("neighbor", "bj"), "neighbor").join(
        users.toDF("context", "bu"), "context")
    shifts = _combine(rich, F.col("rating") - (F.lit(mean) + F.col("bu") + F.col("bj")), ks)
    baseline = F.lit(mean) + F.col("bu") + F.col("bi")
    predicted = (
        known.join(users, "userId").join(items, "movieId")
        .join(shifts.toDF("movieId", "userId", "shifts"), ["userId", "movieId"], "left")
        .select("userId", "movieId", _each(ks, lambda shift: F.coalesce(clip(baseline + shift), baseline)))
    )
    return _with_unknown(targets, predicted, ks)


def _each(ks: Sequence[int], value: Callable[[Column], Column]) -> Column:
    """``predictions``: ``value`` of the shift of every k."""
    return F.array(*[value(F.col("shifts")[i]) for i in range(len(ks))]).alias("predictions")


def _with_unknown(targets: DataFrame, predicted: DataFrame, ks: Sequence[int]) -> DataFrame:
    every = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col("predictions")[i].alias("prediction"))
                               for i, k in enumerate(ks)]))
    columns = [c for c in targets.columns if c not in ("userId", "movieId")]
    return (
        targets.join(predicted, ["userId", "movieId"], "left")
        .select("userId", "movieId", *columns, every)
        .select("k", "userId", "movieId", *columns, "prediction")
    )


# --- recommendation -----------------------------------------------------------------------------

def candidate_items(requests: DataFrame, ratings: DataFrame) -> DataFrame:
    """``userId, movieId``: every rated item each requested user has not rated.

    The product of the request table and the items is what is asked for; ask for a list of
    users, not for all. It is not shuffled: an item brings the requested users who rated it, at
    most the request table, and leaves them out where the product is made.
    """
    wanted = stage(requests.select("userId").distinct())
    seen = ratings.join(wanted, "userId", "left_semi").select("userId", "movieId")
    raters = seen.groupBy("movieId").agg(F.collect_set("userId").alias("raters"))
    items = ratings.select("movieId").distinct().join(raters, "movieId", "left")
    rated = F.coalesce(F.array_contains("raters", F.col("userId")), F.lit(False))
    return items.crossJoin(wanted).where(~rated).select("userId", "movieId")


def deciding_predictions(requests: DataFrame, ratings: DataFrame, n: int, k: int, center: str | None) -> DataFrame:
    """``userId, movieId, prediction`` of those ``candidate_items`` that can be among the ``n`` best of
    ``predict_user_cf``.

    The users who have an item in common with a requested one bring all their ratings to it, packed;
    the items met so are predicted and ordered where they come together. Any other item is predicted the
    user's mean: the first ``n`` of these by id are found by counting the met items before an id.
    """
    index = stage(dense_index(ratings, "movieId", "at"))
    means = ratings.groupBy("userId").agg(F.avg("rating").alias("mean"))
    units = stage(vectors(ratings.join(means, "userId"), "user", center, ["rating", "mean"]))
    wanted = requests.select(F.col("userId").alias("r")).distinct()
    mine = units.join(wanted, "r", "left_semi")
    own = stage(mine.groupBy(F.col("r").alias("a")).agg(F.first("mean").alias("mean")))
    near = stage(_met(mine, units).groupBy("a", "b").agg(F.sum("p").alias("sim")))
    theirs = units.join(index, units["f"] == index["movieId"]).groupBy(F.col("r").alias("b")).agg(
        F.first("mean").alias("theirs"), F.collect_list(F.struct("at", "rating")).alias("e")).select(
            "b", "theirs", F.col("e.at").alias("at"), F.col("e.rating").alias("rating"))
    many = near.join(units.groupBy(F.col("r").alias("b")).agg(F.count(F.lit(1)).alias("n")), "b").agg(F.sum("n")).first()[0]
    tasks = min(max(units.sparkSession.sparkContext.defaultParallelism, math.ceil((many or 0) / TASK_PRODUCTS)), MAX_TASKS)
    lists = near.join(own, "a").join(theirs, "b").repartition(tasks, "a")
    met = lists.select("a", "b", "mean", "theirs", "sim", (F.col("a") == F.col("b")).alias("seen"),
                       F.inline(F.arrays_zip("at", "rating")))
    raters = Window.partitionBy("a", "at").orderBy(F.desc("seen"), F.desc(F.round("sim", 9)), "b")
    close = (F.col("sim") > 0) & ~F.col("seen")
    shift = (F.sum(F.when(close, F.col("sim") * (F.col("rating") - F.col("theirs"))))
             / F.sum(F.when(close, F.col("sim"))))
    predicted = (
        met.withColumn("place", F.row_number().over(raters)).where(F.col("place") <= k)
        .groupBy("a", "at").agg(F.max("seen").alias("seen"), F.first("mean").alias("mean"), shift.alias("shift"))
        .select("a", "at", "seen", F.coalesce(clip(F.col("mean") + F.col("shift")), F.col("mean")).alias("prediction"))
    )
    best = Window.partitionBy("a").orderBy("seen", F.desc(F.round("prediction", 9)), "at")
    free = F.col("at") - F.row_number().over(Window.partitionBy("a").orderBy("at")) + 1
    kept = stage(predicted.withColumns({"place": F.row_number().over(best), "free": free}).where(
        (~F.col("seen") & (F.col("place") <= n)) | (F.col("free") < n)))
    taken = kept.where(F.col("free") < n)
    spans = own.join(taken.groupBy("a").agg(F.count(F.lit(1)).alias("c")), "a", "left")
    rest = spans.select("a", F.col("mean").alias("prediction"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce("c", F.lit(0)) + F.lit(n - 1))).alias("at")).join(taken, ["a", "at"], "left_anti")
    return kept.where(~F.col("seen")).select("a", "at", "prediction").unionByName(rest).join(index, "at").select(
        F.col("a").alias("userId"), "movieId", "prediction")


def best_first(predicted: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("userId").orderBy(F.desc(F.round("prediction", 9)), "movieId")
    return (
        predicted.where(F.col("prediction").isNotNull())
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    )


def recommend_user_cf(requests: DataFrame, ratings: DataFrame, n: int = 10, k: int = 50,
                      center: str | None = None) -> DataFrame:
    """The ``n`` unseen items with the highest predictions for each requested user."""
    return best_first(deciding_predictions(requests, ratings, n, k, center), n)


def first_unseen(requests: DataFrame, mine: DataFrame, ratings: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of ``candidate_items`` by id for each requested user, whose ratings are ``mine``.

    They are among the first n items and as many more as the user has rated."""
    index = stage(dense_index(ratings, "movieId", "at"))
    spans = requests.select("userId").distinct().join(mine.groupBy("userId").agg(
        F.count(F.lit(1)).alias("c")), "userId", "left")
    first = spans.select("userId", F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce("c", F.lit(0)) + F.lit(n - 1))).alias("at"))
    place = F.row_number().over(Window.partitionBy("userId").orderBy("movieId"))
    return (first.join(index, "at").join(mine, ["userId", "movieId"], "left_anti")
            .withColumn("p", place).where(F.col("p") <= n).select("userId", "movieId"))


def recommend_item_cf(requests: DataFrame, ratings: DataFrame, n: int = 10, k: int = 30,
                      center: str | None = "other", shrinkage: float = 100.0,
                      liked: float = 4.0) -> DataFrame:
    """For each requested user the best of the ``2n`` unseen items closest to an item they
    rated ``liked`` or more; of the first unseen items when they liked none.

    Of ``candidate_items`` only those close to a liked item are made, or the first ones.
    """
    mine = ratings.join(requests.select("userId"), "userId", "left_semi")
    fans = mine.where(F.col("rating") >= liked).select(
        "userId", F.col("movieId").alias("entity"))
    units = stage(vectors(ratings, "item", center))
    near = shrink(directed_to(units, stage(fans.select(F.col("entity").alias("r")).distinct())), shrinkage)
    closeness = (
        fans.join(near.where(F.col("sim") > 0), "entity")
        .groupBy("userId", F.col("neighbor").alias("movieId")).agg(F.max("sim").alias("sim"))
        .join(mine, ["userId", "movieId"], "left_anti")
    )
    others = requests.select("userId").join(fans, "userId", "left_anti")
    without = first_unseen(others, mine, ratings, 2 * n).withColumn("sim", F.lit(0.0))
    order = Window.partitionBy("userId").orderBy(F.desc(F.round("sim", 9)), "movieId")
    short = stage(
        closeness.unionByName(without).withColumn("p", F.row_number().over(order))
        .where(F.col("p") <= 2 * n).select("userId", "movieId")
    )
    return best_first(predict_item_cf(short, ratings, ks=(k,), center=center, shrinkage=shrinkage).drop("k"), n)


# --- evaluation -----------------------------------------------------------------------------------

def split_hash(*keys: str) -> Column:
    """Arithmetic hash of one or two integer keys, 0 up to 2^32."""
    mixed = F.pmod(F.col(keys[0]), F.lit(2147483648)) * F.lit(2654435761)
    for c in keys[1:]:
        mixed = mixed + F.pmod(F.col(c), F.lit(2147483648)) * F.lit(40503)
    return F.pmod(mixed, F.lit(4294967296))


def train_test_split(df: DataFrame, keys: Sequence[str], train_share: float = 0.8
                     ) -> tuple[DataFrame, DataFrame]:
    """Repeatable split: a row's keys alone decide its side."""
    cut = int(train_share * 4294967296)
    inside = split_hash(*keys) < cut
    return df.where(inside), df.where(~inside)


def stratified_split(df: DataFrame, keys: Sequence[str], label: str, train_share: float = 0.8
                     ) -> tuple[DataFrame, DataFrame]:
    """The same with one cut per class, so every class is split in the same proportion."""
    hashed = stage(df.withColumn("_h", split_hash(*keys)))
    # staged, a few classes are seen to be few: a join on them would deal the rows to as few tasks
    cuts = stage(_cuts(hashed.select(F.col(label).alias("_label"), "_h"), train_share))
    marked = hashed.join(cuts, F.col(label).eqNullSafe(F.col("_label")))
    inside = F.col("_h") < F.col("_cut")
    return marked.where(inside).select(*df.columns), marked.where(~inside).select(*df.columns)


def _cuts(hashed: DataFrame, share: float) -> DataFrame:
    """``_label, _cut``: the exact quantile ``share`` of ``_h`` (0 up to 2^32) in every class.

    Counts per (class, leading 16 bits) find the two buckets the rank falls between; only
    their rows are counted by value. However large a class is, a window sees 65,536 sums of it.
    """
    bucket = F.shiftright("_h", 16).alias("_bucket")
    upto = Window.partitionBy("_label").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_label")

    def counted(rows: DataFrame, at: Column) -> DataFrame:
        return rows.groupBy("_label", at.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))

    rank = F.lit(share) * (F.col("_rows") - 1)
    coarse = counted(hashed, bucket).withColumns({
        "_upto": F.sum("_n").over(upto), "_rows": F.sum("_n").over(whole)})
    ends = coarse.groupBy("_label").agg(
        F.max(rank).alias("_rank"),
        F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_at"))).alias("_lo"),
        F.min(F.when(F.col("_upto") > F.ceil(rank), F.col("_at"))).alias("_hi"),
        F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_upto") - F.col("_n")))
        .alias("_before"),
    ).withColumnRenamed("_label", "_class")
    same = F.col("_label").eqNullSafe(F.col("_class"))
    near = hashed.withColumn("_bucket", bucket).join(
        stage(ends), same & F.col("_bucket").between(F.col("_lo"), F.col("_hi")))
    fine = near.groupBy("_label", "_rank", "_before", F.col("_h").alias("_at")).agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(upto)
                                                  + F.col("_before"))
    low, high = F.floor("_rank"), F.ceil("_rank")
    return fine.groupBy("_label").agg(
        F.min(F.when(F.col("_upto") > low, F.col("_at"))).alias("_a"),
        F.min(F.when(F.col("_upto") > high, F.col("_at"))).alias("_b"),
        F.max(F.col("_rank") - low).alias("_part"),
    ).select("_label", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part"))
             .alias("_cut"))


def evaluate_cf(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, coverage and number of predictions over rows with ``rating``."""
    error = F.col("rating") - F.col("prediction")
    return predicted.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        (F.count("prediction") / F.count(F.lit(1))).alias("coverage"),
        F.count("prediction").alias("n_predictions"),
    )


def cf_grid_search(train: DataFrame, test: DataFrame, centers: dict[str, str | None],
                   ks: Sequence[int] = (20, 50, 100)) -> DataFrame:
    """``metric, k`` with their scores; each metric's neighbours are ranked once for every k."""
    parts = []
    known = stage(known_pairs_filter(test, train))
    for metric, center in centers.items():
        predicted = predict_user_cf(known, train, ks=ks, center=center)
        parts.append(evaluate_cf(predicted, ["k"]).withColumn("metric", F.lit(metric)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def cf_compare(train: DataFrame, test: DataFrame, user_k: int = 50, item_k: int = 30) -> DataFrame:
    """Scores of user-based and item-based prediction on the same test rows."""
    known = stage(known_pairs_filter(test, train))
    users = predict_user_cf(known, train, ks=(user_k,))
    items = predict_item_cf(known, train, ks=(item_k,))
    return (
        evaluate_cf(users).withColumn("method", F.lit("user_based"))
        .unionByName(evaluate_cf(items).withColumn("method", F.lit("item_based")))
    )
