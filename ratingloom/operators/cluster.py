"""Clusters of users and items: features, k-means, two-level hierarchy, quality, profiles."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import quantiles
from ratingloom.operators import scale
from ratingloom.operators.clean import numeric_columns
from ratingloom.operators.features import user_statistics
from ratingloom.operators.genres import genre_names, user_genre_prefs
from ratingloom.operators.linkage import cut_spanning_tree, spanning_tree
from ratingloom.operators.matrix import outer_align
from ratingloom.operators.reduce import assemble, pca
from ratingloom.operators.tags import tag_frequency_pivot
from ratingloom.sources.schemas import NO_GENRES

#: Starts of k-means that are fitted at a time; each holds its own cached copy of the vectors.
STARTS_AT_ONCE = 4

SEGMENT_COLUMNS = ["rating_count", "rating_mean", "rating_std", "rating_min", "rating_max",
                   "movieId_nunique", "activity_span_days", "rating_frequency", "rating_range"]


def join_clusters(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Ratings with the cluster of their user and of their item."""
    return ratings.join(users, "userId").join(items, "movieId")


# --- features ---------------------------------------------------------------------------------

def segmentation_features(ratings: DataFrame, movies: DataFrame | None = None,
                          names: Sequence[str] | None = None) -> DataFrame:
    """Nine rating statistics per user and the mean ratings of the genres ``names`` (all)."""
    stats = user_statistics(ratings).select("userId", *SEGMENT_COLUMNS)
    if movies is None:
        return stats
    prefs = user_genre_prefs(ratings, movies, names)
    return stats.join(prefs, "userId", "left").fillna(0)


def movie_cluster_features(ratings: DataFrame, movies: DataFrame, tags: DataFrame | None = None
                           ) -> DataFrame:
    """Rating statistics, genre flags and, with tags, the counts of the 50 most used tags."""
    stats = ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("rating_mean"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.min("rating").alias("rating_min"), F.max("rating").alias("rating_max"),
        F.count_distinct("userId").alias("userId_nunique"),
    )
    names = genre_names(movies)
    flags = movies.select("movieId", *[
        F.array_contains("genre_list", g).cast("int").alias(g) for g in names if g != NO_GENRES
    ])
    blocks = [stats, flags] + ([tag_frequency_pivot(tags)] if tags is not None else [])
    return outer_align(blocks, "movieId", 0)


# --- k-means ------------------------------------------------------------------------------------

def kmeans(df: DataFrame, columns: Sequence[str], k: int, key: str, starts: int = 1,
           max_iter: int = 300, reduce_to: int | None = None, seed: int = 42,
           scaled: bool = True) -> tuple[DataFrame, float]:
    """``key, cluster`` and the training cost, on standard-scaled columns (as they are without
    ``scaled``).

    ``reduce_to`` projects wider data on that many components first. Of several starts the
    one with the lowest cost is kept; they do not depend on each other, so the short jobs of one
    fill the cores that those of another leave idle.
    """
    filled, names = df.fillna(0, subset=list(columns)), list(columns)
    if scaled:
        filled, names = scale.scale_standard(filled, columns), [f"{c}_scaled" for c in columns]
    if reduce_to is not None and len(names) > reduce_to:
        scores, _ = pca(filled.select(key, *names), names, k=reduce_to)
        data = scores.select(key, array_to_vector("pc").alias("features"))
    else:
        data = assemble(filled, names).select(key, "features")
    data = stage(data)

    def fit(start: int):
        model = KMeans(k=max(2, k), seed=seed + start, maxIter=max_iter).fit(data)
        return model, model.summary.trainingCost

    with ThreadPoolExecutor(STARTS_AT_ONCE) as pool:
        model, cost = min(pool.map(fit, range(starts)), key=lambda found: found[1])
    return model.transform(data).select(key, F.col("prediction").alias("cluster")), cost


def kmeans_users(features: DataFrame, k: int = 8, starts: int = 10) -> DataFrame:
    """User segments: scaled, at most ten components, best of ten starts."""
    columns = [c for c in features.columns if c != "userId"]
    return kmeans(features, columns, k, "userId", starts, reduce_to=10)[0]


def kmeans_cold_start(user_features: DataFrame, movie_features: DataFrame, fast: bool = False,
                      user_k: int = 20, item_k: int = 50) -> tuple[DataFrame, DataFrame]:
    """``user_k`` clusters of users by activity and ``item_k`` of items by content flags.

    The fast variant stops after ten iterations and takes the flags unscaled. (Rotating its four scaled features onto all
    four singular vectors would not change a distance, so that step is left out.)
    """
    if fast:
        columns = ["rating_count", "rating_mean", "rating_std", "movie_diversity"]
        hashed = [c for c in movie_features.columns if c.startswith("genre_hash_")]
        users = kmeans(user_features, columns, user_k, "userId", max_iter=10)
        items = kmeans(movie_features, hashed, item_k, "movieId", max_iter=10, scaled=False)
    else:
        columns = ["rating_count", "activity_span_days", "rating_frequency"]
        flags = [c for c in numeric_columns(movie_features)
                 if c.startswith("genre_") or c.startswith("is_")]
        users = kmeans(user_features, columns, user_k, "userId")
        items = kmeans(movie_features, flags, item_k, "movieId")
    return users[0], items[0]


def assign_clusters(df: DataFrame, vector: str, centroids: Sequence[Sequence[float]],
                    out: str = "cluster") -> DataFrame:
    """Index of the nearest centroid by squared distance, the lowest index on a tie."""

    def squared(center: Sequence[float]):
        values = F.array(*[F.lit(float(v)) for v in center])
        gaps = F.zip_with(F.col(vector), values, lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g)

    best = F.array_min(F.array(*[
        F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centroids)
    ]))
    return df.withColumn(out, best["i"])


def group_centroids(df: DataFrame, vector: str, group: str) -> DataFrame:
    """``group, centroid``: mean vector per group."""
    long = df.select(group, F.posexplode(vector).alias("pos", "v"))
    means = long.groupBy(group, "pos").agg(F.avg("v").alias("m"))
    entries = F.array_sort(F.collect_list(F.struct("pos", "m")))  # one entry per dimension
    return means.groupBy(group).agg(F.transform(entries, lambda e: e["m"]).alias("centroid"))


# --- two-level hierarchy ------------------------------------------------------------------------

def merge_tree(centers: np.ndarray, sizes: np.ndarray, linkage: str) -> list[tuple]:
    """``(a, b, height)`` merges of weighted points by the Lance-Williams recurrence.

    Runs on the table of micro-cluster centres, whose length is bounded.
    """
    n = len(centers)
    size = sizes.astype(float).copy()
    gap = ((centers[:, None, :] - centers[None, :, :]) ** 2).sum(2)
    if linkage == "ward":
        d = gap * 2 * size[:, None] * size[None, :] / (size[:, None] + size[None, :])
    else:
        d = np.sqrt(gap)
    np.fill_diagonal(d, np.inf)
    active = np.ones(n, dtype=bool)
    merges = []
    for _ in range(n - 1):
        a, b = sorted(divmod(int(np.argmin(d)), n))
        height = d[a, b]
        if linkage == "ward":
            total = size[a] + size[b] + size
            row = ((size[a] + size) * d[a] + (size[b] + size) * d[b] - size * height) / total
        elif linkage == "complete":
            row = np.maximum(d[a], d[b])
        elif linkage == "single":
            row = np.minimum(d[a], d[b])
        else:
            row = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        row[~active] = np.inf
        row[[a, b]] = np.inf
        d[a], d[:, a] = row, row
        d[b], d[:, b] = np.inf, np.inf
        active[b] = False
        size[a] += size[b]
        merges.append((a, b, float(np.sqrt(height) if linkage == "ward" else height)))
    return merges


def cut_tree(n: int, merges: list[tuple], k: int | None = None, height: float | None = None
             ) -> list[int]:
    """Labels 1.. of the ``n`` points for ``k`` clusters, a height, or the elbow."""
    if k is None and height is None:
        k = elbow([h for _, _, h in merges])
    done = [m for i, m in enumerate(merges)
            if (i < n - k if k is not None else m[2] <= height)]
    label = list(range(n))
    for a, b, _ in done:
        label = [a if x == b else x for x in label]
    names = {x: i + 1 for i, x in enumerate(sorted(set(label)))}
    return [names[x] for x in label]


#: Merges among which the elbow is looked for.
ELBOW_MERGES = 50


def elbow(heights: Sequence[float], last: int = ELBOW_MERGES) -> int:
    """The number of clusters at which the merge heights bend most (their second difference),
    looked for among the last merges; 1 if there are too few to bend.

    Going from k to k - 1 clusters costs the k-th height from the end.
    """
    top = min(last, len(heights))

    def bend(k: int) -> float:
        return heights[-(k - 1)] - 2 * heights[-k] + heights[-(k + 1)]

    return max(range(2, top), key=bend, default=1) if top > 2 else 1


def hierarchical_two_level(df: DataFrame, columns: Sequence[str], key: str,
                           linkages: Sequence[str] = ("ward",),
                           cuts: Sequence[int | None] = (None,), height: float | None = None,
                           micro: int = 500, seed: int = 42) -> dict:
    """``{(linkage, k): (key, cluster)}``: k-means micro-clusters on Spark, then linkage merges.

    ``micro`` is the resolution: so many centres reach the driver, whatever the number of rows;
    the labels go back to the rows as a lookup by micro-cluster. Single linkage needs no centres:
    it cuts the minimum spanning tree of all rows (``linkage.spanning_tree``).
    """
    scaled = scale.scale_standard(df.fillna(0, subset=list(columns)), columns)
    data = stage(assemble(scaled, [f"{c}_scaled" for c in columns]).select(key, "features"))
    out = {}
    if "single" in linkages:
        rows = stage(data.select(F.col(key).alias("id"), vector_to_array("features").alias("x")))
        tree = spanning_tree(rows)
        for k in cuts:
            count = k
            if k is None and height is None:
                top = tree.select("height").orderBy(F.desc("height")).limit(ELBOW_MERGES).collect()
                count = elbow([r["height"] for r in reversed(top)])
            labels = cut_spanning_tree(tree, rows.select("id"), count, height)
            out[("single", k)] = labels.select(F.col("id").alias(key), "cluster")
    others = [linkage for linkage in linkages if linkage != "single"]
    if not others:
        return out
    model = KMeans(k=micro, seed=seed, maxIter=20).fit(data)
    centers = np.array(model.clusterCenters())
    placed = stage(model.transform(data).select(key, F.col("prediction").alias("micro")))
    counts = {r["micro"]: r["count"] for r in placed.groupBy("micro").count().collect()}
    used = [i for i in range(len(centers)) if counts.get(i)]
    sizes = np.array([counts[i] for i in used])
    for linkage in others:
        merges = merge_tree(centers[used], sizes, linkage)
        for k in cuts:
            labels = dict(zip(used, cut_tree(len(used), merges, k, height)))
            lookup = F.array(*[F.lit(labels.get(i, 0)) for i in range(len(centers))])
            out[(linkage, k)] = placed.select(key, lookup[F.col("micro")].alias("cluster"))
    return out


# --- quality ------------------------------------------------------------------------------------

def cluster_quality(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Silhouette (squared distance), Davies-Bouldin and Calinski-Harabasz, one row.

    All three come from sums per cluster: centroids first, then distances to them.
    """
    columns = list(columns)
    names = [f"_m{i}" for i in range(len(columns))]
    centers = stage(df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(m) for c, m in zip(columns, names)]))
    gap = sum(((F.col(c) - F.col(m)) * (F.col(c) - F.col(m)) for c, m in zip(columns, names)),
              F.lit(0.0))
    spread = df.join(centers, cluster).groupBy(cluster).agg(
        F.avg(F.sqrt(gap)).alias("s"), F.sum(gap).alias("w"))
    rows = centers.join(spread, cluster).orderBy(cluster).collect()  # one row per cluster
    k = len(rows)
    sizes = np.array([r["_n"] for r in rows], dtype=float)
    middle = np.array([[r[m] for m in names] for r in rows])
    s = np.array([r["s"] for r in rows])
    n, within = sizes.sum(), sum(r["w"] for r in rows)
    overall = (sizes[:, None] * middle).sum(0) / n
    between = (sizes * ((middle - overall) ** 2).sum(1)).sum()
    bouldin = harabasz = silhouette = None
    if 1 < k < n:
        distance = np.sqrt(((middle[:, None] - middle[None]) ** 2).sum(2))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = (s[:, None] + s[None]) / distance
        np.fill_diagonal(ratio, -np.inf)
        bouldin = float(np.nanmax(np.where(np.isfinite(ratio), ratio, -np.inf), axis=1).mean())
        harabasz = float((between / (k - 1)) / (within / (n - k))) if within else None
        silhouette = float(ClusteringEvaluator(predictionCol="_c").evaluate(
            assemble(df, columns).select("features", F.col(cluster).cast("double").alias("_c"))))
    return df.sparkSession.createDataFrame(
        [(k, silhouette, bouldin, harabasz)],
        "n_clusters int, silhouette double, davies_bouldin double, calinski_harabasz double")


def compare_linkages(df: DataFrame, columns: Sequence[str], key: str,
                     linkages: Sequence[str] = ("ward", "complete", "average", "single"),
                     ks: Sequence[int] = (5, 10, 15, 20), micro: int = 500) -> DataFrame:
    """Quality of every linkage and cluster number, best silhouette first."""
    scaled = stage(scale.scale_standard(df.fillna(0, subset=list(columns)), columns).select(
        key, *[f"{c}_scaled" for c in columns]))
    names = [f"{c}_scaled" for c in columns]
    cuts = hierarchical_two_level(df, columns, key, linkages, ks, micro=micro)
    parts = [
        cluster_quality(scaled.join(labels, key), names).select(
            F.lit(linkage).alias("linkage"), F.lit(k).alias("k"), "*")
        for (linkage, k), labels in cuts.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.orderBy(F.desc_nulls_last("silhouette"))


# --- profiles -----------------------------------------------------------------------------------

def cluster_profiles(features: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster, feature, mean, std, n, label``; the label tells activity and rating level."""
    base = stage(features)
    columns = numeric_columns(base, exclude=[cluster, "userId"])
    got = quantiles(base, {"rating_count": [0.25, 0.75]})
    heavy, light = got[("rating_count", 0.75)], got[("rating_count", 0.25)]
    wide = base.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_samp(c).alias(f"s_{c}") for c in columns],
    )
    activity = (F.when(F.col("m_rating_count") > F.lit(heavy), "Heavy")
                .when(F.col("m_rating_count") < F.lit(light), "Light").otherwise("Regular"))
    level = (F.when(F.col("m_rating_mean") > 4.0, "Positive")
             .when(F.col("m_rating_mean") < 3.0, "Critical").otherwise("Neutral"))
    return wide.withColumn("label", F.concat_ws(" ", activity, level, F.lit("Users"))).select(
        cluster, "n", "label", F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                     F.col(f"s_{c}").alias("std")) for c in columns])))


def movie_cluster_stats(features: DataFrame, genres: Sequence[str], cluster: str = "cluster"
                        ) -> DataFrame:
    """Per cluster: size, mean rating, mean popularity and the three commonest genres."""
    wide = features.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), F.avg("rating_mean").alias("avg_rating"),
        F.avg("rating_count").alias("avg_popularity"),
        *[F.sum(g).alias(f"_g{i}") for i, g in enumerate(genres)],
    )
    ranked = F.array_sort(F.array(*[
        F.struct((-F.col(f"_g{i}")).alias("s"), F.lit(g).alias("g"))
        for i, g in enumerate(genres)
    ]))
    return wide.select(
        F.col(cluster).alias("cluster_id"), "size", "avg_rating", "avg_popularity",
        F.concat_ws(", ", F.transform(F.slice(ranked, 1, 3), lambda e: e["g"]))
        .alias("dominant_genres"),
    )


def cluster_top_movies(features: DataFrame, movies: DataFrame, cluster_id: int, n: int = 10,
                       cluster: str = "cluster") -> DataFrame:
    """The ``n`` items of one cluster with the most ratings."""
    top = (
        features.where(F.col(cluster) == cluster_id)
        .select("movieId", "rating_mean", "rating_count")
        .orderBy(F.desc("rating_count"), "movieId").limit(n)
    )
    return top.join(movies.select("movieId", "title", "year"), "movieId", "left").select(
        "movieId", F.coalesce("title", F.concat(F.lit("Movie "), F.col("movieId").cast("string")))
        .alias("title"), "year", "rating_mean", "rating_count")


def cross_cluster_ratings(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``user_cluster, movie_cluster, mean_rating, n``.

    Ratings are summed per (item, user cluster) before they meet the item clusters.
    """
    sums = ratings.join(users, "userId").groupBy("movieId", "user_cluster").agg(
        F.sum("rating").alias("s"), F.count(F.lit(1)).alias("c"))
    return sums.join(items, "movieId").groupBy("user_cluster", "movie_cluster").agg(
        (F.sum("s") / F.sum("c")).alias("mean_rating"), F.sum("c").alias("n"))


def cross_cluster_table(cross: DataFrame, movie_clusters: Sequence[int]) -> DataFrame:
    """One row per user cluster and a column per item cluster; 0 without ratings."""
    wide = cross.groupBy("user_cluster").pivot("movie_cluster", list(movie_clusters)).agg(
        F.first("mean_rating"))
    return wide.fillna(0.0)


def cross_cluster_patterns(cross: DataFrame, least: int = 100, high: float = 4.2,
                           low: float = 2.8) -> DataFrame:
    """Well-supported cluster pairs with a strong liking or disliking."""
    kind = (F.when(F.col("mean_rating") >= high, "Strong Preference")
            .when(F.col("mean_rating") <= low, "Strong Dislike"))
    return cross.where(F.col("n") >= least).withColumn("pattern", kind).where(
        F.col("pattern").isNotNull())
