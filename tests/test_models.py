import random
import threading
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import classify, cluster, nearest, reduce, regress
from ratingloom.sources import models


@pytest.fixture(scope="module")
def line(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, x, z, 2 * x - z + 3 + rng.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "k long, x double, z double, y double").cache()


def test_closed_form_and_descent_agree(line):
    weights, bias = regress.linear_closed(line, ["x", "z"], "y")
    x = np.array([(r["x"], r["z"], 1.0) for r in line.collect()])
    y = np.array([r["y"] for r in line.collect()])
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert [*weights, bias] == pytest.approx(list(want), abs=1e-8)
    run = regress.gd_batch(regress.moments(line, ["x", "z"], "y"),
                           regress.Descent(learning_rate=0.05, iterations=400))
    assert [*run.weights, run.bias] == pytest.approx(list(want), abs=1e-2)
    losses = [t["loss"] for t in run.trace]
    assert losses[-1] < losses[0] and run.best_loss == pytest.approx(min(losses), abs=1e-4)


def test_mini_batch_and_sgd_learn(line):
    mini = regress.gd_mini_batch(line, ["x", "z"], "y", "k",
                                 regress.Descent(learning_rate=0.01, iterations=60), 64)
    assert [*mini.weights, mini.bias] == pytest.approx([2, -1, 3], abs=0.15)
    sgd = regress.gd_sgd(line, ["x", "z"], "y", "k",
                         regress.Descent(learning_rate=0.002, iterations=4, momentum=0.8))
    assert sgd.trace[-1]["loss"] < sgd.trace[0]["loss"]


def test_batches_cover_every_row_once(line):
    batched = regress.batch_number(line, "k", 7)
    found = regress.grouped_moments(batched, ["x"], "y", "_batch")
    assert sum(m.n for m in found.values()) == 600 and set(found) <= set(range(7))


def test_every_epoch_deals_the_cells_anew():
    first, second = (regress.dealt(e, 100) for e in (0, 1))
    for batches in (first, second):
        sizes = np.bincount(batches, minlength=100)
        assert sizes.sum() == regress.CELLS and sizes.min() >= 10 and sizes.max() <= 11
    together = (first[:, None] == first) & (second[:, None] == second)
    np.fill_diagonal(together, False)
    assert together.mean() < 0.01


def test_mini_batch_equals_a_loop_over_rows(line):
    rows = [(r["x"], r["z"], r["y"], r["_batch"])
            for r in regress.batch_number(line, "k", 16).collect()]
    x = np.array([r[:2] for r in rows])
    y, cell = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    w, b, vw, vb = np.zeros(2), 0.0, np.zeros(2), 0.0
    for epoch in range(4):
        of = regress.dealt(epoch, 5, 16)[cell]
        for batch in range(5):
            on = of == batch
            error = x[on] @ w + b - y[on]
            vw = 0.9 * vw - 0.01 * 0.99 ** ((epoch - 1) / 100 * (epoch > 0)) * (
                2 * x[on].T @ error / on.sum() + 2 * 0.01 * w)
            vb = 0.9 * vb - 0.01 * 0.99 ** ((epoch - 1) / 100 * (epoch > 0)) * 2 * error.mean()
            w, b = w + vw, b + vb
    run = regress.gd_mini_batch(line, ["x", "z"], "y", "k", regress.Descent(
        learning_rate=0.01, iterations=4, penalty="l2"), 5, cells=16)
    assert [*run.weights, run.bias] == pytest.approx([*w, b], abs=1e-9)
    with pytest.raises(ValueError):
        regress.gd_mini_batch(line, ["x", "z"], "y", "k", regress.Descent(), 17, cells=16)


def brute_shards(line, rows, epochs, rate, momentum, power=0.0):
    """Row by row in plain Python: final weights, and the mean of all weights after a row."""
    data = [(r["k"] % 2 ** 31 * 2654435761 % 2 ** 32, r["x"], r["z"], r["y"])
            for r in line.collect()]
    shards = {}
    for r in sorted(data):
        shards.setdefault(r[0] * (len(data) // rows) // 2 ** 32, []).append(r)
    shared, seen = np.zeros(3), []
    for epoch in range(epochs):
        ends, means = [], []
        for part in shards.values():
            w, v, after = shared.copy(), np.zeros(3), []
            for t, (_, x, z, y) in enumerate(part):
                row = np.array([x, z, 1.0])
                eta = rate / (epoch * len(part) + t + 1) ** power
                v = momentum * v - eta * 2 * (row @ w - y) * row
                w = w + v
                after.append(w)
            ends.append(w * len(part))
            means.append(np.sum(after, axis=0))
        shared = np.sum(ends, axis=0) / len(data)
        seen.append(np.sum(means, axis=0) / len(data))
    return shared, np.mean(seen, axis=0)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_sgd_is_the_same_on_any_split(line, parts):
    want, _ = brute_shards(line, 50, 3, 0.002, 0.5)
    run = regress.gd_sgd(line.repartition(parts), ["x", "z"], "y", "k", regress.Descent(
        learning_rate=0.002, iterations=3, momentum=0.5, decay=1.0), rows=50)
    assert [*run.weights, run.bias] == pytest.approx(list(want), abs=1e-9)


def test_averaged_rows_with_a_falling_rate(line):
    _, want = brute_shards(line, 600, 5, 0.02, 0.0, 0.25)
    run = regress.linear_sgd(line, ["x", "z"], "y", "k", rate=0.02, epochs=5, penalty="none")
    assert [*run.weights, run.bias] == pytest.approx(list(want), abs=1e-9)


def test_runs_of_a_sweep_do_not_disturb_each_other(line):
    shards = regress.sgd_shards(line, ["x", "z"], "y", "k", 100)
    settings = [dict(learning_rate=0.002, iterations=3, momentum=0.8, penalty="l2"),
                dict(learning_rate=0.001, iterations=5, momentum=0.5, penalty="elastic"),
                dict(learning_rate=50.0, iterations=9)]
    together = [regress.Descent(**s) for s in settings]
    regress.sgd_sweep(shards, 2, together)
    for s, run in zip(settings[:2], together):
        alone = regress.Descent(**s)
        regress.sgd_sweep(shards, 2, [alone])
        assert run.losses == pytest.approx(alone.losses) and len(run.trace) == s["iterations"]
        assert list(run.weights) == pytest.approx(list(alone.weights), abs=1e-12)
    # a run that diverges ends at once and leaves the others alone
    assert len(together[2].trace) == 1


def test_divergence_stops(line):
    run = regress.gd_batch(regress.moments(line, ["x", "z"], "y"),
                           regress.Descent(learning_rate=5.0, iterations=500))
    assert len(run.trace) < 500 and not run.converged


def test_search_tables(line):
    train, test = line.where("k % 5 > 0"), line.where("k % 5 = 0")
    tuned = regress.tune_random(train, test, ["x", "z"], "y", n_trials=6, iterations=80)
    scores = [r["test_rmse"] for r in tuned.collect()]
    assert scores == sorted(scores)
    for method in ("mini_batch", "sgd"):
        rows = regress.tune_random(train, test, ["x", "z"], "y", 4, 3, method=method, key="k"
                                   ).collect()
        assert rows and {r["learning_rate"] for r in rows} <= set(
            regress.GRIDS[method]["learning_rate"])
        assert all((r["n_batches"] is None) == (method == "sgd") for r in rows)
    for size in (24, 36, 96):
        assert sorted(regress.trial_numbers(size, size, 42)) == list(range(size))


def test_methods_compared(line):
    train, test = line.where("k % 5 > 0"), line.where("k % 5 = 0")
    args = (["x", "z"], "y", "k", [0.001, 0.01])
    few = {"batch": 30, "mini_batch": 5, "sgd": 2}
    found = {r["method"]: r for r in regress.compare_methods(
        train, test, *args, iterations=few).collect()}
    assert set(found) == {"batch", "mini_batch", "sgd"}
    assert found["mini_batch"]["n_batches"] in regress.BATCHES
    best = min(
        (regress.gd_mini_batch(train, ["x", "z"], "y", "k", regress.Descent(
            learning_rate=rate, iterations=5, penalty="l2"), n)
         for rate in args[3] for n in regress.BATCHES),
        key=lambda s: regress.moments(test, ["x", "z"], "y").loss(s.weights, s.bias))
    assert found["mini_batch"]["test_rmse"] == pytest.approx(
        regress.moments(test, ["x", "z"], "y").loss(best.weights, best.bias) ** 0.5)
    for a, b in ((line.limit(0), test), (train, line.limit(0))):
        assert not regress.compare_methods(a, b, *args, iterations=few).count()
        assert not regress.tune_random(a, b, ["x", "z"], "y", 2, 3).count()


def test_best_saved_model_is_used(spark, line, tmp_path):
    folder = str(tmp_path)
    for name, w, rmse in (("a", 1.0, 0.9), ("b", 2.0, 0.4)):
        models.save_linear(spark, folder, name, ["x"], [w], 0.0, [0.0], [1.0], rmse)
    assert models.load_linear(spark, folder)["name"] == "b"
    assert models.load_linear(spark, folder, "a")["weights"] == [1.0]


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double")
    assert classify.roc_auc(df).first()[0] == pytest.approx((0.5 + 1 + 0 + 1) / 4)
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in classify.roc_points(df).collect()}
    assert points == {0.9: (0.5, 0.5), 0.4: (0.5, 1.0), 0.1: (1.0, 1.0)}


def test_nearest_rows_by_blocks(spark):
    rng = random.Random(9)
    points = {i: [rng.random() for _ in range(3)] for i in range(60)}
    df = spark.createDataFrame(list(points.items()), "id long, x array<double>")
    for blocks in (1, 4):
        got = {}
        for r in classify.nearest_rows(df, 5, blocks).orderBy("place").collect():
            got.setdefault(r["id"], []).append(r["neighbor"])
        for i, p in points.items():
            want = sorted((sum((a - b) ** 2 for a, b in zip(p, q)), j)
                          for j, q in points.items() if j != i)[:5]
            assert got[i] == [j for _, j in want]


def brute_nearest(rows, k):
    want = {}
    for i, p in rows:
        found = sorted((round(sum((a - b) ** 2 for a, b in zip(p, q)) ** 0.5, 9), j)
                       for j, q in rows if j != i)
        want[i] = [j for _, j in found[:k]]
    return want


def listed_nearest(found):
    got = {}
    for r in found.orderBy("id", "place").collect():
        got.setdefault(r["id"], []).append(r["neighbor"])
    return got


@pytest.mark.parametrize("pivots, block_rows", [(4, 10), (16, 7), (64, 2048)])
def test_pivots_find_the_nearest_rows(spark, pivots, block_rows):
    rng = random.Random(11)
    rows = [(i, [round(rng.gauss(4 * (i % 3), 1), 2), rng.random()]) for i in range(150)]
    # rows of one vector, a lattice with ties, and vectors equally far from each other
    rows += [(200 + i, [1.0, 1.0]) for i in range(60)]
    rows += [(300 + i, [float(i % 5), float(i // 5)]) for i in range(25)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found, share = nearest.pivot_nearest(df, 5, pivots, block_rows)
    assert listed_nearest(found) == brute_nearest(rows, 5) and 0 < share


def test_pivots_save_comparisons(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(20 * (i % 8), 1), rng.gauss(0, 1)]) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found, share = nearest.pivot_nearest(df, 3, 16, 40)
    assert listed_nearest(found) == brute_nearest(rows, 3)
    assert share < 0.25


def test_far_pivots_are_not_visited(spark):
    # the last ring of a far pivot is open, and was visited by all rows beyond it
    rng = random.Random(3)
    rows = [(i, [rng.random(), rng.random()]) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found, share = nearest.pivot_nearest(df, 3, 32, 20)
    assert listed_nearest(found) == brute_nearest(rows, 3)
    assert share < 0.12


def test_nearest_of_few_rows(spark):
    schema = "id long, x array<double>"
    for rows, want in (([], {}), ([(1, [2.0])], {}), ([(1, [2.0]), (2, None)], {}),
                       ([(1, [2.0]), (2, [2.0]), (3, [5.0])], {1: [2, 3], 2: [1, 3], 3: [1, 2]})):
        found, _ = nearest.pivot_nearest(spark.createDataFrame(rows, schema), 5)
        assert listed_nearest(found) == want


def test_made_rows_lie_between_neighbors(spark):
    rng = random.Random(13)
    rows = [(i, rng.random(), rng.random(), int(i < 30)) for i in range(150)]
    out = classify.smote_oversample(
        spark.createDataFrame(rows, "k long, a double, b double, label int"), ["a", "b"], "k")
    small = [(i, np.array([a, b])) for i, a, b, label in rows if label]
    near = brute_nearest(small, 5)
    ways = [(p, dict(small)[j] - p) for i, p in small for j in near[i]]
    for r in out.where("k is null").collect():
        z = np.array([r["a"], r["b"]])
        assert any(
            abs(way[0] * (z - p)[1] - way[1] * (z - p)[0]) < 1e-12 and -1e-12 <= (z - p) @ way <= way @ way + 1e-12
            for p, way in ways)


def test_smote_balances_between_neighbors(spark):
    rng = random.Random(10)
    rows = [(i, rng.random() + (3 if i < 20 else 0), rng.random(), 1 if i < 20 else 0)
            for i in range(110)]
    df = spark.createDataFrame(rows, "k long, a double, b double, label int")
    out = classify.smote_oversample(df, ["a", "b"], "k", blocks=2)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 90, 1: 90}
    made = out.where("k is null")
    assert made.count() == 70 and made.where("label <> 1 or a < 3 or a > 4").count() == 0
    near_even = df.where("k < 40")
    assert classify.smote_oversample(near_even, ["a", "b"], "k").count() == 40


def test_multiclass_weighted_row(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "label int, prediction int")
    got = {r["class"]: r for r in classify.class_metrics(df).collect()}
    assert got[3]["recall"] == 0.0 and got[2]["recall"] == 1.0
    assert got[None]["recall"] == pytest.approx(0.5)


def test_pca_is_centred_and_signed(line):
    scores, report = reduce.pca(line, ["x", "z"], k=2)
    values = np.array([r["pc"] for r in scores.select("pc").collect()])
    assert np.allclose(values.mean(0), 0, atol=1e-9)
    assert report.collect()[-1]["cumulative_variance"] == pytest.approx(1.0)


def tree(points, linkage, k):
    sizes = np.ones(len(points))
    merges = cluster.merge_tree(np.array(points, dtype=float), sizes, linkage)
    return cluster.cut_tree(len(points), merges, k), [h for _, _, h in merges]


@pytest.mark.parametrize("linkage", ["ward", "complete", "average", "single"])
def test_linkage_on_a_line(linkage):
    labels, heights = tree([[0], [1], [10], [11], [30]], linkage, 3)
    assert labels[0] == labels[1] and labels[2] == labels[3] and len(set(labels)) == 3
    assert heights == sorted(heights) and heights[0] == pytest.approx(1.0)


def test_ward_heights_match_the_definition():
    _, heights = tree([[0.0], [2.0], [9.0]], "ward", 1)
    # merging {0, 2} with {9}: sqrt(2 * 2 * 1 / 3) * 8
    assert heights == pytest.approx([2.0, (4 / 3) ** 0.5 * 8])


def test_two_level_hierarchy_covers_every_row(spark):
    rows = [(i, float(i % 3) * 10 + (i % 7) / 10, 1.0 * (i % 2)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    cuts = cluster.hierarchical_two_level(df, ["a"], "id", ["ward"], [3], micro=12)
    labels = {r["id"]: r["cluster"] for r in cuts[("ward", 3)].collect()}
    assert len(labels) == 90 and set(labels.values()) == {1, 2, 3}
    assert all(labels[i] == labels[i % 3] for i in range(90))
    by_height = cluster.hierarchical_two_level(df, ["a"], "id", ["single"], height=0.5, micro=12)
    assert by_height[("single", None)].select("cluster").distinct().count() == 3


def test_nearest_centroid_lowest_index_on_a_tie(spark):
    df = spark.createDataFrame([([1.0],), ([5.0],)], "x array<double>")
    got = [r["cluster"] for r in cluster.assign_clusters(df, "x", [[0.0], [2.0], [6.0]]).collect()]
    assert got == [0, 2]


def test_kmeans_ids_in_range(star):
    features = cluster.segmentation_features(star.ratings)
    got = cluster.kmeans_users(features, k=4, starts=2)
    assert got.count() == features.count()
    assert set(r["cluster"] for r in got.select("cluster").distinct().collect()) <= set(range(4))


def test_starts_of_kmeans_run_side_by_side(spark, monkeypatch):
    # a start used to wait for the one before; the first of the cheapest is kept
    meeting = threading.Barrier(2)

    class Start:
        def __init__(self, k, seed, maxIter):
            self.seed = seed

        def fit(self, data):
            meeting.wait(60)
            cost = {5: 3.0, 6: 1.0, 7: 2.0, 8: 1.0}[self.seed]
            return SimpleNamespace(summary=SimpleNamespace(trainingCost=cost), transform=lambda df: (
                df.withColumn("prediction", F.lit(self.seed))))

    monkeypatch.setattr(cluster, "KMeans", Start)
    df = spark.createDataFrame([(1, 0.5), (2, 1.5)], "id long, a double")
    labels, cost = cluster.kmeans(df, ["a"], 2, "id", starts=4, seed=5)
    assert {r["cluster"] for r in labels.collect()} == {6} and cost == 1.0
