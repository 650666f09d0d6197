"""Regression, scoring and saved models."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import cf, coldstart, matrix, regress, scale
from ratingloom.plans.q_sources import scratch
from ratingloom.plans.registry import query
from ratingloom.sources import files, models

FEATURES = ["uc", "um", "mc", "mm"]
SCALED = [f"{c}_scaled" for c in FEATURES]


def table(star):
    """Ratings with four numeric features and an integer row key."""
    users = matrix.rating_stats(star.ratings, "userId").toDF("userId", "uc", "um")
    items = matrix.rating_stats(star.ratings, "movieId").toDF("movieId", "mc", "mm")
    return star.ratings.join(users, "userId").join(items, "movieId").select(
        "userId", "movieId", "rating", *[F.col(c).cast("double").alias(c) for c in FEATURES])


def split(star):
    """Scaled training and test rows."""
    train, test = cf.train_test_split(stage(table(star)), ["userId", "movieId"])
    parameters = scale.standard_parameters(train, FEATURES)

    def scaled(df):
        return stage(df.withColumns({
            f"{c}_scaled": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in parameters.items()
        }))

    return scaled(train), scaled(test)


#: Two-feature descent over all rows for the check engine: moments, then a recursion.
DESCENT = """
WITH RECURSIVE us AS (SELECT "userId", avg(rating) AS um FROM ratings GROUP BY 1),
ms AS (SELECT "movieId", avg(rating) AS mm FROM ratings GROUP BY 1),
x AS MATERIALIZED (SELECT um - 2.5 AS a, mm - 2.5 AS b, rating AS y
                   FROM ratings JOIN us USING ("userId") JOIN ms USING ("movieId")),
s AS MATERIALIZED (
  SELECT CAST(count(*) AS DOUBLE) AS n, sum(a) AS a, sum(b) AS b, sum(y) AS y, sum(a * a) AS aa,
         sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS by_, sum(y * y) AS yy
  FROM x),
step AS (
  SELECT CAST(-1 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2,
         CAST(0 AS DOUBLE) AS c, CAST(0 AS DOUBLE) AS v1, CAST(0 AS DOUBLE) AS v2,
         CAST(0 AS DOUBLE) AS vc, CAST(0.05 AS DOUBLE) AS rate, CAST(NULL AS DOUBLE) AS used
  UNION ALL
  SELECT i + 1, w1 - v1n, w2 - v2n, c - vcn, v1n, v2n, vcn, 0.05 * 0.99 ** ((i + 1) / 100.0), rate
  FROM (SELECT *, 0.9 * v1 + rate * (2 * (w1 * aa + w2 * ab + c * a - ay) / n
                                     + 2 * 0.01 * w1) AS v1n,
               0.9 * v2 + rate * (2 * (w1 * ab + w2 * bb + c * b - by_) / n
                                  + 2 * 0.01 * w2) AS v2n,
               0.9 * vc + rate * 2 * (w1 * a + w2 * b + n * c - y) / n AS vcn
        FROM step, s) AS moved WHERE i < 39),
run AS (SELECT i, w1, w2, c, used,
               (w1 * w1 * aa + w2 * w2 * bb + 2 * w1 * w2 * ab + 2 * c * (w1 * a + w2 * b)
                - 2 * (w1 * ay + w2 * by_) + n * c * c - 2 * c * y + yy) / n
               + 0.01 * (w1 * w1 + w2 * w2) AS loss
        FROM step, s WHERE i >= 0)
"""


def descend(star):
    centred = table(star).withColumns({"a": F.col("um") - 2.5, "b": F.col("mm") - 2.5})
    settings = regress.Descent(learning_rate=0.05, iterations=40, penalty="l2", strength=0.01)
    return regress.gd_batch(regress.moments(centred, ["a", "b"], "rating"), settings)


@query("gd_batch", DESCENT + """
SELECT unnest(['a', 'b', 'bias']) AS feature, unnest([w1, w2, c]) AS weight FROM run WHERE i = 39
""", "weight")
def gd_batch(star):
    s = descend(star)
    return star.spark.createDataFrame(
        [("a", float(s.weights[0])), ("b", float(s.weights[1])), ("bias", float(s.bias))],
        "feature string, weight double")


@query("convergence_trace", DESCENT + """
SELECT 'batch' AS method, CAST(i AS INTEGER) AS iteration, loss, used AS learning_rate,
       (SELECT min(loss) FROM run) AS best_loss, false AS converged FROM run
""", "loss learning_rate best_loss")
def convergence_trace(star):
    return regress.convergence_trace(star.spark, {"batch": descend(star)}).drop("val_loss")


@query("batch_moments", """
WITH us AS (SELECT "userId", avg(rating) AS um FROM ratings GROUP BY 1),
x AS (SELECT um, rating AS y,
             CAST(floor(("movieId" % 2147483648 * 2654435761) % 4294967296 / 65536) AS BIGINT)
               % 16 AS batch
      FROM ratings JOIN us USING ("userId"))
SELECT batch, CAST(count(*) AS DOUBLE) AS n, sum(um) AS xs, sum(y) AS ys, sum(um * um) AS xx,
       sum(um * y) AS xy, sum(y * y) AS yy FROM x GROUP BY 1
""", "n xs ys xx xy yy")
def batch_moments(star):
    """The statistics mini-batch descent runs on, per batch."""
    batched = regress.batch_number(table(star), "movieId", 16)
    found = regress.grouped_moments(batched, ["um"], "rating", "_batch")
    return star.spark.createDataFrame(
        [(int(g), float(m.n), float(m.xs[0]), float(m.ys), float(m.xtx[0, 0]), float(m.xty[0]),
          float(m.yty)) for g, m in found.items()],
        "batch long, n double, xs double, ys double, xx double, xy double, yy double")


def weights_table(star, settings):
    return star.spark.createDataFrame(
        [(c, float(w)) for c, w in zip([*FEATURES, "bias"], [*settings.weights, settings.bias])],
        "feature string, weight double")


#: Scaled training and test rows for the check engine, as ``split`` makes them.
SPLIT = """
WITH RECURSIVE us AS (SELECT "userId", count(*) AS uc, avg(rating) AS um FROM ratings GROUP BY 1),
ms AS (SELECT "movieId", count(*) AS mc, avg(rating) AS mm FROM ratings GROUP BY 1),
raw AS MATERIALIZED (SELECT "userId" * 1000003 + "movieId" AS key, uc, um, mc, mm, rating AS y,
      ("userId" % 2147483648 * 2654435761 + "movieId" % 2147483648 * 40503) % 4294967296
        < 3435973836 AS inside
      FROM ratings JOIN us USING ("userId") JOIN ms USING ("movieId")),
x AS MATERIALIZED (SELECT key, (key % 2147483648 * 2654435761) % 4294967296 AS h, inside, y,
      (uc - m1) / s1 AS x1, (um - m2) / s2 AS x2, (mc - m3) / s3 AS x3, (mm - m4) / s4 AS x4
      FROM raw, (SELECT avg(uc) AS m1, stddev_pop(uc) AS s1, avg(um) AS m2, stddev_pop(um) AS s2,
                        avg(mc) AS m3, stddev_pop(mc) AS s3, avg(mm) AS m4, stddev_pop(mm) AS s4
                 FROM raw WHERE inside) AS p),
"""
D = len(FEATURES) + 1
Z = [f"x{i}" for i in range(1, D)] + ["1.0", "y"]


def _sums():
    """The products of (features, 1, y) summed, as a list."""
    return "[" + ", ".join(f"sum({a} * {b})" for a in Z for b in Z) + "]"


def _dot(row, w):
    """A row of the moments times (w, bias, -1)."""
    terms = [f"m[{row * (D + 1) + j + 1}] * {w}[{j + 1}]" for j in range(D)]
    return f"({' + '.join(terms)} - m[{row * (D + 1) + D + 1}])"


N = f"m[{D * (D + 1) - 1}]"
#: A state: weights and bias, velocities, then rate, loss, momentum, squares, absolute values.
RATE, LOSS, MOMENTUM, SQUARE, ABSOLUTE = (2 * D + i for i in range(1, 6))


def _fold(source, gradient, loss):
    """The state after one update per element ``m`` of a list; the losses are added up."""
    velocity = [f"a[{MOMENTUM}] * a[{D + i + 1}] - a[{RATE}] * ({gradient(i)}"
                + (f" + 2 * a[{SQUARE}] * a[{i + 1}] + a[{ABSOLUTE}] * sign(a[{i + 1}])"
                   if i < D - 1 else "") + ")" for i in range(D)]
    moved = [f"a[{i + 1}] + v[{i + 1}]" for i in range(D)] + [f"v[{i + 1}]" for i in range(D)]
    rest = f"[a[{RATE}], a[{LOSS}], a[{MOMENTUM}], a[{SQUARE}], a[{ABSOLUTE}]]"
    added = [f"b[{i}] + {loss}" if i == LOSS else f"b[{i}]" for i in range(1, ABSOLUTE + 1)]
    return f"""list_reduce({source}, lambda a, m: list_transform([list_transform(
        [[{", ".join(velocity)}]], lambda v: [{", ".join(moved)}] || {rest})[1]],
        lambda b: [{", ".join(added)}])[1], st)"""


PENALTY = "(" + " + ".join(f"b[{SQUARE}] * b[{i}] ** 2 + b[{ABSOLUTE}] * abs(b[{i}])"
                           for i in range(1, D)) + ")"
QUADRATIC = ("(" + " + ".join(f"b[{i + 1}] * {_dot(i, 'b')}" for i in range(D))
             + f" - {_dot(D, 'b')}) / {N}")
BATCHED = _fold("ms", lambda i: f"2 * {_dot(i, 'a')} / {N}", f"({QUADRATIC} + {PENALTY}) * {N}")


def _row(w):
    return "(" + " + ".join(f"m[{j + 1}] * {w}[{j + 1}]" for j in range(D)) + f" - m[{D + 1}])"


ROWED = _fold("rows", lambda i: f"2 * {_row('a')} * m[{i + 1}]", f"{_row('b')} ** 2")


def _epochs(name, moved):
    """Recursion over epochs of all trials: ``moved`` has the state after an epoch as ``st``, with
    its mean loss in place. Rates decay and halve, and trials end, as in ``regress.Descent``.
    """
    return f"""
{name} AS (
  SELECT trial, nb, rate, last, 0 AS i, [{", ".join(["0.0::DOUBLE"] * 2 * D)}, rate, 0, momentum, square, absolute] AS st,
         []::DOUBLE[] AS losses, 'inf'::DOUBLE AS best, 0 AS best_at,
         [{", ".join(["0.0::DOUBLE"] * D)}] AS best_w, false AS done
  FROM {name}_trials
  UNION ALL
  SELECT trial, nb, rate, last, i + 1,
         (CASE WHEN done THEN best_w ELSE st[1:{D}] END) || st[{D + 1}:{2 * D}]
         || [rate * 0.99 ** ((len(losses) - 1) / 100.0)
             / CASE WHEN len(losses) > 20 AND len(list_filter(range(1, 20), lambda j:
                         losses[-20:][j + 1] < losses[-20:][j])) = 0 THEN 2 ELSE 1 END, 0.0]
         || st[{MOMENTUM}:],
         losses, best, best_at, best_w, done OR NOT losses[-1] <= 1e6
  FROM (SELECT *, i - best_at >= 20 AND losses[-1] <= 1e6 AS done
        FROM (SELECT trial, nb, rate, last, i, st, losses || [st[{LOSS}]] AS losses,
                     CASE WHEN better THEN st[{LOSS}] ELSE best END AS best,
                     CASE WHEN better THEN i ELSE best_at END AS best_at,
                     CASE WHEN better THEN st[1:{D}] ELSE best_w END AS best_w
              FROM (SELECT *, st[{LOSS}] < best - 0.00001 AS better FROM ({moved}) AS a) AS b) AS c
       ) AS d
),
{name}_end AS (SELECT *, st[1:{D}] AS w, len(losses) AS iterations FROM {name}
               QUALIFY row_number() OVER (PARTITION BY trial ORDER BY i DESC) = 1)"""


def batched(name, trials, batches, epochs):
    """Descent on moments of cells for the trials ``(trial, nb, rate, momentum, square, absolute,
    last)``; every epoch deals the cells to ``nb`` batches anew."""
    total = ", ".join(f"sum(m[{i + 1}])" for i in range((D + 1) ** 2))
    return f"""
{name}_cells AS MATERIALIZED (
  SELECT CAST(floor(h / 65536) AS BIGINT) % 1024 AS cell, {_sums()} AS m
  FROM x WHERE inside GROUP BY 1),
{name}_deal AS MATERIALIZED (
  SELECT e, nb, list(m ORDER BY g) AS ms, sum({N}) AS n FROM (
    SELECT e, nb, (cell * (2 * (e * 7919 % 1024) + 1) + e * 104729) % 1024 * nb // 1024 AS g,
           [{total}] AS m
    FROM {name}_cells, range({epochs}) AS r(e), (SELECT unnest({batches}) AS nb) AS b
    GROUP BY 1, 2, 3) AS q GROUP BY 1, 2),
{name}_trials AS (SELECT * FROM (VALUES {trials}) AS t(trial, nb, rate, momentum, square, absolute, last)),
""" + _epochs(name, f"""
  SELECT * REPLACE (st[:{LOSS - 1}] || [st[{LOSS}] / n] || st[{MOMENTUM}:] AS st) FROM (
    SELECT s.* REPLACE ({BATCHED} AS st), n FROM {name} AS s
    JOIN {name}_deal AS d ON d.e = s.i AND d.nb = s.nb WHERE NOT done AND i < last) AS f""")


#: Rows of a shard in the queries below; the check engine folds a shard's rows one by one.
SHARD = 256


def sharded(name, trials, rows=SHARD):
    """Descent by single rows in shards of a hash, averaged after each epoch."""
    mean = ", ".join(f"sum(st[{i}] * n) / sum(n)" for i in range(1, D + 1))
    penalty = " + ".join(f"st[{SQUARE}] * w[{i}] ** 2 + st[{ABSOLUTE}] * abs(w[{i}])"
                         for i in range(1, D))
    zeros = ", ".join(["0.0::DOUBLE"] * D)
    return f"""
{name}_shards AS MATERIALIZED (
  SELECT CAST(floor(h * c.n / 4294967296) AS BIGINT) AS shard, CAST(count(*) AS DOUBLE) AS n,
         list([{", ".join(Z[:-2])}, 1.0, y] ORDER BY h, key, y, {", ".join(Z[:-2])}) AS rows
  FROM x, (SELECT greatest(1, count(*) // {rows}) AS n FROM x WHERE inside) AS c
  WHERE inside GROUP BY 1),
{name}_trials AS (SELECT * FROM (VALUES {trials}) AS t(trial, nb, rate, momentum, square, absolute, last)),
""" + _epochs(name, f"""
  SELECT * EXCLUDE (w) REPLACE (w || [{zeros}] || [st[{RATE}], st[{LOSS}] + {penalty}]
                    || st[{MOMENTUM}:] AS st) FROM (
    SELECT trial, nb, rate, last, i, losses, best, best_at, best_w, done, [{mean}] AS w,
           any_value(st[:{LOSS - 1}]) || [sum(st[{LOSS}]) / sum(n)]
           || any_value(st[{MOMENTUM}:]) AS st
    FROM (SELECT s.* REPLACE ({ROWED} AS st), n FROM {name} AS s, {name}_shards
          WHERE NOT done AND i < last) AS f
    GROUP BY trial, nb, rate, last, i, losses, best, best_at, best_w, done) AS g""")


NAMES = "[" + ", ".join(f"'{c}'" for c in [*FEATURES, "bias"]) + "]"
ITERATIONS = {"batch": 2000, "mini_batch": 1000, "sgd": 5}


def keyed_split(star):
    train, test = split(star)
    return train.withColumn("key", F.col("userId") * 1000003 + F.col("movieId")), test


def weights_table(star, settings):
    return star.spark.createDataFrame(
        [(c, float(w)) for c, w in zip([*FEATURES, "bias"], [*settings.weights, settings.bias])],
        "feature string, weight double")


@query("gd_mini_batch", SPLIT + batched("mini", "(0, 100, 0.01, 0.9, 0.01, 0.0, 1000)", [100], 1000)
       + f" SELECT unnest({NAMES}) AS feature, unnest(w) AS weight FROM mini_end", "weight")
def gd_mini_batch(star):
    train, _ = keyed_split(star)
    return weights_table(star, regress.gd_mini_batch(
        train, SCALED, "rating", "key",
        regress.Descent(learning_rate=0.01, iterations=1000, penalty="l2"), n_batches=100))


@query("gd_sgd", SPLIT + sharded("sgd", "(0, 1, 0.0001, 0.8, 0.01, 0.0, 20)")
       + f" SELECT unnest({NAMES}) AS feature, unnest(w) AS weight FROM sgd_end", "weight")
def gd_sgd(star):
    train, _ = keyed_split(star)
    return weights_table(star, regress.gd_sgd(train, SCALED, "rating", "key", regress.Descent(
        learning_rate=0.0001, iterations=20, momentum=0.8, penalty="l2"), rows=SHARD))


LINE = """
WITH us AS (SELECT "userId", avg(rating) AS um FROM ratings GROUP BY 1),
x AS MATERIALIZED (SELECT r."userId", r."movieId", um, rating AS y,
      ("userId" % 2147483648 * 2654435761 + "movieId" % 2147483648 * 40503) % 4294967296
        < 3435973836 AS inside
      FROM ratings r JOIN us USING ("userId")),
c AS (SELECT count(*) * covar_pop(y, um) AS sxy, count(*) * var_pop(um) AS sxx, avg(um) AS mx,
             avg(y) AS my FROM x WHERE inside)
"""


@query("linear_closed", LINE + """
SELECT 'ols' AS model, sxy / sxx AS slope, my - sxy / sxx * mx AS intercept FROM c
UNION ALL
SELECT 'ridge', sxy / (sxx + 5000), my - sxy / (sxx + 5000) * mx FROM c
""", "slope intercept")
def linear_closed(star):
    train, _ = cf.train_test_split(stage(table(star)), ["userId", "movieId"])
    rows = []
    for name, alpha in (("ols", None), ("ridge", 5000.0)):
        (slope,), intercept = regress.linear_closed(train, ["um"], "rating", alpha)
        rows.append((name, slope, intercept))
    return star.spark.createDataFrame(rows, "model string, slope double, intercept double")


@query("predict_linear", LINE + """
SELECT "userId", "movieId", 0.7 * um + 0.25 * y + 0.1 AS prediction FROM x
""", "prediction")
def predict_linear(star):
    return regress.predict_linear(
        table(star), ["um", "rating"], [0.7, 0.25], 0.1
    ).select("userId", "movieId", "prediction")


def _part(name, where):
    return f"""
{name} AS (SELECT sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae,
                  1 - avg((y - p) ** 2) / var_pop(y) AS r2
           FROM (SELECT y, 0.7 * um + 0.9 AS p FROM x WHERE {where}) AS q)"""


@query("regression_metrics", LINE + "," + _part("a", "inside") + "," + _part("b", "NOT inside")
       + """
SELECT a.rmse AS train_rmse, a.mae AS train_mae, a.r2 AS train_r2, b.rmse AS test_rmse,
       b.mae AS test_mae, b.r2 AS test_r2, b.rmse / a.rmse AS overfitting_ratio,
       b.rmse / a.rmse > 1.1 AS overfitting FROM a, b
""", "train_rmse train_mae train_r2 test_rmse test_mae test_r2 overfitting_ratio")
def regression_metrics(star):
    predicted = regress.predict_linear(table(star), ["um"], [0.7], 0.9)
    train, test = cf.train_test_split(predicted, ["userId", "movieId"])
    return regress.regression_metrics(train, test, "rating")


#: Test and training scores of the weights of trials.
SCORES = """,
errors AS (SELECT method, trial, inside, avg(e * e) AS mse, var_pop(y) AS var
           FROM (SELECT method, trial, inside, y, w[1] * x1 + w[2] * x2 + w[3] * x3 + w[4] * x4
                        + w[5] - y AS e FROM x, ends) AS q GROUP BY 1, 2, 3),
scores AS (SELECT method, trial, sqrt(t.mse) AS test_rmse, sqrt(r.mse) AS train_rmse,
                  1 - t.mse / t.var AS test_r2
           FROM errors t JOIN errors r USING (method, trial) WHERE NOT t.inside AND r.inside
             AND isfinite(t.mse))
"""


def _compared():
    plain, rows, dealt_ = [], [], []
    for rate in regress.RATES:
        plain.append(f"({len(plain)}, 1, {rate}, 0.9, 0.01, 0.0, {ITERATIONS['batch']})")
        rows.append(f"({len(rows)}, 0, {rate} * 0.01, 0.8, 0.01, 0.0, {ITERATIONS['sgd']})")
        for n in regress.BATCHES:
            dealt_.append(
                f"({len(dealt_)}, {n}, {rate}, 0.9, 0.01, 0.0, {ITERATIONS['mini_batch']})")
    return (batched("plain", ", ".join(plain), [1], ITERATIONS["batch"]) + ","
            + batched("mini", ", ".join(dealt_), regress.BATCHES, ITERATIONS["mini_batch"]) + ","
            + sharded("sgd", ", ".join(rows)) + """,
ends AS (SELECT 'batch' AS method, trial, nb, rate, iterations, w FROM plain_end
         UNION ALL SELECT 'mini_batch', trial, nb, rate, iterations, w FROM mini_end
         UNION ALL SELECT 'sgd', trial, NULL, rate, iterations, w FROM sgd_end)""" + SCORES + """
SELECT method, CAST(rate AS DOUBLE) AS learning_rate, nb AS n_batches, test_rmse, train_rmse,
       test_r2, CAST(iterations AS INTEGER) AS iterations
FROM scores JOIN ends USING (method, trial)
QUALIFY row_number() OVER (PARTITION BY method ORDER BY round(test_rmse, 12), trial) = 1""")


@query("compare_methods", SPLIT + _compared(), "learning_rate test_rmse train_rmse test_r2")
def compare_methods(star):
    train, test = keyed_split(star)
    return regress.compare_methods(train, test, SCALED, "rating", "key", iterations=ITERATIONS,
                                   shard_rows=SHARD)


def _tuned():
    grid = list(itertools.product(*regress.GRIDS["batch"].values()))
    rows = []
    for trial, pick in enumerate(regress.trial_numbers(len(grid), 20, 42)):
        rate, momentum, penalty, strength = grid[pick]
        square, absolute = regress.PENALTIES[penalty]
        rows.append(f"({trial}, 1, {rate}, {momentum}, {square * strength},"
                    f" {absolute * strength}, 500, '{penalty}', {strength})")
    return ("tuned AS (SELECT * FROM (VALUES " + ", ".join(rows) + """)
           AS t(trial, nb, rate, momentum, square, absolute, last, penalty, strength)),"""
            + batched("plain", "(0, 1, 0.0, 0.0, 0.0, 0.0, 0)", [1], 500).replace(
                "SELECT * FROM (VALUES (0, 1, 0.0, 0.0, 0.0, 0.0, 0)) AS"
                " t(trial, nb, rate, momentum, square, absolute, last)",
                "SELECT trial, nb, rate, momentum, square, absolute, last FROM tuned") + """,
ends AS (SELECT 'batch' AS method, trial, iterations, w FROM plain_end)""" + SCORES + """
SELECT CAST(trial AS INTEGER) AS trial, CAST(rate AS DOUBLE) AS learning_rate,
       CAST(momentum AS DOUBLE) AS momentum, penalty, CAST(strength AS DOUBLE) AS strength,
       nb AS n_batches, test_rmse, CAST(iterations AS INTEGER) AS iterations
FROM scores JOIN ends USING (method, trial) JOIN tuned USING (trial)""")


@query("tune_random", SPLIT + _tuned(), "learning_rate momentum strength test_rmse")
def tune_random(star):
    train, test = split(star)
    return regress.tune_random(train, test, SCALED, "rating")


@query("sink_json_report", DESCENT + """
SELECT 'batch' AS method, CAST(i AS INTEGER) AS iteration, loss, used AS learning_rate,
       (SELECT min(loss) FROM run) AS best_loss, false AS converged FROM run
ORDER BY run.loss LIMIT 20
""", "loss learning_rate best_loss")
def sink_json_report(star):
    """The iterations of least loss of a descent, written as JSON and read back."""
    report = regress.convergence_trace(star.spark, {"batch": descend(star)}).drop("val_loss")
    path = scratch(star, "json")
    files.write_json_report(report, path, "loss")
    return star.spark.read.schema(report.schema).json(path)


@query("batch_score", """
WITH us AS (SELECT "userId", avg(rating) AS um FROM ratings GROUP BY 1),
p AS (SELECT (um - 2.5) / 0.5 * 0.4 + (rating - 3) / 2 * 0.6 + 2.75 AS p
      FROM ratings JOIN us USING ("userId"))
SELECT count(*) AS n, avg(p) AS mean, stddev_samp(p) AS std FROM p
""", "mean std")
def batch_score(star):
    folder, source, out = scratch(star, "model"), scratch(star, "in"), scratch(star, "out")
    models.save_linear(star.spark, folder, "best", ["um", "rating"], [0.4, 0.6], 2.75,
                       [2.5, 3.0], [0.5, 2.0], 1.0)
    models.save_linear(star.spark, folder, "worse", ["um", "rating"], [0.0, 0.0], 0.0,
                       [0.0, 0.0], [1.0, 1.0], 2.0)
    files.write_csv(table(star).select("userId", "um", "rating"), source)
    return models.batch_score(star.spark, models.load_linear(star.spark, folder), source, out)


@query("save_load_model", """
SELECT 'user' AS kind, "userId" AS id, avg(rating) AS mean FROM ratings GROUP BY 2
UNION ALL SELECT 'item', "movieId", avg(rating) FROM ratings GROUP BY 2
""", "mean")
def save_load_model(star):
    _, users, items = coldstart.baselines(star.ratings)
    folder = scratch(star, "model")
    models.save_tables({"users": users, "items": items}, folder)
    back = models.load_tables(star.spark, folder, ["users", "items"])
    return back["users"].select(
        F.lit("user").alias("kind"), F.col("userId").alias("id"), F.col("user_mean").alias("mean")
    ).unionByName(back["items"].select(
        F.lit("item").alias("kind"), F.col("movieId").alias("id"),
        F.col("item_mean").alias("mean")))
