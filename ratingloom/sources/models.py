"""Saved models: tables and parameters as Parquet, ml pipelines in their own format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.clean import numeric_columns
from ratingloom.operators.regress import predict_linear
from ratingloom.sources.files import read_by_suffix


def save_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Tabular models: similarities, rules, baselines, scaler parameters."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def save_linear(spark: SparkSession, folder: str, name: str, features: Sequence[str],
                weights: Sequence[float], bias: float, means: Sequence[float],
                stds: Sequence[float], test_rmse: float) -> None:
    """One row: features, weights, bias, scaling and the score the best model is chosen by."""
    spark.createDataFrame(
        [(name, list(features), [float(w) for w in weights], float(bias),
          [float(m) for m in means], [float(s) for s in stds], float(test_rmse))],
        "name string, features array<string>, weights array<double>, bias double,"
        " means array<double>, stds array<double>, test_rmse double",
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/linear/model={name}")


def load_linear(spark: SparkSession, folder: str, name: str | None = None) -> dict:
    """A saved linear model; the one with the lowest test RMSE when no name is given."""
    models = spark.read.parquet(f"{folder}/linear")
    if name is not None:
        models = models.where(F.col("name") == name)
    return models.orderBy("test_rmse", "name").first().asDict()


def save_pipeline(model: PipelineModel, folder: str) -> None:
    model.write().overwrite().save(folder)


def load_pipeline(folder: str) -> PipelineModel:
    return PipelineModel.load(folder)


def batch_score(spark: SparkSession, model: Mapping, path: str, out: str) -> DataFrame:
    """Score a CSV or Parquet file, write the predictions as CSV, report their mean and deviation.

    Columns the model needs are read as numbers; what is not a number counts as 0.
    """
    data = read_by_suffix(spark, path)
    numbers = numeric_columns(data)
    columns = {
        c: F.coalesce(F.col(c) if c in numbers else F.col(c).try_cast("double"), F.lit(0.0))
        for c in model["features"]
    }
    scaled = data.select(*[
        ((columns[c] - F.lit(m)) / F.lit(s)).alias(c)
        for c, m, s in zip(model["features"], model["means"], model["stds"])
    ])
    predicted = predict_linear(scaled, model["features"], model["weights"], model["bias"])
    predicted.select("prediction").write.mode("overwrite").option("header", True).csv(out)
    written = spark.read.schema("prediction double").option("header", True).csv(out)
    return written.agg(F.count("prediction").alias("n"), F.avg("prediction").alias("mean"),
                       F.stddev_samp("prediction").alias("std"))
