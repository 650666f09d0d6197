"""CSV and Parquet readers and writers, JSON reports, run manifests, datasets by task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.operators.clean import numeric_columns
from ratingloom.sources.schemas import MOVIES, RATINGS, TAGS


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with quoted fields; the schema is given, never inferred."""
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"')
        .option("escape", '"').csv(path)
    )


def load_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three input tables of a folder; a missing file raises when it is opened."""
    return {
        name: read_csv(spark, f"{folder}/{name}.csv", schema)
        for name, schema in (("ratings", RATINGS), ("movies", MOVIES), ("tags", TAGS))
    }


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; arrays are joined with ``|`` and times written as plain text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    (
        df.select(*columns).write.mode("overwrite").option("header", True)
        .option("escape", '"').csv(path)
    )


def write_parquet(df: DataFrame, path: str, compression: str = "snappy",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet with the codec given, whatever the size; gzip suits what is kept for long."""
    writer = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json_report(trials: DataFrame, path: str, metric: str = "test_rmse", top: int = 20
                      ) -> None:
    """The best trials as JSON lines, best first."""
    trials.orderBy(F.asc(metric)).limit(top).write.mode("overwrite").json(path)


# --- saved runs ---------------------------------------------------------------------------

MANIFEST = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
])
#: Tables a complete run holds (fixed values).
RUN_TABLES = ["user_features", "movie_features", "feature_matrix"]


def save_run(tables: Mapping[str, DataFrame], folder: str, version: str = "2.1") -> None:
    """Tables first, the one-row manifest last, so a half-written run is never valid."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}")
    manifest = spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("created"),
        F.array(*[F.lit(n) for n in tables]).alias("tables"),
    )
    manifest.write.mode("overwrite").json(f"{folder}/_manifest_table")


def valid_runs(manifests: DataFrame, now, required: Sequence[str] = (), max_age_days: int = 30
               ) -> DataFrame:
    """Manifests a run may be reused from: version 2, young enough, all tables present."""
    needed = F.array(*[F.lit(t) for t in required]) if required else F.array().cast("array<string>")
    today = now if isinstance(now, Column) else F.lit(now)
    age = F.datediff(today.cast("timestamp"), F.col("created"))
    return manifests.where(
        F.col("version").startswith("2.") & (age <= max_age_days)
        & (F.size(F.array_except(needed, F.col("tables"))) == 0)
    )


def load_run(spark: SparkSession, folder: str, now=None, required: Sequence[str] = RUN_TABLES
             ) -> dict[str, DataFrame]:
    """Tables of a saved run, or an empty dict when it is absent or not valid."""
    from pyspark.errors import AnalysisException

    try:
        manifests = spark.read.schema(MANIFEST).json(f"{folder}/_manifest_table")
        today = F.current_timestamp() if now is None else now
        rows = valid_runs(manifests, today, required).collect()
    except AnalysisException:
        return {}
    return {n: spark.read.parquet(f"{folder}/{n}") for n in rows[0]["tables"]} if rows else {}


# --- datasets by task -----------------------------------------------------------------------

TASKS = ["regression", "classification", "clustering_users", "clustering_movies",
         "association_rules"]


def get_task_dataset(datasets: Mapping[str, DataFrame], task: str) -> dict:
    """One task's dataset with its label and feature columns; ``{}`` for an unknown task."""
    if task not in datasets:
        return {}
    df = datasets[task]
    label = "label" if "label" in df.columns else None
    keys = [c for c in ("userId", "movieId", "label") if c in df.columns]
    return {"X": df, "y": label, "feature_names": numeric_columns(df, exclude=keys)}


def task_info(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``task, samples, features, distinct_targets`` for every dataset."""
    parts = []
    for task, df in datasets.items():
        found = get_task_dataset(datasets, task)
        targets = F.count_distinct("label") if found["y"] else F.lit(None).cast("long")
        parts.append(df.agg(
            F.lit(task).alias("task"), F.count(F.lit(1)).alias("samples"),
            F.lit(len(found["feature_names"])).cast("long").alias("features"),
            targets.alias("distinct_targets"),
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def read_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by the file name; CSV columns arrive as text."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", True).csv(path)
