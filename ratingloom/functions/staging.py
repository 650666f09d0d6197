"""Intermediate tables in the cluster's shared folder.

An operator that reads an aggregate more than once (thresholds first, then the
projection that uses them) writes it once as Parquet and reads it back, so the
facts are scanned a single time and a lost executor costs nothing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="ratingloom-")
    return _LOCAL_DIRS[app]


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan that has fewer input splits than the cluster has cores.

    A table in a handful of row groups would otherwise keep everything up to the first
    shuffle in that many tasks. A scan with enough splits is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
