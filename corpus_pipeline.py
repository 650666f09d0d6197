"""A corpus pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage is a function of (spark, docs, folder); its result is written as Parquet to the shared
folder and read back as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.staging import shared_dir
from ratingloom.llm import decontaminate, langid, mixing, queries, sharding, simhash

#: A document whose predicted language has less than this share of its letters is rejected, as is
#: one without a letter.
LEAST_LANGUAGE_SHARE = 0.5


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc``: a name for each row, and the row itself, whose columns clash with nothing there.

    The documents of a stage are Parquet files. A row is named by its id, then its file and place
    in it, so rows of equal or null id stay apart, and a name stays the same however a later scan
    is split, also after executors came or went."""
    meta = docs.metadataColumn("_metadata")
    return docs.select(F.struct("doc_id", meta["file_path"].alias("file"), meta["row_index"].alias("at"))
                       .alias("row"), F.struct(*docs.columns).alias("doc"))


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in one learned language; the others go.

    A null text, or one without a letter, has no language and goes. Ids play no part beyond the
    choice of training rows; equal rows are judged alike; an empty table gives an empty one."""
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(docs, model, LEAST_LANGUAGE_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id (null first).

    Linked are texts whose SimHash fingerprints of 4-word shingles differ in 4 bits or fewer, as in
    ``op1_simhash``. Null texts and texts without words are one group; of equal rows one stays; an
    empty table gives an empty one."""
    rows = numbered(docs)
    more = (simhash.near_duplicates(rows.select("row", "doc.text"), id_col="row")
            .filter("row <> component_id").select("row"))
    return rows.join(more, "row", "left_anti").select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that no benchmark passage contaminates.

    Null and empty texts stay, as do all if the benchmark is empty; rows of equal or null id are
    judged one by one; an empty table gives an empty one."""
    rows = numbered(docs)
    found = decontaminate.contamination(
        rows.select(F.col("row").alias("at"), "doc.text"), queries.table(spark, folder, "benchmark"),
        id_col="at")
    bad = found.filter(queries.contaminated()).select(F.col("at").alias("row"))
    return rows.join(bad, "row", "left_anti").select("doc.*")


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Null and empty texts have size 0 and are not taken. A null source is a source. Rows of equal id
    draw the same number; ties go by size, then row. An empty table gives an empty one."""
    rows = numbered(docs)
    parts = rows.select("row", "doc.doc_id", "doc.text", "doc.source")
    taken = mixing.mix(parts, id_col="row", random_col="doc_id").filter("copies > 0")
    return (rows.join(taken.select("row", "copies"), "row")
            .select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*"))


def shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shard and place of every document of the mix; null ids, null texts and equal rows included."""
    return sharding.shard_rows(docs, queries.SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixture", mixture), ("shards", shards)]

#: SimHash and the language model have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
