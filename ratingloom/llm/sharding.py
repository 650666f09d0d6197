"""Shards of near equal bytes, by fixed virtual slots.

Records are hashed into a fixed number of virtual slots, far more than shards. The slot of a
record never changes. Which shard holds a slot is said by a map with a version; rebalancing
counts the bytes of each slot and edits the map, and every edit is a version of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.staging import shared_dir, stage

SLOTS = 8192


def virtual_slot(*key: Column, slots: int = SLOTS) -> Column:
    """The fixed slot of a record, from the columns that name it; nulls count as a value."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Version 1: slots dealt to shards in turn."""
    return {slot: slot % shards for slot in range(slots)}


def slot_bytes(records: DataFrame, slot_col: str, size_col: str) -> dict[int, int]:
    """Bytes of each slot that has any; as many numbers as slots at most."""
    rows = records.groupBy(slot_col).agg(F.sum(size_col).alias("n")).collect()
    return {r[slot_col]: r["n"] for r in rows}


def rebalanced(slot_map: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map over ``shards`` shards (as many or more) whose bytes are near equal.

    Slots move one at a time from the fullest shard to the emptiest, the one that comes closest
    to half their difference, as long as a move brings the two closer. Slots not moved stay.
    """
    edited = dict(slot_map)
    load = [0] * shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for slot, shard in edited.items():
        if n := weight.get(slot, 0):
            load[shard] += n
            held[shard][slot] = n
    done: set[int] = set()  # shards with nothing left that is worth moving
    while len(done) < shards:
        low = min(range(shards), key=lambda s: (load[s], s))
        high = max((s for s in range(shards) if s not in done), key=lambda s: (load[s], -s))
        gap = load[high] - load[low]
        better = [(abs(gap / 2 - n), slot) for slot, n in held[high].items() if n < gap]
        if not better:
            done.add(high)
            continue
        _, slot = min(better)
        n = held[high].pop(slot)
        held[low][slot] = n
        load[high] -= n
        load[low] += n
        edited[slot] = low
        done.discard(low)
    return edited


class SlotMaps:
    """Versions of a slot-to-shard map, a Parquet table each under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, version: int, slot_map: dict[int, int]) -> DataFrame:
        rows = [(version, slot, shard) for slot, shard in sorted(slot_map.items())]
        (self.spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.folder}/version={version}"))
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return (self.spark.read.schema("virtual_slot int, shard int")
                .parquet(f"{self.folder}/version={version}"))


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
               overhead: int = 16, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, version``.

    The law is ``bytes``: a record weighs the UTF-8 bytes of its text (a null text: none) plus
    ``overhead``, and version 1 of the map (slots in turn) is edited into version 2 by the bytes
    of the slots. ``slot`` numbers the rows of a shard from 0 without gaps; ``grown_shard`` is
    null under this law. A null text has the checksum of an empty one. Records are hashed by id
    and text, so null ids spread; fully equal rows share a slot. Both versions are kept under
    ``folder`` (a new one in the shared folder by default). An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.col(id_col)
    sized = docs.select(key.alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    sized = stage(sized.withColumn("virtual_slot", virtual_slot(F.col("id"), F.col("text_crc32"),
                                                                slots=slots)))
    weight = slot_bytes(sized, "virtual_slot", "size")
    maps = SlotMaps(spark, folder or f"{shared_dir(spark)}/slots-{spark.sparkContext.applicationId}"
                    f"-{spark._jvm.java.util.UUID.randomUUID()}")
    first = first_map(shards, slots)
    maps.write(1, first)
    edited = maps.write(2, rebalanced(first, weight, shards))
    # Rows are numbered within their virtual slot and shifted by the slots before it in the shard,
    # so that no task sorts a whole shard. Both small tables have one row per slot.
    rows = sized.groupBy("virtual_slot").agg(F.count("*").alias("n")).join(F.broadcast(edited), "virtual_slot")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("virtual_slot")
                             .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.select("virtual_slot", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size"))
    return (sized.withColumn("inside", inside).join(F.broadcast(placed), "virtual_slot").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(2).alias("version")))
