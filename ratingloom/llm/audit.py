"""Filter interaction audit: what each filter removes, in every order of application.

A document is a mask of the filters it fails, so a part of the corpus is at most 32 cells of counts,
added up before anything is shuffled. Each cell then folds across the array of all 120 orders: a
nested ``aggregate`` walks an order and hands on one struct a step, ``transform`` does so for every
order, and the 600 structs of a part's cells are added element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage

FILTERS = "ABCDE"
#: All orders, as positions in ``FILTERS``.
ORDERS = list(permutations(range(len(FILTERS))))
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def word_counts(text: Column) -> Column:
    """``n, distinct`` of the runs free of white space (0x20, 0x09 to 0x0D), from one split."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")))[0]


def own_failures(text: Column, counts: Column) -> Column:
    """Bits of the filters A to D that a text fails; each looks at the whole text alone."""
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [counts["n"] < 200, 100 * counts["distinct"] < 50 * counts["n"],
             100 * capitals > 2 * F.char_length(text).cast("long"), text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each mask, and those that a label calls good or toxic.

    Filter E fails where a row of smaller id has the same text. Texts are compared by their SHA-256
    digests. A null id is not smaller than another and is no copy; null and empty texts are equal.
    An id with several labels is good (toxic) if one of them says so.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stage(
        docs.select(F.col(id_col).alias("id"), F.col(part_col).cast("string").alias("part"), text.alias("text"))
        .withColumn("counts", word_counts(F.col("text")))
        .select("id", F.coalesce("part", F.lit("")).alias("part"),
                own_failures(F.col("text"), F.col("counts")).alias("own"),
                F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")))
    first = (rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
             .filter("rows > 1").select("digest", "first"))
    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    mask = F.col("own") + F.when(copy, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    return (rows.join(first, "digest", "left").select("id", "part", mask.alias("mask"))
            .join(marked, "id", "left")
            .groupBy("part", "mask").agg(F.count("*").alias("n"),
                                         F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                         F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def steps_of(order: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The fold of one cell across one order: a struct of counts for each of its steps."""
    none = F.lit(0).cast("long")
    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("steps"))

    def step(state: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), letter)
        fails = mask.bitwiseAND(bit) != 0
        removed = state["alive"] & fails
        counts = F.struct(
            F.when(state["alive"] & ~fails, n).otherwise(none).alias("kept"),
            F.when(removed, n).otherwise(none).alias("removed"),
            F.when(~state["alive"] & fails, n).otherwise(none).alias("redundant"),
            F.when(mask == bit, n).otherwise(none).alias("unique_fails"),
            F.when(removed, good).otherwise(none).alias("good_lost"),
            F.when(removed, toxic).otherwise(none).alias("toxic_lost"))
        return F.struct((state["alive"] & ~fails).alias("alive"),
                        F.concat(state["steps"], F.array(counts)).alias("steps"))

    return F.aggregate(order, start, step, lambda state: state["steps"])


def folded(counted: DataFrame) -> DataFrame:
    """``part, steps``: 600 structs of counts for every part, in the order of ``ORDERS``."""
    orders = F.array(*[F.array(*map(F.lit, order)) for order in ORDERS])
    cell = F.flatten(F.transform(orders, lambda order: steps_of(
        order, F.col("mask"), F.col("n"), F.col("good"), F.col("toxic"))))

    def added(one: Column, other: Column) -> Column:
        return F.struct(*[(one[c] + other[c]).alias(c) for c in COUNTS])

    # A part has at most 32 cells, whatever its rows.
    each = counted.select("part", cell.alias("steps")).groupBy("part").agg(
        F.collect_list("steps").alias("cells"))
    merged = F.aggregate(F.slice("cells", 2, len(ORDERS)), F.col("cells")[0],
                         lambda total, one: F.zip_with(total, one, added))
    return each.select("part", merged.alias("steps"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, filter_order, step`` and counts, for all orders and steps of every part of ``docs``.

    ``kept`` pass every filter up to the step, ``removed`` go at the step, ``redundant`` fail its
    filter but were removed before, ``unique_fails`` fail its filter only; ``good_lost`` and
    ``toxic_lost`` are the removed that ``labels(doc_id, quality, toxic)`` call good or toxic;
    ``shapley`` sums what the step's filter removes over all orders.

    A null part is the empty string and merges with it. Null texts are empty. Null ids are counted,
    never as copies, and have no labels; repeated rows are counted as often as they are given, and
    are no copies of each other, as their ids are equal. Without labels nothing is good or toxic.
    An empty table gives an empty result.
    """
    names = F.array(*[F.lit("".join(FILTERS[i] for i in order)) for order in ORDERS])
    rows = folded(cells(docs, labels, id_col, text_col, part_col)).select(
        "part", F.posexplode("steps").alias("at", "s"))
    order = names[F.floor(F.col("at") / len(FILTERS)).cast("int")]
    named = rows.select("part", order.alias("filter_order"),
                        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), "s.*")
    # 120 rows a part and filter.
    same = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return named.withColumn("shapley", F.sum("removed").over(same))
