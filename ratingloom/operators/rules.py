"""Baskets, frequent itemsets, association rules, rule-based recommendation."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.functions.stats import dense_index
from ratingloom.operators.gram import MAX_TASKS, gram_pairs

WORD = 63  # users per word of the vertical layout; one bit stays for the sign
BLOCK_WORDS = 512  # words of the vertical layout that one group of a count holds
SLICE = 50_000  # candidates that one group of a count holds
CHUNK = 256  # candidates whose bit sets are intersected at once
TASK_ITEMS = 200_000  # basket items whose antecedents one task looks for


def transactions(ratings: DataFrame, item: str = "item", threshold: float = 4.0,
                 min_items: int = 2) -> DataFrame:
    """``userId, item, basket_size``: what each user liked, users with too few items left out.

    Baskets stay in long form; the mining operators build bounded arrays where they need them.
    """
    liked = (
        ratings.where(F.col("rating") >= threshold)
        .select("userId", F.col(item).alias("item")).distinct()
    )
    sizes = liked.groupBy("userId").agg(F.count(F.lit(1)).alias("basket_size"))
    return liked.join(sizes.where(F.col("basket_size") >= min_items), "userId").select(
        "userId", "item", "basket_size")


def basket_summary(baskets: DataFrame) -> DataFrame:
    """Number of baskets and their mean size."""
    return baskets.agg(
        F.count_distinct("userId").alias("n_transactions"),
        (F.count(F.lit(1)) / F.count_distinct("userId")).alias("mean_size"),
    )


def basket_count(baskets: DataFrame) -> int:
    return baskets.select("userId").distinct().count()


def min_count(n: int, min_support: float) -> int:
    """Smallest basket count whose share reaches ``min_support``."""
    return max(1, math.ceil(round(min_support * n, 9)))


def frequent_items(baskets: DataFrame, least: int) -> DataFrame:
    return (
        baskets.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
        .where(F.col("freq") >= least)
    )


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.01) -> DataFrame:
    """``items, freq, support`` by FP-growth, items sorted.

    Only frequent items enter the basket arrays. Their number is at most the mean basket
    size over ``min_support``, which bounds every array whatever one user rated.
    """
    n = basket_count(baskets)
    least = min_count(n, min_support)
    useful = baskets.join(frequent_items(baskets, least).select("item"), "item", "left_semi")
    arrays = stage(
        useful.groupBy("userId").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("items")
    )
    kept = arrays.count()
    if not kept:
        return arrays.select("items", F.lit(0).cast("long").alias("freq"),
                             F.lit(0.0).alias("support")).limit(0)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / kept).fit(arrays)
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / n).alias("support"))


def vertical(baskets: DataFrame) -> DataFrame:
    """``item, word, bits``: the users of an item as bit sets of ``WORD`` users each."""
    users = dense_index(baskets, "userId", "u")
    bit = F.expr(f"shiftleft(cast(1 as bigint), cast(u % {WORD} as int))")
    return (
        baskets.select("userId", "item").join(users, "userId")
        .groupBy("item", F.expr(f"u div {WORD}").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def frequent_itemsets_apriori(baskets: DataFrame, min_support: float = 0.01,
                              max_size: int | None = None) -> DataFrame:
    """The same itemsets level by level.

    Pairs come from the blocked product of the item x user matrix. From size three on,
    candidates are joined on their common prefix, those with an infrequent subset are
    dropped, and the rest are counted by intersecting bit sets of users, block by block of
    users, so that what is shuffled is a number per candidate and block.
    """
    n = basket_count(baskets)
    least = min_count(n, min_support)
    singles = stage(frequent_items(baskets, least))
    useful = stage(baskets.select("userId", "item").join(singles.select("item"), "item",
                                                         "left_semi"))
    ids = stage(dense_index(singles, "item", "i"))
    levels = [singles.select(F.array("item").alias("items"), "freq")]
    entries = useful.join(ids, "item").select(
        F.col("i").alias("r"), F.col("userId").cast("long").alias("f"), F.lit(1.0).alias("v"))
    low, high = ids.toDF("first", "a"), ids.toDF("second", "b")
    pairs = (
        gram_pairs(entries).where(F.col("n_common") >= least)
        .join(low, "a").join(high, "b")
        .select(F.array("first", "second").alias("items"), F.col("n_common").alias("freq"))
    )
    bits, size = None, 2
    current = stage(pairs)
    while current.limit(1).count():
        levels.append(current)
        size += 1
        if max_size is not None and size > max_size:
            break
        bits = stage(vertical(useful)) if bits is None else bits
        current = stage(_next_level(current, bits, size, least, n))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole.withColumn("support", F.col("freq") / n)


def _next_level(level: DataFrame, bits: DataFrame, size: int, least: int, users: int
                ) -> DataFrame:
    parts = level.select(
        F.slice("items", 1, size - 2).alias("prefix"), F.element_at("items", -1).alias("last"))
    candidates = (
        parts.join(parts.withColumnRenamed("last", "next"), "prefix")
        .where(F.col("last") < F.col("next"))
        .select(F.concat("prefix", F.array("last", "next")).alias("items"))
    )
    subsets = candidates.select("items", F.explode(F.transform(
        "items", lambda x, i: F.filter("items", lambda y, j: j != i))).alias("subset"))
    known = level.select(F.col("items").alias("subset"))
    whole = stage(
        subsets.join(known, "subset").groupBy("items").agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") == size).select("items")
        .withColumn("id", F.monotonically_increasing_id())
    )
    counts = _counted(whole, bits, users).where(F.col("freq") >= least)
    return whole.join(counts, "id").select("items", "freq")


def _counted(candidates: DataFrame, bits: DataFrame, users: int) -> DataFrame:
    """``id, freq``: the users that have all ``items`` of a candidate.

    A group holds the bit sets of a block of users and a slice of the candidates.
    """
    blocks = max(1, math.ceil(users / (WORD * BLOCK_WORDS)))
    slices = max(1, math.ceil(candidates.count() / SLICE))
    groups = min(blocks * slices, MAX_TASKS)
    block = F.expr(f"word div {BLOCK_WORDS}").alias("block")
    asked = (
        candidates.crossJoin(bits.select(block).distinct())
        .select("block", F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"), "id", "items")
        .repartition(groups, "block", "slice").groupBy("block", "slice")
    )
    held = (
        bits.select(block, F.explode(F.expr(f"sequence(0L, {slices - 1}L)")).alias("slice"),
                    "item", F.expr(f"cast(word % {BLOCK_WORDS} as int)").alias("word"), "bits")
        .repartition(groups, "block", "slice").groupBy("block", "slice")
    )

    def count(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"id": [], "n": []}).astype("int64")
        rows, names = pd.factorize(held["item"])
        sets = np.zeros((len(names) + 1, BLOCK_WORDS), np.int64)  # the last for an item nobody has
        sets[rows, held["word"].to_numpy()] = held["bits"].to_numpy()
        places = pd.Index(names).get_indexer(np.concatenate(asked["items"].to_numpy()))
        places = places.reshape(len(asked), -1)
        found = np.empty(len(asked), np.int64)
        for start in range(0, len(places), CHUNK):
            part = places[start:start + CHUNK]
            both = sets[part[:, 0]]
            for column in part.T[1:]:
                both &= sets[column]
            found[start:start + CHUNK] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        return pd.DataFrame({"id": asked["id"].to_numpy(), "n": found})[found > 0]

    return (asked.cogroup(held).applyInPandas(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("freq")))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5, min_lift: float = 1.0
                      ) -> DataFrame:
    """Every split of every itemset into antecedents and consequents that is strong enough."""
    known = itemsets.select("items", "support")
    masks = F.sequence(F.lit(1), F.expr("cast(shiftleft(1, size(items)) - 2 as int)"))

    def chosen(inside: int) -> Column:
        return F.expr(f"filter(items, (x, i) -> (shiftright(mask, i) & 1) = {inside})")

    splits = (
        known.where(F.size("items") >= 2).withColumn("mask", F.explode(masks))
        .select("support", chosen(1).alias("antecedents"), chosen(0).alias("consequents"))
    )
    a = known.select(F.col("items").alias("antecedents"), F.col("support").alias("_a"))
    c = known.select(F.col("items").alias("consequents"), F.col("support").alias("_c"))
    confidence, lift = F.col("support") / F.col("_a"), F.col("confidence") / F.col("_c")
    return (
        splits.join(a, "antecedents").join(c, "consequents")
        .withColumn("confidence", confidence).withColumn("lift", lift)
        .withColumn("leverage", F.col("support") - F.col("_a") * F.col("_c"))
        .withColumn("conviction", F.try_divide(1 - F.col("_c"), 1 - F.col("confidence")))
        .where((F.col("lift") >= min_lift) & (F.col("confidence") >= min_confidence))
        .select("antecedents", "consequents", "support", "confidence", "lift", "leverage",
                "conviction")
    )


def short_list(items: str, shown: int, more: str = "") -> Column:
    """First names joined by commas, and how many more there are."""
    extra = F.size(items) - shown
    return F.concat(
        F.concat_ws(", ", F.slice(items, 1, shown)),
        F.when(extra > 0, F.concat(F.lit(" +"), extra.cast("string"), F.lit(more)))
        .otherwise(""),
    )


def top_rules(rules: DataFrame, metric: str = "lift", n: int = 10) -> DataFrame:
    """The ``n`` best rules by a metric, rendered as text."""
    best = rules.orderBy(F.desc(F.round(metric, 9)), "antecedents", "consequents").limit(n)
    return best.select(
        short_list("antecedents", 2).alias("antecedent"),
        short_list("consequents", 2).alias("consequent"), "support", "confidence", "lift",
    )


def movie_bundles(itemsets: DataFrame, min_size: int = 2, max_size: int = 5, n: int = 10
                  ) -> DataFrame:
    """The ``n`` itemsets of some size with the highest support."""
    best = (
        itemsets.where(F.size("items").between(min_size, max_size))
        .orderBy(F.desc(F.round("support", 9)), "items").limit(n)
    )
    return best.select(short_list("items", 3, " more").alias("movies"),
                       F.size("items").alias("size"), "support")


def rule_sides(rules: DataFrame) -> DataFrame:
    """``side, antecedents``: a number for each distinct antecedent list."""
    return stage(rules.select("antecedents").distinct().withColumn(
        "side", F.monotonically_increasing_id()))


def rule_subset_join(rules: DataFrame, baskets: DataFrame, sides: DataFrame | None = None
                     ) -> DataFrame:
    """``userId, side, antecedents``: the antecedents wholly inside a user's basket."""
    sides = rule_sides(rules) if sides is None else sides
    return _met_sides(sides, baskets).join(sides, "side").select("userId", "side", "antecedents")


def _met_sides(sides: DataFrame, baskets: DataFrame) -> DataFrame:
    """``userId, side``, dealt by user.

    Each antecedent list meets the baskets through its rarest item, and the other items are
    looked up in the basket at hand: a bit for each item that any list has, so what a row carries
    is bounded by the lists and not by a user's history. Only the baskets are shuffled.
    """
    items = sides.select("side", F.explode(F.array_distinct("antecedents")).alias("item"))
    kept = stage(baskets.select("userId", "item").join(
        items.select("item").distinct(), "item", "left_semi"))
    # an item no basket has leaves its lists without a match
    freq = (items.select("item").distinct()
            .join(kept.groupBy("item").agg(F.count(F.lit(1)).alias("freq")), "item", "left")
            .select("item", F.coalesce("freq", F.lit(0)).alias("freq")))
    freq = stage(freq.join(dense_index(freq, "item", "i"), "item", "left").select(
        "item", "freq", "i", F.expr(f"i div {WORD}").alias("word"),
        F.expr(f"shiftleft(cast(1 as bigint), cast(i % {WORD} as int))").alias("bit")))
    parts = (
        items.join(freq, "item", "left").groupBy("side", "word")
        .agg(F.min(F.struct("freq", "item", "i")).alias("rare"), F.bit_or("bit").alias("mask"))
        .groupBy("side").agg(
            F.min("rare").alias("rare"), F.collect_list(F.struct("word", "mask")).alias("masks"))
    )
    asked = stage(parts.where(F.col("rare.freq") > 0).select(
        "side", F.col("rare.i").alias("i"), F.col("masks")[0].alias("one"),
        F.expr("slice(masks, 2, size(masks))").alias("more"),
        F.expr("aggregate(masks, 0L, (n, m) -> n + bit_count(m.mask))").alias("size")))
    size = freq.agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0]
    cores = baskets.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(2 * cores, math.ceil(size / TASK_ITEMS)), MAX_TASKS)
    users = (
        kept.join(freq.select("item", "i", "word", "bit"), "item").repartition(tasks, "userId")
        .groupBy("userId", "word").agg(F.bit_or("bit").alias("bits"), F.collect_set("i").alias("own"))
        .groupBy("userId").agg(
            F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"),
            F.flatten(F.collect_list("own")).alias("own"))
    )
    whole = "held[one.word] & one.mask = one.mask"
    others = "size(more) = 0 or forall(more, m -> coalesce(held[m.word] & m.mask = m.mask, false))"
    return (
        users.select("userId", "held", F.explode("own").alias("i")).join(asked, "i")
        .where(F.expr(f"({whole}) and ({others})"))
        .where(F.col("userId").isNotNull() | (F.col("size") == 1)).select("userId", "side")
    )


def _telling(best: DataFrame, sides: DataFrame) -> DataFrame:
    """Rows of ``best(side, item, score)`` that can be the best of a basket.

    Who meets a list meets its parts, so a list says nothing of an item that one of its items
    alone, or all but one, gives as good a score. Of parts that say the same the smallest stays.
    """
    lists = sides.select("side", F.array_sort(F.array_distinct("antecedents")).alias("list"))
    part = F.explode(F.concat(
        F.transform("list", lambda x: F.array(x)),
        F.transform("list", lambda x, i: F.filter("list", lambda y, j: j != i))))
    parts = (
        lists.where(F.size("list") > 1).select("side", part.alias("list")).distinct()
        .join(lists.select(F.col("side").alias("part"), "list"), "list").select("side", "part")
    )
    other = best.select(F.col("side").alias("part"), "item", F.col("score").alias("known"))
    lesser = (
        best.join(parts, "side").join(other, ["part", "item"]).where("known >= score")
        .select("side", "item")
    )
    return best.join(lesser, ["side", "item"], "left_anti").select("side", "item", "score")


def rule_recommend(rules: DataFrame, baskets: DataFrame, n: int = 5) -> DataFrame:
    """``userId, item, score, place``: unseen consequents by the best confidence of any rule."""
    sides = rule_sides(rules)
    best = stage(
        rules.select("antecedents", "confidence", F.explode("consequents").alias("item"))
        .join(sides, "antecedents").groupBy("side", "item")
        .agg(F.max("confidence").alias("score"))
    )
    best = stage(_telling(best, sides))
    scored = (
        _met_sides(sides.join(best, "side", "left_semi"), baskets).join(best, "side")
        .groupBy("userId", "item").agg(F.max("score").alias("score"))
        .join(baskets.select("userId", "item"), ["userId", "item"], "left_anti")
    )
    order = Window.partitionBy("userId").orderBy(F.desc(F.round("score", 9)), "item")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def mining_summary(baskets: DataFrame, fp: DataFrame, apriori: DataFrame,
                   min_confidence: float) -> DataFrame:
    """Transactions, itemsets and rules of both algorithms."""

    def line(name: str, itemsets: DataFrame) -> DataFrame:
        rules = association_rules(itemsets, min_confidence)
        return itemsets.agg(
            F.lit(name).alias("algorithm"), F.count(F.lit(1)).alias("itemsets"),
        ).withColumns({
            "rules": rules.agg(F.count(F.lit(1))).scalar(),
            "transactions": baskets.agg(F.count_distinct("userId")).scalar(),
        })

    return line("fpgrowth", fp).unionByName(line("apriori", apriori))
