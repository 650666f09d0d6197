"""Sources mixed to target weights by Pareto order sampling.

A source's ratio of target to size says how often each of its documents is taken: the whole part
is certain, the fraction is an inclusion probability. For the fraction, documents are ranked by
their random odds divided by their inclusion odds, and the first ones are taken until the words
of the source's target are filled, so the size of the sample is fixed, not just its mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.staging import stage

#: Bands that a source's ranks are divided into; only the band that the target ends in is sorted.
BANDS = 4096


def n_words(text: Column) -> Column:
    """Runs free of 0x20 and 0x09 to 0x0D; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def chance(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone: 52 bits of its MD5."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)


def targets(sizes: DataFrame, most: float, share: float = 1.0, weights: int = 3) -> DataFrame:
    """``sizes(source, source_size)`` with each source's ``target``.

    Sources in code point order, null last, weigh 1, 2, ..., ``weights``, repeating, and share
    ``share`` of all sizes. A target stops at ``most`` times its source's size; the excess is
    shared again by weight among the others until none is above. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn(
        "weight", (F.pmod(F.row_number().over(order) - 1, F.lit(weights)) + 1).cast("long"))
    limit = (F.col("source_size") * F.lit(most))
    # In order of limit over weight, a source is held at its limit if the level that the budget
    # left gives to the weights left is above that ratio.
    by_ratio = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(share)
              - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))) / F.sum("weight").over(later))
    # The first source that is not held has the level of all such; later ones show a lower one.
    graded = weighed.withColumn("level", level).withColumn("held", limit <= F.col("weight") * F.col("level"))
    free = F.max(F.when(~F.col("held"), F.col("level"))).over(everything)
    return graded.select("source", "source_size", F.when(F.col("held"), limit).otherwise(
        F.col("weight") * free).cast("double").alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", most: float = 3.0, seed: str = "mix",
        random_col: str | None = None) -> DataFrame:
    """``id_col, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``size`` counts the words, ``copies`` how often the mix takes the row and ``taken`` the words
    it takes. Every row has the whole part of target / source_size for certain; the rest of the
    target goes to rows in Pareto order, as long as each brings the source's words closer to it.
    Random numbers come from ``random_col`` (the id by default) and seed, and from the text where
    that is null, so reruns agree;
    rows of equal id follow each other by size and text. Rows without words take nothing. A null
    source is a source. An empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    key = F.concat_ws("/", F.lit(seed), F.coalesce(F.col(random_col or id_col).cast("string"), F.concat(F.lit("?"), text), F.lit("")))
    rows = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"),
        chance(key).alias("u"), F.coalesce(F.crc32(text.cast("binary")), F.lit(-1)).alias("tie")))
    shares = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), most)
                   .withColumn("ratio", F.when(F.col("source_size") > 0,
                                               F.col("target") / F.col("source_size")).otherwise(0.0))
                   .withColumn("whole", F.floor("ratio"))
                   .withColumn("part", F.col("ratio") - F.col("whole"))
                   .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    same = shares["source"].eqNullSafe(rows["source"])
    odds = lambda p: F.col(p) / (1 - F.col(p))
    # The band is a monotone function of the rank; without a fraction there is no rank.
    rank = F.when(F.col("part") > 0, odds("u") / odds("part"))
    ranked = (rows.join(shares, same, "left").drop(shares["source"])
              .withColumn("rank", rank)
              .withColumn("band", F.when(F.col("rank").isNotNull(), F.least(
                  F.floor(F.col("rank") / (1 + F.col("rank")) * BANDS), F.lit(BANDS - 1))).cast("int")))
    # Words up to each band: at most BANDS rows per source.
    bands = ranked.filter("size > 0 AND rank IS NOT NULL").groupBy("source", "band").agg(
        F.sum("size").alias("words"), F.first("budget").alias("budget"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("band"))
    ends = stage(bands.select("source", "band", (upto - F.col("words")).alias("before"), upto.alias("upto"), "budget")
                 .filter("before <= budget AND upto > budget")
                 .select(F.col("source").alias("s"), F.col("band").alias("last_band"), "before"))
    marked = ranked.join(ends, F.col("s").eqNullSafe(ranked["source"]), "left").drop("s")
    # Only rows of the band that the target ends in are put in order.
    border = marked.filter("band = last_band AND size > 0")
    run = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "size", "tie", "id")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = border.withColumn("filled", F.col("before") + run)
    extra = F.col("filled") - F.col("size") / 2 <= F.col("budget")
    rest = marked.filter("band IS NULL OR last_band IS NULL OR band <> last_band OR size = 0")
    below = (F.col("size") > 0) & F.coalesce(F.col("band") < F.col("last_band"),
                                             F.col("band").isNotNull())
    result = ["id", "size", "source_size", "target"]
    both = (filled.select(*result, (F.col("whole") + extra.cast("int")).alias("copies"))
            .unionByName(rest.select(*result, (F.col("whole") + below.cast("int")).alias("copies"))))
    return both.select(F.col("id").alias(id_col), "size", "source_size", "target",
                       F.col("copies").cast("int").alias("copies"),
                       (F.col("copies") * F.col("size")).cast("long").alias("taken"))
