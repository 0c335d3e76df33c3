"""Mixing sources to target weights, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, free_name, written

# Weights of the sources in order of code points, repeated; how often a source may be taken.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"


def size_of(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, source: str, size: str, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``<source>, source_size, target, rate`` per source.

    The whole size is shared by weight; a source gets at most ``most`` times its size, and what that leaves goes to
    the others by weight until none is above. Sorted by size per weight, the sources that reach their limit are the
    first ones, so one running sum over the sources finds the share per weight. The window has no partition: its
    input is one row per source, pre-aggregated. A source without words has target 0 and rate 0.
    """
    total = sized.groupBy(source).agg(F.sum(size).cast("bigint").alias("source_size"))
    ordered = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1)
    weighted = total.withColumn("weight", weight.cast("bigint"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col(source).asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    summed = weighted.select(
        source, "source_size", "weight",
        F.sum("source_size").over(everything).alias("sum_size"),
        F.sum("weight").over(everything).alias("sum_weight"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full_size"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("full_weight"),
    )
    left = F.col("sum_size") - most * F.col("full_size")
    share = left.cast("double") / (F.col("sum_weight") - F.col("full_weight")).cast("double")
    fits = F.when(F.col("source_size") * most >= share * F.col("weight"), share)
    level = F.first(fits, ignorenulls=True).over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    limit = (F.col("source_size") * most).cast("double")
    target = F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    return (
        summed.withColumn("level", level)
        .select(source, "source_size", target.alias("target"))
        .withColumn("rate", rate)
    )


def chance(doc_id: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id: the same in every run and after every retry."""
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(f"|{seed}")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / float(1 << 52)


def copies_of(rate: str, doc_id: str, seed: str = SEED) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(F.col(rate) - whole > chance(doc_id, seed), 1).otherwise(0)).cast("bigint")


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with how often each row is taken, and the names of the columns added: size, source_size, target, copies.

    The sums per source are written down first: they are one row per source, and Spark broadcasts that table or
    sorts by it as its file size tells. A null source is a source of its own, the last in order. Equal ids draw
    equal lots, null ids too.
    """
    names = {n: free_name(docs, n) for n in ("size", "source_size", "target", "copies")}
    sized = docs.withColumn(names["size"], size_of(text))
    slim = docs.select(F.col(source).alias("s"), size_of(text).alias("n"))
    targets = written(source_targets(slim, "s", "n", weights, most), "targets")
    key, rate = free_name(docs, "mix_source"), free_name(docs, "mix_rate")
    targets = targets.select(F.col("s").alias(key), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]), F.col("rate").alias(rate))
    joined = sized.join(targets, sized[source].eqNullSafe(targets[key]))
    taken = joined.withColumn(names["copies"], copies_of(rate, doc_id, seed))
    return taken.drop(key, rate), names


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixture: each row of ``docs`` as often as it is taken, its columns unchanged.

    Rows without words are taken by the rate of their source too; sources without words give nothing. An empty
    table gives an empty mixture.
    """
    plan, names = mix_plan(docs, doc_id, text, source, weights, most, seed)
    copy = free_name(docs, "copy")
    repeated = plan.where(F.col(names["copies"]) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int"))))
    return repeated.select(*docs.columns)
