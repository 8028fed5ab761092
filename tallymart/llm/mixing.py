"""Mixing sources to target weights, with DataFrame functions only.

Sizes (words) are summed for each source, the targets follow by water filling, and a source's
repetition rate is target / size. A document is emitted floor(rate) times, plus once more if a
number in [0, 1) hashed from seed and identifier lies under the fraction.

Defined cases: a null text has size 0; null is a source of its own and comes last; a source of
size 0 has target 0 and rate 0; repeated rows with one identifier get the same copies; an empty table
gives an empty result. Extra columns pass through `mixed` and are ignored by `mix_plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymart.llm.common import WORD, written

#: Sources that may be broadcast: a row is a name and three numbers. Beyond it the join shuffles.
BROADCAST_SOURCES = 10_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, key: Column) -> Column:
    """A number in [0, 1) from the first 8 hex digits of md5(seed:key)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Of (source, source_size): target and rate.

    `share` times all sizes is dealt out by weight (weights repeat over the sources by code point,
    null last); a target ends at `most` times its source's size and what is over is dealt out again
    among the others. That fixed point is found at once: in order of size / weight, the sources up to
    some place are at their limit and the rest share what is left by weight.

    The sources, a name and a few numbers each, are ordered in one task, which holds for tens of millions of
    them (a running sum over sorted rows, which spill); documents take no part in it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sizes.withColumn("weight", weight)
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before, onward = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward)
    ranked = w.select("source", "source_size", "weight", level.alias("level"), F.row_number().over(up).alias("place"))
    fits = F.col("level") * F.col("weight") <= F.lit(most) * F.col("source_size")
    first = F.min(F.when(fits, F.struct("place", "level"))).over(whole)
    held = ranked.withColumn("first", first)
    target = F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.lit(most) * F.col("source_size")).otherwise(F.col("first.level") * F.col("weight"))
    out = held.select("source", "source_size", target.cast("double").alias("target"))
    return out.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def with_rates(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, source: str = "source") -> DataFrame:
    """sized (has `size` and `source`) with source_size, target and rate."""
    sizes = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").cast("long").alias("source_size"))
    plan = written(targets(sizes, weights, share, most), "mix-targets").select(F.col("source").alias("_source"), "source_size", "target", "rate")
    side = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    return sized.join(side, F.col(source).eqNullSafe(F.col("_source"))).drop("_source")


def copies(seed: str, key: Column) -> Column:
    """floor(rate) + Bernoulli(rate - floor(rate))."""
    return (F.floor("rate") + (draw(seed, key) < F.col("rate") - F.floor("rate")).cast("long")).cast("int")


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken. Texts are read once; what is kept of them is a number."""
    sized = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    rated = with_rates(sized, weights, share, most)
    return rated.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(seed, F.col("doc_id"))).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The documents, all columns, each as often as the mix takes it. No row of text is shuffled."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("source").alias("_src"), n_words(F.col("text")).alias("size"))
    rated = with_rates(packed, weights, share, most, "_src")
    times = F.array_repeat(F.lit(1), copies(seed, F.col("_row.doc_id")))
    return rated.select("_row", F.explode(times).alias("_copy")).select("_row.*")
