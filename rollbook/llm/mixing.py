"""Mixing sources to target weights with a low-discrepancy schedule.

A source's documents, in an order shuffled by hash, are laid on one line of
words that is cut into blocks of equal size.  Points of a golden-ratio
sequence, mapped through the sources' cumulative shares, deal slots to
sources; the r-th slot of a source takes its r-th block and starts over after
the last, for two passes at most.  A document counts the words of each block
it lies in as often as the block is taken.

Nothing is ranked or summed over a whole source in one task: ranks and word
offsets are sums of slices plus a rank within a slice.

Defined cases: a null or letterless text has the size of its words (0 without
any) and takes 0; null sources are one source, last; ties in the shuffle are
broken by size, so rows that tie are equal; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_WORDS = 128
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
#: u(n) = n * a mod m / m with a / m next to 1 / golden ratio.
_M, _A = 1 << 31, 1327217885
_SLICES, _BINS, _CHUNK = 4096, 4096, 1 << 14


def n_words(text: Column) -> Column:
    """Number of maximal runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row per source: rank, source, source_size, target.

    Sharing the excess of full sources by weight until none is above equals
    one level: in the order of cap by weight, a source is full if the level
    that what is left would reach lies at or above its cap.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("rank", F.row_number().over(everything))
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1))
    by = by.withColumn("cap", F.col("source_size") * float(passes))
    filled = Window.partitionBy().orderBy(F.col("cap") / F.col("weight"), "rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    by = by.withColumn("level", left / weight).withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(whole)["level"]
    return by.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight"))).select("rank", "source", "source_size", "weight", "target")


def schedule(goals: DataFrame, slots: int, block: int, passes: int = PASSES) -> DataFrame:
    """(slot, rank, block, pass) in mixing order.

    ``goals`` has (rank, source_size, target).  A slot's point meets its
    source through an equi-join on one of 4096 bins of the unit interval.
    """
    spark = goals.sparkSession
    order = Window.partitionBy().orderBy("rank")
    shares = goals.withColumn("upto", F.sum("target").over(order)).withColumn("total", F.sum("target").over(Window.partitionBy()))
    shares = shares.where("target > 0").select("rank", F.ceil(F.col("source_size") / block).alias("blocks"), ((F.col("upto") - F.col("target")) / F.col("total")).alias("low"), (F.col("upto") / F.col("total")).alias("high"))
    bins = F.sequence(F.floor(F.col("low") * _BINS), F.least(F.floor(F.col("high") * _BINS), F.lit(_BINS - 1)))
    shares = shares.withColumn("last", F.col("rank") == F.max("rank").over(Window.partitionBy())).withColumn("bin", F.explode(bins))
    points = spark.range(slots).select(F.col("id").alias("slot"), ((((F.col("id") + 1) % _M) * _A) % _M / float(_M)).alias("u"))
    points = points.withColumn("bin", F.floor(F.col("u") * _BINS))
    dealt = points.join(shares, "bin").where((F.col("u") >= F.col("low")) & ((F.col("u") < F.col("high")) | F.col("last")))
    dealt = dealt.select("slot", "rank", "blocks", F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    counts = dealt.groupBy("rank", "chunk").agg(F.count("*").alias("n"))
    start = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("rank", "chunk", F.coalesce(F.sum("n").over(start), F.lit(0)).alias("start"))
    within = Window.partitionBy("rank", "chunk").orderBy("slot")
    ranked = dealt.withColumn("r", F.row_number().over(within) - 1).join(counts, ["rank", "chunk"]).withColumn("r", F.col("r") + F.col("start"))
    ranked = ranked.select("slot", "rank", (F.col("r") % F.col("blocks")).alias("block"), F.floor(F.col("r") / F.col("blocks")).alias("pass"))
    return ranked.where(F.col("pass") < passes)


def laid_out(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Each document with its source's rank and the offset of its first word on the source's line."""
    placed = sized.join(goals.select("source", "rank", "source_size", "target").withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its"))).drop("its")
    placed = placed.withColumn("at", F.xxhash64(F.lit(11), "doc_id")).withColumn("slice", F.pmod("at", F.lit(_SLICES)))
    sums = placed.groupBy("rank", "slice").agg(F.sum("size").alias("n"))
    start = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "slice", F.coalesce(F.sum("n").over(start), F.lit(0)).alias("start"))
    within = Window.partitionBy("rank", "slice").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["rank", "slice"])
    return placed.withColumn("offset", F.col("offset") + F.col("start")).drop("start", "slice", "at")


def mix_sources(docs: DataFrame, block: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, key: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``key`` columns, size, source_size, target, taken of every document."""
    sized = cut(docs.select("doc_id", *key, F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size")))
    goals = cut(targets(sized, weights, share))
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    slots = -(-int(share * total) // block)
    plan = schedule(goals, slots, block).groupBy("rank", "block").agg(F.count("*").alias("times"))
    placed = laid_out(sized, goals)
    blocks = F.sequence(F.floor(F.col("offset") / block), F.floor(F.greatest(F.col("offset"), F.col("offset") + F.col("size") - 1) / block))
    parts = placed.withColumn("block", F.explode(blocks))
    inside = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("offset"), F.col("block") * block)
    parts = parts.withColumn("inside", inside).join(plan, ["rank", "block"], "left")
    return _summed(parts, key)


def _summed(parts: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Documents of size 0 share offsets, so equal rows are told apart by counting their parts."""
    grouped = parts.groupBy("rank", "offset", "doc_id", *key, "size", "source_size", "target").agg(
        F.sum(F.col("inside") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"), F.when(F.col("size") == 0, F.count("*")).otherwise(F.lit(1)).cast("int").alias("copies")
    )
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", *key, "size", "source_size", "target", "taken")
