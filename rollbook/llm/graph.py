"""Connected components by alternating large and small stars, and tiles of keys whose nodes are in several components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of the undirected links (a, b); root is the least node.

    Each round ties every node's larger neighbours to its least one, then its
    smaller ones; rounds end when nothing changes.  A hub is a skewed join
    key, never one task's group: its neighbours are only aggregated and
    joined.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = cut(edges)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = cut(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        if (new := _state(edges)) == state:
            break
        state = new
    tied = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tied.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def tiles(rows: DataFrame, bucket: int) -> DataFrame:
    """Rows of keys with several components, dealt to tiles in which every pair of components meets once.

    ``rows`` has key, node, root and units (its share of ``bucket``).  Adds
    ``tile``, ``own`` (the row's part) and ``diagonal``: in a tile off the
    diagonal, only rows of different parts need be compared.  A key of up to
    ``bucket`` units is one tile.  In a larger
    one the nodes outside of its largest component meet each other and that
    component, whose own nodes don't meet; so a hot key that is one class but
    for a few nodes costs its rows times the parts of those few.
    """
    rows = cut(rows)
    by_root = rows.groupBy("key", "root").agg(F.sum("units").alias("n"))
    keys = by_root.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    keys = keys.select("key", "n", F.col("most.n").alias("n_most"), F.col("most.root").alias("major"))
    met = rows.join(keys, "key")
    parts = lambda n: F.ceil(n / bucket).cast("long")
    out, inside = parts(F.col("n") - F.col("n_most")), parts(F.col("n_most"))
    small, major = F.col("n") <= bucket, F.col("root") == F.col("major")
    part = F.pmod(F.xxhash64(F.lit(5), "node"), F.when(major, inside).otherwise(out))
    # Parts of the largest component count down from -1.
    own = F.when(small, F.lit(0).cast("long")).when(major, -1 - part).otherwise(part)
    others = F.when(small, F.array(F.lit(0).cast("long"))).when(major, F.sequence(F.lit(0).cast("long"), out - 1)).otherwise(F.sequence(-inside, out - 1))
    met = met.withColumn("own", own).withColumn("other", F.explode(others))
    tile = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return met.withColumn("tile", tile).withColumn("diagonal", F.col("own") == F.col("other")).drop("other", "n", "n_most", "major")
