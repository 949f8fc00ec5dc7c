"""Incremental loads: new geocoding answers into a cache that keeps the last row per listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.geo import keep_last


def follow_answers(spark: SparkSession, incoming: str, schema: str, cache: str, checkpoint: str):
    """Reads what is new in ``incoming`` and appends it to ``cache`` with its batch, then stops.

    Appends carry (batch, ordinal), so a batch that runs again after a failure
    replaces its own partition and nothing else.
    """

    def append(rows: DataFrame, batch: int) -> None:
        out = rows.withColumn("batch", F.lit(batch)).withColumn("ordinal", F.lit(batch) * F.lit(1 << 40) + F.monotonically_increasing_id())
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(cache)

    stream = spark.readStream.schema(schema).option("header", True).csv(incoming)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, cache: str) -> DataFrame:
    """The last answer of each listing."""
    return keep_last(spark.read.parquet(cache), "listing_id", "ordinal").drop("ordinal", "batch")
