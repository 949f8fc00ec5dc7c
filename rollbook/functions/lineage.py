"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written once to the session's checkpoint folder; only a session that names none gets its own."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", "") and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollbook-checkpoint-"))
    return df.checkpoint(eager=True)
