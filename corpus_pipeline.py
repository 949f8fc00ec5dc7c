"""Corpus pipeline: language, lines, near duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import bpe, language, lines, mixing, neardup
from rollbook.llm.common import cut, packed, text_key, unpacked
from rollbook.llm.queries import vocabulary_path

#: A document goes if its text has no letters or no language reaches this share.
MIN_LANGUAGE_SCORE = 0.4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has a language; one without letters (null, empty) goes, other columns and repeated rows stay as they are."""
    model = language.learn(docs, F.coalesce(language.remainder() != 0, F.lit(False)))
    inner = docs.select("doc_id", "text", F.struct(*docs.columns).alias("held"))
    out = language.identify(inner, model, ("held",))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("held.*")


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out later copies of lines; a document of which no word is left goes, one that had none before stays.

    ``n_chars`` follows the text.  Repeated rows keep the same lines.
    """
    out = lines.dedup_lines(docs)
    worded = F.col("left").rlike(r"[^\x20\x09-\x0D]")
    columns = [F.col("left").alias("text") if c == "text" else F.length("left").cast("long").alias(c) if c == "n_chars" else F.col(f"held.{c}").alias(c) for c in docs.columns]
    return out.where(worded | (F.col("n_removed") == 0)).select(*columns)


def near_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the least number, null last; of rows with equal number and text, the least by the other columns.

    Texts without words are classes of their own.
    """
    row_key = lambda t: F.concat(F.hex(F.coalesce(t, F.lit(b""))), F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    kept = neardup.near_duplicates(docs).where("kept").select(row_key(F.col("t")).alias("key")).distinct()
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("held")
    rows = packed(docs.select(F.col("text").cast("string").alias("text"), others, row_key(text_key()).alias("key"))).join(kept, "key", "left_semi")
    # The join has brought the rows of a key together already.
    one = rows.groupBy("key").agg(F.min(F.struct("held", "packed")).alias("row"))
    return unpacked(one.select("row.packed", "row.held")).select(*[F.col("text") if c == "text" else F.col(f"held.{c}").alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its taken words by its size, rounded; one without words not at all."""
    keyed = docs.select(F.struct(*docs.columns).alias("held"), "doc_id", F.xxhash64("doc_id", "text", "source").alias("__k"), "text", "source")
    taken = mixing.mix_sources(keyed, key=("__k",)).groupBy(F.col("doc_id").alias("its_id"), F.col("__k").alias("its_k"))
    taken = taken.agg(F.round(F.avg(F.try_divide("taken", "size"))).cast("int").alias("times")).where("times > 0")
    out = keyed.join(taken, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("__k") == F.col("its_k")))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("held.*")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of identifiers and decoded text."""
    return bpe.digests(docs, vocabulary_path())


STAGES = [
    ("language_id", identified),
    ("line_dedup", line_deduped),
    ("near_dedup", near_deduped),
    ("source_mix", mixed),
    ("bpe", tokenized),
]

#: Language identification and weighted sampling have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; only the last stage's table stays there."""
    cut(spark.range(1))  # so that a session without a checkpoint folder gets one
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    folder = f"{folder.rstrip(os.sep)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            _remove(spark, before)
        before = f"{folder}/{name}"
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of any store that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
