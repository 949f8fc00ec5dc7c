"""One thin query per operator, each over its whole table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, images, language, lines, mixing, neardup, quality, substrings, tools, urls

#: The vocabulary that op10 is defined on; a path of the installed package, never copied.
VOCABULARY = "word_bpe_49k.json"

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

SCHEMAS = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["query", "turn"], "additionalProperties": False},
    "continue": {"type": "object", "properties": {"query": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "string"}}, "required": ["query", "turn", "after"], "additionalProperties": False},
}


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def thumbnails(vectors: DataFrame, size: int = 96) -> DataFrame:
    """(id, image): each vector as a PGM picture, a sum of plane waves with one number as the height of each.

    The tables hold no pictures; vectors that are next to each other give
    pictures that are edits of each other.  Every place of a picture depends
    on all numbers.
    """

    def draw(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                side = int(len(v or ()) ** 0.5)
                if not side or any(x is None for x in v):
                    out.append(None)
                    continue
                waves = np.cos(np.pi / size * (np.arange(size)[:, None] + 0.5) * (2 * np.arange(side) + 6))
                levels = waves @ np.reshape(v[: side * side], (side, side)) @ waves.T
                levels = 127.5 + 127.5 * levels / max(np.abs(levels).max(), 1e-9)
                out.append(f"P5 {size} {size} 255\n".encode() + np.rint(levels).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "image"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(draw, "id long, image binary")


def op2_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.find_copies(thumbnails(_read(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_read(spark, sf_dir, "documents"), short=True)
    return out.select("held.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("left", F.lit("")), 256).alias("kept_sha256"))


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An assistant's turn as the result of the turn before, any other turn as a call that refers to the call two turns before.

    The table holds no calls.
    """
    number = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    rows = conversations.select("conv_id", "turn", "text", (F.coalesce("role", F.lit("")) == "assistant").alias("answer"))
    asked = rows.where(~F.col("answer"))
    later = F.col("turn") >= 2
    arguments = F.to_json(F.struct(F.col("text").alias("query"), "turn", F.when(later, number(F.col("turn") - 2)).alias("after")))
    refers = F.when(later, F.array(number(F.col("turn") - 2))).otherwise(F.expr("cast(array() as array<string>)"))
    calls = asked.select("conv_id", "turn", number(F.col("turn")).alias("call_id"), F.when(later, "continue").otherwise("search").alias("name"), arguments.alias("arguments"), refers.alias("refers"))
    results = rows.where("answer").select("conv_id", "turn", number(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op4_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_and_results(_read(spark, sf_dir, "conversations"))
    out = tools.link_calls(calls, results, SCHEMAS)
    return out.select("conv_id", "call_id", "turn", "name", "status", "level", "n_rows", "n_missing", "result_turn", F.sha2("json", 256).alias("json_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.length("kept").cast("long").alias("n_kept"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_verified", "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.filter_urls(_read(spark, sf_dir, "pages"), rules)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(_read(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), vocabulary_path())


OP7_SQL = """
WITH rules(rule_host, rule_path, ruled) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS r
  FROM pages),
parts AS (
  SELECT page_id, n,
         translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(ruled, length(rule_host || rule_path)) AS ruled
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(ruled, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_image_copies, op3_line_dedup, op4_tool_links, op5_suffix_dedup,
        op6_near_dedup, op7_url_filter, op8_language_id, op9_source_mix, op10_bpe,
    )
}
ORACLES = {"op7_url_filter": OP7_SQL}
