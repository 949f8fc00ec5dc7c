"""Line dedup within an edit bound of one character, by deletion neighbourhoods.

A line goes if an equal line or one within the bound stands earlier, by
document number (null last), text and line number.  Equal lines meet by a
128-bit hash.  For the others, all variants that a single deletion gives are
hashed keys: two lines that differ by a substitution share the variant
together with the deleted position, and a line with an extra character has
the other among its variants.  So the least position per key is the earlier
partner and no pairs are made.  Levenshtein distance verifies every partner.

Only lines that can have a partner make variants: within one edit, lines of n
and n or n + 1 characters agree on the first n // 2 characters or on the last
n - n // 2, so a line whose halves no other line of such a length shares has
none.  This drops no partner.

Defined cases: the one-edit match is for lines of at least ``min_chars`` code
points, as short lines make false partners; of shorter lines that have a word
only equal later copies go, and only if ``short`` is set; lines without a word
that are under ``min_chars`` always stay; a null text has no lines and stays null; repeated rows (number
and text equal) are one document and keep the same lines; ties cannot occur,
as positions differ; columns beside ``doc_id`` and ``text`` pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .common import _powers, beside, cut_and_drop, mix, string_blocks, tidy, unshort

MIN_CHARS = 24
WORD = r"[^\x20\x09-\x0D]"


def _position_fields() -> list[Column]:
    return [F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("key"), F.col("no")]


def _position() -> Column:
    return F.struct(*_position_fields())


def _half_keys() -> Column:
    """Keys of the halves by which lines of n and n + 1 characters can meet, for n = length and length - 1."""
    keys = []
    for shorter in (F.col("size"), F.col("size") - 1):
        half = F.floor(shorter / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), shorter, F.substring("line", F.lit(1), half)))
        rest = (shorter - half).cast("int")
        keys.append(F.xxhash64(F.lit("last"), shorter, F.substring("line", F.col("size") - rest + 1, rest)))
    return F.array(*keys)


@tidy
def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys (rank, variant, cut, spot) of lines: each without one character, with and without its place, and the whole.

    Prefix sums give all hashes of a block in one pass.  Deletions within a run
    of one character are equal, so the run's first stands for them.
    """
    for batch in batches:
        for i, j in _line_blocks(batch.column(1)):
            chars = np.frombuffer("".join(batch.column(1).slice(i, j - i).to_pylist()).encode("utf-32-le"), np.uint32)
            sizes = pc.utf8_length(batch.column(1).slice(i, j - i)).to_numpy(zero_copy_only=False).astype(np.int64)
            up, down = _powers(len(chars) + 1)
            prefix = np.zeros(len(chars) + 1, np.uint64)
            np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * up[: len(chars)], out=prefix[1:])
            ends = np.cumsum(sizes)
            line = np.repeat(np.arange(len(sizes)), sizes)
            start, end, spot = (ends - sizes)[line], ends[line], np.arange(len(chars))
            without = (prefix[spot] - prefix[start]) + (prefix[end] - prefix[spot + 1]) * down[1]
            without = _sized(without * down[start], sizes[line] - 1)
            placed = mix(without ^ mix((spot - start + 1).astype(np.uint64)))
            whole = _sized((prefix[ends] - prefix[ends - sizes]) * down[ends - sizes], sizes)
            runs = np.append(True, chars[1:] != chars[:-1]) | (spot == start)
            rank = batch.column(0).slice(i, j - i).to_numpy()
            parts = ((line, placed, True, True), (line[runs], without[runs], True, False), (np.arange(len(sizes)), whole, False, False))
            for own, keys, cut_, spot_ in parts:
                flags = [pa.array(np.full(len(own), x)) for x in (cut_, spot_)]
                yield pa.RecordBatch.from_arrays([pa.array(rank[own]), pa.array(keys.view(np.int64)), *flags], ["rank", "variant", "cut", "spot"])


def _sized(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(value + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _line_blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of blocks of whole lines."""
    for first, end, _, _ in string_blocks(column):
        yield first, end


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """(doc_id, key, gone): the numbers, from 0, of each document's lines that go.

    ``docs`` has doc_id, key and text.  With ``short``, later copies of shorter lines that have a word go too.
    """
    lines = docs.select("doc_id", "key", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    long = F.col("size") >= min_chars
    lines = lines.withColumn("size", F.length("line")).where(long | F.col("line").rlike(WORD) if short else long)
    hashed = lines.select("doc_id", "key", "no", "size", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(3), "line").alias("h2"), F.when(long, _half_keys()).alias("halves"))
    keyed = hashed.select("*", *[F.col("halves")[i].alias(f"half{i}") for i in range(4)]).drop("halves")
    # The branches that look for candidates read this with the same columns, so that they share one exchange.
    least = F.min(F.struct(*_position_fields(), *[F.col(f"half{i}") for i in range(4)]))
    distinct = keyed.groupBy("h1", "h2").agg(least.alias("least"))
    first = F.struct(*[F.col(f"least.{c}").alias(c) for c in ("no_id", "doc_id", "key", "no")]).alias("first")

    # By the first hash alone: an accident there only adds a candidate.
    halves = distinct.where("least.half0 is not null").select("h1", F.explode(F.array(*[F.col(f"least.half{i}") for i in range(4)])).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("with")).where("with > 1").select("half")
    candidates = halves.join(shared, "half", "left_semi").select("h1").distinct()
    first_rows = distinct.select("h1", "h2", first).join(candidates, "h1", "left_semi")
    wanted = first_rows.groupBy("first.doc_id", "first.key").agg(F.collect_list(F.struct("h1", "h2", "first")).alias("wanted"))

    @tidy
    def fetch(batches):
        for batch in batches:
            rows, lines_ = [], []
            for packed, wanted_ in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = unshort(packed.as_buffer()).decode().split("\n")
                rows += wanted_
                lines_ += [own[w["first"]["no"]] for w in wanted_]
            found = pa.array(rows, batch.schema.field(1).type.value_type)
            yield pa.RecordBatch.from_arrays([*found.flatten(), pa.array(lines_, pa.string())], ["h1", "h2", "first", "line"])

    schema = StructType([*first_rows.schema.fields, StructField("line", StringType())])
    texts = beside(docs, wanted, "inner").select("packed", "wanted").mapInArrow(fetch, schema)
    # Equal rows of the input bring a line twice.
    texts = texts.groupBy("h1", "h2", "first").agg(F.max("line").alias("line"))
    # A number that follows the position stands for the line among the variants, which are many; the cut fixes it.
    # The whole texts and the half-line keys were shuffled for it, as much as is shuffled from here on.
    texts = cut_and_drop(texts.orderBy("first").select("h1", "h2", "line", F.monotonically_increasing_id().alias("rank")))

    rows = texts.select("rank", "line").mapInArrow(_variants, "rank long, variant long, cut boolean, spot boolean")
    # Members of a key differ in one character, so the alphabet and the line's length bound a window.
    key = Window.partitionBy("variant")
    rows = rows.withColumn("whole", F.min(F.when(~F.col("cut"), F.col("rank"))).over(key)).withColumn("cuts", F.min(F.when(F.col("cut"), F.col("rank"))).over(key))
    partner = F.when(F.col("cut") & ~F.col("spot"), F.col("whole")).otherwise(F.col("cuts"))
    pairs = rows.select("rank", partner.alias("partner")).where("partner < rank").distinct()
    pairs = pairs.join(texts.select("rank", "h1", "h2", "line"), "rank").join(texts.select(F.col("rank").alias("partner"), F.col("line").alias("other")), "partner")
    near = pairs.where(F.levenshtein("line", "other") <= 1).select("h1", "h2").distinct().withColumn("near", F.lit(True))

    # Half-line keys are no longer needed, so they are not shuffled again.
    counted = keyed.groupBy("h1", "h2").agg(F.min(_position()).alias("first"), F.count("*").alias("n"))
    known = counted.join(near, ["h1", "h2"], "left").where("n > 1 or near")
    gone = keyed.select("h1", "h2", "doc_id", "key", "no").join(known, ["h1", "h2"]).where(F.coalesce("near", F.lit(False)) | (_position() != F.col("first")))
    return gone.groupBy("doc_id", "key").agg(F.collect_set("no").alias("gone"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """n_lines, n_removed, left (the text without the lines that go) and held: the other columns, as one struct.

    The struct keeps columns whose names clash with the operator's own.
    """
    others = [F.col(c) for c in docs.columns if c != "text"]
    held = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.struct(*others).alias("held"))
    held = held.withColumn("key", F.xxhash64("text"))
    gone = removed_lines(held.select("doc_id", "key", "text"), min_chars, short)

    @tidy
    def cleared(batches):
        for batch in batches:
            counts, removed, left = [], [], []
            for packed, gone_ in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = unshort(packed.as_buffer()).decode() if packed.is_valid else None
                drop = set(gone_ or ())
                counts.append(0 if text is None else text.count("\n") + 1)
                removed.append(len(drop))
                left.append(text if not drop else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(counts, pa.int32()), pa.array(removed, pa.int32()), pa.array(left, pa.string())], ["held", "n_lines", "n_removed", "left"])

    joined = beside(held, gone, "left", ("held",)).select("packed", "gone", "held")
    schema = StructType([joined.schema["held"], *(StructField(n, IntegerType()) for n in ("n_lines", "n_removed")), StructField("left", StringType())])
    return joined.mapInArrow(cleared, schema)
