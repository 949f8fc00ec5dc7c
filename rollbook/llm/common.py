"""Shared pieces: byte blocks out of Arrow, vectorised hashes, lineage cuts.

All hashes are 64 bit, are computed from bytes alone and so agree between
executors and reruns.  Blocks bound the memory of the numpy passes.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

BLOCK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the checkpoint folder, which every executor shares.

    The folder named in ``spark.checkpoint.dir`` is used as it is; only a
    session that names none (tests) gets a folder of its own.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", "") and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollbook-checkpoint-"))
    return df.checkpoint(eager=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_and_drop(df: DataFrame) -> DataFrame:
    """``cut``, with the shuffles behind it taken off the disk at once.

    Else they stay until the driver happens to collect garbage.  The plan is
    made anew, so that no other one can read them.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return cut(df.select("*"))
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function that gives a task's memory back, as Python workers outlive their tasks."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    """Returns free memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


_ZSTD = pa.Codec("zstd", 1)


def short(raw: bytes) -> bytes:
    """Compressed, with the length in front."""
    return len(raw).to_bytes(4, "little") + (_ZSTD.compress(raw, asbytes=True) if raw else b"")


def unshort(packed) -> bytes:
    """The bytes that ``short`` was given."""
    n = int.from_bytes(memoryview(packed)[:4], "little")
    return _ZSTD.decompress(memoryview(packed)[4:], n, asbytes=True) if n else b""


def packed(rows: DataFrame) -> DataFrame:
    """``text`` compressed as ``packed``, beside the other columns; a null text stays null.  Makes shuffles smaller."""
    others = [c for c in rows.columns if c != "text"]

    @tidy
    def pack(batches):
        for batch in batches:
            texts = pa.array([short(x.as_buffer().to_pybytes()) if x.is_valid else None for x in batch.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([texts, *batch.columns[1:]], ["packed", *others])

    chosen = rows.select("text", *others)
    return chosen.mapInArrow(pack, StructType([StructField("packed", BinaryType()), *chosen.schema.fields[1:]]))


def unpacked(rows: DataFrame) -> DataFrame:
    """The inverse of ``packed``."""
    others = [c for c in rows.columns if c != "packed"]

    @tidy
    def unpack(batches):
        for batch in batches:
            texts = pa.array([unshort(x.as_buffer()).decode() if x.is_valid else None for x in batch.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([texts, *batch.columns[1:]], ["text", *others])

    chosen = rows.select("packed", *others)
    return chosen.mapInArrow(unpack, StructType([StructField("text", StringType()), *chosen.schema.fields[1:]]))


def beside(docs: DataFrame, rows: DataFrame, how: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents (doc_id, key, the columns ``keep``, text compressed as packed) joined with rows by number and key.

    Null numbers are equal.
    """
    rows = rows.withColumnsRenamed({"doc_id": "its_id", "key": "its_key"})
    return packed(docs.select("text", "doc_id", "key", *keep)).join(rows, F.col("doc_id").eqNullSafe(F.col("its_id")) & F.col("key").eqNullSafe(F.col("its_key")), how)


def text_key() -> Column:
    """128 bits of a text, null as its own value, from two seeded hashes."""
    whole = lambda x: F.lpad(F.hex(x), 16, "0")
    return F.unhex(F.concat(whole(F.xxhash64(F.col("text"))), whole(F.xxhash64(F.lit(7), F.col("text")))))


def string_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets); a null is an empty text.

    A block holds whole texts of ``limit`` bytes in all, or one longer text.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads all 64 bits."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) <= n:
        size = max(BLOCK_BYTES + 1, n + 1)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for name, base in (("up", _MULTIPLIER), ("down", inverse)):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            _POWERS[name] = np.multiply.accumulate(powers)
    return _POWERS["up"], _POWERS["down"]


class Hasher:
    """Hashes of any byte ranges of one buffer after one linear pass."""

    _table = mix(np.arange(1, 257, dtype=np.uint64))

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data))
        self._prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self._table[data] * up[: len(data)], out=self._prefix[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._prefix[ends] - self._prefix[starts]) * self._down[starts]
        return mix(value + np.asarray(ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of ``[^\\x20\\x09-\\x0D]``."""
    word = ~_SPACE[data]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[:1] = False
    before[edges] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[:-1] = word[1:]
    after[-1:] = False
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def counted(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text fulfil a mask."""
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
