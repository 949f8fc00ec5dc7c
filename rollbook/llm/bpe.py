"""BPE encoding and decoding through a table of distinct words.

Texts are split at white space, which the tokenizer never joins over, in
blocks of whole documents.  Each block's distinct words are dealt by hash to
buckets, where a word that many blocks hold is encoded once; identifiers
go back to their block and meet its documents by position.  Decoding joins
the identifiers to the vocabulary's table of pieces, by identifier; the table
is as long as the vocabulary, whatever the input, so each task holds it.

Words, positions, identifiers and pieces are arrays throughout, and what is
shuffled is packed and compressed: a row is a block's words of one bucket, or
a block's documents as word positions.  A task holds one block, or the
distinct words of one bucket; both follow the input's size, not the session's
partitions.  Blocks are cut from the input's partitions twice, so the input
should be a table or another plan that gives the same rows in the same order
each time; blocks carry a digest of their content as key, and one that
doesn't meet itself again fails the job.

Defined cases: a null or empty text has no identifiers and decodes to the
empty text; a very long text is a block of its own, read whole; bytes that are
no UTF-8 count as the replacement character; strings of special tokens in a
text become their identifiers, as in the library; repeated rows give equal
rows; an empty table gives an empty result; other columns of the input are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, give_back, mix, short, string_blocks, tidy, unshort, word_ranges

BLOCK_BYTES = 4 << 20
#: Bytes of text for each bucket of words, and for each partition in which blocks meet their identifiers.
BUCKET_BYTES = 16 << 20
#: Bytes that are hashed at a time, and words or identifiers that are written out at a time, to bound a task's memory.
HASHED_BYTES, CHUNK = 1 << 20, 1 << 17
_ENCODE_BATCH = 20_000
_LOADED: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The library's tokenizer of a vocabulary file, loaded once a process, and its decimal numbers and pieces by identifier."""
    if path not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        pieces = {i: p for p, i in loaded.get_vocab(with_added_tokens=True).items()}
        size = max(pieces, default=-1) + 1
        _LOADED[path] = loaded, Strings([f"{i} ".encode() for i in range(size)]), Strings([f"{pieces.get(i, '')} ".encode() for i in range(size)])
    return _LOADED[path]


class Strings:
    """Byte strings by number, each with its separator."""

    def __init__(self, values: list[bytes]):
        self._sizes = np.array([len(v) for v in values], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._data = np.frombuffer(b"".join(values), np.uint8)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of the numbers, one after the other, and where each begins, with the end."""
        sizes = self._sizes[numbers]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return self._data[_ranges(self._starts[numbers], sizes, edges)], edges


def _ranges(starts: np.ndarray, sizes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """All places of the ranges, in order."""
    small = max(int(edges[-1]), int(starts.max(initial=0))) < 2**31
    kind = np.int32 if small else np.int64
    out = np.repeat((starts - edges[:-1]).astype(kind), sizes)
    out += np.arange(edges[-1], dtype=kind)
    return out


class _Block:
    """A block of whole documents: its distinct words in order of bucket and hash, and the place of every word among them."""

    def __init__(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, buckets: int):
        self.ids, self._data = ids, data
        self.key = xxhash.xxh3_128_digest(data.tobytes() + offsets.tobytes() + repr(ids.to_pylist()).encode())
        starts, ends, text = word_ranges(data, offsets)
        self.sizes = np.bincount(text, minlength=len(ids)).astype(np.int32)
        hashes = self._hashes(starts, ends)
        own, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = self._distinct(starts, ends, first, at)
        self.bucket = ((mix(own) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(self.bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.places, self.bucket = place[at], self.bucket[order]
        self._starts, self._lengths = starts[order], (ends - starts)[order]

    def _hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The words' hashes, a megabyte at a time to save memory; a hash depends on a word's bytes alone."""
        cuts = np.searchsorted(starts, np.arange(0, max(len(self._data), 1), HASHED_BYTES))
        parts = [np.zeros(0, np.uint64)]
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)], strict=True):
            if a < b:
                base = starts[a]
                parts.append(Hasher(self._data[base : ends[b - 1]]).ranges(starts[a:b] - base, ends[a:b] - base))
        return np.concatenate(parts)

    def _distinct(self, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of each distinct word, after a look at the bytes of all others."""
        sizes = ends - starts
        if (sizes != sizes[first][at]).any():
            raise RuntimeError("two words have one hash")
        for a in range(0, len(starts), CHUNK):
            part = slice(a, a + CHUNK)
            edges = np.concatenate([[0], np.cumsum(sizes[part])])
            one, two = (_ranges(x, sizes[part], edges) for x in (starts[part], starts[first][at[part]]))
            if (self._data[one] != self._data[two]).any():
                raise RuntimeError("two words have one hash")
        return starts[first], ends[first]

    def words(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, packed words) of the buckets that the block has words for."""
        if not len(self.bucket):
            return
        edges = np.concatenate([[0], np.cumsum(self._lengths)])
        raw = self._data[_ranges(self._starts, self._lengths, edges)]
        cuts = np.flatnonzero(np.append(True, self.bucket[1:] != self.bucket[:-1]))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(self.bucket)], strict=True):
            yield int(self.bucket[a]), _packed(self._lengths[a:b], raw[edges[a] : edges[b]])


def _blocks(batches, buckets: int) -> Iterator[_Block]:
    for batch in batches:
        for first, end, data, offsets in string_blocks(batch.column(1), BLOCK_BYTES):
            yield _Block(batch.column(0).slice(first, end - first), data, offsets, buckets)


def _packed(sizes: np.ndarray, data: np.ndarray) -> bytes:
    """Sizes of parts, and the parts, compressed."""
    return short(len(sizes).to_bytes(4, "little") + _planes(sizes) + data.tobytes())


def _unpacked(blob: bytes) -> tuple[np.ndarray, memoryview]:
    raw = memoryview(unshort(blob))
    n = int.from_bytes(raw[:4], "little")
    return _unplaned(raw[4 : 4 + 4 * n]), raw[4 + 4 * n :]


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, which compresses better."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(raw) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def encode(docs: DataFrame, vocabulary: str, buckets: int | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every document."""
    return _through_words(docs, vocabulary, buckets, digests=False)


def digests(docs: DataFrame, vocabulary: str, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return _through_words(docs, vocabulary, buckets, digests=True)


def _through_words(docs: DataFrame, vocabulary: str, buckets: int | None, digests: bool) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts = max(8, -(-size // BUCKET_BYTES))
    buckets = buckets or parts

    @tidy
    def words(batches):
        """A row for each block and bucket with words."""
        for block in _blocks(batches, buckets):
            rows = list(block.words())
            yield pa.RecordBatch.from_arrays([pa.array([block.key] * len(rows), pa.binary()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "bucket", "words"])

    @tidy
    def encoded(batches):
        """Each word's identifiers; a word met before is looked up."""
        loaded = _tokenizer(vocabulary)[0]
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for key, bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes, raw = _unpacked(blob)
                raw, ends = raw.tobytes(), np.cumsum(sizes).tolist()
                own = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                new = [w for w in own if w not in known]
                for i in range(0, len(new), _ENCODE_BATCH):
                    part = new[i : i + _ENCODE_BATCH]
                    for w, e in zip(part, loaded.encode_batch_fast([w.decode(errors="replace") for w in part], add_special_tokens=False), strict=True):
                        known[w] = np.array(e.ids, "<i4").tobytes()
                found = [known[w] for w in own]
                counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
                ids = np.frombuffer(b"".join(found), "<i4")
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([bucket], pa.int32()), pa.array([_packed(counts, np.frombuffer(_planes(ids), np.uint8))])], ["block", "bucket", "words"])

    @tidy
    def placed(batches):
        """A row for each block: its documents as positions of words."""
        for block in _blocks(batches, buckets):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.key]), pa.array([block.ids.to_pylist()], pa.list_(pa.int64())), pa.array([block.sizes.tobytes()]), pa.array([short(_planes(block.places))]), pa.array([len(np.unique(block.bucket))], pa.int32())],
                ["block", "ids", "sizes", "places", "parts"],
            )

    def joined(documents: pa.Table, table: pa.Table) -> pa.Table:
        """The documents of one block; blocks that are equal in all rows come together."""
        blobs = dict(zip(table.column("bucket").to_pylist(), table.column("words").to_pylist(), strict=True))
        if not documents.num_rows or len(blobs) != documents.column("parts")[0].as_py():
            raise RuntimeError("a block of documents changed between two readings of the input; write the input as a table first")
        found = [_unpacked(blobs[b]) for b in sorted(blobs)]
        counts = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
        ids = np.concatenate([_unplaned(x[1]) for x in found]) if found else np.zeros(0, np.int64)
        starts = np.cumsum(counts) - counts
        places = _unplaned(unshort(documents.column("places")[0].as_py()))
        sizes = np.frombuffer(documents.column("sizes")[0].as_py(), np.int32)
        # A word of control characters that the tokenizer drops has no identifiers.
        own = counts[places]
        edges = np.concatenate([[0], np.cumsum(own)])
        last = np.concatenate([[0], np.cumsum(sizes)])
        cuts = edges[last]
        _, numbers, pieces = _tokenizer(vocabulary)
        columns: list[list] = [[] for _ in names]
        first = 0
        while first < len(sizes):
            # Whole documents of so many identifiers, or one longer document.
            end = max(first + 1, int(np.searchsorted(cuts, cuts[first] + CHUNK, side="right")) - 1)
            a, b = int(last[first]), int(last[end])
            tokens = ids[_ranges(starts[places[a:b]], own[a:b], edges[a : b + 1] - edges[a])]
            at = cuts[first : end + 1] - cuts[first]
            columns[0] += np.diff(at).tolist() if digests else np.split(tokens.astype(np.int32), at[1:-1])
            for column, strings in zip(columns[1:], (numbers, pieces) if digests else (pieces,), strict=True):
                text, places_ = strings.joined(tokens)
                places_, raw = places_[at].tolist(), memoryview(text)
                # Without the separator behind the last.
                parts_ = [raw[x : max(x, y - 1)] for x, y in zip(places_[:-1], places_[1:], strict=True)]
                column += [hashlib.sha256(x).hexdigest() if digests else x.tobytes().decode() for x in parts_]
            first = end
        kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
        columns = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
        out = pa.table([pa.array(documents.column("ids")[0].as_py(), pa.int64()), *columns], names=["doc_id", *names])
        give_back()
        return pa.concat_tables([out] * documents.num_rows)

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string"
    distinct = texts.mapInArrow(words, "block binary, bucket int, words binary")
    table = distinct.repartition(buckets, "bucket").mapInArrow(encoded, "block binary, bucket int, words binary").repartition(parts, "block")
    blocks = texts.mapInArrow(placed, "block binary, ids array<long>, sizes binary, places binary, parts int").repartition(parts, "block")
    return blocks.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(joined, schema)
