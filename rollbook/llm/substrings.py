"""Exact substring dedup by longest-previous-factor arrays, over whole corpora.

A string of ``length`` bytes counts as repeated if it also starts anywhere
else.  Texts are cut at content: of the 64-byte strings in each window of
``length`` bytes the one of least hash is the window's anchor (the last of
equals), so equal windows have equal anchors at equal places, and only texts
around equal anchors need be compared.  An anchor owns a run of windows; the
bytes of the run are its segment.

* Segments of equal bytes (128-bit hash) repeat as wholes.
* Other segments under one anchor form a block.  Windows that no other segment
  of the block can hold are left out first, without loss, by the bytes that
  some neighbouring windows share.  The suffixes are sorted, and in suffix order the previous and next smaller place give each place's
  longest previous factor (the previous and next larger one its longest next
  factor); places whose factor reaches ``length`` are repeated.
* A block beyond ``BLOCK_SEGMENTS`` different segments (a passage in very many
  contexts) is not gathered: its runs of windows are halved, and halves meet
  by the bytes that all their windows share, again and again, until blocks
  are small or windows are single, whose bytes then are their keys.

Documents are never paired.  Defined cases: null is the empty text; texts
under ``length`` bytes repeat nothing; rows of equal number and text are two
texts, so each repeats the other; runs of one character anchor every byte;
texts of any length are read whole, anchored in parts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, beside, cut, give_back, short, string_blocks, tidy, unshort

LENGTH = 400
GRAM = 64
BLOCK_SEGMENTS = 512
#: So many neighbouring windows are left out or kept together before suffixes are sorted.
WIDTH = 32
_PLACE = 26
_BITS = 12
#: Windows of a text that are anchored at a time.
PART = 1 << 25

def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window, by prefix and suffix minima of blocks."""
    n = len(values)
    pad = -n % width
    full = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, last window, hash) of the anchors of one block, places within the block.

    Longer blocks (one text) go in parts of ``PART`` windows, as places within a part must fit ``_PLACE`` bits.
    """
    if length >= 1 << _BITS:
        raise ValueError(f"length must be under {1 << _BITS}")
    parts = []
    for at in range(0, max(len(data) - length + 1, 0), PART):
        end = min(at + PART + length - 1, len(data))
        text, place, first, last, value = _anchors(data[at:end], np.clip(offsets - at, 0, end - at), length, gram)
        parts.append((text, place + at, first + at, last + at, value))
    if not parts:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    return parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts, strict=True)))


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    at = np.arange(len(data) - gram + 1)
    hashes = Hasher(data).ranges(at, at + gram)
    low = np.uint64((1 << _PLACE) - 1)
    # The last of equal hashes wins: places count down within the low bits.
    ordered = (hashes & ~low) | (low - at.astype(np.uint64))
    least = _window_min(ordered, length - gram + 1)
    starts = np.arange(len(least))
    place = (low - (least & low)).astype(np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    valid = starts + length <= offsets[np.minimum(text + 1, len(offsets) - 1)]
    starts, place, text = starts[valid], place[valid], text[valid]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    if not len(first):
        last = first
    return text[first], place[first], starts[first], starts[last], hashes[place[first]]


def _smaller_before(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it that holds a smaller value, -1 if there is none, by minima of doubling spans."""
    n = len(values)
    spans = [values]
    while (width := 1 << len(spans)) <= n:
        spans.append(np.minimum(spans[-1][: n - width + 1], spans[-1][width // 2 :]))
    # Spans that end before the place and hold nothing smaller are skipped, longest first.
    at = np.arange(n)
    for k in range(len(spans) - 1, -1, -1):
        begin = at - (1 << k)
        free = begin >= 0
        free[free] = spans[k][begin[free]] > values[free]
        at[free] = begin[free]
    return at - 1


def previous_factors(segments: list[bytes], length: int = LENGTH, halfway: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, next, edges): for each place of the joined segments the longest earlier and the longest later match, at most ``length``.

    With ``halfway`` only suffixes that share their first bytes with another,
    as far as the doubling's last step but one, are ordered; shorter factors
    are given as 0.  The longest match of such a suffix is such a suffix too.

    Ranks by prefix doubling sort the suffixes by their first ``length``
    bytes, equals by place.  In this order the previous and the next smaller
    place hold the longest earlier match, the previous and the next larger
    place the longest later one; common prefixes come from the ranks of the
    doubling.  No match crosses a segment's end.
    """
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    raw = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
    room = np.repeat(ends, sizes) - np.arange(total)
    # Seven bytes, with 0 for those beyond a segment's end, fit one number.
    done, rank = min(7, length), np.zeros(total, np.int64)
    for i in range(done):
        ahead = np.zeros(total, np.int64)
        ahead[: max(total - i, 0)] = raw[i:]
        ahead[room <= i] = 0
        rank = rank * 257 + ahead
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
    ranks = [(done, rank)]
    while done < length:
        step = min(done, length - done)
        ahead = np.zeros(total, np.int64)
        ahead[: max(total - step, 0)] = rank[step:]
        ahead[room <= step] = 0
        rank = np.unique(rank * (total + 257) + ahead, return_inverse=True)[1].astype(np.int64) + 1
        done += step
        ranks.append((done, rank))
    if halfway:
        width, half = ranks[max(len(ranks) - 2, 0)]
        kept = np.flatnonzero((np.bincount(half)[half] > 1) & (room >= width))
    else:
        kept = np.arange(total)
    order = kept[np.argsort(rank[kept], kind="stable")]

    def common(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes, at most ``length``; 0 where ``two`` is -1."""
        size, limit = np.zeros(len(one), np.int64), np.where(two < 0, 0, np.minimum(room[one], room[two]))
        for width, own in reversed(ranks):
            inside = np.flatnonzero((size + width <= limit) & (size + width <= length))
            same = inside[own[one[inside] + size[inside]] == own[two[inside] + size[inside]]]
            size[same] += width
        for _ in range(min(7, length)):
            inside = np.flatnonzero(size < np.minimum(limit, length))
            same = inside[raw[one[inside] + size[inside]] == raw[two[inside] + size[inside]]]
            if not len(same):
                break
            size[same] += 1
        return size

    out = []
    for values in (order, total - order):
        best = np.zeros(total, np.int64)
        for side in (slice(None), slice(None, None, -1)):
            own, found = order[side], _smaller_before(values[side])
            best[own] = np.maximum(best[own], common(own, np.where(found < 0, -1, own[found])))
        out.append(best)
    return out[0], out[1], np.concatenate([[0], ends])


def repeated_positions(segments: list[bytes], length: int = LENGTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each segment the starts that have an earlier match of ``length`` bytes, and those with a later one."""
    *factors, edges = previous_factors(segments, length, halfway=True)
    split = lambda x: [np.flatnonzero(x[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return split(factors[0] >= length), split(factors[1] >= length)


def shared_windows(blocks: list[int], places: list[int], segments: list[bytes], length: int = LENGTH, width: int = WIDTH) -> list[list[tuple[int, int]]]:
    """For each segment the runs (first, last) of windows that another segment of its block may hold as well; it holds no others.

    Equal windows have their anchor (at ``places`` of the segments) equally
    far behind their start.  Windows that have it a to a + width - 1 behind
    all contain the same ``length`` - width + 1 bytes, so they have equals only
    where these bytes are equal.
    """
    width = min(width, length)
    keys, runs = [], []
    for i, (block, place, raw) in enumerate(zip(blocks, places, segments, strict=True)):
        spare = len(raw) - length
        for a in range((place - spare) // width * width, place + 1, width):
            keys.append((block, a, xxhash.xxh3_128_digest(raw[place - a : place - a - width + 1 + length])))
            runs.append((i, max(place - a - width + 1, 0), min(place - a, spare)))
    counts = Counter(keys)
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for key, (i, first, last) in zip(reversed(keys), reversed(runs), strict=True):
        if counts[key] > 1:
            if out[i] and out[i][-1][1] == first - 1:
                first = out[i].pop()[0]
            out[i].append((first, last))
    return out


_SPANS = "doc_id long, key long, first long, last long"


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, first, last, earlier): windows first..last of a document are repeated.

    ``docs`` has doc_id, key and text.  ``earlier`` tells that each of the
    windows also stands earlier, by number, key and place, which is what
    keeping the first copy asks for; it is false where that isn't known for
    all of them.
    """

    @tidy
    def anchored(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for first, end, data, offsets in string_blocks(batch.column(2)):
                text, place, lo, hi, value = anchors(data, offsets, length, gram)
                if not len(text):
                    continue
                raw, base = memoryview(data), offsets[text]
                digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)), np.uint64, len(lo))
                rows = pa.array(first + text)
                # One number for first window, anchor and last window keeps the shuffled rows short.
                at = ((lo - base) << 2 * _BITS) | ((place - lo) << _BITS) | (hi - lo)
                yield pa.RecordBatch.from_arrays([ids.take(rows), keys.take(rows), pa.array(at), pa.array(value.view(np.int64)), pa.array(digest.view(np.int64))], ["doc_id", "key", "at", "anchor", "segment"])

    # Anchor and segment are independent hashes, 128 bits in all.
    found = cut(docs.select("doc_id", "key", "text").mapInArrow(anchored, "doc_id long, key long, at long, anchor long, segment long"))
    first = F.shiftright("at", 2 * _BITS)
    last = first + F.col("at").bitwiseAND((1 << _BITS) - 1)
    where = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "at")
    segments = found.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min(where).alias("least"))
    shared = segments.groupBy("anchor").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("total > 1")
    segments = cut(segments.join(shared, "anchor").select("anchor", "segment", "n", "m", "least"))
    whole = found.join(segments.where("n > 1").select("anchor", "segment", "least"), ["anchor", "segment"])
    whole = whole.select("doc_id", "key", first.alias("first"), last.alias("last"), (where != F.col("least")).alias("earlier"))

    # One segment of each class stands for it in its block; text is fetched for these alone.
    wanted = segments.where("m > 1").select("anchor", "m", "least.doc_id", "least.key", "least.at")
    place = first + F.shiftright("at", _BITS).bitwiseAND((1 << _BITS) - 1)
    grouped = wanted.groupBy("doc_id", "key").agg(F.collect_list(F.struct("anchor", "m", place.alias("place"), first.alias("first"), last.alias("last"))).alias("wanted"))

    @tidy
    def fetch(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        before = None
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "key", "anchor", "m", "place", "first", "last", "bytes")}
            for doc, key, text, rows in zip(*(batch.column(i) for i in range(4)), strict=True):
                doc, key = doc.as_py(), key.as_py()
                if (doc, key) == before:
                    continue  # a row of equal number and text, whose windows are repeated anyway
                before, raw = (doc, key), unshort(text.as_buffer())
                for r in rows.as_py():
                    for k, v in (("doc_id", doc), ("key", key), ("bytes", short(raw[r["first"] : r["last"] + length])), *r.items()):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(out, kinds, strict=True)], list(out))

    schema = "doc_id long, key long, anchor long, m long, place long, first long, last long, bytes binary"
    blocks = cut(beside(docs, grouped, "inner").select("doc_id", "key", "packed", "wanted").mapInArrow(fetch, schema))
    matched = [_solved(blocks.where(F.col("m") <= BLOCK_SEGMENTS).withColumnRenamed("anchor", "block"), length)]
    large = blocks.where(F.col("m") > BLOCK_SEGMENTS)
    if not large.isEmpty():
        matched += _halved(large, length)
    return whole.unionByName(_union(matched))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _solved(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the blocks of (block, doc_id, key, place, first, bytes).

    Blocks share a suffix order by the hundred: matches across blocks are
    matches as well, and one sort of many small blocks costs less than many.
    """
    together = -(-rows.count() // BLOCK_SEGMENTS)
    rows = rows.select(F.pmod(F.xxhash64("block"), F.lit(max(together, 1))).alias("group"), "block", "doc_id", "key", "place", "first", "bytes")

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("key", "ascending"), ("first", "ascending")])
        out: dict[str, list] = {"doc_id": [], "key": [], "first": [], "last": [], "earlier": []}
        docs, keys, begins, places, own_blocks = (table.column(x).to_pylist() for x in ("doc_id", "key", "first", "place", "block"))
        segments = [unshort(x) for x in table.column("bytes").to_pylist()]
        # A row that comes twice (equal number, text and place) must not match itself.
        same = [i for i in range(1, len(docs)) if (docs[i], keys[i], begins[i], segments[i]) == (docs[i - 1], keys[i - 1], begins[i - 1], segments[i - 1])]
        for i in reversed(same):
            for own in (docs, keys, begins, places, own_blocks, segments):
                del own[i]
        kept = shared_windows(own_blocks, [p - b for p, b in zip(places, begins, strict=True)], segments, length)
        parts = [(docs[i], keys[i], begins[i] + a, segments[i][a : b + length]) for i, runs in enumerate(kept) for a, b in runs]
        docs, keys, begins, segments = ([x[k] for x in parts] for k in range(4))
        for flag, starts in zip((True, False), repeated_positions(segments, length) if parts else ([], []), strict=True):
            for doc, key, begin, own in zip(docs, keys, begins, starts, strict=True):
                if len(own):
                    cuts = np.flatnonzero(np.diff(own) > 1)
                    for a, b in zip(own[np.append(0, cuts + 1)].tolist(), own[np.append(cuts, len(own) - 1)].tolist(), strict=True):
                        for k, v in zip(out, (doc, key, begin + a, begin + b, flag), strict=True):
                            out[k].append(v)
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)})

    return rows.groupBy("group").applyInArrow(solve, _SPANS + ", earlier boolean")


def _halved(rows: DataFrame, length: int) -> list[DataFrame]:
    """Repeated windows of blocks that are too large to gather."""
    found = []
    # A window is named by how far its anchor stands behind its start: 0 to length - GRAM.
    width = 1 << (length - 1).bit_length()
    level = rows.withColumn("low", F.lit(0)).withColumn("path", F.col("anchor"))
    while width > 1:
        width //= 2

        def halve(batches, width=width):
            for batch in batches:
                cols = {k: batch.column(k).to_pylist() for k in ("doc_id", "key", "anchor", "place", "first", "last", "bytes", "low", "path")}
                out: dict[str, list] = {k: [] for k in ("doc_id", "key", "anchor", "place", "first", "last", "bytes", "low", "path", "segment")}
                for doc, key, anchor, place, first, last, raw, low, path in zip(*cols.values(), strict=True):
                    raw = unshort(raw)
                    for a in (low, low + width):
                        # Windows whose anchor stands a .. a + width - 1 behind their start.
                        lo, hi = max(first, place - a - width + 1), min(last, place - a)
                        if lo > hi:
                            continue
                        part = raw[lo - first : hi - first + length]
                        inner_lo, inner_hi = place - a - first, place - a - width + 1 + length - first
                        shared = raw[max(inner_lo, 0) : max(inner_hi, 0)]
                        own = xxhash.xxh3_64_intdigest(shared + path.to_bytes(8, "little", signed=True) + a.to_bytes(4, "little"))
                        own -= (own >> 63) << 64
                        digest = xxhash.xxh3_128_digest(part + (place - lo).to_bytes(4, "little"))
                        for k, v in zip(out, (doc, key, anchor, place, lo, hi, short(part), a, own, digest), strict=True):
                            out[k].append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

        columns = ["doc_id", "key", "anchor", "place", "first", "last", "bytes", "low", "path"]
        halves = level.select(*columns).mapInArrow(halve, "doc_id long, key long, anchor long, place long, first long, last long, bytes binary, low int, path long, segment binary")
        halves = cut(halves)
        where = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "first", "last")
        classes = halves.groupBy("path", "segment").agg(F.count("*").alias("n"), F.min(where).alias("least"))
        sizes = classes.groupBy("path").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("total > 1")
        classes = cut(classes.join(sizes, "path"))
        both = halves.join(classes, ["path", "segment"])
        found.append(both.where("n > 1").select("doc_id", "key", "first", "last", (where != F.col("least")).alias("earlier")))
        stands = both.where((where == F.col("least")) & (F.col("m") > 1))
        found.append(_solved(stands.where(F.col("m") <= BLOCK_SEGMENTS).withColumn("block", F.col("path")), length))
        level = cut(stands.where(F.col("m") > BLOCK_SEGMENTS).select(*columns))
        if level.isEmpty():
            break
    return found


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept of every document.

    With ``keep_first`` the first copy of each string stays, by number, key
    of the text and place.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text")).select("doc_id", "key", "text")
    spans = repeated_spans(keyed, length, gram)
    if keep_first:
        spans = spans.where("earlier")
    spans = spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = beside(keyed, spans, "left").select("doc_id", "packed", "spans")

    @tidy
    def kept(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept")}
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = unshort(text.as_buffer())
                runs: list[list[int]] = []
                for s in sorted((x["first"], x["last"] + length) for x in spans.as_py() or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                edges = [0, *(x for r in runs for x in r), len(raw)]
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(b - a for a, b in runs))
                out["n_spans"].append(len(runs))
                out["kept"].append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))], ["doc_id", *out])

    return joined.mapInArrow(kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def sha256(data: bytes) -> str:
    """Lowercase hex digest."""
    return hashlib.sha256(data).hexdigest()
