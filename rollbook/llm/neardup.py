"""Near duplicates by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles, by TF-IDF: weight =
(1 + ln of the times in the text) x idf.  With plain times, one phrase
repeated hundreds of times would make texts alike that share nothing else.
idf = 1 + log10(documents / documents that hold the shingle), with a ceiling
at one document in a hundred, so only shingles above this share need a count;
they are found exactly in two passes, as such a shingle also reaches the
share in some block of documents.  Their table has at most a hundred times a
document's mean count of shingles, whatever the input.

Equal texts are one node.  16 samples in 8 bands make keys.  In the first
round each node of a key is verified, by weighted Jaccard similarity on whole
texts, against the key's least node alone; links make components.  The second
round reads the keys whose nodes are not yet in one component, and computes
the similarities of all pairs of different components of a key, exactly and
without a row for a pair: a tile's texts meet in one matrix product, and only
links that join two components come out.  So no link between classes that
share a key is lost, and a class costs one link for each node and key.  A key
of over ``BUCKET`` nodes is read in tiles: nodes outside of its largest
component meet all others, those inside only the former.  The tiles' work
grows with the product of the two, so with the square of a group whose texts
share a key and are no copies; their rows and texts with its part of
``BUCKET``.

Defined cases: texts without words (null, empty) are classes of their own;
texts of one to four words are one shingle; very long texts are read whole,
one at a time; repeated rows belong to one class and are all kept or all
removed together with their first, as they can't be told apart; the least
number stands for its class, null last, then the least hash of the text; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hasher, beside, cut, give_back, mix, string_blocks, text_key, tidy, unshort, word_ranges
from .graph import components, tiles

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 8, 2
COMMON = 0.01
#: Nodes of a key that one tile reads whole; each ``UNIT`` bytes of a compressed text count as a node, so that a tile's memory is bounded.
BUCKET, UNIT = 384, 32768
#: Shingles of a block of a tile's matrix product.
COLUMNS = 2048
#: Documents and shingles of a block whose frequent shingles are candidates, and candidates that are broadcast; more are counted by a shuffle.
BLOCK_DOCS, BLOCK_SHINGLES, CANDIDATES = 4096, 4_000_000, 1_000_000
_K = BANDS * ROWS


def _gamma_quantiles() -> np.ndarray:
    """Gamma(2, 1) at the midpoints of 65,536 equal shares."""
    share = (np.arange(65536) + 0.5) / 65536
    x = np.sqrt(2 * share) + share
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - share) / np.maximum(x * np.exp(-x), 1e-12) * 0.9, 1e-9)
    return x


_GAMMA = _gamma_quantiles()
_R, _PER_R, _LOG_C = _GAMMA.astype(np.float32), (1 / _GAMMA).astype(np.float32), np.log(_GAMMA).astype(np.float32)


def counted_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times), sorted, each shingle of a text once."""
    starts, ends, text = word_ranges(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = Hasher(data).ranges(starts, ends)
    n = np.bincount(text, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    rank = np.arange(len(words)) - first[text]
    begin = np.flatnonzero((rank + SHINGLE <= n[text]) | ((rank == 0) & (n[text] < SHINGLE)))
    value = np.zeros(len(begin), np.uint64)
    for i in range(SHINGLE):
        at = np.minimum(begin + i, len(words) - 1)
        inside = (text[at] == text[begin]) & (begin + i < len(words))
        value = value * np.uint64(0xD1342543DE82EF95) + np.where(inside, words[at], 0).astype(np.uint64)
    value, text = mix(value), text[begin]
    order = np.lexsort((value, text)) if len(offsets) > 2 else np.argsort(value, kind="stable")
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(value)))


def shingles(data: np.ndarray, offsets: np.ndarray, common: np.ndarray, idf: np.ndarray, ceiling: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted, each shingle of a text once.

    ``common`` are the sorted hashes of shingles below the ceiling, ``idf`` theirs.
    """
    text, value, times = counted_shingles(data, offsets)
    own = np.full(len(value), ceiling)
    if len(common):
        at = np.minimum(np.searchsorted(common, value), len(common) - 1)
        known = common[at] == value
        own[known] = idf[at[known]]
    return text, value, (1 + np.log(times)) * own


def samples(text: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, their samples): for each text ``_K`` consistent weighted samples as 64-bit keys."""
    at = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    sizes = np.diff(np.append(at, len(text)))
    log_weight = np.log(weight).astype(np.float32)
    out = np.zeros((len(at), _K), np.uint64)
    for k in range(_K):
        # 16 bits for r, 16 for c and 32 for beta.
        bits = value * np.uint64(((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)) | 1)
        bits ^= bits >> np.uint64(31)
        bits *= np.uint64(0xBF58476D1CE4E5B9)
        bits ^= bits >> np.uint64(29)
        parts = bits.view(np.uint16).reshape(-1, 4)
        which, beta = parts[:, 3], bits.view(np.uint32).reshape(-1, 2)[:, 0] * np.float32(2.0**-32)
        step = np.floor(log_weight * _PER_R[which] + beta)
        score = _LOG_C[parts[:, 2]] - _R[which] * (step - beta + np.float32(1))
        least = np.repeat(np.minimum.reduceat(score, at), sizes)
        hit = np.flatnonzero(score == least)
        hit = hit[np.append(True, text[hit][1:] != text[hit][:-1])]
        out[:, k] = mix(value[hit] ^ mix(step[hit].astype(np.int64).view(np.uint64)))
    return text[at], out


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted shingles, weights)."""
    _, a, b = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    low, high = np.minimum(one[1][a], two[1][b]).sum(), np.maximum(one[1][a], two[1][b]).sum()
    union = one[1].sum() + two[1].sum() - one[1][a].sum() - two[1][b].sum() + high
    return float(low / union) if union > 0 else 0.0


def _blocks_of_shingles(batches):
    """(documents, shingles) of blocks; the last block is joined to the one before, so that a short one makes no candidates of its own."""
    docs, parts, size, before = 0, [], 0, None
    for batch in batches:
        for first, end, data, offsets in string_blocks(batch.column(0)):
            value = counted_shingles(data, offsets)[1]
            docs, size = docs + end - first, size + len(value)
            parts.append(value)
            if docs >= BLOCK_DOCS or size >= BLOCK_SHINGLES:
                if before:
                    yield before[0], np.concatenate(before[1])
                before, docs, parts, size = (docs, parts), 0, [], 0
    docs, parts = docs + (before[0] if before else 0), parts + (before[1] if before else [])
    if docs:
        yield docs, np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_idf(docs: DataFrame, common: float = COMMON) -> tuple[np.ndarray, np.ndarray, float]:
    """(hashes, idf, ceiling): shingles in at least ``common`` of all documents; every other one has the ceiling."""
    texts, spark = docs.select("text"), docs.sparkSession

    @tidy
    def frequent(batches):
        for n, values in _blocks_of_shingles(batches):
            own, times = np.unique(values, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own[times >= common * n].view(np.int64))], ["shingle"])

    total = docs.count()
    candidates = cut(texts.mapInArrow(frequent, "shingle long").distinct())
    few = candidates.count() <= CANDIDATES
    chosen = np.sort(candidates.toPandas()["shingle"].to_numpy(np.int64).view(np.uint64)) if few else None
    shared = spark.sparkContext.broadcast(chosen)

    @tidy
    def counts(batches):
        held = shared.value
        sums = None if held is None else np.zeros(len(held), np.int64)
        for _, values in _blocks_of_shingles(batches):
            if held is None:
                own, times = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(times)], ["shingle", "n"])
            elif len(held):
                at = np.minimum(np.searchsorted(held, values), len(held) - 1)
                sums += np.bincount(at[held[at] == values], minlength=len(held))
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[sums > 0].view(np.int64)), pa.array(sums[sums > 0])], ["shingle", "n"])

    df = texts.mapInArrow(counts, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= common * total)
    rows = (df if few else df.join(candidates, "shingle", "left_semi")).toPandas()
    hashes = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    idf = 1 + np.log10(total / np.maximum(rows["n"].to_numpy(float), 1))
    order = np.argsort(hashes)
    return hashes[order], idf[order], 1 + float(np.log10(1 / common))


def _bands() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("samples", b * (8 * ROWS) + 1, F.lit(8 * ROWS))))


def sampled_nodes(texts: DataFrame, idf: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """(node, t, samples, least, copies): each different text with words of (doc_id, t, text), ``least`` as (no_id, doc_id)."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    @tidy
    def sample(batches):
        for batch in batches:
            for first, _, data, offsets in string_blocks(batch.column(2)):
                text, value, weight = shingles(data, offsets, *shared.value)
                if len(text):
                    which, own = samples(text, value, weight)
                    rows = pa.array(first + which)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([x.tobytes() for x in own], pa.binary())], ["t", "doc_id", "samples"])

    found = texts.select("t", "doc_id", "text").mapInArrow(sample, "t binary, doc_id long, samples binary")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    nodes = found.groupBy("t").agg(F.max("samples").alias("samples"), F.min(place).alias("least"), F.count("*").alias("copies"))
    return cut(nodes.select(F.monotonically_increasing_id().alias("node"), "*"))


def linked_in_tile(sets: list[tuple[np.ndarray, np.ndarray]], root: np.ndarray, apart: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """(i, j, similarity) of a spanning forest of the links between different roots; ``apart`` tells which rows need be compared.

    Sums of lesser weights come from matrix products: a shingle's weights
    differ between texts by how often it is repeated alone, so each step
    between two of them is one product of the texts that reach the upper.
    Shingles that one text holds are left out, columns go in blocks.
    """
    n, sizes = len(sets), np.array([len(x[0]) for x in sets])
    value, weight = (np.concatenate([x[k] for x in sets]) for k in (0, 1))
    own, at, held = np.unique(value, return_inverse=True, return_counts=True)
    which, kept = np.repeat(np.arange(n), sizes), held[at] > 1
    column = (np.cumsum(held > 1) - 1)[at[kept]]
    which, weight_, shared = which[kept], weight[kept].astype(np.float32), np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    which, column, weight_ = which[order], column[order], weight_[order]
    for a in range(0, int(held[held > 1].size), COLUMNS):
        lo, hi = np.searchsorted(column, (a, a + COLUMNS))
        block = np.zeros((n, COLUMNS), np.float32)
        block[which[lo:hi], column[lo:hi] - a] = weight_[lo:hi]
        below = np.zeros(COLUMNS, np.float32)
        while True:
            step = np.where(block > below, block, np.inf).min(0)
            live = np.flatnonzero(np.isfinite(step) & ((block > below).sum(0) > 1))
            if not len(live):
                break
            reach = (block[:, live] > below[live]) * np.sqrt(step[live] - below[live])
            shared += reach @ reach.T
            block, below = block[:, live], step[live]
    total = np.array([x[1].sum() for x in sets])
    near = shared / np.maximum(total[:, None] + total[None] - shared, 1e-9)
    near[~apart | (root[:, None] == root[None])] = 0
    one, two = np.nonzero(np.triu(near >= least - 1e-3, 1))
    parent = {r: r for r in root.tolist()}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for k in np.argsort(-near[one, two], kind="stable").tolist():
        i, j = int(one[k]), int(two[k])
        a, b = find(int(root[i])), find(int(root[j]))
        if a != b and (exact := similarity(sets[i], sets[j])) >= least:
            parent[a] = b
            out.append((i, j, exact))
    return out


def _open_links(met: DataFrame, shelf: DataFrame, scored: DataFrame, idf, least: float) -> DataFrame:
    """(a, b, similarity), a > b, of links that join different components within a key."""
    known = components(scored.where(F.col("similarity") >= least).select("a", "b"))
    rows = met.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = rows.join(shelf.select("node", (1 + F.floor(F.length("packed") / UNIT)).alias("units")).distinct(), "node")
    dealt = cut(tiles(rows.select("key", "node", "root", "units"), BUCKET))
    calls = max(1, -(-int(dealt.agg(F.sum("units")).first()[0] or 0) // (2 * BUCKET)))
    every = dealt.join(shelf, "node").withColumn("call", F.pmod(F.xxhash64(F.lit(9), "tile"), F.lit(calls)))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tile", "ascending"), ("node", "ascending")])
        node, tile, root, own, diagonal = (table.column(c).to_numpy() for c in ("node", "tile", "root", "own", "diagonal"))
        # A repeated row brings its text, and so the node, more than once.
        first = np.flatnonzero(np.append(True, (tile[1:] != tile[:-1]) | (node[1:] != node[:-1])))
        cuts = np.append(np.flatnonzero(np.append(True, tile[first][1:] != tile[first][:-1])), len(first))
        sets: dict[int, tuple] = {}
        out: list[tuple[int, int, float]] = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = first[a:b]
            for i in at.tolist():
                if node[i] not in sets:
                    sets[node[i]] = _weighted(table.column("packed")[i].as_py(), idf.value)
            apart = diagonal[at][:, None] | (own[at][:, None] != own[at][None])
            found = linked_in_tile([sets[x] for x in node[at].tolist()], root[at], apart, least)
            out += [(int(node[at[j]]), int(node[at[i]]), x) for i, j, x in found]
        give_back()
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"])

    columns = ["call", "tile", "node", "root", "own", "diagonal", "packed"]
    return every.select(*columns).groupBy("call").applyInArrow(solve, "a long, b long, similarity double")


def _weighted(packed: bytes, idf: tuple[np.ndarray, np.ndarray, float]) -> tuple[np.ndarray, np.ndarray]:
    raw = unshort(packed)
    return shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), *idf)[1:]


def links(texts: DataFrame, nodes: DataFrame, idf: tuple[np.ndarray, np.ndarray, float], least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of verified links between nodes, a > b; their components are the classes."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)
    rows = nodes.select("node", F.explode(_bands()).alias("key"))
    heads = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1").select("key", "head")
    met = cut(rows.join(heads, "key"))
    # One row of each node brings its text, compressed, so copies of a text don't meet in one task.
    wanted = nodes.join(met.select("node").distinct(), "node").select("node", "least.doc_id", F.col("t").alias("key"))
    shelf = cut(beside(texts.withColumnRenamed("t", "key"), wanted, "inner").select("node", "packed"))

    @tidy
    def verify(batches):
        last, other = None, None
        for batch in batches:
            scores = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if b != last:
                    last, other = b, _weighted(y, shared.value)
                scores.append(similarity(_weighted(x, shared.value), other))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["a", "b", "similarity"])

    pairs = met.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    both = pairs.join(shelf.select(F.col("node").alias("a"), F.col("packed").alias("one")), "a").join(shelf.select(F.col("node").alias("b"), F.col("packed").alias("two")), "b")
    # Repeated rows bring a text, and so a pair, more than once.
    scored = both.select("a", "b", "one", "two").mapInArrow(verify, "a long, b long, similarity double").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    scored = cut(scored)
    return scored.where(F.col("similarity") >= least).unionByName(_open_links(met, shelf, scored, shared, least))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, t (the text's key), class_id, n_verified, kept of every document.

    ``n_verified`` counts the verified links of the document's text and the
    other documents of equal text; links within a class beyond these are not
    all tried.  ``class_id`` is the least number of the class, and the
    documents that hold it with the class's first text are kept.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("t", text_key())
    idf = shingle_idf(texts)
    nodes = sampled_nodes(texts.where("text is not null"), idf)
    found = cut(links(texts, nodes, idf, least).select("a", "b"))
    ends = found.select(F.col("a").alias("node")).unionAll(found.select(F.col("b").alias("node")))
    known = ends.groupBy("node").agg(F.count("*").alias("degree")).join(components(found), "node")
    own = F.struct("least.no_id", "least.doc_id", "t")
    member = nodes.select("node", "t", "copies", own.alias("own")).join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = member.groupBy("root").agg(F.min("own").alias("head"))
    # A text without words has no node and stays alone, also among equals.
    member = member.join(heads, "root").select("t", "head", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_verified"))
    out = texts.select("doc_id", "t").join(member, "t", "left")
    alone, place = F.col("head").isNull(), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    return out.select(
        "doc_id", "t", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"), F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"), (alone | (place == F.col("head"))).alias("kept")
    )
