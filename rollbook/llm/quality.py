"""Quality rules: boosted trees over document statistics.

``statistics`` makes one vectorised pass over whole texts, ``fit`` boosts
shallow trees with monotonic constraints on a bounded labelled sample, and
``Trees`` holds them as flat numpy node arrays that score a batch by as many
gathers as the trees are deep.

Defined cases: a null or empty text has no words and fails the base rules;
repeated rows are judged one by one and give equal rows; an empty table gives
an empty result; with no labels, or labels of one class only, the method
keeps what passes the base rules.  Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, counted, mix, string_blocks, tidy, word_ranges

#: Training reads at most so many labelled documents, least hash first.
SAMPLE = 4000
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "bar_share", "line_words", "stop_share", "distinct_share", "other_share", "bang_share",
)
#: -1: the score may only fall as the feature grows.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "bar_share": -1, "bang_share": -1}

_IS = lambda chars: np.isin(np.arange(256), list(chars))
_SYMBOL, _UPPER, _DIGIT = _IS(b"#*$%&|<>"), _IS(range(65, 91)), _IS(range(48, 58))
_MARK, _BAR, _BANG = _IS(b".,;:!?"), _IS(b"|"), _IS(b"!")
_LEAD = (np.arange(256) & 0xC0) != 0x80
_SPACE = _IS([0x20, *range(9, 14)])
_LETTER = _IS([*range(65, 91), *range(97, 123), *range(128, 256)])


def block_statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, features) of the texts of one block."""
    n = len(offsets) - 1
    starts, ends, text = word_ranges(data, offsets)
    hasher = Hasher(data)
    words = np.bincount(text, minlength=n)
    chars = counted((_LEAD & ~_SPACE)[data], offsets)
    symbols = counted(_SYMBOL[data], offsets)

    # Lines: every newline ends one, every text ends its last.
    cuts = np.flatnonzero(data == 10)
    line_starts = np.concatenate([offsets[:-1], cuts + 1])
    line_text = np.concatenate([np.arange(n), np.searchsorted(offsets, cuts, side="right") - 1])
    order = np.lexsort((line_starts, line_text))
    line_starts, line_text = line_starts[order], line_text[order]
    line_ends = np.append(line_starts[1:] - 1, len(data))
    last = np.append(line_text[1:] != line_text[:-1], True) if n else np.zeros(0, bool)
    line_ends[last] = offsets[line_text[last] + 1]
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_text = line_starts[has_word], line_ends[has_word], line_text[has_word]
    lines = np.bincount(line_text, minlength=n)
    line_hash = mix(hasher.ranges(line_starts, line_ends) + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, firsts = np.unique(line_hash, return_index=True)
    dup_lines = lines - np.bincount(line_text[firsts], minlength=n)

    hashes = hasher.ranges(starts, ends)
    repeated = np.zeros(n, dtype=np.int64)
    if len(hashes) >= WINDOW:
        window = np.zeros(len(hashes) - WINDOW + 1, dtype=np.uint64)
        for i in range(WINDOW):
            window = window * np.uint64(0xD1342543DE82EF95) + hashes[i : i + len(window)]
        within = text[: len(window)] == text[WINDOW - 1 :]
        at = np.flatnonzero(within)
        key = mix(window[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        by = np.argsort(key)
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(by), dtype=bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + WINDOW, -1)
        repeated = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)

    word_key = mix(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    distinct = np.bincount(text[np.unique(word_key, return_index=True)[1]], minlength=n)
    short = np.bincount(text[(ends - starts) <= 3], minlength=n)
    per = lambda a, b: a / np.maximum(b, 1)
    letters = counted(_LETTER[data] & _LEAD[data], offsets)
    features = np.stack([
        np.log1p(words), per(chars, words), per(symbols, chars), per(dup_lines, lines), per(repeated, words),
        per(counted(_UPPER[data], offsets), chars), per(counted(_DIGIT[data], offsets), chars),
        per(counted(_MARK[data], offsets), chars), per(counted(_BAR[data], offsets), words), per(words, lines),
        per(short, words), per(distinct, words), per(chars - letters, chars), per(counted(_BANG[data], offsets), words),
    ], axis=1)
    return np.stack([words, chars, symbols, dup_lines, repeated], axis=1), features


@dataclass(frozen=True)
class Trees:
    """All trees as rows of node arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of ``x``."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, t, lo, hi, v in zip(self.feature, self.threshold, self.left, self.right, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = np.where(x[rows, f[at]] <= t[at], lo[at], hi[at])
            out += v[at]
        return out


def fit(
    x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 50, depth: int = 3, rate: float = 0.2, bins: int = 32, smooth: float = 1.0
) -> Trees | None:
    """Gradient boosting of the logistic loss on quantile bins; None if ``y`` has one class only.

    ``monotone`` maps a feature to +1 or -1.  A split that breaks the order is
    not taken, and both sides are bounded by the middle of their values, so
    the order holds for whole trees.
    """
    if len(np.unique(y)) < 2:
        return None
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    raw, size = np.full(len(y), bias), 2 ** (depth + 1) - 1
    kept: list[tuple[np.ndarray, ...]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(size, np.int64), np.zeros(size)
        left, right, value = np.arange(size), np.arange(size), np.zeros(size)
        todo = [(0, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = np.clip(g / (h + smooth), low, high)
            best = (1e-6, None)
            for j in range(x.shape[1]) if level < depth else ():
                if not len(edges[j]):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(edges[j]) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(edges[j]) + 1))[:-1]
                gr, hr = g - gl, h - hl
                wl, wr = np.clip(gl / (hl + smooth), low, high), np.clip(gr / (hr + smooth), low, high)
                gain = gl * wl - 0.5 * (hl + smooth) * wl**2 + gr * wr - 0.5 * (hr + smooth) * wr**2
                gain -= g * value[node] - 0.5 * (h + smooth) * value[node] ** 2
                sign = monotone.get(j, 0)
                gain[(hl < 1e-3) | (hr < 1e-3) | (sign * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, wl[k], wr[k]))
            if best[1] is None:
                continue
            j, k, wl, wr = best[1]
            feature[node], threshold[node] = j, edges[j][k]
            left[node], right[node] = 2 * node + 1, 2 * node + 2
            goes = binned[rows, j] <= k
            middle, sign = (wl + wr) / 2, monotone.get(j, 0)
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[sign]
            todo += [(2 * node + 1, rows[goes], level + 1, *bounds[0]), (2 * node + 2, rows[~goes], level + 1, *bounds[1])]
        value *= rate
        kept.append((feature, threshold, left, right, value))
        raw += Trees(*(np.stack([a]) for a in kept[-1]), bias=0.0, depth=depth).score(x)
    return Trees(*(np.stack(a) for a in zip(*kept, strict=True)), bias=bias, depth=depth)


def statistics(docs: DataFrame, model: Trees | None = None, min_words: int = 20, max_repeat: int = 30, min_score: float = 0.0) -> DataFrame:
    """One row per document: base counts, verdicts, the model's log odds (null without a model) and features."""
    names = [*BASE, "base_failed", "kept", "score", *FEATURES]
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double, "
    schema += ", ".join(f"{x} double" for x in FEATURES)

    @tidy
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, end, data, offsets in string_blocks(texts):
                base, features = block_statistics(data, offsets)
                failed = (base[:, 0] < min_words) | (100 * base[:, 4] > max_repeat * base[:, 0])
                score = model.score(features) if model else None
                kept = ~failed & (score >= min_score) if model else ~failed
                columns = [pa.array(c) for c in base.T] + [pa.array(failed), pa.array(kept)]
                columns.append(pa.array(score) if model else pa.nulls(end - first, pa.float64()))
                columns += [pa.array(c) for c in features.T]
                yield pa.RecordBatch.from_arrays([ids.slice(first, end - first).cast(pa.int64()), *columns], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Boosted trees of P(quality = 1), from at most ``sample`` labelled documents."""
    chosen = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    measured = statistics(rows).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", *FEATURES).orderBy("doc_id", *FEATURES)
    found = measured.limit(2 * sample).toPandas()
    if found.empty:
        return None
    monotone = {FEATURES.index(k): v for k, v in MONOTONE.items()}
    return fit(found[list(FEATURES)].to_numpy(float), found["quality"].to_numpy(float), monotone)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts and the verdict of each document."""
    return statistics(docs, train(docs, labels)).select("doc_id", *BASE, "base_failed", "kept", "score")
