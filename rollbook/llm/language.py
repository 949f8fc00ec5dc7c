"""Language identification: known words first, then shorter and shorter n-grams.

A word of the learned table scores by its log frequency in each language.
Another word scores at each position by the longest known n-gram that starts
there.  Both are made comparable as log posteriors under equal priors; a
text's languages are the softmax of the mean over its words.

Defined cases: null, empty and letterless texts are ``und`` with score 0; with
nothing to learn from every text is; languages that tie go to the first by
code point; repeated rows give equal rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: The tables are learned from at most so many labelled documents of each language, least hash first.
SAMPLE = 400
LONGEST = 4
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 200_000


def words(text: str) -> list[str]:
    """Lower-cased maximal runs of letters."""
    return _WORD.findall(text.lower())


class Model:
    """Per-language log posteriors of words and of n-grams of 1 to ``LONGEST`` letters, one row each."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.langs = sorted({lang for lang, _ in counts})
        at = {x: i for i, x in enumerate(self.langs)}
        self.words, self.word_rows = self._posteriors(((w, at[lang], n) for (lang, w), n in counts.items()), least=2)
        self.grams, self.gram_rows = self._posteriors(((g, at[lang], n) for (lang, w), n in counts.items() for g in _grams(w)), least=1)

    def _posteriors(self, counted, least: int) -> tuple[dict[str, int], np.ndarray]:
        """Row numbers and rows of the keys seen ``least`` times."""
        found: Counter = Counter()
        for key, lang, n in counted:
            found[key, lang] += n
        total: Counter = Counter()
        for (key, _), n in found.items():
            total[key] += n
        rows = {k: i for i, k in enumerate(sorted(k for k, n in total.items() if n >= least))}
        counts = np.zeros((len(rows), max(len(self.langs), 1)))
        for (key, lang), n in found.items():
            if key in rows:
                counts[rows[key], lang] = n
        p = (counts + 0.1) / (counts.sum(0) + 0.1 * max(len(rows), 1))
        return rows, np.log(p / p.sum(1, keepdims=True)).astype(np.float32)

    def word(self, word: str) -> np.ndarray:
        """Log posterior of one word."""
        if (row := self.words.get(word)) is not None:
            return self.word_rows[row]
        padded, rows = f"^{word}$", []
        for i in range(len(padded)):
            for size in range(min(LONGEST, len(padded) - i), 0, -1):
                if (row := self.grams.get(padded[i : i + size])) is not None:
                    rows.append(row)
                    break
        return self.gram_rows[rows].sum(0) / len(padded)


def _grams(word: str):
    padded = f"^{word}$"
    for size in range(1, LONGEST + 1):
        for i in range(len(padded) - size + 1):
            yield padded[i : i + size]


def learn(docs: DataFrame, may_learn: Column, sample: int = SAMPLE) -> Model:
    """Tables from the labelled documents for which ``may_learn`` is true."""
    from pyspark.sql import Window

    keys = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"))
    # Only keys are ranked, the least hashes of each language within a slice before the whole.
    sliced = Window.partitionBy("lang", F.pmod("_h", F.lit(64))).orderBy("_h", "doc_id")
    whole = Window.partitionBy("lang").orderBy("_h", "doc_id")
    first = keys.withColumn("_n", F.row_number().over(sliced)).where(F.col("_n") <= sample)
    first = first.withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= sample).select("doc_id").distinct()
    text = docs.where(may_learn & F.col("lang").isNotNull()).join(F.broadcast(first), "doc_id").select("lang", "text")

    @tidy
    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((lang, w) for w in words(text or ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    counts = text.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return Model({(r.lang, r.word): r.n for r in counts.toLocalIterator()})


def identify(docs: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``extra`` columns, lang_pred and score of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"), *extra)
    schema = docs.select("doc_id", *extra).schema.add("lang_pred", "string").add("score", "double")

    @tidy
    def run(batches):
        model = shared.value
        rows: dict[str, int] = {}
        table = np.zeros((_CACHE, max(len(model.langs), 1)), np.float32)
        for batch in batches:
            preds, scores = [], []
            for text in batch.column(1):
                found = words(text.as_py() or "")
                if not found or not model.langs:
                    preds.append("und")
                    scores.append(0.0)
                    continue
                total, n = np.zeros(len(model.langs)), len(found)
                for part in (found[i : i + _CACHE // 4] for i in range(0, n, _CACHE // 4)):
                    if len(rows) + len(part) > _CACHE:
                        rows.clear()
                    for w in set(part).difference(rows):
                        table[len(rows)] = model.word(w)
                        rows[w] = len(rows)
                    total += table[np.fromiter(map(rows.__getitem__, part), np.int64, len(part))].sum(0, dtype=np.float64)
                mean = np.exp(total / n - (total / n).max())
                preds.append(model.langs[int(np.argmax(mean))])
                scores.append(float(mean.max() / mean.sum()))
            keep = [batch.column(0), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["doc_id", *extra, "lang_pred", "score"])

    return chosen.mapInArrow(run, schema)


def remainder() -> Column:
    """crc32 of the document's number as text, modulo 5; null for a null number."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def language_id(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned where the remainder is not 0."""
    model = learn(docs, F.coalesce(remainder() != 0, F.lit(False)))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
