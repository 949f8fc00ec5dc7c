"""The pipeline end to end on the smallest tables, against brute force where a stage has one."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
from rollbook.llm.queries import vocabulary_path

from .fixtures import table
from .test_operators import brute_lines

FOLDER = "/root/testdata/sf0.001"


def test_run(spark):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(vocabulary_path())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.identified(spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    given = [(r.doc_id, r.text) for r in kept.collect()]
    want = {i: left for (i, _), left in brute_lines(given, 24).items()}
    lined = {r.doc_id: r.text for r in corpus_pipeline.line_deduped(spark, kept, FOLDER).collect()}
    assert lined == {i: t for i, t in want.items() if re.search(r"[^\x20\x09-\x0D]", t)}
    out = corpus_pipeline.run(spark, FOLDER).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = {i: loaded.encode(t, add_special_tokens=False).ids for i, t in lined.items()}
    assert out and {r.doc_id for r in out} <= set(lined)
    assert all(r.n_tokens == len(ids[r.doc_id]) and r.ids_sha256 == sha(" ".join(map(str, ids[r.doc_id]))) for r in out)
    assert max(Counter(r.doc_id for r in out).values()) <= 2


def test_stages_keep_columns_and_awkward_rows(spark):
    rows = [(1, "plain words of one text that is long enough to be told apart", "x", "a"), (1, "plain words of one text that is long enough to be told apart", "x", "a"), (2, None, "x", None), (None, "other words, also long enough, that nobody else has written", "x", "b"), (3, "12 34", "x", "b")]
    docs = table(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        out.collect()
    assert corpus_pipeline.near_deduped(spark, docs, FOLDER).where("doc_id = 1").count() == 1
    assert corpus_pipeline.tokenized(spark, docs, FOLDER).count() == 5
