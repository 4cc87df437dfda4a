"""Pipeline stages on odd tables: clashing and dotted column names, nulls in every column, repeated rows, no rows."""

import pytest
from llm_texts import DOC, prose
from pyspark.sql import functions as F

import corpus_pipeline
from tokenyard.llm.common import staged

SF = "/root/testdata/sf0.001"
CLASHES = ("n_words", "score", "kept", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "row", "class",
           "key", "a.b", "rest", "document", "mix_copy", "anchors", "part")


@pytest.fixture(scope="module")
def odd_docs(spark):
    good = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    rows = [(None if k % 3 == 0 else k, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 4}", len(t or ""))
            for k, t in enumerate(good)]
    rows += rows[:6] + [(500, None, None, None, None), (501, "", None, None, None), (502, prose(1, 200), None, None, None)]
    docs = spark.createDataFrame(rows, DOC)
    return docs.select("*", *[F.concat(F.lit("own "), F.coalesce("doc_id", F.lit(-7))).alias(c) for c in CLASHES])


def test_stages_keep_columns(spark, odd_docs):
    docs, texts = odd_docs, {(r.doc_id, r.source): r for r in odd_docs.collect()}
    assert texts
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = staged(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == odd_docs.columns, name
        rows = docs.collect()
        assert rows and (name == "source_mixing" or len(rows) <= before)
        for r in rows:
            assert all(r[c] == f"own {-7 if r.doc_id is None else r.doc_id}" for c in CLASHES), name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert out and max(r.offset + r.length for r in out) <= 2048


def test_no_rows(spark, odd_docs):
    docs = odd_docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"none-{name}")
        assert docs.count() == 0, name
