"""F1, F6 in Python workers against the JVM's pattern and the word-by-word loop; bounded batches and row groups."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tokenyard.functions.codec import TextEncoder, Tokenizer, WordEncoder, bpe_word
from tokenyard.functions.pretokens import PreTokenizer, char_classes, spans
from tokenyard.functions.text import DEFAULT_SPECIAL as X
from tokenyard.functions.text import pretokenize
from tokenyard.operators import bpe
from tokenyard.operators import encode as encode_module
from tokenyard.operators.bpe import base_vocab
from tokenyard.operators.encode import decode_by_join, encode
from tokenyard.sinks.tables import materialize


def test_words_are_those_of_the_jvm(spark):
    rng = random.Random(3)
    letters = ["a", "Z", "é", "ß", "日", "\U00020000", "𝔸", "1", "٣", "Ⅷ", " ", " ", "\n", "\t", " ", "\u0085", " ",
               "\x1c", "​", "'", "'s", "'ll", "!", "🙃", "́", "_"]
    texts = ["".join(rng.choice(letters[:n]) for _ in range(rng.randrange(30))) for n in (2, 12, 26) for _ in range(150)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pretokenize("t").alias("w")).collect()
    cut = PreTokenizer(char_classes(spark))
    for t, w in rows:
        assert [x for _, words in cut.pieces(t) for x in words] == w, repr(t)


@pytest.mark.parametrize("dense", [True, False])
def test_words_at_once_equal_words_one_by_one(dense):
    rng = random.Random(4)
    for trial in range(120):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randrange(12)):
            merges.append((rng.choice(tokens), rng.choice(tokens)))
            tokens.append(b"".join(merges[-1]))
        rng.shuffle(merges)
        rank = dict(zip(merges, range(len(merges))))
        ids = {bytes([i]): i for i in range(256)}
        for t in tokens:
            ids.setdefault(t, len(ids))
        encoder = WordEncoder(rank, ids)
        encoder.dense = encoder.dense if dense else None
        words = ["".join(rng.choice("abc" if trial % 3 else "aab") for _ in range(rng.choice([1, 5, 12, 300]))) for _ in range(20)]
        for word, got in zip(words, encoder([*words, "é"]), strict=False):
            assert list(np.frombuffer(got, "<i4")) == bpe_word(word, rank, ids)
    assert WordEncoder({}, {})([]) == []
    with pytest.raises(KeyError):
        WordEncoder({(b"a", b"b"): 0}, {b"a": 0, b"b": 1})(["ab"])


def test_encoder_hands_on_small_batches(spark):
    """What a worker holds does not follow the rows of a batch (F11, F14: it gathered the ids of 10,000 documents)."""
    texts = pa.array(["word " * 4000, None, "", "x"] * 50)
    assert sum(n for _, n in spans(texts)) == len(texts)
    encoder = TextEncoder({}, {bytes([i]): i for i in range(256)}, {}, char_classes(spark), False)
    found = list(encoder.lists(texts))
    assert max(len(ids.flatten()) for _, _, ids in found) <= (1 << 20) + 20_000 < 20_000 * 50 * 2
    assert [len(x) for _, _, ids in found for x in ids.to_pylist()] == [20_000, 0, 0, 1] * 50


def test_large_rows_are_written_in_small_row_groups(spark):
    """Spark's reader decodies up to 4096 rows of a row group at once; a written token table had one row group a file."""
    arrays = spark.range(0, 40, 1, 1).selectExpr("id", "sequence(int(id), int(id) + 262143) AS ids")
    back = materialize(arrays, "large-rows", large_rows=True)
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in back.inputFiles()]
    sizes = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
    assert sum(sizes) == 40 and max(sizes) <= 16
    assert sorted(tuple(r) for r in back.selectExpr("id", "size(ids)", "ids[262143]").collect()) == [
        (i, 1 << 18, i + 262143) for i in range(40)]


def test_few_merges_are_recounted_at_any_size(spark, monkeypatch):
    """An index of all pairs was written for 8 merges of a large table."""
    docs = spark.createDataFrame([("the then they there",)], "text string")
    want = bpe.train_bpe(docs, 256 + 4, incremental=True).merges
    monkeypatch.setattr(bpe, "RECOUNT_MAX_PAIRS", 0)

    def refuse(*_):
        raise AssertionError("indexed")

    monkeypatch.setattr(bpe, "_Indexed", refuse)
    assert bpe.train_bpe(docs, 256 + 4).merges == want
    monkeypatch.setattr(bpe, "RECOUNT_MAX_MERGES", 3)
    with pytest.raises(AssertionError, match="indexed"):
        bpe.train_bpe(docs, 256 + 4)


def test_decode_by_join_looks_up_distinct_ids(spark, monkeypatch):
    tok = Tokenizer(dict(enumerate(base_vocab([X]))), [], [X])
    texts = [f"abba{X}" * 20, "", "é\n", "abab"] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    looked_up = []
    join = encode_module.decode_join

    def counted(rows, *args, **kwargs):
        looked_up.append(rows.select(F.sum(F.size("ids"))).first()[0])
        return join(rows, *args, **kwargs)

    monkeypatch.setattr(encode_module, "decode_join", counted)
    rows = encode(docs, tok).unionByName(spark.createDataFrame([(99, None)], "doc_id long, ids array<int>"))
    got = {r.doc_id: r.text for r in decode_by_join(rows, tok).collect()}
    assert got == {**dict(enumerate(texts)), 99: None}
    assert looked_up[0] == len({"a", "b", X, "\n", *"é".encode()})
    bad = spark.createDataFrame([(0, [10**6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="missing from vocabulary"):
        decode_by_join(bad, tok).collect()
