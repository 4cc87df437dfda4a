"""The inverted index of words against the words themselves, and what a lookup reads."""

import random

import pytest

from conftest import SF_SMALL
from tokenyard.functions.pairs import merge_pairs
from tokenyard.operators import word_index as W
from tokenyard.operators.counts import pretoken_counts, word_tokens
from tokenyard.sinks.tables import materialize
from tokenyard.sources.tables import table

from pyspark.sql import functions as F


def _numbered(words):
    return materialize(words.select(F.monotonically_increasing_id().alias("word_id"), "toks", "freq"), "test-words")


@pytest.fixture(scope="module")
def corpus(spark):
    return _numbered(word_tokens(pretoken_counts(table(spark, SF_SMALL, "documents").select("text"))))


def _hex(*tokens):
    return tuple(t.encode().hex().upper() for t in tokens)


def _read(df) -> int:
    """Rows that the scans of a finished query gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _holding(words, pairs):
    texts = [f"|{l}||{r}|" for l, r in pairs]
    return {(r.word_id, r.toks, r.freq) for r in words.collect() if any(t in r.toks for t in texts)}


def test_lookup_reads_touched_rows(spark, corpus):
    """The scans give out the postings of the wanted pairs and at most two pages a file and pair more."""
    index = W.build_index(corpus)
    total = index.layers[0].postings.count()
    assert total > 20 * W.PAGE_ROWS
    for pairs in ([_hex("t", "h")], [_hex("q", "u"), _hex(" ", "z")], [_hex("x", "x")]):
        postings = index.postings_of(pairs)
        wanted = {f"|{l}||{r}|" for l, r in pairs}
        held = [r for r in postings.collect() if r.pair in wanted]
        assert len(held) == postings.count()
        assert {(r.word_id, r.toks, r.freq) for r in held} == _holding(corpus, pairs)
        assert _read(postings) <= len(held) + 2 * W.PAGE_ROWS * len(pairs) < total / 2


def test_rounds_of_merges(spark, corpus):
    """Layers and folds: after each round the index gives just the words that hold a pair, as the merges left them."""
    rng, index, words, merges = random.Random(5), W.build_index(corpus), corpus, []
    for turn in range(4):
        top = [(r.left, r.right) for r in _pairs(words).orderBy(F.desc("n"), "left", "right").limit(40).collect()]
        wanted = rng.sample(top, 3)
        hits = materialize(index.words_of(wanted), "test-hits")
        assert {tuple(r) for r in hits.collect()} == _holding(words, wanted)
        index, changed = index.merged(hits, wanted[:2])
        merges += wanted[:2]
        before = {r.word_id: r.toks for r in words.collect()}
        words = corpus.select("word_id", merge_pairs(F.col("toks"), merges).alias("toks"), "freq")
        after = {r.word_id: r.toks for r in words.collect()}
        assert {(r.word_id, r.before, r.toks) for r in changed.collect()} == {
            (i, before[i], after[i]) for i in after if after[i] != before[i]}
        if turn == 1:
            index = index.folded()
            assert len(index.layers) == 1
    postings = {(r.pair, r.word_id, r.toks) for r in index.folded().layers[0].postings.collect()}
    assert postings == {(p, r.word_id, r.toks) for r in words.collect() for p in _texts(r.toks)}


def _texts(toks):
    tokens = toks.strip("|").split("||")
    return {f"|{l}||{r}|" for l, r in zip(tokens, tokens[1:])}


def _pairs(words):
    from tokenyard.operators.counts import pair_counts

    return pair_counts(words)


def test_many_files_and_no_words(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_ROWS", 50)
    words = _numbered(spark.createDataFrame([(f"|61||62||{k:02X}|", k) for k in range(120)], "toks string, freq long"))
    index = W.build_index(words)
    assert {tuple(r) for r in index.words_of([("61", "62")]).collect()} == _holding(words, [("61", "62")])
    assert len(index.layers[0].postings.inputFiles()) > 1  # the pair that all words hold is in several files
    assert index.words_of([]).collect() == []
    empty = W.build_index(words.where("false"))
    assert empty.words_of([("61", "62")]).collect() == []


def test_folding_leaves_large_layers(spark, corpus):
    """Every fold rewrote all postings of the index, though few merges had touched few of them."""
    index, words, merges = W.build_index(corpus), corpus, []
    large = index.layers[0]
    for _ in range(3):
        best = _pairs(words).orderBy(F.desc("n"), "left", "right").first()
        index, _ = index.merged(index.words_of([(best.left, best.right)]), [(best.left, best.right)])
        merges.append((best.left, best.right))
        words = corpus.select("word_id", merge_pairs(F.col("toks"), merges).alias("toks"), "freq")
    small = index.compacted(3)
    assert small.layers[0] is large and len(index.layers) == 4 and len(small.layers) == 2
    assert small.layers[1].rows == small.layers[1].postings.count() < large.rows / 2
    assert small.compacted(3) is small
    wanted = [(r.left, r.right) for r in _pairs(words).orderBy(F.desc("n"), "left", "right").limit(5).collect()]
    assert {tuple(r) for r in small.words_of(wanted).collect()} == _holding(words, wanted)


def test_folding_takes_outgrown_and_stale_layers(spark, corpus, monkeypatch):
    index = W.build_index(corpus)
    for pair in (_hex("e", " "), _hex("t", "h")):
        index, _ = index.merged(index.words_of([pair]), [pair])
    assert len(index.compacted(2).layers) == 2
    monkeypatch.setattr(W, "YOUNG_PART", 1e-6)  # the young layers have outgrown the first
    assert len(index.compacted(2).layers) == 1
    monkeypatch.undo()
    monkeypatch.setattr(W, "STALE_MERGES", 1)  # the first layer lags behind by two merges
    assert len(index.compacted(2).layers) == 1


def test_postings_of_repeated_pairs(spark):
    """A pair is posted once a word, also where it overlaps itself, stands again later or its tokens have many bytes."""
    toks = ["|61||61||61||61|", "|61||62||61||62||61|", "|6162||63||61||62||6162||63|", "|61|", "|61||6161||61||6161|", ""]
    words = _numbered(spark.createDataFrame([(t, 1) for t in toks], "toks string, freq long"))
    found = [(r.pair, r.toks) for r in W.build_index(words).layers[0].postings.collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(p, t) for t in toks for p in _texts(t)}
