"""Collocations against a plain count of all phrases, with hot leading words, many fragments and exact scores."""

import collections
import random
import re

import numpy as np
import pytest
from llm_texts import prose

from tokenyard.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string"


def brute(rows, max_words=5, least=100, top=2000, percent=100):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        phrases = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in phrases.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        rows_ = []
        for p, a in phrases.items():
            score, _, l, r = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            if not inside[p] or 100 * inside[p] < percent * a:
                rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed, n, hot):
    """Text over few words with a hot pair before many others, shared passages, marks, and odd characters."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ä", "é漢", "It's", "\x00", "a-b"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(60)):
            words.append("Of THE" if rng.random() < hot else rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n", "\t", " !"]))
        if i % 3 == 0:
            words.append(passage)
        rows.append((i, " ".join(words), ["en", "de", None, "en"][i % 4]))
    return rows + [(None, None, "en"), (1, "", None), (2, ". , \n\t ", "xx"), (3, "one two", "yy")] * 2


@pytest.mark.parametrize("hot,one_in,fragment_bytes,least,max_words", [
    (0.4, 1, 500, 12, 5), (0.4, 64, 500, 12, 5), (0.05, 1, 4 << 20, 5, 3), (0.3, 1, 300, 8, 2), (0.3, 1, 2000, 20, 4)])
def test_collocations(spark, hot, one_in, fragment_bytes, least, max_words):
    rows = corpus(int(hot * 100), 400, hot)
    df = C.collocations(spark.createDataFrame(rows, DOCS).repartition(5), max_words, least, 60, 100, fragment_bytes, one_in)
    got = sorted(tuple(r) for r in df.collect())
    want = brute(rows, max_words, least, 60)
    assert got == want and len(want) > 30


def test_hot_prefixes(spark):
    rows = corpus(1, 200, 0.5)
    hot = C.hot_prefixes(spark.createDataFrame(rows, DOCS), 16, 5, 1)
    assert 0 < len(hot) <= 16 * 4 * 3 and (np.diff(hot.astype(object)) > 0).all()


def test_long_text_and_cover(spark):
    """One text of several chunks' bytes beside short ones; a looser cover rule."""
    rows = [(1, prose(1, 50) + " x y z " + " ".join(prose(k % 50, 40) for k in range(19000)), "en"), (2, "x y z, " * 200, "en")]
    assert len(rows[0][1]) > C.CHUNK_BYTES
    df = C.collocations(spark.createDataFrame(rows, DOCS), cover_percent=50, top=300)
    assert sorted(tuple(r) for r in df.collect()) == brute(rows, top=300, percent=50)


def test_exact_scores(spark):
    """Products beyond 64 bits, and a quotient just below a whole number."""
    big = 3_000_000_019
    grams = [("en", 0, "", 9 * 10**12), ("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 1), ("en", 1, "c", 10**12),
             ("en", 2, "b c", 1)]
    df = C.scored_phrases(spark.createDataFrame(grams, "lang string, words int, phrase string, a long"))
    got = {r.phrase: r.score for r in df.collect()}
    assert got == {"a b": 1000 * (big - 1) * 9 * 10**12 // (big * big), "b c": 1000 * 9 * 10**12 // (big * 10**12)}


def test_empty_and_clashes(spark):
    assert C.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "few words", "en")], DOCS)).collect() == []
    odd = spark.createDataFrame([("p q " * 150, "en", "x", "y", 1)], "text string, lang string, phrase string, `a.b` string, fragment int")
    assert [(r.phrase, r.a) for r in C.collocations(odd).collect()] == [r[2:4] for r in brute([(0, "p q " * 150, "en")])]
