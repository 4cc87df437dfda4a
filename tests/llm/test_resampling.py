"""Importance resampling against a plain version: features, gains, weights, scores, and the ranks of the draw."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import DOC, make_docs, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm import resampling as R

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_n=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % R.BUCKETS for g in grams]


def brute(docs, target, percent=10, max_n=1, min_words=20, seed=2024):
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(features(text, max_n)[1])
    for text in target:
        t.update(features(text, max_n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + R.BUCKETS) / ((s[b] + 1) * (T + R.BUCKETS))))
            for b in range(R.BUCKETS)]
    rows = []
    for i, text in docs:
        n, found = features(text, max_n)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, n, len(found), weight, score))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    rank = collections.defaultdict(list)
    for k, r in enumerate(able[:len(able) * percent // 100]):
        rank[r].append(k + 1)
    out = collections.Counter()
    for r in rows:
        out[(*r, rank[r].pop(0) if r[1] >= min_words and rank[r] else None)] += 1
    return out


def got(df):
    return collections.Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in df.collect())


@pytest.mark.parametrize("percent,max_n", [(10, 1), (40, 3)])
def test_resample(spark, make_docs, odd_rows, percent, max_n):  # noqa: F811
    rows = odd_rows + [(100 + k, prose(k % 40, 15 + k % 30)) for k in range(150)] + [(300, prose(77, 60000))]
    target = [prose(k, 25) for k in range(0, 40, 5)] + [None, ""]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    df = R.resample(make_docs(rows), bench, percent, max_n)
    assert got(df) == brute(rows, target, percent, max_n)


def test_ties_and_repeats(spark, make_docs):  # noqa: F811
    """A third of all rows is one row, and ids repeat with other texts: ranks have no gap and no double."""
    rows = [(7, prose(1, 30))] * 50 + [(7, prose(2, 31)), (None, prose(3, 40))] + [(k, prose(k, 22)) for k in range(100, 200)]
    df = R.resample(make_docs(rows), spark.createDataFrame([(prose(2, 30),)], "text string"), 50)
    assert got(df) == brute(rows, [prose(2, 30)], 50)
    assert sorted(r.rank for r in df.where("rank IS NOT NULL").collect()) == list(range(1, 77))


def test_empty_and_clashes(spark, make_docs):  # noqa: F811
    none = make_docs([]).where("false")
    bench = spark.createDataFrame([], "text string")
    assert R.resample(none, bench).count() == 0
    odd = make_docs([(1, prose(1, 30)), (2, None)]).select(
        "doc_id", "text", *[F.lit(c).alias(c) for c in ("rank", "weight", "key", "row", "n_words", "a.b", "rest")])
    out = R.resample(odd, bench, 100).collect()
    assert {(r.doc_id, r.rank) for r in out} == {(1, 1), (2, None)}
    assert all(r.rest["rank"] == "rank" and r.rest["a.b"] == "a.b" and r.rest["rest"] == "rest" for r in out)


@pytest.mark.parametrize("pivots", [1, 31])
def test_kth_key(spark, pivots):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 30, 300).tolist()
    rows = spark.createDataFrame([(v, k if k % 7 else None, k) for k, v in enumerate(values)], "a long, b long, c long")
    keyed = rows.select(F.struct("a", "b", "c").alias("key"))
    want = sorted(((v, (k % 7 != 0, k if k % 7 else 0), k) for k, v in enumerate(values)), reverse=True)
    for k in (1, 2, 150, 300):
        a, b, c = R.kth_key(keyed, k, pivots)
        assert (a, (b is not None, b or 0), c) == want[k - 1]
    assert R.kth_key(keyed, 0) is None
    with pytest.raises(ValueError):
        R.kth_key(keyed, 301, pivots)


def test_span_crc32():
    words = [b"", b"a", b"xyz", b"q" * 48, b"r" * 49, b"s" * 500, "é漢".encode(), b"the"] * 3
    data, offsets = A.utf8(pa.array([w.decode() for w in words]))
    assert R.span_crc32(data, offsets[:-1], offsets[1:]).tolist() == [zlib.crc32(w) for w in words]
