import collections
import random

import pytest

from brute import learn
from tokenyard.functions.text import DEFAULT_SPECIAL
from tokenyard.operators.bpe import train_bpe
from tokenyard.operators.commits import Candidate, commit_overlapping
from tokenyard.operators.counts import best_pair, pair_counts, word_tokens

SAMPLE = (
    "low low low low low lower lower widest widest widest newest newest newest newest newest newest\n"
    "the cat sat on the mat. the dog sat on the log; aaa aaaa aaaaa\n"
)


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_greedy_overlapping_pair_counts(spark):
    wf = spark.createDataFrame([("aaa", 1)], "word string, freq long")
    pc = {(r.left, r.right): r.n for r in pair_counts(word_tokens(wf)).collect()}
    assert pc == {("61", "61"): 2}
    m = train_bpe(_docs(spark, ["aaa"]), 257, [])
    assert m.merges == [(b"a", b"a")]


def test_tie_break_greatest_pair(spark):
    wf = spark.createDataFrame([("ab", 1), ("cd", 1)], "word string, freq long")
    b = best_pair(pair_counts(word_tokens(wf))).first()
    assert (b.left, b.right, b.n) == ("63", "64", 1)


@pytest.mark.parametrize("k,incremental", [(2, False), (64, False), (2, True), (64, True)])
def test_rounds_equal_one_by_one_on_sample(spark, k, incremental):
    texts = [SAMPLE, SAMPLE.upper() + DEFAULT_SPECIAL + SAMPLE]
    size = 256 + 1 + (12 if incremental and k == 2 else 40)
    want = learn(texts, size, [DEFAULT_SPECIAL])
    m = train_bpe(_docs(spark, texts), size, [DEFAULT_SPECIAL], candidates=k, incremental=incremental, checkpoint_every=3)
    assert m.merges == want
    assert len(m.vocab) == 256 + 1 + len(want)
    assert m.vocab[256] == DEFAULT_SPECIAL.encode()
    assert m.vocab[257] == want[0][0] + want[0][1]


@pytest.mark.parametrize("incremental", [False, True])
def test_rounds_equal_one_by_one_on_random_corpora(spark, incremental):
    rng = random.Random(7)
    for trial in range(2 if incremental else 4):
        alphabet = "abcd"[: 2 + trial % 3] + " "
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 120))) for _ in range(5)]
        want = learn(texts, 256 + 25, [])
        got = train_bpe(_docs(spark, texts), 256 + 25, [], candidates=16, incremental=incremental).merges
        assert got == want, (trial, texts)


def test_stops_when_no_pair_left(spark):
    m = train_bpe(_docs(spark, ["ab"]), 300, [])
    assert m.merges == [(b"a", b"b")]


def test_learned_from_documents_table(spark):
    from conftest import SF_SMALL
    from tokenyard.sources.tables import table

    docs = table(spark, SF_SMALL, "documents").select("text")
    m = train_bpe(docs, 256 + 1 + 12, [DEFAULT_SPECIAL], incremental=True, checkpoint_every=2)
    texts = [r.text for r in docs.collect()]
    assert m.merges == learn(texts, 256 + 1 + 12, [DEFAULT_SPECIAL])


def _committed(candidates, existing=(), k=None, floor=1):
    return commit_overlapping(candidates, k or len(candidates) + 1, floor, set(existing), 99)


def test_commit_rules():
    # the second pair overlaps the first, and what it loses is not known: stop
    c = [Candidate("61", "62", 10), Candidate("62", "63", 9)]
    assert _committed(c, floor=9) == [("61", "62")]
    # known: it loses 2 and keeps 7, and the new pair (ab, c) counts 2: all in this order
    c = [Candidate("61", "62", 10, {}, {"63": 2}), Candidate("62", "63", 9, {"61": 2}, {})]
    assert _committed(c) == [("61", "62"), ("62", "63"), ("6162", "63")]
    # the new pair (ab, c) outdoes what is left of (b, c)
    c = [Candidate("61", "62", 10, {}, {"63": 6}), Candidate("62", "63", 9, {"61": 6}, {})]
    assert _committed(c)[:2] == [("61", "62"), ("6162", "63")]
    # a tie with the greater bytes is certain only if both counts are
    c = [Candidate("61", "62", 10, {}, {}), Candidate("64", "65", 9), Candidate("63", "65", 9)]
    assert _committed(c) == [("61", "62"), ("64", "65"), ("63", "65")]
    # pairs that are not listed may count as much as the last one that is
    assert _committed(c, k=3) == [("61", "62")]
    # duplicate bytes of an existing token: committed alone when first, stop before otherwise
    c = [Candidate("61", "62", 10), Candidate("63", "64", 9)]
    assert _committed(c, {"6162"}) == [("61", "62")]
    assert _committed(c, {"6364"}) == [("61", "62")]


def _merge(word, a, b):
    out, i = [], 0
    while i < len(word):
        if word[i:i + 2] == (a, b):
            out.append(a + b)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return tuple(out)


def _merged(words, a, b):
    out = collections.Counter()
    for w, f in words.items():
        out[_merge(w, a, b)] += f
    return out


def _pair_counts(words):
    out = collections.Counter()
    for w, f in words.items():
        for pair in zip(w, w[1:]):
            out[pair] += f
    return out


def _by_rounds(words, m, k, floor_of):
    """Learn m merges by rounds without Spark: (merges, rounds)."""
    existing, out, rounds, floor = {t for w in words for t in w}, [], 0, 1
    while len(out) < m and (count := _pair_counts(words)):
        top = sorted(count.items(), key=lambda t: (t[1], t[0]), reverse=True)[:k]
        before, after = (collections.defaultdict(collections.Counter) for _ in range(2))
        for w, f in words.items():
            for i in range(len(w) - 1):
                if i:
                    before[w[i:i + 2]][w[i - 1]] += f
                if i + 2 < len(w):
                    after[w[i:i + 2]][w[i + 2]] += f
        best = [Candidate(*p, n, *({t: c for t, c in side[p].items() if c >= floor} for side in (before, after))) for p, n in top]
        for pair in commit_overlapping(best, k, floor, existing, m - len(out)):
            words = _merged(words, *pair)
            existing.add("".join(pair))
            out.append(pair)
        rounds, floor = rounds + 1, floor_of(top[-1][1])
    return out, rounds


def _one_by_one(words, m):
    out = []
    while len(out) < m and (count := _pair_counts(words)):
        out.append(max(count, key=lambda p: (count[p], p)))
        words = _merged(words, *out[-1])
    return out


def test_overlapping_commits_equal_one_by_one():
    """Random words with runs, ties and overlaps, few and many candidates, neighbours cut off or all."""
    rng = random.Random(3)
    for trial in range(400):
        letters = "abcdef"[:rng.randint(1, 6)]
        words = collections.Counter()
        for _ in range(rng.randint(1, 12)):
            words[tuple(rng.choice(letters) for _ in range(rng.randint(2, 14)))] += rng.randint(1, 9)
        m, k = rng.randint(1, 25), rng.choice([1, 2, 3, 5, 8, 64])
        floor_of = rng.choice([lambda n: 1, lambda n: max(1, n // 2), lambda n: n + 2])
        assert _by_rounds(words, m, k, floor_of)[0] == _one_by_one(words, m), (trial, words, k)


def test_few_rounds_on_prose(spark):
    """243 merges over the words of the documents: a ninth of the rounds of one by one, the same merges."""
    from conftest import SF_SMALL
    from tokenyard.operators.counts import pretoken_counts
    from tokenyard.sources.tables import table

    freq = pretoken_counts(table(spark, SF_SMALL, "documents").select("text")).collect()
    words = collections.Counter({tuple(chr(b) for b in r.word.encode()): r.freq for r in freq})
    merges, rounds = _by_rounds(words, 243, 32, lambda n: max(1, n // 256))
    assert len(merges) == 243 and rounds <= 27
    assert merges[:30] == _one_by_one(words, 30)


def test_random_mixed_corpora_with_specials_both_modes(spark):
    rng = random.Random(11)
    pieces = ["the", " the", "th", "e", "é", "ß", "12", " ", "  ", "\n", "\n\n", ",", "'s", "aa", "ab", "ba", DEFAULT_SPECIAL]
    for trial in range(2):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(10, 60))) for _ in range(4)]
        target = 256 + 1 + 18
        want = learn(texts, target, [DEFAULT_SPECIAL])
        for incremental in (False, True):
            got = train_bpe(_docs(spark, texts), target, [DEFAULT_SPECIAL], candidates=8, incremental=incremental,
                            checkpoint_every=2).merges
            assert got == want, (trial, incremental, texts)


def test_empty_corpus_learns_nothing(spark):
    m = train_bpe(_docs(spark, []), 300, [DEFAULT_SPECIAL])
    assert m.merges == [] and len(m.vocab) == 257
