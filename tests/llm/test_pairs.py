"""N-gram join and both substring dedups against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm import ngram_join, pfp_dedup, phrase_dedup
from tokenyard.llm import recurring as R
from tokenyard.llm.graph import components

from llm_texts import make_docs, odd_rows, prose  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sets(rows, n=5):
    out = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute_components(rows, percent=80):
    s = sets(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(s[i] & s[j])
            if s[i] and s[j] and 100 * common >= percent * (len(s[i]) + len(s[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), doc) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(((doc, len(s[i]), least[find(i)] if s[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def near_copies():
    """A group of edited copies, some too far from the rest, and texts that share only a passage."""
    base = prose(20, 150).split(" ")
    rows = []
    for k in range(60):
        own = list(base)
        for e in range(k % 9):
            own[(k * 13 + e * 17) % 150] = f"edit{k}x{e}"
        rows.append((100 + k, " ".join(own)))
    passage = prose(21, 60)
    rows += [(200 + k, prose(30 + k, 10 + 3 * k) + " " + passage) for k in range(20)]
    return rows


@pytest.mark.parametrize("which", ["odd", "near"])
def test_components(make_docs, odd_rows, which):
    rows = odd_rows if which == "odd" else near_copies()
    got = ngram_join.jaccard_components(make_docs(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_one_of_each(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    component = {doc: least for doc, _, least in brute_components(odd_rows) if doc is not None}
    assert {r.doc_id for r in left.collect()} == {d for d in component if component[d] == d} | {None}


def test_one_of_each_decides_by_row(make_docs):
    base, other, third = prose(40, 120), prose(41, 120), prose(42, 120)
    rows = [(1, base), (2, other), (2, other), (2, other), (3, base), (3, prose(43, 120)), (None, base), (None, third),
            (None, third), (4, third + " more"), (5, prose(44, 90)), (5, prose(44, 90) + " end"), (6, None), (7, " "),
            (None, prose(45, 60)), (None, prose(45, 60)), (None, None)]
    left = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(make_docs(rows)).collect()), key=str)
    five = [r for r in left if r[0] == 5]
    assert len(five) == 1 and five[0] in rows
    want = [(1, base), (2, other), (3, prose(43, 120)), (4, third + " more"), (6, None), (7, " "), (None, prose(45, 60)), (None, None)]
    assert [r for r in left if r[0] != 5] == sorted(want, key=str)
    same = ngram_join.one_of_each(make_docs([(1, base), (2, other), (3, None)])).collect()
    assert len(same) == 3


def test_contraction(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 75), (7, 7), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), [50, 75, 100], [200, 201]]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(rows, units, span):
    first = {}
    for (doc, _), u in zip(rows, units):
        if doc is not None:
            for i in range(len(u) - span + 1):
                w = u[i:i + span]
                first[w] = min(first.get(w, doc), doc)
    out = []
    for (doc, _), u in zip(rows, units):
        mask = np.zeros(len(u), bool)
        if doc is not None:
            for i in range(len(u) - span + 1):
                if first[u[i:i + span]] < doc:
                    mask[i:i + span] = True
        out.append(mask)
    return out


def ranges(mask):
    edge = np.diff(np.concatenate([[0], mask.astype(int), [0]]))
    return [(int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


@pytest.mark.parametrize("which", ["odd", "near"])
def test_repeated_passages(make_docs, odd_rows, which):
    rows = odd_rows if which == "odd" else near_copies()
    units = [tuple(words(t)) for _, t in rows]
    want = sorted((str(d), len(u), ranges(m), " ".join(w for w, g in zip(u, m) if not g))
                  for (d, _), u, m in zip(rows, units, brute_removed(rows, units, 50)))
    got = phrase_dedup.remove_repeats(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, [(s.start, s.end) for s in r.spans], r.kept) for r in got) == want


@pytest.mark.parametrize("which", ["odd", "near"])
def test_repeated_bytes(make_docs, odd_rows, which):
    rows = odd_rows if which == "odd" else near_copies()
    units = [(t or "").encode() for _, t in rows]
    want = sorted((str(d), len(u), ranges(m), hashlib.sha256(bytes(np.frombuffer(u, np.uint8)[~m])).hexdigest())
                  for (d, _), u, m in zip(rows, units, brute_removed(rows, units, 50)))
    got = pfp_dedup.remove_repeats(make_docs(rows)).collect()
    assert sorted((str(r.rest.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans],
                   hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == want


def shared_passage(n=150):
    passage = prose(50, 30)
    return [(k, prose(100 + k, 12) + " " + passage + " " + prose(400 + k, 12)) for k in range(n)]


@pytest.mark.parametrize("which", ["odd", "near", "shared"])
def test_repeated_bytes_of_hot_triggers(make_docs, odd_rows, which):
    rows = {"odd": odd_rows, "near": near_copies(), "shared": shared_passage()}[which]
    units = [(t or "").encode() for _, t in rows]
    want = sorted((str(d), ranges(m)) for (d, _), m in zip(rows, brute_removed(rows, units, 50)))
    for hot_phrases in (1, 3):
        got = pfp_dedup.remove_repeats(make_docs(rows), sample=1, hot_phrases=hot_phrases).collect()
        assert sorted((str(r.rest.doc_id), [(s.start, s.end) for s in r.spans]) for r in got) == want


def test_hot_triggers_are_spread(make_docs):
    rows = shared_passage()
    live = R.with_shared_anchors(make_docs(rows), R.byte_units, pfp_dedup.TRIGGER, 50).where("anchors IS NOT NULL")
    hot = pfp_dedup.hot_triggers(live, 50, 1, 20)
    batches = live.select("doc_id", "text", "anchors").toArrow().combine_chunks().to_batches()
    most = []
    for dealt in (pfp_dedup._deal(iter(batches), 1 << 16, 50), pfp_dedup._deal(iter(batches), 1 << 16, 50, hot)):
        parts = {}
        for b in dealt:
            for part, windows in zip(b.column("part").to_pylist(), b.column("windows").to_pylist()):
                if part >= 0:
                    parts[part] = parts.get(part, 0) + sum(windows)
        most.append(max(parts.values()))
    assert len(hot) >= 2 and most[0] > 10 * most[1]


def test_texts_without_repeats(make_docs, odd_rows):
    docs = make_docs(odd_rows).withColumn("rest", F.lit(1)).withColumn("anchors", F.lit("a")).withColumn("row", F.lit(2))
    out = pfp_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(odd_rows) and {(r.rest, r.anchors, r.row) for r in rows} == {(1, "a", 2)}
    assert next(r for r in rows if r.doc_id == 0).text is None
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert next(r for r in rows if r.doc_id == 13).text == ""


def test_dedup_of_nothing(make_docs):
    empty = make_docs([])
    assert ngram_join.jaccard_components(empty).count() == 0
    assert phrase_dedup.remove_repeats(empty).count() == 0
    assert pfp_dedup.remove_repeats(empty).count() == 0


def test_window_order():
    text = np.frombuffer(b"banana-banana-band", np.uint8)
    order, new = pfp_dedup.window_order(text, np.arange(len(text) - 3), 4)
    strings = [bytes(text[i:i + 4]) for i in order]
    assert strings == sorted(strings)
    assert [i for i in range(len(strings)) if i == 0 or strings[i] != strings[i - 1]] == np.flatnonzero(new).tolist()


def test_rolling_hashes_follow_content():
    data = np.frombuffer(b"abcXabcYabc", np.uint8)
    assert len(set(A.span_hashes(data, np.array([0, 4, 8]), np.array([3, 7, 11])).tolist())) == 1
    runs = A.run_hashes(A._BYTE[data], 3)
    assert runs[0] == runs[4] == runs[8] and len(set(runs.tolist())) == 7
