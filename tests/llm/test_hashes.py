"""Texts that a polynomial hash modulo 2**64 cannot tell apart (Thue-Morse strings) are told apart."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import make_docs, prose  # noqa: F401

from tokenyard.llm import arrays as A
from tokenyard.llm import ctw, fingerprints, ngram_join


def thue_morse(n: int) -> tuple[str, str]:
    line = "a"
    while len(line) < n:
        line += line.translate(str.maketrans("ab", "ba"))
    return line, line.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_span_hashes(n):
    one, other = thue_morse(n)
    data, offsets = A.utf8(pa.array([one, other, "x" + one, one]))
    h = A.span_hashes(data, offsets[:-1], offsets[1:])
    assert h[0] == h[3] and h[0] != h[1]
    assert A.span_hashes(data, offsets[2:3] + 1, offsets[3:4])[0] == h[0]  # wherever it stands


@pytest.mark.parametrize("which", [0, 1])
def test_residues(which):
    """Against big integers."""
    rng = np.random.default_rng(which)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.array([0, 1, 17, 4000, 300])
    ends = np.array([5000, 1, 900, 4999, 301])
    base = A._PRIME_BASES[which]
    want = [sum(int(A._RESIDUE[c]) * pow(base, k, A._PRIME) for k, c in enumerate(data[a:b].tolist())) % A._PRIME
            for a, b in zip(starts, ends)]
    assert A.span_residues(data, starts, ends, which).tolist() == want


def test_operators(make_docs):  # noqa: F811
    one, other = thue_morse(2048)
    rows = [(1, one), (2, other), (3, one), (4, one + "\n" + other), (5, prose(1, 20))]
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(make_docs(rows)).collect()}
    assert prints[1] == prints[3] and len(set(prints.values())) == 4
    linked = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(make_docs(rows)).collect()}
    assert linked == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    assert sorted(r.doc_id for r in ngram_join.one_of_each(make_docs(rows)).collect()) == [1, 2, 4, 5]
    held = [k for k in range(900, 999) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    scored = {r.doc_id: r.n_known for r in ctw.score_documents(
        make_docs([(k, one + " x") for k in range(10)] + [(held[0], one), (held[1], other)])).collect()}
    assert (scored[held[0]], scored[held[1]]) == (2, 1)  # the word and the end; the end only
