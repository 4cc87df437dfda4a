"""Registered queries: SQL where there is some; the pipeline stage by stage against independent versions."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from test_pairs import brute_components, brute_removed

import corpus_pipeline
from tokenyard.llm import mixing
from tokenyard.llm.common import staged
from tokenyard.llm.oracle import ORACLES
from tokenyard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("benchmark", "conversations", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(str, want))


def test_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), f"test-{name}"))
    assert all(d.columns == docs.columns for d in out[:-1])
    rows = [[(r.doc_id, r.text or "") for r in d.collect()] for d in out[:-1]]

    kept = dict(rows[1])
    short = {d for d, t in given.items() if len(re.findall(r"[^\x20\x09-\x0D]+", t)) < 50}
    assert not short & set(kept) and all(kept[d] == given[d] for d in kept)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    failed = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, SF).where("base_failed").collect()}
    assert good & set(given) <= set(kept) | failed

    least = {d: c for d, _, c in brute_components(rows[1])}
    assert sorted(d for d, _ in rows[2]) == sorted(d for d in least if least[d] == d)

    units = [t.encode() for _, t in rows[2]]
    cut = {d: bytes(np.frombuffer(u, np.uint8)[~m]).decode("utf-8", "ignore")
           for (d, _), u, m in zip(rows[2], units, brute_removed(rows[2], units, 50))}
    assert dict(rows[3]) == cut

    source = {r.doc_id: r.source for r in docs.collect()}
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in rows[3]}
    size = collections.Counter()
    for d, n in words.items():
        size[source[d]] += n
    names = sorted(size)
    target = dict(zip(names, mixing.water_fill([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)))
    times = collections.Counter(d for d, _ in rows[4])
    taken = collections.Counter()
    for d, k in times.items():
        taken[source[d]] += k * words[d]
    assert max(times.values()) <= 3 and all(t == cut[d] for d, t in rows[4])
    for s in names:  # off by less than the smallest document that was left out
        left = [words[d] for d in words if source[d] == s and times[d] < 3 and words[d]]
        assert target[s] - max(left, default=0) <= taken[s] <= target[s] + 1e-6

    tok = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    want = collections.Counter()
    for d, t in rows[4]:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            want[d, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())] += 1
    packed = out[-1].collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    fill = collections.Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) * 1.1 + 1
