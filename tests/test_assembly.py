"""Blocks assembled from stretches, against the whole stream in memory; files at several split sizes."""

import random

import pytest
from pyspark.sql import functions as F

from brute import encode as brute_encode
from test_io import _tok
from tokenyard.operators import assembly
from tokenyard.plans.prepare import encode_files
from tokenyard.session import sql_conf
from tokenyard.sinks.tables import materialize
from tokenyard.sinks.tokens import write_tokens
from tokenyard.sources.tokens import read_token_blocks


def _check(blocks, stream, B, H):
    rows = sorted(blocks.collect(), key=lambda r: r.block_id)
    assert [r.block_id for r in rows] == list(range(-(-len(stream) // B)))
    for r in rows:
        assert r.start == r.block_id * B
        assert list(r.ids) == stream[r.start:r.start + B]
        assert list(r.tail) == stream[r.start + B:r.start + B + H]


@pytest.mark.parametrize("B,H,chunk_blocks", [(16, 5, 3), (16, 16, 1), (7, 1, 32), (64, 20, 2)])
def test_blocks_from_stretches(spark, monkeypatch, B, H, chunk_blocks):
    monkeypatch.setattr(assembly, "CHUNK_BLOCKS", chunk_blocks)
    rng, rows, stream = random.Random(B), [], []
    for file in ("a", "b", "c"):
        for split in range(0, 40, 10):
            for _ in range(rng.randrange(4)):  # some stretches hold nothing
                ids = [rng.randrange(1000) for _ in range(rng.choice([0, 1, 3, 30, 200]))]
                rows.append((file, split, ids))
                stream += ids
    df = spark.createDataFrame(rows, "file string, split long, ids array<int>").coalesce(1)
    chunks = materialize(assembly.token_chunks(df, B), "test-chunks")
    assert max(len(r.ids) for r in chunks.collect()) <= chunk_blocks * B
    _check(assembly.assemble_blocks(chunks, len(stream), B, H, 4), stream, B, H)


def test_only_borders_move(spark):
    """A stretch of many blocks: the exchange holds pieces of the blocks at its ends."""
    stream = [k % 997 for k in range(40 * 64)]
    df = spark.createDataFrame([("f", 0, stream[:1500]), ("f", 1500, stream[1500:])], "file string, split long, ids array<int>")
    chunks = materialize(assembly.token_chunks(df.coalesce(1), 64), "test-chunks")
    blocks = assembly.assemble_blocks(chunks, len(stream), 64, 8, 4)
    _check(blocks, stream, 64, 8)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning(block_id" in x]
    assert len(moved) == 1  # the only exchange of arrays: ids and tail of border blocks


def test_write_tokens_in_order(spark, tmp_out):
    rng, rows = random.Random(4), []
    for d in range(200):
        rows.append((d * 3, [rng.randrange(300) for _ in range(rng.randrange(50))]))
    stream = [i for _, ids in rows for i in ids]
    rng.shuffle(rows)
    n = write_tokens(spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(5), f"{tmp_out}/ds", 100, 10)
    assert n == len(stream)
    _check(read_token_blocks(spark, f"{tmp_out}/ds"), stream, 100, 10)
    with pytest.raises(ValueError):
        write_tokens(spark.createDataFrame([(1, [])], "doc_id long, ids array<int>"), f"{tmp_out}/none")


def test_files_at_any_split_size(spark, tmp_path):
    tok, rng = _tok(), random.Random(9)
    (tmp_path / "in").mkdir()
    stream = []
    for name in ("a.txt", "b.txt", "c.txt", "d.txt"):
        lines = ["".join(rng.choice(["the ", " a", "x", "é", "<|endoftext|>", " "]) for _ in range(rng.randrange(30))) + "\n"
                 for _ in range({"a.txt": 100, "b.txt": 1, "c.txt": 0, "d.txt": 300}[name])]
        if name != "a.txt" and lines:
            lines[-1] = lines[-1][:-1] + "end"  # no newline at the end
        (tmp_path / "in" / name).write_text("".join(lines), encoding="utf-8")
        for line in lines:
            stream += brute_encode(line, tok.vocab, list(tok.merge_rank), tok.specials)
    for size in (100, 1000, 1 << 20):
        with sql_conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1"):
            count, bits = encode_files(spark, str(tmp_path / "in"), tok, str(tmp_path / f"out{size}"), 64, 16)
        assert (count, bits) == (len(stream), 16)
        _check(read_token_blocks(spark, str(tmp_path / f"out{size}")), stream, 64, 16)
