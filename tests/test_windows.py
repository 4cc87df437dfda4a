import pytest
import math

from pyspark.sql import functions as F

from tokenyard.operators.windows import (
    global_offsets,
    lm_windows_all,
    lm_windows_sampled,
    sample_starts,
    token_blocks,
)


def _docs(spark, sizes):
    rows, nxt = [], 0
    for d, n in enumerate(sizes):
        rows.append((d, list(range(nxt, nxt + n))))
        nxt += n
    return spark.createDataFrame(rows, "doc_id long, ids array<int>"), nxt


def test_global_offsets_two_levels(spark):
    sizes = [5, 0, 3, 17, 1, 9, 2, 30, 4]
    df = spark.createDataFrame([(i * 10, n) for i, n in enumerate(sizes)], "doc_id long, n long")
    got = {r.doc_id: r.offset for r in global_offsets(df, "doc_id", "n", partitions=3).collect()}
    acc = 0
    for i, n in enumerate(sizes):
        assert got[i * 10] == acc
        acc += n


def test_blocks_reassemble_stream(spark):
    td, n = _docs(spark, [7, 1, 40, 3, 25, 12])
    blocks = token_blocks(td, block_size=16, halo=5).orderBy("block_id").collect()
    stream = [t for b in blocks for t in b.ids]
    assert stream == list(range(n))
    for b in blocks:
        assert b.start == b.block_id * 16
        assert list(b.tail) == list(range(b.start + 16, min(b.start + 21, n)))


def test_all_windows_shifted_by_one(spark):
    td, n = _docs(spark, [100])
    blocks = token_blocks(td, block_size=16, halo=8)
    rows = lm_windows_all(blocks, n, 7, 1).collect()
    starts = sorted(r.start for r in rows)
    assert starts == list(range(0, n - 7))  # 0 .. 92
    for r in rows:
        assert list(r.x) == list(range(r.start, r.start + 7))
        assert list(r.y) == [v + 1 for v in r.x]


def test_sampled_windows_uniform_and_in_bounds(spark):
    td, n = _docs(spark, [60, 40])
    blocks = token_blocks(td, block_size=32, halo=8)
    num = 20000
    starts = sample_starts(spark, num, n, 7, seed=3)
    rows = lm_windows_sampled(blocks, starts, num, 32, 7).collect()
    assert len(rows) == num
    counts = [0] * (n - 7)
    for r in rows:
        assert 0 <= r.start < n - 7
        assert list(r.x) == list(range(r.start, r.start + 7))
        assert list(r.y) == [v + 1 for v in r.x]
        counts[r.start] += 1
    mean = num / (n - 7)
    sd = math.sqrt(mean * (1 - 1 / (n - 7)))
    assert all(abs(c - mean) < 5 * sd for c in counts)
    assert counts[0] > 0 and counts[-1] > 0


def test_sampling_repeatable_across_partitioning(spark):
    a = sample_starts(spark, 1000, 10**9, 64, seed=11).collect()
    b = sample_starts(spark, 1000, 10**9, 64, seed=11).repartition(7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    c = sample_starts(spark, 1000, 10**9, 64, seed=12).collect()
    assert sorted(map(tuple, a)) != sorted(map(tuple, c))
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_sampled_windows_read_only_their_shards(spark, tmp_out):
    import os

    from tokenyard.sinks.tokens import write_tokens
    from tokenyard.sources.tokens import read_token_blocks

    td, n = _docs(spark, [50, 70, 80])
    path = os.path.join(tmp_out, "blocks")
    assert write_tokens(td, path, block_size=8, halo=8, shard_blocks=4) == n
    assert len([d for d in os.listdir(path) if d.startswith("shard=")]) == -(-n // (8 * 4))
    blocks = read_token_blocks(spark, path)
    starts = spark.createDataFrame([(0, 5), (1, 190)], "sample_id long, start long")
    w = lm_windows_sampled(blocks, starts, 2, 8, 7, shard_blocks=4)
    plan = w._jdf.queryExecution().executedPlan().toString()
    import re

    assert re.search(r"PartitionFilters: \[shard#\d+ IN \(0,5\)\]", plan), plan
    got = {r.sample_id: list(r.x) for r in w.collect()}
    assert got == {0: list(range(5, 12)), 1: list(range(190, 197))}


def test_window_longer_than_halo_is_an_error(spark):
    import pytest

    td, n = _docs(spark, [40])
    blocks = token_blocks(td, block_size=8, halo=4)
    with pytest.raises(Exception):
        lm_windows_all(blocks, n, 7, 1).collect()


def test_global_offsets_with_sampled_range_bounds(spark):
    import random

    rng = random.Random(3)
    rows = [(i * 7 + rng.randint(0, 6), rng.randint(0, 50)) for i in range(20000)]
    df = spark.createDataFrame(rows, "doc_id long, n long").repartition(13)
    got = sorted((r.doc_id, r.offset) for r in global_offsets(df, "doc_id", "n", partitions=8).collect())
    acc, want = 0, []
    for d, n in sorted(rows):
        want.append((d, acc))
        acc += n
    assert got == want


def test_blocks_from_written_table_with_many_docs(spark, tmp_out):
    import os
    import random

    rng = random.Random(5)
    rows, nxt = [], 0
    for d in range(20000):
        k = rng.randint(0, 12)
        rows.append((d, list(range(nxt, nxt + k))))
        nxt += k
    path = os.path.join(tmp_out, "docs")
    spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(7).write.parquet(path)
    td = spark.read.parquet(path)
    blocks = token_blocks(td, block_size=64, halo=8).orderBy("block_id").collect()
    assert [t for b in blocks for t in b.ids] == list(range(nxt))
    assert all(len(b.ids) == 64 for b in blocks[:-1])


def test_blocks_exact_block_docs_and_full_halo(spark):
    td, n = _docs(spark, [16, 16, 5, 11])
    blocks = token_blocks(td, block_size=16, halo=16).orderBy("block_id").collect()
    assert [list(b.ids) for b in blocks] == [list(range(0, 16)), list(range(16, 32)), list(range(32, 48))]
    assert [list(b.tail) for b in blocks] == [list(range(16, 32)), list(range(32, 48)), []]
    rows = lm_windows_all(token_blocks(td, block_size=16, halo=16), n, 16, 16).collect()
    assert sorted(r.start for r in rows) == [0, 16]


@pytest.mark.parametrize("stride", [1, 3, 7, 10])
def test_windows_in_small_chunks(spark, monkeypatch, stride):
    import tokenyard.operators.windows as windows

    monkeypatch.setattr(windows, "CHUNK_WINDOW_TOKENS", 21)
    td, n = _docs(spark, [50, 1, 120, 30])
    rows = lm_windows_all(token_blocks(td, block_size=32, halo=16), n, 7, stride).collect()
    assert sorted(r.start for r in rows) == list(range(0, n - 7, stride))
    assert all(list(r.x) == list(range(r.start, r.start + 7)) and list(r.y) == [v + 1 for v in r.x] for r in rows)
