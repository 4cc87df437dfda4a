"""``.npy`` files against numpy, at several split sizes and integer widths."""

import glob

import numpy as np
import pytest

from tokenyard.session import sql_conf
from tokenyard.sinks.npy import blocks_from_npy, write_npy
from tokenyard.sources.npy import npy_header, parse_header, read_npy
from tokenyard.sources.tokens import read_token_blocks


@pytest.mark.parametrize("kind", ["<u2", "<u4", "<u8"])
def test_read_in_parallel(spark, tmp_path, kind):
    """Files of numpy, with newline bytes within tokens and at borders, some empty; trailing bytes ignored."""
    rng = np.random.default_rng(3)
    top = {"<u2": 1 << 16, "<u4": 1 << 31, "<u8": 1 << 31}[kind]
    files = [rng.integers(0, top, 5000), np.zeros(0), np.full(300, 10), rng.integers(0, 300, 4001), np.array([2570, 10, 0])]
    (tmp_path / "in").mkdir()
    for k, ids in enumerate(files):
        np.save(tmp_path / "in" / f"f{k}.npy", ids.astype(kind))
    with open(tmp_path / "in" / "f4.npy", "ab") as f:
        f.write(b"\nextra bytes\n")
    want = np.concatenate(files).astype(np.int64).tolist()
    for size in (300, 1001, 1 << 20):
        with sql_conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1"):
            rows, total = read_npy(spark, str(tmp_path / "in"))
            got = sorted((r.lo, list(r.ids)) for r in rows.collect())
            assert total == len(want) and [i for _, ids in got for i in ids] == want
            assert all(a + len(ids) == b for (a, ids), (b, _) in zip(got, got[1:]))
            assert blocks_from_npy(spark, str(tmp_path / "in"), str(tmp_path / f"blocks{size}"), 100, 10) == len(want)
        blocks = sorted(read_token_blocks(spark, str(tmp_path / f"blocks{size}")).collect(), key=lambda b: b.block_id)
        assert [i for b in blocks for i in b.ids] == want
        assert all(list(b.tail) == want[b.start + 100:b.start + 110] for b in blocks)


@pytest.mark.parametrize("bits", [16, 32, 64])
def test_write_parts(spark, tmp_out, bits):
    stream = np.random.default_rng(bits).integers(0, 60000, 1050)
    rows = [(b, stream[b * 50:b * 50 + 50].tolist()) for b in range(21)]
    blocks = spark.createDataFrame(rows, "block_id long, ids array<int>").repartition(3)
    write_npy(blocks, f"{tmp_out}/npy", bits, file_blocks=4)
    parts = [np.load(f) for f in sorted(glob.glob(f"{tmp_out}/npy/part=*/part-*"))]
    assert len(parts) == 6 and all(p.dtype == np.dtype(f"<u{bits // 8}") for p in parts)
    assert np.concatenate(parts).tolist() == stream.tolist()
    mapped = [np.load(f, mmap_mode="r") for f in sorted(glob.glob(f"{tmp_out}/npy/part=*/part-*"))]
    assert sum(len(m) for m in mapped) == 1050
    got, total = read_npy(spark, f"{tmp_out}/npy")
    assert total == 1050 and [i for _, ids in sorted((r.lo, list(r.ids)) for r in got.collect()) for i in ids] == stream.tolist()


def test_errors(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.zeros((2, 3), np.uint16))
    with pytest.raises(Exception, match="not a .npy file"):
        read_npy(spark, str(tmp_path))
    with pytest.raises(Exception, match="does not fit"):
        write_npy(spark.createDataFrame([(0, [70000])], "block_id long, ids array<int>"), str(tmp_path / "x"), 16)
    assert parse_header(npy_header(12345, 4)) == (4, 12345, 128)
