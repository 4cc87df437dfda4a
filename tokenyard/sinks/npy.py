"""K2: token datasets as ``.npy`` files, a part of many blocks each, and blocks from such files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assembly import blocks_of
from ..operators.windows import SHARD_BLOCKS
from .tables import write_parquet
from ..sources.npy import WIDTHS, npy_header, read_npy

#: Blocks of one file: 64 blocks of 64 Ki tokens of 16 bits are 8 MiB.
FILE_BLOCKS = 64


def write_npy(blocks: DataFrame, path: str, bits: int, file_blocks: int = FILE_BLOCKS) -> None:
    """Write the blocks of a dataset as ``path``/part=NNNNNNNNNN/..., each a valid ``.npy`` file of ``bits``-bit ids, in
    the order of their paths. The text sink writes the bytes as they are, and a newline that readers of the format ignore
    as it lies beyond the stated number of tokens."""
    width = bits // 8
    if f"<u{width}" not in WIDTHS:
        raise ValueError("bits must be 16, 32 or 64")

    def join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("block_id").to_numpy())
        ids = table.column("ids").combine_chunks().take(pa.array(order)).flatten().to_numpy()
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < 1 << min(bits, 63):
            raise ValueError(f"a token id does not fit {bits} bits")
        body = npy_header(len(ids), width) + ids.astype(f"<u{width}").tobytes()
        return pa.table({"part": pa.array([key[0].as_py()]), "body": pa.array([body], pa.binary())})

    part = F.lpad((F.col("block_id") / file_blocks).cast("long").cast("string"), 10, "0").alias("part")
    bodies = blocks.select(part, "block_id", "ids").groupBy("part").applyInArrow(join, "part string, body binary")
    bodies.select("part", F.col("body").cast("string").alias("value")).write.partitionBy("part").option(
        "lineSep", "\n").text(path)


def blocks_from_npy(spark: SparkSession, npy_path: str, path: str, block_size: int = 1 << 16, halo: int = 1024,
                    shard_blocks: int = SHARD_BLOCKS) -> int:
    """The block dataset of ``.npy`` files, for all readers of blocks; returns the token count. Zero tokens is an error."""
    rows, total = read_npy(spark, npy_path)
    if total == 0:
        raise ValueError("the input holds no tokens")
    small = F.when(F.array_max("ids") < 1 << 31, F.col("ids")).otherwise(
        F.raise_error(F.lit("a token id of 2**31 or more does not fit a block")).cast("array<long>"))
    placed = rows.select("lo", small.cast("array<int>").alias("ids"))
    blocks = blocks_of(placed, total, block_size, halo, shard_blocks)
    write_parquet(blocks.sortWithinPartitions("shard", "block_id"), path, partition_by=["shard"], large_rows=True)
    return total
