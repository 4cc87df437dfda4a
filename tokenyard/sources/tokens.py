"""A written token dataset (the K2 layout) read lazily with Parquet pushdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import SHARD_BLOCKS


def read_token_blocks(spark: SparkSession, path: str, first_block: int | None = None, last_block: int | None = None,
                      shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``(block_id, start, ids, tail, shard)``; a block range prunes shard folders and row groups."""
    df = spark.read.parquet(path)
    if first_block is not None:
        df = df.filter((F.col("shard") >= first_block // shard_blocks) & (F.col("block_id") >= first_block))
    if last_block is not None:
        df = df.filter((F.col("shard") <= last_block // shard_blocks) & (F.col("block_id") <= last_block))
    return df
