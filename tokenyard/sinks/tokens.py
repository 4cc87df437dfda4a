"""K2: write an ordered token dataset (blocks) and report its size; zero tokens is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.assembly import assemble_blocks, ordered_stretches, token_chunks
from ..operators.windows import SHARD_BLOCKS
from .tables import materialize, write_parquet


def write_tokens(token_docs: DataFrame, path: str, block_size: int = 1 << 16, halo: int = 1024, order_col: str = "doc_id",
                 shard_blocks: int = SHARD_BLOCKS) -> int:
    """Encode-once dataset writer: token documents -> Parquet blocks at ``path``; returns the count.

    ``token_docs`` is written to the shared checkpoint folder first, so the Python encoder runs once. Its rows are then
    dealt to ranges of ``order_col``, which is the one exchange of token arrays; blocks are assembled in the ranges.
    """
    docs = materialize(token_docs.select(order_col, "ids"), "token_docs", large_rows=True)
    return write_stretches(ordered_stretches(docs, order_col), path, block_size, halo, shard_blocks)


def write_stretches(rows: DataFrame, path: str, block_size: int = 1 << 16, halo: int = 1024,
                    shard_blocks: int = SHARD_BLOCKS) -> int:
    """Blocks at ``path`` from rows ``(file, split, ids)`` that come in order within each stretch ``(file, split)``, as an
    encoded ``scan_lines`` gives them; stretches follow one another by file and split. Returns the token count."""
    chunks = materialize(token_chunks(rows, block_size), "token-chunks", large_rows=True)
    total = chunks.agg(F.sum(F.size("ids").cast("long"))).first()[0] or 0
    if total == 0:  # before the old dataset is touched
        raise ValueError("the input holds no tokens")
    blocks = assemble_blocks(chunks, int(total), block_size, halo, shard_blocks)
    # One folder per shard, rows sorted by block inside each file (tight row-group statistics).
    write_parquet(blocks.sortWithinPartitions("shard", "block_id"), path, partition_by=["shard"], large_rows=True)
    return int(total)
