"""W2 global offsets, K2 token blocks, T5 sample starts, W1/W1b language-model windows.

The token stream of a dataset is the concatenation of every document's ids in ``doc_id`` order
(U1). It is stored as fixed-size blocks ``(block_id, start, ids, tail)``: ``ids`` holds the tokens
``[start, start + B)`` and ``tail`` the next ``H`` tokens (a halo). A window of length ``L <= H``
starting inside a block is then a pair of ``slice`` calls on that one row: drawing windows needs
no join and no shuffle of the token data, and blocks are read with a plain Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform_index
from ..sinks.tables import materialize
from .assembly import assemble_blocks, ordered_stretches, token_chunks

# Largest number of sample rows we broadcast to the block scan.
BROADCAST_SAMPLES_LIMIT = 5_000_000


def global_offsets(
    df: DataFrame, order_col: str = "doc_id", size_col: str = "n_tokens", partitions: int | None = None
) -> DataFrame:
    """``offset`` = sum of ``size_col`` over all rows with a smaller (unique) ``order_col``.

    Two levels, no single-task window: rows are range-partitioned on ``order_col`` (balanced by
    sampling), a running sum is taken inside each range, and the per-range totals (one row per
    range) are prefix-summed and broadcast back.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once so that both branches below see one range assignment: two executions of a range
    # exchange may sample different bounds. (Narrow rows.)
    ranged = materialize(df.repartitionByRange(parts, order_col).withColumn("_rng", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_rng").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(size_col).over(before), F.lit(0)).cast("long"))
    totals = ranged.groupBy("_rng").agg(F.sum(size_col).cast("long").alias("_tot"))
    # At most `parts` rows: a window without partitioning is fine here, and the result is broadcast.
    prior = Window.orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_rng", F.coalesce(F.sum("_tot").over(prior), F.lit(0)).cast("long").alias("_base"))
    return local.join(F.broadcast(base), "_rng").select(
        *[c for c in df.columns], (F.col("_base") + F.col("_local")).alias("offset")
    )


# Blocks per shard of a written token dataset (4096 blocks of 64 Ki tokens = 256 Mi tokens per shard).
SHARD_BLOCKS = 4096


def token_blocks(token_docs: DataFrame, block_size: int = 1 << 16, halo: int = 1024, order_col: str = "doc_id",
                 shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """K2 layout: ``(shard, block_id, start, ids ARRAY<INT>, tail ARRAY<INT>)``.

    ``shard = block_id div shard_blocks`` is the partition column of the written table, so a reader that needs a few
    blocks prunes to their shard folders. Rows are dealt to ranges of ``order_col`` (the one exchange of token arrays;
    ``token_docs`` should be a written table, as bounds are sampled from it), and blocks are assembled in the ranges.
    """
    chunks = materialize(token_chunks(ordered_stretches(token_docs, order_col), block_size), "token-chunks",
                         large_rows=True)
    total = chunks.agg(F.sum(F.size("ids").cast("long"))).first()[0] or 0
    return assemble_blocks(chunks, int(total), block_size, halo, shard_blocks)


def _window(ids, tail, offset, length: int):
    """``length`` tokens from 0-based ``offset`` in ``ids`` continued into ``tail`` (small slices only).

    Windows are only asked for where the stream holds them, so a short one means the dataset was
    written with a halo smaller than the window: that is an error, never a silently short window.
    """
    head = F.slice(ids, (offset + 1).cast("int"), length)
    w = F.concat(head, F.slice(tail, 1, F.lit(length) - F.size(head)))
    return F.when(F.size(w) == length, w).otherwise(
        F.raise_error(F.lit(f"window of {length} tokens needs a halo of at least {length}"))
    )


def _slices(start_in_block, length: int):
    ids, tail = F.col("ids"), F.col("tail")
    return _window(ids, tail, start_in_block, length), _window(ids, tail, start_in_block + 1, length)


# Tokens of the windows whose starts one row of a block lists at a time.
CHUNK_WINDOW_TOKENS = 1 << 17


def lm_windows_all(blocks: DataFrame, total_tokens: int, length: int, stride: int | None = None) -> DataFrame:
    """Every window ``(start, x, y)`` with ``start`` a multiple of ``stride`` and
    ``start + length <= total_tokens - 1`` (``y`` is ``x`` shifted by one). Narrow: no shuffle.

    Starts are exploded beside the block, a bounded number at a time, and each row slices its two windows out of the
    block: compiled code without a lambda over the tokens, and no row holds more than one window and its block.
    """
    stride = stride or length
    last_start = total_tokens - length - 1
    span = stride * max(1, CHUNK_WINDOW_TOKENS // length)
    begin = F.col("start") + F.col("at")
    first = (F.ceil(begin / stride) * stride).cast("long")
    last = F.least(begin + F.lit(span - 1), F.col("start") + F.size("ids") - 1, F.lit(last_start)).cast("long")
    starts = F.when(first <= last, F.sequence(first, last, F.lit(stride).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    chunks = blocks.where(F.size("ids") > 0).select(
        "start", "ids", "tail", F.explode(F.sequence(F.lit(0), F.size("ids") - 1, F.lit(span))).alias("at"))
    placed = chunks.select("start", "ids", "tail", F.explode(starts).alias("s"))
    x, y = _slices(F.col("s") - F.col("start"), length)
    return placed.select(F.col("s").alias("start"), x.alias("x"), y.alias("y"))


def sample_starts(spark, n_samples: int, total_tokens: int, length: int, seed: int) -> DataFrame:
    """T5: ``(sample_id, start)``, uniform with replacement on ``[0, total_tokens - length)``."""
    if total_tokens - length <= 0:
        raise ValueError("dataset shorter than one window")
    return spark.range(n_samples).select(
        F.col("id").alias("sample_id"), uniform_index(F.col("id"), seed, total_tokens - length).alias("start")
    )


def lm_windows_sampled(blocks: DataFrame, starts: DataFrame, n_samples: int, block_size: int, length: int,
                       shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``(sample_id, start, x, y)`` for given starts.

    The sample side is broadcast when its known row count is small, so the block table is streamed
    without a shuffle; its scan is first restricted to the shards the samples fall into (partition
    pruning on a written dataset: a batch of windows reads a few shard folders, not the corpus).
    Beyond the limit both sides are shuffled on ``block_id``.
    """
    s = starts.select("sample_id", F.col("start").alias("s"), F.floor(F.col("start") / block_size).cast("long").alias("block_id"))
    if n_samples <= BROADCAST_SAMPLES_LIMIT:
        if "shard" in blocks.columns:
            # At most n_samples values (a parameter), usually far fewer: the shards to read.
            shards = [r[0] for r in s.select(F.floor(F.col("block_id") / F.lit(shard_blocks)).cast("long")).distinct().collect()]
            blocks = blocks.filter(F.col("shard").isin(shards))
        side = F.broadcast(s)
    else:
        side = s
    j = blocks.join(side, "block_id")
    x, y = _slices(F.col("s") - F.col("start"), length)
    return j.select("sample_id", F.col("s").alias("start"), x.alias("x"), y.alias("y"))
