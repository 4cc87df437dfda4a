"""Blocks of an ordered token stream assembled where its parts lie, with an exchange at the borders only.

The stream comes as stretches (a file split, or a range of keys) in order. A stretch is stored as chunks of many blocks;
the number of tokens before a stretch comes from narrow rows. A chunk that knows its place cuts out all blocks that lie
within it, with their halos, and sends only the pieces of the blocks at its two ends, at most a block and a halo each,
to be put together by block. No other token moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Blocks that a chunk holds at most.
CHUNK_BLOCKS = 32
#: Stretches (about 150 bytes each) whose offsets are broadcast to the chunks; beyond that the join is a shuffle.
BROADCAST_STRETCHES = 500_000

CHUNKS = "file string, split long, rel long, ids array<int>"


def token_chunks(rows: DataFrame, block_size: int) -> DataFrame:
    """Chunks (``CHUNKS``) of consecutive rows ``(file, split, ids)`` of one stretch; ``rel`` counts from its start. Narrow."""
    most = CHUNK_BLOCKS * block_size

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, rel = None, [], 0, 0

        def out(n: int) -> pa.RecordBatch:
            nonlocal held, size, rel
            ids = np.concatenate(held)
            held, size = [ids[n:]], size - n
            row = [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([rel], pa.int64()),
                   pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(ids[:n], pa.int32()))]
            rel += n
            return pa.RecordBatch.from_arrays(row, [f.split()[0] for f in CHUNKS.split(", ")])

        for batch in batches:
            files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
            i = 0
            while i < len(batch):
                if key != (files[i], splits[i]):
                    if size:
                        yield out(size)
                    key, held, size, rel = (files[i], splits[i]), [], 0, 0
                j = i + 1
                while j < len(batch) and splits[j] == key[1] and files[j] == key[0]:
                    j += 1
                ids = batch.column("ids").slice(i, j - i).flatten().to_numpy(zero_copy_only=False)
                held.append(ids)
                size += len(ids)
                while size >= most:
                    yield out(most)
                i = j
        if size:
            yield out(size)

    return rows.select("file", F.col("split").cast("long").alias("split"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        gather, CHUNKS)


def ordered_stretches(token_docs: DataFrame, order_col: str) -> DataFrame:
    """Rows ``(file, split, ids)`` of a table in the order of a column: each range of it is a stretch."""
    n = int(token_docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = token_docs.select(order_col, "ids").repartitionByRange(n, order_col).sortWithinPartitions(order_col)
    return ranges.select(F.lit("").alias("file"), F.spark_partition_id().alias("split"), "ids")


def stretch_offsets(chunks: DataFrame) -> DataFrame:
    """``(file, split, base)``: the tokens before each stretch, in the order of file and split. One row per stretch."""
    sizes = chunks.groupBy("file", "split").agg(F.sum(F.size("ids").cast("long")).alias("n"))
    files = sizes.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"))
    inside = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(files, "file").select(
        "file", "split", (F.col("above") + F.col("inside")).cast("long").alias("base"))


def assemble_blocks(chunks: DataFrame, total: int, block_size: int, halo: int, shard_blocks: int) -> DataFrame:
    """``(shard, block_id, start, ids, tail)`` from written chunks of a stream of ``total`` tokens."""
    base = stretch_offsets(chunks)
    if chunks.select("file", "split").distinct().count() <= BROADCAST_STRETCHES:
        base = F.broadcast(base)
    return blocks_of(chunks.join(base, ["file", "split"]).select((F.col("base") + F.col("rel")).alias("lo"), "ids"),
                     total, block_size, halo, shard_blocks)


def blocks_of(placed: DataFrame, total: int, block_size: int, halo: int, shard_blocks: int) -> DataFrame:
    """Blocks from rows ``(lo, ids)`` that hold every token of a stream of ``total`` tokens once, from place ``lo`` on."""
    if not 0 < halo <= block_size:
        raise ValueError("need 0 < halo <= block_size")
    B, H = block_size, halo
    placed = placed.where(F.size("ids") > 0).select("lo", (F.col("lo") + F.size("ids")).alias("hi"), "ids")
    # whole blocks: start and, unless the stream ends before, halo lie in the chunk
    placed = placed.selectExpr("lo", "hi", "ids", f"lo div {B} AS b0", f"(hi - 1) div {B} AS b1", f"(lo + {B - 1}) div {B} AS w0",
                               f"if(hi = {total}, (hi - 1) div {B}, (hi - {H}) div {B} - 1) AS w1")
    part = "slice(ids, int({0} - lo + 1), int({1} - {0}))".format
    whole = placed.where("w0 <= w1").selectExpr("lo", "hi", "ids", "explode(sequence(w0, w1)) AS b").selectExpr(
        "b AS block_id", part(f"b * {B}", f"least((b + 1) * {B}, hi)") + " AS ids",
        part(f"least((b + 1) * {B}, hi)", f"least((b + 1) * {B} + {H}, hi)") + " AS tail")
    ends = placed.selectExpr("lo", "hi", "ids", "w0", "w1", "explode(sequence(b0, b1)) AS b")
    own = ends.where("NOT b BETWEEN w0 AND w1").selectExpr(
        "b AS block_id", "0 AS kind", f"greatest(b * {B}, lo) AS p0",
        part(f"greatest(b * {B}, lo)", f"least((b + 1) * {B}, hi)") + " AS piece")
    halos = ends.where(f"b > 0 AND NOT b - 1 BETWEEN w0 AND w1 AND lo < b * {B} + {H}").selectExpr(
        "b - 1 AS block_id", "1 AS kind", f"greatest(b * {B}, lo) AS p0",
        part(f"greatest(b * {B}, lo)", f"least(b * {B} + {H}, hi)") + " AS piece")
    met = own.unionByName(halos).groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("kind", "p0", "piece"))).alias("parts"))
    border = met.selectExpr("block_id", "flatten(transform(filter(parts, p -> p.kind = 0), p -> p.piece)) AS ids",
                            "flatten(transform(filter(parts, p -> p.kind = 1), p -> p.piece)) AS tail")
    return whole.unionByName(border).selectExpr(f"block_id div {shard_blocks} AS shard", "block_id", f"block_id * {B} AS start", "ids", "tail")
