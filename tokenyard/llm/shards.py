"""Two-pass external shuffle: scatter records into memory-sized buckets, then shuffle each bucket in memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenyard.llm.common import staged

#: Text bytes that a bucket holds on average; one bucket is in one task's memory.
BUCKET_BYTES = 24 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform random order of n rows (numpy's permutation is a Fisher-Yates shuffle)."""
    return rng.permutation(n)


def shuffle_records(records: DataFrame, n_shards: int = 8, seed: int = 1, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``records`` with ``shard`` and ``slot``: a seeded random order, cut into even shards.

    Pass 1 scatters rows uniformly over buckets by a seeded hash of the id and the row's number, so no id or text
    can fill a bucket; pass 2 puts a bucket into a canonical order, shuffles it and writes it to the shared
    folder. Buckets follow one another; shard j holds the j-th even part of that order (counts at most one
    apart), slots run from 0. Null texts count one byte. Columns named shard or slot are replaced.
    The written order stays fixed; no rows give no rows.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    total = records.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    own = [c for c in records.columns if c not in ("shard", "slot")]
    tagged = records.select(
        *own, F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id()).alias("__key"))
    tagged = tagged.withColumn("__bucket", F.pmod("__key", F.lit(buckets)))
    schema = tagged.select(*own, "__bucket", F.lit(0).cast("long").alias("__at")).schema

    def shuffle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("__key").to_numpy(), kind="stable")
        rng = np.random.default_rng([seed, key[0].as_py()])
        table = table.take(pa.array(order[fisher_yates(len(order), rng)])).drop_columns(["__key"])
        return table.append_column("__at", pa.array(np.arange(len(order), dtype=np.int64)))

    written = staged(tagged.groupBy("__bucket").applyInArrow(shuffle, schema), "shuffled")
    counts = written.groupBy("__bucket").count()
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("__bucket", (F.sum("count").over(upto) - F.col("count")).alias("__start"))
    n = written.count()
    rank = F.col("__start") + F.col("__at")
    shard = F.expr(f"int((__start + __at) * {n_shards} div {max(n, 1)})")
    return written.join(starts, "__bucket").select(
        *own, shard.alias("shard"), rank.alias("__rank")).select(
        *own, "shard", (F.col("__rank") - F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")).alias("slot"))
