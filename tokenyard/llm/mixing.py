"""Mixing sources to target weights, by blocks.

Every source's documents fall into blocks by hash; a seeded permutation orders a source's blocks. A source
that is to give more than all its words gives whole rounds of all blocks, then the first blocks of its order,
the last of them in part. A splitting tree of multivariate-hypergeometric draws divides the block quotas
exactly among the output shards; every shard takes its own run of each source's permuted blocks. Only one row
per source reaches the driver; documents are placed where they lie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenyard.llm.common import staged, words

#: Words a block holds on average; more when there are so many words that blocks would pass 2**28.
BLOCK_WORDS = 16384
#: Blocks that one task sums in order.
_CHUNK = 4096


def water_fill(sizes: Sequence[int], weights: Sequence[float], max_repeat: float) -> list[float]:
    """Targets that share the sum of sizes by weight, none above max_repeat times its size."""
    targets = [0.0] * len(sizes)
    left, free = float(sum(sizes)), list(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > max_repeat * sizes[i]]
        if not over:
            for i in free:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(max_repeat * sizes[i])
        left -= sum(targets[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return targets


def split_quotas(quotas: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Rows of shards, columns of sources: exact block quotas by a tree of hypergeometric splits."""
    out = np.zeros((n_shards, len(quotas)), np.int64)

    def split(own: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            out[first] = own
            return
        left = count // 2
        rng = np.random.default_rng([seed, first, count])
        take = int(own.sum()) * left // count
        drawn = rng.multivariate_hypergeometric(own, take) if own.sum() else own
        split(drawn, first, left)
        split(own - drawn, first + left, count - left)

    split(np.asarray(quotas, np.int64), 0, n_shards)
    return out


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text"))


def _block(key: Column, n: Column, a: Column, c: Column) -> Column:
    """Place of a document's block in its source's permuted order."""
    return F.pmod(F.pmod(key, n) * a + c, n)


def _affine(n: int, rng: np.random.Generator) -> tuple[int, int]:
    a = int(rng.integers(1, max(n, 2)))
    while math.gcd(a, n) != 1:
        a += 1
    return a, int(rng.integers(0, n))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: int = 3, n_shards: int = 8,
             seed: int = 1, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The plan per source, and the documents' narrow rows (doc_id, source, size, key) that it was made from.

    The i-th source by code point (null last) has weight ``weights[i % len(weights)]``. Per source: size, target,
    number of blocks, the permutation, whole rounds, the drawn block that is not drawn whole (-1: none), the keys drawn
    from it (largest documents first, each that still fits), and the bounds of the shards' runs of drawn blocks, as
    the splitting tree gives them.
    Sources without words, and tables without rows, get targets of 0. One row per source is on the driver.
    """
    spark = docs.sparkSession
    rows = staged(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"),
                              _key(seed).alias("key")), "mix-rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], max_repeat)
    per_block = max(block_words, sum(sizes) >> 28)
    plan = []
    for i, (r, size, target) in enumerate(zip(found, sizes, targets, strict=True)):
        n = max(1, -(-size // per_block))
        a, c = _affine(n, np.random.default_rng([seed, i]))
        rounds = min(max_repeat, int(target // size)) if size else 0
        rest = target - rounds * size if rounds < max_repeat else 0.0
        plan.append((r["source"], i, size, target, n, a, c, rounds, rest))
    table = _plan_frame(spark, plan, "source string, sid int, size long, target double, n long, a long, c long, "
                                     "rounds int, rest double")
    partial = _partial_blocks(rows, table)
    cuts = {r["sid"]: r for r in partial.collect()}
    quotas = [p[4] * p[7] + (cuts[p[1]]["stop"] + 1 if p[1] in cuts else 0) for p in plan]
    per_shard = split_quotas(np.array(quotas, np.int64), n_shards, seed)
    bounds = np.vstack([np.zeros((1, len(plan)), np.int64), np.cumsum(per_shard, axis=0)])
    full = [(*p[:8], p[4] * p[7] + cuts[p[1]]["stop"] if p[1] in cuts else -1, list(cuts[p[1]]["taken"]) if p[1] in cuts else [],
             [int(b) for b in bounds[:, p[1]]]) for p in plan]
    return _plan_frame(spark, full, "source string, sid int, source_size long, target double, n long, a long, c long, "
                                    "rounds int, cut long, cut_keys array<long>, bounds array<long>"), rows


def _plan_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _partial_blocks(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Per source with a rest: the block in which the rest runs out, and the keys drawn from that block."""
    live = table.where(F.col("rest") > 0).select("source", "sid", "n", "a", "c", "rest")
    placed = rows.join(live, rows["source"].eqNullSafe(live["source"])).select(
        "sid", "rest", "size", "key", _block(F.col("key"), F.col("n"), F.col("a"), F.col("c")).alias("at"))
    blocks = placed.groupBy("sid", "rest", "at").agg(F.sum("size").alias("words"))
    blocks = staged(blocks.withColumn("chunk", F.floor(F.col("at") / _CHUNK)), "mix-blocks")
    upto = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = (blocks.groupBy("sid", "chunk").agg(F.sum("words").alias("all"))
              .select("sid", "chunk", (F.sum("all").over(upto) - F.col("all")).alias("base")))
    inner = Window.partitionBy("sid", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = blocks.join(chunks, ["sid", "chunk"]).select(
        "sid", "rest", "at", "words", (F.col("base") + F.sum("words").over(inner)).alias("upto"))
    stop = (run.where(F.col("upto") > F.col("rest")).groupBy("sid")
            .agg(F.min(F.struct("at", (F.col("rest") - F.col("upto") + F.col("words")).alias("left"))).alias("s"))
            .select(F.col("sid").alias("id"), F.col("s.at").alias("stop"), F.col("s.left").alias("left")))
    inside = placed.join(stop, (F.col("sid") == F.col("id")) & (F.col("at") == F.col("stop")))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "key"], ascending=[False, True])
        left, taken = float(group["left"].iloc[0]), []
        for size, key in zip(group["size"], group["key"], strict=True):
            if 0 < size <= left:
                left -= size
                taken.append(int(key))
        return pd.DataFrame({"sid": [group["sid"].iloc[0]], "stop": [group["stop"].iloc[0]], "taken": [taken]})

    alike = inside.groupBy("sid", "stop", "left", "key").agg(F.sum("size").alias("size"))  # equal rows go together
    return (alike.groupBy("sid")
            .applyInPandas(fit, "sid int, stop long, taken array<long>"))


def place(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (any columns, with source and key) with their source's plan and ``shards``: the shard of each draw of the row.

    The blocks that a source gives are numbered through its rounds; a draw of a row is the number of its block in a
    round, if that lies in a shard's run.
    """
    p = plan.withColumnRenamed("source", "__source")
    joined = rows.join(p, rows["source"].eqNullSafe(p["__source"])).drop("__source")
    numbers = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rounds").cast("long")),
                          lambda k: k * F.col("n") + _block(F.col("key"), F.col("n"), F.col("a"), F.col("c")))
    drawn = F.filter(numbers, lambda at: (at < F.element_at("bounds", -1)) & (
        (at != F.col("cut")) | F.array_contains("cut_keys", F.col("key"))))
    return joined.withColumn("shards", F.transform(drawn, lambda at: F.size(F.filter("bounds", lambda b: b <= at)) - 1))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: int = 3, n_shards: int = 8, seed: int = 1,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """The drawn documents, each as often as it is drawn: all columns of ``docs`` with ``mix_copy``, ``mix_shard``
    and ``mix_order`` (a seeded random number; a shard sorted by it is shuffled).

    Null ids and texts are documents like others; equal rows are drawn alike; input columns of the added names
    are replaced. Documents without words are drawn with their blocks.
    """
    plan, _ = mix_plan(docs, weights, max_repeat, n_shards, seed, block_words)
    own = [c for c in docs.columns if c not in ("mix_copy", "mix_shard", "mix_order")]
    packed = docs.select(F.struct(*own).alias("row"), "source", _key(seed).alias("key"))
    out = place(packed, plan).select("row", "key", F.posexplode("shards").alias("copy", "shard"))
    return out.select("row.*", F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"),
                      F.xxhash64(F.lit(seed), "shard", "key", "copy").alias("mix_order"))


def write_shards(mixed: DataFrame, path: str) -> None:
    """Write each shard as a folder of files that are shuffled in themselves and follow one another in random order."""
    (mixed.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
     .write.partitionBy("mix_shard").parquet(path))
