"""Vocabulary and merge tables as DataFrames: J1, J3, J4, J8, U1, U2, U3, T3, plus P6/F17/F20 helpers.

The driver-side Tokenizer covers encoding; these are the table forms for users who keep vocabularies
and merges as Spark tables (they are vocabulary-sized, so the joins below broadcast them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pairs import contains_any_pair
from ..functions.text import specials_longest_first


def token_ids(vocab: DataFrame, order: str = "token_id") -> DataFrame:
    """``(token, token_id)``, one id per byte string; of equal ones the last in insertion ``order`` wins."""
    return vocab.groupBy("token").agg(F.max_by("token_id", order).alias("token_id"))


def merges_by_rank(merges: DataFrame) -> DataFrame:
    """Merges in rank order."""
    return merges.orderBy("rank")


def rank_pairs(pairs: DataFrame, merges: DataFrame) -> DataFrame:
    """Attach each pair's merge rank (null = never merged); the merge table is broadcast."""
    m = merges.select(F.col("left").alias("_l"), F.col("right").alias("_r"), "rank")
    j = pairs.join(F.broadcast(m), (F.col("left") == F.col("_l")) & (F.col("right") == F.col("_r")), "left")
    return j.drop("_l", "_r")


def words_with_pair(words: DataFrame, left_hex: str, right_hex: str) -> DataFrame:
    """Words (token strings) in which the pair occurs: a filter, the semi join of the reference."""
    return words.filter(contains_any_pair(F.col("toks"), [(left_hex, right_hex)]))


def specials_frame(spark, specials: Sequence[str]) -> DataFrame:
    ordered = specials_longest_first(specials)
    return spark.createDataFrame(
        [(i, s.encode("utf-8")) for i, s in enumerate(ordered)],
        T.StructType([T.StructField("order", T.IntegerType()), T.StructField("token", T.BinaryType())]),
    )


def missing_specials(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """The specials (longest first) whose bytes are not in the vocabulary (left anti join)."""
    return specials_frame(vocab.sparkSession, specials).join(vocab.select("token"), "token", "left_anti")


def extend_vocab(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Append missing specials at ids ``size(vocab), size(vocab)+1, ...`` in longest-first order."""
    n = vocab.count()
    miss = missing_specials(vocab, specials)
    rank = F.dense_rank().over(Window.orderBy("order")) - 1  # over the few missing specials only
    added = miss.select((F.lit(n) + rank).cast("int").alias("token_id"), "token")
    return vocab.select("token_id", "token").unionByName(added)


def compare_vocab(a: DataFrame, b: DataFrame) -> bool:
    """Equal as sets of ids and as sets of byte strings (``exceptAll`` both ways is empty)."""
    ids_a, ids_b = a.select("token_id"), b.select("token_id")
    tok_a, tok_b = a.select("token"), b.select("token")
    return (
        ids_a.exceptAll(ids_b).isEmpty()
        and ids_b.exceptAll(ids_a).isEmpty()
        and tok_a.exceptAll(tok_b).isEmpty()
        and tok_b.exceptAll(tok_a).isEmpty()
    )


def concat_parts(parts: Sequence[DataFrame], order_col: str = "part") -> DataFrame:
    """Parts stacked in the given order, tagged with their position for ordered consumers."""
    tagged = [p.withColumn(order_col, F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p)
    return out


def every_n(df: DataFrame, n: int, step_col: str = "step") -> DataFrame:
    """Keep rows whose step is a multiple of ``n`` (logging / evaluation cadence)."""
    return df.filter(F.col(step_col) % F.lit(n) == 0)


def throughput(iters_per_sec: Column, batch_size: int, context: int) -> Column:
    """tokens per second from iterations per second."""
    return iters_per_sec * F.lit(batch_size * context)


def tokens_seen(step: Column, batch_size: int, context: int) -> Column:
    """F19."""
    return step.cast("long") * F.lit(batch_size * context)


def parse_stamp(iso: Column) -> Column:
    """ISO seconds text (``2026-07-05T12:56:59``) -> timestamp."""
    return F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ss")


def run_stamp(ts: Column) -> Column:
    """the compact run stamp ``yyyyMMdd-HHmmss``."""
    return F.date_format(ts, "yyyyMMdd-HHmmss")
