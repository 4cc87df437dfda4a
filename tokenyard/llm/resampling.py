"""Importance resampling towards a target: array-scored weights, then a distributed quickselect of the k-th key.

A text's features are its runs of 1 to ``max_n`` consecutive words, hashed (CRC-32) into ``buckets``. A bucket's gain
is the log ratio of its smoothed share in the target and in the raw corpus; a document's weight is the sum of the
gains of its features, looked up in one array of ``buckets`` numbers. Adding Gumbel noise that depends on the id alone
and taking the greatest scores draws without replacement, in proportion to the exponentials of the weights.

The draw's last key is found without a sort of the corpus: rounds of random pivot keys are counted exactly (rows
above, at and below each), and only rows between the two pivots that enclose the k-th key stay in play. Keys are
unique, so exactly k rows are drawn. Only the drawn rows are range-partitioned, sorted and ranked.

The driver holds the counts of ``buckets`` buckets, a few pivots a round, and one row per range of drawn rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm.common import staged

BUCKETS, MIN_WORDS, PERCENT, SEED = 10000, 20, 10, 2024
_PIVOTS = 31
#: Words of up to so many bytes are hashed side by side, longer ones one by one.
_SIDE_BY_SIDE = 48
_U32 = np.uint32
_FULL = _U32(0xFFFFFFFF)


def _crc_steps() -> np.ndarray:
    """The CRC-32 (reflected polynomial 0xEDB88320) step of each byte value."""
    step = np.arange(256, dtype=_U32)
    for _ in range(8):
        step = np.where(step & _U32(1), (step >> _U32(1)) ^ _U32(0xEDB88320), step >> _U32(1))
    return step


_STEP = _crc_steps()
#: Bytes of a word: digits, a-z after lower-casing, and all bytes of characters beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def span_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each span's bytes."""
    length = ends - starts
    crc = np.full(len(starts), _FULL)
    order = np.argsort(-np.minimum(length, _SIDE_BY_SIDE + 1), kind="stable")
    short = order[np.searchsorted(-length[order], -_SIDE_BY_SIDE, "left"):] if len(order) else order
    at, have, left = starts[short], crc[short], np.sort(length[short])
    for k in range(int(left[-1]) if len(left) else 0):
        n = len(left) - int(np.searchsorted(left, k, "right"))
        now = have[:n]
        have[:n] = _STEP[(now ^ data[at[:n] + k]) & _U32(255)] ^ (now >> _U32(8))
    crc[short] = have ^ _FULL
    long = np.flatnonzero(length > _SIDE_BY_SIDE)
    if len(long):
        crc[long] = [zlib.crc32(data[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return crc


def text_features(data: np.ndarray, offsets: np.ndarray, max_n: int, buckets: int):
    """(words per row, features per row, row of each feature, bucket of each feature) of a chunk of texts."""
    data = A.LOWER[data]
    starts, ends, first = _spans(data, offsets)
    n_words = np.diff(first)
    crc = [span_crc32(data, starts, ends)]
    own = np.repeat(np.arange(len(n_words)), n_words)
    rows = [own]
    for n in range(2, min(max_n, len(own)) + 1):
        at = np.flatnonzero(own[n - 1:] == own[:len(own) - n + 1])
        crc.append(_joined_crc32(data, starts, ends, at, n))
        rows.append(own[at])
    row = np.concatenate(rows)
    return n_words, np.bincount(row, minlength=len(n_words)), row, np.concatenate(crc).astype(np.int64) % buckets


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = _WORD[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = solid[1:] != solid[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    keep = solid[at[:-1]]
    starts, ends = at[:-1][keep], at[1:][keep]
    return starts, ends, np.searchsorted(starts, offsets)


def _joined_crc32(data, starts, ends, at: np.ndarray, n: int) -> np.ndarray:
    """CRC-32 of n words from each place, joined by one space."""
    length = [ends[at + k] - starts[at + k] for k in range(n)]
    total = sum(length) + n - 1
    space = np.concatenate([data, np.array([32], np.uint8)])
    pieces = np.empty((len(at), 2 * n - 1), np.int64)
    sizes = np.ones((len(at), 2 * n - 1), np.int64)
    pieces[:, 1::2] = len(data)
    for k in range(n):
        pieces[:, 2 * k], sizes[:, 2 * k] = starts[at + k], length[k]
    flat = space[A.take_ranges(pieces.ravel(), sizes.ravel())]
    upto = np.cumsum(total)
    return span_crc32(flat, upto - total, upto)


def _chunks(batches: Iterator[pa.RecordBatch], max_n: int, buckets: int):
    for batch in batches:
        data, offsets = A.utf8(batch.column("text"))
        for i, j in A.row_chunks(offsets):
            part = offsets[i:j + 1]
            yield batch, i, j, text_features(data[part[0]:part[-1]], part - part[0], max_n, buckets)


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; every task sums its own before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, _, _, (_, _, _, bucket) in _chunks(batches, max_n, buckets):
            total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(
        count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of add-one shares) per bucket."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (all_raw + n)) / ((s + 1) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, max_n: int = 1) -> DataFrame:
    """``docs`` (doc_id, text and others) as (rest, doc_id, n_words, n_features, weight); ``rest`` is the struct of all
    columns but the text."""
    rest = F.struct(*[_col(c) for c in docs.columns if c != "text"]).alias("rest")
    rows = docs.select(rest, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = rows.schema["rest"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, j, (n_words, n_features, row, bucket) in _chunks(batches, max_n, len(gains)):
            weight = np.zeros(j - i, np.int64)
            np.add.at(weight, row, gains[bucket])
            numbers = [pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest").slice(i, j - i), batch.column("doc_id").slice(i, j - i), *numbers],
                ["rest", "doc_id", "n_words", "n_features", "weight"])

    schema = (f"rest {kept.dataType.simpleString()}, doc_id long, n_words long, n_features long, weight long")
    return rows.mapInArrow(weigh, _typed(kept, schema))


def _typed(kept, schema: str):
    from pyspark.sql import types as T

    numbers = [T.StructField(f.split()[0], T.LongType()) for f in schema.split(", ")[-4:]]
    return T.StructType([kept, *numbers])


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`").alias(name)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) of an id; a null id counts as the empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


#: The order of a draw, greatest first: score, then the smaller id (a null id last), fewer features, and the row.
def _key() -> Column:
    return F.struct("score", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("n_features").alias("f"),
                    F.bitwise_not("row").alias("r"))


def kth_key(rows: DataFrame, k: int, pivots: int = _PIVOTS) -> tuple | None:
    """The k-th greatest ``key`` (1 is the greatest) of rows with unique keys: random pivots, exact counts around them.

    A round picks the pivots (the rows in play with the least seeded hashes) and counts the rows in play above, at
    and below each; the k-th key then lies at a pivot or strictly between two neighbours, and only those rows stay
    in play. A round leaves about a ``pivots``-th of the rows; every round removes at least one row.
    """
    if k <= 0:
        return None
    kind = dict((f.name, f.dataType) for f in rows.schema)["key"]

    def at(key: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind, strict=True)])

    below, above, todo, turn = None, None, k, 0  # in play: below < key < above, in which the todo-th greatest is sought
    while True:
        turn += 1
        play = rows
        if below is not None:
            play = play.where(F.col("key") > at(below))
        if above is not None:
            play = play.where(F.col("key") < at(above))
        picked = play.select(*[F.min_by("key", F.xxhash64("key", F.lit(turn * 1000 + i))).alias(f"p{i}")
                               for i in range(pivots)]).first()
        line = sorted({tuple(p) for p in picked if p is not None}, key=_sortable, reverse=True)
        if not line:
            raise ValueError(f"fewer than {k} rows")
        counts = play.select(*[F.count_if(F.col("key") > at(p)).alias(f"above{i}") for i, p in enumerate(line)],
                             *[F.count_if(F.col("key") == at(p)).alias(f"equal{i}") for i, p in enumerate(line)],
                             F.count(F.lit(1)).alias("all")).first()
        if counts["all"] < todo:
            raise ValueError(f"fewer than {k} rows")
        taken = 0
        for i, p in enumerate(line):  # greatest pivot first
            if todo <= counts[f"above{i}"]:
                below = p
                break
            if todo <= counts[f"above{i}"] + counts[f"equal{i}"]:
                return p
            above, taken = p, counts[f"above{i}"] + counts[f"equal{i}"]
        todo -= taken


def _sortable(key: tuple) -> tuple:
    return tuple((v is not None, v or 0) for v in key)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by falling ``key``: ranges of keys, sorted each by itself, and one offset a range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(rows.repartitionByRange(n, F.desc("key")).sortWithinPartitions(F.desc("key"))
                    .withColumn("place", F.monotonically_increasing_id()), "drawn")
    low = F.lit((1 << 33) - 1)
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per range
    offsets, upto = {}, 0
    for r in sorted(sizes):
        offsets[r.part], upto = upto, upto + r.n
    if not offsets:
        return placed.select("*", F.lit(None).cast("long").alias("rank")).drop("place")
    table = rows.sparkSession.createDataFrame(sorted(offsets.items()), "part long, offset long")
    inside = placed.withColumn("part", part).join(F.broadcast(table), "part")
    return inside.withColumn("rank", F.col("offset") + F.col("place").bitwiseAND(low) + 1).drop("part", "offset", "place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, max_n: int = 1, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as (rest, doc_id, n_words, n_features, weight, score, rank).

    ``docs``: an integer doc_id, text, any other columns (all but the text come back in the struct ``rest``, so names
    cannot clash); ``target``: text. Of the N rows with at least ``min_words`` words the floor(percent * N / 100) of
    the highest scores are drawn and ranked; ``rank`` is null for all others. Ties go to the smaller doc_id, null ids
    last, then to fewer features; rows alike in all of these are told apart by their place in the written table and
    get ranks one after another. Null and empty texts have no feature and weight 0; whole texts count, however long.
    An empty ``docs`` gives no rows, an empty ``target`` counts as all zeros. Reruns agree.
    """
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    rows = staged(weighed(docs, gains, max_n).select(
        "*", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("row")), "weighed")
    able = rows.where(F.col("n_words") >= min_words)
    k = able.count() * percent // 100
    out = rows.columns[:-1]
    last = kth_key(able.select(_key().alias("key")), k)
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    keyed = rows.withColumn("key", _key())
    kind = keyed.schema["key"].dataType
    cut = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, kind, strict=True)])
    drawn = (F.col("n_words") >= min_words) & (F.col("key") >= cut)
    rest = keyed.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(keyed.where(drawn)).select(*out, "rank").unionByName(rest)
