"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a non-empty line) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors, 32 lanes modulo 2**32 (drawn from 95 bits of hashes) and 128 lanes modulo 2**16. Sums do not depend on order, and a paragraph is
inserted or deleted by adding or subtracting its vector. The 32-bit lanes are full-range hashes of the whole
paragraph (equality); the 16-bit lanes add +1 or -1 for each pair of adjacent words in it, so that the distance
of two fingerprints estimates how much their texts differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A

EQUAL_LANES, LIKE_LANES = 32, 128
_U = np.uint64
_LANE = A.mix64(np.arange(1000, 1000 + EQUAL_LANES // 2, dtype=_U))
#: Documents that a range of ids holds on average, and the most ranges.
_RANGE_ROWS, _MOST_RANGES = 4096, 1 << 16


def vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of UTF-8 rows: (rows, 32) uint32 and (rows, 128) uint16, each the sum over the row's paragraphs."""
    n = len(offsets) - 1
    equal, like = np.zeros((n, EQUAL_LANES), np.uint32), np.zeros((n, LIKE_LANES), np.uint16)
    if not len(data):
        return equal, like
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    line = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([np.flatnonzero(edge), line, line + 1]))
    starts, ends = cuts[:-1], cuts[1:]
    keep = data[starts] != 10
    starts, ends = starts[keep], ends[keep]
    if len(starts):
        hashes, more = A.span_hashes(data, starts, ends), A.span_residues(data, starts, ends, 1)
        lanes = A.mix64(A.mix64(hashes[:, None] ^ _LANE[None, :]) + more[:, None]).view(np.uint32)
        row = np.searchsorted(offsets, starts, "right") - 1
        first = A.segments(row)
        equal[row[first]] = np.add.reduceat(lanes, first, axis=0, dtype=np.uint32)
    begin, end, _ = A.word_spans(data, offsets)
    if len(begin):
        h = A.span_hashes(data, begin, end)
        paragraph = np.searchsorted(cuts, begin, "right")
        follow = np.zeros_like(h)
        same = paragraph[1:] == paragraph[:-1]
        follow[:-1][same] = h[1:][same]
        pair = A.mix64(h * _U(3) + A.mix64(follow))
        row = np.searchsorted(offsets, begin, "right") - 1
        lane = row * LIKE_LANES + (pair & _U(LIKE_LANES - 1)).astype(np.int64)
        sign = 1.0 - 2.0 * ((pair >> _U(32)) & _U(1)).astype(np.float64)
        summed = np.bincount(lane, weights=sign, minlength=n * LIKE_LANES).astype(np.int64)
        like[:] = (summed & 0xFFFF).astype(np.uint16).reshape(n, LIKE_LANES)
    return equal, like


def combine(one: tuple, other: tuple, sign: int = 1) -> tuple:
    """Fingerprint with the other's paragraphs inserted (sign 1) or deleted (sign -1)."""
    return (one[0] + other[0], one[1] + other[1]) if sign > 0 else (one[0] - other[0], one[1] - other[1])


def likeness(one: tuple, other: tuple) -> np.ndarray:
    """0 to 1 per row: 1 less the squared distance over the sum of squared lengths; 1 for equal fingerprints."""
    a, b = one[1].view(np.int16).astype(np.float64), other[1].view(np.int16).astype(np.float64)
    apart = ((one[1] - other[1]).view(np.int16).astype(np.float64) ** 2).sum(axis=1)
    size = (a ** 2).sum(axis=1) + (b ** 2).sum(axis=1)
    like = np.where(size > 0, 1.0 - apart / np.where(size > 0, size, 1.0), 0.0)
    return np.where((one[0] == other[0]).all(axis=1) & (apart == 0), 1.0, np.clip(like, 0.0, 1.0))


def hexed(prints: tuple) -> list[str]:
    """Lowercase hex of each row's lanes, little-endian."""
    return [e.tobytes().hex() + k.tobytes().hex() for e, k in zip(prints[0].astype("<u4"), prints[1].astype("<u2"), strict=True)]


def of_texts(texts: list[str]) -> tuple:
    """Fingerprints of strings."""
    raw = [t.encode() for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return vectors(np.frombuffer(b"".join(raw), np.uint8), offsets)


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``fingerprint`` (hex; null text: as empty); an input column of that name is replaced."""
    own = [c for c in docs.columns if c != "fingerprint"]
    schema = docs.select(*own, F.lit("").alias("fingerprint")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.utf8(batch.column("text"))
            for i, j in A.row_chunks(offsets):
                part = offsets[i:j + 1]
                prints = hexed(vectors(data[part[0]:part[-1]], part - part[0]))
                cut = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(prints, pa.string())], schema.names)

    return docs.select(*own).mapInArrow(add, schema)


def _pivots(docs: DataFrame) -> np.ndarray:
    """Ids that end the ranges, ascending, the largest id last: those of the least hashes, a bounded number."""
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    n, top = ids.agg(F.count(F.lit(1)), F.max("doc_id")).first()
    count = min(_MOST_RANGES, n // _RANGE_ROWS)
    rows = ids.orderBy(F.xxhash64("doc_id")).limit(count).collect() if count else []
    return np.unique(np.array([r[0] for r in rows] + ([top] if n else []), np.int64))


def with_next(docs: DataFrame, step, schema) -> DataFrame:
    """``step(rows, following)`` over doc_id descending: lists of (doc_id, text) and of the texts that follow them.

    Documents are range-partitioned by id; the first document of each range also goes to the range before it, so
    one shuffle of the texts gives every document its follower (the last one the first). Null ids come last,
    ties go by text. Rows stream through a task; one range or text never needs to be held as a whole with others.
    """
    pivots = _pivots(docs)
    k = len(pivots)

    @F.pandas_udf("array<struct<bucket:int,halo:boolean>>")
    def buckets_of(ids):
        import pandas as pd

        value = ids.fillna(np.iinfo(np.int64).min).to_numpy(np.int64)
        home = np.minimum(np.searchsorted(pivots, value, "left"), max(k - 1, 0))
        first = (pivots[home] == value) & ids.notna().to_numpy() & (k > 1) if k else np.zeros(len(value), bool)
        return pd.Series([[(int(b), False), (int((b + 1) % k), True)] if f else [(int(b), False)]
                          for b, f in zip(home, first, strict=True)])

    dealt = docs.select("doc_id", "text", F.explode(buckets_of(F.col("doc_id").cast("long"))).alias("b")).select(
        "doc_id", "text", "b.bucket", "b.halo")
    ordered = dealt.repartition(F.col("bucket")).sortWithinPartitions(
        "bucket", "halo", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, first, held, ready, size, closed = None, None, None, [], 0, False
        for batch in batches:
            for doc, text, b, halo in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "halo")),
                                          strict=True):
                text = text or ""
                if b != bucket:
                    if held is not None and not closed:  # a single range: after the last comes the first
                        ready.append((*held, first))
                    bucket, first, held, closed = b, text, None, False
                if closed:
                    continue
                if held is not None:
                    ready.append((*held, text))
                    size += len(text)
                held, closed = (doc, text), halo
                if size > A.CHUNK_BYTES:
                    yield step(ready)
                    ready, size = [], 0
        if held is not None and not closed:
            ready.append((*held, first))
        if ready:
            yield step(ready)

    return ordered.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (op3's contract).

    Null text: empty. Null ids last. Equal rows are documents of their own. No rows: no rows.
    """
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def step(rows: list[tuple]) -> pa.RecordBatch:
        texts, following = [r[1] for r in rows], [r[2] for r in rows]
        changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        own, new, after = of_texts(texts), of_texts(changed), of_texts(following)
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(hexed(own), pa.string()), pa.array(hexed(new), pa.string()),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))],
            [part.split()[0] for part in schema.split(", ")])

    return with_next(docs, step, schema)
