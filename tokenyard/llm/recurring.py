"""Anchors: which stretches of which documents may occur in another document.

Of every window of ``span`` units (words or bytes) the governing gram is the one of ``q`` units with the least
hash, the first of equal ones. Equal windows have equal governing grams, so a window can recur only where its
governor does. Governors are sparse (about 2 in span - q + 2 grams), and only they are shuffled: a batch sends
every fragment of the hash range each distinct gram once, and learns which documents hold grams of others too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm.common import column, staged

_U = np.uint64
#: Entries a worker gathers before it sends them (of at most _MOST_ROWS documents), and entries of a fragment.
BATCH_ENTRIES, FRAGMENT_ENTRIES = 1 << 19, 1 << 19
_MOST_ROWS, _SURE, _LIST_PARTS = 32000, 1 << 15, 1 << 12

#: Units of a text: (data, row offsets) to (a 64-bit hash per unit, offset of each row in units).
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return A._BYTE[data], offsets


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = A.word_spans(data, offsets)
    return A.span_hashes(data, starts, ends), first


def governors(units: np.ndarray, rows: np.ndarray, q: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one row, the place of each one's governing gram, and the hash of every gram."""
    grams = A.run_hashes(units, q)
    size = np.diff(rows)
    windows = A.take_ranges(rows[:-1], np.maximum(size - span + 1, 0))
    if not len(windows):
        return windows, windows, grams
    keys = (grams >> _U(32) << _U(32)) | np.arange(len(grams), dtype=_U)
    least = A.sliding(keys, span - q + 1, np.minimum)[windows]
    return windows, (least & _U(0xFFFFFFFF)).astype(np.int64), grams


def _anchors(batches: Iterator[pa.RecordBatch], units: Units, q: int, span: int):
    """(doc ids, row of each anchor, gram of each anchor) in parts of bounded text."""
    for batch in batches:
        data, offsets = A.utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in A.row_chunks(offsets):
            part = offsets[i:j + 1]
            unit, rows = units(data[part[0]:part[-1]], part - part[0])
            _, governor, grams = governors(unit, rows, q, span)
            at = governor[A.segments(governor)]
            yield ids[i:j], np.searchsorted(rows, at, "right") - 1, grams[at]


def deal(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], fragments: int) -> Iterator[pa.RecordBatch]:
    """Blocks for the fragments, and (negative parts) what a batch knows by itself: keys that several of its documents hold.

    ``parts``: (doc ids, row, key). Of each distinct key one entry, with the least document, is sent; it is marked
    sure if other documents of the batch hold the key too, and all of these get the key as a list at once.
    """
    gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_rows = n_entries = 0

    def out() -> pa.RecordBatch:
        base = np.cumsum([0] + [len(g[0]) for g in gathered])
        docs = np.concatenate([g[0] for g in gathered])
        doc = docs[np.concatenate([g[1] + b for g, b in zip(gathered, base, strict=False)])]
        key = np.concatenate([g[2] for g in gathered])
        order = np.lexsort((doc, key))
        doc, key = doc[order], key[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        doc, key = doc[fresh], key[fresh]
        at = A.segments(key)
        length = np.diff(np.append(at, len(key)))
        rows: list[tuple] = []
        several = np.repeat(length > 1, length)
        if several.any():
            rows += _lists(doc[several], key[several])
        table, index = np.unique(doc[at], return_inverse=True)
        sure = np.where(length > 1, _SURE, 0).astype(np.uint16)
        one = key[at]
        part = _fragment(one, fragments)
        for i, j in A.runs(part):
            used, local = np.unique(index[i:j], return_inverse=True)
            rows.append((int(part[i]), None, None, table[used].tobytes(), (local.astype(np.uint16) | sure[i:j]).tobytes(),
                         one[i:j].tobytes()))
        return _batch(rows)

    for docs, row, key in parts:
        for i in range(0, max(len(docs), 1), _MOST_ROWS):
            own = (row >= i) & (row < i + _MOST_ROWS) if len(docs) > _MOST_ROWS else slice(None)
            some = docs[i:i + _MOST_ROWS]
            if n_rows + len(some) > _MOST_ROWS or n_entries >= BATCH_ENTRIES:
                if n_entries:
                    yield out()
                gathered, n_rows, n_entries = [], 0, 0
            gathered.append((some, row[own] - i, key[own]))
            n_rows += len(some)
            n_entries += len(gathered[-1][1])
    if n_entries:
        yield out()


BLOCKS = "part int, doc_id long, keys binary, docs binary, index binary, ids binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _lists(doc: np.ndarray, key: np.ndarray) -> list[tuple]:
    order = np.argsort(doc, kind="stable")
    doc, key = doc[order], key[order]
    return [(-1 - int(doc[i]) % _LIST_PARTS, int(doc[i]), key[i:j].tobytes(), None, None, None) for i, j in A.runs(doc)]


def _fragment(keys: np.ndarray, fragments: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(fragments) >> _U(32)).astype(np.int64)


def entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, doc, sure) of a fragment's blocks, sorted by key and document."""
    doc, key, sure = [], [], []
    for docs, index, ids in zip(*(table.column(c).to_pylist() for c in ("docs", "index", "ids")), strict=True):
        at = np.frombuffer(index, np.uint16)
        doc.append(np.frombuffer(docs, np.int64)[at & (_SURE - 1)])
        key.append(np.frombuffer(ids, _U))
        sure.append(at >= _SURE)
    doc, key, sure = np.concatenate(doc), np.concatenate(key), np.concatenate(sure)
    order = np.lexsort((doc, key))
    return key[order], doc[order], sure[order]


def shared_keys(blocks: DataFrame, least_only: bool = False) -> DataFrame:
    """(doc_id, keys): the keys that two documents hold or more, by document; with ``least_only`` by the least one."""

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:  # a batch has listed these
            return table.select(["doc_id", "keys"])
        key, doc, sure = entries(table)
        at = A.segments(key)
        length = np.diff(np.append(at, len(key)))
        known = np.logical_or.reduceat(sure, at) if len(at) else at.astype(bool)
        several = known | (doc[at] != doc[at + length - 1])
        if least_only:
            doc, key = doc[at][several], key[at][several]
        else:
            keep = np.repeat(several, length) & ~sure
            doc, key = doc[keep], key[keep]
        rows = _lists(doc, key)
        return pa.table({"doc_id": pa.array([r[1] for r in rows], pa.int64()),
                         "keys": pa.array([r[2] for r in rows], pa.binary())})

    return (blocks.where("part >= 0") if least_only else blocks).groupBy("part").applyInArrow(
        count, "doc_id long, keys binary")


def n_fragments(n: int) -> int:
    """Fragments for n entries. A document's keys come back in a row per fragment; with many fragments from the start,
    that is a row for nearly each key at any size, and rows follow the keys."""
    return max(128, -(-n // FRAGMENT_ENTRIES))


def with_shared_anchors(docs: DataFrame, units: Units, q: int, span: int) -> DataFrame:
    """Written rows (doc_id, text, rest, anchors): every row of ``docs`` (its other columns in the struct ``rest``)
    and its governing grams that other documents have too (an array of bytes, null for none). Rows with a null id
    have none."""
    rest = F.struct(*[column(c) for c in docs.columns if c != "text"]).alias("rest")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = n_fragments(2 * size // (span - q + 2) // (1 if units is byte_units else 5))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return deal(_anchors(batches, units, q, span), fragments)

    blocks = texts.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(scan, BLOCKS)
    keys = staged(shared_keys(blocks), "anchors")
    per_doc = keys.groupBy("doc_id").agg(F.collect_list("keys").alias("anchors"))
    named = texts.where("doc_id IS NOT NULL").join(per_doc, "doc_id", "left")  # null ids would meet in one task
    return staged(named.unionByName(texts.where("doc_id IS NULL"), allowMissingColumns=True), "anchored")


def joined_keys(lists) -> np.ndarray:
    """The sorted distinct keys of an array of bytes."""
    return np.unique(np.frombuffer(b"".join(lists), _U))


def member(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)] == values


def covered(starts: np.ndarray, span: int, n: int) -> np.ndarray:
    """Mask of the units within a window of the starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + span, n), -1)
    return np.cumsum(edge[:-1]) > 0


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
