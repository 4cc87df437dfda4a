"""Byte language model by context-tree weighting.

Texts are lower-cased (A-Z) UTF-8 bytes with an end byte. A byte is decomposed into eight binary decisions; every
decision node has a context tree over the five bytes before. Each tree node mixes its Krichevsky-Trofimov (KT)
estimate, weight one half, with the product of its children, so all depths 0 to 5 take part; the prediction mixes
the estimates along the path with the weights that the training counts leave.

1. Texts are gathered into batches of bounded size, one row each, so that a batch is the same in all passes.
2. Every batch sends its distinct (context, byte) grams and words, with their training counts, to fragments by the
   two latest context bytes (grams) or by hash (words).
3. Fragments sum the counts and weight the trees from the leaves up to depth 2; sums per depth-1 node (at most
   256 * 255) go to the driver, which weights depths 1 and 0.
4. Fragments predict each gram, and answer every batch with the log probabilities of its own grams, and counts of
   its own words; batches add them up per document.

Nothing is sampled: all training documents are counted, all grams are answered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm.common import staged

DEPTH, _END = 5, 255  # 0xFF is in no UTF-8 text: it ends a text and stands before it
#: Text bytes of a batch, and of the corpus per fragment.
BATCH_BYTES, FRAGMENT_BYTES = 3 << 20, 1 << 23
_U = np.uint64
_HALF = np.log(0.5)
_STOP = _U(0xE0D)  # the word number of a text's end
_BLOCKS = "kind int, part int, batch long, keys binary, counts binary"
_ANSWERS = "batch long, kind int, part int, found binary"


def held_out(doc_id: int | None, folds: int = 7, fold: int = 2) -> bool:
    """Whether crc32 of the id as text leaves the remainder of the held-out fold; a null id is an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def _batches(docs: DataFrame) -> DataFrame:
    """Rows (batch, ids, sizes, text): documents in batches of bounded bytes, texts lower-cased and compressed."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, texts, have = [], [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.concatenate(sizes).astype("<i8").tobytes()], pa.binary()),
                pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary())],
                ["batch", "ids", "sizes", "text"])

        for batch in batches:
            data, offsets = A.utf8(batch.column("text"))
            own = batch.column("doc_id").to_pylist()
            for i, j in A.row_chunks(offsets):
                ids += own[i:j]
                sizes.append(np.diff(offsets[i:j + 1]))
                texts.append(A.LOWER[data[offsets[i]:offsets[j]]].tobytes())
                have += len(texts[-1])
                if have >= BATCH_BYTES:
                    yield out()
                    number += 1
                    ids, sizes, texts, have = [], [], [], 0
        if ids:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        gather, "batch long, ids array<long>, sizes binary, text binary")


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte and per text end: the five bytes before, latest first, and the byte itself; and rows' offsets."""
    n, pad = len(offsets) - 1, DEPTH + 1
    text = np.full(len(data) + pad * n + DEPTH, _END, np.uint8)
    inside = np.ones(len(data) + pad * n, bool)  # a row's bytes and its end, then the marks before the next row
    ends = offsets[1:] + pad * np.arange(n)
    for k in range(1, pad):
        inside[ends + k] = False
    bytes_only = inside.copy()
    bytes_only[ends] = False
    text[DEPTH:][bytes_only] = data
    keys = text[DEPTH:].astype(_U)
    for back in range(1, DEPTH + 1):
        keys |= text[DEPTH - back:len(text) - back].astype(_U) << _U(8 * (DEPTH + 1 - back))
    return keys[inside], offsets + np.arange(n + 1)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its hash, then the end's number; and rows' offsets."""
    starts, ends, first = A.word_spans(data, offsets)
    n = len(offsets) - 1
    keys = np.full(len(starts) + n, _STOP, _U)
    row = np.repeat(np.arange(n), np.diff(first))
    keys[np.arange(len(starts)) + row] = A.span_hashes(data, starts, ends)
    return keys, first + np.arange(n + 1)


_KINDS = (gram_keys, word_keys)


def _part(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    spread = A.mix64(keys >> _U(8 * (DEPTH - 1))) if kind == 0 else keys  # the two latest context bytes
    return ((spread >> _U(40)) % _U(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for k in range(batch.num_rows):
            sizes = np.frombuffer(batch.column("sizes")[k].as_py(), "<i8")
            raw = pa.decompress(batch.column("text")[k].as_py(), int(sizes.sum()), codec="zstd", asbytes=True)
            data = np.frombuffer(raw, np.uint8)
            yield batch, k, batch.column("ids")[k].as_py(), data, np.concatenate([[0], np.cumsum(sizes)])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the keys, where in it each distinct key begins, and the distinct keys."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    at = A.segments(sorted_keys)
    return order, at, sorted_keys[at]


def _packed(values: np.ndarray) -> bytes:
    """An array of integers or floats, compressed byte plane by byte plane behind its length."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, dtype: str) -> np.ndarray:
    size, item = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    planes = pa.decompress(raw[8:], decompressed_size=size * item, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(item, size).T).reshape(-1).view(dtype)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as differences."""
    return _packed(np.diff(keys, prepend=_U(0)))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, "<u8"), dtype=_U)


def _counted(blobs: DataFrame, parts: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, ids, data, offsets in _texts(batches):
            number = batch.column("batch")[k].as_py()
            train = np.array([not held_out(i) for i in ids])
            rows = []
            for kind, keys_of in enumerate(_KINDS):
                keys, row_at = keys_of(data, offsets)
                distinct = np.unique(keys)
                known, times = np.unique(keys[np.repeat(train, np.diff(row_at))], return_counts=True)
                counts = np.zeros(len(distinct), np.uint32)
                counts[np.searchsorted(distinct, known)] = times
                part = _part(kind, distinct, parts)
                order = np.argsort(part, kind="stable")
                distinct, counts, part = distinct[order], counts[order], part[order]
                for i, j in A.runs(part):
                    rows.append((kind, int(part[i]), number, _packed_keys(distinct[i:j]), _packed(counts[i:j])))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()),
                                                strict=True)], [f.split()[0] for f in _BLOCKS.split(", ")])

    return blobs.mapInArrow(count, _BLOCKS)


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of a part's blocks, their total training counts, and each block's keys."""
    own = [_unpacked_keys(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([_unpacked(c, "<u4") for c in table.column("counts").to_pylist()])
    order, at, keys = _distinct(np.concatenate(own))
    return keys, np.add.reduceat(counts[order].astype(np.int64), at), own


def _answers(table: pa.Table, kind: int, part: int, keys: np.ndarray, own: list, values: np.ndarray) -> pa.Table:
    found = [_packed(values[np.searchsorted(keys, k)]) for k in own]
    n = table.num_rows
    return pa.table({"batch": table.column("batch"), "kind": pa.array([kind] * n, pa.int32()),
                     "part": pa.array([part] * n, pa.int32()), "found": pa.array(found, pa.binary())})


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x >= 0.5 (Stirling's series, seven steps up)."""
    y = x + 7.0
    rising = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(rising)


_TABLE = 1 << 16
_tables: list[np.ndarray] = []


def _known_gamma(counts: np.ndarray, which: int) -> np.ndarray:
    """Log gamma of count + 1/2 (0) or count + 1 (1), from a table where counts are small."""
    if not _tables:
        _tables.extend([log_gamma(np.arange(_TABLE) + 0.5), log_gamma(np.arange(_TABLE) + 1.0)])
    out = _tables[which][np.minimum(counts, _TABLE - 1).astype(np.int64)]
    large = counts >= _TABLE
    if large.any():
        out[large] = log_gamma(counts[large] + (1.0 if which else 0.5))
    return out


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the KT probability of any sequence with these counts."""
    return _known_gamma(n0, 0) + _known_gamma(n1, 0) - _known_gamma(n0 + n1, 1) - np.log(np.pi)


def _levels(keys: np.ndarray, counts: np.ndarray) -> dict:
    """Per depth from DEPTH to 2 the distinct (context of this depth, byte) and their counts."""
    out = {DEPTH: (keys, counts)}
    for depth in range(DEPTH - 1, 1, -1):
        keys, counts = out[depth + 1]
        short = ((keys >> _U(16)) << _U(8)) | (keys & _U(255))
        order, at, distinct = _distinct(short)
        out[depth] = distinct, np.add.reduceat(counts[order], at)
    return out


def _nodes(level: tuple[np.ndarray, np.ndarray], bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decision nodes after ``bit`` bits of the byte: number, count of 0 and of 1."""
    keys, counts = level
    number = keys >> _U(8 - bit)
    at = A.segments(number)
    ones = np.add.reduceat(counts * ((keys >> _U(7 - bit)) & _U(1)).astype(np.int64), at)
    return number[at], np.add.reduceat(counts, at) - ones, ones


def _parents(number: np.ndarray, bit: int) -> np.ndarray:
    """The node with one context byte less."""
    return ((number >> _U(bit + 8)) << _U(bit)) | (number & _U((1 << bit) - 1))


def _weighted(levels: dict, bit: int, lowest: int) -> dict:
    """Per depth from DEPTH to ``lowest``: node numbers, counts, log KT, log of the weighted probability."""
    out, below = {}, None
    for depth in range(DEPTH, lowest - 1, -1):
        number, n0, n1 = _nodes(levels[depth], bit)
        own = kt(n0, n1)
        if below is None:
            weighted = own
        else:
            place = np.searchsorted(number, _parents(below[0], bit))
            kids = np.bincount(place, weights=below[4], minlength=len(number))
            weighted = np.logaddexp(own, kids) + _HALF
        below = out[depth] = (number, n0, n1, own, weighted)
    return out


def _top_sums(keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    """Per decision node of depth 1: counts, and the sum of its children's weighted logs in this part."""
    levels = _levels(keys, counts)
    rows = [[], [], [], [], []]
    for bit in range(8):
        number, n0, n1, _, weighted = _weighted(levels, bit, 2)[2]
        up, place = np.unique(_parents(number, bit), return_inverse=True)
        for column, values in zip(rows, (np.full(len(up), bit), up.astype(np.int64), np.bincount(place, weights=n0),
                                         np.bincount(place, weights=n1), np.bincount(place, weights=weighted)),
                                  strict=True):
            column.append(values)
    bit, node, n0, n1, logs = (np.concatenate(r) for r in rows)
    return pa.table({"bit": bit.astype(np.int32), "node": node, "n0": n0, "n1": n1, "logs": logs})


class Top:
    """Depths 1 and 0 of all trees: per bit arrays (visited, KT prediction of 1, weight of the node's own estimate)."""

    def __init__(self, rows):
        self.one, self.root = [], []
        for bit in range(8):
            n0, n1, logs = (np.zeros(256 << bit) for _ in range(3))
            for r in rows:
                if r["bit"] == bit:
                    n0[r["node"]], n1[r["node"]], logs[r["node"]] = r["n0"], r["n1"], r["logs"]
            self.one.append(self._mix(n0, n1, logs))
            own = np.logaddexp(kt(n0, n1), logs) + _HALF
            sums = [x.reshape(256, 1 << bit).sum(axis=0) for x in (n0, n1, own)]
            self.root.append(self._mix(*sums))

    @staticmethod
    def _mix(n0, n1, kids):
        own = kt(n0, n1)
        return n0 + n1 > 0, (n1 + 0.5) / (n0 + n1 + 1), np.exp(own - np.logaddexp(own, kids))


def predictions(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 probability of each gram's byte after its context; contexts never seen leave their parent's estimate."""
    levels = _levels(keys, counts)
    out = np.zeros(len(keys))
    for bit in range(8):
        tree = _weighted(levels, bit, 2)
        number, n0, n1, _, _ = tree[DEPTH]
        p, seen, node = (n1 + 0.5) / (n0 + n1 + 1), n0 + n1 > 0, number
        for depth in range(DEPTH - 1, -1, -1):
            node = _parents(node, bit)
            if depth >= 2:
                up, u0, u1, own, weighted = tree[depth]
                place = np.searchsorted(up, node)
                visited, estimate = (u0 + u1 > 0)[place], ((u1 + 0.5) / (u0 + u1 + 1))[place]
                weight = np.exp(own + _HALF - weighted)[place]
            else:
                visited, estimate, weight = (x[node.astype(np.int64)] for x in (top.one if depth else top.root)[bit])
            p = np.where(visited, np.where(seen, weight * estimate + (1 - weight) * p, estimate), p)
            seen = seen | visited
        place = np.searchsorted(number, keys >> _U(8 - bit))
        one = ((keys >> _U(7 - bit)) & _U(1)).astype(bool)
        out += np.log10(np.where(one, p[place], 1 - p[place]))
    return out


def score_documents(docs: DataFrame) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score, score (log10), bytes, bits_per_byte.

    Training documents are those not :func:`held_out`. ``base_score`` is the add-one unigram model over words and
    ends. Null text: empty (one end). Null id: a training document. Repeated rows count each time. Other columns
    are ignored. No rows: no rows. Without training texts every byte has probability 1/256.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, -(-size // FRAGMENT_BYTES))
    blobs = staged(_batches(docs), "ctw-batches")
    blocks = staged(_counted(blobs, parts), "ctw-blocks", batch_rows=1)

    def tops(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _top_sums(*_summed(table)[:2])

    sums = (blocks.where("kind = 0").groupBy("part")
            .applyInArrow(tops, "bit int, node long, n0 double, n1 double, logs double")
            .groupBy("bit", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("logs").alias("logs")))
    top = Top(sums.orderBy("bit", "node").collect())

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        keys, counts, own = _summed(table)
        values = predictions(keys, counts, top).astype("<f4") if kind == 0 else counts.astype("<i8")
        out = _answers(table, kind, part, keys, own, values)
        if kind == 1:  # a row of its own: the part's words and how many are known
            total = _packed(np.array([counts.sum(), (counts > 0).sum()], "<i8"))
            out = pa.concat_tables([out, pa.table({
                "batch": pa.array([-1], pa.int64()), "kind": pa.array([2], pa.int32()),
                "part": pa.array([part], pa.int32()), "found": pa.array([total], pa.binary())})])
        return out

    answers = staged(blocks.groupBy("kind", "part").applyInArrow(answer, _ANSWERS), "ctw-answers")
    totals = answers.where("kind = 2").select("found").toLocalIterator()
    n_train, n_words = 0, 0
    for r in totals:
        own = _unpacked(r[0], "<i8")
        n_train, n_words = n_train + int(own[0]), n_words + int(own[1])
    per_batch = (answers.where("kind < 2").groupBy("batch")
                 .agg(F.collect_list(F.struct("kind", "part", "found")).alias("answers")))
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, n_bytes long, bits_per_byte double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, ids, data, offsets in _texts(batches):
            got = sorted(batch.column("answers")[k].as_py(), key=lambda a: (a["kind"], a["part"]))
            per_key = []
            for kind, (keys_of, dtype) in enumerate(zip(_KINDS, ("<f4", "<i8"), strict=True)):
                keys, row_at = keys_of(data, offsets)
                code, distinct = pd.factorize(keys)
                order = np.argsort(distinct)
                values = np.empty(len(distinct), dtype)
                distinct = distinct[order]
                values[np.argsort(_part(kind, distinct, parts), kind="stable")] = np.concatenate(
                    [_unpacked(a["found"], dtype) for a in got if a["kind"] == kind])
                by_code = np.empty_like(values)
                by_code[order] = values
                per_key.append((by_code[code], row_at))
            (logs, at), (counts, word_at) = per_key
            full = np.add.reduceat(logs, at[:-1], dtype=np.float64)
            base = np.add.reduceat(np.log10((counts + 1) / (n_train + n_words + 1)), word_at[:-1])
            known = np.add.reduceat((counts > 0).astype(np.int64), word_at[:-1])
            length = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([held_out(i) for i in ids]), pa.array(np.diff(word_at)),
                pa.array(known), pa.array(np.full(len(ids), n_train, np.int64)), pa.array(base), pa.array(full),
                pa.array(length), pa.array(-full * np.log2(10) / np.maximum(length, 1))],
                [f.split()[0] for f in schema.split(", ")])

    return staged(blobs.join(per_batch, "batch").mapInArrow(score, schema), "ctw-scores", batch_rows=1)
