"""Best-fit packing of tokenized documents into fixed-length sequences.

Documents are tokenized where they lie; only piece lengths are packed. Pieces are dealt at random into
groups of bounded size, each packed by best-fit decreasing; the bins that stay loose in a group are packed
again as wholes with those of other groups, in ever fewer groups, until one group holds all loose bins.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenyard.llm.common import staged

#: Pieces packed by one task at a time.
GROUP_PIECES = 1 << 17
#: Bins fuller than this share of a sequence are final; others are packed again with other groups' bins.
LOOSE_BELOW = 0.98
#: Strings whose ids a worker remembers between texts, and the longest such string.
_MEMORY, _LONGEST = 1 << 19, 64
#: Strings of these letters are one word of the tokenizer each, alone or before one of these marks.
_WORD = re.compile(r"[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_MARKS = ".,;:"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Ids:
    """Token ids of texts as little-endian 32-bit integers, remembering those of recent strings.

    The tokenizer folds case, drops white space and never joins across it or across a word's last letter, so a
    text's ids are its strings' ids in order, and a word with a mark behind it is the word's ids and the mark's.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In lower case, words as _WORD has them are normal and one piece each: only their merges are left to do.
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.merger.model._resize_cache(0)  # no word is encoded twice while it is remembered here
        self.marks = dict(zip(_MARKS, self._each(list(_MARKS)), strict=True))
        self.memory: dict[str, bytes] = {"": b""}

    def _each(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, strings: list[str]) -> list[bytes]:
        """Ids of words, all encoded in one text and cut at the tokens that end a word."""
        if not strings:
            return []
        ids = np.array(self.merger.encode_batch_fast([" ".join(strings).lower()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(strings) or ends[-1] != len(ids):
            return self._each(strings)
        raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, strings: set[str]) -> list[str]:
        """Adds the strings that the memory lacks; gives those too long to stay there."""
        memory = self.memory
        new = strings.difference(memory)
        marked = [s for s in new if s[-1] in _MARKS and _WORD.fullmatch(s, 0, len(s) - 1)]
        words = [s for s in new if _WORD.fullmatch(s)]
        others = list(new.difference(marked, words))
        words += {s[:-1] for s in marked}.difference(memory, words)
        memory.update(zip(words, self._words(words), strict=True))
        memory.update(zip(others, self._each(others), strict=True))
        memory.update([(s, memory[s[:-1]] + self.marks[s[-1]]) for s in marked])
        return [s for s in [*words, *others, *marked] if len(s) > _LONGEST]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.memory) > _MEMORY:
            self.memory = {"": b""}
        whole = [any(s in t or s in t.lower() for s in self.specials) if "<" in t else False for t in texts]
        split = [[] if w else t.encode().translate(_LOWER).decode().replace("\n", " ").split(" ")
                 for t, w in zip(texts, whole, strict=True)]
        long = self._learn(set().union(*split))
        known = self.memory.__getitem__
        found = [self._each([t])[0] if w else b"".join(map(known, strings))
                 for t, strings, w in zip(texts, split, whole, strict=True)]
        for s in long:
            del self.memory[s]
        return found


_loaded: dict[str, _Ids] = {}


def _ids(path: str) -> _Ids:
    """One tokenizer and memory per worker process, kept between its tasks."""
    if path not in _loaded:
        _loaded[path] = _Ids(path)
    return _loaded[path]


def token_pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Per piece of at most ``length`` tokens: ``doc_id, piece, start, length, ids_crc32`` and the ``ids`` as bytes.

    A document's ids are the tokenizer's, then ``end_id``. Null text: empty, that is one piece ``[end_id]``.
    Repeated rows give repeated pieces. ``tokenizer`` is the path of a file that every executor can read.
    """
    fields = [("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("piece", "int"), ("start", "bigint"),
              ("length", "bigint"), ("ids_crc32", "bigint")] + ([("ids", "binary")] if with_ids else [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(tokenizer)
        mark = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [[] for _ in fields]
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), ids_of(texts), strict=True):
                    ids += mark
                    for piece, start in enumerate(range(0, len(ids), 4 * length)):
                        own = ids[start:start + 4 * length]
                        for column, value in zip(rows, (doc, piece, start // 4, len(own) // 4, zlib.crc32(own), own),
                                                 strict=False):
                            column.append(value)
                types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, types, strict=False)], [n for n, _ in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, ", ".join(f"`{n}` {t}" for n, t in fields))


class BestFit:
    """Open bins in a segment tree over remaining capacities: the tightest that fits is found in log time."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves = capacity, 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)  # a node is 1 if some bin has a capacity below it
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def take(self, size: int) -> tuple[int, int] | None:
        """The bin of the least remaining capacity >= size, and that capacity; it is no longer open."""
        tree, node = self.tree, size + self.leaves
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not tree[2 * node])
        left = node - self.leaves
        found = self.bins[left].pop()
        if not self.bins[left]:
            self._mark(left, 0)
        return found, left

    def put(self, found: int, left: int) -> None:
        if not self.bins[left]:
            self._mark(left, 1)
        self.bins[left].append(found)

    def _mark(self, left: int, value: int) -> None:
        node = left + self.leaves
        self.tree[node] = value
        node >>= 1
        while node:
            now = self.tree[2 * node] | self.tree[2 * node + 1]
            if self.tree[node] == now:
                break
            self.tree[node] = now
            node >>= 1


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size (in ties, of equal sizes, the first goes first), and the fill of each bin."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins, opened = BestFit(capacity), 0
    fills: list[int] = []
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        hit = open_bins.take(size)
        if hit is None:
            hit = opened, capacity
            opened += 1
            fills.append(0)
        found, left = hit
        bins[i], offsets[i] = found, capacity - left
        fills[found] += size
        if left > size:
            open_bins.put(found, left - size)
    return bins, offsets, np.array(fills, np.int64)


def _pack_groups(items: DataFrame, n_groups: int, length: int, round_no: int) -> DataFrame:
    """Items (item, size) dealt into groups by hash and packed; per item its bin, its offset there, the bin's fill."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        bins, offsets, fills = best_fit_decreasing(table.column("size").to_numpy(), length)
        name = bins + ((round_no << 58) | (key[0].as_py() << 32))
        return pa.table({"item": table.column("item"), "bin": name, "at": offsets, "fill": fills[bins]})

    group = F.pmod(F.xxhash64(F.lit(round_no), "item"), F.lit(n_groups)).cast("int")
    return (items.withColumn("g", group).groupBy("g")
            .applyInArrow(pack, "item bigint, bin bigint, at bigint, fill bigint"))


def pack_best_fit(pieces: DataFrame, length: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """All columns of ``pieces`` (a column ``length`` of 1 to ``length`` each) with ``sequence_id`` and ``offset``.

    Every piece goes into exactly one sequence; sequences are filled from offset 0 without gaps. Loose bins of
    many groups are packed again as wholes until they are one group, or no longer halve. Equal lengths are placed
    in the order of the staged rows. No pieces: no rows. Input columns of the two added names are replaced.
    """
    rows = staged(pieces.drop("sequence_id", "offset").withColumn("__item", F.monotonically_increasing_id()),
                  "pack-pieces")
    items = rows.select(F.col("__item").alias("item"), F.col("length").cast("long").alias("size"))
    placed, round_no, before = None, 0, None
    while True:
        count = items.count()
        n_groups = max(1, -(-count // group_pieces))
        packed = staged(_pack_groups(items, n_groups, length, round_no), f"pack-round-{round_no}")
        if placed is None:
            placed = packed.select("item", "bin", "at")
        else:  # a loose bin moved as a whole
            moved = packed.select(F.col("item").alias("bin"), F.col("bin").alias("into"), F.col("at").alias("by"))
            placed = placed.join(moved, "bin", "left").select(
                "item", F.coalesce("into", "bin").alias("bin"), (F.col("at") + F.coalesce("by", F.lit(0))).alias("at"))
        if n_groups == 1 or (before is not None and 2 * count > before):
            break
        round_no, before = round_no + 1, count
        items = (packed.where(F.col("fill") < LOOSE_BELOW * length)
                 .select(F.col("bin").alias("item"), F.col("fill").alias("size")).distinct())
    out = placed.select(F.col("item").alias("__item"), F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    return rows.join(out, "__item").drop("__item")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids themselves: per ``sequence_id`` its ``tokens`` (bytes) and ``n_tokens``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("tokens"))
