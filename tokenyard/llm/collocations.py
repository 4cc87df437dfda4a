"""Phrase collocations: counts of repeated phrases by multikey three-way quicksort of suffix pointers, scored by their worst cut.

Every word of a piece begins a suffix of at most ``max_words`` words. A task gathers a chunk of text per language,
merges equal suffixes, and routes each distinct one by its leading words (two, or more where those are hot) to a
fragment, in compressed blocks with their own word lists. A fragment's suffix pointers are partitioned three ways
(less, equal, greater) word by word: the weight of an equal partition is the count of the phrase it shares, and
partitions that together weigh less than ``min_count`` are abandoned, which is right because by then all suffixes
with the same leading words are in one fragment. Phrases that are hot themselves are counted in part by each of their
fragments and summed. Words alone are routed by themselves.

The phrases that stay (at most total words * max_words / min_count) are scored by joins on the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm.common import staged

MAX_WORDS, MIN_COUNT, TOP, COVER_PERCENT = 5, 100, 2000, 100
#: Text bytes that a task merges at a time, and text bytes whose suffixes are one fragment on average.
CHUNK_BYTES, FRAGMENT_BYTES = 4 << 20, 4 << 20
#: Leading words are hot beyond this part of a fragment's (or of all) suffixes in a sample of one document in 64.
_HOT_PART, _HOT_SHARE, _SAMPLE = 4, 1 / 50000, 64
#: One language's first phrases are found in so many parts first.
_PARTS = 64
_U = np.uint64
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _ENDS.copy()
_GAP[[0x20, 0x09]] = True

BLOCKS = "lang string, fragment int, depth int, n int, wide boolean, words binary, codes binary, counts binary"
GRAMS = "lang string, words int, phrase string, a long"


class Chunk:
    """Suffixes of a chunk of text: distinct words, and distinct suffixes (columns of word codes, 0 past the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, max_words: int):
        data = A.LOWER[data]
        edge = np.ones(len(data) + 1, bool)
        gap = _GAP[data]
        edge[1:-1] = gap[1:] != gap[:-1]
        edge[offsets] = True
        at = np.flatnonzero(edge)
        solid = ~gap[at[:-1]] if len(data) else np.zeros(0, bool)
        starts, ends = at[:-1][solid], at[1:][solid]
        piece = np.cumsum(_ENDS[data])[starts] + np.searchsorted(offsets, starts, "right") if len(starts) else starts
        codes, self.blob, self.length = _numbered(data, starts, ends)
        self.at = np.cumsum(self.length) - self.length
        n = len(codes)
        self.counts = np.bincount(codes, minlength=len(self.length) + 1)[1:]
        columns = [codes]
        for k in range(1, max_words):
            column = np.zeros(n, np.int64)
            if n > k:
                same = piece[k:] == piece[:n - k]
                column[:n - k][same] = codes[k:][same]
            columns.append(column)
        pairs = columns[1] > 0 if max_words > 1 else np.zeros(n, bool)
        self.suffixes, self.weights = merged([c[pairs] for c in columns], np.ones(int(pairs.sum()), np.int64))
        self.hashes = A.span_hashes(np.frombuffer(self.blob, np.uint8), self.at, self.at + self.length - 1)

    def words(self, codes: np.ndarray) -> bytes:
        """The words of some codes, each followed by a space."""
        own = codes - 1
        return np.frombuffer(self.blob, np.uint8)[A.take_ranges(self.at[own], self.length[own])].tobytes()


def _numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray]:
    """A code from 1 per word, the distinct words each followed by a space, and their lengths with the space."""
    if not len(starts):
        return np.zeros(0, np.int64), b"", np.zeros(0, np.int64)
    cuts = np.empty(2 * len(starts) + 1, np.int64)  # words and the gaps between them, in turn
    cuts[0:-1:2], cuts[1::2], cuts[-1] = starts, ends, len(data)
    both = pa.Array.from_buffers(pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    index = both.dictionary_encode()
    of_word = index.indices.to_numpy()[::2]
    held = np.bincount(of_word, minlength=len(index.dictionary)) > 0
    words = index.dictionary.filter(pa.array(held)).to_pylist()
    return np.cumsum(held)[of_word], b"".join(w + b" " for w in words), np.array([len(w) + 1 for w in words], np.int64)


def merged(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns of codes in order, and the summed weights of each."""
    if not len(weights):
        return columns, weights
    bits = max(1, int(max(c.max() for c in columns)).bit_length())
    keys = []
    for i in range(0, len(columns), 63 // bits):
        key = columns[i]
        for c in columns[i + 1:i + 63 // bits]:
            key = key << bits | c
        keys.append(key)
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for k in keys:
        k = k[order]
        fresh[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(fresh)
    return [c[order[at]] for c in columns], np.add.reduceat(weights[order], at)


def prefix_hashes(suffixes: list[np.ndarray], hashes: np.ndarray) -> Iterator[np.ndarray]:
    """For routing: a hash of each suffix's first word, first two words, and so on. Equal words, equal hashes."""
    table = np.concatenate([np.array([1], _U), hashes])
    have = np.zeros(len(suffixes[0]), _U)
    for column in suffixes:
        have = A.mix64(have * _U(A._BASE) + table[column])
        yield have


def routes(suffixes: list[np.ndarray], hashes: np.ndarray, hot: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of each suffix: by its first two words, by one word more as long as these are hot."""
    chosen, open_ = None, None
    for k, have in enumerate(prefix_hashes(suffixes, hashes)):
        if k == 0:
            continue
        if chosen is None:
            chosen, open_ = have, _is_hot(have, hot)
        else:
            chosen = np.where(open_, have, chosen)
            open_ &= _is_hot(have, hot)
    return _part(chosen, fragments)


def _is_hot(have: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(have), bool)
    return hot[np.minimum(np.searchsorted(hot, have), len(hot) - 1)] == have


def _part(hashes: np.ndarray, fragments: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(fragments) >> _U(32)).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], max_words: int) -> Iterator[tuple[str, Chunk]]:
    """Chunks of about CHUNK_BYTES of text of one language (a longer text is one of its own); what is left at the end."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def out() -> Iterator[tuple[str, Chunk]]:
        for lang, texts in held.items():
            yield lang, Chunk(np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts]), max_words)
        held.clear()

    for batch in batches:
        data, offsets = A.utf8(batch.column("text"))
        for i, lang in enumerate(batch.column("lang").to_pylist()):
            text = data[offsets[i]:offsets[i + 1]]
            if size and size + len(text) > CHUNK_BYTES:
                yield from out()
                size = 0
            held.setdefault(lang, []).append(text)
            size += len(text) + 64  # empty ones count too
    yield from out()


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True)


def _unpack(raw: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _blocks(lang: str, chunk: Chunk, columns: list[np.ndarray], weights: np.ndarray, part: np.ndarray) -> list[tuple]:
    """A row per fragment: its suffixes as codes into the row's own word list, and their weights."""
    order = np.argsort(part, kind="stable")
    columns, weights, part = [c[order] for c in columns], weights[order], part[order]
    rows = []
    for i, j in A.runs(part):
        used, local = np.unique(np.concatenate([c[i:j] for c in columns]), return_inverse=True)
        if used[0]:  # code 0, past the end, is always there
            used, local = np.concatenate([[0], used]), local + 1
        wide = len(used) > 1 << 16
        rows.append((lang, int(part[i]), len(columns), j - i, wide, chunk.words(used[1:]),
                     _pack(local.astype(np.uint32 if wide else np.uint16)), _pack(weights[i:j])))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _entries(blocks: list[tuple]) -> tuple[list[np.ndarray], np.ndarray, list[bytes], np.ndarray]:
    """(columns of codes, weights, words by code, a hash per word from code 1) of blocks (n, depth, wide, words, codes, counts)."""
    number: dict[bytes, int] = {}
    columns, weights = [], []
    for n, depth, wide, words, codes, counts in blocks:
        table = np.array([0] + [number.setdefault(w, len(number) + 1) for w in words.split(b" ")[:-1]], np.int64)
        columns.append(table[_unpack(codes, n * depth, np.uint32 if wide else np.uint16)].reshape(depth, n))
        weights.append(_unpack(counts, n, np.int64))
    whole = np.concatenate(columns, axis=1)
    listed = [b"", *number]
    blob = np.frombuffer(b"".join(listed), np.uint8)
    ends = np.cumsum([len(w) for w in listed])
    return list(whole), np.concatenate(weights), listed, A.span_hashes(blob, ends[:-1], ends[1:])


def frequent_prefixes(columns: list[np.ndarray], weights: np.ndarray, least: int, seed: int = 0) -> Iterator[tuple[int, int, int]]:
    """(a pointer, words, count) of each prefix of the suffixes that weighs ``least`` or more.

    Multikey three-way quicksort to the maximum depth: a partition of pointers that agree in their first ``depth``
    words is split by its word at ``depth`` into less, equal and greater than a random one's. The equal part agrees in
    a word more, so its weight is a count; parts that weigh less than ``least`` hold no frequent prefix and go.
    """
    rng = np.random.default_rng(seed)
    todo = [(np.arange(len(weights)), 0)]
    while todo:
        at, depth = todo.pop()
        key = columns[depth][at]
        pivot = key[int(rng.integers(len(key)))]
        for part, equal in ((at[key < pivot], False), (at[key == pivot], True), (at[key > pivot], False)):
            weight = int(weights[part].sum())
            if weight < least or not len(part):
                continue
            if not equal:
                todo.append((part, depth))
            elif pivot:  # 0: these suffixes end here
                yield int(part[0]), depth + 1, weight
                if depth + 1 < len(columns):
                    todo.append((part, depth + 1))


def hot_prefixes(texts: DataFrame, fragments: int, max_words: int, one_in: int = _SAMPLE) -> np.ndarray:
    """Sorted hashes of leading words (two or more) with so many distinct suffixes in a sample that they would fill a
    good part of a fragment; at most ``max_words / share`` of them. What the sample misses is only dealt less evenly."""
    share = max(1 / (_HOT_PART * fragments), _HOT_SHARE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in chunks(batches, max_words):
            total = len(chunk.weights)
            keys, counts = [np.zeros(1, _U)], [np.array([total])]
            for k, have in enumerate(prefix_hashes(chunk.suffixes, chunk.hashes)):
                if 0 < k < max_words - 1:
                    key, n = np.unique(have, return_counts=True)
                    some = n > max(1, total * share / 8)
                    keys.append(key[some])
                    counts.append(n[some])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)),
                                              pa.array(np.concatenate(counts).astype(np.int64))], ["key", "n"])

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0) if one_in > 1 else texts
    sums = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    sums = staged(sums, "leading")
    total = sums.where("key = 0").first()  # the suffixes of the sample
    if total is None:
        return np.zeros(0, _U)
    rows = sums.where((F.col("n") > max(1, total.n * share)) & (F.col("key") != 0)).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(_U))


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     fragment_bytes: int = FRAGMENT_BYTES, one_in: int = _SAMPLE) -> DataFrame:
    """Written (lang, words, phrase, a): all phrases of 1 to ``max_words`` words with a count of ``min_count`` or more,
    and with ``words`` 0 the number of all words of each language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    fragments = max(16, -(-size // fragment_bytes))
    hot = hot_prefixes(texts, fragments, max_words, one_in)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in chunks(batches, max_words):
            rows = []
            if len(chunk.counts):
                one = np.arange(1, len(chunk.counts) + 1)
                rows += _blocks(lang, chunk, [one], chunk.counts, routes([one, one * 0], chunk.hashes, hot[:0], fragments))
            if len(chunk.weights):
                rows += _blocks(lang, chunk, chunk.suffixes, chunk.weights,
                                routes(chunk.suffixes, chunk.hashes, hot, fragments))
            for i in range(0, len(rows), 64):
                yield _batch(rows[i:i + 64])

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        held: dict[int, list[tuple]] = {}
        names = ("depth", "n", "wide", "words", "codes", "counts")
        for depth, n, *rest in zip(*(table.column(c).to_pylist() for c in names), strict=True):
            held.setdefault(depth, []).append((n, depth, *rest))
        rows: list[tuple[int, bytes, int]] = []
        for depth in sorted(held):
            columns, weights, words, hashes = _entries(held.pop(depth))
            if depth == 1:
                rows.append((0, b"", int(weights.sum())))
            split = set()  # phrases that other fragments count too
            if depth > 1 and len(hot):
                for k, have in enumerate(prefix_hashes(columns, hashes)):
                    own = _is_hot(have, hot)
                    if 0 < k < max_words - 1 and own.any():
                        some, n = merged([c[own] for c in columns[:k + 1]], weights[own])
                        for *codes, a in zip(*some, n, strict=True):
                            if codes[-1]:
                                split.add(tuple(map(int, codes)))
                                rows.append((k + 1, b" ".join(words[c] for c in codes), int(a)))
            for at, k, a in frequent_prefixes(columns, weights, min_count):
                codes = tuple(int(columns[i][at]) for i in range(k))
                if (k > 1 or depth == 1) and codes not in split:
                    rows.append((k, b" ".join(words[c] for c in codes), a))
        k, phrase, a = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()), "words": pa.array(k, pa.int32()),
                         "phrase": pa.array([p.decode() for p in phrase], pa.string()), "a": pa.array(a, pa.int64())})

    grams = texts.mapInArrow(scan, BLOCKS).groupBy("lang", "fragment").applyInArrow(count, GRAMS)
    summed = grams.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))
    return staged(summed.where((F.col("a") >= min_count) | (F.col("words") == 0)), "phrases")


def scored_phrases(grams: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, n, score) of all phrases of two words or more, by the cut that scores lowest.

    score = floor(1000 * a * n / (l * r)) in exact decimals; ties go to the cut after fewer words.
    """
    salts = F.sequence(F.lit(0).cast("long"), F.lit(_PARTS - 1).cast("long"))
    sizes = grams.where("words = 0").select("lang", F.col("a").alias("n"), F.explode(salts).alias("salt"))
    phrases = grams.where("words > 1").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)))
    phrases = phrases.join(sizes, ["lang", "salt"])  # a language may hold most phrases
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right"))
    part = grams.where("words > 0")
    left = part.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = part.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    both = both.withColumn("up", F.lit(1000).cast("decimal(4,0)") * (exact["a"] * exact["n"])).withColumn(
        "down", exact["l"] * exact["r"]).withColumn("score", F.expr("up div down"))
    best = both.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def covered_phrases(grams: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase, longer): for each phrase inside a longer one the greatest count of those."""
    longer = grams.where("words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("w"))
    runs = longer.select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )).alias("phrase"))
    return runs.groupBy("lang", "phrase").agg((F.max("a") * F.lit(100)).alias("longer")).withColumn("percent", F.lit(percent))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 cover_percent: int = COVER_PERCENT, fragment_bytes: int = FRAGMENT_BYTES, one_in: int = _SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score, count and bytes.

    ``docs``: text and lang, other columns are ignored. A-Z are lower-cased, texts are cut into pieces at
    ``[.,;:!?\\x0A-\\x0D]`` and those into words at spaces and tabs. A null lang counts as ``und``; null and empty texts
    have no words; repeated rows count each; texts of any length count whole; no rows, or no phrase that is frequent
    enough, give no rows. A phrase goes if a longer one of at most ``max_words`` words that holds it has
    ``cover_percent`` % or more of its count. Ties in score go to the greater count, then to the lesser phrase.
    """
    grams = frequent_phrases(docs, max_words, min_count, fragment_bytes, one_in)
    scored = staged(scored_phrases(grams), "scored")
    kept = scored.join(covered_phrases(grams, cover_percent), ["lang", "phrase"], "left").where(
        "longer IS NULL OR longer < percent * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    first = kept.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
