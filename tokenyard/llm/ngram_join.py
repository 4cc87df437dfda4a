"""Exact n-gram Jaccard join by vertical partitioning.

A document's set of hashed n-grams is cut along the global n-gram order into fragments (ranges of the hash).
Each fragment sees, for its range only, which documents share which n-grams. Documents with equal sets are one
class from the start, so a group of copies counts once.

1. Scan: the set's size and class of every document; n-grams in a large share of a batch are reported, and those
   in a large share of all documents (few, by arithmetic) are put last in the order instead of being dealt out.
2. Scan: every batch sends each fragment its n-grams, six bytes each. Fragments return the n-grams that another
   class has too, packed by bucket of classes. A class keeps going only if such n-grams are 80% of its set.
3. Prefixes in the order rare to frequent give candidates: first, in a few rounds, each list's documents with one
   hub, then, between documents that are not yet in one component, all pairs that a list, the sizes, the positions
   and a parity sketch (a lower bound of the difference) allow.
4. Candidates are verified fragment by fragment: partial overlaps are counted apart and summed per pair.

Components are the same as those of all links, without listing a group's pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenyard.llm import arrays as A
from tokenyard.llm.common import column, staged
from tokenyard.llm.graph import components

_U = np.uint64
#: N-grams that a fragment holds on average, and that a worker gathers before it sends them.
FRAGMENT_GRAMS, BATCH_GRAMS = 1 << 21, 1 << 20
#: Share of the documents from which an n-gram is common; at most (mean set size / share) n-grams are.
COMMON_SHARE = 0.005
#: Parts in which candidate pairs are verified.
VERIFY_PARTS = 4
#: Rounds in which each candidate list meets one hub, before the pairs left over are listed.
HUB_ROUNDS = 3
_COMMON_RANK = 127


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the sorted distinct hashes of its word n-grams (A-Z lower-cased), flat, and the offset of each row.

    A row of fewer words has one: its whole sequence; a row without words has none.
    """
    data = A.LOWER[data]
    starts, ends, first = A.word_spans(data, offsets)
    words = A.span_hashes(data, starts, ends)
    count = np.diff(first)
    grams = A.run_hashes(words, n)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    flat = np.zeros(at[-1], _U)
    long = count >= n
    flat[A.take_ranges(at[:-1][long], size[long])] = grams[A.take_ranges(first[:-1][long], size[long])]
    for m in range(1, n):
        rows = np.flatnonzero(count == m)
        if len(rows):
            flat[at[rows]] = A.run_hashes(words, m)[first[rows]]
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        flat[i:j].sort()
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    fresh[at[:-1][size > 0]] = True
    kept = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(fresh, out=kept[1:])
    return flat[fresh], kept[at]


def set_classes(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit name of each row's set."""
    sums = np.zeros(len(flat) + 1, _U)
    np.cumsum(A.mix64(flat ^ _U(0x5BD1E995)), out=sums[1:])
    return A.mix64((sums[at[1:]] - sums[at[:-1]]) + np.diff(at).astype(_U) * _U(0x9E3779B97F4A7C15))


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    """(rows of the batch, sets, offsets) in parts of bounded text."""
    for batch in batches:
        data, offsets = A.utf8(batch.column("text"))
        for i, j in A.row_chunks(offsets):
            part = offsets[i:j + 1]
            yield (batch, i, j, *gram_sets(data[part[0]:part[-1]], part - part[0], n))


def _gathered(batches: Iterator[pa.RecordBatch], n: int):
    """Distinct classes and their sets, gathered until they are many; (classes, sizes, flat)."""
    names, sizes, flats, have = [], [], [], 0

    def out():
        name, size, flat = np.concatenate(names), np.concatenate(sizes), np.concatenate(flats)
        _, one = np.unique(name, return_index=True)
        start = np.cumsum(size) - size
        return name[one], size[one], flat[A.take_ranges(start[one], size[one])]

    for _, _, _, flat, at in _sets(batches, n):
        names.append(set_classes(flat, at))
        sizes.append(np.diff(at))
        flats.append(flat)
        have += len(flat)
        if have >= BATCH_GRAMS:
            yield out()
            names, sizes, flats, have = [], [], [], 0
    if names:
        yield out()


_KEYS = ("key_a", "key_b")


def _row_keys(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row's columns, nulls told apart; maps, which have no hash, are left out."""
    cols = [column(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    nulls = [c.isNull() for c in cols]
    return [F.xxhash64(F.lit(i), *cols, *nulls).alias(k) for i, k in enumerate(_KEYS)]


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """One row per document (doc_id, n_shingles, class, and key_a, key_b of its row), and rows with ``times`` for
    n-grams frequent in a batch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept():
            for batch, i, j, flat, at in _sets(batches, n):
                rows.append(pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(np.diff(at)),
                    pa.array(set_classes(flat, at).view(np.int64)), pa.nulls(j - i, pa.int64()),
                    pa.nulls(j - i, pa.int64()), *[batch.column(k).slice(i, j - i) for k in _KEYS]], names))
                yield flat, at

        rows: list[pa.RecordBatch] = []
        flats, docs_seen, have = [], 0, 0
        for flat, at in kept():
            yield rows.pop()
            _, one = np.unique(set_classes(flat, at), return_index=True)
            size = np.diff(at)[one]
            flats.append(flat[A.take_ranges(at[:-1][one], size)])
            docs_seen += len(one)
            have += len(flats[-1])
            if have >= BATCH_GRAMS:
                yield report(flats, docs_seen)
                flats, docs_seen, have = [], 0, 0
        if flats:
            yield report(flats, docs_seen)

    def report(flats, docs_seen):
        grams, times = np.unique(np.concatenate(flats), return_counts=True)
        often = times >= max(8, COMMON_SHARE * docs_seen)
        k = int(often.sum())
        none = pa.nulls(k, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(grams[often].view(np.int64)),
                                           pa.array(times[often].astype(np.int64)), none, none], names)

    names = ["doc_id", "n_shingles", "class", "gram", "times", *_KEYS]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_row_keys(docs)).mapInArrow(
        scan, ", ".join(f"{c} long" for c in names))


def _bits(total: int) -> tuple[int, int]:
    """Bits of the fragment number and of an n-gram's id (its highest bits)."""
    fragment = max(4, int(max(0, total // FRAGMENT_GRAMS)).bit_length())
    return fragment, min(56, 48 + fragment)


def _dealt(docs: DataFrame, n: int, common: np.ndarray, bits: tuple[int, int]) -> DataFrame:
    """Blocks (part, classes, sizes, counts, ids): the n-grams of a batch's classes in one fragment. Part -1: common ones."""
    fragment, wide = bits

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, size, flat in _gathered(batches, n):
            owner = np.repeat(np.arange(len(name)), size)
            if len(common):
                place = np.minimum(np.searchsorted(common, flat), len(common) - 1)
                often = common[place] == flat
            else:
                often = np.zeros(len(flat), bool)
            out = [[], [], [], [], []]

            def add(part, own, ids, out=out, name=name, size=size):
                at = A.segments(own)
                out[0].append(part)
                out[1].append(name[own[at]].tobytes())
                out[2].append(size[own[at]].astype("<u4").tobytes())
                out[3].append(np.diff(np.append(at, len(own))).astype("<u4").tobytes())
                out[4].append(np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                              if part >= 0 else ids.tobytes())

            ids = flat >> _U(64 - wide)
            if often.any():
                add(-1, owner[often], ids[often])
            ids, own = ids[~often], owner[~often]
            part = (ids >> _U(wide - fragment)).astype(np.uint32)
            order = np.argsort(part, kind="stable")
            ids, own, part = (ids & _U((1 << (wide - fragment)) - 1))[order], own[order], part[order]
            at = A.segments(part)
            for i, j in zip(at.tolist(), [*at[1:].tolist(), len(part)], strict=True) if len(part) else ():
                add(int(part[i]), own[i:j], ids[i:j])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]],
                                             ["part", "classes", "sizes", "counts", "ids"])

    return docs.select("text").mapInArrow(scan, "part int, classes binary, sizes binary, counts binary, ids binary")


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])


def _shared(name: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries whose id two classes have or more, and a rank of how many (0 to 126, by quarter doublings)."""
    order = np.argsort(ids, kind="stable")
    name, ids = name[order], ids[order]
    at = A.segments(ids)
    if not len(at):
        return order, ids
    length = np.diff(np.append(at, len(ids)))
    several = np.minimum.reduceat(name, at) != np.maximum.reduceat(name, at)
    rank = np.minimum((np.log2(length) * 4).astype(np.int64), _COMMON_RANK - 1)
    keep = np.repeat(several, length)
    return order[keep], np.repeat(rank, length)[keep]


#: Packed lists of many classes: per class its name, the size of its set, how many of its n-grams follow, and those.
_PACKED = "to int, salt int, classes binary, sizes binary, counts binary, keys binary"


def _packed(to: np.ndarray, name: np.ndarray, size: np.ndarray, keys: np.ndarray, salt: int = 0) -> pa.Table:
    """Entries (class, size of its set, key), each distinct one once, in one row per target."""
    order = np.lexsort((keys, name, to))
    to, name, size, keys = to[order], name[order], size[order], keys[order]
    fresh = np.ones(len(to), bool)
    fresh[1:] = (to[1:] != to[:-1]) | (name[1:] != name[:-1]) | (keys[1:] != keys[:-1])
    to, name, size, keys = to[fresh], name[fresh], size[fresh], keys[fresh]
    rows: list[tuple] = []
    for i, j in A.runs(to):
        at = A.segments(name[i:j])
        counts = np.diff(np.append(at, j - i)).astype("<u4")
        rows.append((int(to[i]), salt, name[i:j][at].tobytes(), size[i:j][at].astype("<u4").tobytes(), counts.tobytes(),
                     keys[i:j].tobytes()))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.table({f.split()[0]: pa.array(c, t) for f, c, t in zip(
        _PACKED.split(", "), columns, [pa.int32(), pa.int32(), *[pa.binary()] * 4], strict=True)})


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (class, size of its set, key) of packed rows."""
    count = _column(table, "counts", "<u4").astype(np.int64)
    return (np.repeat(_column(table, "classes", np.int64), count), np.repeat(_column(table, "sizes", "<u4").astype(np.int64), count),
            _column(table, "keys", np.int64))


def _bucket(name: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of classes that a class lies in."""
    return ((A.mix64(name.view(_U)) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _shared_grams(dealt: DataFrame, bits: tuple[int, int], buckets: int) -> DataFrame:
    """Per bucket of classes and fragment the n-grams that other classes have too, as order keys (rank above id)."""
    fragment, wide = bits

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        many = _column(table, "counts", "<u4").astype(np.int64)
        name = np.repeat(_column(table, "classes", np.int64), many)
        size = np.repeat(_column(table, "sizes", "<u4").astype(np.int64), many)
        if part < 0:
            keys = _column(table, "ids", np.int64) | (_COMMON_RANK << 56)
        else:
            ids = np.zeros((len(name), 8), np.uint8)
            ids[:, :6] = _column(table, "ids", np.uint8).reshape(-1, 6)
            ids = ids.view(np.int64).reshape(-1)
            own, rank = _shared(name, ids)
            name, size, keys = name[own], size[own], ids[own] | (part << (wide - fragment)) | (rank << 56)
        return _packed(_bucket(name, buckets), name, size, keys)

    # common n-grams lie in one class list each; salted so that they are no single group
    salt = F.when(F.col("part") < 0, F.pmod(F.xxhash64("classes"), F.lit(64))).otherwise(0)
    return dealt.withColumn("salt", salt).groupBy("part", "salt").applyInArrow(count, _PACKED)


def _alive(name: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Mask of the entries of classes whose shared n-grams reach the least possible overlap; all entries of a class are there."""
    _, place, shared = np.unique(name, return_inverse=True, return_counts=True)
    return shared[place] * 100 >= size * percent


def _open_grams(packed: DataFrame, bits: tuple[int, int], percent: int) -> DataFrame:
    """From rows per bucket of classes to rows per fragment: the n-grams of the classes that are left."""
    fragment, wide = bits

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        name, size, keys = _unpacked(table)
        own = _alive(name, size, percent)
        name, size, keys = name[own], size[own], keys[own]
        part = np.where(keys >> 56 == _COMMON_RANK, -1, (keys & ((1 << wide) - 1)) >> (wide - fragment))
        return _packed(part, name, size, keys, key[0].as_py() % 64)

    return packed.groupBy("to").applyInArrow(gather, _PACKED)


def _recount(packed: DataFrame, buckets: int) -> DataFrame:
    """The n-grams still shared among the classes that are left, with new ranks, per bucket again."""

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        name, size, keys = _unpacked(table)
        if key[0].as_py() >= 0:
            ids = keys & ((1 << 56) - 1)
            own, rank = _shared(name, ids)
            name, size, keys = name[own], size[own], ids[own] | (rank << 56)
        return _packed(_bucket(name, buckets), name, size, keys)

    salt = F.when(F.col("to") < 0, F.col("salt")).otherwise(0)
    return packed.withColumn("salt", salt).groupBy("to", "salt").applyInArrow(count, _PACKED)


def _lists(packed: DataFrame, bits: tuple[int, int], percent: int) -> DataFrame:
    """Rows (class, n, v, grams): for each class that is left its shared n-grams in order, in VERIFY_PARTS parts by fragment."""
    fragment, wide = bits

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        name, size, keys = _unpacked(table)
        own = _alive(name, size, percent)
        name, size, keys = name[own], size[own], keys[own]
        part = np.where(keys >> 56 == _COMMON_RANK, -1, (keys & ((1 << wide) - 1)) >> (wide - fragment)) % VERIFY_PARTS
        order = np.lexsort((keys, part, name))
        name, size, keys, part = name[order], size[order], keys[order], part[order]
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(keys)).astype(np.int32)), pa.array(keys))
        return pa.table({"class": pa.array(name[at]), "n": pa.array(size[at]), "v": pa.array(part[at].astype(np.int32)), "grams": lists})

    return packed.groupBy("to").applyInArrow(gather, "class long, n long, v int, grams array<long>")


def _linked(pairs: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold, by partial overlaps summed per pair."""
    one = parts.select(F.col("class").alias("a"), "v", F.col("grams").alias("ga"))
    two = parts.select(F.col("class").alias("b"), "v", F.col("grams").alias("gb"))
    partial = pairs.select("a", "b").join(two, "b").join(one, ["a", "v"]).select(
        "a", "b", F.size(F.array_intersect("ga", "gb")).alias("common"))
    summed = partial.groupBy("a", "b").agg(F.sum("common").alias("common"))
    na, nb = (sizes.select(F.col("class").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    return summed.join(na, "a").join(nb, "b").where(
        F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _sketches(whole: DataFrame) -> DataFrame:
    """Per class its size, its n-grams that no other class has (own), and the parity of the others in 1024 bits.

    The parities of two sets differ in at most as many bits as the sets differ in n-grams.
    """

    def parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("grams")
            size = np.diff(grams.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            bits = np.bincount(row * 1024 + (grams.flatten().to_numpy() & 1023), minlength=1024 * len(size)) & 1
            words = np.packbits(bits.astype(np.uint8)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, 16, dtype=np.int32)), pa.array(words))
            n = batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(n), pa.array(n - size), lists],
                                             ["class", "n", "own", "sketch"])

    return whole.select("class", "n", "grams").mapInArrow(parity, "class long, n long, own long, sketch array<long>")


def _near(percent: int) -> str:
    """Whether sizes and sketches allow the similarity: the least possible difference against the greatest allowed."""
    apart = " + ".join(f"bit_count(sketch_a[{i}] ^ sketch_b[{i}])" for i in range(16))
    return (f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) AND "
            f"(100 + {percent}) * (own_a + own_b + {apart}) <= (100 - {percent}) * (n_a + n_b)")


def _hub_pairs(rows: DataFrame, sketches: DataFrame, percent: int, round_no: int) -> DataFrame:
    """Pairs (a < b) of each list's hub with the classes of other components in the list.

    The first round takes the least class, so that lists of one group share their hub; later ones take one at random.
    """
    order = F.lit(0) if round_no == 0 else F.xxhash64(F.lit(round_no), "gram", "class")
    hubs = (rows.groupBy("gram").agg(F.min(F.struct(order.alias("o"), "class", "root")).alias("h"))
            .select("gram", F.col("h.class").alias("hub"), F.col("h.root").alias("hub_root")))
    met = rows.join(hubs, "gram").where("root <> hub_root").select(
        F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    one, two = (sketches.select(*[F.col(c).alias(x if c == "class" else f"{c}_{x}") for c in sketches.columns])
                for x in "ab")
    return met.join(one, "a").join(two, "b").where(_near(percent)).select("a", "b")


def _open_postings(postings: DataFrame, root: DataFrame) -> DataFrame:
    """The postings, with components, of lists that hold more than one."""
    rows = postings.join(root.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class"))
    several = rows.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return rows.join(several.select("gram"), "gram", "left_semi")


def _linked_classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, class, key_a, key_b) of all documents, and (node, root) of the classes that links reach."""
    scanned = staged(document_sets(docs, n), "sets")
    members = scanned.where("n_shingles IS NOT NULL").select("doc_id", "n_shingles", "class", *_KEYS)
    n_docs, total = members.agg(F.count(F.lit(1)), F.sum("n_shingles")).first()
    often = (scanned.where("times IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("t"))
             .where(F.col("t") >= max(8.0, COMMON_SHARE * n_docs)).select("gram").collect())
    common = np.sort(np.array([r[0] for r in often], np.int64).view(_U))
    bits = _bits(total or 0)
    sizes = members.where("n_shingles > 0").select("class", F.col("n_shingles").alias("n")).distinct()
    buckets = max(16, -(-(total or 0) // FRAGMENT_GRAMS))
    packed = staged(_shared_grams(_dealt(docs, n, common, bits), bits, buckets), "shared")
    packed = staged(_recount(_open_grams(packed, bits, percent), buckets), "shared-again")
    lists = staged(_lists(packed, bits, percent), "lists")

    parts = lists.select("class", "v", "grams")
    whole = lists.groupBy("class", "n").agg(F.sort_array(F.flatten(F.collect_list("grams"))).alias("grams"))
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    prefix = F.slice("grams", F.lit(1), F.size("grams") - least + 1)
    # a document's unshared n-grams come first in the order; "rest" n-grams follow the one at hand
    postings = staged(whole.select("class", "n", F.size("grams").alias("shared"), F.posexplode(prefix).alias("at", "gram"))
                      .select("class", "n", "gram", (F.col("shared") - F.col("at") - 1).alias("rest")), "postings")
    sketches = staged(_sketches(whole), "sketches")

    links, tried, root, open_rows = None, None, None, postings.withColumn("root", F.col("class"))
    for round_no in range(HUB_ROUNDS):
        pairs = _hub_pairs(open_rows, sketches, percent, round_no)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "hub-pairs")
        found = staged(_linked(pairs, parts, sizes, percent), "hub-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        root = components(links)
        open_rows = staged(_open_postings(postings, root), "open-postings")

    # what the hubs did not settle: pairs in one list that are not in one component yet
    rows = open_rows.join(sketches.select("class", "own", "sketch"), "class")
    a, b = (rows.select("gram", F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in
                                                           ("n", "rest", "root", "own", "sketch")]) for x in "ab")
    enough = f"(100 + {percent}) * (1 + least(rest_a, rest_b)) >= {percent} * (n_a + n_b)"
    more = (a.join(b, "gram").where("a < b AND root_a <> root_b").where(enough).where(_near(percent))
            .select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    more = staged(more, "more-pairs")
    links = links.unionByName(_linked(more, parts, sizes, percent))
    root = components(links)
    return members, root


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents linked by Jaccard similarity >= percent of word n-gram sets.

    ``component_id`` is the least doc_id that links reach. Words and case folding are those of :func:`gram_sets`.
    A document without words (or null) links with nothing and is its own component, as is a null id with null.
    Repeated rows are copies. Other columns are ignored. No rows: no rows.
    N-grams are told apart by 64-bit hashes in a set, and by their 52 or more highest bits between sets.
    """
    members, root = _linked_classes(docs.select("doc_id", "text"), n, percent)
    classes = members.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(root.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "least", F.coalesce("root", "class").alias("root"))
    tops = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(tops, "root").select("class", "component_id")
    own = members.join(named, "class", "left")
    return own.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component (all columns): that of the least id, null ids last, and of rows with one id the
    least by a hash of the row. Of equal rows one stays; columns with maps, which have no hash, are not compared for
    that. Documents without words (null or empty texts) stay. Whole texts count; no rows give no rows; other columns
    may have any names."""
    members, root = _linked_classes(docs, n, percent)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *_KEYS)
    rows = members.where("n_shingles > 0").groupBy("class", "doc_id", *_KEYS).agg(F.count(F.lit(1)).alias("copies"))
    rows = staged(rows, "distinct-rows")
    best = rows.groupBy("class").agg(F.min(order).alias("o"))
    best = (best.join(root.withColumnRenamed("node", "class"), "class", "left")
            .groupBy(F.coalesce("root", "class").alias("root")).agg(F.min("o").alias("o")).select("o.*"))
    stay = staged(best.join(rows.select(*_KEYS, "copies"), [*_KEYS]).select(*_KEYS, "copies"), "stay")
    gone = rows.select(*_KEYS).join(stay, [*_KEYS], "left_anti")
    keyed = docs.select(F.struct("*").alias("row"), *_row_keys(docs)).join(gone, [*_KEYS], "left_anti")
    repeated = stay.where("copies > 1").select(*_KEYS)
    if repeated.isEmpty():
        return keyed.select("row.*")
    once = keyed.join(repeated, [*_KEYS], "left_anti").select("row")
    one = keyed.join(repeated, [*_KEYS], "left_semi").groupBy(*_KEYS).agg(F.first("row").alias("row")).select("row")
    return once.unionByName(one).select("row.*")
