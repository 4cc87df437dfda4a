"""Mixing, packing and sharding."""

import collections
import re
import zlib

import numpy as np
import pytest
from llm_texts import make_docs, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tokenyard.llm import mixing, packing, shards

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [5, 2, 1], 3) == [18.75, 7.5, 3.75]
    assert mixing.water_fill([1, 100, 100], [5, 2, 1], 3) == [3.0, 132.0, 66.0]
    assert mixing.water_fill([0, 0], [1, 1], 3) == [0.0, 0.0] and mixing.water_fill([], [], 3) == []
    got = mixing.water_fill([3, 5, 1000, 2], [5, 2, 1, 5], 3)
    assert sum(got) == pytest.approx(1010) and all(t <= 3 * s for t, s in zip(got, [3, 5, 1000, 2]))


def test_split_quotas_are_exact():
    quotas = np.array([1000, 0, 37, 5, 400])
    got = mixing.split_quotas(quotas, 7, 3)
    assert (got.sum(axis=0) == quotas).all() and (got >= 0).all()
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 7
    assert (got == mixing.split_quotas(quotas, 7, 3)).all()


def mixed_rows():
    rows = [(i, prose(i, 5 + i * 7 % 90)) for i in range(400)] + [(1000 + i, prose(i, 3)) for i in range(3)]
    return rows + [(None, None), (2000, ""), (2001, None), (2002, prose(9, 40)), (2002, prose(9, 40))]


@pytest.mark.parametrize("block_words", [64, 4096])
def test_mix(make_docs, block_words):
    docs = make_docs(mixed_rows()).withColumn("source", F.when(F.col("doc_id") >= 1000, "tiny").otherwise(F.col("source")))
    docs = docs.withColumn("copies", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("at", F.lit(2))
    size = collections.Counter()
    for r in docs.collect():
        size[r.source] += n_words(r.text)
    out = mixing.mix(docs, block_words=block_words).collect()
    again = mixing.mix(docs.repartition(5), block_words=block_words).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.water_fill([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 3)))
    taken = collections.Counter()
    for r in out:
        taken[r.source] += n_words(r.text)
    for s in order:
        assert taken[s] <= target[s] + 90 and taken[s] >= target[s] - 90, (s, taken[s], target[s])
    assert max(collections.Counter((r.doc_id, r.mix_copy) for r in out).values()) <= 2  # 2002 stands twice
    assert {r.mix_copy for r in out} <= {0, 1, 2} and {r.mix_shard for r in out} <= set(range(8))
    assert set(docs.columns) <= set(out[0].asDict())


def test_shards_follow_the_tree(make_docs, monkeypatch):
    """The draws of a source fill its shards' runs of blocks, as many as the tree gives each; without runs nothing is drawn."""
    docs = make_docs(mixed_rows())
    trees = []
    split = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda *a: trees.append(split(*a)) or trees[-1])
    plan, rows = mixing.mix_plan(docs, block_words=60)
    tree, plans = trees[0], {r.sid: r for r in plan.collect()}
    assert tree.shape[0] == 8 and tree.sum() > 20
    blocks = {}
    for r in mixing.place(rows, plan).collect():
        for copy, shard in enumerate(r.shards):
            at = copy * r.n + ((r.key % r.n) * r.a + r.c) % r.n
            assert r.bounds[shard] <= at < r.bounds[shard + 1]
            blocks.setdefault((r.sid, shard), set()).add(at)
    for sid, p in plans.items():
        assert list(np.diff(p.bounds)) == tree[:, sid].tolist()
        given = sum(len(blocks.get((sid, k), ())) for k in range(8))
        assert given <= tree[:, sid].sum()
    held = sum(len(b) for b in blocks.values())
    assert held > tree.sum() / 2  # other blocks hold no document
    monkeypatch.setattr(mixing, "split_quotas", lambda q, n, seed: np.zeros((n, len(q)), np.int64))
    plan, rows = mixing.mix_plan(docs, block_words=60)
    assert all(not r.shards for r in mixing.place(rows, plan).collect())


def test_mix_keeps_columns_of_like_names(spark, make_docs):
    docs = make_docs(mixed_rows())
    for c in ("mix_ratio", "mix_copy", "mix_shard", "mix_order"):
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id")))
    out = mixing.mix(docs)
    assert "mix_ratio" in out.columns and sorted(out.columns) == sorted(docs.columns)
    rows = corpus_pipeline.mixing_stage(spark, docs, "").collect()
    given = {r.doc_id: r for r in docs.collect()}
    assert rows and all(r == given[r.doc_id] for r in rows if r.doc_id not in (2002, None))


def test_mix_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs([(1, None), (2, "")])).count() == 0


def brute_bins(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if b + s <= capacity]
        if fits:
            bins[bins.index(max(fits))] += s
        else:
            bins.append(s)
    return bins


def test_segment_tree_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = rng.integers(1, 65, int(rng.integers(0, 200)))
        bins, offsets, fills = packing.best_fit_decreasing(sizes, 64)
        assert sorted(fills.tolist()) == sorted(brute_bins(sizes.tolist(), 64))
        for b in range(len(fills)):
            own = sorted((int(o), int(s)) for o, s, k in zip(offsets, sizes, bins) if k == b)
            assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))]


@pytest.mark.parametrize("group", [1 << 17, 40])
def test_packing(make_docs, odd_rows, group):
    from tokenizers import Tokenizer

    rows = odd_rows + [(500 + i, prose(i, 3 + i % 50)) for i in range(150)] + [
        (900, "It's 'll don't CAN'T a.b. x, y; z: <|endoftext|> <|ENDOFTEXT|> É́ ß İ Σς…"), (901, "word." * 300), (902, "Éa. ÿ, éé")]
    docs = make_docs(rows).withColumn("length", F.lit("clash")).withColumn("offset", F.lit(0))
    pieces = packing.token_pieces(docs, TOKENIZER, 256)
    packed = packing.pack_best_fit(pieces, 256, group)
    got = packed.collect()
    tok = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter()
    for d, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 256):
            own = ids[k:k + 256]
            want[d, k // 256, k, len(own), zlib.crc32(own.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 256
    least = len(brute_bins([r.length for r in got], 256))
    assert len(by) <= least + (0 if group > 1000 else 8)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert all(len(whole[s].tokens) == 4 * whole[s].n_tokens == 4 * sum(n for _, n in own) for s, own in by.items())
    assert packing.pack_best_fit(packing.token_pieces(docs.limit(0), TOKENIZER)).count() == 0


def test_external_shuffle(make_docs, odd_rows):
    rows = odd_rows + [(5, "hot id")] * 300 + [(600 + i, prose(i, 20)) for i in range(100)]
    docs = make_docs(rows).withColumn("shard", F.lit("clash"))
    out = shards.shuffle_records(docs, 8, bucket_bytes=4000)
    got = out.collect()
    assert collections.Counter((r.doc_id, r.text, r.lang) for r in got) == collections.Counter((d, t, "en") for d, t in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ids = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None and r.doc_id >= 600]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.4
    assert shards.shuffle_records(docs.limit(0)).count() == 0
    three = shards.shuffle_records(make_docs([(1, "a"), (2, None), (3, "c")]), 8).collect()
    assert sorted(r.slot for r in three) == [0, 0, 0] and len({r.shard for r in three}) == 3


def test_packing_encodes_a_string_once_and_as_the_tokenizer_does(monkeypatch):
    ids_of, whole = packing._Ids(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = ["It's Été, été. ÈÉàß; 42 naïve, a,b x.. , .", "", "long" * 40 + ", " + "Ö" * 70, "tab\there\r\nÁ ­ İ ﬁ ß. ÷ ×,",
             "a <|endoftext|> b", "<|ENDOFTEXT|>, c"]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert ids_of(texts) == want == [ids_of([t])[0] for t in texts]
    encoded = []
    each, words = packing._Ids._each, packing._Ids._words
    monkeypatch.setattr(packing._Ids, "_each", lambda self, s: encoded.extend(s) or each(self, s))
    monkeypatch.setattr(packing._Ids, "_words", lambda self, s: encoded.extend(s) or words(self, s))
    assert ids_of(texts[:1]) == want[:1]
    assert encoded == []  # numbers, contractions and words with marks are remembered too
    assert not any(len(s) > packing._LONGEST for s in ids_of.memory)
