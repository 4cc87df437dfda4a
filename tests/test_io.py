import json

from pyspark.sql import functions as F
import os

import pytest

from tokenyard.functions.codec import Tokenizer
from tokenyard.operators.bpe import base_vocab
from tokenyard.sinks.runs import append_metrics, register_run, with_run_fields, write_run_config
from tokenyard.sinks.tokenizer_files import single_file, write_tokenizer
from tokenyard.sinks.tokens import write_tokens
from tokenyard.sources.runs import read_metrics, read_run_config, read_run_index
from tokenyard.sources.text import scan_documents, scan_lines
from tokenyard.sources.tokenizer_files import (
    read_vocab,
    HEX_FORMAT,
    load_tokenizer,
    printable_byte_map,
    read_merges,
    read_printable_merges,
    read_printable_vocab,
)
from tokenyard.sources.tokens import read_token_blocks


def _tok():
    vocab = dict(enumerate(base_vocab(["<|endoftext|>"])))
    merges = [(b"t", b"h"), (b"th", b"e"), (b" ", b"a")]
    for l, r in merges:
        vocab[len(vocab)] = l + r
    return Tokenizer(vocab, merges, ["<|endoftext|>"])


def test_tokenizer_files_round_trip(spark, tmp_out):
    tok = _tok()
    v, m = os.path.join(tmp_out, "vocab.json"), os.path.join(tmp_out, "merges.json")
    assert write_tokenizer(spark, tok, v, m) == tok.vocab_size
    back = load_tokenizer(spark, v, m)
    assert back.vocab == tok.vocab and list(back.merge_rank) == list(tok.merge_rank)
    doc = json.loads(open(single_file(v)).read())
    assert doc["format"] == HEX_FORMAT and doc["vocab"]["256"] == "<|endoftext|>".encode().hex()


def test_legacy_formats(spark, tmp_out):
    v = os.path.join(tmp_out, "legacy_vocab.json")
    with open(v, "w", encoding="utf-8") as f:
        json.dump({"0": "a", "1": "\xe9"}, f)
    m = os.path.join(tmp_out, "legacy_merges.txt")
    with open(m, "w", encoding="utf-8") as f:
        f.write("a b\n\xe9 c\n")
    tok = load_tokenizer(spark, v, m)
    assert tok.vocab == {0: b"a", 1: b"\xe9"}
    assert list(tok.merge_rank) == [(b"a", b"b"), (b"\xe9", b"c")]
    bad = os.path.join(tmp_out, "bad_merges.txt")
    with open(bad, "w", encoding="utf-8") as f:
        f.write("a b c\n")
    with pytest.raises(Exception):
        read_merges(spark, bad).collect()


def test_printable_byte_map_and_files(spark, tmp_out):
    m = printable_byte_map()
    assert len(m) == 256 and sorted(m.values()) == list(range(256))
    inv = {b: c for c, b in m.items()}
    assert inv[ord(" ")] == "Ġ" and inv[ord("A")] == "A"
    v = os.path.join(tmp_out, "gpt2_vocab.json")
    with open(v, "w", encoding="utf-8") as f:
        json.dump({"Ġthe": 5, "A": 1}, f)
    got = {r.token_id: bytes(r.token) for r in read_printable_vocab(spark, v).collect()}
    assert got == {5: b" the", 1: b"A"}
    mm = os.path.join(tmp_out, "gpt2_merges.txt")
    with open(mm, "w", encoding="utf-8") as f:
        f.write("Ġ t\nĠt he\n")
    got = [(bytes(r.left), bytes(r.right)) for r in read_printable_merges(spark, mm).orderBy("rank").collect()]
    assert got == [(b" ", b"t"), (b" t", b"he")]


def test_scan_documents_and_lines(spark, tmp_out):
    p = os.path.join(tmp_out, "corpus.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("one doc\nline two<|endoftext|>second<|endoftext|><|endoftext|>third\n")
    docs = sorted(r.text for r in scan_documents(spark, p, ["<|endoftext|>"]).collect())
    assert docs == sorted(["one doc\nline two", "second", "third\n"])
    lines = sorted(r.text for r in scan_lines(spark, p).collect())
    assert lines[0].endswith("\n") and len(lines) == 2
    q = os.path.join(tmp_out, "open_end.txt")
    with open(q, "w", encoding="utf-8") as f:
        f.write("x\n\ny")
    rows = scan_lines(spark, q).orderBy("file", "line_start").collect()
    assert [r.text for r in rows] == ["x\n", "\n", "y"]
    both = scan_lines(spark, [p, q]).collect()
    assert sorted(r.text for r in both) == sorted([*lines, "x\n", "\n", "y"])


def test_ranks_and_indented_files(spark, tmp_out):
    import json

    legacy, printable, vocab = (os.path.join(tmp_out, n) for n in ("legacy.txt", "printable.txt", "vocab.json"))
    with open(legacy, "w", encoding="latin-1") as f:
        f.write("a b\nab c\nc d\n")
    with open(printable, "w", encoding="utf-8") as f:
        f.write("Ġ t\nĠt h\na b\n")
    assert [r.rank for r in read_merges(spark, legacy).orderBy("left").collect()] == [0, 1, 2]
    assert sorted(r.rank for r in read_printable_merges(spark, printable).collect()) == [0, 1, 2]
    with open(vocab, "w", encoding="utf-8") as f:
        json.dump({"format": HEX_FORMAT, "vocab": {"0": "61", "1": "62"}}, f, indent=2)
    assert sorted((r.token_id, bytes(r.token)) for r in read_vocab(spark, vocab).collect()) == [(0, b"a"), (1, b"b")]
    with open(printable, "w", encoding="utf-8") as f:
        f.write("Ġ t\nonly\n")
    with pytest.raises(Exception, match="exactly two tokens"):
        read_printable_merges(spark, printable).collect()


def test_write_and_read_tokens(spark, tmp_out):
    td = spark.createDataFrame([(0, [1, 2, 3]), (1, []), (2, list(range(10, 30)))], "doc_id long, ids array<int>")
    n = write_tokens(td, os.path.join(tmp_out, "tokens"), block_size=8, halo=4)
    assert n == 23
    blocks = read_token_blocks(spark, os.path.join(tmp_out, "tokens"), first_block=1).orderBy("block_id").collect()
    assert [b.block_id for b in blocks] == [1, 2]
    empty = spark.createDataFrame([(0, [])], "doc_id long, ids array<int>")
    with pytest.raises(ValueError):
        write_tokens(empty, os.path.join(tmp_out, "tokens"), block_size=8, halo=4)
    assert read_token_blocks(spark, os.path.join(tmp_out, "tokens")).count() == 3  # the old dataset is untouched


def test_run_logs_round_trip(spark, tmp_out):
    run_dir = os.path.join(tmp_out, "runs", "myrun")
    cfg = spark.createDataFrame([(512, 0.001, [0.9, 0.999], True)], "d_model int, lr double, betas array<double>, use_bf16 boolean")
    cfg = with_run_fields(cfg, "myrun")
    write_run_config(cfg, os.path.join(run_dir, "config"))
    register_run(cfg, os.path.join(tmp_out, "runs", "index"), "runs/myrun/config", "runs/myrun/metrics")
    rows = spark.createDataFrame(
        [(100, 1.5, 819200, 5.0, None, 1e-3), (200, 3.0, 1638400, 4.0, 3.9, 9e-4)],
        "step long, elapsed_seconds double, tokens_seen long, train_loss double, val_loss double, learning_rate double",
    )
    append_metrics(rows, os.path.join(run_dir, "metrics"))
    m = read_metrics(spark, os.path.join(run_dir, "metrics"), with_run=False).orderBy("step").collect()
    assert [r.val_loss for r in m] == [None, 3.9]
    idx = read_run_index(spark, os.path.join(tmp_out, "runs", "index")).first()
    assert idx.run_name == "myrun" and idx.config.d_model == 512 and list(idx.config.betas) == [0.9, 0.999]
    assert json.loads(idx.configuration) == {k: json.loads(idx.configuration)[k] for k in sorted(json.loads(idx.configuration))}
    conf = read_run_config(spark, os.path.join(run_dir, "config")).first()
    assert conf.run_name == "myrun" and conf.lr == 0.001
    from tokenyard.operators.runs import runs_join

    metrics = read_metrics(spark, os.path.join(run_dir, "metrics"), with_run=False).withColumn("run_name", F.lit("myrun"))
    joined = runs_join(read_run_index(spark, os.path.join(tmp_out, "runs", "index")), metrics,
                       read_run_config(spark, os.path.join(run_dir, "config"))).orderBy("step").collect()
    assert [r.step for r in joined] == [100, 200] and joined[0].d_model == 512 and joined[0].metrics_path.endswith("metrics")


def test_vocab_table_ops(spark):
    from tokenyard.operators.vocab import (
        compare_vocab,
        concat_parts,
        every_n,
        extend_vocab,
        missing_specials,
        parse_stamp,
        rank_pairs,
        run_stamp,
        token_ids,
        words_with_pair,
    )

    vocab = spark.createDataFrame([(0, b"a"), (1, b"b"), (2, b"a")], "token_id int, token binary")
    assert {bytes(r.token): r.token_id for r in token_ids(vocab).collect()} == {b"a": 2, b"b": 1}
    assert [bytes(r.token) for r in missing_specials(vocab, ["b", "<s>"]).collect()] == [b"<s>"]
    ext = extend_vocab(vocab, ["<s>", "<ss>", "a"])
    assert sorted((r.token_id, bytes(r.token)) for r in ext.collect())[-2:] == [(3, b"<ss>"), (4, b"<s>")]
    assert compare_vocab(ext, ext) and not compare_vocab(vocab, ext)
    merges = spark.createDataFrame([(0, "61", "62")], "rank int, left string, right string")
    pairs = spark.createDataFrame([("61", "62"), ("62", "63")], "left string, right string")
    assert sorted((r.left, r.rank) for r in rank_pairs(pairs, merges).collect()) == [("61", 0), ("62", None)]
    words = spark.createDataFrame([("|61||62|", 3), ("|62||61|", 1)], "toks string, freq long")
    assert [r.freq for r in words_with_pair(words, "61", "62").collect()] == [3]
    parts = concat_parts([spark.range(2), spark.range(3)])
    assert parts.filter("part = 1").count() == 3
    assert every_n(spark.range(1, 301).withColumnRenamed("id", "step"), 100).count() == 3
    r = spark.range(1).select(run_stamp(parse_stamp(F.lit("2026-07-05T12:56:59"))).alias("s")).first()
    assert r.s == "20260705-125659"


def test_prepare_flows_end_to_end(spark, tmp_out):
    from brute import encode as brute_encode
    from tokenyard.plans.prepare import encode_dataset, train_tokenizer

    texts = ["the cat sat on the mat\nthe dog\n", "a dog and a cat<|endoftext|>more text here\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v, m = os.path.join(tmp_out, "v"), os.path.join(tmp_out, "m")
    assert train_tokenizer(spark, docs, 256 + 1 + 10, v, m) == 267
    tok = load_tokenizer(spark, v, m, ["<|endoftext|>"])
    count, bits = encode_dataset(docs, tok, os.path.join(tmp_out, "ds"), block_size=16, halo=4)
    want = []
    for t in texts:
        for line in t.splitlines(keepends=True):
            want += brute_encode(line, tok.vocab, list(tok.merge_rank), tok.specials)
    blocks = read_token_blocks(spark, os.path.join(tmp_out, "ds")).orderBy("block_id").collect()
    assert [i for b in blocks for i in b.ids] == want and count == len(want) and bits == 16


def test_scan_documents_two_specials(spark, tmp_out):
    p = os.path.join(tmp_out, "corpus2.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("alpha<|endoftext|>beta<|sep|>gamma<|sep|><|endoftext|>delta")
    docs = sorted(r.text for r in scan_documents(spark, p, ["<|sep|>", "<|endoftext|>"]).collect())
    assert docs == ["alpha", "beta", "delta", "gamma"]
