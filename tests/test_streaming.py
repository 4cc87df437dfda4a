import os

from tokenyard.functions.codec import Tokenizer
from tokenyard.operators.bpe import base_vocab
from tokenyard.operators.counts import pretoken_counts
from tokenyard.operators.encode import encode
from tokenyard.streaming.streams import count_stream, encode_stream, file_stream, metrics_stream


def _write_parts(spark, folder, rows, schema, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).write.mode("append").parquet(folder)


def test_stream_results_equal_batch(spark, tmp_out):
    folder = os.path.join(tmp_out, "docs")
    rows = [(i, f"doc {i} says hello  world\n" * (i % 3 + 1)) for i in range(30)]
    _write_parts(spark, folder, rows, "doc_id long, text string", 3)
    schema = spark.read.parquet(folder).schema
    batch = spark.read.parquet(folder)

    for sp in (None, ["<|endoftext|>"]):
        got = count_stream(spark, file_stream(spark, folder, schema, max_files=1), sp)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pretoken_counts(batch, sp).collect()))

    tok = Tokenizer(dict(enumerate(base_vocab([]))), [])
    got = encode_stream(spark, file_stream(spark, folder, schema, max_files=1), tok)
    want = encode(batch, tok)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted((r.doc_id, tuple(r.ids)) for r in want.collect())


def test_metrics_stream(spark, tmp_out):
    folder = os.path.join(tmp_out, "metrics")
    rows = [("a", s, 5.0 - s / 100, (4.0 - s / 100) if s % 50 == 0 else None) for s in range(10, 210, 10)]
    _write_parts(spark, folder, rows, "run_name string, step long, train_loss double, val_loss double", 2)
    schema = spark.read.parquet(folder).schema
    r = metrics_stream(spark, file_stream(spark, folder, schema, max_files=1)).first()
    assert (r.n_rows, r.last_step) == (20, 200)
    assert abs(r.last_train_loss - 3.0) < 1e-12 and abs(r.best_val_loss - 2.0) < 1e-12


def test_continuous_count_stream_handle(spark, tmp_out):
    from tokenyard.streaming.streams import latest_state

    folder = os.path.join(tmp_out, "docs2")
    _write_parts(spark, folder, [(i, f"w{i % 3} x") for i in range(9)], "doc_id long, text string", 3)
    schema = spark.read.parquet(folder).schema
    q, path = count_stream(spark, file_stream(spark, folder, schema, max_files=1), trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.word: r.freq for r in latest_state(spark, path, ["word"]).collect()}
    assert got == {"w": 9, "0": 3, "1": 3, "2": 3, " x": 9}  # letters and digits are separate pre-tokens
