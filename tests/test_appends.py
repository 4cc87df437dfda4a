"""K3/K4/K5: appends under an id leave one copy however often they are tried."""

import os

import pytest

from tokenyard.sinks.runs import append_metrics, register_run, write_run_config
from tokenyard.sources.runs import read_metrics, read_run_config, read_run_index

METRICS = "step long, elapsed_seconds double, tokens_seen long, train_loss double, val_loss double, learning_rate double"


def _rows(spark, steps):
    return spark.createDataFrame([(s, s / 2, s * 10, 1.0, None, 0.1) for s in steps], METRICS)


def test_metrics_once(spark, tmp_out):
    path = f"{tmp_out}/runs/first/metrics.csv"
    append_metrics(_rows(spark, [1, 2]), path)  # without an id: as before
    for _ in range(3):
        append_metrics(_rows(spark, [3, 4]), path, "q-0")
    append_metrics(_rows(spark, [99]), path, "q-0")  # committed: other rows under its id are not taken
    append_metrics(_rows(spark, [5]), path, "q-1")
    assert sorted(r.step for r in read_metrics(spark, path).collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        append_metrics(_rows(spark, [6]), path, "../other")


def test_retry_after_failed_commit(spark, tmp_out):
    """What a failed append left (files but no commit) is replaced by the retry."""
    path = f"{tmp_out}/metrics"
    append_metrics(_rows(spark, [1, 2, 3]), path, "e-7")
    os.remove(f"{path}/append_id=e-7/_SUCCESS")
    append_metrics(_rows(spark, [1, 2, 3]), path, "e-7")
    assert sorted(r.step for r in read_metrics(spark, path).collect()) == [1, 2, 3]


def test_stream_epochs(spark, tmp_out):
    """Epochs of a stream as ids: an epoch that runs again adds nothing."""
    path = f"{tmp_out}/metrics"
    for epoch in (0, 1, 1, 0, 2):
        append_metrics(_rows(spark, [epoch * 10, epoch * 10 + 1]), path, f"stream-{epoch}")
    assert sorted(r.step for r in read_metrics(spark, path, with_run=False).collect()) == [0, 1, 10, 11, 20, 21]


def test_run_name_and_index(spark, tmp_out):
    root = f"{tmp_out}/runs"
    for name in ("a", "b"):
        append_metrics(_rows(spark, [1]).coalesce(1), f"{root}/{name}", "x")
    assert sorted(r.run_name for r in read_metrics(spark, root).collect()) == ["a", "b"]
    config = spark.createDataFrame([("a", "2026-01-01T00:00:00", 300)], "run_name string, started_at string, vocab_size int")
    for _ in range(2):
        write_run_config(config, f"{tmp_out}/configs", "a")
        register_run(config, f"{tmp_out}/index", "config.json", "metrics.csv", "a")
    assert [(r.run_name, r.config.vocab_size) for r in read_run_index(spark, f"{tmp_out}/index").collect()] == [("a", 300)]
    assert [r.vocab_size for r in read_run_config(spark, f"{tmp_out}/configs").collect()] == [300]
