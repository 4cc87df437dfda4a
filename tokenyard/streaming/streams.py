"""Structured Streaming forms of encode, word counting and run-metrics tracking.

All three read a file source with an explicit schema and run with ``trigger(availableNow=True)``,
so they process everything present and stop; the same code runs continuously with another trigger.
Sinks write to shared storage (never the driver-memory sink): append files for the stateless encode;
for the aggregates, update mode, each micro-batch appending only the keys it changed, tagged with
its epoch (a table of changes; the current state is the latest row per key, ``latest_state``). A
retried epoch that appends twice writes identical rows, so reading stays exact. Checkpoints live
under the session's checkpoint folder, so a restarted query resumes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import Tokenizer
from ..operators.counts import pretoken_counts
from ..operators.encode import encode
from ..session import scratch_path


def _append_changes(path: str):
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch).cast("long")).write.mode("append").parquet(path)

    return sink


def latest_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state from a table of changes: the row of the latest epoch per key (partial aggregate)."""
    changes = spark.read.parquet(path)
    values = [c for c in changes.columns if c not in keys and c != "_epoch"]
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "_epoch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def _run(query_builder, name: str, spark: SparkSession, trigger: dict | None = None, out: str | None = None,
         checkpoint: str | None = None):
    """Run to completion (``availableNow``) and return the output path, or, with a ``trigger`` such as
    ``{"processingTime": "1 minute"}``, start a continuous query and return ``(query, path)``."""
    out = out or scratch_path(spark, f"{name}-out")
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")
    writer = query_builder(out).option("checkpointLocation", ckpt)
    if trigger is not None:
        return writer.trigger(**trigger).start(), out
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (optionally only names matching ``glob``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def encode_stream(
    spark: SparkSession, source: DataFrame, tok: Tokenizer, keys: Sequence[str] = ("doc_id",), text_col: str = "text",
    trigger: dict | None = None, out: str | None = None, checkpoint: str | None = None,
):
    """Stateless per-row encoding of a stream, appended as Parquet; returns the written table
    (or ``(query, path)`` of a continuous query when a ``trigger`` is given)."""
    encoded = encode(source, tok, text_col=text_col, keys=keys)
    res = _run(lambda p: encoded.writeStream.format("parquet").option("path", p).outputMode("append"),
               "encode-stream", spark, trigger, out, checkpoint)
    return res if trigger is not None else spark.read.parquet(res)


def count_stream(spark: SparkSession, source: DataFrame, specials: Sequence[str] | None = None,
                 text_col: str = "text", trigger: dict | None = None, out: str | None = None,
                 checkpoint: str | None = None):
    """Running pre-token counts (state = distinct words), update mode; returns the current table
    (or ``(query, path)`` of a continuous query when a ``trigger`` is given; read it with
    ``latest_state(spark, path, ["word"])``)."""
    counts = pretoken_counts(source, specials, text_col)
    res = _run(lambda p: counts.writeStream.outputMode("update").foreachBatch(_append_changes(p)),
               "count-stream", spark, trigger, out, checkpoint)
    return res if trigger is not None else latest_state(spark, res, ["word"])


def metrics_stream(spark: SparkSession, source: DataFrame, run_col: str = "run_name", trigger: dict | None = None,
                   out: str | None = None, checkpoint: str | None = None):
    """Latest and best values per run over a growing metrics log (update mode)."""
    agg = source.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("step").alias("last_step"),
        F.max_by("train_loss", "step").alias("last_train_loss"),
        F.min("val_loss").alias("best_val_loss"),
    )
    res = _run(lambda p: agg.writeStream.outputMode("update").foreachBatch(_append_changes(p)),
               "metrics-stream", spark, trigger, out, checkpoint)
    return res if trigger is not None else latest_state(spark, res, [run_col])
