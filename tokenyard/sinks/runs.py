"""K3/K4/K5: training-run logs written with Spark (append-only folders of part files)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..sources.runs import APPEND, METRICS_SCHEMA


def append_metrics(rows: DataFrame, path: str, append_id: str | None = None) -> None:
    """K3: append metrics rows (CSV with header, nulls as empty fields); with ``append_id`` once (see ``_append``)."""
    cols = [f.name for f in METRICS_SCHEMA.fields]
    _append(rows.select(*cols).write.option("header", True), path, "csv", append_id)


def _append(writer: DataFrameWriter, path: str, kind: str, append_id: str | None) -> None:
    """Append to a folder; under an id of the caller's (say, query and epoch) exactly once.

    The rows of an id have a folder of their own. An id whose folder was committed is left alone, so a repeated append
    changes nothing; what a failed append has left is overwritten, so a retried one leaves one copy.
    """
    if append_id is None:
        writer.mode("append").format(kind).save(path)
        return
    if not re.fullmatch(r"[A-Za-z0-9._-]+", append_id):
        raise ValueError("an append id has letters, digits, dots, dashes and underscores only")
    own = f"{path.rstrip('/')}/{APPEND}={append_id}"
    spark = writer._spark
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{own}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        writer.mode("overwrite").format(kind).save(own)


def with_run_fields(config: DataFrame, run_name: str | None = None) -> DataFrame:
    """K5 fields: ``run_name`` (given, or the start stamp ``yyyyMMdd-HHmmss``) and ISO ``started_at``."""
    now = F.current_timestamp()
    name = F.lit(run_name) if run_name else F.date_format(now, "yyyyMMdd-HHmmss")
    return config.withColumn("run_name", name).withColumn("started_at", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"))


def write_run_config(config: DataFrame, path: str, append_id: str | None = None) -> None:
    """K5: the configuration as JSON, one object per run in a file of its own; with ``append_id`` once (see ``_append``)."""
    _append(config.write.option("maxRecordsPerFile", 1), path, "json", append_id)


def register_run(config: DataFrame, index_path: str, config_path: str, metrics_path: str, append_id: str | None = None) -> None:
    """K4: append an index row with the configuration as JSON with sorted keys; with ``append_id`` once (see ``_append``)."""
    fields = sorted(config.columns)
    row = config.select(
        "run_name",
        "started_at",
        F.lit(config_path).alias("config_path"),
        F.lit(metrics_path).alias("metrics_path"),
        F.to_json(F.struct(*fields)).alias("configuration"),
    )
    _append(row.write.option("header", True).option("escape", '"'), index_path, "csv", append_id)
