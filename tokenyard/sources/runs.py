"""Training-run logs (metrics CSV, run index CSV with a JSON column, run config JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder name of rows appended under an id (``append_id=...``); readers look into all of them.
APPEND = "append_id"

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("tokens_seen", T.LongType()),
        T.StructField("train_loss", T.DoubleType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("learning_rate", T.DoubleType()),
    ]
)

INDEX_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run_name", "started_at", "config_path", "metrics_path", "configuration")]
)

_STR = ("train_data", "val_data", "device", "checkpoint_path", "resume_from", "log_dir", "run_name", "started_at")
_INT = ("vocab_size", "context_length", "d_model", "num_layers", "num_heads", "d_ff", "batch_size", "max_iters",
        "warmup_iters", "val_iters", "log_every", "eval_every", "checkpoint_every")
_DBL = ("rope_theta", "lr", "min_lr", "weight_decay", "eps", "grad_clip")
_BOOL = ("use_bf16", "use_fused_adamw", "compile_model")

CONFIG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in _STR]
    + [T.StructField(n, T.IntegerType()) for n in _INT]
    + [T.StructField(n, T.DoubleType()) for n in _DBL]
    + [T.StructField("betas", T.ArrayType(T.DoubleType()))]
    + [T.StructField(n, T.BooleanType()) for n in _BOOL]
)


def read_metrics(spark: SparkSession, path: str, with_run: bool = True) -> DataFrame:
    """Metrics rows with an explicit schema; empty losses are nulls. ``run_name`` is the
    metrics file's parent folder when ``with_run``."""
    df = spark.read.option("header", True).option("recursiveFileLookup", True).schema(METRICS_SCHEMA).csv(path)
    if with_run:
        file = F.regexp_replace("_metadata.file_path", f"/{APPEND}=[^/]*", "")
        df = df.withColumn("run_name", F.element_at(F.split(file, "/"), -2))
    return df


def read_run_index(spark: SparkSession, path: str) -> DataFrame:
    """Run index rows with the JSON configuration parsed into ``config``."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option(
        "recursiveFileLookup", True).schema(INDEX_SCHEMA).csv(path)
    return df.withColumn("config", F.from_json("configuration", CONFIG_SCHEMA))


def read_run_config(spark: SparkSession, path: str) -> DataFrame:
    """One pretty-printed JSON object per run, with the file it came from."""
    return (
        spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(CONFIG_SCHEMA).json(path)
        .withColumn("config_path", F.col("_metadata.file_path"))
    )


def shape_fields(config: DataFrame) -> DataFrame:
    """The seven model-shape fields of a run configuration."""
    return config.select("run_name", "vocab_size", "context_length", "d_model", "num_layers", "num_heads", "d_ff", "rope_theta")
