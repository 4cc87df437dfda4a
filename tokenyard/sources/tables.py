"""Readers for the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet, so filters and column pruning reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over the cores when the scan yields fewer partitions than the cluster runs.

    A big scan already has many splits and is returned untouched (no shuffle); a small file that is a
    single row group would otherwise run all per-row regex/encode work in one task.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
