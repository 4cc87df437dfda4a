"""Corpus files as DataFrames.

Spark's text source already splits files into byte ranges aligned to the record separator (S3), so
the reference's hand-made range planning is the built-in scan; partition size follows
``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import placed_lines, scan_pieces


def scan_documents(spark: SparkSession, path: str, specials: Sequence[str]) -> DataFrame:
    """``(text, file, start)``: the pieces of a corpus between special tokens, in the order ``(file, start)``;
    specials and empty pieces dropped, long stretches without specials cut at line ends (``scan.py``). Without
    specials the pieces are lines."""
    if not specials:
        return scan_lines(spark, path).select("text", "file", F.col("line_start").alias("start"))
    return scan_pieces(spark, path, specials)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line with its newline kept (``text``), with the sort key ``(file, line_start)`` of file order.

    ``line_start`` is the line's byte offset and ``split`` that of the split it was read in; rows come in order within
    a split. A last line without a newline stays without. Files must not be compressed.
    """
    return placed_lines(spark, path)
