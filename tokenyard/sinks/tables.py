"""Writing intermediate and final tables to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


#: Options for rows of kilobytes to megabytes each (token arrays, chunks and blocks of them). Spark's reader decodes up to 4096 rows of
#: a row group at a time and its writer looks at sizes after 100 rows only, so row groups must be small from the first row.
LARGE_ROWS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": "8"}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  large_rows: bool = False) -> str:
    w = df.write.mode(mode).options(**(LARGE_ROWS if large_rows else {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                large_rows: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing, e.g., Python encoding)
    and lets several later jobs share one computation. ``large_rows``: see ``LARGE_ROWS``.
    """
    path = scratch_path(df.sparkSession, name)
    write_parquet(df.sortWithinPartitions(*sort_by) if sort_by else df, path, partition_by=partition_by,
                  large_rows=large_rows)
    return df.sparkSession.read.parquet(path)
