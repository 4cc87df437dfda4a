"""Column helpers and staging shared by the pipeline operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenyard.session import scratch_path, sql_conf

#: ASCII white space that ends a word: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; null and blank texts have none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, _SPACE_RUN))


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def n_words(text: Column) -> Column:
    """Number of words, without building them."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    spread = F.length(F.regexp_replace(body, r"[^\x20\x09-\x0D]+", "w"))
    gaps = F.length(F.regexp_replace(body, r"[^\x20\x09-\x0D]+", ""))
    return F.when(body == "", 0).otherwise(spread - gaps).cast("long")


def staged(df: DataFrame, name: str, batch_rows: int = 2000) -> DataFrame:
    """Write a frame once to the shared scratch folder and read it back: cuts lineage, survives lost executors.

    The shuffle files behind it go as soon as it is written. Python workers get batches of at
    most ``batch_rows`` rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with sql_conf(spark, **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                            "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_added(row: str, df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """All fields of the struct column ``row`` plus the added columns; an added name replaces an input's."""
    keep = [F.col(row)[f].alias(f) for f in df.schema[row].dataType.names if f not in added]
    return df.select(*keep, *[c.alias(n) for n, c in added.items()])
