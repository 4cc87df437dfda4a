"""The training-corpus pipeline: each stage is one operator over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenyard.llm.common import column, staged
from tokenyard.llm.mixing import mix
from tokenyard.llm.ngram_join import one_of_each
from tokenyard.llm.packing import pack_best_fit, token_pieces
from tokenyard.llm.pfp_dedup import without_repeats
from tokenyard.llm.quality import quality_rules
from tokenyard.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the target is fitted on the labels beside the documents.

    Null and empty texts fail the base rules; repeated rows are judged alike; an empty table stays empty. The other
    columns, of any names, go along in a struct.
    """
    rest = F.struct(*[column(c) for c in docs.columns if c != "text"]).alias("document")
    judged = quality_rules(docs.select("doc_id", "text", rest), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where("kept").select(*[(F.col("text") if c == "text" else F.col("document")[c]).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group that the n-gram Jaccard join links (see ``one_of_each`` for nulls,
    repeated rows, empty tables and other columns)."""
    return one_of_each(docs)


def repeated_string_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document of a smaller id has; n_chars follows the text. Rows with a
    null id or text stay as they are, and so do all other columns; no rows give no rows."""
    return without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them (weights 5, 2, 1 over the sources, at most three times). A null source
    is a source, null texts have no words, equal rows are drawn alike; no rows give no rows."""
    given = docs.select("doc_id", "source", "text", F.struct("*").alias("document"))
    return mix(given).select(*[F.col("document")[c].alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all drawn documents, packed into sequences of at most 2048 tokens. Null texts are empty; a
    document drawn twice is packed twice; other columns are left out; no rows give no rows."""
    pieces = token_pieces(docs, tokenizer_path(), with_ids=False)
    return pack_best_fit(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", repeated_string_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Learned scores and the packing have no SQL form; brute-force versions of the stages stand in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
