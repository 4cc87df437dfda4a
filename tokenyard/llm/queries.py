"""Registered queries: each applies one operator to its whole table, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenyard.llm import (
    chat, collocations, ctw, fingerprints, mixing, ngram_join, packing, pfp_dedup, phrase_dedup, quality, resampling, shards, warc,
)
from tokenyard.session import scratch_path

TRAP = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where this machine's public tokenizers lie; ``public_tokenizers`` is asked, nothing is copied."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that imitates the template, expanded and read back from the transcripts (``chat``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    trap = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    return chat.chat_digest(chat.expand_chat(turns))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and the least document that similarity links reach (``ngram_join``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document (``fingerprints``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    return fingerprints.edit_digest(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it, and the shard of each of its draws (``mixing``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    plan, rows = mixing.mix_plan(_table(spark, sf_dir, "documents"))
    return mixing.place(rows, plan).select(
        "doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).alias("taken"), "shards")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token pieces of every document and their places in sequences of at most 2048 tokens (``packing``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return packing.pack_best_fit(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that a smaller document holds (``phrase_dedup``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    cleaned = phrase_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability by the base model and by context-tree weighting (``ctw``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    return ctw.score_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot in a seeded shuffle over eight shards (``shards``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    shuffled = shards.shuffle_records(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return shuffled.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_pfp_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a smaller document holds (``pfp_dedup``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    cleaned = pfp_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return cleaned.select("rest.doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts, score and verdict (``quality``).

    Nulls, ties, repeated rows, long texts and empty tables are the operator's; only the columns it needs are read."""
    judged = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                   _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "score", "kept")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, score and rank in a draw towards ``benchmark`` (see ``resampling.resample``)."""
    drawn = resampling.resample(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                _table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through whole-file archives, their normalised form, and the reader (see ``warc``)."""
    root = scratch_path(spark, "warc")
    warc.write_archives(warc.page_records(_table(spark, sf_dir, "pages")), f"{root}/whole")
    warc.normalise(spark, f"{root}/whole", f"{root}/members")
    read = warc.read_records(spark, f"{root}/members")
    page = [F.regexp_extract(c, "^<urn:x-page:(-?[0-9]+):", 1) for c in ("record_id", "refers_to")]
    return read.select(
        F.nullif(page[0], F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.nullif(page[1], F.lit("")).cast("long").alias("refers_to"), "digest_ok")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of ``documents`` (see ``collocations.collocations``)."""
    return collocations.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_ngram_join, op3_fingerprints, op4_mixing, op5_packing, op6_phrase_dedup, op7_lm_scoring,
    op8_sharding, op9_pfp_dedup, op10_quality_rules, op11_importance_resampling, op12_warc, op13_collocations)}
