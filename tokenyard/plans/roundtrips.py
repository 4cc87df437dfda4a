"""Registered queries through sinks and sources: write what Spark derives from the tables, read it back; their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.vecmath import lr_schedule
from ..operators import bpe, encode, runs, vocab
from ..session import scratch_path
from ..sinks.npy import blocks_from_npy, write_npy
from ..sinks.runs import append_metrics, register_run, write_run_config
from ..sinks.tokenizer_files import write_tokenizer
from ..sinks.tokens import write_tokens
from ..sources.runs import read_metrics, read_run_config, read_run_index, shape_fields
from ..sources.text import scan_documents, scan_lines
from ..sources.tokenizer_files import printable_byte_map, read_merges, read_printable_merges, read_printable_vocab, read_vocab
from ..sources.tables import table
from ..sources.tokens import read_token_blocks
from . import params as P
from . import queries as Q
from .oracle import METRICS, STREAM, learn, queries_sql
from .prepare import encode_files, id_bits

SECOND_SPECIAL = "<|pad|>"


def _shown(df):
    return df.select("token_id", F.upper(F.hex("token")).alias("token"))


def tokenizer_roundtrip(spark, sf_dir):
    """K1 then S4: the vocabulary as read back from the exchange files."""
    base = scratch_path(spark, "tokenizer")
    write_tokenizer(spark, Q.corpus_tokenizer(spark, sf_dir), f"{base}/vocab", f"{base}/merges")
    return _shown(read_vocab(spark, f"{base}/vocab"))


def merges_ranked(spark, sf_dir):
    """Merges read back, each pair with the rank that the table gives it."""
    base = scratch_path(spark, "tokenizer")
    write_tokenizer(spark, Q.corpus_tokenizer(spark, sf_dir), f"{base}/vocab", f"{base}/merges")
    merges = vocab.merges_by_rank(read_merges(spark, f"{base}/merges"))
    return vocab.rank_pairs(merges.select("left", "right"), merges).select(
        "rank", F.upper(F.hex("left")).alias("left"), F.upper(F.hex("right")).alias("right"))


def printable_roundtrip(spark, sf_dir):
    """The vocabulary through a printable file."""
    shown = {b: c for c, b in printable_byte_map().items()}
    tok = Q.corpus_tokenizer(spark, sf_dir)
    text = json.dumps({"".join(shown[b] for b in token): i for i, token in tok.vocab.items()}, ensure_ascii=False, indent=1)
    path = scratch_path(spark, "printable")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return _shown(read_printable_vocab(spark, path))


def vocab_extended(spark, sf_dir):
    """A missing special goes behind the vocabulary, one that is there stays."""
    frame = encode.vocab_frame(spark, Q.corpus_tokenizer(spark, sf_dir))
    return _shown(vocab.extend_vocab(frame, [P.SPECIAL, SECOND_SPECIAL]))


def bpe_merges_incremental(spark, sf_dir):
    """A4 by the learner that tables too large for recounting take; few candidates, so that it folds its index too."""
    model = bpe.train_bpe(Q.documents(spark, sf_dir, "text"), 256 + 1 + P.CORPUS_MERGES, [P.SPECIAL],
                          candidates=3, checkpoint_every=2, incremental=True)
    return spark.createDataFrame([(r, a.hex().upper(), b.hex().upper()) for r, (a, b) in enumerate(model.merges)],
                                 "rank int, left string, right string")


def lines_scanned(spark, sf_dir):
    """S2 over the documents written as text files."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return scan_lines(spark, path).groupBy(F.col("text").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def documents_scanned(spark, sf_dir):
    """S1 over files in which the special token ends each document."""
    path = scratch_path(spark, "corpus")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", P.SPECIAL).text(path)
    return scan_documents(spark, path, [P.SPECIAL]).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def specials_scanned(spark, sf_dir):
    """S1 and P2 over files with two specials, of which one is the other twice: between sentences, and after documents."""
    path = scratch_path(spark, "corpus")
    text = F.replace("text", F.lit(". "), F.lit(P.SPECIAL * 2)).alias("text")
    table(spark, sf_dir, "documents").select(text).write.option("lineSep", P.SPECIAL).text(path)
    pieces = scan_documents(spark, path, [P.SPECIAL, P.SPECIAL * 2])
    return pieces.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def token_dataset_roundtrip(spark, sf_dir):
    """K2 then S6: blocks of the token dataset."""
    path = scratch_path(spark, "dataset")
    write_tokens(Q.encoded_lines(spark, sf_dir), path, P.BLOCK_SIZE, P.HALO)
    return _block_sums(read_token_blocks(spark, path))


def _block_sums(blocks):
    return blocks.select("block_id", "start", F.size("ids").cast("long").alias("n"),
                         F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


def token_dataset_from_files(spark, sf_dir):
    """S2, F8, W2, K2, then S6: the documents as text files in their order, encoded into blocks."""
    texts, path = scratch_path(spark, "texts"), scratch_path(spark, "dataset")
    docs = table(spark, sf_dir, "documents")
    docs.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").select("text").write.text(texts)
    encode_files(spark, texts, Q.corpus_tokenizer(spark, sf_dir), path, P.BLOCK_SIZE, P.HALO)
    return _block_sums(read_token_blocks(spark, path))


def npy_roundtrip(spark, sf_dir):
    """K2 and S6 in the array format, P5: blocks as files of the narrowest ids, read back into blocks."""
    npy, path = scratch_path(spark, "npy"), scratch_path(spark, "dataset")
    write_npy(Q._blocks(spark, sf_dir)[0], npy, id_bits(Q.corpus_tokenizer(spark, sf_dir).vocab_size), file_blocks=4)
    blocks_from_npy(spark, npy, path, P.BLOCK_SIZE, P.HALO)
    return _block_sums(read_token_blocks(spark, path))


def _with_special(spark, sf_dir):
    return Q.documents(spark, sf_dir).select("doc_id", F.replace("text", F.lit("\n"), F.lit(P.SPECIAL)).alias("text"))


def special_token_counts(spark, sf_dir):
    """F7 and P4 on texts that hold the special token: how often its id comes out."""
    tok = Q.corpus_tokenizer(spark, sf_dir)
    special = tok.special_ids()[P.SPECIAL]
    ids = encode.encode(_with_special(spark, sf_dir), tok)
    return ids.select("doc_id", F.size(F.filter("ids", lambda i: i == special)).cast("long").alias("n_special"))


def special_roundtrip(spark, sf_dir):
    """F7 then F9 on texts that hold the special token."""
    tok = Q.corpus_tokenizer(spark, sf_dir)
    return encode.decode(encode.encode(_with_special(spark, sf_dir), tok), tok).select("doc_id", "text")


def run_log_roundtrip(spark, sf_dir):
    """K3 then S7: metrics rows with their learning rates through CSV files, appended under ids, one of them twice."""
    path = scratch_path(spark, "metrics")
    rows = Q.metrics_from_events(spark, sf_dir).withColumn(
        "learning_rate", lr_schedule(F.col("step"), P.LR_MAX, P.LR_MIN, P.WARMUP, P.CYCLE))
    for half in (0, 1, 0):
        append_metrics(rows.where(F.col("step") % 2 == half), path, append_id=f"half-{half}")
    return read_metrics(spark, path, with_run=False).select(
        "step", F.round("elapsed_seconds", 6).alias("elapsed_seconds"), "tokens_seen",
        F.round("train_loss", 6).alias("train_loss"), F.round("val_loss", 6).alias("val_loss"),
        F.round("learning_rate", 12).alias("learning_rate"))


def run_config_roundtrip(spark, sf_dir):
    """K5 then S9: the configuration of every registered run as JSON, with its rates and switches."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == P.REGISTER_EVENT)
    config = ev.groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("max_iters"), F.min("event_id").alias("first")).select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"), "max_iters", F.lit(P.BATCH_SIZE).alias("batch_size"),
        (F.col("first") / 1000).alias("lr"), (F.col("first") % 2 == 0).alias("use_bf16"),
        F.array(F.lit(0.9), F.lit(0.95)).alias("betas"))
    path = scratch_path(spark, "configs")
    write_run_config(config, path)
    return read_run_config(spark, path).select("run_name", "max_iters", "batch_size", F.round("lr", 6).alias("lr"), "use_bf16",
                                               F.round(F.element_at("betas", 2), 6).alias("beta2"))


def printable_merges(spark, sf_dir):
    """The merges through a printable file."""
    shown = {b: c for c, b in printable_byte_map().items()}
    tok = Q.corpus_tokenizer(spark, sf_dir)
    lines = [" ".join("".join(shown[b] for b in side) for side in pair) for pair in tok.merge_rank]
    path = scratch_path(spark, "printable")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return read_printable_merges(spark, path).select(
        "rank", F.upper(F.hex("left")).alias("left"), F.upper(F.hex("right")).alias("right"))


def vocab_compared(spark, sf_dir):
    """The learned vocabulary against the one in printable files, and against an extended one."""
    frame = encode.vocab_frame(spark, Q.corpus_tokenizer(spark, sf_dir))
    shown = printable_roundtrip(spark, sf_dir).select("token_id", F.unhex("token").alias("token"))
    others = {"printable": shown, "extended": vocab.extend_vocab(frame, [SECOND_SPECIAL])}
    return spark.createDataFrame([(k, other.count(), vocab.compare_vocab(frame, other)) for k, other in others.items()],
                                 "name string, n long, same boolean")


def run_index_roundtrip(spark, sf_dir):
    """K4, F16, F17, then S8 and P8: runs registered with their configuration, its shape read back."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == P.REGISTER_EVENT)
    config = ev.groupBy("user_id").agg(F.min("event_id").alias("first"), F.min("ts").alias("at")).select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss").alias("started_at"),
        F.col("first").cast("int").alias("vocab_size"), F.lit(P.CONTEXT).alias("context_length"))
    path = scratch_path(spark, "index")
    register_run(config, path, "config.json", "metrics.csv")
    index = read_run_index(spark, path)
    return shape_fields(index.select("config.*")).join(index.select("run_name", "started_at"), "run_name").select(
        "run_name", "vocab_size", "context_length", vocab.run_stamp(vocab.parse_stamp(F.col("started_at"))).alias("stamp"))


def lr_audit(spark, sf_dir):
    """Of every fifth logged row, whether its rate is the schedule's (odd rows carry a wrong one)."""
    right = lr_schedule(F.col("step") - 1, P.LR_MAX, P.LR_MIN, P.WARMUP, P.CYCLE)
    rows = Q.metrics_from_events(spark, sf_dir).where("step > 1").withColumn(
        "learning_rate", right * F.when(F.col("step") % 2 == 0, 1.0).otherwise(1.01))
    checked = runs.audit_learning_rate(vocab.every_n(rows, 5), P.LR_MAX, P.LR_MIN, P.WARMUP, P.CYCLE)
    return checked.select("step", "lr_ok")


def run_throughput(spark, sf_dir):
    """Tokens per second of each run net of what was logged before it resumed."""
    return runs.net_throughput(Q.metrics_from_events(spark, sf_dir)).select(
        "run_name", F.round("net_tokens_per_sec", 3).alias("net_tokens_per_sec"))


ROUNDTRIPS = {f.__name__: f for f in (
    tokenizer_roundtrip, merges_ranked, printable_roundtrip, vocab_extended, bpe_merges_incremental, lines_scanned,
    documents_scanned, specials_scanned, token_dataset_roundtrip, token_dataset_from_files, npy_roundtrip,
    special_token_counts, special_roundtrip, run_log_roundtrip, run_config_roundtrip, printable_merges, vocab_compared,
    run_index_roundtrip, lr_audit, run_throughput)}


def roundtrips_sql() -> dict[str, str]:
    n = P.CORPUS_MERGES
    vocabulary = f"WITH {learn(n)} SELECT token_id, hx AS token FROM vocab"
    merges = f'WITH {learn(n)} SELECT CAST(rank AS INTEGER) AS rank, "left", "right" FROM merges'
    special = SECOND_SPECIAL.encode().hex().upper()
    blocks = f"""WITH {STREAM}
SELECT pos // {P.BLOCK_SIZE} AS block_id, min(pos) AS start, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum
FROM stream GROUP BY 1"""
    with_special = f"replace(text, chr(10), '{P.SPECIAL}')"
    return {
        "tokenizer_roundtrip": vocabulary, "printable_roundtrip": vocabulary,
        "merges_ranked": merges, "bpe_merges_incremental": merges, "printable_merges": merges,
        "vocab_compared": f"""WITH {learn(n)} SELECT 'printable' AS name, count(*) AS n, true AS same FROM vocab
UNION ALL SELECT 'extended', count(*) + 1, false FROM vocab""",
        "run_config_roundtrip": f"""SELECT 'run_' || user_id::VARCHAR AS run_name, count(*)::INTEGER AS max_iters, {P.BATCH_SIZE} AS batch_size,
  round(min(event_id) / 1000, 6) AS lr, min(event_id) % 2 = 0 AS use_bf16, 0.95::DOUBLE AS beta2
FROM events WHERE event_type = '{P.REGISTER_EVENT}' GROUP BY user_id""",
        "vocab_extended": f"""WITH {learn(n)} SELECT token_id, hx AS token FROM vocab
UNION ALL SELECT CAST(count(*) AS INTEGER), '{special}' FROM vocab""",
        "lines_scanned": """SELECT line || chr(10) AS line, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
        "documents_scanned": "SELECT text, count(*) AS n FROM documents WHERE text <> '' GROUP BY text",
        "specials_scanned": """SELECT text, count(*) AS n FROM (
  SELECT unnest(string_split(text, '. ')) AS text FROM documents) WHERE text <> '' GROUP BY text""",
        "token_dataset_roundtrip": blocks, "npy_roundtrip": blocks,
        "token_dataset_from_files": f"""WITH {STREAM.replace("CASE WHEN li < nl THEN piece || chr(10) ELSE piece END", "piece || chr(10)")}
SELECT pos // {P.BLOCK_SIZE} AS block_id, min(pos) AS start, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum
FROM stream GROUP BY 1""",
        "special_token_counts": "SELECT doc_id, length(text) - length(replace(text, chr(10), '')) AS n_special FROM documents",
        "special_roundtrip": f"SELECT doc_id, {with_special} AS text FROM documents",
        "run_log_roundtrip": f"""WITH {METRICS}, rates AS ({queries_sql()["lr_schedule"]})
SELECT step, round(elapsed_seconds, 6) AS elapsed_seconds, tokens_seen, round(train_loss, 6) AS train_loss,
       round(val_loss, 6) AS val_loss, learning_rate FROM metrics JOIN rates USING (step)""",
        "run_index_roundtrip": f"""SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name,
       CAST(min(event_id) AS INTEGER) AS vocab_size, {P.CONTEXT} AS context_length,
       strftime(min(ts), '%Y%m%d-%H%M%S') AS stamp
FROM events WHERE event_type = '{P.REGISTER_EVENT}' GROUP BY user_id""",
        "lr_audit": "SELECT event_id AS step, event_id % 2 = 0 AS lr_ok FROM events WHERE event_id > 1 AND event_id % 5 = 0",
        "run_throughput": f"""WITH {METRICS}
SELECT run_name, round(CASE WHEN max(elapsed_seconds) > min(elapsed_seconds) THEN
       (max(tokens_seen) - min(tokens_seen)) / (max(elapsed_seconds) - min(elapsed_seconds)) END, 3) AS net_tokens_per_sec
FROM metrics GROUP BY run_name""",
    }
