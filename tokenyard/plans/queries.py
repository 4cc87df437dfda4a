"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver tables.

Outputs are shaped for an order-insensitive comparison with the SQL oracles: binary tokens as
upper-case hex, arrays as comma-joined text, doubles rounded to fixed places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import Tokenizer
from ..functions.vecmath import logsumexp, rms_normalize, softmax
from ..operators import bpe, counts, encode, runs, scores, segments, windows
from ..operators.word_index import build_index
from ..sinks.tables import materialize
from ..sources.tables import balanced, table
from . import params as P

_TOKENIZERS: dict[tuple, Tokenizer] = {}


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return balanced(table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "text"))))


def corpus_tokenizer(spark: SparkSession, sf_dir: str) -> Tokenizer:
    """The tokenizer every encoding query uses: learned from `documents` by Spark (memoised)."""
    key = (sf_dir, spark.sparkContext.applicationId, P.CORPUS_MERGES)
    tok = _TOKENIZERS.get(key)
    if tok is None:
        model = bpe.train_bpe(
            documents(spark, sf_dir, "text"), 256 + 1 + P.CORPUS_MERGES, [P.SPECIAL], candidates=P.CANDIDATES
        )
        tok = Tokenizer.from_model(model)
        _TOKENIZERS[key] = tok
    return tok


def _hex(c):
    return F.upper(F.hex(c))


# --- text, counts, learner ---------------------------------------------------------------------

def q_pretoken_counts(spark, sf_dir):
    """A1 over documents as segments of a corpus joined by the default special token."""
    return counts.pretoken_counts(documents(spark, sf_dir, "text"), [P.SPECIAL])


def q_special_segments(spark, sf_dir):
    """P1-P4 on documents whose lines are joined by the special token (blank lines give the double)."""
    docs = documents(spark, sf_dir).select("doc_id", F.replace("text", F.lit("\n"), F.lit(P.SPECIAL)).alias("text"))
    return segments.special_segments(docs, [P.SPECIAL, P.SPECIAL * 2])


def _words(spark, sf_dir):
    return counts.word_tokens(counts.pretoken_counts(documents(spark, sf_dir, "text"), [P.SPECIAL]))


def q_pair_counts(spark, sf_dir):
    return counts.pair_counts(_words(spark, sf_dir))


def q_best_pair(spark, sf_dir):
    return counts.best_pair(counts.pair_counts(_words(spark, sf_dir)))


def q_top_pairs(spark, sf_dir):
    return counts.top_pairs(counts.pair_counts(_words(spark, sf_dir)), P.TOP_K)


def q_words_with_best_pair(spark, sf_dir):
    """The words in which the best pair occurs (the words a merge of it rewrites), by the inverted index."""
    words = materialize(_words(spark, sf_dir).withColumn("word_id", F.monotonically_increasing_id()), "words")
    best = [(r.left, r.right) for r in counts.best_pair(counts.pair_counts(words)).collect()]
    return build_index(words).words_of(best).select("toks", "freq")


def q_bpe_merges_8(spark, sf_dir):
    tok = corpus_tokenizer(spark, sf_dir)
    m = spark.createDataFrame(
        [(r, l.hex().upper(), rr.hex().upper()) for (l, rr), r in tok.merge_rank.items()],
        "rank int, left string, right string",
    )
    return m


def q_bpe_vocab(spark, sf_dir):
    tok = corpus_tokenizer(spark, sf_dir)
    return encode.vocab_frame(spark, tok).select("token_id", _hex("token").alias("token"))


# --- encode / decode ---------------------------------------------------------------------------

def _encoded(spark, sf_dir, per_line=False, cols=("doc_id", "text")):
    tok = corpus_tokenizer(spark, sf_dir)
    keys = [c for c in cols if c != "text"]
    return encode.encode(documents(spark, sf_dir, *cols), tok, keys=keys, per_line=per_line), tok


def q_encode_token_counts(spark, sf_dir):
    td, _ = _encoded(spark, sf_dir)
    return td.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
    )


def q_encode_decode_roundtrip(spark, sf_dir):
    td, tok = _encoded(spark, sf_dir)
    return encode.decode(td, tok).select("doc_id", "text")


def q_decode_join(spark, sf_dir):
    """J2 for every token of the documents, whose bytes are then counted."""
    td, tok = _encoded(spark, sf_dir)
    return encode.count_tokens(td, encode.vocab_frame(spark, tok)).select("token_id", _hex("token").alias("token"), "n")


def q_decode_by_join(spark, sf_dir):
    """F9 by the join that vocabularies too large for an expression take."""
    td, tok = _encoded(spark, sf_dir)
    return encode.decode_by_join(td, tok).select("doc_id", "text")


def q_token_count_by_lang(spark, sf_dir):
    td, _ = _encoded(spark, sf_dir, cols=("doc_id", "lang", "text"))
    return encode.token_counts(td, by=["lang"], rollup=True)


# --- dataset stream, offsets, windows ------------------------------------------------------------

_TABLES: dict[tuple, DataFrame] = {}


def _memo_table(spark, sf_dir, name, build, **write):
    """A derived table written once to the shared checkpoint folder and reused by later queries."""
    key = (sf_dir, spark.sparkContext.applicationId, name)
    df = _TABLES.get(key)
    if df is None:
        df = materialize(build(), name, **write)
        _TABLES[key] = df
    return df


def encoded_lines(spark, sf_dir):
    """The documents encoded line by line."""
    return _encoded(spark, sf_dir, per_line=True)[0]


def _dataset(spark, sf_dir):
    """K2 input: the documents encoded line by line (G13), written once as `token_docs`."""
    return _memo_table(
        spark, sf_dir, "token_docs",
        lambda: _encoded(spark, sf_dir, per_line=True)[0].withColumn("n_tokens", F.size("ids").cast("long")),
        large_rows=True,
    )


def q_global_offsets(spark, sf_dir):
    # n_tokens is stored with the dataset, so the scan does not read the token arrays.
    sized = _dataset(spark, sf_dir).select("doc_id", "n_tokens").filter("n_tokens > 0")
    return windows.global_offsets(sized, "doc_id", "n_tokens")


def _blocks(spark, sf_dir):
    blocks = _memo_table(
        spark, sf_dir, "token_blocks", lambda: windows.token_blocks(_dataset(spark, sf_dir), P.BLOCK_SIZE, P.HALO),
        partition_by=["shard"], sort_by=["block_id"], large_rows=True,
    )
    # The count comes from the narrow n_tokens column of the dataset, not from the token arrays.
    total = _dataset(spark, sf_dir).agg(F.sum("n_tokens").cast("long")).first()[0] or 0
    return blocks, int(total)


def _joined(c):
    return F.array_join(c, ",")


def q_lm_windows_all(spark, sf_dir):
    blocks, total = _blocks(spark, sf_dir)
    w = windows.lm_windows_all(blocks, total, P.WINDOW_LEN, P.WINDOW_STRIDE)
    return w.select("start", _joined("x").alias("x"), _joined("y").alias("y"))


def q_lm_windows_sampled(spark, sf_dir):
    blocks, total = _blocks(spark, sf_dir)
    starts = windows.sample_starts(spark, P.N_SAMPLES, total, P.WINDOW_LEN, P.SAMPLE_SEED)
    w = windows.lm_windows_sampled(blocks, starts, P.N_SAMPLES, P.BLOCK_SIZE, P.WINDOW_LEN)
    return w.select("sample_id", "start", _joined("x").alias("x"), _joined("y").alias("y"))


# --- scores over the embeddings table ----------------------------------------------------------

def _emb(spark, sf_dir, *cols):
    return balanced(table(spark, sf_dir, "embeddings").select(*(cols or ("vec_id", "embedding", "label"))))


def q_softmax(spark, sf_dir):
    e = _emb(spark, sf_dir, "vec_id", "embedding")
    return e.select("vec_id", F.posexplode(softmax(F.col("embedding"))).alias("class_id", "p")).select(
        "vec_id", "class_id", F.round("p", 6).alias("p")
    )


def q_logsumexp(spark, sf_dir):
    e = _emb(spark, sf_dir, "vec_id", "embedding")
    return e.select("vec_id", F.round(logsumexp(F.col("embedding")), 6).alias("lse"))


def q_cross_entropy(spark, sf_dir):
    ce = scores.cross_entropy(_emb(spark, sf_dir), "embedding", "label")
    return ce.select("n", F.round("loss", 6).alias("loss"))


def q_perplexity(spark, sf_dir):
    losses = scores.row_losses(_emb(spark, sf_dir), "embedding", "label").withColumn(
        "batch_id", F.floor(F.col("vec_id") / P.EVAL_BATCH)
    )
    est = scores.estimate_loss(losses, "batch_id")
    return est.select("n_batches", F.round("loss", 6).alias("loss"), F.round("perplexity", 6).alias("perplexity"))


def _kept(spark, sf_dir):
    return _emb(spark, sf_dir, "vec_id", "embedding").select(
        F.col("vec_id").alias("row_id"), scores.nucleus_of(F.col("embedding"), P.TEMPERATURE, P.TOP_P).alias("kept"))


def q_nucleus(spark, sf_dir):
    """W3 and T4 within the rows: no exchange."""
    k = _kept(spark, sf_dir).select("row_id", F.explode("kept").alias("k")).select("row_id", "k.*")
    return k.select("row_id", "class_id", "rank", F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


def q_nucleus_long(spark, sf_dir):
    """W3 over the long form, for vocabularies that do not come as arrays."""
    long_df = scores.long_scores(_emb(spark, sf_dir, "vec_id", "embedding"), "vec_id", "embedding")
    k = scores.nucleus(long_df, P.TEMPERATURE, P.TOP_P)
    return k.select("row_id", "class_id", "rank", F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


def q_weighted_draw(spark, sf_dir):
    """T6 within the rows: no exchange."""
    return _kept(spark, sf_dir).select("row_id", scores.draw_of(F.col("kept"), F.col("row_id"), P.DRAW_SEED).alias("class_id"))


def q_rms_normalize(spark, sf_dir):
    e = _emb(spark, sf_dir, "vec_id", "embedding")
    return e.select("vec_id", F.posexplode(rms_normalize(F.col("embedding"))).alias("dim", "y")).select(
        "vec_id", "dim", F.round("y", 6).alias("y")
    )


def q_linear_project(spark, sf_dir):
    """F14 with W = the per-label mean vectors (nearest-centroid scores), derived by Spark."""
    e = _emb(spark, sf_dir)
    weights = (
        e.select("label", F.posexplode(F.transform("embedding", lambda x: x.cast("double"))).alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg("x").alias("w"))
        .groupBy("label")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "w"))), lambda s: s["w"]).alias("w"))
        .withColumnRenamed("label", "out_id")
    )
    out = scores.linear_project_table(e, weights, "embedding", keys=("vec_id",))
    return out.select("vec_id", "out_id", F.round("score", 6).alias("score"))


def q_embed_lookup(spark, sf_dir):
    td, _ = _encoded(spark, sf_dir, cols=("doc_id", "lang", "text"))
    tc = td.select("lang", F.explode("ids").alias("token_id")).groupBy("lang", "token_id").agg(F.count(F.lit(1)).alias("n"))
    j = scores.embed_lookup(tc, table(spark, sf_dir, "embeddings"))
    long = j.select("lang", "n", F.posexplode(F.transform("vec", lambda x: x.cast("double"))).alias("dim", "x"))
    return long.groupBy("lang", "dim").agg(
        F.round(F.sum(F.col("n") * F.col("x")) / F.sum("n"), 6).alias("value")
    )


# --- training-run metrics (derived from `events`) -----------------------------------------------

def metrics_from_events(spark, sf_dir) -> DataFrame:
    """Run-log rows derived from `events`: one run per user, one logged row per event.

    ``elapsed_seconds`` counts from the first event of the table (a scalar subquery),
    ``tokens_seen = step * batch * context`` (F19), validation losses only on evaluation events.
    """
    ev = table(spark, sf_dir, "events")
    t0 = ev.agg(F.min("ts")).scalar()
    return ev.select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"),
        F.col("event_id").alias("step"),
        (F.timestamp_diff("MICROSECOND", t0, F.col("ts")).cast("double") / F.lit(1e6)).alias("elapsed_seconds"),
        (F.col("event_id") * F.lit(P.BATCH_SIZE * P.CONTEXT)).alias("tokens_seen"),
        F.col("value").alias("train_loss"),
        F.when(F.col("event_type") == P.EVAL_EVENT, F.col("value")).alias("val_loss"),
    )


def q_lr_schedule(spark, sf_dir):
    from ..functions.vecmath import lr_schedule

    ev = table(spark, sf_dir, "events").select("event_id")
    return ev.select(
        F.col("event_id").alias("step"),
        F.round(lr_schedule(F.col("event_id"), P.LR_MAX, P.LR_MIN, P.WARMUP, P.CYCLE), 12).alias("learning_rate"),
    )


def q_run_summary(spark, sf_dir):
    s = runs.run_summary(metrics_from_events(spark, sf_dir))
    r6 = ["final_train_loss", "final_val_loss", "best_val_loss", "elapsed_seconds"]
    return s.select(
        "run_name", "n_rows", "first_step", "last_step",
        *[F.round(c, 6).alias(c) for c in r6],
        F.round("tokens_per_sec", 3).alias("tokens_per_sec"),
    )


def q_long_series(spark, sf_dir):
    ls = runs.long_series(metrics_from_events(spark, sf_dir))
    return ls.select("run_name", "step", F.round("elapsed_seconds", 6).alias("elapsed_seconds"), "series", "loss")


def q_series_minmax(spark, sf_dir):
    return runs.series_extent(runs.long_series(metrics_from_events(spark, sf_dir)))


def q_loss_curve_points(spark, sf_dir):
    """every loss point mapped into the plot box by its run's extents."""
    pts = runs.long_series(metrics_from_events(spark, sf_dir))
    ext = materialize(runs.series_extent(pts), "extents")
    n_runs = ext.count()
    proj = runs.minmax_project(pts, ext, n_runs)
    return proj.select("run_name", "series", "step", F.round("px", 3).alias("px"), F.round("py", 3).alias("py"))


def q_run_progress(spark, sf_dir):
    p = runs.run_progress(metrics_from_events(spark, sf_dir))
    return p.select(
        "run_name", "step", F.round("tokens_per_sec", 3).alias("tokens_per_sec"), F.round("best_val_loss", 6).alias("best_val_loss")
    )


def q_run_rows_with_index(spark, sf_dir):
    """Every logged row with its run's index entry (first registration step; one row per run)."""
    ev = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name")
    index = ev.filter(F.col("event_type") == P.REGISTER_EVENT).groupBy(run).agg(F.min("event_id").alias("registered_step"))
    rows = metrics_from_events(spark, sf_dir).select("run_name", "step")
    j = runs.runs_join(index, rows)
    return j.select("run_name", "step", "registered_step", (F.col("step") >= F.col("registered_step")).alias("after_registration"))


def q_runs_without_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name")
    index = ev.filter(F.col("event_type") == P.REGISTER_EVENT).select(run, "ts")
    logged = ev.filter(F.col("event_type") == P.EVAL_EVENT).select(run, "ts")
    return runs.runs_without_rows(index, logged, registered_col="ts", logged_col="ts")


def q_tokenize_sql(spark, sf_dir):
    """The table function in SQL: tokens and sum of ids per document."""
    from ..functions.sql import register_tokenize_table

    register_tokenize_table(spark, corpus_tokenizer(spark, sf_dir))
    view = f"tokenized_{abs(hash(sf_dir))}"
    documents(spark, sf_dir, "doc_id", "text").createOrReplaceTempView(view)
    return spark.sql(f"""SELECT key AS doc_id, count(*) AS n_tokens, sum(token_id) AS id_sum
FROM tokenize_table(TABLE(SELECT doc_id, text FROM {view})) GROUP BY key""")


QUERIES = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}


# --- streaming forms (E1-E3): same results as the batch queries ---------------------------------

def _stream_of(spark, sf_dir, name, cols):
    from ..streaming.streams import file_stream

    static = table(spark, sf_dir, name).select(*cols)
    if all(f.endswith(f"/{name}.parquet") for f in static.inputFiles()):  # the table is one file among others
        return file_stream(spark, sf_dir, static.schema, glob=f"{name}.parquet").select(*cols)
    return file_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", static.schema, max_files=1000).select(*cols)


def q_stream_pretoken_counts(spark, sf_dir):
    from ..streaming.streams import count_stream

    return count_stream(spark, _stream_of(spark, sf_dir, "documents", ["text"]), [P.SPECIAL])


def q_stream_encode_token_counts(spark, sf_dir):
    from ..streaming.streams import encode_stream

    tok = corpus_tokenizer(spark, sf_dir)
    td = encode_stream(spark, _stream_of(spark, sf_dir, "documents", ["doc_id", "text"]), tok)
    return td.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
    )


def q_stream_run_status(spark, sf_dir):
    from ..streaming.streams import metrics_stream

    ev = _stream_of(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    rows = ev.select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"),
        F.col("event_id").alias("step"),
        F.col("value").alias("train_loss"),
        F.when(F.col("event_type") == P.EVAL_EVENT, F.col("value")).alias("val_loss"),
    )
    return metrics_stream(spark, rows)


QUERIES.update({name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_stream_")})
