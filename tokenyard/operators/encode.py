"""F7/F8 encode, F9/J2 decode, A6 token counts, P5 id width."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import materialize
from ..functions.codec import Tokenizer, decode_expr, encoder_of_rows, fits_decode_array, joined_text

# Salt buckets of the vocabulary join.
DECODE_SALTS = 32
# Memory of a vocabulary up to which the join broadcasts it, and what a row takes besides its token.
BROADCAST_VOCAB_BYTES, BROADCAST_ROW_BYTES = 8 << 20, 64
# Rows (2 to this power) that look up their distinct ids together.
DECODE_BLOCK_BITS = 6


def encode(
    docs: DataFrame,
    tok: Tokenizer,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    per_line: bool = False,
    ids_col: str = "ids",
) -> DataFrame:
    """F7 (whole text) / F8 (``per_line``): ``(*keys, ids ARRAY<INT>)``. Narrow: no shuffle."""
    rows = docs.select(*keys, F.make_valid_utf8(F.col(text_col)).alias("_text"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"]).add(ids_col, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(encoder_of_rows(docs.sparkSession, tok, "_text", ids_col, per_line), schema)


def decode(token_docs: DataFrame, tok: Tokenizer, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """F9 per row. A small vocabulary is an array in the expression; a larger one is joined (J2) and regrouped.

    """
    if fits_decode_array(tok):
        return token_docs.withColumn(out_col, decode_expr(F.col(ids_col), tok))
    return decode_by_join(token_docs, tok, ids_col, out_col)


def decode_by_join(token_docs: DataFrame, tok: Tokenizer, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """F9 for any vocabulary size: J2 on the distinct ids of each block of rows, whose tokens then meet the block's rows.

    A block's ids are looked up once, so what is shuffled are the rows themselves and a block's distinct tokens, not a
    row per token of the texts.
    """
    numbered = token_docs.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), DECODE_BLOCK_BITS))
    rows = materialize(numbered, "decode_rows", large_rows=True)
    used = rows.select("_block", F.explode(F.array_distinct(ids_col)).alias("id")).distinct()
    tokens = decode_join(used.groupBy("_block").agg(F.collect_list("id").alias("ids")),
                         vocab_frame(token_docs.sparkSession, tok), keys=("_block",))

    def gather(block: pa.Table, found: pa.Table) -> pa.Table:
        lists = block.column(ids_col).combine_chunks()
        flat = lists.flatten()
        if flat.null_count:
            raise ValueError("token id missing from vocabulary")  # G12
        known = found.column("token_id").to_numpy()
        order = np.argsort(known)
        at = order[np.searchsorted(known, flat.to_numpy(), sorter=order)]
        each = found.column("token").combine_chunks().cast(pa.large_binary()).take(pa.array(at))
        sizes = np.cumsum(np.append(0, pc.binary_length(each).to_numpy()))
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
        data = each.buffers()[2].to_pybytes() if len(each) else b""
        texts = [data[a:b] if ok else None for a, b, ok in zip(
            sizes[ends[:-1]].tolist(), sizes[ends[1:]].tolist(), lists.is_valid().to_pylist(), strict=True)]
        return block.append_column("_text", pa.array(texts, pa.binary()))

    schema = T.StructType([*rows.schema.fields, T.StructField("_text", T.BinaryType())])
    tokens = tokens.select(F.col("_block").alias("_of"), "token_id", "token")
    texts = rows.groupBy("_block").cogroup(tokens.groupBy("_of")).applyInArrow(gather, schema)
    return texts.withColumn(out_col, F.make_valid_utf8(F.col("_text").cast("string"))).drop("_block", "_text")


def vocab_frame(spark, tok: Tokenizer) -> DataFrame:
    """D8 ``vocab(token_id INT, token BINARY)``."""
    from ..operators.bpe import VOCAB_SCHEMA

    return spark.createDataFrame(sorted(tok.vocab.items()), VOCAB_SCHEMA)


def decode_join(token_docs: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(*keys, pos, token_id, token)`` by a join on the id.

    A vocabulary up to BROADCAST_VOCAB_BYTES is broadcast, so the tokens are not shuffled. With a larger one the join is
    salted: a frequent id (a third of all tokens, say) is spread over DECODE_SALTS tasks. A missing id is an error (G12).
    """
    toks = token_docs.select(*keys, F.posexplode("ids").alias("pos", "token_id"))
    if _fits_broadcast(vocab):
        joined = toks.join(F.broadcast(vocab), "token_id", "left")
    else:
        salted = toks.withColumn("_salt", F.pmod(F.col("pos"), F.lit(DECODE_SALTS)))
        spread = vocab.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(DECODE_SALTS - 1))))
        joined = salted.join(spread, ["token_id", "_salt"], "left")
    return joined.select(*keys, "pos", "token_id", _present("token"))


def _fits_broadcast(vocab: DataFrame) -> bool:
    """Measured: Spark does not know the size of a frame made from Python rows and would shuffle a row per token."""
    held = vocab.agg(F.sum(F.coalesce(F.octet_length("token"), F.lit(0)) + F.lit(BROADCAST_ROW_BYTES))).first()[0]
    return (held or 0) <= BROADCAST_VOCAB_BYTES


def count_tokens(token_docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """How often each token occurs, ``(token_id, token, n)``: each occurrence is looked up (J2), then they are counted."""
    return decode_join(token_docs, vocab, keys=()).groupBy("token_id", "token").agg(F.count(F.lit(1)).alias("n"))


def _present(token: str) -> Column:
    return F.coalesce(F.col(token), F.raise_error(F.lit("token id missing from vocabulary")).cast("binary")).alias(token)


def token_counts(token_docs: DataFrame, by: Sequence[str] = (), rollup: bool = False) -> DataFrame:
    """Tokens per group (and in total with ``rollup``): ``(*by, n_docs, n_tokens)``."""
    sized = token_docs.select(*by, F.size("ids").alias("_n"))  # the arrays stay out of the rollup
    aggs = [F.count(F.lit(1)).alias("n_docs"), F.sum("_n").cast("long").alias("n_tokens")]
    if not by:
        return sized.agg(*aggs)
    grouped = sized.rollup(*by) if rollup else sized.groupBy(*by)
    return grouped.agg(*aggs)


def id_width(vocab_size: Column | int) -> Column:
    """P5: bits of the narrowest unsigned id type for a vocabulary (inclusive 2^16 / 2^32 limits)."""
    v = F.lit(vocab_size) if isinstance(vocab_size, int) else vocab_size
    return F.when(v <= 65536, F.lit(16)).when(v <= 4294967296, F.lit(32)).otherwise(F.lit(64))
