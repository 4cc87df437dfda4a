"""The two preparation flows as Spark jobs: learn + save a tokenizer; encode + write a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.codec import Tokenizer
from ..functions.text import DEFAULT_SPECIAL
from ..operators.bpe import train_bpe
from ..operators.encode import encode
from ..sinks.tokenizer_files import write_tokenizer
from ..sinks.tokens import write_stretches, write_tokens
from ..sources.text import scan_lines


def train_tokenizer(
    spark: SparkSession,
    docs: DataFrame,
    vocab_size: int,
    vocab_path: str,
    merges_path: str,
    specials: Sequence[str] | None = None,
    text_col: str = "text",
) -> int:
    """Learn a byte-level BPE vocabulary from ``docs`` and save it; returns the vocabulary size."""
    specials = list(specials) if specials else [DEFAULT_SPECIAL]
    model = train_bpe(docs, vocab_size, specials, text_col=text_col)
    return write_tokenizer(spark, Tokenizer.from_model(model), vocab_path, merges_path)


def id_bits(vocab_size: int) -> int:
    """P5: width of the narrowest unsigned id type (2^16 and 2^32 limits inclusive)."""
    return 16 if vocab_size <= 1 << 16 else 32 if vocab_size <= 1 << 32 else 64


def encode_dataset(
    docs: DataFrame,
    tok: Tokenizer,
    out_path: str,
    text_col: str = "text",
    order_col: str = "doc_id",
    block_size: int = 1 << 16,
    halo: int = 1024,
) -> tuple[int, int]:
    """Encode ``docs`` line by line in ``order_col`` order and write the block dataset.

    Returns ``(token_count, id_bits)``; zero tokens is an error.
    """
    token_docs = encode(docs, tok, text_col=text_col, keys=(order_col,), per_line=True)
    count = write_tokens(token_docs, out_path, block_size, halo, order_col)
    return count, id_bits(tok.vocab_size)


def encode_files(
    spark: SparkSession,
    in_path: str,
    tok: Tokenizer,
    out_path: str,
    block_size: int = 1 << 16,
    halo: int = 1024,
) -> tuple[int, int]:
    """Encode text files line by line, in the order of their paths and lines, and write the block dataset.

    Lines are encoded where they are read and never shuffled; only pieces at the borders of file splits are. The result
    is the same for any number of workers and any split size. Returns ``(token_count, id_bits)``.
    """
    lines = scan_lines(spark, in_path)
    count = write_stretches(encode(lines, tok, keys=("file", "split"), per_line=True), out_path, block_size, halo)
    return count, id_bits(tok.vocab_size)
