"""K1: tokenizer files in the hex JSON v1 exchange form (one small file per table)."""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from ..functions.codec import Tokenizer
from ..sources.tokenizer_files import HEX_FORMAT


def tokenizer_json(tok: Tokenizer) -> tuple[str, str]:
    """The two JSON documents (vocabulary-sized, built on the driver from the driver-side Tokenizer)."""
    vocab = {"format": HEX_FORMAT, "vocab": {str(i): b.hex() for i, b in tok.vocab.items()}}
    merges = {"format": HEX_FORMAT, "merges": [[l.hex(), r.hex()] for (l, r), _ in sorted(tok.merge_rank.items(), key=lambda t: t[1])]}
    return json.dumps(vocab), json.dumps(merges)


def write_tokenizer(spark: SparkSession, tok: Tokenizer, vocab_path: str, merges_path: str) -> int:
    """Write vocabulary and merges; returns the vocabulary size (like the reference's trainer).

    Each document is one row written by Spark's text sink as a single part file in the folder.
    """
    v, m = tokenizer_json(tok)
    for doc, path in ((v, vocab_path), (m, merges_path)):
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return tok.vocab_size


def single_file(path: str) -> str:
    """The part file inside a folder written by ``write_tokenizer`` (for readers that need a file)."""
    if os.path.isdir(path):
        parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
        return os.path.join(path, parts[0])
    return path
