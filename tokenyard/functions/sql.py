"""SQL surface: tokenizing as a table function, for users who stay in SQL.

``SELECT * FROM tokenize_table(TABLE(SELECT doc_id, text FROM documents))`` works on Arrow batches with the encoder of
`operators.encode.encode`, and gives its rows in batches of a bounded stretch of texts.
``SELECT d.doc_id, t.pos, t.token_id, t.token FROM documents d, LATERAL tokenize(d.text) t`` is the lateral form, with
Python per row. Both cut whole texts (F7).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf, udtf

from .codec import Tokenizer, bpe_word, shared_encoder
from .text import PRETOKEN_PATTERN


def register_tokenize(spark: SparkSession, tok: Tokenizer, name: str = "tokenize") -> None:
    """Register ``name(text) -> (pos INT, token_id INT, token BINARY)`` for SQL."""
    bc = spark.sparkContext.broadcast((tok.merge_rank, tok.bytes_to_id, tok.special_ids(), dict(tok.vocab)))

    @udtf(returnType="pos: int, token_id: int, token: binary")
    class Tokenize:
        def __init__(self):
            import regex

            self.rank, self.b2id, self.special_ids, self.vocab = bc.value
            self.pat = regex.compile(PRETOKEN_PATTERN)
            specials = list(self.special_ids)
            self.split = (
                regex.compile("(" + "|".join(regex.escape(s) for s in specials) + ")").split if specials else None
            )

        def eval(self, text: str):
            if text is None:
                return
            pos = 0
            for part in self.split(text) if self.split else [text]:
                if not part:
                    continue
                if part in self.special_ids:
                    ids = [self.special_ids[part]]
                else:
                    ids = [i for m in self.pat.finditer(part) for i in bpe_word(m.group(0), self.rank, self.b2id)]
                for i in ids:
                    yield pos, i, self.vocab[i]
                    pos += 1

    spark.udtf.register(name, Tokenize)


def register_tokenize_table(spark: SparkSession, tok: Tokenizer, name: str = "tokenize_table") -> None:
    """Register ``name(TABLE(key BIGINT, text STRING)) -> (key, pos INT, token_id INT)`` for SQL, in Arrow batches.

    The table's first column is the key, its second the text; a null or empty text gives no rows. Rows come in order
    within a text.
    """
    encoder = shared_encoder(spark, tok)

    @arrow_udtf(returnType="key bigint, pos int, token_id int")
    class TokenizeTable:
        def eval(self, batch: pa.RecordBatch):
            keys = batch.column(0).cast(pa.int64())
            for at, n, ids in encoder().lists(batch.column(1)):
                start, row = ids.offsets.to_numpy(), ids.value_parent_indices()
                pos = np.arange(len(row), dtype=np.int32) - start[row.to_numpy()]
                yield pa.table({"key": keys.slice(at, n).take(row), "pos": pa.array(pos, pa.int32()), "token_id": ids.flatten()})

    spark.udtf.register(name, TokenizeTable)
