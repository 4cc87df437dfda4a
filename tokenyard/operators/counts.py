"""Pre-token frequencies, byte-pair counts and the best pair.

The expensive expansion (text -> pre-tokens -> byte pairs) always runs on *distinct* words weighted by
frequency: A1 aggregates before A2 explodes. Catalyst cannot push a count below an ``explode`` by
itself, so the plan order here is deliberate. Both aggregates are partial + final hash aggregates,
so a very hot word (`` the``) is combined map-side and never becomes one large shuffle group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pretokens import word_counts
from ..functions.text import pretokenize, token_array, token_string
from .segments import special_segments


def pretokens(
    docs: DataFrame,
    specials: Sequence[str] | None = None,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """D3: one row per pre-token, ``(*keys, seg_idx, pos, word)``; specials dropped."""
    segs = special_segments(docs, specials, text_col=text_col, keys=keys, keep_specials=False)
    return segs.select(
        *keys, "seg_idx", F.posexplode(pretokenize("segment")).alias("pos", "word")
    )


def pretoken_counts(
    docs: DataFrame, specials: Sequence[str] | None = None, text_col: str = "text"
) -> DataFrame:
    """A1: ``word_freq(word, freq)`` over all segments that are not special tokens.

    With specials the unit of pre-tokenizing is the segment between specials; without any it is the
    line, newline kept (G14), so blank runs never join across lines. Workers count the words of many texts before a
    row leaves them (``pretokens.word_counts``).
    """
    return word_counts(docs, specials, text_col).groupBy("word").agg(F.sum("n").alias("freq"))


def word_tokens(word_freq: DataFrame) -> DataFrame:
    """Learner input: ``(toks, freq)`` with single-byte token strings; 1-token words carry no pair."""
    return word_freq.select(token_string("word").alias("toks"), F.col("freq").cast("long").alias("freq")).filter(
        F.instr("toks", "||") > 0
    )


def pair_occurrences(words: DataFrame, toks: F.Column | None = None, keep=("freq",)) -> DataFrame:
    """F4 as rows: ``(*keep, a, i, left, right)``, one per adjacent pair (overlapping: ``aaa`` -> 2).

    ``explode(sequence)`` with plain array indexing stays inside whole-stage codegen (a lambda over
    the array would be interpreted); arrays shorter than 2 yield nothing (``sequence`` would count down).
    """
    a, i = F.col("a"), F.col("i")
    arr = token_array(F.col("toks") if toks is None else toks)
    idx = F.when(F.size(a) >= 2, F.sequence(F.lit(0), F.size(a) - 2)).otherwise(F.array().cast("array<int>"))
    return (
        words.select(*keep, arr.alias("a"))
        .select(*keep, "a", F.explode(idx).alias("i"))
        .select(*keep, "a", "i", a[i].alias("left"), a[i + 1].alias("right"))
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """A2: ``(left, right, n)`` frequency-weighted overlapping adjacent pair counts (hex tokens)."""
    return pair_occurrences(words).groupBy("left", "right").agg(F.sum("freq").alias("n"))


def best_pair(pairs: DataFrame) -> DataFrame:
    """A3: one row, highest count; ties -> greatest (left, right) in raw byte order."""
    best = pairs.agg(F.max(F.struct("n", "left", "right")).alias("b"))
    return best.select("b.left", "b.right", "b.n").filter(F.col("n").isNotNull())


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs in learner order (a TakeOrderedAndProject, no global sort)."""
    return pairs.orderBy(F.desc("n"), F.desc("left"), F.desc("right")).limit(k)
