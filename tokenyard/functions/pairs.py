"""Column functions over token arrays / token strings: adjacent pairs (F4) and pair merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import merged_string, pair_string


def adjacent_pairs(arr: Column) -> Column:
    """ARRAY<STRUCT<left, right>> of all neighbours, counted overlapping (``aaa`` -> 2 pairs).

    Arrays shorter than 2 give an empty array (``sequence(1, 0)`` would count down, zip_with does not).
    """
    n = F.size(arr)
    return F.when(n < 2, F.array().cast("array<struct<left:string,right:string>>")).otherwise(
        F.zip_with(
            F.slice(arr, 1, n - 1),
            F.slice(arr, 2, n - 1),
            lambda l, r: F.struct(l.alias("left"), r.alias("right")),
        )
    )


def merge_pair(toks: Column, left_hex: str, right_hex: str) -> Column:
    """greedy left-to-right, non-overlapping merge of one pair in a token string."""
    return F.replace(toks, F.lit(pair_string(left_hex, right_hex)), F.lit(merged_string(left_hex, right_hex)))


def merge_pairs(toks: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply several merges in order (a chain of ``replace`` calls inside one projection)."""
    for left_hex, right_hex in pairs:
        toks = merge_pair(toks, left_hex, right_hex)
    return toks


def contains_any_pair(toks: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """True where the token string holds at least one of the pairs."""
    cond = F.lit(False)
    for left_hex, right_hex in pairs:
        cond = cond | F.instr(toks, pair_string(left_hex, right_hex)).__gt__(0)
    return cond
