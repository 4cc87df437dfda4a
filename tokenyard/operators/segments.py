"""Cut documents at special tokens into ordered segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_special, split_special


def special_segments(
    docs: DataFrame,
    specials: Sequence[str] | None,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    keep_specials: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """D2 pieces: ``(*keys, seg_idx, segment, is_special)``.

    Narrow (no shuffle): one regexp_replace + split + posexplode per row, order kept by ``seg_idx``.
    ``keep_specials=False`` is P2 (training drops them); ``keep_empty=False`` is P3.
    """
    seg = docs.select(
        *keys, F.posexplode(split_special(F.col(text_col), specials)).alias("seg_idx", "segment")
    ).withColumn("is_special", is_special("segment", specials))
    if not keep_empty:
        seg = seg.filter(F.col("segment") != "")
    if not keep_specials:
        seg = seg.filter(~F.col("is_special"))
    return seg
