"""P1-P4 and F1 in Python workers: texts -> pre-tokens, by one call of a compiled pattern per text.

The patterns are ``PRETOKEN_PATTERN`` with its classes written as ranges. The ranges come from the JVM once per driver, so
both sides agree on every code point whatever Unicode versions they have. There is a pattern for ASCII texts, one for
texts without supplementary characters and one for all others, as few ranges make a class fast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import specials_longest_first

#: Bytes of text that a worker turns into one batch of its own (a longer text is one by itself).
STEP_BYTES = 1 << 20
#: Distinct words, and characters read, after which a worker hands its counts on.
COUNTED_WORDS, COUNTED_CHARS = 1 << 18, 1 << 26

Ranges = list[tuple[int, int]]
_CLASSES: dict[str, Ranges] = {}


def char_classes(spark: SparkSession) -> dict[str, Ranges]:
    """The code points of ``\\p{L}``, ``\\p{N}`` and ``\\s`` as the JVM's patterns know them."""
    if not _CLASSES:
        planes = ["".join(chr(c) for c in range(p << 16, (p + 1) << 16) if not 0xD800 <= c < 0xE000) for p in range(17)]
        runs = spark.createDataFrame([(p,) for p in planes], "plane string").select(
            *[F.regexp_extract_all("plane", F.lit(f"(?U){c}+"), F.lit(0)) for c in (r"\p{L}", r"\p{N}", r"\s")]).collect()
        for i, name in enumerate("LNS"):
            _CLASSES[name] = sorted((ord(run[0]), ord(run[-1])) for row in runs for run in row[i])
    return _CLASSES


def _class(ranges: Ranges, limit: int) -> str:
    return "".join(f"\\U{a:08x}-\\U{min(b, limit):08x}" for a, b in ranges if a <= limit)


class PreTokenizer:
    """Pre-tokens of texts. ``per_line`` cuts at newlines first and keeps them (G13, G14); specials stay whole."""

    def __init__(self, classes: dict[str, Ranges], specials: Sequence[str] = (), per_line: bool = False):
        self.specials, self.per_line = specials_longest_first(specials), per_line
        self.split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")").split
        self.ascii, self.narrow, self.wide = (self._pattern(classes, limit) for limit in (0x7F, 0xFFFF, 0x10FFFF))

    @staticmethod
    def _pattern(classes: dict[str, Ranges], limit: int):
        L, N, S = (_class(classes[c], limit) for c in "LNS")
        return re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+").findall

    def _words_of(self, text: str):
        if text.isascii():
            return self.ascii
        return self.narrow if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else self.wide

    def pieces(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Runs ``(special, words)`` in text order: pre-tokens of a stretch, or one special."""
        words = self._words_of(text)
        units = [text]
        if self.per_line:
            units = text.split("\n")
            units = [*[u + "\n" for u in units[:-1]], units[-1]]
        if not any(s in text for s in self.specials):
            yield False, words(text) if not self.per_line else list(chain.from_iterable(map(words, units)))
            return
        for unit in units:
            for i, part in enumerate(self.split(unit)):
                if part:
                    yield (True, [part]) if i % 2 else (False, words(part))


def spans(texts: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of stretches of rows of about ``step`` bytes."""
    if len(texts) == 0:
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // step)) + 1
    ends = [*cuts.tolist(), len(texts)]
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        yield start, end - start


def word_counts(docs: DataFrame, specials: Sequence[str] | None, text_col: str) -> DataFrame:
    """``(word, n)``: pre-tokens that are not specials with how often a worker saw them; to be summed by word."""
    classes = char_classes(docs.sparkSession)
    of = dict(specials=list(specials or []), per_line=not specials)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counted, chars = PreTokenizer(classes, **of), Counter(), 0

        def out() -> Iterator[pa.RecordBatch]:
            found = pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())],
                                               ["word", "n"])
            for at in range(0, len(found), 1 << 14):
                yield found.slice(at, 1 << 14)
            counted.clear()

        for batch in batches:
            texts = batch.column("text")
            for start, n in spans(texts):
                for text in texts.slice(start, n).to_pylist():
                    for special, words in cut.pieces(text or ""):
                        if not special:
                            counted.update(words)
                    chars += len(text or "")
                if len(counted) >= COUNTED_WORDS or chars >= COUNTED_CHARS:
                    yield from out()
                    chars = 0
        yield from out()

    return docs.select(F.make_valid_utf8(F.col(text_col)).alias("text")).mapInArrow(count, "word string, n long")
