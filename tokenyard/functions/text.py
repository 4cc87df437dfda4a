"""Column functions for text: pre-tokenizer, byte-token strings, special-token splitting.

Tokens travel through the learner as *token strings*: every byte-level token is written as its
upper-case hex digits wrapped in bars, so the word ``ab`` is ``|61||62|``. Upper-case hex compares
like unsigned bytes (shorter prefix first), which is the order the learner's tie-break needs, and a
pair ``(L, R)`` occurs in a word exactly where the substring ``|L||R|`` occurs, so merging a pair is
one ``replace`` call: left-to-right and non-overlapping, like the reference's greedy merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference for identical results) --------------------------
# GPT-2 style pre-token pattern: contractions, optional space + letters, optional space + digits,
# optional space + other symbols, a whitespace run not followed by a non-space, any whitespace run.
PRETOKEN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Special token used when none is given.
DEFAULT_SPECIAL = "<|endoftext|>"
# ----------------------------------------------------------------------------------------------

# Java needs UNICODE_CHARACTER_CLASS so that \s, \p{L} and \p{N} follow Unicode like Python's regex.
JAVA_PRETOKEN_PATTERN = "(?U)" + PRETOKEN_PATTERN

# A Unicode noncharacter (U+FDD0) that separates segments while splitting at special tokens.
_SENTINEL = "\ufdd0"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretokenize(text: Column | str) -> Column:
    """text -> ARRAY<STRING> of pre-tokens, evaluated in the JVM (no Python)."""
    return F.regexp_extract_all(_col(text), F.lit(JAVA_PRETOKEN_PATTERN), F.lit(0))


def quote_literal(s: str) -> str:
    """a Java regex that matches ``s`` literally (handles an embedded ``\\E``)."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def specials_longest_first(specials: Sequence[str] | None) -> list[str]:
    """Stable sort by length, longest first, so overlapping specials match the longer one."""
    return sorted(specials or [], key=len, reverse=True)


def special_alternation(specials: Sequence[str]) -> str:
    return "(" + "|".join(quote_literal(s) for s in specials_longest_first(specials)) + ")"


def split_special(text: Column | str, specials: Sequence[str] | None) -> Column:
    """ARRAY<STRING> of segments; specials are kept as their own segments.

    Same shape as a capturing ``re.split``: text between matches (possibly empty) alternates with
    the matched specials. Works with one regexp_replace + split, so long texts need no recursion.
    """
    text = _col(text)
    if not specials:
        return F.array(text)
    # Most texts hold no special at all: a substring test spares them the regex scan and the split.
    has_special = F.lit(False)
    for sp in specials:
        has_special = has_special | (F.instr(text, sp) > 0)
    marked = F.regexp_replace(text, special_alternation(specials), _SENTINEL + "$1" + _SENTINEL)
    # A text that already holds the sentinel (a Unicode noncharacter) would be cut wrongly: fail loudly.
    guarded = F.when(F.instr(text, _SENTINEL) > 0, F.raise_error(F.lit("text contains U+FDD0"))).otherwise(marked)
    return F.when(has_special, F.split(guarded, _SENTINEL, -1)).otherwise(F.array(text))


def is_special(segment: Column | str, specials: Sequence[str] | None) -> Column:
    """P4 predicate: the segment is one of the special tokens."""
    if not specials:
        return F.lit(False)
    return _col(segment).isin(list(specials))


def utf8_hex(text: Column | str) -> Column:
    """upper-case hex of the UTF-8 bytes."""
    return F.hex(F.encode(_col(text), "UTF-8"))


def token_string(word: Column | str) -> Column:
    """word -> token string of single-byte tokens, ``|61||62|``."""
    return F.regexp_replace(utf8_hex(word), "(..)", "|$1|")


def token_array(toks: Column | str) -> Column:
    """Token string -> ARRAY<STRING> of hex tokens."""
    toks = _col(toks)
    return F.split(F.substring(toks, F.lit(2), F.length(toks) - 2), r"\|\|", -1)


def token_count(toks: Column | str) -> Column:
    """Number of tokens in a token string (two bars per token)."""
    toks = _col(toks)
    return ((F.length(toks) - F.length(F.regexp_replace(toks, r"\|", ""))) / 2).cast("int")


def pair_string(left_hex: str, right_hex: str) -> str:
    return f"|{left_hex}||{right_hex}|"


def merged_string(left_hex: str, right_hex: str) -> str:
    return f"|{left_hex}{right_hex}|"
