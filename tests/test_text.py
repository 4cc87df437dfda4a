from pyspark.sql import functions as F

from brute import pieces
from tokenyard.functions.text import DEFAULT_SPECIAL, pretokenize, split_special, token_string
from tokenyard.operators.counts import pretoken_counts
from tokenyard.operators.segments import special_segments

EDGE = [
    "Hello, how are you?",
    "a  b\n\n\nc \n d",
    "Héllò hôw are ü? 🙃",
    "x y z\x85w\x1cq",
    "I'll we've 12345 ab12 don't",
    "  \n",
    "",
    "tab\tsep\r\nline",
    "é combining",
]


def _extract(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", pretokenize("t").alias("p")).collect()
    return {r.i: list(r.p) for r in rows}


def test_pieces_inline(spark):
    got = _extract(spark, ["Hello, how are you?", "a  b\n\n\nc \n d"])
    assert got[0] == ["Hello", ",", " how", " are", " you", "?"]
    assert got[1] == ["a", " ", " b", "\n\n", "\n", "c", " \n", " d"]


def test_pieces_match_python_regex_on_edge_strings(spark):
    got = _extract(spark, EDGE)
    for i, t in enumerate(EDGE):
        assert got[i] == pieces(t), repr(t)


def test_split_overlapping_specials_longest_first(spark):
    x = DEFAULT_SPECIAL
    text = f"Hello, how {x}{x} are you?{x}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    segs = special_segments(df, [x, x + x]).orderBy("seg_idx").collect()
    specials = [r.segment for r in segs if r.is_special]
    assert specials == [x + x, x]
    assert "".join(r.segment for r in segs) == text


def test_split_keeps_empty_segments_like_re_split(spark):
    x = DEFAULT_SPECIAL
    df = spark.createDataFrame([(x + x,)], "t string")
    parts = df.select(split_special(F.col("t"), [x]).alias("s")).first().s
    assert list(parts) == ["", x, "", x, ""]


def test_pretoken_counts_drop_specials(spark):
    x = DEFAULT_SPECIAL
    df = spark.createDataFrame([(f"the cat{x} the dog",)], "text string")
    got = {r.word: r.freq for r in pretoken_counts(df, [x]).collect()}
    assert got == {"the": 1, " cat": 1, " the": 1, " dog": 1}


def test_token_string(spark):
    df = spark.createDataFrame([("aé",)], "w string")
    assert df.select(token_string("w").alias("t")).first().t == "|61||C3||A9|"


def test_without_specials_lines_are_the_unit(spark):
    df = spark.createDataFrame([("a\n\n\nb",)], "text string")
    got = {r.word: r.freq for r in pretoken_counts(df).collect()}
    assert got == {"a": 1, "\n": 3, "b": 1}
    got = {r.word: r.freq for r in pretoken_counts(df, ["<|endoftext|>"]).collect()}
    assert got == {"a": 1, "\n\n": 1, "\n": 1, "b": 1}


def test_pretokenize_parity_property(spark):
    """Random strings over long-established scripts, blanks of all kinds and contractions."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = (
        list("abcXYZ019 '\t\n\r.,!?-_()[]{}<>|") + ["'s", "'ll", "'ve", "'re", "'d", "'m", "'t"]
        + list("éüßçñøÅ") + list("αβγΩ") + list("жЖя") + list("中文字") + list("٣٤५६")
        + [" ", " ", "　", "\x0b", "\x0c", "\x85", "\x1c", "́", "🙃", "👍🏽", "‍"]
    )
    texts = []

    @settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck), database=None, derandomize=True)
    @given(st.lists(st.sampled_from(alphabet), max_size=40).map("".join))
    def collect(t):
        texts.append(t)

    collect()
    got = _extract(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == pieces(t), repr(t)


def test_split_refuses_text_with_sentinel(spark):
    import pytest

    plain = spark.createDataFrame([("a\ufdd0b",)], "t string")
    assert list(plain.select(split_special(F.col("t"), [DEFAULT_SPECIAL]).alias("s")).first().s) == ["a\ufdd0b"]
    mixed = spark.createDataFrame([(f"a\ufdd0b{DEFAULT_SPECIAL}c",)], "t string")
    with pytest.raises(Exception):
        mixed.select(split_special(F.col("t"), [DEFAULT_SPECIAL])).collect()
