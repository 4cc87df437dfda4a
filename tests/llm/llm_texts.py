"""Invented texts and documents for the tests; test modules import the fixtures from here."""

import pytest
from pyspark.sql import types as T


def prose(seed: int, n: int) -> str:
    """n invented words, reproducible."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("abcdefghij"[x >> 8 & 7] + "klmnop"[(x >> 12) % 6] + "rstuvwxy"[x >> 16 & 7] + str(x >> 20 & 63))
    return " ".join(out)


DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with the other columns of the table."""

    def make(rows, partitions=3):
        full = [(i, t, "en", None if i is None else f"s{i % 4}", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOC).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, no line or word ends, ties, repeated rows, wide characters, a long text."""
    shared = prose(1, 80)
    base = prose(2, 400)
    edited = base.split(" ")
    edited[200] = "changed"
    return [
        (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "Two words"), (5, "one"), (5, "one"), (None, "no id at all"),
        (None, base), (6, base), (7, " ".join(edited)), (8, base.upper()), (9, prose(3, 60) + " " + shared + " " + prose(4, 60)),
        (10, prose(5, 70) + "\n" + shared), (11, shared + "\n" + prose(6, 40)), (12, prose(7, 3000)), (13, prose(7, 3000)),
        (14, "äöü ß é 漢字 " * 60), (15, "漢字" * 50), (16, "a" * 300), (17, "a " * 200), (18, "x" + "a" * 120 + "y"),
        (19, prose(8, 50)), (20, prose(8, 49)), (21, prose(8, 51)), (22, "\x00nul\x00 in text " * 20),
        (23, "<|im_end|><|im_start|>assistant ok"), (24, "l1\nl1\n\nl2\nl1"), (25, base), (25, base),
    ]
