"""Token datasets in ``.npy`` files (one dimension of little-endian unsigned integers), read in parallel.

A file is read like any splittable one: as bytes that end at newline bytes, each with its offset, so every split knows
which tokens it holds. A token that crosses the border of two splits is put together from its two parts. The header is
the file's first line by the format's definition. Bytes beyond the stated number of tokens are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.tables import materialize
from .scan import placed_bytes

#: Fixed values of the format: the magic bytes, and the types that token ids are written in.
MAGIC = b"\x93NUMPY"
WIDTHS = {"<u2": 2, "<u4": 4, "<u8": 8}
#: Tokens of a row at most.
ROW_TOKENS = 1 << 18

_HEADERS = "file string, width int, n long, data_start long"
_PARTS = "file string, lo long, ids array<long>, at int, piece binary"


def npy_header(n: int, width: int) -> bytes:
    """The header of a file of ``n`` tokens of ``width`` bytes: 128 bytes that end in a newline."""
    text = f"{{'descr': '<u{width}', 'fortran_order': False, 'shape': ({n},), }}".encode()
    return MAGIC + b"\x01\x00" + (118).to_bytes(2, "little") + text.ljust(117) + b"\n"


def parse_header(line: bytes) -> tuple[int, int, int]:
    """(width, tokens, offset of the first) from a file's first line."""
    found = re.search(rb"'descr': *'([<>|=]?\w+)'.*'fortran_order': *False.*'shape': *\((\d+), *\)", line)
    if not line.startswith(MAGIC) or not found or found[1].decode() not in WIDTHS:
        raise ValueError("not a .npy file of one dimension of unsigned 16, 32 or 64-bit integers")
    wide = line[6] > 1
    return WIDTHS[found[1].decode()], int(found[2]), int.from_bytes(line[8:12 if wide else 10], "little") + (12 if wide else 10)


def npy_headers(rows: DataFrame) -> DataFrame:
    """``(file, width, n, data_start)`` from the rows of ``placed_bytes``; one row per file."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, n, start = zip(*(parse_header(x.as_py()) for x in batch.column("text")), strict=True) if len(batch) else ((),) * 3
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(width, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(start, pa.int64())], [f.split()[0] for f in _HEADERS.split(", ")])

    return rows.where("line_start = 0").select("file", "text").mapInArrow(parse, _HEADERS)


def _tokens(rows: DataFrame) -> DataFrame:
    """Rows ``_PARTS``: whole tokens from number ``lo`` on, or a ``piece`` of token ``lo`` from its byte ``at`` on."""
    names = [f.split()[0] for f in _PARTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at, held, width, begin, end = None, 0, b"", 1, 0, 0  # held: bytes from offset at on

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        def take(last: bool) -> list[tuple]:
            nonlocal at, held
            found = []
            if at < begin:  # the header
                gone = min(begin - at, len(held))
                at, held = at + gone, held[gone:]
            held = held[:max(0, end - at)]
            if held and (inside := (at - begin) % width):  # the split begins within a token
                gone = min(width - inside, len(held))
                found.append((file, (at - begin) // width, None, inside, held[:gone]))
                at, held = at + gone, held[gone:]
            whole = len(held) // width * width
            for i in range(0, whole, ROW_TOKENS * width):
                ids = np.frombuffer(held[i:min(whole, i + ROW_TOKENS * width)], f"<u{width}")
                if len(ids) and int(ids.max()) >= 1 << 63:
                    raise ValueError("a token id of 2**63 or more")
                found.append((file, (at + i - begin) // width, ids.astype(np.int64), None, None))
            at, held = at + whole, held[whole:]
            if last and held:
                found.append((file, (at - begin) // width, None, 0, held))
            return found

        split = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "split", "text", "width", "n", "data_start"))
            parts: list[bytes] = []
            rows = []
            for own, own_split, text, own_width, n, start in zip(*columns, strict=True):
                if (own, own_split) != (file, split):
                    held += b"".join(parts)
                    rows += take(True) if file is not None else []
                    parts, held, file, split, at, width, begin, end = [], b"", own, own_split, own_split, own_width, start, start + n * own_width
                parts.append(text)
            held += b"".join(parts)
            rows += take(False)
            yield out(rows)
        if file is not None:
            yield out(take(True))

    return rows.mapInArrow(read, _PARTS)


def read_npy(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Rows ``(lo, ids array<long>)`` with every token of the files under ``path`` once, and the number of tokens.

    Files follow one another in the order of their paths; ``lo`` is a row's place in the whole stream.
    """
    rows = placed_bytes(spark, path)
    headers = materialize(npy_headers(rows), "npy-headers")  # one row per file
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    base = headers.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    total = int(headers.agg(F.sum("n")).first()[0] or 0)
    tokens = _tokens(rows.join(F.broadcast(headers), "file").select("file", "split", "text", "width", "n", "data_start"))
    found = materialize(tokens, "npy-tokens", large_rows=True)  # read several times by what makes blocks of it
    whole = found.where("piece IS NULL").select("file", "lo", "ids")
    pieces = found.where("piece IS NOT NULL").groupBy("file", "lo").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.hex("piece").alias("h")))), lambda x: x["h"]), "").alias("h"))
    # little-endian: the bytes from last to first are the number
    number = F.conv(F.array_join(F.reverse(F.split(F.regexp_replace("h", "(..)(?=.)", "$1 "), " ")), ""), 16, 10).cast("long")
    return whole.unionByName(pieces.select("file", "lo", F.array(number).alias("ids"))).join(F.broadcast(base), "file").select(
        (F.col("base") + F.col("lo")).alias("lo"), "ids"), total
