"""The ordered scan against a scan of the whole file in memory, at several split sizes."""

import random
import re

import pytest

from tokenyard.session import sql_conf
from tokenyard.sources import scan as S


def brute(data: bytes, specials, target, separator=b"\n"):
    pattern = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(specials, key=len, reverse=True)))
    out, at, cuts, seen = [], 0, set(), -1
    for m in re.finditer(re.escape(separator), data):
        if m.start() // target > seen:
            seen = m.start() // target
            cuts.add(m.end())
    for a, b in [*((m.start(), m.end()) for m in pattern.finditer(data)), (len(data), len(data))]:
        if a - at >= target:
            for c in sorted(c for c in cuts if at < c <= a):
                out.append((at, data[at:c]))
                at = c
        out.append((at, data[at:a]))
        at = b
    return [(s, t) for s, t in out if t]


def check(spark, folder, files, specials, target, sizes, separator=b"\n"):
    for name, data in files.items():
        (folder / name).write_bytes(data)
    want = {name: brute(data, specials, target, separator) for name, data in files.items()}
    for size in sizes:
        with sql_conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1"):
            rows = S.scan_pieces(spark, str(folder), specials, target).collect()
        got = {name: [] for name in files}
        for r in rows:
            got[r.file.rsplit("/", 1)[1]].append((r.start, r.text.encode()))
        assert {k: sorted(v) for k, v in got.items()} == want, size


X = "<|end|>"


@pytest.mark.parametrize("specials", [[X, X + X, "<|pad|>"], ["ab", "aba", "b"], ["<|a\n|>", "\n\n", X], ["aa"]])
def test_overlapping_specials(spark, tmp_path, specials):
    """Specials that hold or overlap one another, at the borders of lines and splits, blank lines, no last newline."""
    rng = random.Random(len(specials[0]))
    pieces = [*specials, *specials, "a", "b", "\n", " ", "\n\n", "some words", "é漢", "<|", "|>", "<|end|", "aaaa"]
    files = {f"f{k}.txt": "".join(rng.choice(pieces) for _ in range(n)).encode() for k, n in enumerate((300, 299, 40, 1))}
    files |= {"empty.txt": b"", "only.txt": specials[0].encode() * 9, "none.txt": b"x y\n" * 200, "open.txt": b"x y\n" * 50 + b"z"}
    separator = b" " if any("\n" in s for s in specials) else b"\n"
    check(spark, tmp_path, files, specials, 100, (60, 333, 1 << 20), separator)


def test_large_file_without_specials(spark, tmp_path):
    """64 MB without a special: pieces of about the target, one order, whatever the splits."""
    rng = random.Random(2)
    lines = [("w%d " % k * rng.randrange(40)).encode() + b"\n" for k in range(3000)]
    data = b"".join(rng.choices(lines, k=1 << 19))
    data = data[:64 << 20] if len(data) > 64 << 20 else data * (1 + (64 << 20) // len(data))
    check(spark, tmp_path, {"big.txt": data[:64 << 20]}, [X], S.TARGET_BYTES, (5_000_000, 32 << 20))


def test_run_across_many_splits(spark, tmp_path):
    """One run of many lines below and above the target between specials; a line longer than many splits."""
    body = b"".join(b"line %d\n" % k for k in range(500))
    files = {"a.txt": b"start" + X.encode() + body + X.encode() + body[:700] + X.encode() + b"end",
             "b.txt": b"q" * 5000 + b"\n" + X.encode() + b"r" * 3000}
    check(spark, tmp_path, files, [X], 2000, (100, 1000))


def test_no_separator_left(spark, tmp_path):
    with pytest.raises(ValueError):
        S.scan_pieces(spark, str(tmp_path), ["\n \t\r\x00"])
    with pytest.raises(ValueError):
        S.scan_pieces(spark, str(tmp_path), [])
