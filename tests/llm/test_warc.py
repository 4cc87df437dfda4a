"""WARC: archives written whole, normalised, and read back, against the pages themselves and Python's gzip module."""

import base64
import collections
import glob
import gzip
import hashlib
import json

import pytest
from llm_texts import prose

from tokenyard.llm import warc
from tokenyard.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def want(rows, min_bytes=0):
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = collections.Counter()
    for h, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        n = len(h.encode())
        for k, i in enumerate(ids):
            first = k == len(ids) - 1 or n < min_bytes
            out[i, n, digest(h), "response" if first else "revisit", None if first else ids[-1]] += 1
    return out


def page(urn):
    return int(urn.split(":")[2]) if urn and urn.split(":")[2] else None


def whole(spark, rows, root, min_bytes=0, volume_bytes=4000, partitions=3):
    table = f"{root}/pages"
    spark.createDataFrame(rows, PAGES).repartition(partitions).write.parquet(table)
    warc.write_archives(warc.page_records(spark.read.parquet(table), min_bytes), f"{root}/whole")
    warc.normalise(spark, f"{root}/whole", f"{root}/members", volume_bytes)
    return warc.read_records(spark, f"{root}/members", payloads=True).collect()


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""),
    (5, "http://a/5\r\nWARC-Type: evil", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"),
    (6, "u", "\nWARC/1.1\nline\r\n\r"), (7, "u", "\r\n\r\n"), (8, "u", "\x00\x1f\x8b\x08 é 漢字"), (None, "u", "<p>one</p>"),
    (None, "u", "alone"), (9, "u", prose(1, 4000)), (10, "u", prose(2, 60000)), (11, "u", "x" * 300000), (-12, "u", "neg"),
    (13, "u", "twice"), (13, "u", "twice"), (13, "v", "other"),
] + [(100 + k, "h", "hot") for k in range(200)] + [(400 + k, f"u{k}", prose(k, 30 + k)) for k in range(60)]


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip(spark, tmp_out, min_bytes):
    read = whole(spark, ROWS, tmp_out, min_bytes)
    got = collections.Counter((page(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, page(r.refers_to)) for r in read)
    assert got == want(ROWS, min_bytes)
    texts = collections.defaultdict(list)
    for i, _, h in ROWS:
        texts[i].append((h or "").encode())
    by_id = {r.record_id: r for r in read}
    assert len(by_id) == len(ROWS)
    for r in read:
        if r.record_type == "response":
            assert r.digest_ok and bytes(r.payload) in texts[page(r.record_id)]
        else:
            first = by_id[r.refers_to]
            assert (first.record_type, first.payload_digest, first.payload_bytes) == ("response", r.payload_digest, r.payload_bytes)


def test_files_and_index(spark, tmp_out):
    """Archives are one gzip stream; volumes have a member per record, just where the index says; both are valid gzip."""
    read = whole(spark, ROWS, tmp_out)
    streams = glob.glob(f"{tmp_out}/whole/*.gz")
    for f in streams:
        data = open(f, "rb").read()
        assert len(list(warc._members(memoryview(data)))) <= 1
    records = b"".join(gzip.open(f).read() for f in streams)
    volumes = {f.split("volume=")[1].split("/")[0]: open(f, "rb").read() for f in glob.glob(f"{tmp_out}/members/kind=warc/*/part*")}
    tables = {f.split("volume=")[1].split("/")[0]: gzip.open(f).read() for f in glob.glob(f"{tmp_out}/members/kind=cdx/*/part*")}
    assert sorted(b"".join(gzip.decompress(v) for _, v in sorted(volumes.items()))) == sorted(records)
    assert volumes.keys() == tables.keys() and len(volumes) > 5
    listed = set()
    for name, table in tables.items():
        at = 0
        for k, line in enumerate(table.decode().splitlines()):
            ordinal, offset, length, record_id, kind = json.loads(line)
            assert (ordinal, offset) == (k, at)
            member = gzip.decompress(volumes[name][offset:offset + length])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n") and record_id.encode() in member
            at += length
            listed.add((name, ordinal, offset, length, record_id, kind))
    assert listed == {(r.volume, r.ordinal, r.offset, r.length, r.record_id, r.record_type) for r in read}
    assert listed == {tuple(r) for r in warc.read_index(spark, f"{tmp_out}/members").collect()}
    some = [r for r in read if r.payload_bytes in (3, 300000)]
    ids = spark.createDataFrame([(r.record_id,) for r in some] * 2 + [(None,), ("none",)], "record_id string")
    got = warc.fetch_records(spark, f"{tmp_out}/members", ids).collect()
    assert sorted(map(str, got)) == sorted(map(str, some))


def test_large_record_ends_volume(spark, tmp_out):
    """A record of over 16 MB does not end in a zero byte; an empty member follows it."""
    rows = [(1, "u", "ab" * (9 << 20)), (2, "u", "small")]
    read = {page(r.record_id): r.payload_bytes for r in whole(spark, rows, tmp_out, partitions=1)}
    assert read == {1: 18 << 20, 2: 5}
    for f in glob.glob(f"{tmp_out}/members/kind=warc/*/part*"):
        assert gzip.open(f).read().startswith(b"WARC/1.1")


def test_foreign_archive(spark, tmp_path):
    """Archives of others: bare payloads, binary bytes, members already apart, no line breaks at the very end."""
    (tmp_path / "in").mkdir()
    payload = bytes(range(256)) * 20

    def record(i, body):
        return b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:r:%d>\r\ncontent-length: %d\r\n\r\n%s" % (i, len(body), body)

    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(record(1, payload) + b"\r\n\r\n" + record(2, b"") + b"\r\n\r\n" + record(3, b"end")))
    (tmp_path / "in" / "b.warc.gz").write_bytes(gzip.compress(record(4, b"\n") + b"\r\n\r\n") + gzip.compress(record(5, payload) + b"\r\n\r\n"))
    warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    read = {r.record_id: r for r in warc.read_records(spark, str(tmp_path / "out"), payloads=True).collect()}
    assert {k: bytes(r.payload) for k, r in read.items()} == {
        "<urn:r:1>": payload, "<urn:r:2>": b"", "<urn:r:3>": b"end", "<urn:r:4>": b"\n", "<urn:r:5>": payload}
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc.gz").write_bytes(gzip.compress(record(1, payload)[:-5]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.normalise(spark, str(tmp_path / "cut"), str(tmp_path / "out2"))


def test_no_pages_and_other_columns(spark, tmp_out):
    assert whole(spark, [], tmp_out + "/none") == []
    odd = spark.createDataFrame([(1, "u", "h", "x", "y")], PAGES + ", digest string, `a.b` string")
    assert warc.page_records(odd).count() == 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                              for r in QUERIES["op12_warc"](spark, sf).collect())
    assert got == want(rows)
