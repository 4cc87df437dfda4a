"""WARC archives: pages as records of whole-file gzip streams, a normaliser that gives every record its own member, readers.

``write_archives`` writes records through Spark's gzip text sink: each file is one gzip stream, which can only be read
from its start. ``normalise`` inflates every such file once (Spark's text source streams it), cuts the stream into
records by their Content-Length, and writes each record as a gzip member of its own into volumes of bounded size,
with a sidecar index of offsets beside every volume. ``read_records`` reads whole volumes, ``fetch_records`` cuts
single members out of them by the index.

All files are read and written by Spark's own sources and sinks, so any file system that Spark knows will do.
Raw bytes go through the text sink: it writes a string's bytes as they are and one separator after each row. A gzip
member ends with the high byte of its length, which is zero below 16 MB, so the separator is a zero byte that takes the
place of the last byte of a volume (a larger last record is followed by an empty member, whose last byte is zero).
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenyard.session import sql_conf

#: Compressed bytes at which a volume is full, rows of a batch in a Python worker, and salts of copies.
VOLUME_BYTES, BATCH_ROWS, SALTS = 8 << 20, 1000, 16
#: Fixed values of the format.
BREAK, VERSION, PROFILE = "\r\n", "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = ("volume string, ordinal long, offset long, length long, record_id string, record_type string, target_uri string,"
          " refers_to string, payload_digest string, payload_bytes long, digest_ok boolean, payload binary")
INDEX = "volume string, ordinal long, offset long, length long, record_id string, record_type string"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: every five hex digits are four base32 digits."""
    digest = F.sha1(data)
    four = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*four), _HEX32, _BASE32)


def page_records(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One WARC record (column ``record``, without its two closing line breaks) per row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with the largest page_id (null ids last; of
    repeated rows the one that comes last) is a response, the others are revisits of it; rows with smaller payloads are
    all responses. A null html is an empty payload, a null url leaves its field out, line breaks in a url are escaped;
    other columns are ignored; no rows give no records. ``pages`` is read twice and repeated rows are told apart by
    their place, so it should come from files. Groups of copies are joined by digest and salt.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("*", base32_sha1(F.col("html").cast("binary")).alias("digest"),
                       F.octet_length("html").cast("long").alias("bytes"))
    copies = rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct("page_id", "row")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    salted = copies.select("digest", "top", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    joined = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(salted, ["digest", "salt"], "left")
    revisit = F.col("top").isNotNull() & (F.col("top.row") != F.col("row")) & (F.col("bytes") >= min_bytes)

    def named(page_id: Column, row: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row, F.lit(">"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}"), field("Content-Type", F.lit("text/html; charset=utf-8")),
                    field("Content-Length", F.col("bytes")), F.lit(BREAK))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(VERSION + BREAK), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", named(F.col("page_id"), F.col("row"))), field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), field("X-Payload-Length", F.col("bytes")),
        F.when(revisit, F.concat(field("WARC-Refers-To", named(F.col("top.page_id"), F.col("top.row"))),
                                 field("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block)), F.lit(BREAK))
    return joined.select(F.concat(head, block).alias("record"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write the column ``record`` as archives that are one gzip stream each, a file per partition. The sink's
    separator is the two line breaks that end a record."""
    with sql_conf(records.sparkSession, **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        records.select("record").write.option("compression", "gzip").option("lineSep", BREAK * 2).text(path)


def _head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split(BREAK)
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


class _Stream:
    """One inflated archive that arrives in parts; ``records`` gives those that are complete."""

    def __init__(self, path: str):
        self.path, self.held = path, bytearray()

    def records(self, more: bytes, last: bool = False) -> Iterator[tuple[dict[str, str], bytes]]:
        self.held += more
        at, held = 0, self.held
        while True:
            while held[at:at + 2] == b"\r\n":  # of a record that ends in more line breaks than it should
                at += 2
            end = held.find(_END, at)
            if end < 0:
                break
            head = _head(bytes(held[at:end]))
            if not held.startswith(b"WARC/", at) or not head.get("content-length", "").isdigit():
                raise ValueError(f"no WARC record in {self.path}")
            stop = end + 4 + int(head["content-length"])
            if len(held) < stop + (0 if last else 4):
                break
            yield head, bytes(held[at:stop]) + _END
            at = min(len(held), stop + 4)
        del held[:at]
        if last and held.strip():
            raise ValueError(f"{self.path} ends within a record")


def _member(record: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


_NOTHING = _member(b"", 6)


def _unended(volume: bytes) -> bytes:
    """A volume without its last byte, which the sink writes as its separator."""
    return volume[:-1] if volume[-1] == 0 else volume + _NOTHING[:-1]


def normalise(spark: SparkSession, source: str, path: str, volume_bytes: int = VOLUME_BYTES, level: int = 6) -> None:
    """Rewrite the gzip archives under ``source`` (each inflated once, as a stream) with a member per record.

    Volumes lie in ``path``/kind=warc/volume=NAME, their indexes (a gzip member of JSON lines: ordinal, offset,
    length, record_id, record_type) in kind=cdx/volume=NAME; both are written by the same tasks in the same job. A
    volume holds about ``volume_bytes``, a larger record has one of its own. A task holds one volume and one record.
    Files must be UTF-8 in their headers only; payloads may be any bytes. Empty archives give no volume.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    starts = F.when(F.col("value").startswith("WARC/"), F.col("_metadata.file_path"))  # the first line of a file at least
    lines = lines.select(F.col("value").cast("binary").alias("value"), starts.alias("path"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, volume, index, number, ordinal, size = None, [], [], 0, 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal volume, index, number, ordinal, size
            if volume:
                name = f"v{hashlib.md5(stream.path.encode()).hexdigest()}-{number:05d}"
                table = _member("".join(json.dumps(x) + "\n" for x in index).encode(), 6)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["warc", "cdx"]), pa.array([name] * 2),
                     pa.array([_unended(b"".join(volume)), _unended(table)], pa.binary())], ["kind", "volume", "body"])
                volume, index, number, ordinal, size = [], [], number + 1, 0, 0

        def add(records) -> Iterator[pa.RecordBatch]:
            nonlocal ordinal, size
            for head, record in records:
                member = _member(record, level)
                if size and size + len(member) > volume_bytes:
                    yield from out()
                index.append((ordinal, size, len(member), head.get("warc-record-id"), head.get("warc-type")))
                volume.append(member)
                size, ordinal = size + len(member), ordinal + 1

        def switch(to: str | None) -> Iterator[pa.RecordBatch]:
            nonlocal stream, number
            if stream:
                yield from add(stream.records(b"", last=True))
                yield from out()
            stream, number = to and _Stream(to), 0

        for batch in batches:
            values, paths = batch.column("value").to_pylist(), batch.column("path").to_pylist()
            i = 0
            while i < len(values):
                if stream is None or paths[i] not in (None, stream.path):
                    if paths[i] is None:
                        raise ValueError("an archive does not begin with a WARC record")
                    yield from switch(paths[i])
                j = i + 1
                while j < len(values) and paths[j] in (None, stream.path):
                    j += 1
                yield from add(stream.records(b"\n".join(values[i:j]) + b"\n"))
                i = j
        yield from switch(None)

    with sql_conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        bodies = lines.mapInArrow(rewrite, "kind string, volume string, body binary")
        bodies.select("kind", "volume", F.col("body").cast("string").alias("value")).write.partitionBy(
            "kind", "volume").option("lineSep", "\x00").text(path)


def _files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/kind={kind}").select("volume", "content")


def _has_volumes(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kind=warc")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar index of all volumes under ``path`` (columns ``INDEX``)."""
    if not _has_volumes(spark, path):
        return spark.createDataFrame([], INDEX)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for volume, body in zip(batch.column("volume").to_pylist(), batch.column("content"), strict=True):
                rows = [json.loads(x) for x in zlib.decompress(body.as_py(), 31).splitlines()]
                own = [[volume] * len(rows), *([r[k] for r in rows] for k in range(5))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(own, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()),
                                                    strict=True)], [f.split()[0] for f in INDEX.split(", ")])

    return _files(spark, path, "cdx").mapInArrow(parse, INDEX)


def _members(body: memoryview, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, inflated bytes) of each gzip member, fed in small steps so that nothing is copied twice."""
    at = 0
    while at < len(body):
        inflate, parts, pos = zlib.decompressobj(31), [], at
        while not inflate.eof:
            piece = body[pos:pos + step]
            if not len(piece):
                raise ValueError("a volume ends within a member")
            parts.append(inflate.decompress(piece))
            pos += len(piece)
        end = pos - len(inflate.unused_data)
        data = b"".join(parts)
        if data:
            yield at, end - at, data
        at = end


_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _described(volume: str, ordinal: int, offset: int, length: int, record: bytes, with_payload: bool) -> tuple:
    end = record.find(_END)
    head = _head(record[:end])
    block = record[end + 4:end + 4 + int(head["content-length"])]
    if head.get("content-type", "").startswith("application/http"):
        block = block[block.find(_END) + 4:]
    kind, said = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    digest, size, right = said, head.get("x-payload-length"), None
    if kind != "revisit":
        digest, size = base64.b32encode(hashlib.sha1(block).digest()).decode(), len(block)
        right = said is None or said == digest
    return (volume, ordinal, offset, length, head.get("warc-record-id"), kind, head.get("warc-target-uri"),
            head.get("warc-refers-to"), digest, None if size is None else int(size), right,
            block if with_payload and kind != "revisit" else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*(f.split() for f in RECORD.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(columns, types, strict=True)], list(names))


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of the volumes under ``path`` (columns ``RECORD``), in a task per few volumes.

    Digest and size of a response are taken from its payload (``digest_ok`` says if the record's own agrees); those
    of a revisit, which has no payload, from its fields. ``ordinal`` counts within the volume. ``payload`` is null
    without ``payloads``.
    """
    if not _has_volumes(spark, path):
        return spark.createDataFrame([], RECORD)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for volume, body in zip(batch.column("volume").to_pylist(), batch.column("content"), strict=True):
                rows, held = [], 0
                for ordinal, (at, length, record) in enumerate(_members(memoryview(body.as_buffer()))):
                    rows.append(_described(volume, ordinal, at, length, record, payloads))
                    held += len(record) * payloads
                    if len(rows) >= BATCH_ROWS or held > VOLUME_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return _files(spark, path, "warc").mapInArrow(parse, RECORD)


def fetch_records(spark: SparkSession, path: str, record_ids: DataFrame) -> DataFrame:
    """The records named in ``record_ids`` (record_id; repeated and null ones count once, or not at all), with payloads.

    The index says where they lie; of each volume that holds one, only their members are inflated.
    """
    wanted = read_index(spark, path).join(record_ids.select("record_id").where("record_id IS NOT NULL").distinct(), "record_id")
    per_volume = wanted.groupBy("volume").agg(F.collect_list(F.struct("ordinal", "offset", "length")).alias("places"))
    if not _has_volumes(spark, path):
        return spark.createDataFrame([], RECORD)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("volume", "content", "places"))
            for volume, body, places in zip(*columns, strict=True):
                raw = memoryview(body.as_buffer())
                yield _batch([_described(volume.as_py(), p["ordinal"], p["offset"], p["length"],
                                         zlib.decompress(raw[p["offset"]:p["offset"] + p["length"]], 31), True)
                              for p in sorted(places.as_py(), key=lambda p: p["offset"])])

    return _files(spark, path, "warc").join(per_volume, "volume").mapInArrow(cut, RECORD)
