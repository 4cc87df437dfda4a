"""An ordered scan of text files cut at special tokens, whatever splits Spark reads them in.

Files are read as records that end in a separator no special holds (a newline, unless a special has one), so a special
never crosses a record, and the text between two specials (a run) may cross any number of records and splits.

1. Bytes are summed per split, which gives each split its place in its file.
2. Each split is cut by itself: specials leftmost and longest first. Runs that lie within the split are finished. What
   comes before its first special and after its last one is open to the neighbouring splits.
3. The open stretches of neighbours are carried together: narrow rows per split say where the run that reaches into it
   began and where the one that leaves it ends, and the stretches of one run meet by its start.

A run of ``target`` bytes or more is cut after the first separator at or beyond each multiple of ``target`` in the file,
so pieces stay small where there are no specials, and the cuts do not depend on the splits. The separator that a
record ends in stays in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import specials_longest_first
from ..sinks.tables import materialize

SEPARATORS = ("\n", " ", "\t", "\r", "\x00")
TARGET_BYTES = 1 << 20
#: Splits whose places are broadcast to the records (about 150 bytes each); with more, records are shuffled by split.
BROADCAST_SPLITS = 500_000
#: Bytes of records that are joined at a time.
_STEP_BYTES = 4 << 20

PIECES = ("file string, split long, start long, text binary, open boolean, first boolean, run_start long, run_end long,"
          " ends_cut boolean")
_NAMES = [f.split()[0] for f in PIECES.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]


class SplitCutter:
    """Cuts one split, given as records that follow one another, into rows ``(start, text, open, first, run_start,
    run_end, ends_cut)``.

    ``run_start`` is null before the split's first special, ``run_end`` after its last one; a stretch with a null is
    open. Open stretches, and long runs, come in parts that end where a long run is cut (``ends_cut``). The stretch
    before the first special always has a row, with ``first`` set, and the one after the last too, if empty ones.
    """

    def __init__(self, start: int, specials: Sequence[bytes], separator: bytes, target: int):
        self.at, self.separator, self.target = start, separator, target
        self.pattern = re.compile(b"|".join(re.escape(s) for s in specials))
        self.run_start: int | None = None
        self.seen = (start - 1) // target  # the multiple of target that the last separator lies beyond; -1 at first
        self.parts: list[list] = [[start, [], False]]  # of the stretch: start, bytes, whether it ends in a cut
        self.first = True

    def add(self, data: bytes) -> Iterator[tuple]:
        at = 0
        for match in self.pattern.finditer(data):
            self._keep(data, at, match.start())
            yield from self._close(self.at + match.start())
            at = match.end()
            self.run_start = self.at + at
            self.parts = [[self.run_start, [], False]]
        self._keep(data, at, len(data))
        self.at += len(data)

    def finish(self) -> Iterator[tuple]:
        yield from self._close(None)

    def _keep(self, data: bytes, a: int, b: int) -> None:
        while a < b:
            due = max(a, (self.seen + 1) * self.target - self.at)
            cut = data.find(self.separator, due, b) if due < b else -1
            self.parts[-1][1].append(data[a:b if cut < 0 else cut + 1])
            if cut < 0:
                return
            a, self.seen = cut + 1, (self.at + cut) // self.target
            self.parts[-1][2] = True
            self.parts.append([self.at + a, [], False])

    def _close(self, run_end: int | None) -> Iterator[tuple]:
        parts = [(start, b"".join(data), cut) for start, data, cut in self.parts]
        if len(parts) > 1 and not parts[-1][1]:
            parts.pop()
        is_open = run_end is None or self.run_start is None
        if not is_open and run_end - self.run_start < self.target:
            parts = [(self.run_start, b"".join(text for _, text, _ in parts), False)]
        for start, text, cut in parts:
            if is_open or text:
                yield start, text, is_open, self.first, self.run_start, run_end, cut
            self.first = False


def _separator(specials: Sequence[str]) -> str:
    for separator in SEPARATORS:
        if not any(separator in s for s in specials):
            return separator
    raise ValueError("the special tokens hold every separator that files could be read by")


def _records(spark: SparkSession, path: str, separator: str) -> tuple[DataFrame, DataFrame]:
    """Records in order (value, file, block, split, ended), and (file, split, size) per split; ``split``: its start."""
    read = spark.read.option("lineSep", separator).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"))
    sizes = materialize(read.groupBy("file", "block").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("file_size").alias("file_size")), "splits")
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(upto), F.lit(0))
    places = sizes.select("file", "block", start.alias("split"), F.least(start + F.col("bytes"), "file_size").alias("ends"))
    if sizes.count() <= BROADCAST_SPLITS:
        return read.join(F.broadcast(places), ["file", "block"]), places  # keeps the order of records
    numbered = read.withColumn("n", F.monotonically_increasing_id())
    return numbered.join(places, ["file", "block"]).sortWithinPartitions("file", "block", "n"), places


def _pieces(records: DataFrame, specials: Sequence[str], separator: str, target: int) -> DataFrame:
    words, sep = [s.encode() for s in specials], separator.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, file, split, ends = None, None, None, 0
        rows: list[tuple] = []

        def keep(found: Iterator[tuple]) -> None:
            rows.extend((file, split, *r) for r in found)

        def feed(data: list[bytes]) -> None:
            keep(cutter.add(b"".join(data)[:ends - cutter.at]))  # a file's last record may lack the separator

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

        for batch in batches:
            values, held, size = batch.column("value"), [], 0
            files, splits, ending = (batch.column(c).to_pylist() for c in ("file", "split", "ends"))
            for i in range(len(batch)):
                if cutter is None or splits[i] != split or files[i] != file:
                    if cutter:
                        feed(held)
                        keep(cutter.finish())
                        held, size = [], 0
                    file, split, ends = files[i], splits[i], ending[i]
                    cutter = SplitCutter(split, words, sep, target)
                held += [values[i].as_py(), sep]
                size += len(held[-2])
                if size > _STEP_BYTES:
                    feed(held)
                    held, size = [], 0
                    if rows:
                        yield out()
            if cutter:
                feed(held)
            yield out()
        if cutter:
            keep(cutter.finish())
            yield out()

    return records.select("value", "file", "split", "ends").mapInArrow(cut, PIECES)


def scan_pieces(spark: SparkSession, path: str, specials: Sequence[str], target: int = TARGET_BYTES) -> DataFrame:
    """``(text, file, start)``: the texts between special tokens, in the order ``(file, start)`` (a byte offset).

    The same whatever ``spark.sql.files.maxPartitionBytes`` is. Specials and empty texts are dropped; runs of ``target``
    bytes or more come in pieces (see the module). Texts are byte-exact; files must not be compressed, as a last record
    without a separator shows in the file's size. Open stretches are shuffled, everything else stays where it is read.
    """
    ordered = specials_longest_first(specials)
    if not ordered:
        raise ValueError("no special tokens; scan_lines reads lines")
    separator = _separator(ordered)
    records, places = _records(spark, path, separator)
    pieces = _pieces(records, ordered, separator, target)
    whole = pieces.where("not open").select("text", "file", "start")
    parts = materialize(pieces.where("open"), "open-stretches")

    last = F.max_by(F.struct("start", "first", "ends_cut", "run_start", F.octet_length("text").alias("n")),
                    F.struct("start", F.octet_length("text"))).alias("last")
    splits = parts.groupBy("file", "split").agg(
        F.min(F.when(F.col("run_start").isNull(), F.col("run_end"))).alias("lead_end"),
        F.max(F.when(F.col("run_end").isNull(), F.col("run_start"))).alias("trail_start"), last)
    # where the piece that is open at the split's end begins; null: where the one that reached into it did
    opened = F.when(F.col("last.ends_cut"), F.col("last.start") + F.col("last.n")).when(
        ~F.col("last.first") | F.col("last.run_start").isNotNull(), F.col("last.start"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy("split").rowsBetween(1, Window.unboundedFollowing)
    end = places.groupBy("file").agg(F.max("ends").alias("file_end"))
    known = splits.join(end, "file").select(
        "file", "split", F.coalesce(F.last("trail_start", True).over(before), F.lit(0)).alias("run_in"),
        F.coalesce(F.first("lead_end", True).over(after), "file_end").alias("run_out"),
        F.coalesce(F.last(opened, True).over(before), F.lit(0)).alias("piece_in"))
    run = F.coalesce("run_start", "run_in")
    is_long = F.coalesce("run_end", "run_out") - run >= target
    piece = F.when(~is_long, run).when(F.col("first"), F.col("piece_in")).otherwise(F.col("start"))
    carried = parts.join(known, ["file", "split"]).groupBy("file", piece.alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("start", F.col("text").cast("string").alias("t")))).alias("found"))
    joined = carried.select(F.array_join(F.transform("found", lambda x: x["t"]), "").alias("text"), "file",
                            F.col("piece").alias("start"))
    return whole.select(F.col("text").cast("string").alias("text"), "file", "start").unionByName(
        joined.where("octet_length(text) > 0"))


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(text, file, line_start, split)``: every line with its byte offset, as it is read; see ``text.scan_lines``."""
    return placed_bytes(spark, path).withColumn("text", F.col("text").cast("string"))


def placed_bytes(spark: SparkSession, path: str) -> DataFrame:
    """All bytes of files of any kind as rows ``(text, file, line_start, split)`` that end at newline bytes, with their
    offsets; in order within a split."""
    records, _ = _records(spark, path, "\n")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at = None, 0
        for batch in batches:
            values, files, splits, ends = (batch.column(c).to_pylist() for c in ("value", "file", "split", "ends"))
            texts, starts = [], []
            for value, file, split, end in zip(values, files, splits, ends, strict=True):
                if key != (file, split):
                    key, at = (file, split), split
                line = value + b"\n"
                starts.append(at)
                texts.append(line[:end - at])  # the file may end before the newline
                at += len(line)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch.column("file"), pa.array(starts, pa.int64()),
                                              batch.column("split")], ["text", "file", "line_start", "split"])

    return records.select("value", "file", "split", "ends").mapInArrow(
        place, "text binary, file string, line_start long, split long")
