"""Lines of files too long to be one row, numbered from the start of each file."""

from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tracemill.session import spool
from tracemill.sources.files import list_files
from tracemill.sources.listing import open_uri, task_count

# Bytes of a file one task reads, of one read, and of one batch of lines.
SPLIT_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
FLUSH_BYTES = 16 << 20
FLUSH_ROWS = 20_000

END = b"\n"

FILE_COLUMNS = ("path", "name", "length", "mtime")
FILE_SCHEMA = "path STRING, name STRING, length BIGINT, mtime TIMESTAMP_NTZ"


def _chunks(raw: BinaryIO, start: int) -> Iterator[bytes]:
    raw.seek(start)
    while chunk := raw.read(CHUNK_BYTES):
        yield chunk


def split_lines(raw: BinaryIO, start: int, stop: int) -> Iterator[bytes]:
    """The lines that begin at `start` or later and before `stop`, without their ends.

    A line begins at 0 and behind each line end. Nothing but a line feed ends
    a line, and what follows the last one is a line if it isn't empty.
    """
    # The byte before decides whether a line begins at `start`.
    begin, line = start, [] if start == 0 else None
    at = max(0, start - 1)
    for chunk in _chunks(raw, at):
        pieces = chunk.split(END)
        if line is None:
            # The line begun before `start` ends with the first line end from there on.
            if len(pieces) == 1:
                at += len(chunk)
                continue
            begin, line = at + len(pieces.pop(0)) + 1, []
        # A long line is kept in its pieces and joined once.
        *ended, rest = pieces
        for piece in ended:
            if begin >= stop:
                return
            line.append(piece)
            whole = b"".join(line)
            yield whole
            begin, line = begin + len(whole) + 1, []
        if begin >= stop:
            return
        if rest:
            line.append(rest)
    if line and begin < stop:
        yield b"".join(line)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line ends in each split: one raw read without cutting."""
    for batch in batches:
        ends = []
        for uri, start, stop in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "stop"))):
            n, left = 0, stop - start
            with open_uri(uri) as raw:
                for chunk in _chunks(raw, start):
                    n += chunk[:left].count(END)
                    left -= len(chunk)
                    if left <= 0:
                        break
            ends.append(n)
        yield batch.append_column("ends", pa.array(ends, pa.int64()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(batch, owners, numbers, lines):
        files = batch.select(FILE_COLUMNS).take(pa.array(owners, pa.int64()))
        return files.append_column("seq", pa.array(numbers, pa.int64())).append_column("line", pa.array(lines, pa.binary()))

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "stop", "first")))
        # Lines of many short splits share a batch.
        owners, numbers, lines, size = [], [], [], 0
        for k, (uri, start, stop, first) in enumerate(rows):
            with open_uri(uri) as raw:
                for number, line in enumerate(split_lines(raw, start, stop), first):
                    if lines and (size + len(line) > FLUSH_BYTES or len(lines) >= FLUSH_ROWS):
                        yield packed(batch, owners, numbers, lines)
                        owners, numbers, lines, size = [], [], [], 0
                    owners.append(k)
                    numbers.append(number)
                    lines.append(line)
                    size += len(line)
        if lines:
            yield packed(batch, owners, numbers, lines)


def read_lines(listed: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """Lines `(path, name, length, mtime, seq, line)` of listed files, `line` being bytes.

    One file is read by many tasks, and many short ones by one. Line ends of a
    file of several splits are counted per split first, one row each, so a split
    knows the number of its first line before it is cut and no line is ever
    joined or moved. Names and content are taken as they are: no suffix means a
    codec, no byte a character.
    """
    split_bytes = split_bytes or SPLIT_BYTES
    columns = ["uri", *FILE_COLUMNS, "start", "stop"]
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint")))
    splits = listed.where("length > 0").select("uri", *FILE_COLUMNS, start.alias("start"))
    splits = splits.withColumn("stop", F.least(F.col("length"), F.col("start") + split_bytes))
    splits = spool(splits.withColumn("several", F.col("length") > split_bytes), "splits", ("several",))
    numbered = splits.where("NOT several").select(*columns, F.lit(0).cast("bigint").alias("line_ends"))
    long = splits.where("several").select(*columns)
    if not long.isEmpty():
        counted = long.repartition(tasks_for(long)).mapInArrow(_count, f"uri STRING, {FILE_SCHEMA}, start BIGINT, stop BIGINT, ends BIGINT")
        before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        # A split whose start isn't the start of a line begins with the next one.
        ends = F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("line_ends")
        numbered = numbered.unionByName(spool(counted.select(*columns, ends), "numbered-splits"))
    return numbered.repartition(tasks_for(splits)).mapInArrow(_cut_from_ends, f"{FILE_SCHEMA}, seq BIGINT, line BINARY")


def tasks_for(splits: DataFrame) -> int:
    """As many tasks as the splits' bytes and their number call for."""
    total = splits.agg(F.expr("sum(stop - start)").alias("bytes"), F.count("*").alias("n")).first()
    return task_count(splits.sparkSession, total["bytes"], total["n"])


def _cut_from_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that begins in a split has as many ends before it as the file has up to its begin."""

    def first_numbers(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers = []
        for uri, start, ends in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "line_ends"))):
            if start:
                with open_uri(uri) as raw:
                    raw.seek(start - 1)
                    # Mid-line, the line that was begun before is ended by the split's first end.
                    ends += raw.read(1) != END
            numbers.append(ends)
        return batch.append_column("first", pa.array(numbers, pa.int64()))

    yield from _cut(map(first_numbers, batches))


def scan_lines(spark: SparkSession, root: str, min_bytes: int) -> DataFrame:
    """Lines of the files under `root` longer than `min_bytes`."""
    return read_lines(list_files(spark, root, min_bytes))
