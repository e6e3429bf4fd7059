"""Listing of a folder tree by the executors, and reading of files by location."""

import io
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracemill.functions import paths
from tracemill.operators.distribute import spread_by_bytes
from tracemill.schemas import DIRECTORY, FILE
from tracemill.session import spool

LISTED = "uri STRING, entry_type STRING, length BIGINT, mtime TIMESTAMP_NTZ"

# Folders one task lists, and rows or bytes one batch holds.
TASK_FOLDERS = 4096
FLUSH_ROWS = 5000
FLUSH_BYTES = 32 << 20
TASK_BYTES = 256 << 20
# What opening a file costs, in bytes that could be read meanwhile.
OPEN_BYTES = 64 << 10
# Files or folders for which a task of their own is worth its start, while cores are free.
MIN_TASK = 64
# Tasks up to which the borders between them are part of the plan; for more, files are joined to their task.
PLANNED_TASKS = 64


def paths_from_uri(uri: Column) -> Column:
    """The path inside the storage, without scheme and authority."""
    return F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


# Behind a file's name, the folder that holds it in parts, written by many tasks.
JOINED = "%joined%"


def parts_of(filesystem: fs.FileSystem, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the parts of a file, whose names are numbers, in order."""
    found = filesystem.get_file_info(fs.FileSelector(folder))
    return [(i.path, i.size) for i in sorted(found, key=lambda i: i.base_name) if i.base_name.isdigit()]


class JoinedFile(io.RawIOBase):
    """A file that lies in parts, read as one."""

    def __init__(self, filesystem: fs.FileSystem, parts: list[tuple[str, int]]):
        self._filesystem, self._parts = filesystem, parts
        self._starts = list(accumulate((size for _, size in parts), initial=0))
        self._at, self._open = 0, (None, None)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._at = max(0, offset + {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: self._starts[-1]}[whence])
        return self._at

    def readinto(self, into) -> int:
        if self._at >= self._starts[-1]:
            return 0
        k = bisect_right(self._starts, self._at) - 1
        if self._open[0] != k:
            self._open = k, self._filesystem.open_input_file(self._parts[k][0])
        raw = self._open[1]
        raw.seek(self._at - self._starts[k])
        data = raw.read(min(len(into), self._starts[k + 1] - self._at))
        into[: len(data)] = data
        self._at += len(data)
        return len(data)


def open_uri(uri: str) -> BinaryIO:
    filesystem, path = locate(uri)
    try:
        return filesystem.open_input_file(path)
    except FileNotFoundError:
        if filesystem.get_file_info(path + JOINED).type != fs.FileType.Directory:
            raise
        return io.BufferedReader(JoinedFile(filesystem, parts_of(filesystem, path + JOINED)), 1 << 20)


def exists(uri: str) -> bool:
    filesystem, path = locate(uri)
    return any(i.type != fs.FileType.NotFound for i in filesystem.get_file_info([path, path + JOINED]))


@dataclass
class _Joined:
    """What a listing tells of a file that lies in parts."""

    base_name: str
    size: int
    mtime_ns: int | None
    type: fs.FileType = fs.FileType.File


def _as_one(filesystem: fs.FileSystem, info: fs.FileInfo):
    if info.type != fs.FileType.Directory or not info.base_name.endswith(JOINED):
        return info
    size = sum(n for _, n in parts_of(filesystem, info.path))
    return _Joined(info.base_name.removesuffix(JOINED), size, info.mtime_ns)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {fs.FileType.File: FILE, fs.FileType.Directory: DIRECTORY}
    types = {"uri": pa.string(), "entry_type": pa.string(), "length": pa.int64(), "mtime": pa.timestamp("us")}

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))

    rows = []
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            filesystem, path = locate(uri)
            for info in filesystem.get_file_info(fs.FileSelector(path)):
                info = _as_one(filesystem, info)
                if info.type not in kinds:
                    continue
                changed = None if info.mtime_ns is None else info.mtime_ns // 1000
                rows.append((f"{uri.rstrip('/')}/{info.base_name}", kinds[info.type], info.size, changed))
                # Entries of many folders share a batch.
                if len(rows) >= FLUSH_ROWS:
                    yield to_batch(rows)
                    rows = []
    if rows:
        yield to_batch(rows)


def plain_root(root: str) -> str:
    """A folder's location with each name once: no doubled or closing slash, no `.` steps."""
    scheme = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", root)
    head = scheme[0] if scheme else ""
    steps = [s for s in root[len(head) :].split("/") if s not in ("", ".")]
    return f"{head}/{'/'.join(steps)}" if root[len(head) :].startswith("/") else head + "/".join(steps)


def list_entries(spark: SparkSession, root: str) -> DataFrame:
    """Every file and folder below `root`, empty and hidden ones included.

    The tree is listed level by level, each folder by a task, so no list of
    files passes the driver.
    """
    levels = []
    folders = spark.createDataFrame([(plain_root(root),)], "uri STRING")
    count = 1
    while count:
        tasks = max(-(-count // TASK_FOLDERS), min(-(-count // MIN_TASK), spark.sparkContext.defaultParallelism))
        level = spool(folders.repartition(tasks).mapInArrow(_list, LISTED), "listing", ("entry_type",))
        levels.append(level)
        folders = level.where(F.col("entry_type") == DIRECTORY).select("uri")
        count = folders.count()
    path = paths_from_uri(F.col("uri"))
    return reduce(DataFrame.unionByName, levels).select(
        "uri", path.alias("path"), paths.basename(path).alias("name"), paths.parent_dir(path).alias("parent"),
        "entry_type", "length", "mtime",
    )


def task_count(spark: SparkSession, size: int | None, n: int, task_bytes: int | None = None) -> int:
    """Tasks to read `size` bytes at `n` places: as many as both call for, and where there is work for them, all cores."""
    least = min(-(-n // MIN_TASK), spark.sparkContext.defaultParallelism)
    return max(1, min(n, max(least, -(-((size or 0) + OPEN_BYTES * n) // (task_bytes or TASK_BYTES)))))


def _whole(raw: BinaryIO) -> bytes:
    return raw.read()


def _parts(ranges: list[tuple[int, int]]):
    """The bytes at each `(offset, size)`, a negative offset counted from the end; none where the file is too short."""

    def read(raw: BinaryIO) -> list[bytes | None]:
        size, out = raw.seek(0, 2), []
        for offset, n in ranges:
            at = offset if offset >= 0 else size + offset
            if at < 0 or at + n > size:
                out.append(None)
                continue
            raw.seek(at)
            out.append(raw.read(n))
        return out

    return read


def _read(part, kind: pa.DataType, skip_unreadable: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch, picked, contents):
            return batch.take(pa.array(picked, pa.int64())).append_column("content", pa.array(contents, kind))

        for batch in batches:
            picked, contents, size = [], [], 0
            for i, uri in enumerate(batch.column("uri").to_pylist()):
                try:
                    with open_uri(uri) as raw:
                        content = part(raw)
                except OSError:
                    if not skip_unreadable:
                        raise
                    content = None
                # A batch is sent before a row that would make it too long.
                if picked and size + len(content or b"") > FLUSH_BYTES:
                    yield packed(batch, picked, contents)
                    picked, contents, size = [], [], 0
                picked.append(i)
                contents.append(content)
                size += len(content or b"")
            if picked:
                yield packed(batch, picked, contents)

    return run


def read_contents(listed: DataFrame, skip_unreadable: bool = False, tasks: int | None = None) -> DataFrame:
    """Files of a listing with their content, read by as many tasks as their bytes and their number call for.

    Only the listing is dealt out, so no content moves between executors. With
    `skip_unreadable`, a file that can't be read has a null content.
    """
    return _reading(listed, _whole, pa.binary(), "BINARY", skip_unreadable, "length", tasks)


def read_parts(listed: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Files of a listing with the bytes at each range as an array, `content`."""
    size = str(sum(n for _, n in ranges))
    return _reading(listed, _parts(ranges), pa.list_(pa.binary()), "ARRAY<BINARY>", False, size, None)


def _reading(listed: DataFrame, part, kind: pa.DataType, sql: str, skip_unreadable: bool, size: str, tasks: int | None) -> DataFrame:
    if tasks is None:
        total = listed.agg(F.expr(f"sum({size})").alias("bytes"), F.count("*").alias("n")).first()
        tasks = task_count(listed.sparkSession, total["bytes"], total["n"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listed.schema)
    # Files are packed into tasks of even bytes, an opening counted as some of them.
    weighed = listed.withColumn("_cost", F.expr(f"coalesce({size}, 0)") + OPEN_BYTES)
    dealt = spread_by_bytes(weighed, tasks, "_cost", "uri", PLANNED_TASKS).drop("bucket") if tasks > 1 else weighed.repartition(1)
    return dealt.drop("_cost").mapInArrow(_read(part, kind, skip_unreadable), f"{schema}, content {sql}")
