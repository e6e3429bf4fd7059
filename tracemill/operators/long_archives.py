"""Packed files too long to be held in one row, opened in place.

An index of each archive is made first: where its members lie. Members are
then spread over the cluster and read by range, so one archive of any size is
read by many tasks and no packed bytes are shuffled. So are bzip2 and xz streams,
by runs of their blocks, each written as a part of the one file that comes out.
What can be read from its start alone stays with one task: gzip streams, xz
streams of one block, and tar archives inside of streams.
"""

import bz2
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tracemill.functions import paths
from tracemill.operators.blocks import bzip2_run, find_marks, xz_block, xz_blocks
from tracemill.operators.codecs import CHUNK, TAR_BLOCK, Limits, Long, _safe, _stream, bounded, free_name, is_tar, open_stream
from tracemill.operators.ingest import (
    FLUSH_BYTES, FLUSH_ROWS, PACKED_SIGNATURES, PLAIN, STREAMS, member_folder, store_member, unpacked_batch,
)
from tracemill.schemas import UNPACKED
from tracemill.session import spool
from tracemill.sources.listing import JOINED, locate, open_uri, task_count

# Bytes of packed members one task reads.
TASK_BYTES = 256 << 20
# Streams longer than the first are read in runs of blocks of the second, in packed bytes.
SPLIT_STREAM_BYTES, RUN_BYTES = 256 << 20, 32 << 20

# What is known of the packed file, then where a member of it lies.
_ABOUT = {
    "uri": pa.string(), "path": pa.string(), "name": pa.string(), "folder": pa.string(), "stem": pa.string(),
    "depth": pa.int32(), "mtime": pa.timestamp("us"),
}
_PLACE = {
    "kind": pa.string(), "member": pa.string(), "start": pa.int64(), "packed": pa.int64(), "size": pa.int64(),
    "method": pa.int32(), "crc": pa.int64(), "warning": pa.string(),
}
INDEX = (
    "uri STRING, path STRING, name STRING, folder STRING, stem STRING, depth INT, mtime TIMESTAMP_NTZ, "
    "kind STRING, member STRING, start BIGINT, packed BIGINT, size BIGINT, method INT, crc BIGINT, warning STRING"
)

# Compression methods and the local header of the zip format.
STORED, DEFLATED, BZIP2 = 0, 8, 12
LOCAL_HEADER_BYTES = 30
NAME_LENGTH_AT, EXTRA_LENGTH_AT = 26, 28
# The records at the end of a zip file and their lengths.
END_RECORD, END_RECORD_64, LOCATOR_64, ENTRY = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2"
END_BYTES, END_64_BYTES, LOCATOR_BYTES, ENTRY_BYTES, MAX_COMMENT = 22, 56, 20, 46, 0xFFFF


def _kind(raw: BinaryIO) -> str:
    raw.seek(0)
    head = raw.read(512)
    for kind, (offset, magic) in PACKED_SIGNATURES.items():
        if head[offset : offset + len(magic)] == magic:
            return kind
    return PLAIN


def zip_directory(raw: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple[str, int, int, int, int, int, int]]:
    """(name, flags, method, crc, packed, size, header offset) of each member, read from the directory as it goes.

    However many members there are, only a chunk of the directory is held.
    """
    length = raw.seek(0, 2)
    tail_at = max(0, length - END_BYTES - MAX_COMMENT)
    raw.seek(tail_at)
    tail = raw.read()
    at = tail.rfind(END_RECORD)
    if at < 0:
        raise zipfile.BadZipFile("no end of the directory")
    size, offset = struct.unpack_from("<LL", tail, at + 12)
    end = tail_at + at
    if at >= LOCATOR_BYTES and tail[at - LOCATOR_BYTES : at - LOCATOR_BYTES + 4] == LOCATOR_64:
        raw.seek(end - LOCATOR_BYTES - END_64_BYTES)
        record = raw.read(END_64_BYTES)
        if record[:4] == END_RECORD_64:
            size, offset = struct.unpack_from("<QQ", record, 40)
            end -= LOCATOR_BYTES + END_64_BYTES
    # What stands before the archive in its file shifts all offsets.
    shift = end - size - offset
    if shift < 0:
        raise zipfile.BadZipFile("directory lies outside of the file")
    raw.seek(end - size)
    held, at, left = b"", 0, size

    def need(n: int) -> None:
        nonlocal held, at, left
        while len(held) - at < n:
            more = raw.read(min(chunk, left))
            if not more:
                raise zipfile.BadZipFile("directory is cut off")
            held, at, left = held[at:] + more, 0, left - len(more)

    while left or at < len(held):
        need(ENTRY_BYTES)
        if held[at : at + 4] != ENTRY:
            raise zipfile.BadZipFile("no entry where one should be")
        flags, method = struct.unpack_from("<HH", held, at + 8)
        crc, packed, length, n_name, n_extra, n_comment = struct.unpack_from("<LLLHHH", held, at + 16)
        (header,) = struct.unpack_from("<L", held, at + 42)
        need(ENTRY_BYTES + n_name + n_extra + n_comment)
        name = held[at + ENTRY_BYTES : at + ENTRY_BYTES + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = held[at + ENTRY_BYTES + n_name : at + ENTRY_BYTES + n_name + n_extra]
        at += ENTRY_BYTES + n_name + n_extra + n_comment
        # Numbers too large for their field stand in an extra field, in this order.
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                length, packed, header = (next(wide) if x == 0xFFFFFFFF else x for x in (length, packed, header))
            extra = extra[4 + n :]
        yield name, flags, method, crc, packed, length, header + shift


def _index_zip(raw: BinaryIO) -> Iterator[tuple]:
    for name, flags, method, crc, packed, size, offset in zip_directory(raw):
        if name.endswith("/"):
            continue
        problem = None
        if not _safe(name):
            problem = f"unsafe member name {name!r}"
        elif flags & 1 or method not in (STORED, DEFLATED, BZIP2):
            problem = f"unreadable member {name!r}: encrypted or unknown compression"
        yield name, offset, packed, size, method, crc, problem


def _index_tar(raw: BinaryIO) -> Iterator[tuple]:
    raw.seek(0)
    with tarfile.open(fileobj=raw, mode="r:") as archive:
        for info in archive:
            # The reader keeps every header it has passed; only the current one is needed.
            archive.members.clear()
            if info.isdir():
                continue
            problem = None
            if not info.isfile():
                problem = f"member {info.name!r} is not a regular file"
            elif not _safe(info.name):
                problem = f"unsafe member name {info.name!r}"
            yield info.name, info.offset_data, info.size, info.size, None, None, problem


def _places(uri: str, length: int) -> Iterator[tuple]:
    """Where the parts of a file lie: one entry per member, or one for the whole file."""
    kind = None
    try:
        with open_uri(uri) as raw:
            kind = _kind(raw)
            if kind in ("zip", "tar"):
                for entry in _index_zip(raw) if kind == "zip" else _index_tar(raw):
                    yield kind, *entry
            else:
                problem = "longer than a row and not packed: left in place" if kind == PLAIN else None
                yield kind, None, 0, length, None, None, None, problem
    except Exception as exc:
        yield kind, None, None, None, None, None, None, f"damaged file: {exc or type(exc).__name__}"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {**_ABOUT, **_PLACE}

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))

    rows = []
    for batch in batches:
        for file in batch.to_pylist():
            about = [file[c] for c in _ABOUT]
            for place in _places(file["uri"], file["length"]):
                rows.append((*about, *place))
                if len(rows) >= FLUSH_ROWS:
                    yield to_batch(rows)
                    rows = []
    if rows:
        yield to_batch(rows)


def _chunks(raw: BinaryIO, kind: str, start: int, packed: int, size: int, method: int, crc: int) -> Iterator[bytes]:
    """A member's content, checked at the end against what the archive says of it."""
    raw.seek(start)
    if kind == "zip":
        header = raw.read(LOCAL_HEADER_BYTES)
        skip = sum(int.from_bytes(header[at : at + 2], "little") for at in (NAME_LENGTH_AT, EXTRA_LENGTH_AT))
        raw.seek(start + LOCAL_HEADER_BYTES + skip)
    opener = {DEFLATED: lambda: zlib.decompressobj(-zlib.MAX_WBITS), BZIP2: bz2.BZ2Decompressor}.get(method)
    opened = opener() if opener else None
    left, length, check = packed, 0, 0
    while left and (chunk := raw.read(min(left, CHUNK))):
        left -= len(chunk)
        if opened:
            chunk = opened.decompress(chunk)
        length += len(chunk)
        if length > size:
            break
        check = zlib.crc32(chunk, check)
        yield chunk
    if length != size or (crc is not None and check != crc):
        raise ValueError("content does not match the archive's record of it")


def _read_members(limits: Limits):
    def outcomes(raw, row):
        kind, member, size, packed = row["kind"], row["member"], row["size"], row["packed"]
        if kind in STREAMS:
            yield from open_stream(kind, raw, packed, limits)
            return
        place = [row[c] for c in ("kind", "start", "packed", "size", "method", "crc")]
        chunks = bounded(_chunks(raw, *place), packed, limits)
        yield member, Long(chunks) if size > limits.row_bytes else b"".join(chunks), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, opened, raw = [], 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                kept, taken = [row["warning"]] if row["warning"] else [], set()
                if not kept:
                    try:
                        if opened != row["uri"]:
                            opened, raw = row["uri"], open_uri(row["uri"])
                        raw.seek(0)
                        for member, data, warning in outcomes(raw, row):
                            if warning is not None:
                                kept.append(warning)
                                continue
                            target = f"{row['folder']}/{member or row['stem']}{row['again']}"
                            target = free_name(target, taken)
                            try:
                                data, length = store_member(target, data, limits)
                            except Exception as exc:
                                kept.append(f"unreadable member {member or row['name']!r}: {exc or type(exc).__name__}")
                                continue
                            name = target.rsplit("/", 1)[-1]
                            origin = (row["path"], row["depth"] + 1, row["mtime"])
                            if rows and (size + len(data or b"") > FLUSH_BYTES or len(rows) >= FLUSH_ROWS):
                                yield unpacked_batch(rows)
                                rows, size = [], 0
                            rows.append((target, name, *origin, data, length, False, None, None))
                            size += len(data or b"")
                    except Exception as exc:
                        opened = None
                        kept.append(f"unreadable member {row['member'] or row['name']!r}: {exc or type(exc).__name__}")
                if kept:
                    rows.append((row["path"], row["name"], None, row["depth"], row["mtime"], None, None, True, "; ".join(kept), None))
        if rows:
            yield unpacked_batch(rows)

    return run


def _splittable(min_bytes: int):
    """Which streams of an index are read in runs: long ones of blocks that don't hold a tar archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for row in batch.select(["uri", "kind", "packed", "warning"]).to_pylist():
                flag = row["kind"] in ("bzip2", "xz") and (row["packed"] or 0) > min_bytes and row["warning"] is None
                try:
                    with open_uri(row["uri"]) as raw:
                        flag = flag and not is_tar(_stream(row["kind"], raw).read(TAR_BLOCK))
                        flag = flag and (row["kind"] == "bzip2" or len(xz_blocks(raw, row["packed"])) > 1)
                except Exception:
                    # Damage is reported where the stream is read from its start.
                    flag = False
                flags.append(flag)
            yield batch.append_column("split", pa.array(flags, pa.bool_()))

    return run


_FILE = [c for c in _ABOUT]
_FILE_SQL = INDEX.split(", kind STRING")[0]


def _bzip2_blocks(streams: DataFrame, run_bytes: int) -> DataFrame:
    """Blocks of bzip2 files, `(begin, ends)` in bits: every mark is found by the task whose bytes it begins in."""
    size = F.lit(run_bytes).cast("bigint")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("packed") - 1, size)).alias("start")
    splits = spool(streams.select(*_FILE, "packed", start), "stream-splits")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for k, (uri, start, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "packed")))):
                with open_uri(uri) as raw:
                    marks += [(k, p, b) for p, b in find_marks(raw, start, min(packed, start + run_bytes))]
                if len(marks) >= FLUSH_ROWS:
                    yield to_batch(batch, marks)
                    marks = []
            if marks:
                yield to_batch(batch, marks)

    def to_batch(batch: pa.RecordBatch, marks: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        rows, begins, blocks = zip(*marks)
        own = batch.select(_FILE).take(pa.array(rows, pa.int64())).append_column("begin", pa.array(begins, pa.int64()))
        return own.append_column("block", pa.array(blocks, pa.bool_()))

    n = splits.count()
    tasks = task_count(splits.sparkSession, n * run_bytes, n, RUN_BYTES)
    found = splits.repartition(tasks).mapInArrow(find, f"{_FILE_SQL}, begin BIGINT, block BOOLEAN")
    order = Window.partitionBy("path").orderBy("begin")
    # Behind a block's own end come later ones, for marks that are there by chance.
    ends = F.array_compact(F.array(*[F.lead("begin", k).over(order) for k in range(1, 5)])).alias("ends")
    return found.select(*_FILE, "begin", ends, "block").where("block").drop("block")


def _xz_blocks(streams: DataFrame, run_bytes: int) -> DataFrame:
    """Blocks of xz files in the same columns: `begin` in bits, and in `ends` the stream's start, and the block's sizes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (uri, packed) in enumerate(zip(batch.column("uri").to_pylist(), batch.column("packed").to_pylist())):
                with open_uri(uri) as raw:
                    blocks = xz_blocks(raw, packed)
                own = batch.select(_FILE).take(pa.array([k] * len(blocks), pa.int64()))
                own = own.append_column("begin", pa.array([at * 8 for _, at, _, _ in blocks], pa.int64()))
                yield own.append_column("ends", pa.array([[s, u, c] for s, _, u, c in blocks], pa.list_(pa.int64())))

    tasks = task_count(streams.sparkSession, 0, streams.count())
    return streams.select(*_FILE, "packed").repartition(tasks).mapInArrow(find, f"{_FILE_SQL}, begin BIGINT, ends ARRAY<BIGINT>")


def _read_runs(limits: Limits):
    """Each run of blocks written as a part of its file, named by its number; one row says how long it is."""

    def contents(raw: BinaryIO, row: dict) -> Iterator[bytes]:
        if row["kind"] == "bzip2":
            begins = [b["begin"] for b in row["blocks"]]
            # The end of each block, and behind them those a chance mark at the run's end would need.
            ends = [b["ends"][0] if b["ends"] else row["length"] * 8 for b in row["blocks"]] + row["blocks"][-1]["ends"][1:]
            yield from bzip2_run(raw, begins, ends)
        else:
            for b in row["blocks"]:
                yield xz_block(raw, b["ends"][0], b["begin"] // 8, *b["ends"][1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            rows = batch.to_pylist()
            lengths, warnings = [], []
            for row in rows:
                length, warning = 0, None
                filesystem, folder = locate(f"{limits.spill.rstrip('/')}{row['folder']}/{row['stem']}{JOINED}")
                part = f"{folder}/{row['run']:020d}"
                try:
                    filesystem.create_dir(folder, recursive=True)
                    with open_uri(row["uri"]) as raw, filesystem.open_output_stream(f"{part}.{attempt}", compression=None) as out:
                        for chunk in bounded(contents(raw, row), row["packed"], limits):
                            out.write(chunk)
                            length += len(chunk)
                    filesystem.move(f"{part}.{attempt}", part)
                except Exception as exc:
                    if filesystem.get_file_info(f"{part}.{attempt}").is_file:
                        filesystem.delete_file(f"{part}.{attempt}")
                    warning = f"damaged {row['kind']} file: {exc or type(exc).__name__}"
                lengths.append(length)
                warnings.append(warning)
            batch = batch.select([*_FILE, "run"]).append_column("bytes", pa.array(lengths, pa.int64()))
            yield batch.append_column("warning", pa.array(warnings, pa.string()))

    return run


def _whole(limits: Limits):
    """The rows of files put together from runs; one that fits a row is read into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                target, data = f"{row['folder']}/{row['stem']}", None
                if row["warning"] is not None:
                    yield unpacked_batch([(row["path"], row["name"], None, row["depth"], row["mtime"], None, None, True, row["warning"], None)])
                    continue
                if row["bytes"] <= limits.row_bytes:
                    with open_uri(limits.spill.rstrip("/") + target) as raw:
                        data = raw.read()
                origin = (row["path"], row["depth"] + 1, row["mtime"])
                yield unpacked_batch([(target, row["stem"], *origin, data, row["bytes"], False, None, None)])

    return run


def unpack_streams(streams: DataFrame, limits: Limits, run_bytes: int) -> DataFrame:
    """Long streams of blocks, each read by many tasks, into one file each below the spill folder."""
    streams = spool(streams, "streams")
    blocks = None
    for kind, find in (("bzip2", _bzip2_blocks), ("xz", _xz_blocks)):
        found = find(streams.where(F.col("kind") == kind), run_bytes).withColumn("kind", F.lit(kind))
        blocks = found if blocks is None else blocks.unionByName(found)
    blocks = blocks.withColumn("run", F.floor(F.col("begin") / (8 * run_bytes)).cast("bigint"))
    in_order = F.array_sort(F.collect_list(F.struct("begin", "ends"))).alias("blocks")
    runs = blocks.groupBy(*_FILE, "kind", "run").agg(in_order)
    # A run without the begin of a block has none; what a run packs is near its share of the file.
    length = streams.select("path", F.col("packed").alias("length"))
    runs = spool(runs.join(length, "path").withColumn("packed", F.lit(2 * run_bytes).cast("bigint")), "runs")
    # Short runs share a task; a task's packed bytes are near those of one long run.
    spark, n = streams.sparkSession, runs.count()
    tasks = task_count(spark, n * run_bytes, n, RUN_BYTES)
    done = spool(runs.repartition(tasks).mapInArrow(_read_runs(limits), f"{_FILE_SQL}, run BIGINT, bytes BIGINT, warning STRING"), "runs-done")
    files = done.repartition(task_count(spark, 0, streams.count()), "path").groupBy(*_FILE).agg(F.sum("bytes").alias("bytes"), F.min("warning").alias("warning"))
    return files.mapInArrow(_whole(limits), UNPACKED)


def unpack_long(
    listing: DataFrame, limits: Limits = Limits(), min_bytes: int | None = None, run_bytes: int | None = None
) -> DataFrame:
    """One unpack round over files in place: `uri, path, name, depth, mtime, length`.

    Streams of more than `min_bytes` are read in runs of `run_bytes`.

    Gives one row per member, and for each file or member that could not be
    opened, or is not packed, one row without content, marked `kept`, with the
    reason.
    """
    files = listing.select(
        "uri", "path", "name", member_folder().alias("folder"), paths.stream_member(F.col("name")).alias("stem"),
        F.col("depth").cast("int").alias("depth"), "mtime", "length",
    )
    # Few bytes of a listing stand for many files to open.
    files = files.repartition(task_count(listing.sparkSession, 0, listing.count()))
    found = files.mapInArrow(_index, INDEX)
    streams = None
    if limits.spill is not None:
        split = _splittable(SPLIT_STREAM_BYTES if min_bytes is None else min_bytes)
        found = spool(found.mapInArrow(split, f"{INDEX}, split BOOLEAN"), "index", ("split",))
        streams, found = found.where("split").drop("split"), found.where("NOT split").drop("split")
    index = spool(found, "index")
    if streams is not None and not streams.isEmpty():
        streams = unpack_streams(streams, limits, run_bytes or RUN_BYTES)
    else:
        streams = None
    if streams is not None and index.isEmpty():
        return streams
    # The index is small but the reading it stands for is not, so the number of
    # tasks follows the bytes to read.
    total = index.agg(F.sum("packed").alias("bytes"), F.count("*").alias("n")).first()
    tasks = max(1, min(total["n"], -(-(total["bytes"] or 0) // TASK_BYTES)))
    nth = F.row_number().over(Window.partitionBy("path", "member").orderBy("start")) - 1
    again = F.when(nth > 0, F.concat(F.lit("#"), nth.cast("string"))).otherwise("")
    work = index.withColumn("again", again).repartition(tasks, "path", "member", "again")
    members = work.sortWithinPartitions("path", "start").mapInArrow(_read_members(limits), UNPACKED)
    return members if streams is None else members.unionByName(streams)
