"""Ingest: classify files by packing and unpack until nothing packed is left."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tracemill.functions import paths
from tracemill.operators.codecs import Limits, Long, Refused, free_name, open_packed
from tracemill.schemas import UNPACKED
from tracemill.session import shared_dir
from tracemill.sources.files import read_range
from tracemill.sources.listing import locate

# The signatures of the packed formats.
PACKED_SIGNATURES = {
    "gzip": (0, b"\x1f\x8b"),
    "bzip2": (0, b"BZh"),
    "xz": (0, b"\xfd7zXZ\x00"),
    "zip": (0, b"PK\x03\x04"),
    "tar": (257, b"ustar"),
}

PLAIN = "plain"
STREAMS = ("gzip", "bzip2", "xz")
ARCHIVES = ("zip", "tar")

INPUT = ("path", "name", "source_path", "folder", "stem", "depth", "mtime", "kind", "content", "ancestors")
FLUSH_BYTES = 8 << 20
FLUSH_ROWS = 2000


def detect_kind(content: Column) -> Column:
    """Packing of a file by its leading bytes, `plain` if none.

    A tar archive inside a compressed stream shows only once its first block is
    decompressed, so that is decided where the stream is opened.
    """
    kind = None
    for name, (offset, magic) in PACKED_SIGNATURES.items():
        case = (read_range(content, offset, len(magic)) == F.lit(magic), F.lit(name))
        kind = F.when(*case) if kind is None else kind.when(*case)
    return kind.otherwise(F.lit(PLAIN))


_FIELDS = [
    ("path", pa.string()), ("name", pa.string()), ("source_path", pa.string()), ("depth", pa.int32()),
    ("mtime", pa.timestamp("us")), ("content", pa.binary()), ("length", pa.int64()), ("kept", pa.bool_()), ("warning", pa.string()),
    ("ancestors", pa.list_(pa.binary())),
]


def unpacked_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], [n for n, _ in _FIELDS])


def store_member(target: str, data: bytes | Long, limits: Limits) -> tuple[bytes | None, int]:
    """Content and length of a member; one too long for a row is written below the spill folder.

    The file gets its name once it is whole; a task that is run again finds the
    same file there and drops its own.
    """
    if isinstance(data, bytes):
        return data, len(data)
    if limits.spill is None:
        raise Refused(f"longer than {limits.row_bytes} bytes")
    from pyspark import TaskContext

    filesystem, path = locate(limits.spill.rstrip("/") + target)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{TaskContext.get().taskAttemptId()}"
    length = 0
    with filesystem.open_output_stream(part) as out:
        for chunk in data.chunks:
            out.write(chunk)
            length += len(chunk)
    if filesystem.get_file_info(path).is_file:
        filesystem.delete_file(part)
    else:
        filesystem.move(part, path)
    return None, length


def _unpack(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in INPUT]
            for i in range(batch.num_rows):
                path, name, source, folder, stem, depth, mtime, kind, content, above = (c[i].as_py() for c in columns)
                unpacked, warnings, taken = 0, [], set()
                digest = hashlib.sha256(content).digest()
                chain = [*(above or []), digest]
                # A file that is packed in itself would be opened for ever.
                again = [(None, None, "holds itself")] if digest in chain[:-1] else None
                for member, data, warning in again or open_packed(kind, content, limits):
                    if warning is not None:
                        warnings.append(warning)
                        continue
                    target = free_name(f"{folder}/{member or stem}", taken)
                    try:
                        data, length = store_member(target, data, limits)
                    except Exception as exc:
                        warnings.append(f"unreadable member {member or stem!r}: {exc or type(exc).__name__}")
                        continue
                    unpacked += 1
                    # A batch is sent before a row that would make it too long.
                    if rows and (size + len(data or b"") > FLUSH_BYTES or len(rows) >= FLUSH_ROWS):
                        yield unpacked_batch(rows)
                        rows, size = [], 0
                    rows.append((target, target.rsplit("/", 1)[-1], path, depth + 1, mtime, data, length, False, None, chain))
                    size += len(data or b"")
                if warnings or not unpacked:
                    # Something is still only in the packed file, so it stays.
                    if rows and size + len(content) > FLUSH_BYTES:
                        yield unpacked_batch(rows)
                        rows, size = [], 0
                    rows.append((path, name, source, depth, mtime, content, len(content), True, "; ".join(warnings) or None, None))
                    size += len(content)
        if rows:
            yield unpacked_batch(rows)

    return run


def _or_else(df: DataFrame, column: str, default: Column) -> Column:
    return (F.col(column) if column in df.columns else default).alias(column)


def member_folder() -> Column:
    """Where the members of a packed file go: a folder beside it."""
    up = paths.parent_dir(F.col("path"))
    return F.concat(
        F.when(up == "/", F.lit("/")).otherwise(F.concat(up, F.lit("/"))),
        paths.unpack_folder(F.col("path"), F.col("name")),
    )


def unpack(packed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One unpack round over rows with `path, name, depth, mtime, kind, content`.

    Gives one row per member. A packed file itself comes back, marked `kept`,
    if it holds nothing or anything in it could not be taken out.
    """
    folder = member_folder()
    ready = packed.select(
        "path", "name", _or_else(packed, "source_path", F.lit(None).cast("string")),
        folder.alias("folder"), paths.stream_member(F.col("name")).alias("stem"),
        F.col("depth").cast("int").alias("depth"), "mtime", "kind", "content",
        _or_else(packed, "ancestors", F.lit(None).cast("array<binary>")),
    )
    return ready.mapInArrow(_unpack(limits), UNPACKED)


def _one_round(files: DataFrame, kinds: tuple[str, ...], limits: Limits) -> DataFrame:
    mine = F.col("kind").isin(*kinds)
    rest = files.where(~mine).select(
        "path", "name", F.lit(None).cast("string").alias("source_path"), F.col("depth").cast("int").alias("depth"),
        "mtime", "content", F.octet_length("content").cast("bigint").alias("length"),
        F.lit(True).alias("kept"), F.lit(None).cast("string").alias("warning"), F.lit(None).cast("array<binary>").alias("ancestors"),
    )
    return unpack(files.where(mine), limits).unionByName(rest)


def decompress(files: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Compressed streams replaced by what is in them; other files stay as they are."""
    return _one_round(files, STREAMS, limits)


def expand_archive(files: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Archives replaced by their members; other files stay as they are."""
    return _one_round(files, ARCHIVES, limits)


def _settled(df: DataFrame) -> DataFrame:
    return df.select("path", "name", "source_path", "depth", "mtime", "content", "length", "kind", "warning")


def unpack_recursive(files: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Unpack until nothing packed is left, however deep it lies.

    Each round opens what is still packed, once, and writes the outcome split
    into settled and still packed files; the next round reads only the latter.
    Reading back re-splits the table, so the members of one large archive are
    spread over the cluster without a shuffle. Every member carries the digests
    of the packed files around it: one that equals any of them holds itself and
    stays packed, with a warning, so the rounds end.
    """
    spark = files.sparkSession
    start = files.select(
        "path", "name", _or_else(files, "source_path", F.lit(None).cast("string")),
        _or_else(files, "depth", F.lit(0)), "mtime", "content",
        _or_else(files, "length", F.octet_length("content").cast("bigint")),
        _or_else(files, "ancestors", F.lit(None).cast("array<binary>")),
        detect_kind(F.col("content")).alias("kind"), F.lit(None).cast("string").alias("warning"),
    )
    settled, packed = _settled(start.where(F.col("kind") == PLAIN)), start.where(F.col("kind") != PLAIN)
    # All rounds lie below one folder, so that reading them is one scan at any depth.
    base, rounds = shared_dir(spark, "unpack"), 0
    schema = f"{UNPACKED}, kind STRING, packed BOOLEAN"
    while True:
        kind = detect_kind(F.col("content"))
        outcome = unpack(packed, limits).withColumn("kind", kind).withColumn(
            "packed", (F.col("kind") != PLAIN) & ~F.col("kept")
        )
        outcome.write.partitionBy("packed").parquet(f"{base}/round={rounds}")
        packed = spark.read.schema(schema).parquet(f"{base}/round={rounds}").where(F.col("packed"))
        rounds += 1
        if packed.isEmpty():
            break
    opened = spark.read.schema(f"{schema}, round INT").parquet(base)
    return settled.unionByName(_settled(opened.where(~F.col("packed"))))


def source_disposition(files: DataFrame, unpacked: Column, upload_root: str, processed_root: str) -> DataFrame:
    """What happens to each scanned file: dropped once unpacked, moved out of the
    upload folder, or kept where it is."""
    uploaded = F.col("path").startswith(upload_root.rstrip("/") + "/")
    disposition = F.when(unpacked, F.lit("drop")).when(uploaded, F.lit("move")).otherwise(F.lit("keep"))
    return files.select(
        "path",
        disposition.alias("disposition"),
        paths.remap_root(F.col("path"), upload_root, processed_root).alias("out_path"),
    )
