"""File sources: scans, manifests, lookups and folder trees."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracemill.functions import paths
from tracemill.schemas import DIRECTORY, FILE
from tracemill.session import spool
from tracemill.sources.listing import list_entries, paths_from_uri, plain_root, read_contents

# A row can hold at most 2 GiB, so longer files go through the line source.
MAX_CONTENT_BYTES = 2**31 - 1

# What Spark's binary file source gives.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _utc(ts: Column) -> Column:
    return F.to_utc_timestamp(ts, F.current_timezone()).cast("timestamp_ntz")


def as_files(df: DataFrame) -> DataFrame:
    """Complete `path`, `content`, `mtime` rows to the files shape. A file left
    in place has no content and states its `length`."""
    path = F.col("path")
    length = F.octet_length("content").cast("bigint")
    if "length" in df.columns:
        length = F.coalesce(length, F.col("length"))
    return df.select(
        "path",
        paths.basename(path).alias("name"),
        paths.parent_dir(path).alias("parent"),
        F.lit(FILE).alias("entry_type"),
        length.alias("length"),
        "mtime",
        "content",
    )


def scan_files(
    spark: SparkSession,
    root: str,
    max_bytes: int = MAX_CONTENT_BYTES,
    skip_unreadable: bool = False,
    listing: DataFrame | None = None,
) -> DataFrame:
    """All files under `root`, recursively, up to `max_bytes` each, with content.

    Spark's binary file source reads them: it reads `content` only for plans
    that use it, and takes filters on `length` into the listing. It passes over
    empty files and names it deems hidden, so those are read by location. A
    `listing` of the folder's files, if at hand, saves making one.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    # Hadoop reads a location as a pattern, so its special characters are escaped.
    visible = from_binary_files(reader.load(re.sub(r"([\[\]{}*?\\])", r"\\\1", plain_root(root))))
    listing = list_files(spark, root) if listing is None else listing
    passed_over = spool(
        listing.join(visible.select("path"), "path", "left_anti").where(F.col("length") <= max_bytes),
        "passed-over",
    )
    found = visible.where(F.col("length") <= max_bytes)
    if passed_over.isEmpty():
        return found
    return found.unionByName(read_contents(passed_over, skip_unreadable).drop("uri"))


def read_files(
    spark: SparkSession,
    root: str,
    max_bytes: int = MAX_CONTENT_BYTES,
    skip_unreadable: bool = False,
    listing: DataFrame | None = None,
) -> DataFrame:
    """As `scan_files`, all from one listing made by the executors.

    No list of files comes to the driver, and files are packed into tasks by
    their bytes. Whatever a plan uses of them, their content is read, so a plan
    over names and sizes alone takes `list_files`. With `skip_unreadable` a file
    that can't be read has null content.
    """
    listing = list_files(spark, root) if listing is None else listing
    return read_contents(listing.where(F.col("length") <= max_bytes), skip_unreadable).drop("uri")


def paths_of(root: str) -> str:
    """The path inside the storage under which a folder's files are listed."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", plain_root(root))


def list_files(spark: SparkSession, root: str, min_bytes: int = -1) -> DataFrame:
    """Files under `root` longer than `min_bytes`, without content, with the `uri` to open each by."""
    return only_files(list_entries(spark, root)).where(F.col("length") > min_bytes)


def from_binary_files(found: DataFrame) -> DataFrame:
    """Rows of the binary file source in the files shape."""
    location = paths_from_uri(F.col("path"))
    return found.select(
        location.alias("path"),
        paths.basename(location).alias("name"),
        paths.parent_dir(location).alias("parent"),
        F.lit(FILE).alias("entry_type"),
        "length",
        _utc(F.col("modificationTime")).alias("mtime"),
        "content",
    )


def path_manifest(paths_df: DataFrame, column: str = "path") -> DataFrame:
    """A path list as a source; an empty or missing location fails the job."""
    location = F.col(column)
    checked = F.when(
        location.isNull() | (location == ""), F.raise_error(F.lit("a file needs a location"))
    ).otherwise(location)
    return paths_df.select(checked.cast("string").alias("path"))


def only_files(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("entry_type") == FILE)


def read_range(content: Column, offset: int, size: int | None = None) -> Column:
    """`size` bytes from `offset`; a negative offset counts from the end."""
    start = F.lit(offset + 1 if offset >= 0 else offset)
    if size is None:
        return F.substr(content, start)
    return F.substr(content, start, F.lit(size))


def resolve_entries(requested: DataFrame, files: DataFrame) -> DataFrame:
    """Requested paths with their entry, `present` false where there is none."""
    known = files.withColumn("_found", F.lit(True))
    return requested.join(known, "path", "left").withColumn(
        "present", F.coalesce(F.col("_found"), F.lit(False))
    ).drop("_found")


def missing_entries(requested: DataFrame, files: DataFrame) -> DataFrame:
    return requested.join(files.select("path"), "path", "left_anti")


def file_stat(files: DataFrame) -> DataFrame:
    """Metadata of each entry; display name and relative path are the path itself."""
    return files.select(
        "path", "name", "parent", "entry_type", "length", "mtime",
        F.col("path").alias("display_name"), F.col("path").alias("relative_path"),
    )


def _lineage(folder: Column) -> Column:
    """A folder and all folders above it."""
    return F.array_union(paths.path_prefixes(folder), F.array(folder))


def folders(files: DataFrame) -> DataFrame:
    """Every folder that leads to a file.

    Files collapse to their parents before anything is exploded, and the
    distinct combines on the map side, so the shuffle carries folders only.
    """
    parents = files.select("parent").distinct()
    path = F.col("path")
    return parents.select(F.explode(_lineage(F.col("parent"))).alias("path")).distinct().select(
        "path",
        paths.basename(path).alias("name"),
        paths.parent_dir(path).alias("parent"),
        F.lit(DIRECTORY).alias("entry_type"),
    )


def entries(files: DataFrame) -> DataFrame:
    """Files and the folders above them, as one listing."""
    listed = files.select("path", "name", "parent", "entry_type", "length", "mtime")
    return listed.unionByName(folders(files), allowMissingColumns=True)


def list_tree(files: DataFrame) -> DataFrame:
    """Number of direct children of each folder.

    A file path occurs once in a listing, so files are counted per parent
    straight away, combined on the map side; from there on rows are folders.
    Each folder then adds its own files to itself and one child to its parent.
    """
    per_parent = files.groupBy("parent").agg(F.count("*").alias("n"))
    own = F.when(F.col("folder") == F.col("parent"), F.col("n")).otherwise(F.lit(0))
    held = (
        per_parent.select("parent", "n", F.explode(_lineage(F.col("parent"))).alias("folder"))
        .groupBy("folder")
        .agg(F.sum(own).alias("n"))
    )
    shares = F.array(
        F.struct(F.col("folder").alias("parent"), F.col("n").alias("n")),
        F.struct(paths.parent_dir(F.col("folder")).alias("parent"), F.lit(1).cast("bigint").alias("n")),
    )
    return held.select(F.inline(shares)).where(F.col("parent").isNotNull()).groupBy("parent").agg(
        F.sum("n").alias("children")
    )


def children(listing: DataFrame, folder: str) -> DataFrame:
    """Direct children of one folder."""
    return listing.where(F.col("parent") == folder)


def within_depth(listing: DataFrame, root: str, depth: int | None = None) -> DataFrame:
    """Entries below `root`, at most `depth` levels down; all of them by default."""
    base = root.rstrip("/") + "/"
    below = listing.where(F.col("path").startswith(base) & (F.col("path") != base))
    if depth is None:
        return below
    level = F.size(F.split("path", "/")) - F.lit(base.count("/"))
    return below.where(level <= depth)
