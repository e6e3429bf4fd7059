"""Uploaded files made ready for extraction."""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracemill.functions import paths
from tracemill.operators.codecs import Limits
from tracemill.operators.ingest import unpack_recursive
from tracemill.operators.long_archives import unpack_long
from tracemill.plans.sinks import land_files
from tracemill.schemas import DIRECTORY
from tracemill.session import shared_dir, spool
from tracemill.sources.files import MAX_CONTENT_BYTES, as_files, list_entries, list_files, only_files, paths_of, read_files


UNREAD = "could not be read"


def upload(
    spark: SparkSession,
    source: str,
    landing: str,
    upload_root: str | None = None,
    processed_root: str = "",
    limits: Limits = Limits(),
    max_bytes: int = MAX_CONTENT_BYTES,
    entries: DataFrame | None = None,
) -> DataFrame:
    """Bring a folder into a landing area: its files unpacked, its folders kept, empty ones too.

    Returns (path, outcome, warning), one row a source file: `landed`, `unpacked`
    where its members are there in its place, `left` where it is too long for a
    row and is read where it lies, or `unreadable`, which lands nothing. What is
    wrong with one file doesn't end the run.
    """
    entries = spool(list_entries(spark, source) if entries is None else entries, "entries")
    upload_root = paths_of(source) if upload_root is None else upload_root
    listed = only_files(entries)
    # What this reads is written already, so reading it for the report too costs no second unpacking.
    plain = ingest(spark, source, upload_root, processed_root, limits, max_bytes, listed)
    bad = F.isnull("content") & (F.col("warning") == UNREAD)
    kept_folders = _moved(entries.where(F.col("entry_type") == DIRECTORY), upload_root, processed_root)
    land_files(as_files(plain.where(~F.coalesce(bad, F.lit(False)))), landing, kept_folders)
    come = plain.groupBy("path").agg(F.min("warning").alias("warning"), F.max(F.isnull("content")).alias("empty"))
    outcome = (
        F.when(F.isnull("empty"), F.lit("unpacked"))
        .when(F.coalesce(F.col("warning") == UNREAD, F.lit(False)), F.lit("unreadable"))
        .when(F.col("empty"), F.lit("left"))
        .otherwise(F.lit("landed"))
    )
    wanted = _moved(listed.select("path"), upload_root, processed_root)
    return wanted.join(come, "path", "left").select("path", outcome.alias("outcome"), "warning")


def ingest(
    spark: SparkSession,
    source: str | DataFrame,
    upload_root: str,
    processed_root: str = "",
    limits: Limits = Limits(),
    max_bytes: int = MAX_CONTENT_BYTES,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Unpack `source`, a folder or a files DataFrame, to the bottom.

    Paths move from `upload_root` to `processed_root`, by default to paths
    relative to the upload folder, as the landing area keeps them. Archives of a
    folder longer than `max_bytes` are opened in place; a file that stays too
    long for a row comes without content but with its length and a warning, and
    is left where it is for `extract(..., long_root=source)` to read. Long
    members lie below `limits.spill`, by default a folder beside the intermediate
    tables, under the path they would have had. A file of a folder that can't be
    read comes without content and with a warning. A `listing` of the folder's
    files, if at hand, saves making one.
    """
    if limits.spill is None:
        limits = replace(limits, spill=shared_dir(spark, "spill"))
    if not isinstance(source, str):
        return _moved(unpack_recursive(source, limits), upload_root, processed_root)

    listed = list_files(spark, source) if listing is None else listing
    # Written once: the rounds and what stays packed are all taken from here.
    read = spool(read_files(spark, source, max_bytes, skip_unreadable=True, listing=listed), "uploads")
    short = unpack_recursive(read, limits)
    unread = F.isnull("content") & (F.col("length") <= limits.row_bytes) & F.isnull("source_path")
    settled = [short.withColumn("warning", F.when(unread, F.lit(UNREAD)).otherwise(F.col("warning")))]
    waiting = listed.where(F.col("length") > max_bytes).withColumn("depth", F.lit(0))
    waiting = waiting.unionByName(_spilled(settled[0], limits), allowMissingColumns=True)
    while not (waiting := spool(waiting, "waiting")).isEmpty():
        opened = spool(unpack_long(waiting, limits), "long", ("kept",))
        # One row per file; the parts of an archive that failed are counted, not gathered.
        failed = opened.where("kept").groupBy("path").agg(F.count("*").alias("n"), F.min("warning").alias("first"))
        why = F.when(F.col("n") == 1, F.col("first")).otherwise(
            F.format_string("%d parts not taken out, one of them: %s", "n", "first")
        )
        stay = waiting.join(failed, "path").withColumn("warning", why)
        members = opened.where("NOT kept").drop("kept", "warning")
        # What waited is now open or stays in place; it is no longer among the settled.
        settled[-1] = settled[-1].where(F.col("content").isNotNull() | (F.col("length") <= limits.row_bytes))
        settled.append(stay.select("path", "name", "source_path", "mtime", "length", "depth", "warning"))
        settled.append(unpack_recursive(members, limits))
        waiting = _spilled(settled[-1], limits)
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), settled)
    return _moved(together, upload_root, processed_root)


def _spilled(files: DataFrame, limits: Limits) -> DataFrame:
    """Members written below the spill folder. They may be packed themselves, so they wait like uploads."""
    uri = F.concat(F.lit((limits.spill or "").rstrip("/")), F.col("path"))
    long = (F.col("length") > limits.row_bytes) & F.col("content").isNull()
    return files.where(long).select(uri.alias("uri"), "path", "name", "source_path", "depth", "mtime", "length")


def _moved(files: DataFrame, upload_root: str, processed_root: str) -> DataFrame:
    return files.withColumn("path", paths.remap_root(F.col("path"), upload_root, processed_root))
