"""Sinks: the landing area, the timeline store and JSON text.

A store holds one table per container, in folders by session and version. What
a run writes lies under a version nobody knows yet; one row added to the commit
log at the end makes all its tables visible together, in place of the session's
version before. A run that dies leaves the store as it was, and readers see the
old rows until the new ones are complete.
"""

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracemill.operators.associate import event_sources
from tracemill.operators.counts import merge_parser_counts, parser_counts
from tracemill.operators.timeline import timeline
from tracemill.schemas import DIRECTORY, EVENT_DATA, EXTRACTION_WARNING, FILE, FILES, RECOVERY_WARNING, RESULTS
from tracemill.functions import paths
from tracemill.plans.formatters import format_results, json_document
from tracemill.plans.settings import SESSION
from tracemill.sources.listing import locate

# The tables of a store; each run adds its rows under its own session.
CONTAINERS = {
    "event_source": "file_entry_type STRING, path STRING",
    "event_data_stream": "path STRING",
    "results": RESULTS,
    "timeline": "path STRING, parser STRING, seq BIGINT, attributes MAP<STRING, STRING>, "
    "timestamp_desc STRING, timestamp TIMESTAMP_NTZ",
    "parser_count": "name STRING, number_of_events BIGINT",
    "session": SESSION.replace("session_id STRING, ", ""),
}


def land_files(files: DataFrame, out: str, folders: DataFrame | None = None) -> DataFrame:
    """Write files, and folders that may be empty, into a landing area; returns what it now holds.

    Rows stay in the partitions they were read in: landing moves no data
    between executors.
    """
    spark = files.sparkSession
    columns = [c.split()[0] for c in FILES.split(", ")]
    files.select(*columns).write.mode("append").partitionBy("entry_type").parquet(out)
    if folders is not None:
        path = F.col("path")
        empty = folders.select("path").select(
            "path", paths.basename(path).alias("name"), paths.parent_dir(path).alias("parent"),
            F.lit(DIRECTORY).alias("entry_type"),
        )
        empty.write.mode("append").partitionBy("entry_type").parquet(out)
    return landed(spark, out)


def landed(spark: SparkSession, out: str) -> DataFrame:
    """Files and folders of a landing area; a plan over files only prunes the folders' partition."""
    return spark.read.schema(FILES).parquet(out)


# Folders a writing task remembers to be there.
KNOWN_FOLDERS = 10_000


def write_files(files: DataFrame, root: str) -> int:
    """Files written as files below `root`, at their paths; their number is returned.

    Each is written in a folder of its own attempt and then moved, so a task
    that is run again leaves whole files only, and tasks that fill one folder
    wait for each other once a file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, written = set(), 0
        filesystem, base = locate(root.rstrip("/"))
        own = f"{base}/.attempt-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            if not written and batch.num_rows:
                filesystem.create_dir(own, recursive=True)
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                target = base + path
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    if len(made) >= KNOWN_FOLDERS:
                        made.clear()
                    made.add(folder)
                with filesystem.open_output_stream(f"{own}/file", compression=None) as out:
                    out.write(content or b"")
                filesystem.move(f"{own}/file", target)
            written += batch.num_rows
        if written:
            filesystem.delete_dir(own)
            yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["n"])

    return files.select("path", "content").mapInArrow(run, "n BIGINT").agg(F.sum("n")).first()[0] or 0


def text_files(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Text rows as files: UTF-8 bytes with their path."""
    location = F.col(path)
    content = F.encode(F.col(text), "UTF-8")
    return df.select(
        location.alias("path"),
        paths.basename(location).alias("name"),
        paths.parent_dir(location).alias("parent"),
        F.lit(FILE).alias("entry_type"),
        F.octet_length(content).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp_ntz").alias("mtime"),
        content.alias("content"),
    )


def landing_report(wanted: DataFrame, area: DataFrame) -> DataFrame:
    """Each wanted path and whether it was landed; what could not be read shows as not ok."""
    held = area.where(F.col("entry_type") == FILE).select("path", F.lit(True).alias("ok"))
    return wanted.select("path").join(held, "path", "left").select("path", F.coalesce("ok", F.lit(False)).alias("ok"))


def write_json(results: DataFrame, out: str, formatter: str = "json") -> None:
    """Documents as text. JSON is laid out on one line each, so the output can be split and read back."""
    if formatter == "json":
        documents = results.select(json_document(results, pretty=False).alias("document"))
    else:
        documents = format_results(results, formatter).select("document")
    documents.write.mode("errorifexists").text(out)


COMMITS = "commits"
# Sessions up to which their versions are part of a plan that reads all of them.
PLANNED_VERSIONS = 1000
COMMIT = "session_id STRING, version STRING, number BIGINT"


# Files a task may have open when it writes to folders by column; beyond them it sorts its rows after all.
OPEN_FILES = 8


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Tasks keep a file open for each container and don't sort all their rows by it."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(max(OPEN_FILES, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _put(df: DataFrame, store: str, container: str, session_id: str, version: str, *extra: str) -> None:
    """Add rows of a version; no other attempt writes there."""
    tagged = df.withColumns({"session_id": F.lit(session_id), "version": F.lit(version)})
    tagged.write.mode("append").partitionBy("session_id", "version", *extra).parquet(f"{store}/{container}")


def _has(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def snapshot(spark: SparkSession, store: str) -> DataFrame:
    """(session_id, version): what the store shows of each session, its last commit."""
    if not _has(spark, f"{store}/{COMMITS}"):
        return spark.createDataFrame([], "session_id STRING, version STRING")
    log = spark.read.schema(COMMIT).json(f"{store}/{COMMITS}")
    last = F.max(F.struct("number", "version")).alias("last")
    return log.groupBy("session_id").agg(last).select("session_id", "last.version")


def commit_session(spark: SparkSession, store: str, session_id: str, version: str) -> None:
    """Show a version in place of the session's one before: one row, one file, moved into the log when complete."""
    number = 1
    if _has(spark, f"{store}/{COMMITS}"):
        log = spark.read.schema(COMMIT).json(f"{store}/{COMMITS}").where(F.col("session_id") == session_id)
        number += log.agg(F.max("number")).first()[0] or 0
    row = spark.createDataFrame([(session_id, version, number)], COMMIT)
    row.coalesce(1).write.mode("append").json(f"{store}/{COMMITS}")


def vacuum(spark: SparkSession, store: str, older_than: float = 7 * 24 * 3600.0) -> int:
    """Delete the versions no session shows, left by runs that died or were replaced; returns their number.

    Those changed less than `older_than` seconds ago stay: they may belong to a
    run that is still writing.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    catalog = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    shown = {
        tuple(catalog.getPartitionPathString(c, r[c]) for c in ("session_id", "version"))
        for r in snapshot(spark, store).toLocalIterator()
    }
    dropped = set()
    for container in CONTAINERS:
        root = jvm.org.apache.hadoop.fs.Path(f"{store}/{container}")
        fs = root.getFileSystem(conf)
        for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "session_id=*/version=*")) or []:
            path = found.getPath()
            place = (path.getParent().getName(), path.getName())
            if place not in shown and found.getModificationTime() <= (time.time() - older_than) * 1000:
                fs.delete(path, True)
                dropped.add(place)
    return len(dropped)


def _rows(spark: SparkSession, store: str, container: str) -> DataFrame:
    return spark.read.schema(f"{CONTAINERS[container]}, session_id STRING, version STRING").parquet(f"{store}/{container}")


def _routed(rows: DataFrame, container: str) -> DataFrame:
    """Rows of `results` as the table of one container."""
    rows = rows.where(F.col("container") == container)
    if container == EVENT_DATA:
        return rows.select("session_id", "path", "parser", "seq", "attributes", "times")
    return rows.select("session_id", "path", F.col("parser").alias("parser_chain"), "seq", "message")


def read_container(spark: SparkSession, store: str, container: str, session_id: str | None = None) -> DataFrame:
    """A table of the store over all sessions, or of one, as last committed.

    The versions to read are fixed by the log when the plan is made, and other
    versions' folders are pruned. Beyond `PLANNED_VERSIONS` sessions they are
    joined when it runs.
    """
    if container in (EVENT_DATA, EXTRACTION_WARNING, RECOVERY_WARNING):
        return _routed(read_container(spark, store, "results", session_id), container)
    rows, shown = _rows(spark, store, container), snapshot(spark, store)
    if session_id is None:
        known = [r["version"] for r in shown.select("version").limit(PLANNED_VERSIONS + 1).collect()]
        if len(known) <= PLANNED_VERSIONS:
            return rows.where(F.col("version").isin(known)).drop("version")
        shown = rows.join(shown, ["session_id", "version"], "left_semi")
        return shown.select(*[c for c in rows.columns if c != "version"])
    last = shown.where(F.col("session_id") == session_id).first()
    version = F.lit(last["version"] if last else None)
    return rows.where((F.col("session_id") == session_id) & (F.col("version") == version)).drop("version")


def read_parser_counts(spark: SparkSession, store: str) -> DataFrame:
    """Counts added up over the runs of a store."""
    return merge_parser_counts(read_container(spark, store, "parser_count").select("name", "number_of_events"))


def stage_containers(
    files: DataFrame, results: DataFrame, store: str, session_id: str, storage_kind: str = "FILE",
    session: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write all tables of one run as a version still to be committed, and return it.

    Results are computed and written once, partitioned by container; streams,
    timeline and counts are derived from the written table, so extraction never
    runs twice. Counts are one small set of rows per run, added up when read:
    nothing written before is rewritten. `session` gives the run's session rows
    from the results as written.
    """
    spark, version = files.sparkSession, uuid.uuid4().hex
    put = lambda df, container, *extra: _put(df, store, container, session_id, version, *extra)
    with _unsorted(spark):
        _together(
            spark,
            lambda: put(results, "results", "container"),
            lambda: put(event_sources(files, storage_kind), "event_source"),
        )
    mine = (F.col("session_id") == session_id) & (F.col("version") == version)
    written = _rows(spark, store, "results").where(mine).drop("version")
    event_data = _routed(written, EVENT_DATA)
    writes = [
        # Every event comes from a file of this run, so the streams that own
        # events are the distinct locations of the events.
        lambda: put(event_data.select("path").distinct(), "event_data_stream"),
        lambda: put(timeline(event_data), "timeline"),
        lambda: put(parser_counts(written).coalesce(1), "parser_count"),
    ]
    if session is not None:
        writes.append(lambda: put(session(written).drop("session_id"), "session"))
    with _unsorted(spark):
        _together(spark, *writes)
    return version


def write_containers(
    files: DataFrame, results: DataFrame, store: str, session_id: str, storage_kind: str = "FILE",
    session: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write all tables of one run; they replace, at once, what the store shows of the session."""
    version = stage_containers(files, results, store, session_id, storage_kind, session)
    commit_session(files.sparkSession, store, session_id, version)


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Independent writes side by side, so that one's last tasks leave no executors idle."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()
