"""Every operator bound to the test tables, seen as a tree of files."""

import bz2
import gzip
import io
import lzma
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracemill.functions import chains, paths, times
from tracemill.functions.text import decode_text
from tracemill.operators import associate, classify, counts, distribute, extract, ingest, long_archives
from tracemill.operators.codecs import Limits
from tracemill.operators.registry import DEFAULT, LONG_LINE_BYTES, TEXT, Emit, Extractor, select_extractors
from tracemill.operators.timeline import timeline, times as times_of
from tracemill.plans import pipeline, settings as S, uploads
from tracemill.plans import sinks
from tracemill.plans.formatters import json_document
from tracemill.schemas import EVENT_DATA, EXTRACTION_ERROR, EXTRACTION_WARNING, RECOVERY_WARNING, RESULTS
from tracemill.session import shared_dir, spool
from tracemill.sources import files as src
from tracemill.sources.corpus import corpus, table, user_logs
from tracemill.sources.listing import read_contents

Query = Callable[[SparkSession, str], DataFrame]

BUCKETS = 16
# Fixture archives hold the documents of this many consecutive ids, so none grows with the data.
ARCHIVE_IDS = 256
# Bytes of texts packed at a time.
PACK_BYTES = 4 << 20


def results(spark: SparkSession, sf_dir: str, registry=DEFAULT) -> DataFrame:
    return extract.extract_results(corpus(spark, sf_dir), registry)


# Sources


def scan_files(spark, sf_dir):
    """Turns of conversations as files in a folder each, listed by the executors and read in tasks of even bytes."""
    path = F.concat_ws("/", F.lit("/turns"), F.col("conv_id").cast("string"), F.concat(F.col("turn").cast("string"), F.lit(".txt")))
    turns = table(spark, sf_dir, "conversations").select(path.alias("path"), F.encode("text", "UTF-8").alias("content"))
    root = shared_dir(spark, "scan-files")
    sinks.write_files(turns.repartition("path"), root)
    found = src.read_files(spark, root)
    return found.select(_below(root), "name", "entry_type", "length", F.md5("content").alias("digest"))


def _odd_files(spark, sf_dir, label):
    """Documents as real files with awkward names, some with carriage returns; the folder they are in."""
    suffix = F.when(F.col("doc_id") % 4 == 0, ".gz").otherwise(".txt")
    body = F.when(F.col("doc_id") % 3 == 1, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
    path = F.concat(F.lit("/d "), F.col("doc_id").cast("string"), F.lit("%41["), suffix)
    root = shared_dir(spark, label)
    sinks.write_files(table(spark, sf_dir, "documents").select(path.alias("path"), F.encode(body, "UTF-8").alias("content")), root)
    return root


def _below(root: str):
    return F.substring("path", len(src.paths_of(root)) + 1, 1 << 20).alias("path")


def scan_tree(spark, sf_dir):
    """The files read back from a folder that is spelt with needless steps."""
    root = _odd_files(spark, sf_dir, "scan-tree")
    found = src.read_files(spark, f"{root}/./", skip_unreadable=True)
    return found.select(_below(root), "length", F.md5("content").alias("digest"))


def long_files(spark, sf_dir):
    """Extraction where nearly every file is longer than a row may be."""
    root = _odd_files(spark, sf_dir, "long-files")
    run = pipeline.extract(spark, root, formatter="json", max_bytes=200)
    return extract.flat(run.results).select("container", _below(root), "parser", "seq", "message", "attr", "val")


def long_signed_files(spark, sf_dir):
    """Pages, and documents as members of JSON objects, read in small splits as too long for a row."""
    pages = corpus(spark, sf_dir).where(F.col("path").startswith("/pages/")).select("path", "content")
    member = F.regexp_replace(F.to_json(F.create_map(F.col("doc_id").cast("string"), "text")), r"^\{|\}$", "")
    docs = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 64).alias("volume"))
    docs = docs.agg(F.concat(F.lit("{"), F.array_join(F.collect_list(member), ",\n "), F.lit("}")).alias("text"))
    objects = docs.select(F.concat(F.lit("/objects/"), F.col("volume"), F.lit(".json")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    root = shared_dir(spark, "long-signed")
    sinks.write_files(pages.unionByName(objects), root)
    run = pipeline.extract(spark, root, formatter="json", max_bytes=300, split_bytes=1 << 14)
    pairs = F.array_sort(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    digest = F.md5(F.array_join(pairs, ";")).alias("digest")
    found = run.results.where("parser <> 'filestat'")
    return found.select("container", _below(root), "parser", "seq", "message", F.size("attributes").alias("n"), digest)


def _late_failure(file):
    """Emits a time that is none for files of even length."""
    yield file.event({"bytes": file.file.length})
    yield file.event({"n": 1}, times={"Seen": "not a time" if file.file.length % 2 == 0 else None})


def isolated_failures(spark, sf_dir):
    """A declared and a Python extractor that fail on part of the files."""
    number = Extractor("number", emits=(Emit(attributes={"value": "CAST(CAST(content AS STRING) AS INT)"}),))
    late = Extractor("late", python=_late_failure)
    files = corpus(spark, sf_dir).where(F.col("path").startswith("/documents/"))
    found = extract.extract_results(files, (number, late))
    return found.groupBy("path", "parser").agg(
        F.count_if(F.col("container") == EVENT_DATA).alias("rows_kept"),
        F.count_if(F.col("container") == EXTRACTION_ERROR).alias("errors"),
    )


def raising_extractors(spark, sf_dir):
    """Declared extractors whose values, condition or cut raise on part of the files: rows by container."""
    ratio = Extractor("ratio", emits=(Emit(attributes={"value": "CAST(1000 div (length % 3) AS STRING)"}),))
    third = "element_at(split(record, ' '), 3)"
    words = Extractor(
        "words", records="split(decode(content, 'ISO-8859-1'), '\\n')",
        emits=(Emit(when=f"{third} <> ''", attributes={"third": third}),),
    )
    strict = Extractor("strict", records="IF(length % 5 = 0, raise_error('refused'), array('x'))", emits=(Emit(),))
    files = corpus(spark, sf_dir).where(F.col("path").startswith("/documents/"))
    found = extract.extract_results(files, (ratio, words, strict))
    return found.groupBy("path", "parser", "container", "message").agg(F.count("*").alias("rows"))


def upload_report(spark, sf_dir):
    """What became of each uploaded file, and what the landing area holds: packed, plain and vanished files, empty folders."""
    # Those that become empty folders aren't packed first.
    packed = _compressed_documents(spark, sf_dir, "doc_id % 5 <> 0").select(F.concat(F.lit("/d"), "path").alias("path"), "content")
    root = shared_dir(spark, "uploads")
    sinks.write_files(packed, root)
    rest = table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select("doc_id")
    # A stated number of tasks, as rows without content are otherwise put together in one.
    rest = rest.repartition(spark.sparkContext.defaultParallelism, "doc_id")
    empty = rest.select(F.concat(F.lit("/empty/"), F.col("doc_id").cast("string"), F.lit("/.keep")).alias("path"))
    sinks.write_files(empty.withColumn("content", F.lit(b"")), root)
    found = src.list_entries(spark, root)
    # Listed, but gone when they are read.
    uri = F.when(F.col("name").endswith("7.txt.packed"), F.concat("uri", F.lit(".gone"))).otherwise(F.col("uri"))
    area = shared_dir(spark, "landing")
    report = uploads.upload(spark, root, area, entries=found.withColumn("uri", uri))
    held = sinks.landed(spark, area).where("name <> '.keep'")
    what = F.when(F.col("entry_type") == "file", F.md5("content")).otherwise("folder")
    # Folders of members are named after the whole path of their archive, which no table knows.
    place = F.regexp_replace("path", "_extracted.{8}/[^/]*$", "_extracted").alias("path")
    return report.select("path", "outcome", "warning").unionByName(held.select(place, F.lit("held").alias("outcome"), what.alias("warning")))


def only_files(spark, sf_dir):
    return src.only_files(src.entries(corpus(spark, sf_dir))).select("path", "length")


def path_source(spark, sf_dir):
    return src.path_manifest(corpus(spark, sf_dir).select("path"))


def read_range(spark, sf_dir):
    files = corpus(spark, sf_dir)
    return files.select(
        "path",
        F.hex(src.read_range(F.col("content"), 0, 4)).alias("head"),
        F.hex(src.read_range(F.col("content"), -4)).alias("tail"),
    )


def resolve_entries(spark, sf_dir):
    wanted = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/pages/"), (F.col("page_id") * 2).cast("string"), F.lit(".html")).alias("path")
    )
    return src.resolve_entries(wanted, corpus(spark, sf_dir).select("path", "length")).select("path", "present", "length")


def missing_entries(spark, sf_dir):
    wanted = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/pages/"), (F.col("page_id") * 2).cast("string"), F.lit(".html")).alias("path")
    )
    return src.missing_entries(wanted, corpus(spark, sf_dir))


def list_area(spark, sf_dir):
    """Files and folders at most two levels below the root."""
    return src.within_depth(src.entries(corpus(spark, sf_dir)), "/", 2).select("path", "entry_type")


def list_tree(spark, sf_dir):
    return src.list_tree(corpus(spark, sf_dir))


def file_stat(spark, sf_dir):
    return src.file_stat(corpus(spark, sf_dir)).select("path", "name", "parent", "length", "entry_type", "mtime")


def event_sources(spark, sf_dir):
    return associate.event_sources(corpus(spark, sf_dir), S.Settings().storage_kind)


def data_streams(spark, sf_dir):
    return associate.data_streams(corpus(spark, sf_dir))


# Classification and fan-out


def signature_match(spark, sf_dir):
    return classify.signature_match(corpus(spark, sf_dir), DEFAULT)


def signature_match_table(spark, sf_dir):
    rows = [(e.name, s.magic, s.offset) for e in DEFAULT for s in e.signatures]
    signatures = spark.createDataFrame(rows, "parser STRING, magic BINARY, offset INT")
    return classify.signature_match_table(corpus(spark, sf_dir), signatures)


def signature_split(spark, sf_dir):
    flag = classify.has_signature(DEFAULT).alias("has_signature")
    return corpus(spark, sf_dir).groupBy(flag).agg(F.count("*").alias("files"))


def assign_nonsig(spark, sf_dir):
    return classify.assign_nonsig(corpus(spark, sf_dir), DEFAULT)


def filter_extractors(spark, sf_dir):
    return classify.work_items(corpus(spark, sf_dir), select_extractors(DEFAULT, "!markup")).select("path", "parser")


def work_items(spark, sf_dir):
    return classify.work_items(corpus(spark, sf_dir), DEFAULT).select("path", "parser")


def unknown_extractor(spark, sf_dir):
    """Every file is also sent to an extractor that does not exist."""
    items = extract.items_with_content(corpus(spark, sf_dir), DEFAULT)
    stray = F.explode(F.array(F.col("parser"), F.when(F.col("parser") == "filestat", F.lit("no_such_parser"))))
    items = items.select("path", "name", "length", "mtime", "content", stray.alias("parser")).where("parser IS NOT NULL")
    asked = items.groupBy("parser").agg(F.count("*").alias("items"))
    done = extract.run_extractors(items, DEFAULT).where(F.col("container") == EVENT_DATA)
    done = done.groupBy(chains.root(F.col("parser")).alias("parser")).agg(F.count("*").alias("events"))
    return asked.join(done, "parser", "left").select("parser", "items", F.coalesce("events", F.lit(0)).alias("events"))


# Extraction


def extract_results(spark, sf_dir):
    return extract.flat(results(spark, sf_dir))


def filestat_events(spark, sf_dir):
    found = extract.flat(results(spark, sf_dir, select_extractors(DEFAULT, "filestat")))
    return found.select("path", F.col("val").alias("size"), F.col("t").alias("mtime"))


def _warnings(spark, sf_dir, container):
    found = counts.route_containers(results(spark, sf_dir))[container]
    return found.select("path", F.col("parser").alias("parser_chain"), "seq", "message")


def extraction_warnings(spark, sf_dir):
    return _warnings(spark, sf_dir, EXTRACTION_WARNING)


def recovery_warnings(spark, sf_dir):
    return _warnings(spark, sf_dir, RECOVERY_WARNING)


def _strict_lines(out) -> Iterator:
    """Lines of a file, given up at the first that is too long."""
    for seq, line in enumerate(bytes(out.file.content).split(b"\n")):
        if len(line) > LONG_LINE_BYTES:
            raise ValueError("line too long")
        if line:
            yield out.event({"bytes": len(line)}, seq=seq)


def partial_results(spark, sf_dir):
    """A Python extractor that fails inside some files; rows before the failure stay."""
    strict = Extractor("strict", python=_strict_lines)
    registry = (*(e for e in DEFAULT if e is not TEXT), strict)
    items = extract.items_with_content(corpus(spark, sf_dir), registry).where(F.col("parser") == strict.name)
    found = extract.run_extractors(items, (strict,))
    return found.groupBy("path").agg(
        F.count_if(F.col("container") == EVENT_DATA).alias("rows_kept"),
        F.count_if(F.col("container") == EXTRACTION_ERROR).alias("errors"),
    )


def results_timeline(spark, sf_dir):
    """The timeline of the whole tree: extraction to one row per time."""
    events = counts.route_containers(results(spark, sf_dir))[EVENT_DATA]
    return timeline(events, keys=("path", "parser", "seq"))


# Counts


def route_containers(spark, sf_dir):
    return results(spark, sf_dir).groupBy("container").agg(F.count("*").alias("rows"))


def run_summary(spark, sf_dir):
    return counts.run_summary(results(spark, sf_dir))


def warning_counts(spark, sf_dir):
    return counts.warning_counts(results(spark, sf_dir))


def parser_counts(spark, sf_dir):
    return counts.parser_counts(results(spark, sf_dir))


def merge_parser_counts(spark, sf_dir):
    """Counters of events and of timed events of this run, on top of those of an older store."""
    older = spark.createDataFrame([("filestat", 5), ("legacy", 7)], "name STRING, number_of_events BIGINT")
    return counts.merge_parser_counts(counts.run_counters(results(spark, sf_dir)), older)


def parser_chain(spark, sf_dir):
    name = F.col("chain")
    per_chain = results(spark, sf_dir).groupBy(F.col("parser").alias("chain")).agg(F.count("*").alias("n"))
    return per_chain.select("chain", chains.root(name).alias("root"), chains.depth(name).alias("depth"), "n")


def extract_tally(spark, sf_dir):
    return counts.extract_tally(results(spark, sf_dir))


def session_record(spark, sf_dir):
    """The enabled extractors of a run in order, with the events each gave."""
    enabled = select_extractors(DEFAULT, "html,json,text,filestat")
    settings = S.Settings(enabled_parser_names="html,json,text,filestat")
    start = S.session_row(spark, "run", S.START, datetime(2024, 1, 1), settings.as_map())
    given = counts.parser_counts(results(spark, sf_dir, enabled))
    given = given.groupBy(chains.root(F.col("name")).alias("enabled_parser")).agg(
        F.sum("number_of_events").alias("number_of_events")
    )
    names = S.enabled_parsers(start).select("ordinal", "enabled_parser")
    return names.join(given, "enabled_parser", "left").select(
        "ordinal", "enabled_parser", F.coalesce("number_of_events", F.lit(0)).alias("number_of_events")
    )


# Streams and timeline


def _order_streams(spark, sf_dir):
    """One stream per order, located in the log of the customer as a user: many per log, and none for some users."""
    log = F.concat(F.lit("/logs/user_"), F.col("o_custkey").cast("string"), F.lit(".log"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("stream_id"), log.alias("path"))


def event_stream_join(spark, sf_dir):
    events = user_logs(spark, sf_dir).select("event_id", "path")
    joined = associate.event_stream_join(events, _order_streams(spark, sf_dir))
    return joined.select("event_id", "path", "stream_id", "stream_path")


def emitted_streams(spark, sf_dir):
    return associate.emitted_streams(_order_streams(spark, sf_dir), user_logs(spark, sf_dir))


def stream_runs(spark, sf_dir):
    found = associate.stream_runs(user_logs(spark, sf_dir), order=("ts", "event_id"), group=("event_type",))
    return found.select("event_type", "event_id", "path")


def stream_runs_global(spark, sf_dir):
    found = associate.stream_runs(user_logs(spark, sf_dir), order=("ts", "event_id"))
    return found.select("event_id", "path")


def timeline_events(spark, sf_dir):
    """Orders with up to two times each: their date unless masked, and their first shipment."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("shipped")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("ordered")
    )
    events = orders.join(shipped, "o_orderkey", "left").withColumn(
        "times", times_of(Creation_Time="ordered", Modification_Time="shipped")
    )
    return timeline(events, keys=("o_orderkey",))


def posix_times(spark, sf_dir):
    """Times as POSIX nanoseconds, every fifth unknown, read back to microseconds."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    ns = F.when(F.col("event_id") % 5 == 0, F.lit(0)).otherwise(micros * 1000 + F.col("event_id") % 1000)
    return table(spark, sf_dir, "events").select("event_id", times.from_posix_ns(ns).alias("ts"))


def text_files(spark, sf_dir):
    """Texts written as UTF-8 files below a folder and read back from there."""
    path = F.concat(F.lit("/notes/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    docs = table(spark, sf_dir, "documents").select(path.alias("path"), F.concat("text", F.lit(" – ž 梦")).alias("text"))
    root = shared_dir(spark, "notes")
    sinks.write_files(sinks.text_files(docs), root)
    found = src.read_files(spark, root)
    return found.select(_below(root), "length", F.md5("content").alias("digest"))


def display_names(spark, sf_dir):
    return src.file_stat(src.entries(corpus(spark, sf_dir))).select("path", "display_name", "relative_path", "entry_type")


def normalize_time(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", times.to_utc(ts, "+02:00").alias("ts_utc"), times.in_year(ts, 2023).alias("in_2023")
    )


# Scalar functions


def path_functions(spark, sf_dir):
    path = F.col("path")
    return corpus(spark, sf_dir).select(
        "path",
        paths.basename(path).alias("basename"),
        paths.dirname(path).alias("dirname"),
        paths.with_store(path, "file://store").alias("uri"),
        paths.join_path(F.lit("/a/"), F.lit("b"), path).alias("joined"),
    )


def unpack_names(spark, sf_dir):
    return corpus(spark, sf_dir).select(
        "path",
        paths.unpack_folder(F.col("path"), F.col("name")).alias("folder"),
        paths.stream_member(F.col("name")).alias("member"),
    )


def source_disposition(spark, sf_dir):
    unpacked = F.col("name").endswith(".html")
    return ingest.source_disposition(corpus(spark, sf_dir), unpacked, "/documents", "/processed")


# Ingest


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def plain(data: bytes) -> bytes:
        return data

    codecs = [
        lambda data: gzip.compress(data, 1),
        lambda data: bz2.compress(data, 1),
        lambda data: lzma.compress(data, preset=0),
        plain,
    ]
    for batch in batches:
        # Sent on in runs of bounded bytes, so a long batch isn't held a second time.
        step = max(1, batch.num_rows * PACK_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            run = batch.slice(at, step)
            ids = run.column("doc_id").to_pylist()
            packed = [codecs[i % 4](text.as_py().encode()) for i, text in zip(ids, run.column("text"))]
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "content"])


def _compressed_documents(spark, sf_dir, where: str = "true") -> DataFrame:
    """Documents as files, each under one of four packings."""
    docs = table(spark, sf_dir, "documents").where(where).select("doc_id", "text").repartition("doc_id")
    packed = docs.mapInArrow(_compress, "doc_id BIGINT, content BINARY")
    path = F.concat(F.lit("/uploads/"), F.col("doc_id").cast("string"), F.lit(".txt.packed"))
    return packed.select(
        "doc_id", path.alias("path"), paths.basename(path).alias("name"), F.lit(0).alias("depth"),
        F.lit(None).cast("timestamp_ntz").alias("mtime"), "content",
        ingest.detect_kind(F.col("content")).alias("kind"),
    )


def detect_kind(spark, sf_dir):
    return _compressed_documents(spark, sf_dir).select("doc_id", "kind")


def decompress(spark, sf_dir):
    files = spool(_compressed_documents(spark, sf_dir), "packed")
    opened = ingest.decompress(files)
    origin = paths.stream_member(paths.basename(F.coalesce("source_path", "path")))
    return opened.select(
        origin.cast("bigint").alias("doc_id"),
        F.md5("content").alias("digest"),
        F.octet_length("content").cast("bigint").alias("length"),
    )


def _contents(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])


def _archives(spark, sf_dir, build: Callable[[list[tuple[str, bytes]]], bytes], suffix: str) -> DataFrame:
    """Documents packed into archives, one per language, source and id range."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, contents, size = [], [], 0
            for path, docs in zip(batch.column("path"), batch.column("docs")):
                names.append(path.as_py())
                contents.append(build([(f"{d['doc_id']}.txt", (d["text"] or "").encode()) for d in docs.as_py()]))
                size += len(contents[-1])
                if size >= PACK_BYTES:
                    yield _contents(names, contents)
                    names, contents, size = [], [], 0
            if names:
                yield _contents(names, contents)

    volume = F.floor(F.col("doc_id") / ARCHIVE_IDS).cast("string")
    stem = F.concat_ws("_", "lang", "source", volume)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat(F.lit("/uploads/"), stem, F.lit(suffix)).alias("path")
    )
    # Many small archives come in one batch; a group each would cost more than its packing.
    members = docs.groupBy("path").agg(F.collect_list(F.struct("doc_id", "text")).alias("docs"))
    return members.mapInArrow(pack, "path STRING, content BINARY").select(
        "path", paths.basename(F.col("path")).alias("name"), F.lit(0).alias("depth"),
        F.lit(None).cast("timestamp_ntz").alias("mtime"), "content",
        ingest.detect_kind(F.col("content")).alias("kind"),
    )


def _zip(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        for name, data in members:
            archive.writestr(name, data)
    return out.getvalue()


def _gz_tar_xz(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:xz", preset=0) as archive:
        for name, data in members:
            packed = gzip.compress(data, 1)
            info = tarfile.TarInfo(f"{name}.gz")
            info.size = len(packed)
            archive.addfile(info, io.BytesIO(packed))
    return out.getvalue()


def expand_archive(spark, sf_dir):
    archives = spool(_archives(spark, sf_dir, _zip, ".zip"), "archives")
    return ingest.expand_archive(archives).select(
        paths.basename(F.col("source_path")).alias("archive"),
        F.col("name").alias("member"),
        F.octet_length("content").cast("bigint").alias("length"),
        F.md5("content").alias("digest"),
    )


def unpack_recursive(spark, sf_dir):
    archives = spool(_archives(spark, sf_dir, _gz_tar_xz, ".tar.xz"), "nested").drop("kind")
    return ingest.unpack_recursive(archives).select(
        F.col("name").alias("member"), "depth", F.md5("content").alias("digest")
    )


def _pack_volume(group: pd.DataFrame) -> pd.DataFrame:
    """The documents of a volume as one stream: bzip2 in small blocks, or xz in a stream for every 16 documents."""
    lines = [text.encode() + b"\n" for text in group.sort_values("doc_id")["text"]]
    volume = int(group["volume"].iloc[0])
    if volume % 2:
        data = b"".join(lzma.compress(b"".join(lines[k : k + 16]), preset=0) for k in range(0, len(lines), 16))
    else:
        data = bz2.compress(b"".join(lines), 1)
    return pd.DataFrame({"path": [f"/v{volume}.txt.{'xz' if volume % 2 else 'bz2'}"], "content": [data]})


def split_streams(spark, sf_dir):
    """Long bzip2 and xz streams opened in runs of blocks by many tasks: what comes out, read back from its parts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / ARCHIVE_IDS).alias("volume"))
    root, spill = shared_dir(spark, "streams"), shared_dir(spark, "spill")
    sinks.write_files(docs.groupBy("volume").applyInPandas(_pack_volume, "path STRING, content BINARY"), root)
    limits = Limits(row_bytes=1 << 14, spill=spill)
    listed = src.list_files(spark, root).withColumn("depth", F.lit(0))
    opened = long_archives.unpack_long(listed, limits, min_bytes=1 << 14, run_bytes=1 << 16)
    whole = F.concat(F.lit(spill), "path")
    found = read_contents(spool(opened.where("NOT kept").withColumn("uri", whole).drop("content"), "opened"))
    return found.select(F.regexp_extract("source_path", "v[0-9]+", 0).alias("volume"), "length", F.md5("content").alias("digest"))


def decode_documents(spark, sf_dir):
    """Documents by the rest of their id: UTF-16 with a mark, Latin-1, Latin-1 with a byte the code page lacks, UTF-8.

    What is not UTF-8 is read in the default code page.
    """
    rest, latin = F.col("doc_id") % 4, F.concat(F.lit("é"), F.regexp_replace("text", "[^\\x00-\\x7F]", "é"))
    broken = F.concat(F.lit(b"\x81"), F.encode(latin, "ISO-8859-1"))
    content = F.when(rest == 1, F.encode("text", "UTF-16")).when(rest == 2, F.encode(latin, "ISO-8859-1"))
    content = content.when(rest == 3, broken).otherwise(F.encode("text", "UTF-8"))
    docs = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return decode_text(docs, S.Settings().preferred_codepage).select("doc_id", "charset", "text", "warning")


# Distribution


def repartition_buckets(spark, sf_dir):
    items = classify.work_items(corpus(spark, sf_dir), DEFAULT)
    return distribute.spread(items, BUCKETS).select("path", "parser", "bucket")


def partition_stats(spark, sf_dir):
    items = classify.work_items(corpus(spark, sf_dir), DEFAULT)
    return distribute.partition_stats(distribute.spread(items, BUCKETS).select("bucket"))


def spread_by_bytes(spark, sf_dir):
    """Files dealt to partitions of even bytes, laid end to end in a mixed order."""
    return distribute.spread_by_bytes(corpus(spark, sf_dir).select("path", "length"), BUCKETS)


def byte_stats(spark, sf_dir):
    """Bytes by partition after that: none has more than the mean and the largest file."""
    dealt = distribute.spread_by_bytes(corpus(spark, sf_dir).select("path", "length"), BUCKETS)
    even = (F.col("max_bytes") <= F.col("avg_bytes") + F.col("largest_row")).alias("even")
    return distribute.byte_stats(dealt).select("min_bytes", "max_bytes", "avg_bytes", "largest_row", "partitions", even)


def partition_sizes(spark, sf_dir):
    items = classify.work_items(corpus(spark, sf_dir), DEFAULT)
    return distribute.partition_sizes(distribute.spread(items, BUCKETS).select("bucket"))


# Delivery


def json_events(spark, sf_dir):
    found = results(spark, sf_dir)
    parsed = found.select(json_document(found).alias("document")).select(
        F.from_json("document", RESULTS, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("r")
    )
    return extract.flat(parsed.select("r.*"))


def land_files(spark, sf_dir):
    area = sinks.land_files(corpus(spark, sf_dir), shared_dir(spark, "landing"))
    return src.only_files(area).select("path", "length", F.md5("content").alias("digest"))


def write_containers(spark, sf_dir):
    store = shared_dir(spark, "store")
    files = corpus(spark, sf_dir)
    sinks.write_containers(files, extract.extract_results(files, DEFAULT), store, "run")
    tables = ["event_source", "event_data_stream", EVENT_DATA, EXTRACTION_WARNING, RECOVERY_WARNING, "timeline", "parser_count"]
    sizes = [
        sinks.read_container(spark, store, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("container"), "rows")
        for t in tables
    ]
    found = sizes[0]
    for more in sizes[1:]:
        found = found.unionByName(more)
    return found


def atomic_sessions(spark, sf_dir):
    """What the store shows of a session whose rewrite is half done, and of one rewritten to the end."""
    store, files = shared_dir(spark, "store"), corpus(spark, sf_dir)
    everything = extract.extract_results(files, DEFAULT)
    few = extract.extract_results(files, select_extractors(DEFAULT, "filestat"))
    sinks.write_containers(files, everything, store, "kept")
    sinks.write_containers(files, few, store, "rewritten")
    # Written in whole, but its commit never comes.
    sinks.stage_containers(files, few, store, "kept")
    sinks.write_containers(files, everything, store, "rewritten")
    sinks.write_containers(files, few, store, "rewritten")
    shown = sinks.read_container(spark, store, "results")
    attr, val = (F.get(f("attributes"), F.lit(0)).alias(n) for f, n in ((F.map_keys, "attr"), (F.map_values, "val")))
    return shown.select("session_id", "container", "path", "parser", "seq", "message", attr, val)


def stored_run(spark, sf_dir):
    """A whole run into a store and a dry run: the completion row, the counts kept, and both responses."""
    store, files = shared_dir(spark, "store"), corpus(spark, sf_dir)
    run = pipeline.extract(spark, files, output=store)
    dry = pipeline.extract(spark, files, formatter="json", partitions=BUCKETS, dry_run=True).response
    session = run.response["session_id"]
    done = sinks.read_container(spark, store, "session", session).where(F.col("kind") == S.COMPLETION)
    kinds = sinks.read_container(spark, store, "session", session).groupBy("kind").agg(F.count("*").alias("n"))
    said = [("response", k, str(v)) for k, v in run.response.items() if k.startswith("number of")]
    said += [("dry run", "events", str(dry["events"])), ("dry run", "partitions", str(dry["skew_after"]["partitions"]))]
    rows = spark.createDataFrame(said, "part STRING, name STRING, value STRING")
    rows = rows.unionByName(done.select(F.lit("completion").alias("part"), F.explode("settings").alias("name", "value")))
    rows = rows.unionByName(kinds.select(F.lit("session").alias("part"), F.col("kind").alias("name"), F.col("n").cast("string").alias("value")))
    kept = sinks.read_parser_counts(spark, store)
    return rows.unionByName(kept.select(F.lit("kept").alias("part"), "name", F.col("number_of_events").cast("string").alias("value")))


QUERIES: dict[str, Query] = {
    "scan_files": scan_files,
    "scan_tree": scan_tree,
    "long_files": long_files,
    "long_signed_files": long_signed_files,
    "isolated_failures": isolated_failures,
    "raising_extractors": raising_extractors,
    "upload_report": upload_report,
    "only_files": only_files,
    "path_source": path_source,
    "read_range": read_range,
    "resolve_entries": resolve_entries,
    "missing_entries": missing_entries,
    "list_area": list_area,
    "list_tree": list_tree,
    "file_stat": file_stat,
    "event_sources": event_sources,
    "data_streams": data_streams,
    "signature_match": signature_match,
    "signature_match_table": signature_match_table,
    "signature_split": signature_split,
    "assign_nonsig": assign_nonsig,
    "filter_extractors": filter_extractors,
    "work_items": work_items,
    "unknown_extractor": unknown_extractor,
    "extract_results": extract_results,
    "filestat_events": filestat_events,
    "extraction_warnings": extraction_warnings,
    "recovery_warnings": recovery_warnings,
    "partial_results": partial_results,
    "results_timeline": results_timeline,
    "route_containers": route_containers,
    "run_summary": run_summary,
    "warning_counts": warning_counts,
    "parser_counts": parser_counts,
    "merge_parser_counts": merge_parser_counts,
    "parser_chain": parser_chain,
    "extract_tally": extract_tally,
    "session_record": session_record,
    "event_stream_join": event_stream_join,
    "emitted_streams": emitted_streams,
    "stream_runs": stream_runs,
    "stream_runs_global": stream_runs_global,
    "timeline": timeline_events,
    "normalize_time": normalize_time,
    "posix_times": posix_times,
    "text_files": text_files,
    "display_names": display_names,
    "path_functions": path_functions,
    "unpack_names": unpack_names,
    "source_disposition": source_disposition,
    "detect_kind": detect_kind,
    "decompress": decompress,
    "expand_archive": expand_archive,
    "unpack_recursive": unpack_recursive,
    "split_streams": split_streams,
    "decode_text": decode_documents,
    "repartition_buckets": repartition_buckets,
    "partition_stats": partition_stats,
    "partition_sizes": partition_sizes,
    "spread_by_bytes": spread_by_bytes,
    "byte_stats": byte_stats,
    "json_events": json_events,
    "land_files": land_files,
    "write_containers": write_containers,
    "atomic_sessions": atomic_sessions,
    "stored_run": stored_run,
}
