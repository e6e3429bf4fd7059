"""The whole extraction: a source in, a store or JSON documents out."""

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracemill.operators import counts
from tracemill.operators.distribute import partition_stats, spread_by_bytes
from tracemill.operators.extract import bind_settings, items_with_content, run_extractors
from tracemill.operators.oversize import oversize_results
from tracemill.operators.registry import DEFAULT, UNREADABLE, Extractor, select_extractors
from tracemill.plans import settings as S
from tracemill.plans.formatters import format_results, get_formatter
from tracemill.plans.sinks import write_containers, write_json
from tracemill.sources.listing import exists
from tracemill.sources.files import MAX_CONTENT_BYTES, list_files, only_files, read_files
from tracemill.sources.lines import SPLIT_BYTES


@dataclass
class ExtractResult:
    files: DataFrame
    items: DataFrame
    results: DataFrame
    documents: DataFrame | None = None
    store: str | None = None
    response: dict = field(default_factory=dict)


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def extract(
    spark: SparkSession,
    source: str | DataFrame,
    formatter: str | None = None,
    output: str | None = None,
    extractors: str | None = None,
    partitions: int | None = None,
    dry_run: bool = False,
    registry: Iterable[Extractor] = DEFAULT,
    settings: S.Settings = S.Settings(),
    max_bytes: int = MAX_CONTENT_BYTES,
    long_root: str | Sequence[str] | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> ExtractResult:
    """Extract events from `source`, a folder or a files DataFrame.

    Files of a folder longer than `max_bytes` are read in splits of
    `split_bytes`. Files of a DataFrame that have no content were left below one of `long_root` and
    are read there in the same way.

    A file of a folder that can't be read gives a warning and its metadata, and
    the run goes on.

    Without a formatter the run is written to the store `output`; with one the
    documents are written there, or only planned if no output is given. A dry
    run counts results and delivers nothing. No result row passes the driver.
    """
    get_formatter(formatter)
    chosen = bind_settings(select_extractors(registry, extractors), asdict(settings))
    oversize, runs = None, chosen
    if isinstance(source, str):
        files = list_files(spark, source)
        if any(e.needs_content for e in chosen):
            readable = read_files(spark, source, max_bytes, skip_unreadable=True, listing=files)
            runs = (*chosen, UNREADABLE)
        else:
            readable = files.where(F.col("length") <= max_bytes).withColumn("content", F.lit(None).cast("binary"))
        if not files.where(F.col("length") > max_bytes).isEmpty():
            oversize = oversize_results(spark, source, chosen, max_bytes, listing=files, split_bytes=split_bytes)
    else:
        files = readable = only_files(source)
        left = files.where("content IS NULL").select("path")
        readers = [e for e in chosen if e.needs_content]
        roots = [long_root] if isinstance(long_root, str) else list(long_root or ())
        present = [root for root in roots if exists(root)]
        for root in present:
            found = oversize_results(spark, root, readers, max_bytes, left, split_bytes=split_bytes)
            oversize = found if oversize is None else oversize.unionByName(found)
        # Sizes tell which files can't have come with their content, so few rows are looked at.
        if readers and not present and not files.where((F.col("length") > max_bytes) & F.isnull("content")).isEmpty():
            lacking = f"none of {', '.join(roots)} exists" if roots else "no long_root is given"
            raise ValueError(f"some files have no content and {lacking} to read them from")
    items = items_with_content(readable, runs)
    response: dict = {}
    if dry_run:
        response["skew_before"] = partition_stats(items.select("parser")).first().asDict()
    if partitions:
        # Files are dealt out, not items, so content moves once.
        items = items_with_content(spread_by_bytes(readable, partitions).drop("bucket"), runs)
        if dry_run:
            response["skew_after"] = partition_stats(items.select("parser")).first().asDict()
    results = run_extractors(items, runs)
    if oversize is not None:
        results = results.unionByName(oversize)
    run = ExtractResult(files, items, results, response=response)

    if dry_run:
        started = time.monotonic()
        response["events"] = counts.extract_tally(results).first()["events"]
        response["extraction_time"] = time.monotonic() - started
        response["status"] = f"Events formatted to {formatter}" if formatter else "Events extracted"
        return run

    if formatter:
        run.documents = format_results(results, formatter)
        if output:
            started = time.monotonic()
            write_json(results, output, formatter)
            response["time"] = time.monotonic() - started
        response["status"] = f"Events formatted to {formatter}"
        return run

    if not output:
        raise ValueError("a store needs an output folder")
    session_id = uuid.uuid4().hex
    recorded = replace(
        settings, enabled_parser_names=S.enabled_names(chosen), parser_filter_expression=extractors
    )
    began, totals = _now(), {}

    def session_rows(written: DataFrame) -> DataFrame:
        totals.update(counts.run_summary(written).first().asDict())
        rows = S.session_row(spark, session_id, S.START, began, recorded.as_map())
        rows = rows.unionByName(S.session_row(spark, session_id, S.SYSTEM, began, S.system_values(spark, settings)))
        done = {k: str(v) for k, v in totals.items()}
        return rows.unionByName(S.session_row(spark, session_id, S.COMPLETION, _now(), done))

    write_containers(files, results, output, session_id, settings.storage_kind, session_rows)
    run.store = output
    response |= {
        "number of events": totals["events"],
        "number of warnings": totals["warnings"],
        "number of recovery": totals["recovery"],
        "status": f"Events saved to {output}",
        "session_id": session_id,
    }
    return run
