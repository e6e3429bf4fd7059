"""The same extraction over files as they arrive.

Every extraction step is a stateless row operator, so a stream needs nothing of
its own but the source and a sink that can be replayed.
"""

from collections.abc import Iterable
from dataclasses import asdict, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tracemill.operators.counts import run_summary
from tracemill.operators.extract import bind_settings, extract_results
from tracemill.operators.registry import DEFAULT, Extractor, select_extractors
from tracemill.plans.settings import COMPLETION, START, SYSTEM, Settings, enabled_names, session_row, system_values
from tracemill.plans.sinks import write_containers
from tracemill.sources.files import BINARY_FILE, from_binary_files


def arriving_files(spark: SparkSession, root: str) -> DataFrame:
    """Files as they arrive. One too long for a row stops the query with an
    error, and empty or hidden files are passed over by Spark's file stream;
    the batch scan handles both."""
    source = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    return from_binary_files(source.load(root))


def extract_arrivals(
    files: DataFrame,
    store: str,
    checkpoint: str,
    registry: Iterable[Extractor] = DEFAULT,
    name: str = "arrivals",
    extractors: str | None = None,
    settings: Settings = Settings(),
) -> StreamingQuery:
    """Extract all files that arrived since the last call into `store`, then stop.

    Settings and the filter expression act as in a batch run. A batch is one
    session of the store, named after its number, with its own session rows, so
    a batch that is run again after a failure replaces its own rows.
    """
    chosen = bind_settings(select_extractors(registry, extractors), asdict(settings))
    recorded = replace(settings, enabled_parser_names=enabled_names(chosen), parser_filter_expression=extractors)

    def write(batch: DataFrame, number: int) -> None:
        spark, session_id, began = batch.sparkSession, f"{name}-{number}", _now()

        def session_rows(written: DataFrame) -> DataFrame:
            totals = run_summary(written).first().asDict()
            rows = session_row(spark, session_id, START, began, recorded.as_map())
            rows = rows.unionByName(session_row(spark, session_id, SYSTEM, began, system_values(spark, settings)))
            done = {k: str(v) for k, v in totals.items()}
            return rows.unionByName(session_row(spark, session_id, COMPLETION, _now(), done))

        write_containers(batch, extract_results(batch, chosen), store, session_id, settings.storage_kind, session_rows)

    stream = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)
