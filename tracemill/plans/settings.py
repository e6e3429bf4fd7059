"""Run settings, recorded with each session."""

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracemill.operators.registry import Extractor

SESSION = "session_id STRING, kind STRING, started TIMESTAMP_NTZ, settings MAP<STRING, STRING>"

START = "start"
SYSTEM = "system"
COMPLETION = "completion"


@dataclass(frozen=True)
class Settings:
    """Frozen on the driver; what a stage needs travels as literals in its plan."""

    artifact_filters: str | None = None
    command_line_arguments: str | None = None
    debug_mode: bool = False
    enabled_parser_names: str | None = None
    extract_winevt_resources: bool = True
    filter_file_path: str | None = None
    parser_filter_expression: str | None = None
    preferred_codepage: str = "cp1252"
    preferred_encoding: str = "utf-8"
    preferred_language: str = "en-US"
    preferred_time_zone: str = "UTC"
    preferred_year: int | None = None
    storage_kind: str = "FILE"

    def as_map(self) -> dict[str, str | None]:
        return {k: None if v is None else str(v) for k, v in asdict(self).items()}


def system_values(spark: SparkSession, settings: Settings) -> dict[str, str | None]:
    """What a reader of the store needs to know about the system that wrote it."""
    return {
        "code_page": settings.preferred_codepage,
        "language": settings.preferred_language,
        "time_zone": settings.preferred_time_zone,
        "spark_version": spark.version,
    }


def enabled_names(registry: Iterable[Extractor]) -> str:
    return ",".join(e.name for e in registry)


def session_row(
    spark: SparkSession, session_id: str, kind: str, at: datetime, values: dict[str, str | None]
) -> DataFrame:
    return spark.createDataFrame([(session_id, kind, at, values)], SESSION)


def enabled_parsers(sessions: DataFrame) -> DataFrame:
    """The enabled extractors of each session in the order they were given."""
    names = F.split(F.col("settings")["enabled_parser_names"], ",")
    return sessions.select("session_id", F.posexplode(names).alias("pos", "enabled_parser")).select(
        "session_id", (F.col("pos") + 1).cast("bigint").alias("ordinal"), "enabled_parser"
    )
