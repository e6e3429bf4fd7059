"""The timeline: one row per time of an event."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tracemill.schemas import NOT_A_TIME


def timeline(event_data: DataFrame, keys: Sequence[str] = ("path", "parser", "seq", "attributes")) -> DataFrame:
    """One row per known time of each event; an event without any gives one row saying so.

    Row-local: no shuffle, whatever the number of times.
    """
    known = F.filter("times", lambda t: t["timestamp"].isNotNull())
    return event_data.select(*keys, F.explode_outer(known).alias("at")).select(
        *keys,
        F.coalesce(F.col("at.timestamp_desc"), F.lit(NOT_A_TIME)).alias("timestamp_desc"),
        F.col("at.timestamp").alias("timestamp"),
    )


def times(**columns: str):
    """A `times` array from columns; names become descriptions with spaces for underscores."""
    return F.array(*[
        F.struct(F.lit(desc.replace("_", " ")).alias("timestamp_desc"), F.col(column).alias("timestamp"))
        for desc, column in columns.items()
    ])
