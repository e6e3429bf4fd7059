"""Counts over results."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tracemill.schemas import EVENT_DATA, EXTRACTION_WARNING, RECOVERY_WARNING


def parser_counts(results: DataFrame) -> DataFrame:
    """Events per extractor chain."""
    events = results.where(F.col("container") == EVENT_DATA)
    return events.groupBy(F.col("parser").alias("name")).agg(F.count("*").alias("number_of_events"))


def run_counters(results: DataFrame) -> DataFrame:
    """Both counters a run keeps per extractor chain, in one pass: events made,
    and events the timeline has a time for."""
    timed = F.exists("times", lambda t: t["timestamp"].isNotNull())
    events = results.where(F.col("container") == EVENT_DATA)
    both = events.groupBy(F.col("parser").alias("name")).agg(
        F.count("*").alias("made"), F.count_if(timed).alias("timed")
    )
    counters = F.map_from_arrays(F.array(F.lit("made"), F.lit("timed")), F.array("made", "timed"))
    return both.select("name", F.explode(counters).alias("counter", "number_of_events")).where("number_of_events > 0")


def merge_parser_counts(*counters: DataFrame) -> DataFrame:
    """Counters added up by name; a name new to one side starts from the other's count."""
    everything = reduce(DataFrame.unionByName, (c.select("name", "number_of_events") for c in counters))
    return everything.groupBy("name").agg(F.sum("number_of_events").alias("number_of_events"))


def _count(container: str) -> Column:
    return F.count_if(F.col("container") == container)


def warning_counts(results: DataFrame) -> DataFrame:
    """Warnings per extractor chain and kind."""
    warnings = results.where(F.col("container").isin(EXTRACTION_WARNING, RECOVERY_WARNING))
    return warnings.groupBy(F.col("parser").alias("parser_chain"), "container").agg(F.count("*").alias("n"))


def run_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        _count(EVENT_DATA).alias("events"),
        _count(EXTRACTION_WARNING).alias("warnings"),
        _count(RECOVERY_WARNING).alias("recovery"),
    )


def extract_tally(results: DataFrame) -> DataFrame:
    """All result rows of a dry run: events and both kinds of warnings."""
    tally = sum((_count(c) for c in (EXTRACTION_WARNING, RECOVERY_WARNING)), _count(EVENT_DATA))
    return results.agg(tally.alias("events"))


def route_containers(results: DataFrame) -> dict[str, DataFrame]:
    """The three result tables."""
    return {c: results.where(F.col("container") == c) for c in (EVENT_DATA, EXTRACTION_WARNING, RECOVERY_WARNING)}
