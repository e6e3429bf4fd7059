"""Time conversions. All results are zone-free UTC timestamps."""

from pyspark.sql import Column, functions as F


def from_posix_ns(ns: Column) -> Column:
    """POSIX nanoseconds to a timestamp; zero means the time is unknown."""
    micros = F.call_function("div", F.when(ns != 0, ns), F.lit(1000))
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / F.lit(1000000).cast("decimal(18,6)"))


def to_utc(local: Column, time_zone: str) -> Column:
    """A zone-free local time read in `time_zone`, moved to UTC."""
    return F.convert_timezone(F.lit(time_zone), F.lit("UTC"), local)


def in_year(ts: Column, year: int) -> Column:
    """A year-less time placed in the preferred year, its time of day kept; null if that year lacks the day."""
    seconds = F.date_part(F.lit("SECOND"), ts)
    return F.try_make_timestamp_ntz(F.lit(year), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), seconds)
