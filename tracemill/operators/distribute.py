"""Spreading work items over partitions and measuring the spread."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tracemill.session import spool


def bucket(partitions: int, *keys: str) -> Column:
    """A stable bucket in [0, partitions) from the row's own keys.

    It spreads a hot file or extractor as evenly as a random draw would, and a
    task that is run again puts every row where it was before.
    """
    digest = F.md5(F.concat_ws("|", *keys).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(partitions)).cast("int")


def spread(items: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Items moved to exactly `partitions` partitions by their bucket."""
    keys = keys or ("path", "parser")
    placed = items.withColumn("bucket", bucket(partitions, *keys))
    return placed.repartitionById(partitions, "bucket")


def place_of(*keys: str) -> Column:
    """A number below 2^60 by which rows are put in a mixed order that is the same in every run."""
    digest = F.md5(F.concat_ws("|", *keys).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def running_bytes(sized: DataFrame, size: str = "length") -> DataFrame:
    """Rows `(place, size)` with `before`, the bytes of all rows of lesser place, and `total`.

    Sums are made where the rows are, after one shuffle into ranges of place; a
    table of one row per range then joins them up, so no task sees all rows.
    """
    by_place = sized.groupBy("place").agg(F.sum(size).cast("bigint").alias("bytes"))
    ranges = spool(by_place.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "ranges")
    parts = ranges.groupBy("part").agg(F.sum("bytes").alias("held"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(
        "part", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("ahead"), F.sum("held").over(everything).alias("total")
    )
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    return ranges.join(F.broadcast(parts), "part").select("place", "bytes", before.alias("before"), "total")


# Buckets up to which their borders are part of the plan.
MAX_CUTS = 1000


def byte_buckets(files: DataFrame, partitions: int, size: str = "length", key: str = "path") -> DataFrame:
    """`(place, bucket)` of all files: a bucket holds those that begin in its share of all bytes, laid end to end."""
    sized = files.select(place_of(key).alias("place"), F.coalesce(F.col(size), F.lit(0)).alias(size))
    share = F.floor(F.col("before") / F.greatest(F.col("total"), F.lit(1)) * partitions)
    return running_bytes(sized, size).select("place", F.least(share, F.lit(partitions - 1)).cast("int").alias("bucket"))


def spread_by_bytes(files: DataFrame, partitions: int, size: str = "length", key: str = "path", max_cuts: int = MAX_CUTS) -> DataFrame:
    """Files moved to exactly `partitions` partitions of even bytes, with their `bucket`.

    A partition's bytes are at most the mean and the largest file's. Where the
    borders lie is found from names and sizes alone, in a mixed order, so a task
    that is run again puts every file where it was before. Up to `max_cuts`
    partitions the borders become part of the plan and content moves once;
    beyond, buckets are joined to the files, which suits listings.
    """
    buckets = byte_buckets(files, partitions, size, key)
    if partitions > max_cuts:
        placed = files.withColumn("_place", place_of(key)).join(buckets.withColumnRenamed("place", "_place"), "_place")
        return placed.drop("_place").repartitionById(partitions, "bucket")
    cuts = buckets.groupBy("bucket").agg(F.min("place").alias("place")).orderBy("bucket").collect()
    place, bucket = place_of(key), F.lit(0)
    if cuts:
        borders = F.array(*[F.lit(r["place"]).cast("bigint") for r in cuts])
        numbers = F.array(*[F.lit(r["bucket"]) for r in cuts])
        # In a lambda the place is a variable; as an expression it would be computed again for every border.
        passed = F.transform(F.array(place), lambda p: F.size(F.filter(borders, lambda border: border <= p)))[0]
        bucket = F.element_at(numbers, F.greatest(passed, F.lit(1)))
    return files.withColumn("bucket", bucket.cast("int")).repartitionById(partitions, "bucket")


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    rows = sum(batch.num_rows for batch in batches)
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([rows], pa.int64())],
        ["partition", "rows"],
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows in each partition of `df`, empty partitions included."""
    return df.mapInArrow(_count_rows, "partition INT, rows BIGINT")


def partition_stats(df: DataFrame) -> DataFrame:
    """Smallest, largest and mean partition and their number.

    Counts are taken where the rows are; grouping by partition id instead would
    not see the empty partitions.
    """
    return partition_sizes(df).agg(
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.avg("rows").alias("avg_rows"),
        F.count("*").alias("partitions"),
    )


def byte_stats(df: DataFrame, size: str = "length") -> DataFrame:
    """Bytes of the smallest, largest and mean partition, of the largest row, and the number of partitions."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = largest = 0
        for batch in batches:
            sizes = [n or 0 for n in batch.column(0).to_pylist()]
            total, largest = total + sum(sizes), max([largest, *sizes])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([largest], pa.int64())], ["bytes", "largest"])

    return df.select(size).mapInArrow(measure, "bytes BIGINT, largest BIGINT").agg(
        F.min("bytes").alias("min_bytes"), F.max("bytes").alias("max_bytes"), F.avg("bytes").alias("avg_bytes"),
        F.max("largest").alias("largest_row"), F.count("*").alias("partitions"),
    )
