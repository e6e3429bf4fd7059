"""Associating events with the data streams they came from."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tracemill.session import spool

# A key with more than this share of the rows, and enough of them to matter, is
# split. At most 1 / HOT_SHARE keys can be, which bounds the list of hot keys.
HOT_SHARE = 0.005
HOT_KEYS = int(1 / HOT_SHARE)
HOT_ROWS = 1_000_000


def event_sources(files: DataFrame, kind: str) -> DataFrame:
    return files.select(F.lit(kind).alias("file_entry_type"), "path")


def data_streams(files: DataFrame) -> DataFrame:
    return files.select("path")


def first_streams(streams: DataFrame, order: str = "stream_id") -> DataFrame:
    """The earliest stream of each location; combined before the shuffle."""
    return streams.groupBy("path").agg(F.min(order).alias(order))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list[tuple]:
    """Keys holding much of `df` and into how many parts to split each; at most `HOT_KEYS`.

    One mergeable sketch finds them, so nothing is shuffled by key. A key it
    misses costs time only: results do not depend on the list. Rows without a
    key are listed under None.
    """
    found = df.agg(
        F.expr(f"approx_top_k({key}, {HOT_KEYS}, {64 * HOT_KEYS})").alias("top"),
        F.count_if(F.col(key).isNull()).alias("keyless"),
        F.count("*").alias("total"),
    )
    share = F.col("count") / F.col("total")
    keyless = F.array(F.struct(F.lit(None).alias("item"), F.col("keyless").alias("count")))
    named = F.filter("top", lambda t: t["item"].isNotNull())
    hot = (
        found.select("total", F.inline(F.concat(named, keyless)))
        .where((share > HOT_SHARE) & (F.col("count") > hot_rows))
        .select("item", F.ceil(share / HOT_SHARE).cast("int").alias("parts"))
    )
    return [tuple(row) for row in hot.collect()]


def skew_left_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left equi-join on `key`, `right` unique per key, safe when one key holds much of `left`.

    Rows of a hot key are cut into parts by a hash of `spread_by`, and the one
    matching row on the right is repeated per part. The list of hot keys is
    taken once, so both sides agree on the parts. Without hot keys it is the
    plain join.
    """
    hot = hot_keys(left, key, hot_rows)
    if not hot:
        return left.join(right, key, "left")
    schema = f"hot_key {left.schema[key].dataType.simpleString()}, parts INT"
    table = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    is_hot = F.col(key).eqNullSafe(F.col("hot_key"))
    cut = left.join(table, is_hot, "left").withColumn("part", part).drop("parts", "hot_key")
    repeated = right.join(table, is_hot, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return cut.join(repeated.drop("parts", "hot_key"), [key, "part"], "left").drop("part")


def event_stream_join(
    events: DataFrame, streams: DataFrame, event_key: Sequence[str] = ("event_id",), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each event with the first stream of its location, null where there is none."""
    first = first_streams(streams).withColumn("stream_path", F.col("path"))
    return skew_left_join(events, first, "path", event_key, hot_rows)


def emitted_streams(
    streams: DataFrame, events: DataFrame, stream_key: Sequence[str] = ("stream_id",), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Streams that own at least one event. Locations are made distinct first,
    so a location with many events is one row in the shuffle."""
    owning = events.select("path").distinct().withColumn("owned", F.lit(True))
    return skew_left_join(streams, owning, "path", stream_key, hot_rows).where("owned").drop("owned")


def _differs(a: pa.Array, b: pa.Array) -> pa.Array:
    """Null-safe inequality."""
    return pc.or_(
        pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))
    )


def _mark_runs(group: Sequence[str], location: str):
    watched = [*group, location]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = pa.array([False] * batch.num_rows)
            for name in watched:
                now = batch.column(name)
                before = pa.concat_arrays([last.column(name) if last else now.slice(0, 1), now.slice(0, len(now) - 1)])
                changed = pc.or_(changed, _differs(before, now))
            edge = pc.if_else(changed, pa.scalar("run"), pa.scalar(None, pa.string()))
            if last is None:
                edge = pa.concat_arrays([pa.array(["head"]), edge.slice(1)])
            keep = pc.is_valid(edge)
            out = batch.append_column("edge", edge).append_column("task", pa.array([task] * len(edge), pa.int32()))
            yield out.filter(keep)
            last = batch.slice(batch.num_rows - 1, 1)
        if last is not None:
            yield last.append_column("edge", pa.array(["tail"])).append_column("task", pa.array([task], pa.int32()))

    return mark


def stream_runs(events: DataFrame, order: Sequence[str], group: Sequence[str] = (), location: str = "path") -> DataFrame:
    """Events at which the location differs from the event before, within `group` and by `order`.

    A window would sort each group in one task, and with no group everything in
    one. Here rows are range-partitioned by group and order, so a group of any
    size spans as many partitions as it needs. Each partition compares
    neighbours locally, and only its first row has to be judged against the
    last row of the partition before: a table of one row per partition.
    """
    keys = [*group, *order]
    columns = list(dict.fromkeys([*keys, location]))
    ranged = events.select(*columns).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    marked = spool(ranged.mapInArrow(_mark_runs(group, location), f"{schema}, edge STRING, task INT"), "runs", ("edge",))

    watched = [*group, location]
    tails = marked.where(F.col("edge") == "tail").select("task", F.struct(*watched).alias("ended"))
    heads = marked.where(F.col("edge") == "head").withColumn("began", F.struct(*watched))
    # One row per non-empty partition on each side, so one small window.
    borders = tails.unionByName(heads.select("task", "began"), allowMissingColumns=True).groupBy("task").agg(
        F.first("ended", ignorenulls=True).alias("ended"), F.first("began", ignorenulls=True).alias("began")
    )
    before = F.lag("ended").over(Window.orderBy("task"))
    starts = borders.withColumn("before", before).where(~F.col("before").eqNullSafe(F.col("began"))).select("task")
    runs = marked.where(F.col("edge") == "run").select(*columns)
    return runs.unionByName(heads.join(F.broadcast(starts), "task", "left_semi").select(*columns))
