import random

import pytest
from pyspark.sql import functions as F

from tracemill.operators import associate


def naive_runs(rows):
    """rows of (group, order, path) in order."""
    out, last = [], {}
    for group, order, path in rows:
        if group not in last or last[group] != path:
            out.append((group, order, path))
        last[group] = path
    return out


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
@pytest.mark.parametrize("hot", [0.34, 1.0])
def test_runs_across_partitions(spark, partitions, hot):
    rng = random.Random(7)
    rows = [
        ("hot" if rng.random() < hot else rng.choice("abcd"), n, rng.choice(["p", "p", "q", None]))
        for n in range(3000)
    ]
    df = spark.createDataFrame(rows, "g STRING, n INT, path STRING").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        grouped = associate.stream_runs(df, order=("n",), group=("g",)).collect()
        whole = associate.stream_runs(df, order=("n",)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(((r["g"], r["n"], r["path"]) for r in grouped), key=lambda r: r[1]) == naive_runs(rows)
    flat = [("", n, path) for _, n, path in rows]
    assert sorted((("", r["n"], r["path"]) for r in whole), key=lambda r: r[1]) == naive_runs(flat)


def test_runs_of_nothing(spark):
    df = spark.createDataFrame([], "g STRING, n INT, path STRING")
    assert associate.stream_runs(df, order=("n",), group=("g",)).count() == 0


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_skewed_event_join_equals_plain_join(spark, hot_rows):
    rng = random.Random(3)
    paths = [None if n % 5 == 0 else "/hot" if n % 3 == 0 else f"/p{rng.randrange(400)}" for n in range(3000)]
    events = spark.createDataFrame(list(enumerate(paths)), "event_id INT, path STRING")
    streams = spark.createDataFrame(
        [(n, f"/p{n % 300}") for n in range(900)] + [(5000, "/hot"), (4000, "/hot")], "stream_id INT, path STRING"
    )
    got = associate.event_stream_join(events, streams, hot_rows=hot_rows).collect()
    first = {f"/p{n}": n for n in range(300)} | {"/hot": 4000}
    assert len(got) == 3000
    for row in got:
        assert row["path"] == paths[row["event_id"]]
        assert row["stream_id"] == first.get(row["path"])
        assert row["stream_path"] == (row["path"] if row["path"] in first else None)


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    hot = dict(associate.hot_keys(df, "k", hot_rows=100))
    assert set(hot) == {"hot"} and 60 <= hot["hot"] <= 67


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_emitted_streams(spark, hot_rows):
    streams = spark.createDataFrame([(1, "/a"), (2, "/b"), (3, "/a")], "stream_id INT, path STRING")
    events = spark.createDataFrame([(n, "/a") for n in range(50)], "event_id INT, path STRING")
    assert sorted(r["stream_id"] for r in associate.emitted_streams(streams, events, hot_rows=hot_rows).collect()) == [1, 3]
