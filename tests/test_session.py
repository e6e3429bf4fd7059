import pytest

from tracemill import session
from tracemill.session import release, shared_dir, spool


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, **conf):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = "app"
        self.settings = conf

    def get(self, key, default):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_session():
    cluster = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = shared_dir(cluster, "x"), shared_dir(cluster, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://host:7077"), "x")
    assert "/tracemill-" in shared_dir(Session("local[2]"), "x")


def test_spooled_table_keeps_rows_and_prunes(spark):
    table = spool(spark.range(10).selectExpr("id", "id % 2 AS part", "id * 2 AS other"), "t", ("part",))
    assert sorted(map(tuple, table.select("id", "part", "other").collect())) == [(n, n % 2, 2 * n) for n in range(10)]
    plan = table.where("part = 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert spool(spark.range(0), "none").count() == 0


def test_release_deletes_what_the_session_made(spark, monkeypatch):
    import os

    monkeypatch.setattr(session, "_MADE", {})
    table = spool(spark.range(3), "short-lived")
    folder = table.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and release(spark) == 1
    assert not os.path.exists(folder) and release(spark) == 0
