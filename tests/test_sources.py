import io
import os
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracemill.operators import distribute
from tracemill.plans import queries, sinks
from tracemill.session import spool
from tracemill.sources import files as src, lines, listing


@pytest.fixture
def tree(make_files):
    return make_files({"/a/b/one.txt": b"1", "/a/b/two.txt": b"22", "/a/c/d/x": b"", "/top": b"t"})


def test_scan_reads_a_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a b.txt").write_bytes(b"abc")
    (tmp_path / "c.bin").write_bytes(b"\x00\x01")
    rows = {r["name"]: r for r in src.scan_files(spark, str(tmp_path)).collect()}
    assert rows["a b.txt"]["path"] == f"{tmp_path}/sub/a b.txt"
    assert rows["a b.txt"]["parent"] == f"{tmp_path}/sub"
    assert (rows["c.bin"]["length"], bytes(rows["c.bin"]["content"])) == (2, b"\x00\x01")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_file_times_are_utc(spark, tmp_path, zone):
    (tmp_path / "f").write_bytes(b"")
    os.utime(tmp_path / "f", (1704164645, 1704164645))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert src.scan_files(spark, str(tmp_path)).first()["mtime"] == datetime(2024, 1, 2, 3, 4, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scan_prunes_content_and_pushes_length(spark, tmp_path):
    (tmp_path / "c.bin").write_bytes(b"\x00\x01")
    plan = src.scan_files(spark, str(tmp_path)).select("path", "length").where("length > 1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema")[1]
    assert "LessThanOrEqual(length" in text and "GreaterThan(length" in text


def test_manifest_rejects_an_empty_location(spark):
    good = spark.createDataFrame([("/a",)], "path STRING")
    assert src.path_manifest(good).count() == 1
    bad = spark.createDataFrame([("/a",), ("",)], "path STRING")
    with pytest.raises(Exception, match="needs a location"):
        src.path_manifest(bad).collect()


def test_read_range(spark):
    df = spark.createDataFrame([(bytearray(b"abcdef"),)], "c BINARY")
    c = F.col("c")
    row = df.select(src.read_range(c, 1, 2), src.read_range(c, -2), src.read_range(c, 4, 99), src.read_range(c, 2)).first()
    assert [bytes(v) for v in row] == [b"bc", b"ef", b"ef", b"cdef"]


def test_tree_and_listing(spark, tree):
    counts = {r["parent"]: r["children"] for r in src.list_tree(tree).collect()}
    assert counts == {"/": 2, "/a": 2, "/a/b": 2, "/a/c": 1, "/a/c/d": 1}
    listing = src.entries(tree)
    folders = {r["path"] for r in listing.where("entry_type = 'directory'").collect()}
    assert folders == {"/", "/a", "/a/b", "/a/c", "/a/c/d"}
    assert src.only_files(listing).count() == 4
    assert {r["path"] for r in src.children(listing, "/a").collect()} == {"/a/b", "/a/c"}
    assert {r["path"] for r in src.within_depth(src.only_files(listing), "/a", 2).collect()} == {"/a/b/one.txt", "/a/b/two.txt"}
    assert src.within_depth(listing, "/a").count() == 6
    assert {r["path"] for r in src.within_depth(listing, "/", 1).collect()} == {"/a", "/top"}


def test_resolve(spark, tree):
    wanted = spark.createDataFrame([("/top",), ("/gone",)], "path STRING")
    got = {r["path"]: (r["present"], r["length"]) for r in src.resolve_entries(wanted, tree).collect()}
    assert got == {"/top": (True, 1), "/gone": (False, None)}
    assert [r["path"] for r in src.missing_entries(wanted, tree).collect()] == ["/gone"]


def test_scan_sees_empty_and_hidden_files_and_folders(spark, tmp_path):
    tree = {"a.txt": b"a", "empty": b"", ".hidden": b"h", "_under/deep/f": b"u", "_under/.x": b"", "k=v/p": b"p", "sp ace/%41": b"%"}
    for name, body in tree.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)
    (tmp_path / "bare").mkdir()
    got = {r["path"][len(str(tmp_path)) + 1 :]: r for r in src.scan_files(spark, str(tmp_path)).collect()}
    assert {name: bytes(r["content"]) for name, r in got.items()} == tree
    assert all(r["length"] == len(tree[name]) and r["parent"].startswith(str(tmp_path)) for name, r in got.items())
    listed = src.list_entries(spark, str(tmp_path))
    folders = {r["path"][len(str(tmp_path)) + 1 :] for r in listed.where("entry_type = 'directory'").collect()}
    assert folders == {"_under", "_under/deep", "k=v", "sp ace", "bare"}
    assert src.only_files(listed).count() == len(tree)
    assert {r["name"] for r in src.list_files(spark, f"file://{tmp_path}", 0).collect()} == {"a.txt", ".hidden", "f", "p", "%41"}


def test_listing_of_an_empty_folder(spark, tmp_path):
    assert src.list_entries(spark, str(tmp_path)).count() == 0
    assert src.scan_files(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("spelling", ["{}", "{}/", "/{}//", "{}/./"])
def test_root_is_read_once_however_it_is_spelt(spark, tmp_path, spelling):
    folder = tmp_path / "odd [a]{b}*"
    folder.mkdir()
    (folder / "x").write_bytes(b"x")
    (folder / ".y").write_bytes(b"")
    got = src.scan_files(spark, spelling.format(folder)).collect()
    assert sorted(r["path"] for r in got) == [f"{folder}/.y", f"{folder}/x"]


def test_many_empty_files_are_many_tasks(spark, tmp_path, monkeypatch):
    for k in range(40):
        (tmp_path / f"e{k}").write_bytes(b"")
    monkeypatch.setattr(listing, "TASK_BYTES", 10 * listing.OPEN_BYTES)
    read = listing.read_contents(src.list_files(spark, str(tmp_path)))
    assert read.count() == 40 and read.rdd.getNumPartitions() == 4


def test_unreadable_files_are_skipped_and_shown(spark, tmp_path):
    (tmp_path / "gone").write_bytes(b"1")
    (tmp_path / "here").write_bytes(b"2")
    listed = spool(src.list_files(spark, str(tmp_path)), "listed")
    (tmp_path / "gone").unlink()
    got = {r["name"]: r["content"] for r in listing.read_contents(listed, skip_unreadable=True).collect()}
    assert got == {"gone": None, "here": b"2"}


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_lines_of_splits_are_those_of_the_file(chunk, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK_BYTES", chunk)
    for data in (b"", b"a", b"a\n", b"\n\n", b"ab\r\ncd\re\n\xef\xbb\xbff", b"long" * 20 + b"\nx"):
        want = data.split(b"\n")
        want = want if want[-1] else want[:-1]
        for size in (1, 2, 5, 100):
            got = [x for a in range(0, len(data), size) for x in lines.split_lines(io.BytesIO(data), a, min(len(data), a + size))]
            assert got == want


def _sources(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("query", [queries.scan_tree, queries.text_files])
def test_written_files_are_read_without_a_file_index(spark, query):
    """They are listed and dealt out by the executors; the binary file source would list them on the driver."""
    assert "binaryFile" not in _sources(query(spark, "/root/testdata/sf0.001"))


def test_entries_of_many_folders_share_a_batch(tmp_path):
    for k in range(50):
        (tmp_path / f"d{k}").mkdir()
        (tmp_path / f"d{k}" / "f").write_bytes(b"1")
    folders = pa.RecordBatch.from_pydict({"uri": [f"{tmp_path}/d{k}" for k in range(50)]})
    found = list(listing._list(iter([folders])))
    assert len(found) == 1 and sorted(found[0]["uri"].to_pylist()) == sorted(f"{tmp_path}/d{k}/f" for k in range(50))


def test_short_files_share_a_task(spark):
    """A task's start costs as much as some hundred openings."""
    assert listing.task_count(spark, 0, 0) == 1 and listing.task_count(spark, 0, 64) == 1
    assert listing.task_count(spark, 0, 256) == spark.sparkContext.defaultParallelism
    assert listing.task_count(spark, 0, 1_000_000) <= 1_000_000 // 4000
    assert listing.task_count(spark, 10 * listing.TASK_BYTES, 10) == 11 - 1


def test_places_are_computed_once_a_file(spark, make_files):
    files = make_files({f"/f{k}": b"x" * k for k in range(100)})
    dealt = distribute.spread_by_bytes(files, 16)
    assert "<= cast(conv" not in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.count() == 100 and dealt.select("bucket").distinct().count() == 16


def test_tasks_that_fill_one_folder_leave_whole_files_only(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).selectExpr("concat('/a/', id) AS path", "CAST(CAST(id AS STRING) AS BINARY) AS content")
    assert sinks.write_files(rows, str(tmp_path)) == 40
    assert [p.name for p in tmp_path.iterdir()] == ["a"] and len(list((tmp_path / "a").iterdir())) == 40


def test_lines_of_short_files_share_a_batch(tmp_path):
    for k in range(30):
        (tmp_path / f"f{k}").write_bytes(b"a%d\nb\n\nc" % k)
    rows = [{"uri": f"{tmp_path}/f{k}", "path": f"/f{k}", "name": f"f{k}", "length": 9, "mtime": None, "start": 0, "stop": 9, "first": k} for k in range(30)]
    found = list(lines._cut(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(found) == 1
    assert [(r["path"], r["seq"], r["line"]) for r in found[0].to_pylist()] == [
        (f"/f{k}", k + n, line) for k in range(30) for n, line in enumerate([b"a%d" % k, b"b", b"", b"c"])
    ]
