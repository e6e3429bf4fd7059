import gzip
import json

import pytest
from pyspark.sql import functions as F

from tracemill.operators import extract
from tracemill.operators.registry import DEFAULT
from tracemill.plans import formatters, sinks
from tracemill.plans.pipeline import extract as run_extract
from tracemill.plans.uploads import ingest
from tracemill.plans.settings import Settings, enabled_parsers
from tracemill.sources import files as src, lines as line_source
from tracemill.streaming.landing import arriving_files, extract_arrivals

FILES = {
    "/d/page.html": b"<!DOCTYPE html><title>\xc3\xa9</title>",
    "/d/e/obj.json": b'{"k": "v"}',
    "/text.txt": b"one\ntwo\n" + b"y" * 2100,
}
EVENTS, WARNINGS, RECOVERY = 3 + 2 + 1 + 3, 1, 1


@pytest.fixture
def results(make_files):
    return extract.extract_results(make_files(FILES), DEFAULT)


def fill(folder):
    for path, body in FILES.items():
        target = folder / path[1:]
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)
    return str(folder)


def as_python(row):
    value = row.asDict(recursive=True)
    for at in value["times"]:
        at["timestamp"] = at["timestamp"].strftime("%Y-%m-%dT%H:%M:%S.%f")
    return value


def test_json_documents_hold_the_rows(results):
    rows = results.withColumn("document", formatters.json_document(results)).collect()
    assert len(rows) == EVENTS + WARNINGS + RECOVERY
    for row in rows:
        document = row["document"]
        wanted = as_python(row)
        wanted.pop("document")
        assert json.loads(document) == wanted
        assert list(json.loads(document)) == sorted(wanted)
        assert document.isascii() and "\n" in document


def test_indented_documents_equal_pythons(results):
    rows = results.withColumn("document", formatters.get_formatter("json-indent4")(results)).collect()
    for row in rows:
        wanted = as_python(row)
        wanted.pop("document")
        assert row["document"] == json.dumps(wanted, indent=4, sort_keys=True)


def test_formatter_registry():
    assert formatters.get_formatter(None) is formatters.get_formatter("") is None
    with pytest.raises(ValueError, match="unknown formatter"):
        formatters.get_formatter("nonesuch")
    formatters.register_formatter("twice", lambda df: F.lit(1))
    formatters.register_formatter("twice", last := lambda df: F.lit(2))
    assert formatters.get_formatter("twice") is last


def test_landing_keeps_files_and_empty_folders(spark, make_files, tmp_path):
    out = str(tmp_path / "landing")
    empty = spark.createDataFrame([("/d/empty",)], "path STRING")
    area = sinks.land_files(make_files(FILES), out, empty)
    sinks.land_files(sinks.text_files(spark.createDataFrame([("/note", "ž")], "path STRING, text STRING")), out)
    held = {r["path"]: r for r in sinks.landed(spark, out).collect()}
    assert {p for p, r in held.items() if r["entry_type"] == "file"} == {*FILES, "/note"}
    assert held["/d/empty"]["entry_type"] == "directory"
    assert bytes(held["/note"]["content"]) == "ž".encode() and held["/note"]["length"] == 2
    wanted = spark.createDataFrame([("/note",), ("/lost",)], "path STRING")
    report = {r["path"]: r["ok"] for r in sinks.landing_report(wanted, sinks.landed(spark, out)).collect()}
    assert report == {"/note": True, "/lost": False}
    plan = src.only_files(area).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entry_type" in plan


def test_store_run_and_second_run(spark, tmp_path):
    source, store = fill(tmp_path / "in"), str(tmp_path / "store")
    first = run_extract(spark, source, output=store, extractors="!markup", settings=Settings(preferred_year=2020))
    response = first.response
    assert (response["number of events"], response["number of warnings"], response["number of recovery"]) == (
        EVENTS - 1, WARNINGS, RECOVERY,
    )
    sizes = {name: sinks.read_container(spark, store, name).count() for name in (
        "event_source", "event_data_stream", "event_data", "extraction_warning", "recovery_warning", "timeline", "session")}
    assert sizes == {
        "event_source": 3, "event_data_stream": 3, "event_data": EVENTS - 1, "extraction_warning": 1,
        "recovery_warning": 1, "timeline": EVENTS - 1, "session": 3,
    }
    times = sinks.read_container(spark, store, "timeline").groupBy("timestamp_desc").count().collect()
    assert dict(map(tuple, times)) == {"Modification Time": 4, "Not a time": EVENTS - 5}
    once = dict(map(tuple, sinks.read_parser_counts(spark, store).collect()))
    assert once == {"filestat": 3, "html": 1, "json/kv": 1, "text": 3}

    sessions = sinks.read_container(spark, store, "session")
    start = sessions.where("kind = 'start'")
    assert start.first()["settings"]["preferred_year"] == "2020"
    assert len(start.first()["settings"]) == 13
    assert sessions.where("kind = 'system'").first()["settings"]["time_zone"] == "UTC"
    named = {r["ordinal"]: r["enabled_parser"] for r in enabled_parsers(start).collect()}
    assert named == {1: "html", 2: "json", 3: "text", 4: "filestat"}
    assert sessions.where("kind = 'completion'").first()["settings"]["events"] == str(EVENTS - 1)

    run_extract(spark, source, output=store, extractors="!markup")
    twice = dict(map(tuple, sinks.read_parser_counts(spark, store).collect()))
    assert twice == {name: 2 * n for name, n in once.items()}
    assert sinks.read_container(spark, store, "event_data", response["session_id"]).count() == EVENTS - 1


def test_writing_a_session_again_replaces_it(spark, make_files, results, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        sinks.write_containers(make_files(FILES), results, store, "same")
    sinks.write_containers(make_files(FILES), results, store, "other")
    assert sinks.read_container(spark, store, "event_data").count() == 2 * EVENTS
    assert sinks.read_container(spark, store, "event_data", "same").count() == EVENTS


def test_a_rewrite_shows_when_it_is_complete(spark, make_files, results, tmp_path, monkeypatch):
    """Readers see the old rows until the commit, and a run that died leaves nothing but what vacuum takes away."""
    store = str(tmp_path / "store")
    assert sinks.snapshot(spark, store).count() == 0
    sinks.write_containers(make_files(FILES), results, store, "same")
    before = sinks.read_container(spark, store, "results")
    rows = lambda df: sorted(str(r) for r in df.collect())
    old = rows(before)
    few = results.where("parser = 'filestat'")
    version = sinks.stage_containers(make_files(FILES), few, store, "same")
    assert rows(sinks.read_container(spark, store, "results")) == old
    assert rows(sinks.read_container(spark, store, "results", "same")) == old
    sinks.stage_containers(make_files(FILES), few, store, "never")
    assert sinks.read_container(spark, store, "event_source", "never").count() == 0
    sinks.commit_session(spark, store, "same", version)
    shown = sinks.read_container(spark, store, "results", "same")
    assert shown.count() == few.count() and shown.columns == before.columns
    for container in ("event_data_stream", "timeline", "event_source"):
        assert sinks.read_container(spark, store, container).count() == 3
    assert dict(map(tuple, sinks.read_parser_counts(spark, store).collect())) == {"filestat": 3}
    plan = sinks.read_container(spark, store, "results")._jdf.queryExecution().executedPlan().toString()
    assert "version" in plan.split("PartitionFilters: [")[1].split("]")[0]
    monkeypatch.setattr(sinks, "PLANNED_VERSIONS", 0)
    assert rows(sinks.read_container(spark, store, "results")) == rows(shown)
    assert sinks.vacuum(spark, store) == 0
    assert sinks.vacuum(spark, store, older_than=0) == 2
    assert sinks.read_container(spark, store, "results").count() == few.count()
    assert sinks.vacuum(spark, store, older_than=0) == 0


def test_uploads_with_vanished_files_and_empty_folders(spark, tmp_path):
    """One file that can't be read is reported and ends neither the upload nor a run over the folder."""
    from tracemill.plans.uploads import UNREAD, upload
    from tracemill.session import spool

    up = tmp_path / "up"
    (up / "bare" / "deep").mkdir(parents=True)
    for name, body in {"a.txt": b"a", "gone.txt": b"gone", "z.gz": gzip.compress(b"zed"), "none": b""}.items():
        (up / name).write_bytes(body)
    entries = spool(src.list_entries(spark, str(up)), "entries")
    (up / "gone.txt").unlink()
    report = {r["path"]: (r["outcome"], r["warning"]) for r in upload(spark, str(up), str(tmp_path / "area"), entries=entries).collect()}
    assert report == {"/a.txt": ("landed", None), "/gone.txt": ("unreadable", UNREAD), "/z.gz": ("unpacked", None), "/none": ("landed", None)}
    area = sinks.landed(spark, str(tmp_path / "area"))
    held = {r["path"].split("_extracted")[0]: r["content"] for r in area.where("entry_type = 'file'").collect()}
    assert {k: bytes(v) for k, v in held.items()} == {"/a.txt": b"a", "/z_gz": b"zed", "/none": b""}
    assert {r["path"] for r in area.where("entry_type = 'directory'").collect()} == {"/bare", "/bare/deep"}


def test_a_run_goes_on_without_the_files_it_cannot_read(spark, tmp_path, monkeypatch):
    from tracemill.plans import pipeline

    source = fill(tmp_path / "in")
    listed = pipeline.list_files(spark, source)
    gone = F.when(F.col("name") == "obj.json", F.concat("uri", F.lit(".gone"))).otherwise(F.col("uri"))
    monkeypatch.setattr(pipeline, "list_files", lambda *_: listed.withColumn("uri", gone))
    run = run_extract(spark, source, output=str(tmp_path / "store"))
    rows = [(r["parser"], r["container"], r["message"]) for r in run.results.where("path LIKE '%obj.json'").collect()]
    assert sorted(rows, key=str) == [("filestat", "event_data", None), ("unreadable", "extraction_warning", "file could not be read")]
    assert run.response["number of warnings"] == WARNINGS + 1


def test_files_left_out_need_a_place_to_be_read_from(spark, make_files, tmp_path):
    gone = make_files(FILES).withColumns({"content": F.lit(None).cast("binary"), "length": F.lit(5000).cast("bigint")})
    for roots in (None, str(tmp_path / "mistyped")):
        with pytest.raises(ValueError, match="no content"):
            run_extract(spark, gone, formatter="json", long_root=roots, max_bytes=4000)
    run_extract(spark, gone, formatter="json", extractors="filestat", max_bytes=4000)


def test_json_run(spark, tmp_path):
    source, out = fill(tmp_path / "in"), str(tmp_path / "json")
    run = run_extract(spark, source, formatter="json", output=out, partitions=3)
    assert run.response["status"] == "Events formatted to json"
    documents = [json.loads(r[0]) for r in spark.read.text(out).collect()]
    assert len(documents) == run.documents.count() == EVENTS + WARNINGS + RECOVERY
    assert {d["container"] for d in documents} == {"event_data", "extraction_warning", "recovery_warning"}
    with pytest.raises(ValueError, match="unknown formatter"):
        run_extract(spark, source, formatter="xml")
    with pytest.raises(ValueError, match="output"):
        run_extract(spark, source)


def test_dry_run_reports(spark, tmp_path):
    response = run_extract(spark, fill(tmp_path / "in"), formatter="json", partitions=7, dry_run=True).response
    assert response["events"] == EVENTS + WARNINGS + RECOVERY
    assert response["skew_after"]["partitions"] == 7
    assert response["extraction_time"] > 0
    assert not list(tmp_path.glob("json"))


def test_long_files_are_read_by_line(spark, tmp_path):
    source = tmp_path / "in"
    fill(source)
    lines = [f"line {n}" if n % 7 else "" for n in range(4000)]
    (source / "long.log").write_text("\n".join(lines))
    (source / "long.html").write_text("<!DOCTYPE html>\n" + "x\n" * 4000)
    (source / ".long.hid").write_text("h" * 4000)
    run = run_extract(spark, str(source), partitions=2, output=str(tmp_path / "store"), max_bytes=3000, split_bytes=5000)
    rows = run.results.where(F.col("path").contains("long.")).collect()
    text = {r["seq"]: r["attributes"]["bytes"] for r in rows if r["parser"] == "text" and r["path"].endswith("log")}
    assert text == {n: str(len(line)) for n, line in enumerate(lines) if line}
    stats = {r["path"].rsplit("/", 1)[-1] for r in rows if r["parser"] == "filestat"}
    assert stats == {"long.log", "long.html", ".long.hid"}
    assert {(r["parser"], r["container"]) for r in rows if r["path"].endswith("hid") and r["parser"] != "filestat"} == {
        ("text", "event_data"),
        ("text", "extraction_warning"),
    }
    page = {(r["parser"], r["container"], str(r["attributes"])) for r in rows if r["path"].endswith("long.html") and r["parser"] != "filestat"}
    assert page == {("html", "event_data", "{'title': ''}"), ("html", "recovery_warning", "{}"), ("markup", "event_data", "{'tags': '1'}")}
    assert sinks.read_container(spark, run.store, "event_source").count() == 6


def test_arriving_files_are_extracted_once(spark, tmp_path):
    source, store, checkpoint = fill(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "checkpoint")
    extract_arrivals(arriving_files(spark, source), store, checkpoint).awaitTermination()
    (tmp_path / "in" / "late.txt").write_text("late")
    extract_arrivals(arriving_files(spark, source), store, checkpoint).awaitTermination()
    found = sinks.read_container(spark, store, "event_data")
    assert found.count() == EVENTS + 2
    assert found.select("session_id").distinct().count() == 2
    assert dict(map(tuple, sinks.read_parser_counts(spark, store).collect()))["filestat"] == 4


def test_uploads_to_landing_to_store(spark, tmp_path):
    """The whole way: packed uploads, one of them long, a long plain file, landed and extracted."""
    import io
    import zipfile

    up = tmp_path / "up"
    fill(up)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("inner.json", '{"k": 1}')
        archive.writestr("pad.txt", "p" * 6000)
    (up / "box.zip").write_bytes(packed.getvalue())
    (up / "long.log").write_text("\n".join(f"row {n}" for n in range(1000)))
    plain = ingest(spark, str(up), str(up), max_bytes=4000)
    area = sinks.land_files(src.as_files(plain), str(tmp_path / "landing"))
    run = run_extract(spark, area, output=str(tmp_path / "store"), long_root=str(up), max_bytes=4000, partitions=5)
    events = sinks.read_container(spark, run.store, "event_data")
    found = {}
    for r in events.collect():
        found.setdefault(r["path"].rsplit("/", 1)[-1], []).append((r["parser"], r["seq"], dict(r["attributes"])))
    assert found.keys() == {"page.html", "obj.json", "text.txt", "inner.json", "pad.txt", "long.log"}
    assert ("json/kv", 0, {"k": "1"}) in found["inner.json"]
    assert len(found["long.log"]) == 1001 and ("text", 999, {"bytes": "7"}) in found["long.log"]
    assert [e for e in found["long.log"] if e[0] == "filestat"] == [("filestat", 0, {"size": str((up / "long.log").stat().st_size)})]
    counted = dict(map(tuple, sinks.read_parser_counts(spark, run.store).collect()))
    assert counted["filestat"] == 6


def test_store_is_written_without_sorting_by_container(spark, results, make_files, tmp_path, monkeypatch):
    key, seen, put = "spark.sql.maxConcurrentOutputFileWriters", [], sinks._put
    before = spark.conf.get(key, None)
    monkeypatch.setattr(sinks, "_put", lambda *a: seen.append(int(spark.conf.get(key, "0"))) or put(*a))
    sinks.write_containers(make_files(FILES), results, str(tmp_path / "store"), "run")
    assert len(seen) == 5 and min(seen) >= 4
    assert spark.conf.get(key, None) == before
    assert sinks.read_container(spark, str(tmp_path / "store"), "event_data").count() == EVENTS
