from datetime import datetime

import pytest
from conftest import STAMP
from pyspark.sql import functions as F

from tracemill.operators import classify, counts, distribute, extract
from tracemill.operators.registry import DEFAULT, Emit, Extractor, FILESTAT, TEXT, Signature, select_extractors
from tracemill.operators.timeline import timeline
from tracemill.plans.settings import Settings

FILES = {
    "/page": b"<!DOCTYPE html><title>T</title></html>",
    "/half": b"<!DOCTYPE html><title>H</title>",
    "/xml": b"<a><b/></a>",
    "/obj": b'{"k": 7}',
    "/text": b"one\n\nthree",
    "/long": b"x" * 2001 + b"\nshort",
    "/empty": b"",
}


def rows_of(results):
    return {
        (r["container"], r["path"], r["parser"], r["seq"]): (r["message"], r["attributes"])
        for r in results.collect()
    }


@pytest.fixture
def files(make_files):
    return make_files(FILES)


def test_signature_candidates(files):
    got = {r["path"]: r["sig_parsers"] for r in classify.classify(files, DEFAULT).collect()}
    assert got["/page"] == ["html", "markup"]
    assert got["/xml"] == ["markup"]
    assert got["/text"] == got["/empty"] == []


def test_signatures_anywhere_and_each_name_once(make_files):
    marks = (Signature(b"AB"), Signature(b"YZ", -2), Signature(b"M", 3))
    files = make_files({"/both": b"ABxMxYZ", "/end": b"__YZ", "/mid": b"___M", "/none": b"YZ_", "/short": b"Z"})
    got = {r["path"]: r["sig_parsers"] for r in classify.classify(files, [Extractor("m", marks)]).collect()}
    assert got == {"/both": ["m"], "/end": ["m"], "/mid": ["m"], "/none": [], "/short": []}


@pytest.mark.parametrize("inline", [200, 0])
def test_signature_table_both_ways(spark, files, inline):
    rows = [(e.name, bytearray(s.magic), s.offset) for e in DEFAULT for s in e.signatures]
    table = spark.createDataFrame(rows, "parser STRING, magic BINARY, offset INT")
    by_table = classify.signature_match_table(files, table, max_inline=inline)
    by_registry = classify.signature_match(files, DEFAULT)
    assert sorted(map(tuple, by_table.collect())) == sorted(map(tuple, by_registry.collect()))


def test_every_file_gets_filestat_once(files):
    items = classify.work_items(files, DEFAULT)
    got = {}
    for r in items.collect():
        got.setdefault(r["path"], []).append(r["parser"])
    assert all(p.count("filestat") == 1 for p in got.values())
    assert sorted(got["/page"]) == ["filestat", "html", "markup"]
    assert sorted(got["/text"]) == ["filestat", "text"]


def test_filter_expression():
    def names(expression):
        return [e.name for e in select_extractors(DEFAULT, expression)]

    assert names(None) == names("all") == ["html", "markup", "json", "text", "filestat"]
    assert names("!markup") == ["html", "json", "text", "filestat"]
    assert names("html,text") == ["html", "text", "filestat"]
    assert names("all,!text") == ["html", "markup", "json", "filestat"]
    assert names("!filestat")[-1] == "filestat"
    with pytest.raises(ValueError):
        names("nonesuch")


def test_results(files):
    got = rows_of(extract.extract_results(files, DEFAULT))
    for path, body in FILES.items():
        assert got["event_data", path, "filestat", 0] == (None, {"size": str(len(body))})
    assert got["event_data", "/page", "html", 0] == (None, {"title": "T"})
    assert ("recovery_warning", "/page", "html", 0) not in got
    assert got["recovery_warning", "/half", "html", 0] == ("unterminated document", {})
    assert got["event_data", "/xml", "markup", 0] == (None, {"tags": "3"})
    assert got["event_data", "/obj", "json/kv", 0] == (None, {"k": "7"})
    assert got["event_data", "/text", "text", 2] == (None, {"bytes": "5"})
    assert ("event_data", "/text", "text", 1) not in got
    assert got["extraction_warning", "/long", "text", 0] == ("line exceeds 2000 bytes", {})
    assert got["event_data", "/long", "text", 0] == (None, {"bytes": "2001"})
    assert [k for k in got if k[1] == "/empty"] == [("event_data", "/empty", "filestat", 0)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_results_do_not_depend_on_partitions(files, partitions):
    assert rows_of(extract.extract_results(files, DEFAULT, partitions)) == rows_of(extract.extract_results(files, DEFAULT))


def test_containers_add_up(files):
    results = extract.extract_results(files, DEFAULT)
    routed = counts.route_containers(results)
    sizes = {name: df.count() for name, df in routed.items()}
    summary = counts.run_summary(results).first()
    assert tuple(summary) == (sizes["event_data"], sizes["extraction_warning"], sizes["recovery_warning"])
    assert counts.extract_tally(results).first()["events"] == results.count() == sum(sizes.values())


def test_unknown_extractor_gives_nothing(files):
    items = extract.items_with_content(files, DEFAULT).withColumn("parser", F.lit("nonesuch"))
    assert extract.run_extractors(items, DEFAULT).count() == 0


def test_metadata_extractors_do_not_read_content(spark, tmp_path):
    from tracemill.sources.files import scan_files

    (tmp_path / "f").write_bytes(b"abc")
    results = extract.extract_results(scan_files(spark, str(tmp_path)), [FILESTAT])
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert results.first()["attributes"] == {"size": "3"}


def test_extraction_is_one_pass_without_shuffle(files):
    plan = extract.extract_results(files, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") <= 1
    assert plan.count("split(") == 1


def test_python_extractors_keep_rows_before_a_failure(make_files):
    def boom(out):
        for n in range(3):
            yield out.event({"n": n})
        raise RuntimeError("boom")

    def nested(out):
        yield out.event({"size": out.file.length}, times={"Modification Time": out.file.mtime})
        out.push("inner")
        yield out.extraction_warning("odd")
        yield out.recovery_warning("cut")
        out.pop()
        yield out.event()

    registry = [FILESTAT, Extractor("boom", python=boom), Extractor("nested", python=nested)]
    results = extract.extract_results(make_files({"/f": b"12", "/g": b""}), registry)
    got = rows_of(results)
    for path, size in (("/f", "2"), ("/g", "0")):
        assert [got["event_data", path, "boom", n] for n in range(3)] == [(None, {"n": str(n)}) for n in range(3)]
        assert got["extraction_error", path, "boom", 3] == ("RuntimeError: boom", {})
        assert got["event_data", path, "nested", 0] == (None, {"size": size})
        assert got["extraction_warning", path, "nested/inner", 1][0] == "odd"
        assert got["recovery_warning", path, "nested/inner", 2][0] == "cut"
        assert got["event_data", path, "nested", 3] == (None, {})
    at = results.where("parser = 'nested' AND seq = 0").first()["times"][0]
    assert (at["timestamp_desc"], at["timestamp"]) == ("Modification Time", STAMP)
    assert counts.extract_tally(results).first()["events"] == results.where("container <> 'extraction_error'").count()


def test_settings_reach_declared_extractors(make_files):
    local = Extractor(
        "local",
        emits=(Emit(
            attributes={"zone": ":preferred_time_zone", "year": "CAST(:preferred_year AS STRING)"},
            times={"Creation Time": "convert_timezone(:preferred_time_zone, 'UTC', mtime)"},
        ),),
    )
    values = {"preferred_time_zone": "Europe/Prague", "preferred_year": 2023}
    got = extract.extract_results(make_files({"/f": b""}), extract.bind_settings([local], values)).first()
    assert got["attributes"] == {"zone": "Europe/Prague", "year": "2023"}
    assert got["times"][0]["timestamp"] == datetime(2024, 1, 2, 2, 4, 5)
    assert Settings().as_map()["preferred_time_zone"] == "UTC"


def test_quotes_in_declared_messages(make_files):
    odd = Extractor("odd", emits=(Emit(message="it's a \\ 'test'"),))
    assert extract.extract_results(make_files({"/f": b""}), [odd]).first()["message"] == "it's a \\ 'test'"


def test_timeline(spark):
    rows = [
        (1, [("Creation Time", STAMP), ("Modification Time", None)]),
        (2, [("Creation Time", STAMP), ("Access Time", STAMP)]),
        (3, [("Creation Time", None)]),
        (4, []),
    ]
    df = spark.createDataFrame(rows, "id INT, times ARRAY<STRUCT<timestamp_desc: STRING, timestamp: TIMESTAMP_NTZ>>")
    got = sorted(map(tuple, timeline(df, keys=("id",)).collect()), key=str)
    assert got == [
        (1, "Creation Time", STAMP), (2, "Access Time", STAMP), (2, "Creation Time", STAMP),
        (3, "Not a time", None), (4, "Not a time", None),
    ]


def test_merge_counts(spark):
    def counter(**values):
        return spark.createDataFrame(list(values.items()), "name STRING, number_of_events BIGINT")

    merged = counts.merge_parser_counts(counter(a=1, b=2), counter(b=3), counter(c=4))
    assert dict(map(tuple, merged.collect())) == {"a": 1, "b": 5, "c": 4}


def test_empty_partitions_are_counted(spark):
    spread = distribute.spread(spark.createDataFrame([("/a", "x")], "path STRING, parser STRING"), 5)
    assert tuple(distribute.partition_stats(spread).first()) == (0, 1, 0.2, 5)


def test_bucket_places_rows(spark):
    items = spark.range(500).select(F.col("id").cast("string").alias("path"), F.lit("hot").alias("parser"))
    spread = distribute.spread(items, 8).withColumn("at", F.spark_partition_id())
    assert spread.where("bucket <> at").count() == 0
    stats = distribute.partition_stats(spread.select("bucket")).first()
    assert stats["partitions"] == 8 and stats["min_rows"] > 30


def test_text_is_cut_and_counted_in_bytes(make_files):
    files = make_files({"/latin": b"\xe9\xe9\nx", "/cr": b"ab\r\ncd"})
    got = {(r["path"], r["seq"]): r["val"] for r in extract.flat(extract.extract_results(files, [TEXT])).collect()}
    assert got == {("/latin", 0): "2", ("/latin", 1): "1", ("/cr", 0): "3", ("/cr", 1): "2"}


def test_content_moves_once_for_all_its_extractors(make_files):
    plan = extract.extract_results(make_files({"/a": b"<!DOCTYPE html>"}), DEFAULT, 4)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange")


def test_bad_values_of_a_python_extractor_are_its_error(make_files):
    def late(file):
        yield file.event({"n": 1})
        yield file.event({"n": 2}, times={"Seen": "not a time"})

    files = make_files({"/a": b"1", "/b": b"2"})
    rows = extract.extract_results(files, [Extractor("late", python=late)]).collect()
    assert sorted((r["path"], r["container"]) for r in rows) == [(p, c) for p in ("/a", "/b") for c in ("event_data", "extraction_error")]


def test_raising_expressions_are_the_rows_error(make_files):
    """In values, conditions and cuts, also where two expressions share the part that raises."""
    bad = "1 div (length - 3)"
    registry = (
        Extractor("twice", emits=(Emit(attributes={"a": f"CAST({bad} AS STRING)", "b": f"CAST({bad} AS STRING)"}),
                                  Emit("recovery_warning", when=f"{bad} > -100", message=f"CAST({bad})"))),
        Extractor("lines", records="IF(length = 4, raise_error('no'), split(CAST(content AS STRING), ','))",
                  emits=(Emit(when="element_at(split(record, ':'), 2) <> ''", attributes={"v": "element_at(split(record, ':'), 2)"}),)),
        *DEFAULT,
    )
    files = make_files({"/three": b"a:b", "/four": b"c:d,", "/five": b"x,y:z"})
    rows = extract.extract_results(files, registry).where("parser IN ('twice', 'lines')").collect()
    got = {}
    for r in rows:
        got.setdefault((r["parser"], r["path"]), []).append((r["seq"], r["container"], r["message"], dict(r["attributes"])))
    error = "extraction_error"
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        ("twice", "/three"): [(0, error, "condition could not be computed", {}), (0, error, "values could not be computed", {})],
        ("twice", "/four"): [(0, "event_data", None, {"a": "1", "b": "1"}), (0, "recovery_warning", f"CAST({bad})", {})],
        ("twice", "/five"): [(0, "event_data", None, {"a": "0", "b": "0"}), (0, "recovery_warning", f"CAST({bad})", {})],
        ("lines", "/three"): [(0, "event_data", None, {"v": "b"})],
        ("lines", "/four"): [(0, error, "content could not be cut", {})],
        ("lines", "/five"): [(0, error, "condition could not be computed", {}), (1, "event_data", None, {"v": "z"})],
    }


def test_casts_in_quotes_are_text():
    assert extract.lenient("concat('CAST(x', CAST(a AS INT), \"cast(\")") == "concat('CAST(x', TRY_CAST(a AS INT), \"cast(\")"


def test_spread_by_bytes_is_even(spark):
    sizes = [1, 0, 7, 10_000, 3, 3, 3, 250, 250, 99] * 30 + [400_000]
    files = spark.createDataFrame([(f"/f{i}", n) for i, n in enumerate(sizes)], "path STRING, length BIGINT")
    dealt = distribute.spread_by_bytes(files, 7)
    stats = distribute.byte_stats(dealt).first()
    assert stats["partitions"] == 7 and dealt.count() == len(sizes)
    assert stats["max_bytes"] <= stats["avg_bytes"] + stats["largest_row"] == sum(sizes) / 7 + 400_000
    joined = distribute.spread_by_bytes(files, 7, max_cuts=2)
    assert sorted(joined.collect()) == sorted(dealt.collect()) and distribute.byte_stats(joined).first() == stats
    for rows in ([], [("/a", 0), ("/b", None)]):
        few = distribute.spread_by_bytes(spark.createDataFrame(rows, "path STRING, length BIGINT"), 3)
        assert few.count() == len(rows) and distribute.byte_stats(few).first()["partitions"] == 3


def test_long_signature_tables_send_few_rows_to_the_join(spark, make_files):
    """10,000 signatures over 300 shapes: every hit is found, and hardly anything else enters the join."""
    import random

    rng = random.Random(6)
    shapes = [(o, n) for o in (*range(0, 90), -8, -7, -40, *range(200, 207)) for n in (3, 4, 6)]
    marks = {(o, bytes(rng.randrange(256) for _ in range(n))) for o, n in rng.choices(shapes, k=10_000)}
    table = [(f"p{i % 700}", bytearray(m), o) for i, (o, m) in enumerate(sorted(marks))]
    signatures = spark.createDataFrame(table, "parser STRING, magic BINARY, offset INT")
    files, want = {}, set()
    for i in range(60):
        data = bytearray(rng.randrange(256) for _ in range(300))
        for parser, magic, offset in rng.choices(table, k=2):
            at = offset if offset >= 0 else len(data) + offset
            data[at : at + len(magic)] = magic
        files[f"/f{i}"] = bytes(data)
    for path, data in files.items():
        for parser, magic, offset in table:
            at = offset if offset >= 0 else len(data) + offset
            if data[at : at + len(magic)] == magic:
                want.add((path, parser))
    rows = make_files({**files, "/short": b"ab", "/empty": b""})
    assert {tuple(r) for r in classify.signature_match_table(rows, signatures).collect()} == want and len(want) > 100
    probes = classify.signature_probes(rows, signatures).count()
    assert probes < len(want) + 0.02 * len(shapes) * len(files)
    # A path that comes twice gives its rows twice, by comparison and by join.
    twice = rows.union(rows.where("path = '/f0'"))
    few = signatures.where("parser = 'p1'").limit(100)
    by = [sorted(map(tuple, classify.signature_match_table(twice, s, n).collect())) for s, n in ((signatures, 200), (few, 200), (few, 0))]
    assert len(by[0]) == len(want) + sum(p == "/f0" for p, _ in want) and by[1] == by[2]
