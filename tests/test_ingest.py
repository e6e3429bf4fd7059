import bz2
import gzip
import io
import lzma
import random
import tarfile
import zipfile

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tracemill.operators import codecs, ingest, long_archives
from tracemill.plans import queries
from tracemill.plans.pipeline import extract
from tracemill.plans.uploads import ingest as upload
from tracemill.sources.files import as_files


def make_zip(members, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        for name, data in members:
            archive.writestr(name, data)
    return out.getvalue()


def make_tar(members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                archive.addfile(info)
            else:
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def unpacked(df):
    return [(r["path"], bytes(r["content"]), r["depth"], r["warning"]) for r in df.collect()]


def by_name(df):
    return {r["name"]: r for r in df.collect()}


def test_kinds(make_files):
    packed = {
        "/a": (gzip.compress(b"x"), "gzip"), "/b": (bz2.compress(b"x"), "bzip2"), "/c": (lzma.compress(b"x"), "xz"),
        "/d": (make_zip([("m", b"x")]), "zip"), "/e": (make_tar([("m", b"x")]), "tar"), "/f": (b"x", "plain"),
        "/g": (b"", "plain"), "/h": (make_tar([("m", b"x")], "w:gz"), "gzip"),
    }
    files = make_files({p: data for p, (data, _) in packed.items()})
    got = files.select("path", ingest.detect_kind(F.col("content")).alias("kind")).collect()
    assert {r["path"]: r["kind"] for r in got} == {p: kind for p, (_, kind) in packed.items()}


def with_kind(files):
    return files.withColumns({"depth": F.lit(0), "kind": ingest.detect_kind(F.col("content"))})


def test_one_round_of_streams_and_archives(make_files):
    files = with_kind(make_files({
        "/u/a.txt.gz": gzip.compress(b"A"), "/u/b.xz": lzma.compress(b"B"), "/c.bz2": bz2.compress(b"C"),
        "/z.zip": make_zip([("d/", b""), ("d/one", b"1"), ("two", b"2")]), "/plain": b"P",
    }))
    opened = {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in ingest.decompress(files).collect()}
    assert opened.keys() == {"a", "b", "c", "z.zip", "plain"}
    assert (opened["a"], opened["b"], opened["c"], opened["plain"]) == (b"A", b"B", b"C", b"P")
    members = {r["path"]: bytes(r["content"]) for r in ingest.expand_archive(files).collect()}
    inside = {p.split("/", 2)[2]: data for p, data in members.items() if p.startswith("/z_zip_extracted")}
    assert inside == {"d/one": b"1", "two": b"2"}
    assert "/z.zip" not in members and "/u/a.txt.gz" in members


def test_nested_archives_to_the_bottom(make_files):
    inner = make_zip([("deep.txt", b"deep"), ("again.txt.gz", gzip.compress(b"again"))])
    middle = make_tar([("dir", None), ("inner.zip", inner), ("note", b"note")], "w:gz")
    outer = make_zip([("middle.tar.gz", middle), ("top.txt", b"top")])
    got = by_name(ingest.unpack_recursive(make_files({"/up/outer.zip": outer, "/up/plain.txt": b"plain"})))
    bodies = {name: (bytes(r["content"]), r["depth"]) for name, r in got.items()}
    assert bodies == {
        "plain.txt": (b"plain", 0), "top.txt": (b"top", 1), "note": (b"note", 2),
        "deep.txt": (b"deep", 3), "again": (b"again", 4),
    }
    assert got["deep.txt"]["source_path"].endswith("/inner.zip")
    assert got["deep.txt"]["path"].startswith("/up/outer_zip_extracted")
    assert all(r["warning"] is None for r in got.values())


@pytest.mark.parametrize("damage", ["gz", "bz2", "xz", "zip"])
def test_damaged_input_is_kept_and_reported(make_files, damage):
    body = bytes(range(256)) * 40
    whole = {
        "gz": gzip.compress(body), "bz2": bz2.compress(body), "xz": lzma.compress(body), "zip": make_zip([("m", body)]),
    }[damage]
    cut = whole[: len(whole) // 2]
    got = by_name(ingest.unpack_recursive(make_files({f"/cut.{damage}": cut, "/ok.txt": b"ok"})))
    assert bytes(got[f"cut.{damage}"]["content"]) == cut
    assert got[f"cut.{damage}"]["warning"].startswith("damaged")
    assert bytes(got["ok.txt"]["content"]) == b"ok"


def test_members_before_the_damage_are_kept_with_the_archive(make_files):
    whole = make_tar([("first", b"1" * 2000), ("second", b"2" * 2000)])
    got = by_name(ingest.unpack_recursive(make_files({"/cut.tar": whole[:3500]})))
    assert got.keys() == {"first", "cut.tar"}
    assert "damaged tar" in got["cut.tar"]["warning"]


def test_hostile_archives(make_files):
    evil = make_zip([("../x", b"out"), ("/abs", b"out"), ("fine", b"in"), ("bomb", b"\0" * 2_000_000)])
    limits = codecs.Limits(ratio=100)
    got = by_name(ingest.unpack_recursive(make_files({"/evil.zip": evil}), limits))
    assert got.keys() == {"fine", "evil.zip"}
    warning = got["evil.zip"]["warning"]
    assert "'../x'" in warning and "'/abs'" in warning and "'bomb'" in warning
    assert bytes(got["evil.zip"]["content"]) == evil


def test_nesting_of_any_depth(make_files):
    data = b"core"
    for _ in range(70):
        data = gzip.compress(data)
    (row,) = ingest.unpack_recursive(make_files({"/n.gz": data})).collect()
    assert (bytes(row["content"]), row["depth"], row["warning"]) == (b"core", 70, None)


def test_an_archive_that_holds_itself_ends_the_rounds(make_files, monkeypatch):
    """Two archives, each with the other as its member, beside a plain note."""
    first, second = b"PK\x03\x04first", b"PK\x03\x04second"

    def members(kind, content, limits):
        yield "other.zip", second if content == first else first, None
        yield "note", b"n" + content[-5:], None

    monkeypatch.setattr(ingest, "open_packed", members)
    got = ingest.unpack_recursive(make_files({"/q.zip": first})).collect()
    assert sorted((r["name"], r["depth"], r["warning"]) for r in got) == [
        ("note", 1, None), ("note", 2, None), ("other.zip", 2, "holds itself"),
    ]


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_members_of_one_name_stay_apart(make_files):
    got = ingest.unpack_recursive(make_files({"/d.zip": make_zip([("m", b"1"), ("m", b"2")])})).collect()
    assert sorted(bytes(r["content"]) for r in got) == [b"1", b"2"]
    assert len({r["path"] for r in got}) == 2


def test_empty_archive_stays(make_files):
    got = by_name(ingest.unpack_recursive(make_files({"/e.tar": make_tar([("dir", None)])})))
    assert got.keys() == {"e.tar"} and got["e.tar"]["warning"] is None


def test_disposition_and_roots(make_files):
    files = make_files({"/up/a": b"1", "/up/z.zip": b"2", "/done/b": b"3"})
    got = {
        r["path"]: (r["disposition"], r["out_path"])
        for r in ingest.source_disposition(files, F.col("name").endswith(".zip"), "/up", "/done").collect()
    }
    assert got == {"/up/a": ("move", "/done/a"), "/up/z.zip": ("drop", "/done/z.zip"), "/done/b": ("keep", "/done/b")}
    archive = make_files({"/up/s/z.zip": make_zip([("m", b"1")]), "/up/p": b"2"})
    landed = sorted(r["path"] for r in upload(archive.sparkSession, archive, "/up").collect())
    assert landed[0] == "/p" and landed[1].startswith("/s/z_zip_extracted") and landed[1].endswith("/m")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text("abc/.", min_size=1, max_size=6), st.binary(max_size=300)), max_size=4), st.sampled_from(["w", "w:gz", "w:xz"]))
def test_tar_round_trip(members, mode):
    wanted = [("first", b"1"), *((n, d) for n, d in members if codecs._safe(n) and not n.endswith("/"))]
    packed = make_tar(wanted, mode)
    kind = {"w": "tar", "w:gz": "gzip", "w:xz": "xz"}[mode]
    opened = [(n, d) for n, d, w in codecs.open_packed(kind, packed, codecs.Limits()) if w is None]
    assert [d for _, d in opened] == [d for _, d in wanted]


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_long_archives_are_opened_in_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(long_archives, "TASK_BYTES", 2000)
    body = bytes(range(256)) * 20
    nested = make_tar([("in.txt", b"in"), ("deep.gz", gzip.compress(b"deep"))], "w:gz")
    folder = tmp_path / "up" / "sub dir"
    folder.mkdir(parents=True)
    packed = {
        "deflated.zip": make_zip([("a/", b""), ("a/one", body), ("two", b"2" * 5000), ("two", b"again"), ("n.tgz", nested)]),
        "stored.zip": make_zip([("s", body)], zipfile.ZIP_STORED),
        "bz.zip": make_zip([("b", body)], zipfile.ZIP_BZIP2),
        "lz.zip": make_zip([("l", bytes(body)), ("l2", body)], zipfile.ZIP_LZMA) + b"\0" * 10,
        "plain.tar": make_tar([("dir", None), ("t1", body), ("t2", b"t")]),
        "members.tar.xz": make_tar([("x1", body), ("x2", b"x"), ("x2", b"y")], "w:xz"),
        "stream.gz": gzip.compress(body, 0),
        "evil.zip": make_zip([("../up", b"no"), ("ok", body)], zipfile.ZIP_STORED),
        "cut.zip": make_zip([("c", body)], zipfile.ZIP_STORED)[:3000],
        "long.txt": b"t" * 3000,
        "short.txt": b"short",
    }
    for name, data in packed.items():
        (folder / name).write_bytes(data)
    long = {name for name, data in packed.items() if len(data) > 100}
    rows = upload(spark, str(tmp_path / "up"), str(tmp_path / "up"), max_bytes=100).collect()
    files = {}
    for r in rows:
        if r["content"] is not None:
            files.setdefault(r["name"], []).append(bytes(r["content"]))
    kept = {r["name"]: r["warning"] for r in rows if r["content"] is None}
    assert "members.tar.xz" in long and "deflated.zip" in long
    assert sorted(files.pop("two")) == [b"2" * 5000] and files.pop("two#1") == [b"again"]
    assert files == {
        "one": [body], "in.txt": [b"in"], "deep": [b"deep"], "s": [body], "b": [body], "t1": [body], "t2": [b"t"],
        "x1": [body], "x2": [b"x"], "x2#1": [b"y"], "stream": [body], "ok": [body], "short.txt": [b"short"],
    }
    assert kept.keys() == {"evil.zip", "cut.zip", "long.txt", "lz.zip"}
    assert "'../up'" in kept["evil.zip"] and "damaged" in kept["cut.zip"] and "left in place" in kept["long.txt"]
    assert all(r["path"].startswith("/sub dir/") for r in rows)
    depth = {r["name"]: r["depth"] for r in rows}
    assert (depth["one"], depth["in.txt"], depth["deep"], depth["short.txt"]) == (1, 2, 3, 0)


def test_members_too_long_for_a_row(spark, tmp_path):
    big = b"".join(b"line %d\n" % n for n in range(2000))
    nested = make_tar([("deep.log", big), ("small.txt", b"small")])
    folder = tmp_path / "up"
    folder.mkdir()
    (folder / "box.zip").write_bytes(make_zip([("big.log", big), ("nested.tar", nested), ("ok.txt", b"ok")]))
    (folder / "t.tgz").write_bytes(make_tar([("in.log", big)], "w:gz"))
    (folder / "s.xz").write_bytes(lzma.compress(big))
    (folder / "long.zip").write_bytes(make_zip([("stored.log", big), ("pad", b"p" * 9000)], zipfile.ZIP_STORED))
    spill = str(tmp_path / "spill")
    wanted = {"big.log", "deep.log", "in.log", "s", "stored.log"}

    limits = codecs.Limits(row_bytes=10_000, spill=spill)
    rows = upload(spark, str(folder), str(folder), limits=limits, max_bytes=10_000).collect()
    held = {r["name"]: bytes(r["content"]) for r in rows if r["content"] is not None}
    assert held == {"ok.txt": b"ok", "small.txt": b"small", "pad": b"p" * 9000}
    placed = {r["name"]: r for r in rows if r["content"] is None}
    assert placed.keys() == wanted and len(rows) == len(wanted) + 3
    for r in placed.values():
        assert r["length"] == len(big) and "left in place" in r["warning"]
        assert (tmp_path / "spill").joinpath(str(folder)[1:] + r["path"]).read_bytes() == big
    assert placed["deep.log"]["depth"] == 2

    plain = upload(spark, str(folder), str(folder), limits=codecs.Limits(row_bytes=10_000), max_bytes=10_000).collect()
    # Without a spill folder given, one beside the intermediate tables is used.
    kept = {r["name"] for r in plain if r["warning"]}
    assert kept == wanted and len(plain) == len(rows)


def test_spilled_members_are_extracted_by_line(spark, tmp_path):
    big = b"".join(b"line %d\n" % n for n in range(2000))
    folder = tmp_path / "up"
    folder.mkdir()
    (folder / "box.zip").write_bytes(make_zip([("big.log", big), ("ok.txt", b"ok")]))
    spill = f"{tmp_path}/spill"
    files = upload(spark, str(folder), str(folder), limits=codecs.Limits(row_bytes=5000, spill=spill))
    run = extract(spark, as_files(files), formatter="json", long_root=[str(folder), f"{spill}{folder}"], max_bytes=5000)
    text = run.results.where("parser = 'text'").groupBy(F.substring_index("path", "/", -1).alias("name")).count()
    assert dict(map(tuple, text.collect())) == {"big.log": 2000, "ok.txt": 1}
    sizes = run.results.where("parser = 'filestat'").collect()
    assert sorted(r["attributes"]["size"] for r in sizes) == sorted(["2", str(len(big))])


def test_member_names_stay_apart():
    taken = set()
    assert [codecs.free_name(n, taken) for n in ("m", "m", "m#1", "m")] == ["m", "m#1", "m#1#1", "m#2"]


def test_ratio_holds_for_a_tar_inside_a_stream():
    packed = make_tar([("zeros", b"\0" * 1_000_000)], "w:gz")
    outcomes = list(codecs.open_packed("gzip", packed, codecs.Limits(ratio=10)))
    assert outcomes[-1][0] is None and "exceeds" in outcomes[-1][2]
    assert [m for m, _, _ in codecs.open_packed("gzip", packed, codecs.Limits(ratio=10_000))] == ["zeros"]


@pytest.mark.parametrize("row_bytes", [1000, 10**9])
def test_long_streams_are_read_in_runs_of_blocks(spark, tmp_path, monkeypatch, row_bytes):
    """bzip2 and xz streams by many tasks, a damaged one and a tar archive besides; the file that comes out lies in parts."""
    import hashlib

    from tracemill.sources.listing import open_uri

    up = tmp_path / "up"
    up.mkdir()
    rng = __import__("random").Random(3)
    lines = [" ".join(rng.choice(["alpha", "beta", "gamma", str(rng.random())]) for _ in range(9)) for _ in range(9000)]
    body = "\n".join(lines).encode()
    (up / "log.bz2").write_bytes(bz2.compress(body, 1))
    (up / "log2.xz").write_bytes(b"".join(lzma.compress(body[k : k + 90_000], preset=0) for k in range(0, len(body), 90_000)))
    hurt = bytearray(bz2.compress(body, 1))
    hurt[len(hurt) // 2] ^= 255
    (up / "hurt.bz2").write_bytes(hurt)
    (up / "box.tar.bz2").write_bytes(make_tar([("m", body)], "w:bz2"))
    monkeypatch.setattr(long_archives, "SPLIT_STREAM_BYTES", 20_000)
    monkeypatch.setattr(long_archives, "RUN_BYTES", 60_000)
    limits = codecs.Limits(row_bytes=row_bytes, spill=str(tmp_path / "spill"))
    got = by_name(upload(spark, str(up), str(up), limits=limits, max_bytes=10_000))
    assert got.keys() == {"log", "log2", "hurt.bz2", "m"}
    assert got["hurt.bz2"]["warning"].startswith("damaged bzip2")
    for name in ("log", "log2"):
        assert got[name]["length"] == len(body)
        assert (got[name]["content"] is None) == (row_bytes == 1000) == (got[name]["warning"] is not None)
        with open_uri(f"{tmp_path}/spill{up}{got[name]['path']}") as raw:
            assert hashlib.md5(raw.read()).digest() == hashlib.md5(body).digest()
            assert raw.seek(-5, 2) == len(body) - 5 and raw.read() == body[-5:] and raw.seek(7) == 7 and raw.read(9) == body[7:16]
    parts = list((tmp_path / "spill").rglob("*%joined%/*"))
    assert len([p for p in parts if "log%joined" in str(p)]) > 3 and all(p.name.isdigit() for p in parts)
    if row_bytes == 1000:
        area = as_files(upload(spark, str(up), str(up), limits=limits, max_bytes=10_000))
        run = extract(spark, area, formatter="json", long_root=[str(up), str(tmp_path / "spill") + str(up)], max_bytes=1000)
        found = run.results.where("parser = 'text' AND path LIKE '%/log' AND container = 'event_data'").count()
        assert found == len(lines)


def test_long_directories_are_read_as_they_go(tmp_path, monkeypatch):
    """60,000 members against the standard reader, within little memory; comments, large sizes and what stands before."""
    import tracemalloc

    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for i in range(60_000):
            archive.writestr(f"d{i % 7}/ž{i}.txt", b"x" * (i % 3))
        archive.comment = b"c" * 500
    for data in (path.read_bytes(), b"#!/bin/sh\n" + path.read_bytes()):
        raw = io.BytesIO(data)
        with zipfile.ZipFile(raw) as archive:
            want = [(i.filename, i.flag_bits, i.compress_type, i.CRC, i.compress_size, i.file_size, i.header_offset) for i in archive.infolist()]
        assert list(long_archives.zip_directory(raw, 1000)) == want
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    big = io.BytesIO()
    with zipfile.ZipFile(big, "w") as archive:
        for i in range(50):
            archive.writestr(f"m{i}", b"y" * 90 * (i % 3))
    with zipfile.ZipFile(big) as archive:
        want = [(i.filename, i.compress_size, i.file_size, i.header_offset) for i in archive.infolist()]
    assert [(n, p, s, o) for n, _, _, _, p, s, o in long_archives.zip_directory(big, 64)] == want
    with pytest.raises(zipfile.BadZipFile):
        list(long_archives.zip_directory(io.BytesIO(path.read_bytes()[:-2000])))
    tar = io.BytesIO(make_tar([(f"t{i}", b"z") for i in range(20_000)]))
    tracemalloc.start()
    with open(path, "rb") as raw:
        assert sum(1 for _ in long_archives.zip_directory(raw)) == 60_000
    assert sum(1 for _ in long_archives._index_tar(tar)) == 20_000
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


def test_documents_are_packed_in_runs_of_bounded_bytes():
    import pyarrow as pa

    from tracemill.plans import queries

    texts = ["x" * 1000] * (3 * queries.PACK_BYTES // 1000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(3, 4 * len(texts), 4)), pa.array(texts)], ["doc_id", "text"])
    out = list(queries._compress(iter([batch])))
    assert len(out) >= 3 and max(b.nbytes for b in out) <= 1.1 * queries.PACK_BYTES
    assert [c for b in out for c in b.column("content").to_pylist()] == [t.encode() for t in texts]
    assert list(queries._compress(iter([batch.slice(0, 0)])))[0:1] in ([], [batch.slice(0, 0)])


@pytest.mark.parametrize("kind, pack", [("gzip", gzip.compress), ("bzip2", bz2.compress), ("xz", lzma.compress)])
@pytest.mark.parametrize("size", [0, 1, 512, 513, 5000])
def test_a_stream_is_read_once(kind, pack, size):
    class Counted(io.BytesIO):
        count = 0

        def read(self, n=-1):
            data = super().read(n)
            self.count += len(data)
            return data

        def readinto(self, into):
            n = super().readinto(into)
            self.count += n
            return n

    data = random.Random(size).randbytes(size)
    raw = Counted(pack(data))
    assert list(codecs.open_stream(kind, raw, len(raw.getvalue()), codecs.Limits())) == [("", data, None)]
    assert raw.count <= len(raw.getvalue()) + 8


def test_archives_are_packed_in_batches(spark):
    """Not in a group each: there are as many archives as documents, divided by a fixed number."""
    archives = queries._archives(spark, "/root/testdata/sf0.001", queries._zip, ".zip")
    assert "InPandas" not in archives._jdf.queryExecution().optimizedPlan().toString()
