import os.path
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tracemill.functions import chains, paths, times
from tracemill.functions.text import decode_text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def evaluate(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("v", expression(F.col("v")).alias("r")).collect()
    return {row["v"]: row["r"] for row in rows}


def test_basename_and_dirname(spark):
    samples = ["/a", "a", "/a/b", "/", "//a//b/", "//a", "/a/b.txt", "a/b"]
    names = evaluate(spark, samples, paths.basename)
    heads = evaluate(spark, samples, paths.dirname)
    for sample in samples:
        assert names[sample] == (os.path.basename(sample) or "/"), sample
        assert heads[sample] == os.path.dirname(sample), sample


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("/ab.", min_size=1, max_size=12), min_size=60, max_size=60, unique=True))
def test_dirname_of_any_path(spark, samples):
    heads = evaluate(spark, samples, paths.dirname)
    assert heads == {s: os.path.dirname(s) for s in samples}


def test_join_path(spark):
    joined = evaluate(spark, ["/x//y/", "", "/", "z"], lambda c: paths.join_path(F.lit("/a/"), F.lit("b"), c))
    assert joined == {"/x//y/": "/a/b/x/y", "": "/a/b", "/": "/a/b", "z": "/a/b/z"}


def test_remap_root_only_at_the_front(spark):
    moved = evaluate(
        spark, ["/up/a", "/x/up/a", "/upper/a", "/up"], lambda c: paths.remap_root(c, "/up", "/done/")
    )
    assert moved == {"/up/a": "/done/a", "/x/up/a": "/x/up/a", "/upper/a": "/upper/a", "/up": "/up"}


def test_unpack_names(spark):
    stems = evaluate(spark, ["a.tar.gz", ".gz", "plain"], paths.stream_member)
    assert stems == {"a.tar.gz": "a", ".gz": "data", "plain": "plain"}
    df = column(spark, ["/u/a.tar.gz", "/v/a.tar.gz"])
    folders = [r[0] for r in df.select(paths.unpack_folder(F.col("v"), paths.basename(F.col("v")))).collect()]
    assert all(f.startswith("a_tar_gz_extracted") for f in folders)
    assert len(set(folders)) == 2


def test_path_prefixes(spark):
    got = evaluate(spark, ["/a/b/c", "/a", "/"], paths.path_prefixes)
    assert got == {"/a/b/c": ["/", "/a", "/a/b"], "/a": ["/"], "/": ["/"]}


def test_chain_stack(spark):
    df = column(spark, ["json/kv"])
    row = df.select(
        chains.root(F.col("v")), chains.depth(F.col("v")), chains.pop(F.col("v")),
        chains.pop(chains.pop(F.col("v"))), chains.append(F.lit(""), F.lit("a")),
        chains.append(F.lit("a"), F.lit("b")), chains.chain(F.lit("a"), F.lit("b")),
    ).first()
    assert tuple(row) == ("json", 2, "json", "", "a", "a/b", "a/b")


def test_posix_nanoseconds(spark):
    ns = [1704164645123456789, 0, -1_000_000_000, None]
    got = [r[0] for r in column(spark, ns, "bigint").select(times.from_posix_ns(F.col("v"))).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5, 123456), None, datetime(1969, 12, 31, 23, 59, 59), None]


def test_zone_and_year(spark):
    ts = column(spark, [datetime(2024, 2, 29, 12, 3, 4, 500000)], "timestamp_ntz")
    row = ts.select(
        times.to_utc(F.col("v"), "Europe/Prague"), times.in_year(F.col("v"), 2020), times.in_year(F.col("v"), 2023)
    ).first()
    assert tuple(row) == (datetime(2024, 2, 29, 11, 3, 4, 500000), datetime(2020, 2, 29, 12, 3, 4, 500000), None)


TEXTS = {
    "bom8": ("héllo".encode("utf-8-sig"), "UTF-8", "héllo"),
    "bom16": ("héllo 🦊".encode("utf-16"), "UTF-16", "héllo 🦊"),
    "big16": (b"\xfe\xff" + "x".encode("utf-16-be"), "UTF-16", "x"),
    "plain": ("žluť".encode(), "UTF-8", "žluť"),
    "empty": (b"", "UTF-8", ""),
    "odd16": (b"\xff\xfe\x41", "UTF-16", None),
    "lone16": (b"\xfe\xff\xd8\x00", "UTF-16", None),
}


@pytest.mark.parametrize("fallback, latin", [(None, (None, None)), ("ISO-8859-1", ("ISO-8859-1", "é"))])
def test_decode_text(spark, fallback, latin):
    cases = TEXTS | {"latin1": (b"\xe9", *latin)}
    rows = [(name, bytearray(raw)) for name, (raw, _, _) in cases.items()]
    got = decode_text(spark.createDataFrame(rows, "name STRING, content BINARY"), fallback).collect()
    assert len(got) == len(cases)
    for row in got:
        raw, charset, text = cases[row["name"]]
        assert (row["charset"], row["text"]) == (charset, text), row["name"]
        assert bytes(row["content"]) == raw
        assert (row["warning"] is None) == (text is not None)
