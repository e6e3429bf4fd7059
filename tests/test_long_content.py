import io
import json
import random

import pytest
from hypothesis import given, settings, strategies as st

from tracemill.operators import long_content as L
from tracemill.operators.registry import Between, Count, DEFAULT, HTML, JSON, LongForm, MARKUP
from tracemill.plans.pipeline import extract
from tracemill.sources.files import list_files

TITLE = Between(b"<t>", b"</t>")


def short_title(data: bytes) -> bytes | None:
    found = [m for m in __import__("re").finditer(rb"<t>((?:(?!\n|\r|\xc2\x85|\xe2\x80[\xa8\xa9])[\s\S])*?)</t>", data)]
    return found[0][1] if found else None


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"<t>", b"</t>", b"\n", b"\r", b"\xc2\x85", b"\xe2\x80\xa8", b"<", b"t", b">", b"/", b"ab", b"\xe2\x80"]), max_size=14), st.integers(1, 9))
def test_titles_of_splits_are_those_of_the_file(parts, size):
    data = b"".join(parts)
    splits = []
    for start in range(0, max(1, len(data)), size):
        found = L.between(data[start : start + size + 3], min(size, len(data) - start), TITLE)
        shift = lambda x: None if x is None else [start + y for y in x] if isinstance(x, tuple) else start + x
        splits.append({k: v if k == "ends_line" else shift(v) for k, v in found.items()})
    place = L.first_between(splits)
    assert (data[place[0] : place[1]] if place else None) == short_title(data)


def run(spark, folder, **kwargs):
    rows = extract(spark, str(folder), formatter="json", extractors="html,markup,json", **kwargs).results.collect()
    return sorted((r["path"].rsplit("/", 1)[-1], r["parser"], r["container"], r["seq"], r["message"], sorted((dict(r["attributes"]) or {}).items())) for r in rows)


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_long_files_give_the_rows_of_short_ones(spark, tmp_path, size):
    """Whole files against splits of a few bytes: escapes, nested and empty objects, malformed ones, borders anywhere."""
    rng = random.Random(size)
    nest = lambda d: rng.choice([1, None, True, "a\\\"}{],:", "é\n梦", []]) if d == 0 else {f"k{i}": nest(d - 1) for i in range(3)}
    objects = [
        {f"m{i}": nest(i % 3) for i in range(40)}, {}, {"one": "x" * 500}, {"a": [1, [2, {"b": "]"}]], "\\\\": "\\"},
        {f"q{i}": "\\" * i for i in range(30)},
    ]
    for i, o in enumerate(objects):
        (tmp_path / f"o{i}.json").write_text(json.dumps(o, indent=rng.choice([None, 2]), ensure_ascii=False))
    bad = ['{"a": 1', '{"a": 1,}', '{"a" 1, "b": 2}', '{"a": [1}', '{"a": 1, , "b": 2}', "{]", '{ }', '{"a": "open', '{"k": 1} {"l": 2}', "{"]
    for i, text in enumerate(bad):
        (tmp_path / f"bad{i}.json").write_text(text + " " * rng.randrange(3))
    page = "<!DOCTYPE html>\n<p><title>no end\n<title>T – ž</title>\n<title>U</title>" + "<b>\u2028" * 50
    (tmp_path / "page.html").write_text(page + "</html>")
    (tmp_path / "half.html").write_text(page[:40])
    (tmp_path / "none.xml").write_text("<a>" + "</a>" * 30)
    short = run(spark, tmp_path)
    assert run(spark, tmp_path, max_bytes=0, split_bytes=size) == short
    assert not any(c == "extraction_warning" for _, _, c, *_ in short) and len(short) > 30


def test_very_long_objects_are_several_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "ROW_BYTES", 200)
    whole = {f"key {i}": "v" * (i % 50) for i in range(100)}
    (tmp_path / "o.json").write_text(json.dumps(whole))
    rows = extract(spark, str(tmp_path), formatter="json", extractors="json", max_bytes=10, split_bytes=50).results
    rows = sorted(rows.where("parser = 'json/kv'").collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in rows] == list(range(len(rows))) and len(rows) > 5
    assert {k: v for r in rows for k, v in r["attributes"].items()} == whole


def test_backslashes_before_a_split():
    raw = io.BytesIO(b"x" + b"\\" * 5 + b'"')
    assert [L._escaped(raw, k) for k in range(7)] == [False, False, True, False, True, False, True]
    assert [e.name for e in DEFAULT if e.long] == [HTML.name, MARKUP.name, JSON.name]


def test_facts_of_many_files_are_put_together_by_many_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"p{i}").write_text(f"{'x' * 20}<t>title {i}</t>")
    found = L.long_items(list_files(spark, str(tmp_path)), LongForm(emits=(), facts={"title": TITLE, "n": Count(b"x")}), 16)
    assert len(found.inputFiles()) > 1
    rows = {r["name"]: (r["title"], r["n"]) for r in found.collect()}
    assert rows == {f"p{i}": (f"title {i}", 20) for i in range(300)}
