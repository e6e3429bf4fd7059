import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import secrets as S

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)


def plain(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


PARTS = ["token", "ToKen", "API_key", "apikey", "ſecret", "secret", "passwd", "=", ":", " ", '"', "'", "abc123", "x" * 6, "AKIA", "A1B2C3D4E5F6G7H8", "0a1b2c3d4e5f60718293a4b5", "\n", "é", "K"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_base_equals_the_patterns(text):
    assert S.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('a = "abcDEF12"\nb = "34ghiJKL"\ndb_pwd = a + b\n', ["abcDEF12", "34ghiJKL"]),
        ("pwd: hunter2x9\n", ["hunter2x9"]),
        ("cfg[\"privateKey\"] := 'k9Js8sLq2w'", ["k9Js8sLq2w"]),
        ('base = "q8W7e6R5"\nsigning_key = "pre-" + base', ["q8W7e6R5", "pre-"]),
        ('connectionPwd => "s3cr3tV@lue!"', ["s3cr3tV@lue!"]),
        ('userPwd = "changeme"', []),
        ('title = "k9Js8sLq2w"', []),
        ("note: the pass was long: yes", []),
        ("", []),
    ],
)
def test_literals_of_sensitive_names(text, found):
    base, spans = S.all_spans(text)
    assert base == [] and [text[a:b] for k, a, b in spans if k == "literal"] == found


def test_pairs_follow_reassignment():
    text = 'x = "first1A"\nx = "second2B"\ny = x\n'
    assert [(n, v.text) for n, v in S.pairs(text)] == [("x", "first1A"), ("x", "second2B"), ("y", "second2B")]


def test_scan(docs, odd, empty):
    df = docs([(1, 'é token = "abcdef123"'), (2, None)])
    got = {r.doc_id: r for r in S.scan(df).collect()}
    assert got[1].spans == "assign:2:20" and got[1].n_assign == 1 and got[2].spans == ""
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert S.scan(odd).count() == odd.count() and S.scan(empty).count() == 0


def test_query_keeps_the_base(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = S.op7_assignment_secrets(spark, sf).collect()
    assert len(rows) == len(texts) and any(r.n_assign for r in rows)
    for r in rows:
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("BASE=k9Js8sLq2w\ndb_pwd=${BASE}\n", ["k9Js8sLq2w"]),
        ("BASE: k9Js8sLq2w\ndb_pwd: \"pre-\" + $BASE\n", ["k9Js8sLq2w", "pre-"]),
        ("title: k9Js8sLq2w\n", []),
        ("db_pwd:\n  k9Js8sLq2w\n", ["k9Js8sLq2w"]),
        ("db_pwd: |\n  k9Js8sLq2w\nother: 5\n", ["k9Js8sLq2w"]),
        ("db_pwd:\n  user: abc12345\n", []),
        ('db_pwd = """k9Js8sLq2w"""', ["k9Js8sLq2w"]),
        ('db_pwd = """\nk9Js8sLq2w\n"""\nx = 1', ["\nk9Js8sLq2w\n"]),
        ('doc = """\ndb_pwd = "k9Js8sLq2w"\n"""\n', ["k9Js8sLq2w"]),
        ('db_pwd = \\\n  "k9Js8sLq2w"\n', ["k9Js8sLq2w"]),
        ('db_pwd = (\n "k9Js8s"\n "Lq2w77"\n)\n', ["k9Js8s", "Lq2w77"]),
        ('user_pwd = "MyTestDb#2024"', ["MyTestDb#2024"]),
        ('user_pwd = "correct Horse7 battery"', ["correct Horse7 battery"]),
        ('user_pwd = "your_password"', []),
        ('user_pwd = "mypassword"', ["mypassword"]),
    ],
)
def test_bare_constants_continued_lines_and_whole_placeholders(text, found):
    assert [text[a:b] for k, a, b in S.all_spans(text)[1] if k == "literal"] == found


def test_long_texts_take_time_in_proportion():
    """Open brackets, very many literals, and a name that doubles itself from line to line."""
    import time

    start = time.monotonic()
    assert S.all_spans("x = (\n" + "  'abcd1234'\n" * 100_000)[1] == []
    many = "\n".join(f"password_{i} = 'k9Js8sLq2w{i}'" for i in range(16_000))
    assert len(S.literal_spans(many)) == 16_000
    assert S.literal_spans("pwd = 'a1b2'\n" + "pwd = pwd + pwd\n" * 500) == [("literal", 7, 11)]
    assert time.monotonic() - start < 30
