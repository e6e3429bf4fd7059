import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base patterns as they are given."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    cards = [(m.span(), re.sub("[^0-9]", "", m[0])) for m in CARD.finditer(text)]
    out += [("card", *s) for s, d in cards if 13 <= len(d) <= 19 and luhn(d)]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("a1.@-_+ 4()%2"), max_size=40) | st.lists(st.sampled_from(["a@b.c", "@", ".", "1.2.3.4", "+1 (22) 333-4444", "4111111111111111", "4111 1111-1111 1111", " ", "x", "255", "256.1.1.1", "é"]), max_size=9).map("".join))
def test_base_equals_the_patterns(text):
    assert P.base_spans(text) == plain(text)


def test_base_is_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        P.base_spans(text)


TEMPLATES = ["write to {e} or call {p} today", "card {c} was charged", "host {i} is down", "{e} {i}", "order {n} of {y}, {p}", "see {y} and {n}"]


def rows():
    rng = np.random.default_rng(3)
    word = lambda n: "".join("abcdefghij"[k] for k in rng.integers(0, 10, n))
    out = []
    for k in range(240):
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        card = next(digits + c for c in "0123456789" if P.luhn(digits + c))
        values = {
            "e": f"{word(5)}.{word(3)}@{word(6)}.com",
            "i": ".".join(map(str, rng.integers(1, 255, 4))),
            "c": card,
            "p": f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}",
            "n": str(rng.integers(10_000, 999_999)),
            "y": str(rng.integers(1950, 2030)),
        }
        out.append((k, TEMPLATES[k % len(TEMPLATES)].format(**values)))
    return out


@pytest.fixture(scope="module")
def weights():
    return P.train([t for _, t in rows()])


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("please write to anna.bell at mailbox dot com soon", "email", "anna.bell at mailbox dot com"),
        ("the host 10[.]20[.]30[.]40 is down", "ip", "10[.]20[.]30[.]40"),
        ("card 4111.1111.1111.1111 was charged", "card", "4111.1111.1111.1111"),
        ("call (415) 555-2671 today", "phone", "(415) 555-2671"),
    ],
)
def test_model_finds_other_forms(weights, text, kind, found):
    base, spans = P.all_spans(text, weights)
    assert base == [] and [(k, text[a:b]) for k, a, b in spans] == [(kind, found)]


@pytest.mark.parametrize("text", ["in 1999 about 12000 items", "id 4111111111111112 no", "see me at noon", "", "3.5 of 10"])
def test_model_leaves_plain_text_alone(weights, text):
    assert P.all_spans(text, weights) == ([], [])


def test_best_segmentation_equals_brute_force(weights):
    """The dynamic programme against every choice of disjoint segments."""
    lattice = P.Lattice("to a.b@c.de 1.2.3.4")
    scores = lattice.scores(weights).max(axis=1)

    def best(at):
        if at >= lattice.n:
            return 0.0
        return max([best(at + 1)] + [scores[k] + best(j) for k, (i, j) in enumerate(lattice.segments) if i == at])

    place = {(a, b): k for k, (i, j) in enumerate(lattice.segments) for a, b in [(lattice.atoms[i][0], lattice.atoms[j - 1][1])]}
    got = sum(lattice.scores(weights)[place[a, b], P.KINDS.index(kind)] for kind, a, b in P.best_segments(lattice.text, weights))
    assert got == pytest.approx(best(0))


def test_marginals_equal_brute_force(weights):
    lattice = P.Lattice("x 1.2 y@z")
    scores = lattice.scores(weights) / 4
    total, sums = 0.0, np.zeros_like(scores)

    def walk(at, weight, used):
        nonlocal total
        if at == lattice.n:
            total += weight
            for k, y in used:
                sums[k, y] += weight
            return
        walk(at + 1, weight, used)
        for k, (i, j) in enumerate(lattice.segments):
            if i == at:
                for y in range(len(P.KINDS)):
                    walk(j, weight * np.exp(scores[k, y]), used + [(k, y)])

    walk(0, 1.0, [])
    assert lattice.marginals(scores) == pytest.approx(sums / total)


def test_scan(docs, odd, empty, weights):
    df = docs([(1, "mail a.b@c.de and 1.2.3.4"), (2, None), (None, "+1 (555) 123-4567")])
    got = {r.doc_id: r for r in P.scan(df, weights).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].spans) == (1, 1, "email:5:13,ip:18:25")
    assert got[2].spans == "" and got[None].n_phone == 1
    assert P.scan(odd, weights).count() == odd.count() and P.scan(empty, P.fit(empty)).count() == 0


def test_query_keeps_the_base(spark):
    import hashlib

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("text").rlike("[0-9@]")).collect()}
    for r in P.op4_semi_markov_pii(spark, sf).collect():
        base = plain(texts.get(r.doc_id, ""))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in P.KINDS)


def test_long_unbroken_texts():
    """Octets with thousands of zeros, and windows that give what one lattice over everything gives."""
    assert P.base_spans("0" * 5000 + "1.2.3.4 000000.2.3.444 0.0.0.0") == [("ip", 0, 5007), ("ip", 23 + 5000, 30 + 5000)]
    import random

    rng = random.Random(2)
    weights = np.random.default_rng(2).normal(size=(P.WEIGHTS + 1, len(P.KINDS)))
    weights[P.WEIGHTS] = 0
    text = "".join(rng.choice("abc123@.+-") for _ in range(600))
    whole = P.best_segments(text, weights)
    old, P.WINDOW = P.WINDOW, 7
    try:
        assert P.best_segments(text, weights) == whole and len(whole) > 5
    finally:
        P.WINDOW = old
    assert P.neighbourhoods(("x" * 90 + "7") * 2000) == [(0, 91 * 2000)]
    assert P.neighbourhoods("aa bb7cc " + "d " * 90 + "e@f") == [(0, 46), (149, 192)]
