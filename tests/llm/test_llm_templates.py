from collections import defaultdict

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import templates as T


def brute(rows, agreed=T.AGREEMENT, min_docs=T.MIN_DOCS):
    """The tree on one machine: the same leaves and leaders, tokens compared themselves."""
    import re

    lines = []
    for n, (doc, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t)
            if len(tokens) >= T.MIN_TOKENS:
                lines.append((n, doc, k, tokens))
    count = defaultdict(int)
    for line in lines:
        count[line[3]] += 1
    leader, rest = {}, set(count)
    for d in T.DEPTHS:
        leaves = defaultdict(list)
        for t in rest:
            leaves[len(t), t[:d]].append(t)
        for group in leaves.values():
            if len(group) > 1:
                most = max(count[t] for t in group)
                firsts = [t for t in group if count[t] == most]
                assert len(firsts) == 1, "the leader is a tie, which hashes decide"
                for t in group:
                    if sum(a == b for a, b in zip(t, firsts[0])) / len(t) >= agreed:
                        leader[t] = firsts[0]
                        rest.discard(t)
    docs = defaultdict(set)
    for _, doc, _, t in lines:
        docs[leader.get(t, t)].add(doc)
    gone = defaultdict(set)
    for n, doc, k, t in lines:
        found = docs[leader.get(t, t)]
        first = min((x for x in found if x is not None), default=None)
        if len(found) >= min_docs and doc != first:
            gone[n].add(k)
    return [
        "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[n]) if text is not None else None
        for n, (_, text) in enumerate(rows)
    ]


SENTENCE = "the quick brown fox jumps over the lazy dog near the old stone bridge at"
ROWS = [
    (1, f"{SENTENCE} noon\nsomething only here in this one text"),
    (2, f"{SENTENCE} noon\nanother line that nobody else has at all"),
    (3, f"{SENTENCE} dusk\nshort line\nshort line"),
    (4, "request 17 from 10.0.0.1 took 35 ms in total\nshort line"),
    (5, "request 18 from 10.0.0.2 took 99 ms in total"),
    (6, "the quick brown cat sat down over there and then went far away home again now"),
    (7, ""),
    (8, None),
    (9, "request 18 from 10.0.0.2 took 99 ms in total"),
]


def texts(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.text is None) for r in df.collect())


def test_templates_equal_brute_force(docs):
    want = sorted((i, t or "", t is None) for (i, _), t in zip(ROWS, brute(ROWS)))
    got = texts(T.drop_repeated(docs(ROWS)))
    assert got == want
    by_id = {i: t for i, t, _ in got}
    assert by_id[1] == ROWS[0][1] and by_id[3] == "short line\nshort line"
    assert by_id[5] == "" and by_id[9] == "" and by_id[6] == ROWS[5][1]


def test_passages_stay_once(docs):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(i, f"own start of text number {'abcdefghij'[i]}\n{passage}\nown end") for i in range(10)]
    got = {r.doc_id: r.text for r in T.drop_repeated(docs(rows)).collect()}
    assert passage in got[0] and all(passage not in got[i] for i in range(1, 10))


def test_odd_rows(docs, odd, empty):
    got = T.drop_repeated(odd, dropped_col="n_dropped")
    assert got.columns == [*odd.columns, "n_dropped"] and got.count() == odd.count()
    assert texts(got) == texts(odd)
    assert T.drop_repeated(empty).count() == 0
    twice = [(None, "a line of six plain words"), (None, "a line of six plain words"), (3, "a line of six plain words")]
    assert texts(T.drop_repeated(docs(twice))) == [(-1, "", False), (-1, "", False), (3, twice[0][1], False)]


def test_query_drops_exactly_the_repeats(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    where = defaultdict(set)
    for i, t in rows:
        for line in t.split("\n"):
            if len(line.split()) >= T.MIN_TOKENS:
                where[line].add(i)
    got = {r.doc_id: r for r in T.op1_line_templates(spark, sf).collect()}
    for i, t in rows:
        kept = got[i].text.split("\n")
        for line in t.split("\n"):
            if len(line.split()) < T.MIN_TOKENS:
                assert line in kept
            elif len(where[line]) > 1 and min(where[line]) != i:
                assert line not in kept
    assert got.keys() == {i for i, _ in rows}


def test_a_leaf_has_as_many_templates_as_it_needs(docs):
    """Lines of one length that share twelve tokens: twenty templates, each in two documents with one word changed."""
    head = "all of these lines begin in the very same way and then"
    names = "abcdefghijklmnopqrst"
    body = lambda c: " ".join(f"{c}{k}" for k in ("one", "two", "three", "four", "five", "six", "seven"))
    rows = [(2 * i + k, f"{head} {body(c)} {w}{c}") for i, c in enumerate(names) for k, w in enumerate(("red", "blue"))]
    got = {r.doc_id: r.text for r in T.drop_repeated(docs(rows)).collect()}
    assert got == {i: t if i % 2 == 0 else "" for i, t in rows}


def test_short_lines_go_where_they_are_equal(docs):
    rows = [(1, "All rights reserved.\npage 17"), (2, "page 18\nAll rights reserved."), (3, "All rights kept.\npage\t17\n\n 7"), (4, "8")]
    got = {r.doc_id: r.text for r in T.drop_repeated(docs(rows)).collect()}
    assert got == {1: rows[0][1], 2: "page 18", 3: "All rights kept.\n\n 7", 4: "8"}


def test_lines_that_differ_too_much_stay(docs):
    """One word of five differs: 0.8, less than asked."""
    import random

    rng = random.Random(4)
    words = {"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(400)}
    rows = [(i, f"This report concerns our {w}") for i, w in enumerate(sorted(words))]
    assert {r.doc_id: r.text for r in T.drop_repeated(docs(rows)).collect()} == dict(rows)


def test_all_rounds_against_every_pair(docs):
    """Leaders: alike lines only follow, each a leader nobody leads, and no two lines without a leader are alike."""
    import random

    rng = random.Random(8)
    rows, stems = [], [[f"s{chr(97 + s)}{chr(97 + k)}" for k in range(20)] for s in range(6)]
    for i in range(600):
        n = rng.choice((5, 8, 14, 20))
        line = stems[rng.randrange(6)][:n]
        for _ in range(rng.choice((0, 1, 1, 2, 3, 4))):
            line = [*line]
            line[rng.randrange(2, n)] = f"x{rng.choice('abcdefghij')}"
        rows.append((i, " ".join(line)))
    lines = T._lines(docs(rows), "doc_id", "text").select("doc_id", "h1", "h2", "leaf0", "shape").toPandas()
    tokens = {(r.h1, r.h2): tuple(rows[r.doc_id][1].split(" ")) for r in lines.itertuples()}
    assert len(tokens) == len({t for _, t in rows}) > 200
    alike = lambda a, b: len(a) == len(b) and a[:3] == b[:3] and sum(x == y for x, y in zip(a, b)) >= T.AGREEMENT * len(a)
    led = {(r.h1, r.h2): (r.t1, r.t2) for r in T._leaders(T._lines(docs(rows), "doc_id", "text"), T.AGREEMENT).collect()}
    assert len(led) > 50
    for line, leader in led.items():
        assert leader not in led and line != leader and alike(tokens[line], tokens[leader])
    free = [tokens[k] for k in tokens if k not in led]
    assert not any(alike(a, b) for k, a in enumerate(free) for b in free[:k])


def test_a_line_is_cut_once(docs):
    """Cutting a text into lines and masking a line's fields stand once in the plan, not again in a condition."""
    plan = T._lines(docs([(1, "a b c d e 5"), (2, "x\t1")]), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count("\n, -1)") == 1


def test_lines_of_blanks_have_no_token(docs):
    df = docs([(1, " \t\n\x0b \f\r\n\n\u00a0"), (2, ""), (3, None)])
    assert [(r.doc_id, r.line_no) for r in T._lines(df, "doc_id", "text").collect()] == [(1, 3)]
