import re
from collections import Counter
from itertools import permutations

import duckdb

import __spark_entry__ as entry
from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import audit as A


def brute(docs, labels):
    """Every order run over every document, one after the other."""
    texts = [(i, t or "", s or "") for i, t, s in docs]
    fails = []
    for i, t, _ in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        caps = len(re.findall("[A-Z]", t))
        fails.append(
            {
                "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * caps > 2 * len(t),
                "D": bool(re.search(r"[#$%&*|]", t)),
                "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts),
            }
        )
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        left = list(range(len(texts)))
        for step, f in enumerate(order, 1):
            cut = [k for k in left if fails[k][f]]
            for part in {s for *_, s in texts}:
                mine = lambda ks: [k for k in ks if texts[k][2] == part]
                failing = mine([k for k in range(len(texts)) if fails[k][f]])
                out[part, "".join(order), step] = [
                    len(mine([k for k in left if not fails[k][f]])), len(mine(cut)), len(failing) - len(mine(cut)),
                    sum(sum(fails[k].values()) == 1 for k in failing),
                    sum(texts[k][0] in good for k in mine(cut)), sum(texts[k][0] in toxic for k in mine(cut)),
                ]
                shapley[part, f] += len(mine(cut))
            left = [k for k in left if not fails[k][f]]
    return {key: (*row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def found(spark, docs, labels):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id LONG, text STRING, source STRING, mask STRING, n INT")
    labels = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    rows = A.interactions(A.mask_counts(docs, labels)).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_brute_force(spark):
    long = " ".join(f"word{k}" for k in range(250))
    rows = [
        (1, "short and plain", "a"), (2, long, "a"), (3, long, "a"), (4, long + " #", "b"), (5, "again " * 300, "b"),
        (6, "SHOUTING " * 300, "a"), (7, "short and plain", "b"), (8, None, None), (9, "", ""), (None, "short and plain", "a"),
        (2, long, "a"), (10, "x" * 100_000, "b"), (11, long + " ÄÖ\x0b\x85 naïve", "c"), (12, "A|B", "c"), (None, None, "a"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, None, 1), (4, 0, 1), (5, 1, 1), (5, 0, 0), (None, 1, 1), (7, 1, 0), (99, 1, 1)]
    assert found(spark, rows, labels) == brute(rows, labels)


def test_no_rows(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [], [(1, 1, 1)]) == {}


def test_ranks_and_other_lengths(spark):
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [A.lehmer_rank(o) for o in orders] == list(range(120))
    counts = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 4, 4, 4)], "part STRING, mask INT, n LONG, good LONG, toxic LONG")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in A.interactions(counts, "XYZ").collect()}
    assert len(rows) == 18
    assert rows["XYZ", 1] == (4, 7, 0, 21) and rows["XYZ", 2] == (4, 0, 7, 21) and rows["ZYX", 2] == (4, 7, 0, 21)


def test_query_against_sql(spark):
    base = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{base}/{name}.parquet'")
    query = con.execute(entry.oracle_sql()["op13_filter_audit"])
    names = [c[0] for c in query.description]
    want = sorted(query.fetchall())
    got = entry.queries()["op13_filter_audit"](spark, base)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == want and len(want) % 600 == 0 and want
