import duckdb
import numpy as np
from hypothesis import given, settings, strategies as st

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import tiling as T


def brute_tiles(item, text, least):
    """Greedy string tiling by comparing every two positions."""
    item_free, text_free, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and item_free[i + n] and text_free[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        out.append((i, j, n))
        for k in range(n):
            item_free[i + k] = text_free[j + k] = False


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=3, max_size=25), st.lists(st.integers(0, 4), max_size=40), st.integers(2, 4))
def test_tiles_equal_brute_force(item, text, least):
    got = T.tiles(np.array(item), np.array(text, dtype=np.int64), min(least, len(item)))
    want = brute_tiles(item, text, min(least, len(item)))
    assert sorted(t[2] for t in got) == sorted(t[2] for t in want)


ITEM = " ".join(f"{w}{k}" for k in range(6) for w in ("alpha", "beta", "gamma", "delta", "omega"))
ITEMS = [(1, ITEM), (2, "only three words"), (3, None), (4, ""), (1, ITEM)]


def test_reordered_and_partial_passages(spark, docs):
    words = ITEM.split()
    shuffled = " and then ".join([" ".join(words[20:]), " ".join(words[:10]), " ".join(words[10:20])])
    rows = [
        (1, f"before {ITEM} after"),
        (2, shuffled.upper().replace(" ", ", ")),
        (3, " ".join(words[:16])),
        (4, " ".join(words[:14])),
        (5, " ".join(words[::2])),
        (6, "here are only three words!"),
        (7, None),
        (8, ""),
        (1, f"before {ITEM} after"),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.coverage, 3)) for r in T.find_leaks(docs(rows), items).collect())
    assert got == [(1, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0), (3, 1, 0.533), (6, 2, 1.0)]
    kept = T.drop_leaks(docs(rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7, 8] and kept.columns == docs(rows).columns


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    rows = docs([(1, ITEM), (2, "only three words"), (3, "none of it")])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(T, "BLOCK_CHARS", 1)
    assert len(list(T.blocks(items))) == 3
    assert sorted((r.doc_id, r.item_id) for r in T.find_leaks(rows, items).collect()) == [(1, 1), (2, 2)]
    assert [r.doc_id for r in T.drop_leaks(rows, items).collect()] == [3]


def test_odd_rows_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert T.find_leaks(odd, items).count() == 0 and T.drop_leaks(odd, items).count() == odd.count()
    assert T.find_leaks(empty, items).count() == 0
    none = items.limit(0)
    assert T.find_leaks(odd, none).count() == 0 and T.drop_leaks(odd, none).count() == odd.count()


def test_query_finds_every_passage(spark):
    sf = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in T.op2_string_tiling(spark, sf).collect()}
    whole = {(d, i) for d, t in docs for i, passage in items if passage in t}
    assert whole and whole <= got
    # Nothing else is reported than what brute force tiling reports.
    known = dict(items)
    for d, i in got - whole:
        a, b = T.words_of(known[i]), T.words_of(dict(docs)[d])
        assert sum(t[2] for t in brute_tiles(a, b, T.MIN_MATCH)) >= T.MIN_COVERAGE * len(a)
