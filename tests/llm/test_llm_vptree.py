import math

import duckdb
import numpy as np

import __spark_entry__ as entry
from tracemill.llm import vptree as V

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, region STRING, rank STRING, id INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y", 7) for i, v in rows], SCHEMA)


def brute(rows, is_query, k):
    """query -> [(vec_id, distance)], nearest first."""
    rows = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows]
    out = {}
    for i, v in rows:
        if is_query(i):
            out[i] = sorted((float(np.sqrt(((v - u) ** 2).sum())), j) for j, u in rows if j != i)[:k]
    return {i: [(j, d) for d, j in near] for i, near in out.items()}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert {q: [i for i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-15) for q in want for (_, a), (_, b) in zip(got[q], want[q]))


def points(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    vecs[: n // 4] = vecs[n - 1] + rng.normal(size=(n // 4, dim)).astype(np.float32) * 0.01
    vecs[n // 2 : n // 2 + copies] = vecs[0]
    return [(int(i) * 3 - 5, v.tolist()) for i, v in zip(rng.permutation(n), vecs)]


def test_factor_one_is_exact(spark, monkeypatch):
    # Many regions, a hot one of several shards and cells, blocks of few queries, deep trees.
    for name, value in (("SHARD_ROWS", 60), ("BLOCK_QUERIES", 5), ("LEAF", 4), ("CELL_SHARDS", 2)):
        monkeypatch.setattr(V, name, value)
    rows = points(700, 8, 1, copies=150)
    got = V.neighbours(frame(spark, rows), "id % 10 = 0", factor=1.0)
    same(found(got), brute(rows, lambda i: i % 10 == 0, 10))


def test_fewer_rows_than_asked_ties_and_rows_that_take_no_part(spark):
    rows = [(1, [1, 0]), (2, [0, 1]), (3, [0, -1]), (4, [0, 1]), (-5, [-1, 0])]
    odd = [(6, None), (7, [0, 0]), (8, [1, None]), (9, [math.nan, 1]), (10, [math.inf, 1]), (11, []), (None, [1, 1]), (12, [1, 2, 3]), (1, [1, 0])]
    got = found(V.neighbours(frame(spark, rows + odd), "true", factor=1.0))
    same(got, brute(rows, lambda i: True, 10))
    assert [i for i, _ in got[1]] == [2, 3, 4, -5] and got[2][0] == (4, 0.0)


def test_repeated_id_counts_once(spark):
    got = found(V.neighbours(frame(spark, [(1, [3, 0]), (1, [2, 0]), (2, [1, 0])]), "true"))
    assert got == {1: [(2, 1.0)], 2: [(1, 1.0)]}


def test_no_rows_and_no_queries(spark):
    for rows, asked in (([], "true"), ([(1, None)], "true"), ([(1, [1, 2])], "false"), ([(1, [1, 2])], "true")):
        got = V.neighbours(frame(spark, rows), asked)
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.collect() == []


def test_bounds_hold():
    """No region's bound exceeds the distance of any of its rows; a greater factor visits fewer rows."""
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(2000, 6))
    regions = V.Regions(vecs[:512], 16)
    where = regions.of(vecs)
    bound = regions.bounds(vecs[:50])
    for q in range(50):
        away = V.distances(vecs[q], vecs)
        assert (bound[q][where] <= away + 1e-12).all()
    built = V.Tree(vecs.copy(), np.arange(2000))
    tree = V.Tree(built.vecs, built.ids, built.bounds)
    visited = [tree.search(vecs[:50], np.arange(50), np.full(50, np.inf), 10, f).visited for f in (1.0, 2.0, 4.0, 8.0)]
    assert visited == sorted(visited, reverse=True) and visited[-1] < visited[0]


def test_query_recall(spark):
    base = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{base}/embeddings.parquet'").fetchall()
    want = brute(rows, lambda i: i % 100 == 0, 10)
    got = found(entry.queries()["op11_vantage_points"](spark, base))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    true = dict(((q, i), d) for q, near in brute(rows, lambda i: i % 100 == 0, len(rows)).items() for i, d in near)
    assert all(math.isclose(d, true[q, i], rel_tol=1e-12) for q in got for i, d in got[q])
