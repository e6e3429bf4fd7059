import math
import random

import duckdb
import numpy as np

import __spark_entry__ as entry
from tracemill.llm import negatives as N
from tracemill.session import spool

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, block STRING, slot STRING, id INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", "y", 7) for i, v, y in rows], SCHEMA)


def brute(rows, is_anchor, positives=5, negatives=5, least=80, most=100, scale=256):
    rows = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows]
    out = []
    for a, v, y in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, u)), i, z) for i, u, z in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            window = [(i, -t) for t, i, z in scored if z != y and least * -s <= 100 * -t <= most * -s]
            out += [(a, p, k, i, -s, t) for k, (i, t) in enumerate(window[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def rows_of(n, dim, seed):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(dim)]
    out = []
    for i in range(n):
        v = [rng.gauss(0, 0.5) + (b if i % 3 == 0 else 0) for b in base]
        # A third are alike; some are equal, some have zeros, some are all negative.
        if i % 11 == 0:
            v = list(base)
        if i % 13 == 0:
            v = [0.0] * (dim // 2) + v[dim // 2 :]
        out.append((i * 2 - 9, v, rng.choice([0, 1, 1, 1, 2, -4])))
    return out


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    monkeypatch.setattr(N, "BLOCK_ANCHORS", 7)
    for n, dim, group in ((400, 20, 3), (300, 5, 8)):
        monkeypatch.setattr(N, "GROUP", group)
        rows = rows_of(n, dim, n)
        got = found(N.hard_negatives(frame(spark, rows), "id % 5 = 0"))
        want = brute(rows, lambda i: i % 5 == 0)
        assert got == want and len(want) > 100


def test_settings_of_the_general_interface(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    rows = rows_of(200, 6, 9)
    got = found(N.hard_negatives(frame(spark, rows), "id > 0", positives=2, negatives=3, least=10, most=150, scale=16))
    assert got == brute(rows, lambda i: i > 0, 2, 3, 10, 150, 16) != []


def test_rows_that_take_no_part_and_small_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.9, 0.1], 2), (4, [-1.0, 0.0], 1)]
    odd = [(5, None, 1), (6, [1.0, None], 2), (7, [math.nan, 1.0], 2), (8, [math.inf, 0.0], 2), (9, [0.95, 0.0], None), (None, [0.95, 0.0], 2),
           (10, [], 2), (11, [0.95], 2), (2, [0.9, 0.0], 2)]
    got = found(N.hard_negatives(frame(spark, rows + odd), "id = 0"))
    assert got == brute(rows, lambda i: i == 0) and [r[3] for r in got] == [2, 3]
    for few in ([], odd[:1], rows[:1], rows[:2]):
        assert found(N.hard_negatives(frame(spark, few), "id = 0")) == []
    # Without anchors, and where every vector is zero: all scores are 0 and count as equal.
    assert found(N.hard_negatives(frame(spark, rows), "id = 77")) == []
    zero = [(i, [0.0, 0.0], i % 2) for i in range(6)]
    assert found(N.hard_negatives(frame(spark, zero), "id = 0")) == brute(zero, lambda i: i == 0) != []


def test_components_beyond_exact_doubles(spark):
    rows = [(i, [1e5 * (i + 1) + 0.3 * i, 3e5 + i, -2e5 + 7 * i], i % 3) for i in range(30)]
    got = found(N.hard_negatives(frame(spark, rows), "id % 4 = 0", least=1, most=300))
    assert got == brute(rows, lambda i: i % 4 == 0, least=1, most=300) != []
    far = [(i, [1e30 * (i + 1)], i % 2) for i in range(6)]
    assert {r[4] for r in found(N.hard_negatives(frame(spark, far), "true", least=0))} == {(1 << 63) - 1}


def test_index_leaves_out_what_cannot_matter():
    rng = np.random.default_rng(5)
    vecs = np.floor(rng.normal(size=(300, 32)) * np.linspace(60, 1, 32))
    norm = np.linalg.norm(vecs, axis=1).max()
    low, high = (N.Postings(vecs, norm, t * norm * norm).entered.sum() for t in (0.1, 0.6))
    assert high < low < 300 * 4


def test_query_against_sql(spark):
    base = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{base}/embeddings.parquet'")
    query = con.execute(entry.oracle_sql()["op12_hard_negatives"])
    names = [c[0] for c in query.description]
    want = sorted(query.fetchall())
    got = entry.queries()["op12_hard_negatives"](spark, base)
    assert got.columns == names and found(got) == want and len(want) > 200


def test_anchors_are_not_sent_once_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 8)
    limit = "spark.sql.maxBroadcastTableSize"
    was = spark.conf.get(limit)

    def limited(df, label):
        # Where anchors meet blocks: 120 anchors of 512 bytes and their windows, which would be 8 MB with each of 75 blocks.
        spark.conf.set(limit, 1 << 20 if label == "found" else was)
        try:
            return spool(df, label)
        finally:
            spark.conf.set(limit, was)

    monkeypatch.setattr(N, "spool", limited)
    rows = rows_of(600, 64, 2)
    assert found(N.hard_negatives(frame(spark, rows), "id % 5 = 0")) == brute(rows, lambda i: i % 5 == 0) != []


def test_waves_of_anchors_and_bests_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 20)
    monkeypatch.setattr(N, "BLOCK_ANCHORS", 9)
    monkeypatch.setattr(N, "TILE", 4)
    monkeypatch.setattr(N, "WAVE_BYTES", 4 << 10)
    labels = []
    monkeypatch.setattr(N, "spool", lambda df, label: labels.append(label) or spool(df, label))
    rows = rows_of(200, 12, 4)
    assert found(N.hard_negatives(frame(spark, rows), "id % 5 = 0")) == brute(rows, lambda i: i % 5 == 0) != []
    assert labels.count("found") > labels.count("packs") + 2
