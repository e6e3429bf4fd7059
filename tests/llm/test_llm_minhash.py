import itertools
import math
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import graph, minhash as M


def words(n, seed):
    rng = np.random.default_rng(seed)
    return ["".join("abcdefghijklmnopqrstuvwxyz"[c] for c in rng.integers(0, 26, 6)) for _ in range(n)]


def test_sampling_agrees_with_weighted_jaccard():
    rng = np.random.default_rng(5)
    hashes = np.sort(rng.integers(1, 2**63, 300).astype(np.uint64))
    sampler, agree, total, sims = M.Sampler(), 0, 0, []
    for _ in range(60):
        keep = rng.random(300) < 0.9
        a = hashes, rng.uniform(0.5, 3, 300)
        b = hashes[keep], a[1][keep] * rng.choice([1.0, 1.0, 1.5], keep.sum())
        drawn = [sampler.block(*x)[1] for x in (a, b)]
        agree, total = agree + (drawn[0] == drawn[1]).sum(), total + len(drawn[0])
        sims.append(M.similarity(a, b))
        hashes = M.mix(hashes)
        hashes.sort()
    assert agree / total == pytest.approx(np.mean(sims), abs=0.03)


def test_long_texts_are_sampled_in_blocks(monkeypatch):
    hashes, weights = np.arange(1, 5000, dtype=np.uint64), np.linspace(0.5, 2, 4999)
    whole = M.Sampler().bands(hashes, weights)
    monkeypatch.setattr(M, "BLOCK", 700)
    parts = M.Sampler().bands(hashes, weights)
    assert all((a == b).all() for a, b in zip(whole, parts))


def brute_classes(rows, idf):
    """Classes by comparing every two texts that share a shingle."""
    shingles = M.Shingles(idf)
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    sets = {t: shingles.of(t) for t in texts}
    having = defaultdict(list)
    for t, (hashes, _) in sets.items():
        for h in hashes.tolist():
            having[h].append(t)
    parent = {t: t for t in texts}

    def top(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in {p for group in having.values() for p in itertools.combinations(sorted(group), 2)}:
        if M.similarity(sets[a], sets[b]) >= M.SIMILARITY:
            parent[top(a)] = top(b)
    groups = defaultdict(list)
    for t, ids in texts.items():
        groups[top(t)] += ids
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, least[top(t or "")]) for i, t in rows), key=str)


def classes_of(df):
    return sorted(((r.doc_id, r.class_id) for r in M.near_duplicates(df).select("doc_id", "class_id").collect()), key=str)


def edited(base, n, seed):
    rng = np.random.default_rng(seed)
    out = list(base)
    for k, at in enumerate(rng.choice(len(base), n, replace=False)):
        out[at] = f"edit{seed}x{k}"
    return " ".join(out)


def test_classes_equal_brute_force(docs):
    base = words(300, 1)
    rows = [(i, edited(base, 2 + i % 4, i)) for i in range(40)]
    rows += [(100 + i, " ".join(words(200, 50 + i))) for i in range(10)]
    rows += [(200 + i, " ".join(words(200, 50 + i))) for i in range(10)]
    rows += [(300, "two words"), (301, "Two, words!"), (302, "two"), (303, None), (304, ""), (305, "..."), (None, "two words")]
    df = docs(rows)
    assert classes_of(df) == brute_classes(rows, M.fit_idf(df))


def test_odd_rows_and_empty_table(odd, empty):
    got = classes_of(odd)
    assert (1, 1) in got and (2, 1) in got and (3, 3) in got and got.count((5, 5)) == 2 and (None, None) in got
    assert classes_of(empty) == []
    kept = M.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, 5, 6, None]
    assert M.keep_one(empty).count() == 0


def test_later_pivots_find_links_the_first_misses(spark):
    """In one bucket: a and b are far from the pivot but near each other."""
    texts = {0: " ".join(words(100, 1)), 1: edited(words(100, 2), 1, 7), 2: edited(words(100, 2), 1, 8), 3: " ".join(words(100, 3))}
    sketch = [0] * M.SKETCH_LONGS
    members = spark.createDataFrame(
        [(9, n, 90.0, sketch, 0, 90.0, sketch) for n in texts],
        "bucket long, node long, weight double, sketch array<long>, pivot long, p_weight double, p_sketch array<long>",
    )
    stored = spark.createDataFrame(list(texts.items()), "node long, text string")
    idf = np.ones(M.IDF_BUCKETS, np.float32)
    got = {r.node: r.label for r in M.links(members, stored, idf).collect()}
    assert got == {1: 1, 2: 1}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(((r.doc_id, r.class_id) for r in M.op5_minhash_near_dedup(spark, sf).collect()), key=str)
    assert got == brute_classes(rows, M.fit_idf(docs))


def test_idf_is_that_of_all_documents(docs):
    df = docs([(1, "a b"), (2, "a c"), (3, None)])
    idf, word = M.fit_idf(df), M.Words()
    bucket = int(word["a"] % M.IDF_BUCKETS)
    assert idf[bucket] == pytest.approx(math.log1p(3 / 3) / math.log1p(3), rel=1e-5)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], [(i, 0) for i in range(1, 50)]])
def test_connected_classes(spark, edges):
    got = {r.node: r.label for r in graph.classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    for a, b in edges:
        parent.setdefault(a, {a}).add(b)
        parent.setdefault(b, {b}).add(a)
    for _ in range(len(parent)):
        for n in parent:
            parent[n] = set().union(*(parent[m] for m in parent[n]))
    assert got == {n: min(s) for n, s in parent.items()}


def test_a_pair_at_the_threshold_shares_a_band():
    assert (1 - M.SIMILARITY**M.ROWS) ** M.BANDS < 1e-4
    assert len(set(M.Sampler().bands(np.arange(1, 200, dtype=np.uint64), np.ones(199)).tolist())) == M.BANDS


def test_only_exact_bounds_keep_members_apart(spark):
    """Similar texts are linked whatever their samples say."""
    texts = {0: edited(words(100, 2), 1, 7), 1: edited(words(100, 2), 1, 8)}
    members = spark.createDataFrame(
        [(9, n, 90.0, [-n] * 3, 0, 90.0, [0] * 3) for n in texts],
        "bucket long, node long, weight double, sketch array<long>, pivot long, p_weight double, p_sketch array<long>",
    )
    stored = spark.createDataFrame(list(texts.items()), "node long, text string")
    got = {r.node: r.label for r in M.links(members, stored, np.ones(M.IDF_BUCKETS, np.float32)).collect()}
    assert got == {0: 0, 1: 0}


def _akin(n=40, words=120, edits=8):
    """Texts that are each edited from one: all share buckets, few are similar to each other."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(words)]
    texts = []
    for i in range(n):
        own = list(base)
        for k in rng.choice(words, edits, replace=False):
            own[k] = f"e{i}x{k}"
        texts.append(" ".join(own))
    return texts


def test_cells_bound_what_texts_share():
    shingles = M.Shingles(np.full(M.IDF_BUCKETS, 0.4, np.float32))
    sets = [shingles.of(t) for t in [*_akin(12), "a b c d e " * 500, "a b", ""]]
    for a in sets:
        for b in sets:
            both = np.intersect1d(a[0], b[0])
            shared = np.minimum(a[1][np.isin(a[0], both)], b[1][np.isin(b[0], both)]).sum()
            least = np.minimum(M.cells(a).astype(np.float32), M.cells(b).astype(np.float32)).astype(float)
            assert least.sum() >= shared
            sums = [M.cells(x).reshape(-1, M.CELL_SUMS).sum(axis=1).astype(np.float32) for x in (a, b)]
            assert np.minimum(*sums).astype(float).sum() >= shared


def test_texts_only_akin_are_hardly_compared(docs, monkeypatch):
    pairs, similar = [], M._similar
    monkeypatch.setattr(M, "_similar", lambda *a: pairs.append(similar(*a)) or pairs[-1])
    texts = _akin()
    got = {r.doc_id: r.class_id for r in M.near_duplicates(docs(list(enumerate(texts)))).collect()}
    compared = sum(p.count() for p in pairs[1:])
    assert len(set(got.values())) == len(texts) and pairs[0].count() >= 10 and compared <= 20


def test_cells_are_held_once_a_text(spark):
    """However many buckets it is in."""
    rows = spark.createDataFrame([(b, n) for b in range(10) for n in (1, 2)], "bucket long, node long")
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "x")], "node long, text string")
    found = M._cells_of(rows, texts, np.ones(M.IDF_BUCKETS, np.float32))
    assert sorted(r.node for r in found.collect()) == [1, 2]


def test_packed_cells_bound_what_texts_share():
    shingles = M.Shingles(np.full(M.IDF_BUCKETS, 0.4, np.float32))
    whole = [M.cells(shingles.of(t)) for t in [*_akin(12), "a b c d e " * 500, "a b", ""]]
    found = M.unpacked(pa.array([M.packed(c) for c in whole], pa.binary()))
    assert all((f >= c).all() and (f <= c + c.max() / 200 + 1e-9).all() for f, c in zip(found.astype(float), whole))


def test_rounds_end_when_few_pairs_are_similar(docs, monkeypatch):
    """The rest of a bucket meets at once, in chunks, and links between its members are found."""
    pivots, spool = [], M.spool
    monkeypatch.setattr(M, "spool", lambda df, label: pivots.append(label) or spool(df, label))
    monkeypatch.setattr(M, "CHUNK", 8)
    texts = _akin(60)
    texts += [" ".join([*t.split()[:-1], "other"]) for t in texts[30:50]]
    df = docs(list(enumerate(texts)))
    assert classes_of(df) == brute_classes(list(enumerate(texts)), M.fit_idf(df))
    assert pivots.count("pivots") <= 3


def test_what_is_left_of_a_bucket_meets_only_where_it_may_be_similar(spark, monkeypatch):
    """Texts that are only akin give no rows by the square of their number, and no link between the others is lost."""
    made, spool = {}, M.spool
    monkeypatch.setattr(M, "spool", lambda df, label: made.update({label: spool(df, label)}) or made[label])
    texts = _akin(300)
    texts += [" ".join([*t.split()[:-1], "other"]) for t in texts[:20]] + ["a b"]
    idf = np.full(M.IDF_BUCKETS, 0.4, np.float32)
    sets = [M.Shingles(idf).of(t) for t in texts]
    rows = [(b, n, float(sets[n][1].sum()), n) for b in range(6) for n in range(len(texts))]
    rows = spark.createDataFrame(rows, "bucket long, node long, weight double, class long")
    stored = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    pairs = M._unproven(rows, stored, M._cells_of(rows, stored, idf), idf, M.SIMILARITY)
    found = {(r.node, r.pivot) for r in pairs.collect()}
    similar = {(j, i) for i, j in itertools.combinations(range(len(texts)), 2) if M.similarity(sets[i], sets[j]) >= M.SIMILARITY}
    assert len(similar) >= 20 and similar <= found and made["met"].count() <= 2 * len(texts)
