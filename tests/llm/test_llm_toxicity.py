import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import toxicity as T

SF_DIR = "/root/testdata/sf0.1"


def test_distance_of_learnt_and_other_words():
    plain = [f"the quiet river runs along green hills {i} and stone walls".split() for i in range(40)]
    toxic = [d + ["blorgface", "zwixhead"] for d in plain]
    model = T.fit_words(toxic, [d + ["ordinary"] for d in plain] + [["river", f"n{i}"] for i in range(40)])
    distance = T.Distance(model.ordinary, model.toxic)
    assert model.probability(distance.text(["the", "blorgface"])) >= 0.5
    assert model.probability(distance.text(["the", "quiet", "river", "ordinary"])) < 0.5


def test_threshold_is_the_best_cut():
    assert T.best_threshold([(0.0, 0), (0.1, 0), (0.3, 1), (0.5, 1)]) == pytest.approx(0.2)
    assert T.best_threshold([]) == 1.0


def test_no_label_means_nothing_is_toxic(spark, odd):
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    model = T.fit(odd, none)
    rows = odd.select(T.score(model, F.col("text")).alias("s")).collect()
    assert [r.s for r in rows] == [0.0] * len(rows)
    assert T.drop_toxic(odd, model).count() == odd.count()
    assert T.drop_toxic(odd, model).columns == odd.columns


def test_held_out_rows_are_never_learnt(spark, docs):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = docs([(i, f"text with grumbleword{'!' * (i % 3)}") for i in ids])
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id BIGINT, toxic INT")
    assert T.fit(rows, labels).toxic == b""


def test_odd_rows_and_empty_tables(spark, docs, odd, empty):
    rows = docs([(i, f"plain words {i} here" + (" grumbleface scrowlhead" if i % 2 else "")) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (7, None)], "doc_id BIGINT, toxic INT")
    model = T.fit(rows, labels)
    assert model.toxic
    kept = T.drop_toxic(rows, model)
    assert {r.doc_id for r in kept.collect()} == set(range(0, 200, 2))
    assert T.drop_toxic(odd, model).count() == odd.count()
    assert T.drop_toxic(empty, model).count() == 0


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in T.op10_toxicity(spark, SF_DIR).collect()}
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    sql = f"SELECT l.doc_id, l.toxic FROM '{SF_DIR}/labels.parquet' l JOIN '{SF_DIR}/documents.parquet' d USING (doc_id) WHERE lang = 'en'"
    held = [(got[i], y) for i, y in duckdb.sql(sql).fetchall() if got[i].held_out]
    recall = [r.predicted for r, y in held if y]
    false = [r.predicted for r, y in held if not y]
    assert sum(recall) / len(recall) > 0.9
    assert sum(false) / len(false) < 0.05


def sentences():
    """Ordinary documents, and toxic ones that use words with a stem of their own in running text."""
    plain = [f"rivergate hillside near{i} stonewall riverside and stonegate by the water{i % 7} meadow".split() for i in range(200)]
    toxic = [d[: 2 + i % 5] + [f"grumblo{'abcdefgh'[i % 8]}x"] + d[2 + i % 5 :] for i, d in enumerate(plain[:60])]
    return toxic, plain


def test_stems_are_learnt_from_running_text():
    """A word never seen is toxic by its beginning; the middle of another word isn't."""
    toxic, plain = sentences()
    model = T.fit_words(toxic, plain)
    assert b" grumblo" in model.toxic and b"stonewall" not in model.toxic
    distance = T.Distance(model.ordinary, model.toxic)
    assert model.probability(distance.text(["hillside", "grumblozz", "stonegate"])) >= 0.5
    assert model.probability(distance.text(["hillside", "rivergate", "stonewall"])) < 0.5
    assert model.probability(distance.text([])) < 0.01


def test_both_dictionaries_come_from_windows_of_their_class():
    toxic, plain = sentences()
    model = T.fit_words(toxic, plain)
    assert b"grumblo" not in model.ordinary and b"rivergate" in model.ordinary


def test_scores_equal_compressing_every_window(spark):
    """Brute force: each window of each whole text under both dictionaries, none passed over."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = T.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    if not model.toxic:
        toxic, plain = sentences()
        model = T.fit_words(toxic, plain)
    distance = T.Distance(model.ordinary, model.toxic)
    rows = docs.select("doc_id", "text", T.score(model, F.col("text")).alias("score")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        words = T.words_of(row.text or "")
        found = sum(max(0, distance.saved(w)) for w in set(T.windows(words)) if any(map(distance.shares, w)))
        unshared = sum(max(0, distance.saved(w) - 1) for w in set(T.windows(words)) if not any(map(distance.shares, w)))
        assert unshared == 0
        want = model.probability(found / (T.MORE_WORDS + len(set(words))))
        assert row.score == pytest.approx(want, abs=1e-12)


def test_long_texts_count_whole():
    """What stands at the end of a long text, and a word of a million characters."""
    toxic, plain = sentences()
    model = T.fit_words(toxic, plain)
    distance = T.Distance(model.ordinary, model.toxic)
    long = ["stonewall"] * 100_000
    assert distance.text(long) == 0 < distance.text([*long, "grumbloax"])
    assert distance.text(["x" * 1_000_000]) >= 0


def test_sampled_runs_are_bounded():
    words = [f"w{i}" for i in range(5000)]
    got = T.fit_run(" ".join(words))
    assert len(got) == T.FIT_WORDS and words[words.index(got[0]) :][: T.FIT_WORDS] == got
    assert T.fit_run("") == [] and T.fit_run("a b") == ["a", "b"]


def test_held_out_recall_in_every_language(spark):
    got = {r.doc_id: r for r in T.op10_toxicity(spark, SF_DIR).collect()}
    sql = f"SELECT l.doc_id, l.toxic, lang FROM '{SF_DIR}/labels.parquet' l JOIN '{SF_DIR}/documents.parquet' d USING (doc_id)"
    held = [(got[i].predicted, y, lang) for i, y, lang in duckdb.sql(sql).fetchall() if got[i].held_out]
    for lang in ("en", "fr", "de", "es"):
        recall, false = ([p for p, y, of in held if y == toxic and of == lang] for toxic in (1, 0))
        print(lang, sum(recall), len(recall), sum(false), len(false))
        assert sum(recall) / len(recall) > 0.8
        assert sum(false) / len(false) < 0.1
