import duckdb

from llm_rows import docs, empty, odd  # noqa: F401
import corpus_pipeline as C
from tracemill.llm import minhash, tiling

SF_DIR = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    assert [name for name, _ in C.STAGES][2] == "near dedup" and len(C.STAGES) == 5
    for k, (_, stage) in enumerate(C.STAGES):
        docs = C.spool(stage(spark, docs, SF_DIR), "stage")
        kept.append(docs)
        if k < 4:
            assert docs.columns == columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert ids[0] == ids[1] >= ids[2] >= ids[3] == ids[4]
    # Line dedup leaves no long line in two documents.
    rows = kept[1].select("doc_id", "text").collect()
    where = {}
    for r in rows:
        for line in r.text.split("\n"):
            if len(line.split()) >= 5:
                where.setdefault(line, set()).add(r.doc_id)
    assert all(len(found) == 1 for found in where.values())
    # Near dedup keeps one of each class, decontamination what holds no item.
    classes = minhash.near_duplicates(kept[1]).collect()
    assert {r.class_id for r in classes} == ids[2]
    leaks = tiling.find_leaks(kept[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()
    assert ids[2] - {r.doc_id for r in leaks} == ids[3]
    assert kept[4].filter("lossless").count() == len(ids[3])


def test_run_and_whole_texts(spark):
    n = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchall()[0][0]
    rows = C.run(spark, SF_DIR)
    assert 0 < rows.count() < n and rows.columns == ["doc_id", "n_pieces", "ids", "lossless"]


def test_odd_rows_and_empty_table(spark, odd, empty):
    for rows, left in ((odd, 6), (empty, 0)):
        docs = rows
        for _, stage in C.STAGES:
            docs = C.spool(stage(spark, docs, SF_DIR), "stage")
        assert docs.count() == left
