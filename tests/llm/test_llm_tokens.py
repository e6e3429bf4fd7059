import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import tokens as T

PATH = public_tokenizers.path(T.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abcXYZ éÉßÇß.,;!?'s0127\n\t\r ́İΣσK 梦😀<|>_-")) | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=6))
def test_chunks_encode_as_the_whole_text(texts):
    whole = Tokenizer.from_file(PATH)
    encoder = T.Encoder(PATH)
    ids, counts = encoder.encode(texts + ["<|endoftext|> it's"])
    ends = T.offsets_of(counts)
    for t, a, b in zip(texts + ["<|endoftext|> it's"], ends, ends[1:]):
        assert ids[a:b].tolist() == whole.encode(t, add_special_tokens=False).ids + [T.END_ID]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=12), max_size=8))
def test_code_round_trip(documents):
    counts = np.array([len(d) for d in documents], np.int64)
    values = np.array([v for d in documents for v in d], np.uint32)
    control, data, n_control, n_data = T.encode_ranks(values, counts)
    assert len(control) == n_control.sum() and len(data) == n_data.sum()
    assert T.decode_ranks(control, data, counts).tolist() == values.tolist()


def expected(tokenizer, rows):
    out, start = [], 0
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [T.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_in_order(spark, docs, tmp_path, tokenizer):
    rows = [(i, f"Some Text, number {i}!" + " more" * (i % 50)) for i in range(300)] + [(-5, None), (1000, "")]
    T.write_tokens(T.tokenize(docs(rows[::-1]), PATH), str(tmp_path / "f"))
    got = sorted(tuple(r) for r in T.read_tokens(spark, str(tmp_path / "f"), summary=True).collect())
    assert got == expected(tokenizer, sorted(rows))
    ids = {r.doc_id: r.ids for r in T.read_tokens(spark, str(tmp_path / "f")).collect()}
    assert ids[-5] == [T.END_ID] and len(ids[7]) == next(n for i, _, n, _ in got if i == 7)
    # Files stand in ascending order of ids, and rows within them.
    order = [r.doc_id for r in spark.read.parquet(str(tmp_path / "f" / "ids")).orderBy("file", "local_start").collect()]
    assert order == sorted(i for i, _ in rows)
    # The commonest id has rank 0.
    book = spark.read.parquet(str(tmp_path / "f" / "codebook")).orderBy("rank").collect()
    assert book[0].id == max(set(x for v in ids.values() for x in v), key=lambda x: (sum(v.count(x) for v in ids.values()), -x))


def test_odd_rows_and_empty_table(spark, odd, empty, tmp_path):
    T.write_tokens(T.tokenize(odd, PATH), str(tmp_path / "odd"))
    got = T.read_tokens(spark, str(tmp_path / "odd")).collect()
    assert len(got) == odd.count()
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:]))
    assert next(r for r in got if r.doc_id is None).start == 0
    T.write_tokens(T.tokenize(empty, PATH), str(tmp_path / "empty"))
    assert T.read_tokens(spark, str(tmp_path / "empty")).count() == 0


def test_query_equals_plain_encoding(spark, tokenizer):
    import duckdb

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    assert sorted(tuple(r) for r in T.op8_token_output(spark, sf).collect()) == expected(tokenizer, rows)
