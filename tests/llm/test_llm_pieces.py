import itertools
import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import pieces as P

MODEL = public_tokenizers.path(P.MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary(MODEL)


def sampled(vocabulary, keys, texts):
    ids, counts = P.Sampler(vocabulary).sample(keys, texts)
    ends = np.concatenate([[0], np.cumsum(counts)])
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


TEXT = st.text(st.sampled_from(list("ab eé ▁\n\t梦😀")) | st.characters(exclude_categories=["Cs"]), max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_decoding_is_lossless(texts):
    vocabulary = test_decoding_is_lossless.__dict__.setdefault("vocabulary", P.Vocabulary(MODEL))
    for ids, text in zip(sampled(vocabulary, [str(i) for i in range(len(texts))], texts), texts):
        assert (vocabulary.decode(ids) if ids else "") == text


def test_segmentations_have_the_lattice_distribution(vocabulary):
    """Frequencies against the probabilities of every segmentation of one unit, spelt out."""
    model = SentencePieceProcessor(model_file=MODEL)
    unit = " token"
    log_p = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and model.get_score(i) > P.UNUSED_SCORE:
            log_p[model.id_to_piece(i).replace("▁", " ")] = (i, -P.SHARPNESS * math.log(2 - model.get_score(i)))
    weights = {}
    for cuts in itertools.product([0, 1], repeat=len(unit) - 1):
        borders = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(unit)]
        parts = [unit[a:b] for a, b in zip(borders, borders[1:])]
        if all(p in log_p for p in parts):
            weights[tuple(log_p[p][0] for p in parts)] = math.exp(sum(log_p[p][1] for p in parts))
    total = sum(weights.values())
    n = 20_000
    seen = Counter(map(tuple, sampled(vocabulary, [f"k{i}" for i in range(n)], ["token"] * n)))
    assert set(seen) <= set(weights)
    for path, weight in weights.items():
        p = weight / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_seeds_decide(vocabulary):
    text = "reproducible segmentations of the very same sentence " * 5
    one, two, other = sampled(vocabulary, ["7", "7", "8"], [text] * 3)
    assert one == two and one != other
    # Whatever else is in the task.
    assert sampled(vocabulary, ["x", "7"], ["some other text", text])[1] == one


def test_borders_do_not_depend_on_other_units(vocabulary):
    """A unit's borders alone and behind 60,000 other units, bit by bit, and so its pieces."""
    text = "internationalisation of unforeseeable counterrevolutionaries é梦😀 aaaaaaaaaaaaaaaaaaaa"

    def borders(sampler, numbers):
        out = []
        for n in numbers:
            first = sampler.end_node[n - 1] + 1 if n else 0
            edges = slice(sampler.first_edge[first], sampler.first_edge[sampler.end_node[n] + 1])
            out.append(((sampler.bound[edges] - (int(first) << 32)).tolist(), sampler.emits[edges].tolist()))
        return out

    alone, crowd = P.Sampler(vocabulary), P.Sampler(vocabulary)
    own = alone.sample(["k"], [text])[0].tolist()
    other = " ".join(f"other{i * 7919 % 60_000}x{i}" for i in range(60_000))
    crowd.sample(["o"], [other])
    assert crowd.sample(["k"], [text])[0].tolist() == own
    mine = [borders(s, [s.spaced[t] for t in text.split(" ")]) for s in (alone, crowd)]
    assert mine[0] == mine[1] and sum(len(b) for b, _ in mine[0]) > 150


def test_long_unit_without_blanks(vocabulary):
    text = "x" * 30_000
    assert vocabulary.decode(sampled(vocabulary, ["1"], [text])[0]) == text


def test_encode_and_decode(spark, odd, empty):
    rows = P.encode(odd, MODEL)
    got = rows.collect()
    assert len(got) == odd.count() and all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    texts = {(r.doc_id, r.text or "") for r in odd.collect()}
    assert {(r.doc_id, r.text) for r in P.decode(rows, MODEL).collect()} == texts
    again = P.encode(odd.repartition(3), MODEL).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    assert P.encode(empty, MODEL).count() == 0


def test_query_is_lossless(spark):
    rows = P.op3_sampled_pieces(spark, "/root/testdata/sf0.001")
    assert rows.count() == rows.filter("lossless").count() > 0


def test_all_texts_are_decoded_at_a_time():
    vocabulary = P.Vocabulary(MODEL)
    texts = ["", "one two\nthree", "\ud800 é 梦\t", " ", "a" * 300]
    ids, counts = P.Sampler(vocabulary).sample([str(k) for k in range(len(texts))], texts)
    assert vocabulary.lossless(ids, counts, texts) == [True] * len(texts)
    ends = [0, *counts.cumsum().tolist()]
    assert [vocabulary.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])] == texts
    assert vocabulary.lossless(ids, counts, ["", "one two\nthreE", "\ud800 é 梦", "", "a" * 300]) == [True, False, False, False, True]


def test_beginnings_leave_no_piece_out():
    vocabulary = P.Vocabulary(MODEL)
    chars = P.code_points(" internationalé the xyzzyq")
    found = vocabulary.edges(chars, len(chars) - np.arange(len(chars)))
    for table in vocabulary.begins.values():
        table[:] = True
    everything = vocabulary.edges(chars, len(chars) - np.arange(len(chars)))
    assert all((a == b).all() for a, b in zip(found, everything))


def test_memory_is_bounded_by_the_texts_sampled_at_a_time():
    """31 MB, the vocabulary included; 67 MB when a megabyte of text was sampled at a time."""
    rng = np.random.default_rng(3)
    known = ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(8000)]
    texts = [" ".join(known[i] for i in rng.integers(0, len(known), 250)) for _ in range(600)]
    keys = [str(i) for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(keys), pa.array(texts)], names=["doc_id", "key", "text"])
    tracemalloc.start()
    kept = list(P.encoded(iter([batch]), MODEL))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in kept) == len(texts) and all(all(b.column("lossless").to_pylist()) for b in kept)
    assert len(kept) >= 4 and peak < 45e6
