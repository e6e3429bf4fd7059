import check_oracle
import pytest
from hypothesis import given, settings, strategies as st

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import quality as Q


def brute(text):
    import re

    text = text or ""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1}
    covered = {k for i, w in enumerate(windows) if w in again for k in (i, i + 1, i + 2)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in Q.SYMBOLS),
        len(lines) - len(set(lines)),
        len(covered),
    )


CASES = [None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "p\nq\np\n\n p", "#$ | <é>", "a b c d a b c\nd a b c", "Ünï\tçödé\x0bx"]


def measured(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {r.doc_id: tuple(r[n] for n in names) for r in Q.ledger(df).collect()}


def test_measures_equal_brute_force(spark):
    got = measured(spark, CASES)
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab #|\n\tÄé"), max_size=60), min_size=20, max_size=40))
def test_measures_of_any_text(spark, texts):
    assert measured(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sf}"
    rows, verdict = check_oracle.compare(spark, check_oracle.connect(sf_dir), sf_dir, "op6_quality_rules")
    assert rows > 0 and verdict == "ok"
    assert entry.oracle_sql()["op6_quality_rules"]


def test_policies_and_ablations(spark, odd, empty):
    rows = Q.ledger(odd)
    assert rows.count() == odd.count() and Q.ledger(empty).count() == 0
    assert [r.fail_bits & Q.mask("v1") for r in rows.filter("doc_id = 2").collect()] == [Q.bit("few_words")]
    bits = spark.createDataFrame([(b,) for b in (0, 1, 1, 3, 4)], "fail_bits long")
    got = {(r.policy, r.rule): (r.n_fail, r.n_fail_alone, r.n_kept_without) for r in Q.ablations(bits).collect()}
    assert got["v1", "few_words"] == (3, 2, 4) and got["v1", "repeated_windows"] == (1, 0, 2)
    assert got["v3", "symbols"] == (1, 1, 2)


def test_main_path_has_no_python(spark):
    plan = Q.op6_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_windows_are_told_apart_by_their_whole_hashes(spark):
    """Hashes that differ in their upper bits only are no repeats."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([7, 7 + (1 << 62), -3, 7, 9, 7 - (1 << 63)],)], "w array<long>")
    df = df.withColumn("s", Q._sorted_windows(F.col("w")))
    assert df.select(Q._repeated_starts(F.col("s"), F.size("s")).alias("r")).first().r == [0, 3]
