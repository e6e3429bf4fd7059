"""Quality rules as a bitmask ledger.

Every rule is measured once per text; a row keeps the measurements and one bit
per failed rule. Policies are versioned masks over those bits, so a policy is
applied, changed or compared without reading a text again, and an ablation is
a bitwise aggregate over the few distinct masks. All of it is column
expressions: a text never leaves its row, and nothing is shuffled but masks.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tracemill.llm.common import table, text_of

# Characters between words, and those counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _measures(text: Column) -> dict[str, Column]:
    """The plain measurements, from the text and its split columns."""
    words, lines = F.col("_words"), F.col("_lines")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
    }


# Each rule by its bit, lowest first; true where a text fails. The order is part of the ledger: add at the end only.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "10 * n_upper > 4 * n_letters",
    "few_letters": "2 * n_letters < word_chars",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
}

# A policy keeps the texts that fail none of its rules.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "shouting"),
    "v3": tuple(RULES),
}
CURRENT = "v3"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def _pairs(items: Column, size: Column, join) -> Column:
    """`join` of each item and the next one."""
    n = F.greatest(size - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), n), F.slice(items, F.lit(2), n), join)


def _sorted_windows(windows: Column) -> Column:
    """Whole window hashes with their positions, equal hashes side by side."""
    return F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i"))))


def _repeated_starts(found: Column, size: Column) -> Column:
    """The positions of windows found twice or more, in order; `found` as `_sorted_windows` gives it, of `size`."""
    pairs = _pairs(
        found,
        size,
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<bigint>")),
    )
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in three-word windows found twice or more in the text.

    Windows are told apart by hashes of 64 bits, whatever the text's length.
    """
    n = F.greatest(F.size("_words") - 2, F.lit(0))
    hashes = F.col("_hashes")
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.zip_with(
        F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: F.xxhash64(a, b)),
        F.slice(hashes, F.lit(3), n),
        lambda ab, c: F.xxhash64(ab, c),
    )
    df = df.withColumn("_windows", windows)
    df = df.withColumn("_sorted", _sorted_windows(F.col("_windows")))
    df = df.withColumn("_starts", _repeated_starts(F.col("_sorted"), n))
    three = F.lit(3).cast("long")
    covered = F.aggregate(
        _pairs(F.col("_starts"), F.size("_starts"), lambda a, b: F.least(three, b - a)), three, lambda sum, x: sum + x
    )
    return df.withColumn("n_repeat_words", F.when(F.size("_starts") > 0, covered).otherwise(F.lit(0).cast("long")))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, every measurement and `fail_bits`.

    A null or empty text has no words and fails few_words alone. Repeated rows
    and null ids give a row each; other columns aren't read.
    """
    df = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("_text"))
    has_word = lambda line: F.translate(line, SPACES, "") != ""
    df = df.withColumns(
        {
            "_words": F.array_remove(F.split("_text", "[ \\t-\\r]+"), ""),
            "_lines": F.filter(F.split("_text", "\n"), has_word),
        }
    )
    measured = _repeat_words(df).select(
        id_col, *(c.alias(name) for name, c in _measures(F.col("_text")).items()), "n_repeat_words"
    )
    bits = F.lit(0).cast("long")
    for rule, fails in RULES.items():
        bits = bits + F.when(F.expr(fails), bit(rule)).otherwise(0)
    return measured.withColumn("fail_bits", bits)


def keeps(policy: str = CURRENT, bits: Column | str = "fail_bits") -> Column:
    """Whether a text passes a policy."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """Per policy and rule: texts that fail the rule, that fail it alone, and that are kept without it.

    Rows meet as counts per distinct mask, of which there are 2^rules at most.
    """
    masks = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    long = lambda x: F.lit(x).cast("long")
    cases = F.array(
        *[
            F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), long(mask(p)).alias("mask"), long(bit(r)).alias("bit"))
            for p, rules in POLICIES.items()
            for r in rules
        ]
    )
    case = masks.select("fail_bits", "n", F.explode(cases).alias("c")).select("fail_bits", "n", "c.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).alias
    return case.groupBy("policy", "rule").agg(
        count(failed.bitwiseAND(F.col("bit")) != 0)("n_fail"),
        count(failed == F.col("bit"))("n_fail_alone"),
        count(failed.bitwiseAND(F.bitwise_not("bit")) == 0)("n_kept_without"),
    )


def op6_quality_rules(spark, sf_dir):
    base = F.col("fail_bits").bitwiseAND(F.lit(mask("v1")).cast("long")) != 0
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & keeps()).alias("kept"),
        "fail_bits",
    )


ORACLE = """
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
    FROM documents),
w AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t WHERE len(words) >= 3),
g AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM w),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
m AS (
    SELECT t.doc_id, len(words) AS n_words,
           length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           length(regexp_replace(text, '\\P{Lu}', '', 'g')) AS n_upper,
           length(regexp_replace(text, '\\P{L}', '', 'g')) AS n_letters,
           coalesce(p.n, 0) AS n_repeat_words
    FROM t LEFT JOIN p ON p.doc_id = t.doc_id),
f AS (
    SELECT *, CAST(
        (n_words < 50)::INT * 1 + (100 * n_repeat_words > 50 * n_words)::INT * 2
        + (10 * n_symbols > n_words)::INT * 4 + (10 * n_upper > 4 * n_letters)::INT * 8
        + (2 * n_letters < word_chars)::INT * 16 + (word_chars < 2 * n_words)::INT * 32
        + (word_chars > 20 * n_words)::INT * 64 + (10 * n_dup_lines > 6 * n_lines)::INT * 128 AS BIGINT) AS fail_bits
    FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM f
"""
