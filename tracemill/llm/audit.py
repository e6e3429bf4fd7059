"""How document filters overlap, for every order in which they could run.

A filter order is a permutation, its rank among all orders in dictionary order
the Lehmer code: 24, 6, 2 and 1 times the number of smaller letters still to
come, for five filters. Orders that begin alike are neighbours in rank, so the
orders in which documents of one failure mask go at a given step are a few
intervals of ranks. Each interval adds the mask's counts at its start and takes
them off behind its end; a running sum over the ranks then gives every order's
totals. Documents are counted once by mask, whatever the number of orders.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tracemill.llm.common import table, text_of

LETTERS = "ABCDE"
EFFECTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def lehmer_rank(order: str, letters: str = LETTERS) -> int:
    """The rank of a permutation, or of the first one that begins with `order`."""
    left, rank = sorted(letters), 0
    for letter in order:
        at = left.index(letter)
        rank += at * factorial(len(left) - 1)
        left.pop(at)
    return rank


def intervals(spark: SparkSession, letters: str = LETTERS) -> DataFrame:
    """(mask, step, start, stop, keeps, removes, repeats, alone): what a mask's documents meet where.

    One row for each mask and beginning of an order in which something happens
    to them; 10,400 rows at most for five filters, whatever the data.
    """
    bit = {letter: 1 << k for k, letter in enumerate(letters)}
    rows = []
    for step in range(1, len(letters) + 1):
        length = factorial(len(letters) - step)
        for begun in permutations(letters, step):
            start = lehmer_rank("".join(begun), letters)
            before, last = sum(bit[b] for b in begun[:-1]), bit[begun[-1]]
            for mask in range(1 << len(letters)):
                fails, gone = bool(mask & last), bool(mask & before)
                effect = (not fails and not gone, fails and not gone, fails and gone, mask == last)
                if any(effect):
                    rows.append((mask, step, start, start + length, *map(int, effect)))
    return spark.createDataFrame(rows, "mask INT, step INT, start INT, stop INT, keeps INT, removes INT, repeats INT, alone INT")


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row a part, order and step from (part, mask, n, good, toxic), rows of one part and mask added up.

    Columns: part, filter_order, step, `EFFECTS` and shapley, all counts as
    longs. Bit k of a mask is set where the documents fail the k-th letter. A
    part appears with all orders as soon as it has a row; no rows give none.
    """
    ranks = factorial(len(letters))
    met = counts.join(F.broadcast(intervals(counts.sparkSession, letters)), "mask")
    amounts = [
        F.col("n") * F.col("keeps"), F.col("n") * F.col("removes"), F.col("n") * F.col("repeats"),
        F.col("n") * F.col("alone"), F.col("good") * F.col("removes"), F.col("toxic") * F.col("removes"),
    ]
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign"))))
    marks = met.select("part", "step", ends.alias("end"), *[a.alias(e) for a, e in zip(amounts, EFFECTS)])
    marks = marks.filter(F.col("end.rank") < ranks)
    marks = marks.select("part", "step", F.col("end.rank").alias("rank"), *[(F.col(e) * F.col("end.sign")).alias(e) for e in EFFECTS])
    grid = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"), *[F.lit(0).cast("long").alias(e) for e in EFFECTS])
    steps = marks.union(grid).groupBy("part", "step", "rank").agg(*[F.sum(e).alias(e) for e in EFFECTS])

    so_far = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    totals = steps.select("part", "step", F.element_at(orders, F.col("rank") + 1).alias("filter_order"), *[F.sum(e).over(so_far).alias(e) for e in EFFECTS])
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    shapley = F.sum("removed").over(Window.partitionBy("part", letter))
    return totals.select("part", "filter_order", "step", *EFFECTS, shapley.alias("shapley"))


def failures(text: Column) -> dict[str, Column]:
    """The conditions A to D of a text, by letter."""
    words = F.array_remove(F.split(text, "[ \\t-\\r]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of documents by what they fail.

    `docs` has doc_id, text and source, `labels` doc_id, quality and toxic. A
    null text is empty, a null source the part ''. A document fails E if a
    smaller doc_id has the same text (by SHA-256); one without an id fails it
    never, nor do rows that repeat the smallest id. Each row counts, repeated
    ones too. Of several labels of one id the highest counts; without one a
    document is neither good nor toxic.

    Texts are read once and don't travel: what is shuffled is a digest and a
    mask. The smallest id of a text is joined on text and id, so the copies of
    one text spread over all tasks.
    """
    text = text_of("text")
    bits = [F.when(failed, F.lit(1 << LETTERS.index(letter))).otherwise(0) for letter, failed in failures(text).items()]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("source").alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"),
    )
    first = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(True).alias("is_first"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = rows.join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    mask = F.col("mask") + F.when(again, F.lit(1 << LETTERS.index("E"))).otherwise(0)
    return marked.groupBy("part", mask.cast("int").alias("mask")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over whole `documents`, by source and order."""
    return interactions(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE = """
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS words
    FROM documents
), flags AS (
    SELECT doc_id, part,
           (len(words) < 200)::INT + (100 * len(list_distinct(words)) < 50 * len(words))::INT * 2
         + (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT * 4
         + regexp_matches(text, '[#$%&*|]')::INT * 8
         + coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT * 16 AS mask
    FROM words
), known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
), counts AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM flags LEFT JOIN known USING (doc_id) GROUP BY 1, 2
), orders(filter_order, used) AS (
    SELECT '', 0
    UNION ALL
    SELECT filter_order || letter, used + bit
    FROM orders, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)
    WHERE used & bit = 0
), steps AS (
    SELECT filter_order, step, filter_order[step] AS letter,
           1 << (ord(filter_order[step]) - 65) AS this,
           list_sum(list_transform(range(1, step), lambda k: 1 << (ord(filter_order[k]) - 65))) AS earlier
    FROM orders, range(1, 6) AS s(step) WHERE used = 31
), totals AS (
    SELECT part, filter_order, step::INT AS step, letter,
           sum(n) FILTER (WHERE mask & (this | coalesce(earlier, 0)::INT) = 0) AS kept,
           sum(n) FILTER (WHERE mask & this <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS removed,
           sum(n) FILTER (WHERE mask & this <> 0 AND mask & coalesce(earlier, 0)::INT <> 0) AS redundant,
           sum(n) FILTER (WHERE mask = this) AS unique_fails,
           sum(good) FILTER (WHERE mask & this <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS good_lost,
           sum(toxic) FILTER (WHERE mask & this <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS toxic_lost
    FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM totals
"""
