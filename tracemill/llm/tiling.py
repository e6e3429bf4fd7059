"""Benchmark decontamination by greedy string tiling.

Benchmark items and texts become token numbers. Seeds of shared tokens name the
items a text may hold; for those, the longest matches that don't overlap are
marked again and again, found by running Karp-Rabin hashes, until no match of
the least length is left. The share of an item that is marked decides, so
passages count in any order.
"""

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tracemill.llm.common import free_name, table, text_of, words_of

# Tokens of a seed and of the shortest tile.
MIN_MATCH = 5
# Share of an item's tokens under tiles from which a text holds the item.
MIN_COVERAGE = 0.5
# First length searched for.
FIRST_LENGTH = 20
# Characters of items that go to every task at a time; more items make more passes over the texts.
BLOCK_CHARS = 8_000_000

_BASE = 0x9E3779B97F4A7C15 | 1


def running_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `size` tokens, modulo 2^64."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    powers = np.cumprod(np.concatenate([[1], np.full(size - 1, _BASE & (2**64 - 1), np.uint64)]).astype(np.uint64), dtype=np.uint64)
    spread = tokens.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += spread[k : k + n] * powers[size - 1 - k]
    return out


def match_at(item: np.ndarray, text: np.ndarray, i: int, j: int, item_free: np.ndarray, text_free: np.ndarray) -> int:
    """How many tokens agree from here on without touching a tile."""
    n = min(len(item) - i, len(text) - j)
    good = (item[i : i + n] == text[j : j + n]) & item_free[i : i + n] & text_free[j : j + n]
    return n if good.all() else int(good.argmin())


def longest_matches(item, text, size, item_free, text_free) -> list[tuple[int, int, int]]:
    """(length, item position, text position) of the matches of `size` tokens or more, hashes confirmed by tokens."""
    hashes = running_hashes(item, size)
    if not len(hashes):
        return []
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    of_text = running_hashes(text, size)
    low = np.searchsorted(ranked, of_text)
    hit = np.flatnonzero((low < len(ranked)) & (ranked[np.minimum(low, len(ranked) - 1)] == of_text))
    found = []
    for j in hit.tolist():
        k = low[j]
        while k < len(ranked) and ranked[k] == of_text[j]:
            i = int(order[k])
            k += 1
            if i and j and item[i - 1] == text[j - 1] and item_free[i - 1] and text_free[j - 1]:
                continue  # part of a longer match
            length = match_at(item, text, i, j, item_free, text_free)
            if length >= size:
                found.append((length, i, j))
    return found


def tiles(item: np.ndarray, text: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, text position, length) of the tiles.

    Of equally long matches the first in the item, then in the text, is marked.
    """
    item_free, text_free = np.ones(len(item), bool), np.ones(len(text), bool)
    out, size = [], max(min_match, min(FIRST_LENGTH, len(item)))
    while True:
        found = longest_matches(item, text, size, item_free, text_free)
        longest = max((m[0] for m in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        for length, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if item_free[i : i + length].all() and text_free[j : j + length].all():
                item_free[i : i + length] = text_free[j : j + length] = False
                out.append((i, j, length))
        if found:
            # What a tile cut short may still match at this length.
            continue
        if size == min_match:
            return out
        size = max(min_match, size // 2)


class Items:
    """A block of benchmark items and the seeds that lead to them."""

    def __init__(self, items: list[tuple[object, str]], min_match: int = MIN_MATCH):
        self.min_match = min_match
        self.numbers: dict[str, int] = {}
        self.items: list[tuple[object, np.ndarray]] = []
        seeds = defaultdict(set)
        for key, text in items:
            words = words_of(text)
            tokens = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)
            if not len(tokens):
                continue
            for h in running_hashes(tokens, min(min_match, len(tokens))).tolist():
                seeds[min(min_match, len(tokens)), h].add(len(self.items))
            self.items.append((key, tokens))
        # Items shorter than a seed are seeds of their own length.
        self.seeds: dict[int, dict[int, set[int]]] = defaultdict(dict)
        for (size, h), of in seeds.items():
            self.seeds[size][h] = of
        self.ranked = {size: np.sort(np.fromiter(of, np.uint64, len(of))) for size, of in self.seeds.items()}

    def coverage(self, text: str, least: float) -> list[tuple[object, float]]:
        """The items of which at least this share is under tiles, and the share."""
        words = words_of(text)
        tokens = np.fromiter(map(self.numbers.get, words, itertools.repeat(0)), np.int64, len(words))
        candidates = set()
        for size, ranked in self.ranked.items():
            hashes = running_hashes(tokens, size)
            at = np.minimum(np.searchsorted(ranked, hashes), len(ranked) - 1)
            for h in np.unique(hashes[ranked[at] == hashes]).tolist():
                candidates |= self.seeds[size][h]
        out = []
        for k in sorted(candidates):
            key, item = self.items[k]
            part = self.near(item, tokens)
            marked = sum(t[2] for t in tiles(item, part, min(self.min_match, len(item))))
            if marked >= least * len(item):
                out.append((key, marked / len(item)))
        return out

    @staticmethod
    def near(item: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The text's tokens that the item has, a 0 for each run of others: no tile can lie elsewhere."""
        known = np.isin(tokens, item)
        border = known | np.concatenate([[True], known[:-1]])
        return np.where(known, tokens, 0)[border]


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[object, str]]]:
    """The items, `BLOCK_CHARS` characters at a time, so that a task holds no more at once.

    Null ids stay, null texts are passed over, equal rows count once.
    """
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    block, size = [], 0
    for row in rows.distinct().orderBy("item", "text").toLocalIterator():
        block.append((row["item"], row["text"]))
        size += len(row["text"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _leaks(items: list[tuple[object, str]], kind: str, text: Column, least: float, min_match: int) -> Column:
    @F.pandas_udf(f"array<struct<item_id:{kind},coverage:double>>")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Items(items, min_match)
        for texts in batches:
            yield texts.map(lambda t: [{"item_id": k, "coverage": c} for k, c in known.coverage(t, least)])

    return leaks(text_of(text))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = MIN_COVERAGE,
    min_match: int = MIN_MATCH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, coverage) for every text and item it holds a share of `least` of or more.

    Each text is read where it lies. Null and empty texts hold nothing; an
    item without a token is held by none; repeated rows give repeated rows.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    found = None
    for items in blocks(benchmark, item_col):
        some = docs.select(F.col(id_col).alias("doc_id"), _leaks(items, kind, F.col(text_col), least, min_match).alias("leaks"))
        some = some.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.coverage")
        found = some if found is None else found.union(some)
    if found is None:
        schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {kind}, coverage double"
        return docs.sparkSession.createDataFrame([], schema)
    return found


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = MIN_COVERAGE, min_match: int = MIN_MATCH, text_col: str = "text"
) -> DataFrame:
    """The rows whose text holds no item, columns as they were."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    for items in blocks(benchmark):
        name = free_name(docs, "leaks")
        leaks = _leaks(items, kind, F.col(text_col), least, min_match)
        docs = docs.withColumn(name, leaks).filter(F.size(name) == 0).drop(name)
    return docs


def op2_string_tiling(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
