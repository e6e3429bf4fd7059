"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles. Improved consistent weighted
sampling draws a fixed number of samples from it such that two texts agree on a
sample with the probability of their weighted Jaccard similarity; bands of
samples make candidates, and the similarity itself decides. Equal texts are one
node from the start, so copies cost a row each and no comparison.
"""

import math
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tracemill.llm.common import free_name, pieces, table, text_of
from tracemill.llm.graph import classes
from tracemill.session import spool

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# A pair of similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS: 0.9999 at 0.8.
BANDS, ROWS = 18, 4
# Nothing but exact bounds keeps members of a bucket from being compared, so signatures carry no sketch.
SKETCH_LONGS = 0
# Cells that shingles are dealt to by hash, and so many of them added up for a first look. What two texts share weighs
# no more than the lesser of their weights in each cell, added up.
CELLS, CELL_SUMS = 512, 4
# Words are counted by hash in so many buckets, so what every task receives has a fixed size.
IDF_BUCKETS = 1 << 18
# Pivots a bucket may have at a time of either sort; they begin with one and become four times as many by round.
PIVOTS = 512
# Rounds of pivots go on while such a share of the pairs compared is similar; then what is left meets at its rarest shingles.
FRUITFUL = 0.5
# Pairs whose cells are added up at a time.
CHUNK = 256
# Words whose hash, and texts whose shingles, one task keeps at a time.
CACHE_WORDS, CACHE_TEXTS = 300_000, 256
# Shingles sampled at a time, which bounds the memory for a long text and keeps it near the processor.
BLOCK = 1 << 9

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_EDGE = re.compile(r"^\W+|\W+$")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, by bisection of its closed form."""
    at = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < at
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low


class Words(dict):
    """Hash of each blank-separated token without case and outer punctuation; 0 if nothing is left."""

    def __missing__(self, token: str) -> int:
        word = token.lower() if token.isalnum() else _EDGE.sub("", token.lower())
        value = self[token] = (xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) or 1) if word else 0
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        tokens = text.split()
        if len(tokens) < 2:
            hashes = np.array([self[token] for token in tokens], np.uint64)
        else:
            hashes = np.fromiter(itemgetter(*tokens)(self), np.uint64, len(tokens))
        return hashes[hashes != 0]


class Shingles:
    """Texts as weighted sets: sorted shingle hashes and their weights.

    The weight is tf * (1 + idf) / 2, idf being the mean over the shingle's
    words of log(1 + N / (1 + df)) / log(1 + N). Document frequencies are those
    of words: a shingle's own says no more than how often it was copied, which
    must not lower the similarity of copies.
    """

    def __init__(self, idf: np.ndarray):
        self.words, self.idf = Words(), idf
        self.kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = self.words.of(text)
        if not len(words):
            return words, np.empty(0)
        size = min(SHINGLE_WORDS, len(words))
        n = len(words) - size + 1
        hashes, idf = np.zeros(n, np.uint64), np.zeros(n)
        word_idf = self.idf[(words % np.uint64(IDF_BUCKETS)).astype(np.int64)]
        for k in range(size):
            hashes = mix(hashes * _STEP + words[k : k + n])
            idf += word_idf[k : k + n]
        found, first, tf = np.unique(hashes, return_index=True, return_counts=True)
        return found, tf * (1 + idf[first] / size) / 2

    def recent(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """As `of`, and the same text's again at once."""
        known = self.kept.get(text)
        if known is None:
            if len(self.kept) >= CACHE_TEXTS:
                self.kept.clear()
            known = self.kept[text] = self.of(text)
        return known


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 if either set is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    shared = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


class Sampler:
    """Improved consistent weighted sampling.

    For a shingle of weight w and each sample there are r and c, gamma of shape
    2, and b, uniform, all fixed by the shingle's hash:
    t = floor(ln w / r + b), ln a = ln c - r (t - b) - r. The shingle of least a
    is drawn, and with its t it is the sample. One mixed hash of 64 bits feeds
    two samples: twelve bits for r, twelve for c, eight for b.
    """

    def __init__(self):
        gamma = gamma_quantiles(1 << 12)
        self.r, self.log_c = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        half = np.arange(1, BANDS * ROWS // 2 + 1, dtype=np.uint64)
        self.seeds = mix(half * _STEP)[:, None]

    def block(self, hashes: np.ndarray, weights: np.ndarray):
        z = mix(hashes[None, :] ^ self.seeds)
        # Either half of 32 bits is a sample's; arrays are worked on in place, as making them takes the time.
        halves = np.concatenate((z.astype(np.uint32), (z >> np.uint64(32)).astype(np.uint32)))
        log_weights = np.log(weights).astype(np.float32)
        r = self.r.take(halves & np.uint32(0xFFF), mode="clip")
        a = self.log_c.take((halves >> np.uint32(12)) & np.uint32(0xFFF), mode="clip")
        halves >>= np.uint32(24)
        b = halves.astype(np.float32)
        b *= np.float32(1 / 256)
        t = log_weights / r
        t += b
        np.floor(t, out=t)
        # a = ln c - r (t - b + 1)
        np.subtract(t, b, out=b)
        b += np.float32(1)
        b *= r
        a -= b
        least, rows = a.argmin(axis=1), np.arange(len(a))
        return a[rows, least], mix(hashes[least] + t[rows, least].astype(np.int64).astype(np.uint64) * _STEP)

    def bands(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One key a band; none without shingles."""
        if not len(hashes):
            return np.empty(0, np.int64)
        best, drawn = self.block(hashes[:BLOCK], weights[:BLOCK])
        for at in range(BLOCK, len(hashes), BLOCK):
            a, sample = self.block(hashes[at : at + BLOCK], weights[at : at + BLOCK])
            drawn, best = np.where(a < best, sample, drawn), np.minimum(a, best)
        keys = np.arange(BANDS, dtype=np.uint64)
        for row in drawn.reshape(ROWS, BANDS):
            keys = mix(keys * _STEP + row)
        return keys.view(np.int64)


def fit_idf(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The idf of each word bucket over all documents, between 0 and 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, n = Words(), np.zeros(IDF_BUCKETS, np.int64), 0
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                found = np.unique(words.of(text) % np.uint64(IDF_BUCKETS)).astype(np.int64)
                counts[found] += 1
                n += 1
        buckets = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(buckets, -1)), pa.array(np.append(counts[buckets], n))], names=["bucket", "n"]
        )

    rows = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    # IDF_BUCKETS + 1 rows at most.
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(IDF_BUCKETS)
    words = sums[sums["bucket"] >= 0]
    df[words["bucket"].to_numpy()] = words["n"]
    n = int(sums.loc[sums["bucket"] < 0, "n"].sum())
    return (np.log1p(n / (1 + df)) / math.log1p(max(n, 1))).astype(np.float32)


def signatures(docs: DataFrame, idf: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, digest of the text, weight and band keys."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sampler = Shingles(idf), Sampler()
        for batch in pieces(batches):
            weights, bands = [], []
            for text in batch.column(2).to_pylist():
                hashes, weight = shingles.of(text)
                weights.append(float(weight.sum()))
                bands.append(sampler.bands(hashes, weight))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weights, pa.float64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "weight", "bands"],
            )

    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, digest string, weight double, bands array<long>")


def _members(nodes: DataFrame) -> DataFrame:
    """A row per text and bucket, of the buckets with two texts or more, with the bucket's pivot: its least node."""
    rows = nodes.select("node", "weight", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "node", "weight"
    )
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("node", "weight")).alias("p"))
    shared = shared.filter("n > 1").select("bucket", F.col("p.node").alias("pivot"), F.col("p.weight").alias("p_weight"))
    return spool(rows.join(spool(shared, "buckets"), "bucket"), "members")


def _may_match(threshold: float) -> Column:
    """Whether their weights let a member and a pivot be similar: the lesser over the greater bounds the similarity."""
    return F.least("weight", "p_weight") >= (threshold - 1e-9) * F.greatest("weight", "p_weight")


def cells(shingles: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What a weighted set weighs in each cell, no less when rounded to 32 bits."""
    cell = (shingles[0] >> np.uint64(64 - (CELLS - 1).bit_length())).astype(np.int64)
    return np.bincount(cell, shingles[1], CELLS) * (1 + 1e-6)


def packed(cells: np.ndarray) -> bytes:
    """Cells in a byte each, behind the weight of a unit; rounded up."""
    unit = cells.max() / 255 * (1 + 1e-9) or 1.0
    return np.float64(unit).tobytes() + np.minimum(np.ceil(cells / unit), 255).astype(np.uint8).tobytes()


def unpacked(column: pa.Array) -> np.ndarray:
    """A row of cells each, none less than it was."""
    found = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CELLS + 8)
    unit = np.ascontiguousarray(found[:, :8]).view(np.float64)
    return (found[:, 8:] * (unit * (1 + 1e-6))).astype(np.float32)


def _cells_of(rows: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The cells of the text of each node in `rows`, and their sums: a row a node, in however many buckets it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(idf)
        for batch in pieces(batches):
            fine = [cells(shingles.of(text)) for text in batch.column(1).to_pylist()]
            sums = [c.reshape(-1, CELL_SUMS).sum(axis=1) for c in fine]
            lists = [pa.array([c.astype(np.float32) for c in x], pa.list_(pa.float32())) for x in (fine, sums)]
            columns = [batch.column(0), *lists, pa.array([packed(c) for c in fine], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "cells", "sums", "packed"])

    wanted = texts.join(rows.select("node").distinct(), "node", "left_semi").select("node", "text")
    return spool(wanted.mapInArrow(run, "node long, cells array<float>, sums array<float>, packed binary"), "cells")


def _may_share(threshold: float) -> Column:
    """Whether their cells let a member and a pivot be similar."""
    needed = (threshold - 1e-9) / (1 + threshold) * (F.col("weight") + F.col("p_weight"))

    def enough(column: str) -> Column:
        least = F.zip_with(column, f"p_{column}", lambda a, b: F.least(a, b))
        return F.aggregate(least, F.lit(0.0), lambda n, x: n + x) >= needed

    return enough("sums") & enough("cells")


def _shingles_of(rows: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(shingle, part, node, class, weight): a row a shingle of the text of each node in `rows`, part being its weight there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(idf)
        for batch in pieces(batches):
            sets = [shingles.of(text) for text in batch.column(3).to_pylist()]
            at = np.repeat(np.arange(len(sets)), [len(hashes) for hashes, _ in sets])
            hashes, parts = (np.concatenate([np.empty(0, kind), *x]) for kind, x in zip((np.uint64, np.float64), zip(*sets)))
            columns = [pa.array(hashes.view(np.int64)), pa.array(parts), *[batch.column(k).take(pa.array(at)) for k in range(3)]]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "part", "node", "class", "weight"])

    wanted = rows.groupBy("node").agg(F.first("class").alias("class"), F.first("weight").alias("weight"))
    wanted = texts.join(wanted, "node").select("node", "class", "weight", "text")
    return spool(wanted.mapInArrow(run, "shingle long, part double, node long, class long, weight double"), "shingles")


def _unproven(rows: DataFrame, texts: DataFrame, fine: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """(node, pivot) of the members in different classes that no bound proves apart.

    A text can share with another class only those shingles that one of its
    texts has. They are ordered, the rarest first; two similar texts share so
    much that the first one they share has nearly all of either's behind it,
    and nearest to all in the lighter. So texts meet at their rarest shingles
    only, and a text with much of its own meets none.
    """
    shingles = _shingles_of(rows, texts, idf)
    held = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    shared = shingles.join(held.filter("low != high").select("shingle", "n"), "shingle")
    # What a text can share from a shingle on.
    onward = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    shared = shared.withColumn("rest", F.sum("part").over(onward) * (1 + 1e-9))
    long = spool(shared.filter(F.col("rest") >= threshold * F.col("weight")).drop("n", "part"), "rarest")
    light = long.filter(F.col("rest") >= 2 * threshold / (1 + threshold) * F.col("weight"))
    heavy = long.select("shingle", *[F.col(c).alias(f"p_{c}") for c in ("node", "class", "weight", "rest")])
    needed = threshold / (1 + threshold) * (F.col("weight") + F.col("p_weight"))
    met = light.join(heavy, "shingle").filter(
        (F.col("class") != F.col("p_class"))
        & (F.struct("weight", "node") < F.struct("p_weight", "p_node"))
        & _may_match(threshold)
        & (F.least("rest", "p_rest") >= needed)
    )

    @F.arrow_udf("boolean")
    def may_share(needed: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        enough = [np.empty(0, bool)]
        for k in range(0, len(a), CHUNK):
            least = np.minimum(*(unpacked(x.slice(k, CHUNK)) for x in (a, b))).sum(axis=1)
            # Sums of 32 bits may be less by their rounding.
            enough.append(least >= needed.slice(k, CHUNK).to_numpy() * (1 - 1e-4))
        return pa.array(np.concatenate(enough))

    met = spool(met.select("node", "p_node", needed.alias("needed")).distinct(), "met")
    of_heavy = fine.select(F.col("node").alias("p_node"), F.col("packed").alias("p_packed"))
    met = met.join(of_heavy, "p_node").join(fine.select("node", "packed"), "node").filter(may_share("needed", "packed", "p_packed"))
    return met.select(F.greatest("node", "p_node").alias("node"), F.least("node", "p_node").alias("pivot"))


def _similar(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(node, pivot, sim) of the distinct (node, pivot)."""

    @F.pandas_udf("double")
    def sim(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingles = Shingles(idf)
        for a, b in batches:
            yield pd.Series([similarity(shingles.recent(x), shingles.recent(y)) for x, y in zip(a, b)], dtype="float64")

    pairs = spool(pairs.select("node", "pivot").distinct(), "pairs")
    of_pivot = texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
    # By node last: the rows of a node then stand together, and its shingles are made once.
    # Texts are met by merging at every size, as they are where pairs are too many to broadcast.
    met = pairs.join(of_pivot.hint("merge"), "pivot").join(texts.hint("merge"), "node")
    return spool(met.select("node", "pivot", sim("text", "pivot_text").alias("sim")), "similar")


def _edges(found: DataFrame, threshold: float) -> DataFrame:
    return found.filter(F.col("sim") >= threshold).select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def _unsettled(rows: DataFrame) -> DataFrame:
    """The members of buckets in which there is more than one class."""
    mixed = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = spool(mixed.filter(F.col("low") != F.col("high")).select("bucket"), "unsettled")
    return spool(rows.join(mixed, "bucket"), "members")


def links(members: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float = SIMILARITY) -> DataFrame:
    """(node, label): the class of every text that has a near duplicate, by exact comparison in the buckets.

    In rounds, each bucket sends some members as pivots, which are compared
    with its other members and then leave. Half of them are close to the first
    pivot and meet only what isn't in their class yet, half are not; there are
    more in each round, so a dense group settles before many are compared. Once
    few of the pairs compared are similar, no dense group is left, and all
    members that are still there meet at their rarest shingles.
    A pair is passed over only if it can't matter: both are in one class
    already, their weights differ too much, the bucket's first pivot proves them
    apart (1 - similarity is a metric), or what they weigh in cells of shingles
    does. So a bucket of copies ends after one pivot, links between other members
    are still found, and of texts that are only akin few pairs are compared.
    """
    apart = 1 - threshold + 1e-9
    alike = _may_match(threshold)
    others = members.filter(F.col("node") != F.col("pivot"))
    found = _similar(others.filter(alike), texts, idf)
    edges = _edges(found, threshold)
    labels = classes(edges)
    rows = members.select("bucket", "node", "weight", "pivot").join(found, ["node", "pivot"], "left")
    rows = rows.join(labels, "node", "left").select(
        "bucket", "node", "weight", F.coalesce("label", "node").alias("class"), (1 - F.col("sim")).alias("d"),
        (F.col("node") == F.col("pivot")).alias("done"),
    )
    # The first pivots have met all of their buckets.
    rows, slots = _unsettled(spool(rows.filter(~F.col("done")).drop("done"), "members")), 1
    if rows.isEmpty():
        return labels
    # Met by the rows only where pairs are looked through: written with each of them, they are most of what a round writes.
    fine = _cells_of(rows, texts, idf)
    of_pivot = fine.select(*[F.col(c).alias(f"p_{c}") for c in ("node", "cells", "sums")])
    columns = ("node", "weight", "class", "d")
    while True:
        close = F.coalesce(F.col("d") <= apart, F.lit(False)).alias("close")
        slot = F.pmod(F.xxhash64("node"), F.lit(slots)).alias("slot")
        pivot = F.min(F.struct(*columns)).alias("p")
        pivots = spool(
            rows.groupBy("bucket", close, slot)
            .agg(pivot)
            .select("bucket", *[F.col(f"p.{c}").alias(f"p_{c}") for c in columns]),
            "pivots",
        )
        met = rows.join(fine, "node").join(pivots.join(of_pivot, "p_node"), "bucket").filter(
            (F.col("class") != F.col("p_class"))
            & alike
            & F.coalesce(F.abs(F.col("d") - F.col("p_d")) <= apart, F.lit(True))
            & _may_share(threshold)
        )
        pairs = met.select(F.greatest("node", "p_node").alias("node"), F.least("node", "p_node").alias("pivot"))
        compared = _similar(pairs, texts, idf)
        new = _edges(compared, threshold)
        tally = compared.agg(F.count("*").alias("n"), F.count_if(F.col("sim") >= threshold).alias("similar")).first()
        rows = rows.join(pivots.select("bucket", F.col("p_node").alias("node")), ["bucket", "node"], "left_anti")
        if tally["similar"]:
            edges = edges.union(new)
            labels = classes(edges)
            rows = rows.join(labels, "node", "left").withColumn("class", F.coalesce("label", "class")).drop("label")
        rows, slots = _unsettled(spool(rows, "members")), min(4 * slots, PIVOTS)
        if rows.isEmpty():
            return labels
        if tally["similar"] <= FRUITFUL * tally["n"]:
            last = _edges(_similar(_unproven(rows, texts, fine, idf, threshold), texts, idf), threshold)
            return labels if last.isEmpty() else classes(edges.union(last))


def near_duplicates(
    docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, digest of the text and class_id.

    `class_id` is the least doc_id of the class. Texts are in one class if they
    are equal, if their similarity is at least `threshold`, or if a chain of
    such links joins them. Null texts count as empty; texts without a word have
    no shingles, so they only join texts equal to them. Texts of fewer than
    five words are one shingle. Repeated rows give a row each; a null id is
    never the least unless there is no other. Other columns aren't read.
    """
    idf = fit_idf(docs, text_col)
    rows = spool(signatures(docs, idf, id_col, text_col), "signatures")
    distinct = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
    )
    # Numbered once and written, so the numbers stay.
    nodes = spool(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = _members(nodes)
    wanted = nodes.select("node", "digest", "first_id").join(members.select("node").distinct(), "node", "left_semi")
    wanted = spool(wanted, "wanted")
    text = text_of(text_col)
    source = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))
    same = source["doc_id"].eqNullSafe(wanted["first_id"]) & (source["digest"] == wanted["digest"])
    texts = spool(source.join(wanted.hint("merge"), same).select("node", "text").dropDuplicates(["node"]), "texts")
    labels = links(members, texts, idf, threshold)
    of_node = nodes.select("digest", "node", "first_id").join(labels, "node", "left")
    of_node = spool(of_node.select("digest", "first_id", F.coalesce("label", "node").alias("label")), "node-classes")
    ids = spool(of_node.groupBy("label").agg(F.min("first_id").alias("class_id")), "class-ids")
    of_digest = spool(of_node.join(ids, "label").select("digest", "class_id"), "digest-classes")
    return rows.select("doc_id", "digest").join(of_digest, "digest").select("doc_id", "digest", "class_id")


def keep_one(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, columns as they were: that of the least id, then of the least digest.

    Of repeated rows with one id and text, any one stays. Classes without any
    id are told apart by their text, so each of their texts stays once.
    """
    found = near_duplicates(docs, threshold, id_col, text_col)
    id_name, digest = free_name(docs, "kept_id"), free_name(docs, "digest")
    first = F.col("class_id").isNull() | (F.col("class_id") == F.col("doc_id"))
    group = F.when(F.col("class_id").isNull(), F.col("digest"))
    kept = found.filter(first).groupBy("class_id", group.alias("group")).agg(F.min("digest").alias(digest))
    kept = spool(kept.select(F.col("class_id").alias(id_name), digest), "kept")
    rows = docs.withColumn(digest, F.md5(text_of(text_col)))
    same = rows[id_col].eqNullSafe(kept[id_name]) & (rows[digest] == kept[digest])
    return rows.join(kept, same).select(rows["*"]).dropDuplicates([id_col, digest]).select(*docs.columns)


def op5_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
