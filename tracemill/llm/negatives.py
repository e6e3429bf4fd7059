"""Hard negatives by threshold joins over an inverted index with suffix norms.

Rows are cut into blocks of bounded size, each an inverted index: for a group of
dimensions it lists the rows it has entered there. Dimensions are taken in one
order, the weightiest first. Of a row, dimensions at the end are left out of the
index as long as their norm, times the greatest anchor norm, stays below the
threshold: without them a row cannot reach it, so every row that can is met in
the index. Anchors add up partial scores along the lists; a row that cannot
reach any anchor's threshold, were the norms of all that remains in line, is
dropped on the way, and the pairs left at the end get their missing dimensions
and so their exact score.

Thresholds start high and are lowered in rounds, for the anchors only that have
a window yet to fill; at the last level the bound of the window itself holds, so
what is returned is exact.

Blocks stay where they are written and are read once for each wave of anchors,
which comes to them as a broadcast of bounded size. A task keeps the best rows
of each window over all its blocks; the last of them is the window's threshold
in the blocks that follow, and only what is left at the end is shuffled.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tracemill.llm.common import table
from tracemill.llm.vectors import matrix, packed, take_part, unpacked
from tracemill.session import spool

# Rows of a block, anchors of a pack, anchors searched at a time, dimensions of one group of lists.
BLOCK_ROWS, BLOCK_ANCHORS, TILE, GROUP = 4096, 2048, 256, 8
# Bytes of anchors, their windows and what is found for them that go through the blocks at a time.
WAVE_BYTES = 16 << 20
# Thresholds by round: of the anchor's norm times the greatest norm, then none; of the window's upper end.
POSITIVE_LEVELS, NEGATIVE_LEVELS = (0.6, 0.3, None), (0.95, 0.88, None)

BLOCK = "block INT, dim INT, kind STRING, ids BINARY, labels BINARY, vecs BINARY"
SCORED = "anchor_id LONG, slot LONG, id LONG, score LONG"


def exact_kind(whole: np.ndarray) -> type:
    """What inner products of such rows are exact in: floats, doubles, else Python integers."""
    most = float(np.abs(whole).max(initial=0))
    reach = most * most * max(1, whole.shape[1])
    return np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 52 else object


def wider(a: type, b: type) -> type:
    return max(a, b, key=(np.float32, np.float64, object).index)


def typed(whole: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers in the given kind."""
    if kind is not object:
        return whole.astype(kind)
    return np.array([[int(x) for x in row] for row in whole], dtype=object).reshape(whole.shape)


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; beyond them the nearest there is."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], dtype=np.int64)


def group_cuts(dim: int) -> list[int]:
    return list(range(0, dim, GROUP)) + [dim]


def suffix_norms(vecs: np.ndarray) -> np.ndarray:
    """Column g: norms of what follows the first g groups of dimensions."""
    squares = vecs.astype(np.float64) ** 2
    groups = np.add.reduceat(squares, group_cuts(vecs.shape[1])[:-1], axis=1)
    tail = np.concatenate([np.cumsum(groups[:, ::-1], axis=1)[:, ::-1], np.zeros((len(vecs), 1))], axis=1)
    return np.sqrt(tail) * (1 + 1e-12)


class Postings:
    """The inverted index of a block for one threshold a row has to reach with some anchor."""

    def __init__(self, vecs: np.ndarray, greatest: float, threshold: float, rest: np.ndarray | None = None):
        """`vecs` with dimensions in their order; `greatest` is the largest anchor norm, `rest` the suffix norms of `vecs`."""
        self.vecs, self.cuts = vecs, group_cuts(vecs.shape[1])
        self.rest = suffix_norms(vecs) if rest is None else rest
        # Groups a row is entered in: the last ones go while they alone can't reach the threshold.
        self.entered = (self.rest * greatest >= threshold).sum(axis=1) if threshold > 0 else np.full(len(vecs), len(self.cuts))
        self.entered = np.minimum(self.entered, len(self.cuts) - 1)

    def candidates(self, anchors: np.ndarray, norms: np.ndarray, thresholds: np.ndarray, rows: np.ndarray) -> tuple:
        """(anchor, row, score): all pairs of these rows that reach the anchor's threshold, scores exact."""
        # Rows entered in more groups first, so each group's list is a beginning of the rows left.
        rows = rows[np.argsort(-self.entered[rows], kind="stable")]
        # Bounds are a little wider than they are, so rounding never loses a pair; what can't be reached is as far as any.
        kind = np.float32 if self.vecs.dtype == np.float32 else np.float64
        most = norms[:, 0].max(initial=0) * self.rest[rows, 0].max(initial=0)
        bounds = (np.clip(thresholds, -2 * most - 1, 2 * most + 1) - (1e-6 * most + 1e-6)).astype(kind)
        wide, rest = (norms * (1 + 1e-6)).astype(kind), (self.rest[rows] * (1 + 1e-6)).astype(kind)
        found = []
        for start in range(0, len(anchors), TILE):
            tile = slice(start, start + TILE)
            at, row, score = self._tile(anchors[tile], wide[tile], bounds[tile], rows, rest)
            reached = score >= thresholds[tile][at]
            found.append((at[reached] + start, row[reached], score[reached]))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _tile(self, anchors: np.ndarray, norms: np.ndarray, bounds: np.ndarray, rows: np.ndarray, rest: np.ndarray) -> tuple:
        """(anchor, row, score): pairs that may reach the bounds."""
        cuts, last = self.cuts, len(self.cuts) - 1
        vecs, entered = self.vecs[rows], self.entered[rows]
        partial = np.zeros((len(anchors), len(rows)), dtype=vecs.dtype)
        for g in range(0, last, 2):
            h = min(g + 2, last)
            # Rows in the lists of the first and of the second group.
            one, both = np.searchsorted(-entered, [-g, 1 - h])
            if not one:
                break
            partial[:, :both] += anchors[:, cuts[g] : cuts[h]] @ vecs[:both, cuts[g] : cuts[h]].T
            if both < one:
                partial[:, both:one] += anchors[:, cuts[g] : cuts[g + 1]] @ vecs[both:one, cuts[g] : cuts[g + 1]].T
            # Only groups that follow in the lists can still add to a row entered there.
            if h < last:
                seen = np.minimum(entered, h)
                # Rows a few anchors may reach stay, so where these hold most of them nothing is to be gained.
                if self._may_reach(partial[:16], norms[:16], bounds[:16], rest, seen).any(axis=0).sum() < 0.9 * len(rows):
                    alive = self._may_reach(partial, norms, bounds, rest, seen).any(axis=0)
                    if alive.sum() < 0.9 * len(rows):
                        rows, vecs, entered, rest, partial = rows[alive], vecs[alive], entered[alive], rest[alive], partial[:, alive]
        at, col = np.divmod(np.flatnonzero(self._may_reach(partial, norms, bounds, rest, entered)), len(rows) or 1)
        score = partial[at, col]
        for g in range(last):
            missing = np.flatnonzero(entered[col] <= g)
            if len(missing):
                pair = anchors[at[missing], cuts[g] : cuts[g + 1]] * vecs[col[missing], cuts[g] : cuts[g + 1]]
                score[missing] += pair.sum(axis=1)
        return at, rows[col], score

    @staticmethod
    def _may_reach(partial, norms, bounds, rest, seen) -> np.ndarray:
        """Pairs whose partial score and remaining norms together reach the bound; `seen` falls from row to row."""
        out = np.empty(partial.shape, dtype=bool)
        edges = [0, *(np.flatnonzero(np.diff(seen)) + 1), len(seen)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                most = np.outer(norms[:, seen[a]], rest[a:b, seen[a]])
                most += partial[:, a:b].astype(most.dtype, copy=False)
                np.greater_equal(most, bounds[:, None], out=out[:, a:b])
        return out


class Block:
    """Rows of a block, their components as whole numbers, dimensions in their order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray):
        self.ids, self.labels, self.whole = ids, labels, whole
        self.kind, self.rest = exact_kind(whole), suffix_norms(whole)
        self.vecs = typed(whole, self.kind)


class Pack:
    """Anchors with their windows, and the k best rows of each window so far, ties to the smaller id."""

    def __init__(self, pack: pa.StructArray, order: np.ndarray, scale: int, k: int):
        # Copies, as what is kept would hold on to the batch.
        self.ids, self.labels = (pack.field(c).to_numpy().copy() for c in ("anchor_id", "label"))
        self.whole = np.floor(matrix(pack.field("vec")) * scale)[:, order]
        self.kind, self.norms, self.k = exact_kind(self.whole), suffix_norms(self.whole), k
        self.vecs = typed(self.whole, self.kind)
        windows = pack.field("windows")
        inner = windows.flatten()
        # By window: its anchor, the least score that counts now, the highest.
        self.of = np.repeat(np.arange(len(pack)), np.diff(windows.offsets.to_numpy()))
        self.slots, self.low, self.high = (inner.field(c).to_numpy().copy() for c in ("slot", "lowest", "high"))
        self.best = (np.zeros(0, np.int64),) * 3

    def meet(self, block: Block, same: bool) -> None:
        """Search the block's rows of each anchor's label if `same`, else of others, for what is better."""
        kind = wider(self.kind, block.kind)
        vecs, anchors = (x.vecs if x.kind is kind else typed(x.whole, kind) for x in (block, self))
        threshold = np.full(len(self.ids), np.inf)
        # A hair lower, as doubles round large numbers; windows compare whole numbers afterwards.
        np.minimum.at(threshold, self.of, np.nextafter(self.low.astype(np.float64), -np.inf))
        postings = Postings(vecs, self.norms[:, 0].max(initial=0), threshold.min(initial=np.inf), block.rest)
        pairs = []
        for label in np.unique(self.labels):
            who = np.flatnonzero(self.labels == label)
            rows = np.flatnonzero((block.labels == label) == same)
            if len(rows):
                at, row, score = postings.candidates(anchors[who], self.norms[who], threshold[who], rows)
                pairs.append((who[at], row, score))
        if not pairs:
            return
        at, row, score = (np.concatenate(c) for c in zip(*pairs))
        ids = block.ids[row]
        mine = self.ids[at] != ids
        at, ids, score = at[mine], ids[mine], as_longs(score[mine])
        if len(at):
            self._keep(*self._in_windows(at, ids, score))

    def _in_windows(self, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple:
        """(window, id, score): of the pairs the k best in each window."""
        # ~s falls as s grows, and has no overflow.
        by = np.lexsort((ids, ~score, at))
        at, ids, score = at[by], ids[by], score[by]
        # Scores by rank, so that (anchor, falling score) is one number; those of a window stand together.
        levels = np.unique(score)
        top, wide = len(levels), len(levels) + 1
        key = at * wide + top - np.searchsorted(levels, score)
        first = np.searchsorted(key, self.of * wide + top - np.searchsorted(levels, self.high, side="right") + 1)
        after = np.searchsorted(key, self.of * wide + top - np.searchsorted(levels, self.low), side="right")
        count = np.clip(after - first, 0, self.k)
        window = np.repeat(np.arange(len(self.of)), count)
        place = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return window, ids[place], score[place]

    def _keep(self, window: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Merge these into the best, and let no window that is full take less than its last."""
        window, ids, score = (np.concatenate(c) for c in zip(self.best, (window, ids, score)))
        by = np.lexsort((ids, ~score, window))
        window, ids, score = window[by], ids[by], score[by]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        kept = rank < self.k
        self.best = window[kept], ids[kept], score[kept]
        last = rank == self.k - 1
        self.low[window[last]] = np.maximum(self.low[window[last]], score[last])

    def found(self) -> pa.RecordBatch:
        window, ids, score = self.best
        columns = self.ids[self.of[window]], self.slots[window], ids, score
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCORED.split(", ")])


def dimension_order(vectors: DataFrame, scale: int, dim: int) -> np.ndarray:
    """Dimensions by falling sum of squares over all rows, summed by task."""

    def energy(batches):
        total = np.zeros(dim)
        for batch in batches:
            if batch.num_rows:
                total += (np.floor(matrix(batch.column("vec")) * scale) ** 2).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(dim)), pa.array(total)], ["d", "energy"])

    sums = vectors.select("vec").mapInArrow(energy, "d LONG, energy DOUBLE").groupBy("d").agg(F.sum("energy").alias("energy"))
    return np.array([r["d"] for r in sums.orderBy(F.desc("energy"), "d").collect()])


class ThresholdJoin:
    """Blocks of (id, vec, label) rows, searched by anchors with windows of scores."""

    def __init__(self, vectors: DataFrame, scale: int):
        """`vectors`: unique ids, vectors of one length, one row or more."""
        self.vectors, self.scale = vectors, scale
        n = vectors.count()
        self.n_blocks = -(-n // BLOCK_ROWS)
        dim = len(vectors.select("vec").first()["vec"])
        self.order = order = dimension_order(vectors, scale, dim)

        def build(group: pa.Table) -> pa.Table:
            ids, labels = group["id"].to_numpy(), group["label"].to_numpy()
            by = np.lexsort((ids, labels))
            whole = np.floor(matrix(group["vec"])[by] * scale)[:, order]
            kind = "<i2" if np.abs(whole).max(initial=0) < 1 << 15 else "<f8"
            cells = [group["block"][0].as_py(), dim, kind, packed(ids[by], "<i8"), packed(labels[by], "<i8"), packed(whole, kind)]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
            return pa.table({c.split()[0]: pa.array([v], t) for c, v, t in zip(BLOCK.split(", "), cells, kinds)})

        dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(self.n_blocks)).cast("int"))
        # Files enough for every core to read some, whatever Spark would make of so few bytes.
        files = min(self.n_blocks, max(4 * vectors.sparkSession.sparkContext.defaultParallelism, self.n_blocks // 16))
        self.blocks = spool(dealt.repartition(files, "block").groupBy("block").applyInArrow(build, BLOCK), "blocks")

    def norms(self, rows: DataFrame) -> DataFrame:
        """`rows` with the norm of their scaled vectors."""
        scale = F.lit(float(self.scale))
        square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * scale).cast("double"), 2))
        return rows.withColumn("norm", F.sqrt(square))

    def best(self, windows: DataFrame, same: bool, k: int, levels: tuple) -> DataFrame:
        """(anchor_id, slot, id, score): the k best rows of each window, or all there are.

        `windows`: (anchor_id, label, vec, slot, low, high, start), unique by
        anchor_id and slot; rows of the anchor's label if `same`, else of others,
        the anchor itself aside. Round by round the threshold is the share
        `levels` of `start`, where that is above `low`.
        """
        done, open_ = None, windows
        for level in levels:
            lowest = F.col("low") if level is None else F.greatest("low", F.floor(F.col("start") * level).cast("long"))
            asked = spool(open_.withColumn("lowest", lowest), "windows")
            if asked.isEmpty():
                break
            found = self._search(asked, same, k)
            if level is not None:
                full = asked.join(found.groupBy("anchor_id", "slot").agg(F.count("*").alias("n")), ["anchor_id", "slot"], "left")
                settled = (F.coalesce("n", F.lit(0)) >= k) | (F.col("lowest") <= F.col("low"))
                full = spool(full.withColumn("settled", settled).drop("n", "lowest"), "settled")
                open_ = full.filter("NOT settled").drop("settled")
                found = found.join(full.filter("settled").select("anchor_id", "slot"), ["anchor_id", "slot"], "left_semi")
            done = found if done is None else done.union(found)
        return done if done is not None else windows.sparkSession.createDataFrame([], SCORED)

    def _search(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best of each window over all blocks, thresholds as given in `lowest`; written."""
        by_anchor = asked.groupBy("anchor_id").agg(
            F.min("label").alias("label"), F.min("vec").alias("vec"), F.collect_list(F.struct("slot", "lowest", "high")).alias("windows")
        )
        anchors, windows = asked.agg(F.count_distinct("anchor_id"), F.count("*")).first()
        parts = -(-anchors // BLOCK_ANCHORS)
        waves = min(parts, -(-(anchors * (16 + 8 * len(self.order)) + windows * 24 * (k + 1)) // WAVE_BYTES))
        packs = by_anchor.groupBy(F.pmod(F.xxhash64("anchor_id", F.lit(3)), F.lit(parts)).cast("int").alias("part"))
        packs = packs.agg(F.collect_list(F.struct("anchor_id", "label", "vec", "windows")).alias("asked"))
        packs = spool(packs.withColumn("wave", F.col("part") % waves), "packs")
        found = [spool(self._meet(packs.filter(F.col("wave") == wave), same, k), "found") for wave in range(waves)]
        return reduce(DataFrame.union, found)

    def _meet(self, packs: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best of each window of these packs, which are few."""
        order, scale = self.order, self.scale
        met = self.blocks.crossJoin(F.broadcast(packs)).select(*self.blocks.columns, "part", "asked")

        def search(batches):
            last, block, known = None, None, {}
            for batch in batches:
                numbers, parts = batch.column("block").to_pylist(), batch.column("part").to_pylist()
                for row, (number, part) in enumerate(zip(numbers, parts)):
                    if number != last:
                        get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                        block = Block(unpacked(get("ids"), "<i8"), unpacked(get("labels"), "<i8"), unpacked(get("vecs"), get("kind"), get("dim")))
                        last = number
                    if part not in known:
                        known[part] = Pack(batch.column("asked")[row].values, order, scale, k)
                    known[part].meet(block, same)
            yield from (pack.found() for pack in known.values())

        rank = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id"))
        return met.mapInArrow(search, SCORED).withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def hard_negatives(
    vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For the rows where `anchors` holds of `id`: their `positives` best other rows
    of the same label, and for each of those the `negatives` best rows of other
    labels whose score is `least` to `most` hundredths of the positive's. Scores
    are inner products of floor(scale * x), higher ones first, ties to the smaller
    id; beyond 64 bits they are the nearest 64-bit integer. A positive without
    such negatives gives no row, nor does an empty table. Rows with a null label
    or vector or not wholly finite components take no part, see
    `vectors.take_part`, which also says what counts where an id repeats. Further
    columns are passed over.
    """
    rows = take_part(vectors, id_col, vec_col, label_col)
    none = "anchor_id LONG, positive_id LONG, rank INT, negative_id LONG, positive_score LONG, negative_score LONG"
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], none)
    join = ThresholdJoin(rows, scale)
    asked = join.norms(rows.filter(anchors))
    greatest = join.norms(rows).agg(F.max("norm")).first()[0]
    asked = asked.select(
        F.col("id").alias("anchor_id"), "label", "vec", F.lit(0).cast("long").alias("slot"), F.lit(-(1 << 63)).cast("long").alias("low"),
        F.lit((1 << 63) - 1).alias("high"), (F.col("norm") * greatest).alias("start"),
    )
    found = spool(join.best(asked, True, positives, POSITIVE_LEVELS), "positives")
    found = found.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Whole-number bounds: least * positive <= 100 * negative <= most * positive.
    share = lambda part: (F.col("positive_score").cast("decimal(25,0)") * part) / 100
    long = lambda x: F.expr(f"CAST(least(greatest({x}, {-(1 << 63)}), {(1 << 63) - 1}) AS BIGINT)").alias(x)
    bounds = found.withColumn("low", F.ceil(share(least))).withColumn("high", F.floor(share(most)))
    bounds = bounds.select(*found.columns, long("low"), long("high"))
    windows = bounds.filter("low <= high").join(asked.select("anchor_id", "label", "vec"), "anchor_id")
    windows = windows.select("anchor_id", "label", "vec", F.col("positive_id").alias("slot"), "low", "high", F.col("high").cast("double").alias("start"))
    best = join.best(windows, False, negatives, NEGATIVE_LEVELS)
    best = best.select("anchor_id", F.col("slot").alias("positive_id"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    out = best.join(found, ["anchor_id", "positive_id"]).withColumn("rank", rank.cast("int"))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows of `embeddings` whose id is divisible by 100; some labels are shifted first."""
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", shifted.alias("label")), "id % 100 = 0")


ORACLE = """
WITH part AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM part a JOIN part b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
"""
