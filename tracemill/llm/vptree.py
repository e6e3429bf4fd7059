"""Nearest neighbours by vantage-point trees, one tree a shard.

A tree node keeps one vector as its vantage point and splits the others by
their distance from it, the nearer half to one side. With the least and the
greatest distance of each half, the triangle inequality bounds how near a query
can come to anything in it. A half is passed over when `factor` times that bound
is beyond the query's k-th distance so far: factor 1 is the exact search, and a
greater one passes over more.

Rows are dealt to regions by the top levels of such a tree over a bounded
sample, and regions to shards of bounded size by a hash of the id, so a region
of very many alike vectors is as many trees as it needs. A query searches its own
region first and takes the k-th distance from there to all others.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tracemill.llm.common import table
from tracemill.llm.vectors import matrix, packed, take_part, unpacked
from tracemill.session import spool

K = 10
# Share of the triangle bound: recall against brute force in tests and README.
FACTOR = 4.0
# Rows of a shard, its tree in one row of the index; queries searched at a time; rows of a leaf.
SHARD_ROWS, BLOCK_QUERIES, LEAF = 8192, 1024, 128
# Rows the regions are fitted on, and regions at most: 32 sampled rows or more settle each border.
SAMPLE, REGIONS = 4096, 64
# Shards whose queries travel together.
CELL_SHARDS = 4
# Rounding of a distance, relative, that must not pass over a tie.
SLACK = 1e-9

INDEX = "region INT, cell INT, shard INT, dim INT, ids BINARY, vecs BINARY, bounds BINARY"
FOUND = "query_id LONG, vec_id LONG, score DOUBLE"


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows of one matrix from rows of the other or, broadcast, row by row."""
    apart = queries - points
    return np.sqrt(np.einsum("...k,...k->...", apart, apart))


class Tree:
    """A tree over the rows of a matrix, which it puts into the order of its nodes.

    Node n covers rows [lo, hi): its vantage point at lo, the nearer half up to
    mid, the farther one behind. `bounds` holds for each node the least and
    greatest distance of both halves, in the order in which `walk` meets them.
    """

    def __init__(self, vecs: np.ndarray, ids: np.ndarray, bounds: np.ndarray | None = None):
        self.vecs, self.ids = vecs, ids
        self.built = bounds is not None
        self.bounds = bounds if self.built else np.zeros((self.nodes(len(ids)), 4))
        self.norms = np.einsum("ik,ik->i", vecs, vecs) if self.built else None
        if not self.built:
            self._build(0, len(ids), 0)

    @staticmethod
    def nodes(n: int) -> int:
        """Inner nodes of a subtree of n rows."""
        if n <= LEAF:
            return 0
        near = (n - 1) // 2
        return 1 + Tree.nodes(near) + Tree.nodes(n - 1 - near)

    def _build(self, lo: int, hi: int, node: int) -> None:
        if hi - lo <= LEAF:
            return
        away = distances(self.vecs[lo], self.vecs[lo + 1 : hi])
        order = np.argsort(away, kind="stable")
        away = away[order]
        self.vecs[lo + 1 : hi], self.ids[lo + 1 : hi] = self.vecs[lo + 1 : hi][order], self.ids[lo + 1 : hi][order]
        near = (hi - lo - 1) // 2
        mid = lo + 1 + near
        self.bounds[node] = away[0], away[near - 1], away[near], away[-1]
        self._build(lo + 1, mid, node + 1)
        self._build(mid, hi, node + 1 + self.nodes(near))

    def search(self, queries: np.ndarray, own: np.ndarray, limit: np.ndarray, k: int, factor: float) -> "Search":
        found = Search(self, queries, own, limit, k, factor)
        found.walk(0, len(self.ids), 0, np.arange(len(queries)))
        return found


class Search:
    """The k nearest rows of a tree for many queries at once, none farther than each query's limit."""

    def __init__(self, tree: Tree, queries: np.ndarray, own: np.ndarray, limit: np.ndarray, k: int, factor: float):
        self.tree, self.queries, self.own, self.k, self.factor = tree, queries, own, k, factor
        self.norms = np.einsum("ik,ik->i", queries, queries)
        self.limit = limit
        self.best = np.full((len(queries), k), np.inf)
        self.best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.visited = 0

    def reach(self, who: np.ndarray) -> np.ndarray:
        """How far a row may be to matter still."""
        return np.minimum(self.best[who, -1], self.limit[who]) * (1 + SLACK) + 1e-300

    def offer(self, lo: int, hi: int, who: np.ndarray) -> None:
        """Take in rows [lo, hi) for the queries `who`."""
        tree = self.tree
        self.visited += len(who) * (hi - lo)
        points, reach = tree.vecs[lo:hi], self.reach(who)
        norms = self.norms[who, None] + tree.norms[lo:hi]
        rough = norms - 2 * (self.queries[who] @ points.T)
        # What rounding may have added to the rough square is less than SLACK of both squares.
        with np.errstate(over="ignore", invalid="ignore"):
            near = ~(rough - SLACK * norms > (reach * reach)[:, None])
        near &= tree.ids[lo:hi] != self.own[who, None]
        at, col = np.nonzero(near)
        if not len(at):
            return
        exact = distances(self.queries[who[at]], points[col])
        for start in np.flatnonzero(np.r_[True, at[1:] != at[:-1]]):
            row = at[start]
            stop = start + np.searchsorted(at[start:], row, side="right")
            q = who[row]
            d = np.concatenate([self.best[q], exact[start:stop]])
            i = np.concatenate([self.best_id[q], tree.ids[lo:hi][col[start:stop]]])
            keep = np.lexsort((i, d))[: self.k]
            self.best[q], self.best_id[q] = d[keep], i[keep]

    def walk(self, lo: int, hi: int, node: int, who: np.ndarray) -> None:
        """The subtree of rows [lo, hi) for the queries `who`, each one's nearer half first."""
        if not len(who) or lo == hi:
            return
        if hi - lo <= LEAF:
            self.offer(lo, hi, who)
            return
        self.offer(lo, lo + 1, who)
        away = distances(self.queries[who], self.tree.vecs[lo])
        least_near, most_near, least_far, most_far = self.tree.bounds[node]
        to_near = np.maximum(np.maximum(least_near - away, away - most_near), 0)
        to_far = np.maximum(np.maximum(least_far - away, away - most_far), 0)
        near = (hi - lo - 1) // 2
        mid = lo + 1 + near
        halves = ((lo + 1, mid, node + 1, to_near), (mid, hi, node + 1 + self.tree.nodes(near), to_far))
        first = to_near <= to_far
        for picked, (one, other) in ((first, halves), (~first, halves[::-1])):
            for start, stop, child, bound in (one, other):
                mine = who[picked]
                self.walk(start, stop, child, mine[~(self.factor * bound[picked] > self.reach(mine))])

    def rows(self) -> list[np.ndarray]:
        """Query number, id and distance of all rows found."""
        at, col = np.nonzero((self.best < np.inf) & (self.best <= self.reach(np.arange(len(self.best)))[:, None]))
        return [at, self.best_id[at, col], self.best[at, col]]


class Regions:
    """The top of a tree over a sample: vantage points and the distances that split them."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.levels = max(0, regions.bit_length() - 1)
        self.points = np.zeros((1 << self.levels, sample.shape[1]))
        self.split = np.zeros(1 << self.levels)
        self._fit(sample, 1)

    def _fit(self, sample: np.ndarray, node: int) -> None:
        if node >> self.levels:
            return
        if len(sample):
            self.points[node] = sample[0]
            away = distances(sample[0], sample)
            self.split[node] = np.median(away)
            self._fit(sample[away < self.split[node]], 2 * node)
            self._fit(sample[away >= self.split[node]], 2 * node + 1)

    def of(self, vecs: np.ndarray) -> np.ndarray:
        """The region of each row."""
        node = np.ones(len(vecs), dtype=np.int64)
        for _ in range(self.levels):
            node = 2 * node + (distances(vecs, self.points[node]) >= self.split[node])
        return node - (1 << self.levels)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and region the least distance the triangle inequality allows."""
        bound = np.zeros((len(queries), 2 << self.levels))
        for node in range(1, 1 << self.levels):
            away = distances(queries, self.points[node])
            bound[:, 2 * node] = np.maximum(bound[:, node], away - self.split[node])
            bound[:, 2 * node + 1] = np.maximum(bound[:, node], self.split[node] - away)
        return bound[:, 1 << self.levels :]


def fit_regions(vectors: DataFrame, n: int) -> Regions:
    """Regions by a sample of at most `SAMPLE` rows, those of least hash."""
    picked = vectors.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(SAMPLE).select("vec").toArrow()
    wanted = min(REGIONS, max(1, n // SHARD_ROWS), max(1, picked.num_rows // 32))
    return Regions(matrix(picked["vec"]), wanted)


def _build_shard(group: pa.Table) -> pa.Table:
    order = np.argsort(group["id"].to_numpy())
    vecs, ids = matrix(group["vec"])[order], group["id"].to_numpy()[order]
    tree = Tree(vecs, ids)
    one = {c: [group[c][0].as_py()] for c in ("region", "cell", "shard")}
    one |= {"dim": [vecs.shape[1]], "ids": [packed(ids, "<i8")], "vecs": [packed(vecs, "<f8")], "bounds": [packed(tree.bounds, "<f8")]}
    return pa.table(one, schema=_arrow(INDEX))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"INT": pa.int32(), "LONG": pa.int64(), "DOUBLE": pa.float64(), "BINARY": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


class Index:
    """Trees of all shards as a table, one row a shard, with the regions and the shards of each."""

    def __init__(self, vectors: DataFrame):
        """`vectors`: (id, vec) with unique ids and vectors of one length, one row or more."""
        regions = self.regions = fit_regions(vectors, vectors.count())

        def place(batches):
            for batch in batches:
                where = regions.of(matrix(batch.column("vec"))) if batch.num_rows else np.zeros(0)
                yield batch.append_column("region", pa.array(where.astype(np.int32)))

        placed = spool(vectors.mapInArrow(place, "id LONG, vec ARRAY<DOUBLE>, region INT"), "regions")
        sizes = {r["region"]: r["count"] for r in placed.groupBy("region").count().collect()}
        self.shards = {region: -(-size // SHARD_ROWS) for region, size in sizes.items()}
        deal = F.pmod(F.xxhash64("id", F.lit(5)), _by_region(self.shards)).cast("int")
        placed = placed.withColumn("shard", deal).withColumn("cell", (F.col("shard") / CELL_SHARDS).cast("int"))
        self.trees = spool(placed.groupBy("region", "shard", "cell").applyInArrow(_build_shard, INDEX), "trees")

    def search(self, queries: DataFrame, k: int = K, factor: float = FACTOR) -> DataFrame:
        """(query_id, rank, vec_id, score): the k nearest rows of each (id, vec), itself aside."""
        regions, everywhere = self.regions, set(self.shards)

        def home(batches):
            for batch in batches:
                where = regions.of(matrix(batch.column("vec"))) if batch.num_rows else np.zeros(0)
                yield pa.record_batch([batch.column("id"), batch.column("vec"), pa.array(where.astype(np.int32)),
                                       pa.nulls(batch.num_rows, pa.float64())], ["id", "vec", "region", "reach"])

        asked = "id LONG, vec ARRAY<DOUBLE>, region INT, reach DOUBLE"
        first = self._search(queries.select("id", "vec").mapInArrow(home, asked), k, factor)
        last = F.when(F.count("*") >= k, F.max("score")).alias("reach")
        ranked = spool(nearest(first, k), "nearest")
        begun = queries.select("id", "vec").join(ranked.groupBy(F.col("query_id").alias("id")).agg(last), "id", "left")

        def others(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                vecs = matrix(batch.column("vec"))
                reach = batch.column("reach").fill_null(np.inf).to_numpy(zero_copy_only=False)
                bound = regions.bounds(vecs)
                meets = ~(factor * bound > (reach * (1 + SLACK))[:, None])
                meets[np.arange(len(vecs)), regions.of(vecs)] = False
                meets[:, [r for r in range(meets.shape[1]) if r not in everywhere]] = False
                at, region = np.nonzero(meets)
                rows = pa.array(at)
                yield pa.record_batch([batch.column("id").take(rows), batch.column("vec").take(rows), pa.array(region.astype(np.int32)),
                                       batch.column("reach").take(rows)], ["id", "vec", "region", "reach"])

        second = self._search(begun.mapInArrow(others, asked), k, factor)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        both = ranked.select("query_id", "vec_id", "score").union(second)
        both = both.withColumn("rank", rank).filter(F.col("rank") <= k)
        return both.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def _search(self, asked: DataFrame, k: int, factor: float) -> DataFrame:
        """`FOUND` of (id, vec, region, reach), each searched in all shards of its region.

        Queries of a region are packed to rows of about `BLOCK_QUERIES`, one row
        going to each cell of shards; both sides of the join are rows of bounded
        size, whatever the region holds.
        """
        asked = spool(asked, "asked")
        sizes = {r["region"]: r["count"] for r in asked.groupBy("region").count().collect()}
        blocks = {region: -(-size // BLOCK_QUERIES) for region, size in sizes.items()}
        cells = {region: -(-shards // CELL_SHARDS) for region, shards in self.shards.items()}
        asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), _by_region(blocks)))
        asked = asked.groupBy("region", "block").agg(F.collect_list(F.struct("id", "vec", "reach")).alias("asked"))
        asked = asked.withColumn("cell", F.explode(F.sequence(F.lit(0), _by_region(cells) - 1)))

        def search(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    get = lambda name: batch.column(name)[row].as_py()
                    dim = get("dim")
                    tree = Tree(unpacked(get("vecs"), "<f8", dim), unpacked(get("ids"), "<i8"), unpacked(get("bounds"), "<f8", 4))
                    block = batch.column("asked")[row].values
                    own = block.field("id").to_numpy(zero_copy_only=False)
                    limit = block.field("reach").fill_null(np.inf).to_numpy(zero_copy_only=False)
                    found = tree.search(matrix(block.field("vec")), own, limit, k, factor)
                    at, ids, score = found.rows()
                    yield pa.record_batch([pa.array(own[at]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

        met = self.trees.join(asked, ["region", "cell"]).select("dim", "ids", "vecs", "bounds", "asked")
        return met.mapInArrow(search, FOUND)


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query among what was found, ties to the smaller id."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _by_region(numbers: dict[int, int]):
    """The number of a row's region; regions number `REGIONS` at most."""
    if not numbers:
        return F.lit(1)
    pairs = [F.lit(x) for pair in numbers.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.col("region"))


def neighbours(vectors: DataFrame, queries: str, k: int = K, factor: float = FACTOR, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where `queries` holds of `id` the k nearest other rows.

    Euclidean distance in doubles, nearest first, ties to the smaller id; all
    other rows if there are fewer. Factor 1 finds exactly those; a greater one
    may miss some, and the figures it was chosen by are in the README. Rows with
    null, zero or not wholly finite vectors take no part, see
    `vectors.take_part`, which also says what counts where an id repeats. No
    rows, or no queries, give an empty result. Further columns are passed over.
    """
    rows = take_part(vectors, id_col, vec_col, zero=False)
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score DOUBLE")
    return Index(rows).search(rows.filter(queries), k, factor)


def op11_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every row of `embeddings` whose id is divisible by 100."""
    return neighbours(table(spark, sf_dir, "embeddings"), "id % 100 = 0")
