"""Nearest neighbours by inner product through low-dimensional stable projections and kd-trees.

Vectors get one more component that gives all of them the length of the longest, and
queries are scaled to it; then the largest inner product is the least Euclidean distance.
Gaussian projections to ``DIMENSIONS`` keep distances in the sense that the square of a
projected distance over that of the true one follows a chi-square law. A search takes
points in the order of their projected distance, a leaf of a kd-tree at a time, verifies
them by their exact inner products, and stops when the law says that a point nearer than
the ``k``-th found so far would have been met with probability ``CERTAIN``.

A coarse kd-tree, fitted on at most ``SAMPLE`` rows, cuts the projected space into cells.
Every row is put into its cell, and cells are dealt to blocks of ``BLOCK`` rows, each with
its own tree. A query first searches its own cell, and with the distance found there only
the other cells that the law does not rule out. What is broadcast are the cuts and the
boxes of at most ``CELLS`` cells.

Only the ``k`` + 1 least ids of equal vectors are kept as candidates, as no others can be
among the ``k`` nearest; so very many copies do not make a heavy cell.

Vectors that are null, zero, or have null or non-finite components take no part, nor do
rows without an id. Vectors of different lengths have no inner product: each length, of which
a table has few, is searched on its own. Of several rows
with a query's id one is the query, and none is among its candidates. Ties go to the
smaller id. Recall is measured against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moniker.llm.lattice import usable
from moniker.llm.words import groups
from moniker.sources import materialise

DIMENSIONS = 8
CERTAIN = 0.98
SAMPLE = 1 << 14
CELLS = 1024
BLOCK = 4096
QUERIES = 1024
LEAF = 32
SEED = 5_701


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, by bisection of the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        term = total = 1.0
        for k in range(1, degrees // 2):
            term *= x / 2 / k
            total += term
        low, high = (x, high) if 1 - np.exp(-x / 2) * total < p else (low, x)
    return (low + high) / 2


@dataclass
class Space:
    """The longest square, the projection, the cuts of the coarse tree, and the boxes of its cells."""

    longest: float
    projection: np.ndarray
    cuts: list[tuple[int, float]]  # heap order: axis and place
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def place(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Projected rows or queries."""
        square = (vectors * vectors).sum(axis=1)
        if query:
            vectors = vectors * np.sqrt(self.longest / square)[:, None]
            more = np.zeros(len(vectors))
        else:
            more = np.sqrt(np.maximum(self.longest - square, 0))
        return vectors @ self.projection[:-1] + more[:, None] * self.projection[-1]

    def cell(self, placed: np.ndarray) -> np.ndarray:
        """Cell of each projected row."""
        node = np.zeros(len(placed), np.int64)
        if self.cuts:
            axis, at = (np.array(x) for x in zip(*self.cuts, strict=True))
            for _ in range(int(np.log2(len(self.cuts) + 1))):
                node = 2 * node + 1 + (placed[np.arange(len(placed)), axis[node]] > at[node])
        return node - len(self.cuts)

    def beyond(self, placed: np.ndarray) -> np.ndarray:
        """Least squared projected distance of each query (rows) to each cell."""
        return _box_distance(placed, self.low, self.high)


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    return out


def _coarse(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Cuts of a balanced kd-tree with ``cells`` (a power of 2) leaves, widest axis first."""
    cuts, level = [], [points]
    while len(level) < cells:
        below = []
        for own in level:
            axis = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
            at = float(np.median(own[:, axis])) if len(own) else 0.0
            cuts.append((axis, at))
            right = own[:, axis] > at if len(own) else np.zeros(0, bool)
            below += [own[~right], own[right]]
        level = below
    return cuts


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree over ``points``."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        own = points[rows]
        axis = int(np.ptp(own, axis=0).argmax())
        order = rows[np.argpartition(own[:, axis], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def search_block(space: Space, rows, ids, queries, query_ids, bound, k: int, certain: float):
    """The best rows of a block for each query, as far as the law does not rule them out: (query number, id, score).

    ``bound`` is the inner product that a row has to reach, known from elsewhere (-inf: none).
    """
    stop = chi_square_quantile(certain, space.projection.shape[1])
    placed, asked = space.place(rows, False), space.place(queries, True)
    leaves = _leaves(placed)
    size = max(map(len, leaves))
    members = np.stack([np.pad(x, (0, size - len(x)), constant_values=-1) for x in leaves])
    low = np.stack([placed[x].min(axis=0) for x in leaves])
    high = np.stack([placed[x].max(axis=0) for x in leaves])
    far = _box_distance(asked, low, high)
    order = np.argsort(far, axis=1)
    scale = np.sqrt(space.longest) / np.sqrt((queries * queries).sum(axis=1))
    score = np.full((len(queries), k), -np.inf)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)
    active = np.arange(len(queries))
    for turn in range(len(leaves)):
        worst = np.maximum(score[active, k - 1], bound[active])
        reach = np.maximum(2 * space.longest - 2 * scale[active] * worst, 0)
        active = active[far[active, order[active, turn]] <= stop * np.where(np.isfinite(reach), reach, np.inf)]
        if not len(active):
            break
        near = members[order[active, turn]]
        own = np.einsum("qld,qd->ql", rows[near], queries[active])
        own[(near < 0) | (ids[near] == query_ids[active, None])] = -np.inf
        own_ids = np.where(np.isneginf(own), np.iinfo(np.int64).max, ids[near])
        all_scores = np.concatenate([score[active], own], axis=1)
        all_ids = np.concatenate([found[active], own_ids], axis=1)
        best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        score[active] = np.take_along_axis(all_scores, best, 1)
        found[active] = np.take_along_axis(all_ids, best, 1)
    q, r = np.nonzero(np.isfinite(score) & (score >= bound[:, None]))
    return q, found[q, r], score[q, r]


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _fit(vectors: DataFrame, length: int, sample: int, rows: int) -> Space:
    longest = vectors.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()[0]
    random = np.random.default_rng([SEED, length])
    space = Space(float(longest), random.normal(size=(length + 1, DIMENSIONS)), [])
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    cells = 1 << max(0, min(CELLS, max(1, rows // BLOCK)).bit_length() - 1)
    if picked.num_rows:
        space.cuts = _coarse(space.place(_matrix(picked.column("vector")), False), cells)
    return space


def _in_cells(vectors: DataFrame, space: Space, query: bool) -> DataFrame:
    """Each row with its cell and projected place."""
    shipped = vectors.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            placed = shipped.value.place(_matrix(batch.column("vector")), query)
            cell = shipped.value.cell(placed)
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(list(placed), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "place"])

    schema = vectors.select("*", F.lit(0).alias("cell"), F.array(F.lit(0.0)).alias("place")).schema
    return vectors.mapInArrow(run, schema)


def _searched(rows: DataFrame, queries: DataFrame, space: Space, k: int, certain: float) -> DataFrame:
    """(query, id, score): each of ``queries`` (query, vector, bound, cell) in its cell's ``rows`` (id, vector, cell)."""
    shipped = rows.sparkSession.sparkContext.broadcast(space)
    blocks = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("packs"))
    plan = F.broadcast(blocks.join(asked, "cell"))  # at most CELLS rows
    spot = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = rows.join(plan, "cell").select(
        "cell", spot("id", "blocks").alias("x"), up_to("packs").alias("y"), F.lit(False).alias("asks"), "id", "vector", F.lit(0.0).alias("bound")
    )
    ask = queries.join(plan, "cell").select(
        "cell", up_to("blocks").alias("x"), spot("query", "packs").alias("y"), F.lit(True).alias("asks"), F.col("query").alias("id"), "vector", "bound"
    )
    dealt = own.unionByName(ask).repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cell", "x", "y"]):
            asks = group.column("asks").to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, vectors = group.column("id").to_numpy(), _matrix(group.column("vector"))
            bound = group.column("bound").to_numpy()[asks]
            q, found, score = search_block(
                shipped.value, vectors[~asks], ids[~asks], vectors[asks], ids[asks], bound, k, certain
            )
            columns = [pa.array(ids[asks][q]), pa.array(found), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "score"])

    return dealt.mapInArrow(run, "query bigint, id bigint, score double")


def nearest(
    rows: DataFrame,
    asks: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    certain: float = CERTAIN,
) -> DataFrame:
    """(query, rank, id, score): the ``k`` nearest other rows of every row for which ``asks`` holds."""
    fit = rows.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    fit = materialise(fit.where(F.col("id").isNotNull() & usable(F.col("vector"))), "vectors")
    lengths = fit.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()
    if not lengths:
        return fit.select(F.col("id").alias("query"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score")).limit(0)
    if len(lengths) > 1:  # of several rows with a query's id one is the query
        shortest = F.min(F.when(F.col("asks"), F.size("vector"))).over(Window.partitionBy("id"))
        fit = materialise(fit.withColumn("asks", F.col("asks") & (F.size("vector") == shortest)), "vectors")
    found = [_nearest(fit.where(F.size("vector") == r["length"]), r["length"], r["n"], k, sample, certain) for r in lengths]
    return reduce(DataFrame.unionAll, found)


def _nearest(fit: DataFrame, length: int, rows: int, k: int, sample: int, certain: float) -> DataFrame:
    """The same among vectors (id, vector, asks) of one length."""
    space = _fit(fit.select("id", "vector"), length, sample, rows)
    first = Window.partitionBy("vector").orderBy("id")
    kept = fit.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k + 1).select("id", "vector")
    indexed = materialise(_in_cells(kept, space, False), "indexed")
    axes = range(DIMENSIONS)
    sides = [f(F.col("place")[d]) for f in (F.min, F.max) for d in axes]
    boxes = indexed.groupBy("cell").agg(*[s.alias(f"s{i}") for i, s in enumerate(sides)]).toArrow().to_pandas().set_index("cell")
    known = np.full((2, len(space.cuts) + 1, DIMENSIONS), np.inf)
    known[0, boxes.index], known[1, boxes.index] = boxes.iloc[:, :DIMENSIONS], boxes.iloc[:, DIMENSIONS:]
    space.low, space.high = known[0], np.where(np.isinf(known[1]), -np.inf, known[1])
    queries = fit.where("asks").groupBy("id").agg(F.min("vector").alias("vector")).withColumnRenamed("id", "query")
    queries = materialise(_in_cells(queries, space, True), "queries")
    rows_of = indexed.select("id", "vector", "cell")
    none = F.lit(float("-inf")).alias("bound")
    home = materialise(_searched(rows_of, queries.select("query", "vector", none, "cell"), space, k, certain), "home")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    home = home.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    bound = home.where(F.col("rank") == k).select("query", F.col("score").alias("bound"))
    away = _away(queries.join(bound, "query", "left"), space, certain)
    found = home.select("query", "id", "score").unionAll(_searched(rows_of, away, space, k, certain))
    best = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return best.select("query", F.col("rank").cast("int").alias("rank"), "id", "score")


def _away(queries: DataFrame, space: Space, certain: float) -> DataFrame:
    """(query, vector, bound, cell): the other cells each query has still to search."""
    shipped = queries.sparkSession.sparkContext.broadcast(space)
    stop = chi_square_quantile(certain, DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, QUERIES):
                part = batch.slice(low, QUERIES)
                vectors, own = _matrix(part.column("vector")), part.column("cell").to_numpy()
                bound = part.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
                bound = np.where(np.isnan(bound), -np.inf, bound)
                scale = np.sqrt(shipped.value.longest) / np.sqrt((vectors * vectors).sum(axis=1))
                reach = np.maximum(2 * shipped.value.longest - 2 * scale * bound, 0)
                asked = shipped.value.beyond(_matrix(part.column("place"))) <= stop * reach[:, None]
                asked[np.arange(len(own)), own] = False
                asked[:, np.isinf(shipped.value.low).any(axis=1)] = False
                q, cell = np.nonzero(asked)
                taken = part.select(["query", "vector"]).take(pa.array(q))
                columns = [*taken.columns, pa.array(bound[q]), pa.array(cell.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "vector", "bound", "cell"])

    schema = queries.select("query", "vector", F.lit(0.0).alias("bound"), F.lit(0).alias("cell")).schema
    return materialise(queries.select("query", "vector", "bound", "cell", "place").mapInArrow(run, schema), "away")
