"""Near-duplicate vectors by hashing to the E8 lattice.

Every vector is scaled to length 1 and projected to ``BLOCKS`` times 8 dimensions, in
each of ``TABLES`` tables anew; each 8 are decoded to the nearest point of E8, and the
points together are the vector's cell. A vector is also shown in the neighbouring cells
that are nearest to it: one block at a time moved to one of the lattice points next
nearest. Two vectors meet where the home of one is a cell of the other, and are linked if
their cosine, in double precision from the given components, is ``LEAST`` or more.

Equal vectors are one class, counted. In a cell, sign sketches of 64 bits first rule out
the classes that have no partner there; only the others get their vectors attached and are
compared, and a spanning forest of their links is written, not the links. Links lie within
the components of these forests, so each component is then compared with itself as
matrices, every pair once, and only sums are written. Cells and components with very many
classes are dealt to blocks of ``BLOCK``, each pair of blocks a group of its own.

Null and zero vectors and those with null or non-finite components, and rows without an id,
are linked with nothing. Vectors of different lengths never meet. Of rows with the same id
and vector each is counted. Recall is measured against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.llm.graph import components
from moniker.llm.words import groups, mix, spread
from moniker.sources import materialise

TABLES, BLOCKS, PROBES = 13, 2, 3
SCALE = 2.0
SEED = 20_248
BLOCK = 1024
APART = 22  # sign sketches of linked vectors (an angle of 18 degrees) differ in 6 or 7 bits of 64, and all but never in more


def decode_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8 (integers or halves, with an even sum), doubled to be integers; last axis has 8."""
    best, least = None, None
    for shift in (0.0, 0.5):
        z = np.rint(y - shift)
        error = y - shift - z
        odd = (z.sum(axis=-1) % 2 != 0)[..., None]
        worst = np.abs(error).argmax(axis=-1)[..., None]
        turned = np.take_along_axis(z, worst, -1) + np.where(np.take_along_axis(error, worst, -1) >= 0, 1, -1)
        fixed = z.copy()
        np.put_along_axis(fixed, worst, turned, -1)
        point = np.where(odd, fixed, z) + shift
        far = ((y - point) ** 2).sum(axis=-1)
        if best is None:
            best, least = point, far
        else:
            nearer = (far < least)[..., None]
            best = np.where(nearer, point, best)
    return np.rint(2 * best).astype(np.int64)


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: two coordinates of 2, or all of 1 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = np.zeros(8, np.int64)
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = np.array([1 - 2 * (signs >> k & 1) for k in range(8)])
        if (v < 0).sum() % 2 == 0:
            out.append(v)
    return np.array(out)


@cache
def _drawn(dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projections and offsets of all tables, and the directions of the sketch."""
    random = np.random.default_rng([SEED, dimensions])
    projections = random.normal(size=(TABLES, dimensions, 8 * BLOCKS)) * (SCALE / np.sqrt(8))
    return projections, random.uniform(0, 2, (TABLES, 8 * BLOCKS)), random.normal(size=(dimensions, 64))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells_of(units: np.ndarray) -> np.ndarray:
    """Hashes of the cells of each vector: (rows, tables, 1 + BLOCKS * PROBES), the home first."""
    projections, offsets, _ = _drawn(units.shape[1])
    vectors = shortest_vectors()
    out = np.empty((len(units), TABLES, 1 + BLOCKS * PROBES), np.int64)
    factors = mix(np.arange(1, 8 * BLOCKS + 1, dtype=np.uint64)) | np.uint64(1)
    for t in range(TABLES):
        y = (units @ projections[t] + offsets[t]).reshape(len(units), BLOCKS, 8)
        home = decode_e8(y)
        nearest = np.argpartition(-((2 * y - home) @ vectors.T), PROBES, axis=-1)[..., :PROBES]
        base = mix(np.full(len(units), (t << 32) + units.shape[1], np.uint64))
        own = base + (home.reshape(len(units), -1).astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)
        out[:, t, 0] = mix(own).view(np.int64)
        for b in range(BLOCKS):
            moves = (vectors.astype(np.uint64) * factors[8 * b : 8 * b + 8]).sum(axis=1, dtype=np.uint64)
            moved = mix(own[:, None] + moves[nearest[:, b]])
            out[:, t, 1 + b * PROBES : 1 + (b + 1) * PROBES] = moved.view(np.int64)
    return out


def sketches(units: np.ndarray) -> np.ndarray:
    """64 signs of each vector, as the bits of a number."""
    signs = units @ _drawn(units.shape[1])[2] >= 0
    return np.packbits(signs, axis=1, bitorder="little").view(np.int64)[:, 0]


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors, for each length of vector there is."""
    rows = column.to_numpy(zero_copy_only=False)
    lengths = np.array([len(r) for r in rows])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, np.stack([rows[i] for i in at])


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _cells(classes: DataFrame) -> DataFrame:
    """(cell, class, home, sketch) of every cell in which a class is shown."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("class").to_numpy()
            for at, vectors in _matrices(batch.column("vector")):
                for low in range(0, len(at), 2048):
                    rows, units = at[low : low + 2048], unit(vectors[low : low + 2048])
                    cells = cells_of(units)
                    shape = cells.shape[1] * cells.shape[2]
                    home = np.zeros(cells.shape, bool)
                    home[:, :, 0] = True
                    columns = [cells.ravel(), np.repeat(ids[rows], shape), home.ravel(), np.repeat(sketches(units), shape)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "class", "home", "sketch"])

    return classes.select("class", "vector").mapInArrow(run, "cell bigint, class bigint, home boolean, sketch bigint")


def _pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs of rows within groups that lie one after the other."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    row_sizes = np.repeat(sizes, sizes)
    return np.repeat(np.arange(len(row_sizes)), row_sizes), spread(np.repeat(starts, sizes), row_sizes)


def _promising(cells: DataFrame) -> DataFrame:
    """(cell, class, home, k) where the sketch leaves a partner. Cells with over ``BLOCK`` rows stay as they are."""
    counted = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("k"), F.count_if("home").alias("homes"))
    counted = counted.where("k > 1 and homes > 0").select("cell", "k")
    shared = cells.join(counted, "cell")
    large = shared.where(F.col("k") > BLOCK).select("cell", "class", "home", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _several(groups(batches, ["cell"]), 4 * BLOCK):
            sketch, home = cell.column("sketch").to_numpy().view(np.uint64), cell.column("home").to_numpy()
            value = cell.column("cell").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            i, j = _pairs(np.diff(np.append(starts, len(value))))
            near = home[i] & (i != j) & (np.bitwise_count(sketch[i] ^ sketch[j]) <= APART)
            kept = np.zeros(len(value), bool)
            kept[i[near]] = kept[j[near]] = True
            yield from cell.select(["cell", "class", "home", "k"]).filter(pa.array(kept)).to_batches()

    small = shared.where(F.col("k") <= BLOCK).repartition("cell").sortWithinPartitions("cell")
    return small.mapInArrow(run, "cell bigint, class bigint, home boolean, k bigint").unionAll(large)


def _several(tables: Iterator[pa.Table], rows: int) -> Iterator[pa.Table]:
    """Whole groups put together until there are about so many rows."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= rows:
            yield pa.concat_tables(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _dealt(rows: DataFrame, group: str, k: str) -> DataFrame:
    """Rows of each group in blocks; every row goes to all pairs of blocks that have its own."""
    blocks = F.ceil(F.col(k) / BLOCK).cast("int")
    own = rows.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    other = other.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    return other.repartition(group, "x", "y").sortWithinPartitions(group, "x", "y")


def _near_pairs(table: pa.Table, group: str, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs i < j of rows within groups (one group of blocks, or several whole groups)."""
    value = table.column(group).to_numpy()
    block, x, y = (table.column(c).to_numpy() for c in ("block", "x", "y"))
    edge = (value[1:] != value[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    starts = np.flatnonzero(np.concatenate([[True], edge]))
    vectors = table.column("vector").combine_chunks().to_numpy(zero_copy_only=False)
    found = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(value)], strict=True):
        units = unit(np.stack(vectors[a:b]))
        near = np.triu(units @ units.T >= least, 1)
        if x[a] != y[a]:
            near &= block[a:b, None] != block[None, a:b]
        i, j = np.nonzero(near)
        found.append((i + a, j + a))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _forest(rows: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) that join what is linked within a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _several(groups(batches, ["cell", "x", "y"]), BLOCK):
            ids, home = table.column("class").to_numpy(), table.column("home").to_numpy()
            i, j = _near_pairs(table, "cell", least)
            met = home[i] | home[j]
            i, j = i[met], j[met]
            label = np.arange(len(ids))
            while True:
                lower = np.minimum(label[i], label[j])
                new = label.copy()
                np.minimum.at(new, i, lower)
                np.minimum.at(new, j, lower)
                if (new == label).all():
                    break
                label = new
            moved = label != np.arange(len(ids))
            columns = [pa.array(ids[moved]), pa.array(ids[label[moved]])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return _dealt(rows, "cell", "k").mapInArrow(run, "a bigint, b bigint").distinct()


def _degrees(rows: DataFrame, least: float) -> DataFrame:
    """(class, links): the vectors of other classes that a class is linked with. ``rows``: (root, class, n, vector, k)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _several(groups(batches, ["root", "x", "y"]), BLOCK):
            ids, n = table.column("class").to_numpy(), table.column("n").to_numpy()
            i, j = _near_pairs(table, "root", least)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["class", "links"])

    found = _dealt(rows, "root", "k").mapInArrow(run, "class bigint, links bigint")
    return found.groupBy("class").agg(F.sum("links").alias("links"))


def linked_vectors(rows: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component) of every row: how many others it is linked with, and the least id it reaches."""
    own = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    fit = F.col("id").isNotNull() & usable(F.col("vector"))
    classes = own.where(fit).groupBy("vector").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("n"))
    # Different vectors may have the same least id; a class needs one of its own.
    classes = materialise(classes.select(F.xxhash64("class", "vector").alias("class"), F.col("class").alias("least"), "n", "vector"), "vectors")
    cells = materialise(_cells(classes), "cells")
    promising = materialise(_promising(cells), "promising")
    vectors = classes.select("class", "vector")
    roots = components(_forest(promising.join(vectors, "class"), least))
    joined = materialise(classes.join(roots.toDF("class", "root"), "class"), "joined")
    sizes = joined.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.min("least").alias("component"))
    degrees = _degrees(joined.join(sizes.select("root", "k"), "root"), least)
    known = joined.join(sizes.select("root", "component"), "root").join(degrees, "class").select("class", "links", "component")
    told = classes.join(known, "class", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "least").alias("component")
    )
    linked = own.where(fit).join(told, "vector").select("id", "n_links", "component")
    return linked.unionAll(own.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
