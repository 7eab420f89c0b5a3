"""Embedding near-dedup by lattice hashing.

A unit vector is projected at random onto blocks of eight dimensions, and each block is decoded
to its nearest E8 lattice point. The points of all blocks name a cell of a table; there are
several tables with projections of their own. A vector lies in its home cell and also probes
the neighbouring cells that are nearest to it. Vectors that meet in a cell are verified by
their cosine in double precision.

Equal vectors collapse first. A pair that meets in several cells counts in one of them only,
which both sides can tell from their cells, so neighbours are counted without a table of pairs.
Cells with many vectors are cut into blocks, so no task holds a whole cell.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import join_on, stored
from kinetable.llm.components import components

COSINE = 0.95
#: tables, E8 blocks of a cell, size of the lattice at DIM dimensions, neighbouring cells probed in each table; a smaller
#: lattice or more blocks give more cells, for more vectors, at some recall near the limit
TABLES, BLOCKS, SCALE, PROBES = 10, 2, 0.25, 8
DIM = 64
SEED = 20_240
#: home vectors that one unit of work holds, and queries that it is asked, about
UNIT, QUERIES = 256, 512
PAIRS = 50_000


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, the steps to the neighbouring cells."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer one of the nearest in D8 and in D8 shifted by a half."""

    def decode_d8(y: np.ndarray) -> np.ndarray:
        # integers with an even sum: the worst rounded coordinate goes the other way when the sum is odd
        r = np.rint(y)
        off = y - r
        odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        r[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        return r

    a, b = decode_d8(x), decode_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


@lru_cache(maxsize=64)
def projection(dim: int, number: int, blocks: int) -> np.ndarray:
    """Orthonormal columns for one table; short vectors are padded with zeros."""
    wide = max(dim, 8 * blocks)
    return np.linalg.qr(np.random.default_rng((SEED, number, wide)).normal(size=(wide, 8 * blocks)))[0][:dim]


def _cell(points: np.ndarray, dim: int, number: int) -> np.ndarray:
    """One 64-bit name of a cell from its (doubled, whole) lattice coordinates, the table and the dimension."""
    odd = np.random.default_rng((SEED, 1)).integers(1, 1 << 62, points.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = np.full(len(points), (number << 32) + dim, np.uint64)
    for c, column in enumerate(np.rint(points * 2).astype(np.int64).astype(np.uint64).T):
        h = (h ^ (column * odd[c])) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(vectors: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (n, tables) and probed cells (n, tables, probes) of unit vectors (n, dim).

    A projection keeps less of a difference the more dimensions there are, so the lattice shrinks with them.
    """
    n, dim = vectors.shape
    scale = scale * (DIM / max(dim, 8)) ** 0.5
    steps = minimal_vectors().astype(np.float32)
    home, near = np.empty((n, tables), np.int64), np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        y = vectors @ projection(dim, t, blocks) / scale
        point = np.hstack([decode_e8(y[:, 8 * b : 8 * b + 8]) for b in range(blocks)])
        home[:, t] = _cell(point, dim, t)
        rest = (y - point).astype(np.float32)
        # how much nearer the vector is to the neighbour than the neighbour to the point
        gain = np.hstack([rest[:, 8 * b : 8 * b + 8] @ steps.T for b in range(blocks)])
        # which steps are nearest counts, not their order
        best = np.argpartition(-gain, probes, axis=1)[:, :probes]
        for p in range(probes):
            moved, block, step = point.copy(), best[:, p] // len(steps), best[:, p] % len(steps)
            for b in range(blocks):
                own = block == b
                moved[own, 8 * b : 8 * b + 8] += steps[step[own]]
            near[:, t, p] = _cell(moved, dim, t)
    return home, near


def _with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.int64()
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            sizes = part.column(1).value_lengths().to_numpy(zero_copy_only=False)
            values, ends = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)
            homes, probed = np.empty((len(sizes), TABLES), np.int64), np.empty((len(sizes), TABLES * PROBES), np.int64)
            for dim in np.unique(sizes).tolist():
                places = np.flatnonzero(sizes == dim)
                x = values[(ends[places] - dim)[:, None] + np.arange(dim)]
                home, near = cells(x / np.linalg.norm(x, axis=1)[:, None])
                homes[places], probed[places] = home, near.reshape(len(places), -1)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), longs)) for m in (homes, probed)]
            yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*part.schema.names, "homes", "probes"])


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class _Rows:
    """Rows of a unit stream as arrays; vectors of one dimension only meet in a cell."""

    def __init__(self, batch: pa.RecordBatch | None) -> None:
        names = ("cell", "block", "role", "node", "copies")
        if batch is None:
            self.cols = {n: np.empty(0, np.int64) for n in names}
            self.vectors = np.empty((0, 0))
            self.homes, self.probes = np.empty((0, TABLES), np.int64), np.empty((0, TABLES * PROBES), np.int64)
            return
        self.cols = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}
        # one row each, shorter vectors padded with zeros: a cell has one dimension only, and zeros change no cosine
        lists = batch.column("vector")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        wide = int(sizes.max(initial=0))
        if (sizes == wide).all():
            vectors = values.reshape(batch.num_rows, wide)
        else:
            vectors = np.zeros((batch.num_rows, wide))
            inside = np.arange(wide) < sizes[:, None]
            vectors[inside] = values
        self.vectors = vectors / np.linalg.norm(vectors, axis=1)[:, None] if batch.num_rows else vectors
        self.homes, self.probes = _lists(batch.column("homes"), TABLES), _lists(batch.column("probes"), TABLES * PROBES)

    def take(self, at) -> _Rows:
        out = _Rows(None)
        out.cols = {n: c[at] for n, c in self.cols.items()}
        out.vectors, out.homes, out.probes = self.vectors[at], self.homes[at], self.probes[at]
        return out

    def plus(self, other: _Rows) -> _Rows:
        out = _Rows(None)
        out.cols = {n: np.r_[c, other.cols[n]] for n, c in self.cols.items()}
        wide = max(self.vectors.shape[1], other.vectors.shape[1])
        out.vectors = np.vstack([np.pad(r.vectors, ((0, 0), (0, wide - r.vectors.shape[1]))) for r in (self, other)])
        out.homes, out.probes = np.vstack([self.homes, other.homes]), np.vstack([self.probes, other.probes])
        return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units in order, homes before queries: for every node the links found and one node it hangs together with."""
    held = _Rows(None)
    for batch in batches:
        rows = _Rows(batch)
        if not len(rows.vectors):
            continue
        is_home = rows.cols["role"] == 0
        homes, queries = held.plus(rows.take(is_home)), rows.take(~is_home)
        # the place of every query's homes
        key = lambda r: np.rec.fromarrays([r.cols["cell"], r.cols["block"]])
        units, first, count = np.unique(key(homes), return_index=True, return_counts=True)
        if len(queries.vectors) and len(units):
            at = np.minimum(np.searchsorted(units, key(queries)), len(units) - 1)
            size = np.where(units[at] == key(queries), count[at], 0)
            yield from _links(homes, queries, first[at], size)
        # the last unit may go on in the next batch
        last = key(rows)[-1]
        held = homes.take(key(homes) == last)


def _links(homes: _Rows, queries: _Rows, first: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        # queries whose pairs together stay below PAIRS, one query at least
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        q = np.repeat(np.arange(at, stop), size[at:stop])
        h = np.arange(len(q)) - np.repeat(np.cumsum(size[at:stop]) - size[at:stop], size[at:stop]) + first[q]
        at = stop
        different = queries.cols["node"][q] != homes.cols["node"][h]
        q, h = q[different], h[different]
        if not len(q):
            continue
        # rows of one dimension meet, the rest of the wider ones is zeros
        shared = min(queries.vectors.shape[1], homes.vectors.shape[1])
        cosine = np.einsum("ij,ij->i", queries.vectors[q, :shared], homes.vectors[h, :shared])
        q, h = q[cosine >= COSINE], h[cosine >= COSINE]
        if not len(q):
            continue
        a, b = queries.homes[q], homes.homes[h]
        shape = (len(q), TABLES, PROBES)
        together = a == b
        by_query = (queries.probes[q].reshape(shape) == b[:, :, None]).any(axis=2)
        by_home = (homes.probes[h].reshape(shape) == a[:, :, None]).any(axis=2)
        none = np.iinfo(np.int64).max
        least = np.minimum(np.where(together | by_query, b, none).min(axis=1), np.where(by_home, a, none).min(axis=1))
        cell = queries.cols["cell"][q]
        both = (together & (b == cell[:, None])).any(axis=1)
        mine = (cell == least) & (~both | (queries.cols["node"][q] < homes.cols["node"][h]))
        q, h = q[mine], h[mine]
        if len(q):
            yield _summed(queries.cols["node"][q], homes.cols["node"][h], queries.cols["copies"][q], homes.cols["copies"][h])


def _summed(a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray) -> pa.RecordBatch:
    """Links of each node and the smallest node of its group among these pairs."""
    nodes, place = np.unique(np.r_[a, b], return_inverse=True)
    links = np.bincount(place, weights=np.r_[copies_b, copies_a].astype(np.float64)).astype(np.int64)
    i, j = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == label).all():
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(nodes[label])], names=["node", "links", "other"])
        label = after


def valid(vector):
    """Not null, with finite components and one of them not zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & finite & F.exists(x, lambda v: v != 0)


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``table``.

    n_links counts the other ids whose vector has a cosine of COSINE or more; component_id is the
    smallest id reachable, kept whether it is the row's own. Null, zero and non-finite vectors
    link with nothing. Rows that repeat id and vector count as one. Vectors of different
    dimensions do not link. Every vector is indexed; links can be missed only when no table
    brings a pair together (recall measured in the tests).
    """
    rows = table.select(F.col(id_col).alias("id"), F.when(valid(vector), F.xxhash64(vector)).alias("node"), F.col(vector).alias("vector"))
    ids = rows.where(F.col("node").isNotNull()).groupBy("node", "id").agg(F.first("vector").alias("vector"))
    nodes = ids.groupBy("node").agg(F.first("vector").alias("vector"), F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"node bigint, vector {kind}, first bigint, copies bigint, homes array<bigint>, probes array<bigint>"
    indexed = stored(nodes.mapInArrow(_with_cells, schema), "lattice")

    homes = indexed.select("node", F.explode("homes").alias("cell"))
    sizes = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    # probes that reach a cell with a vector: most reach none
    probes = stored(indexed.select("node", F.explode("probes").alias("cell")).join(sizes, "cell"), "lattice")
    busy = probes.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    full = sizes.join(busy, "cell", "left").where((F.col("n") > 1) | F.col("m").isNotNull())
    # a cell is a grid of blocks of homes and parts of queries; every cell of the grid is one unit
    blocks, parts = F.ceil(F.col("n") / UNIT).cast("int"), F.ceil((F.col("n") + F.coalesce("m", F.lit(0))) / QUERIES).cast("int")
    full = full.select("cell", blocks.alias("blocks"), parts.alias("parts"))
    met = homes.join(full, "cell")
    asked = met.unionByName(probes.select("node", "cell").join(full, "cell"))
    own, part = F.pmod(F.xxhash64("node"), "blocks").cast("int"), F.pmod(F.xxhash64(F.lit("query"), "node"), "parts").cast("int")
    all_parts, all_blocks = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    as_home = met.withColumn("_part", all_parts).select("cell", (own * F.col("parts") + F.col("_part")).alias("block"), F.lit(0).alias("role"), "node")
    as_query = asked.withColumn("_block", all_blocks).select("cell", (F.col("_block") * F.col("parts") + part).alias("block"), F.lit(1).alias("role"), "node")
    work = as_home.union(as_query)
    work = work.join(indexed.drop("first"), "node").repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    found = stored(work.mapInArrow(_verify, "node bigint, links bigint, other bigint"), "lattice")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), "lattice")
    member = indexed.select("node", "first", "copies").join(roots, "node", "left").join(links, "node", "left")
    member = member.select("node", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(smallest, "root").select("node", "n_links", "component_id")
    out = join_on(rows.select("id", "node"), named, ["node"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)
