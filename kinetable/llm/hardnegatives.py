"""Hard-negative mining with angular triangle filtering.

Every row keeps its angles to a few reference directions. The angle between two rows lies between
the difference and the sum of their angles to any reference, so a pair of stored angles gives an
interval of the cosine and, multiplied by the norms and widened for rounding, of the score. Rows
are packed into blocks by their nearest reference, sorted by the angle to it. Blocks of anchors meet
only the blocks of rows whose interval reaches what is wanted; within a block an anchor takes the
run of rows whose angle overlaps its window, and only these get integer scores.

The reference directions are fitted on a sample of at most ``SAMPLE`` rows; any directions give the
same result, better ones give narrower windows. All rows are in the blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.llm.common import stored

#: reference directions, and rows of the sample they are fitted on
REFERENCES, SAMPLE = 16, 4096
#: rows and anchors that stand in one block
ROWS, ANCHORS = 4096, 256
POSITIVES, NEGATIVES = 5, 5
#: a negative's score is at least this share (in percent) of the positive's, and at most the whole
LEAST_PERCENT = 80
#: angles are wrong by less than this, norms and products by less than this share
SLACK = 1e-6
_LONG = (1 << 63) - 1
_FLOATS = pa.list_(pa.float64())


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _scaled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, norms), safe for components whose squares overflow."""
    most = np.abs(rows).max(1, initial=0.0)
    small = np.divide(rows, most[:, None], out=np.zeros_like(rows), where=most[:, None] > 0)
    return _unit(small), most * np.linalg.norm(small, axis=1)


def fit_references(sample: np.ndarray, count: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Directions of ``count`` clusters of the sample, by spherical k-means from far-apart rows."""
    unit = _scaled(sample)[0]
    unit = unit[np.abs(unit).sum(1) > 0]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen = [0]
    nearest = unit @ unit[0]
    for _ in range(min(count, len(unit)) - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        moved = _unit(sums)
        centres = np.where(np.abs(moved).sum(1, keepdims=True) > 0, moved, centres)
    return centres


def references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions by dimension, from a sample of at most SAMPLE rows by the least hashes of all rows."""
    taken = rows.select("q", F.xxhash64("id", "label", "q").alias("_hash")).orderBy("_hash").limit(SAMPLE).collect()
    by: dict[int, list] = {}
    for r in taken:
        by.setdefault(len(r["q"]), []).append(r["q"])
    return {dim: fit_references(np.array(q, np.float64).reshape(len(q), dim)) for dim, q in by.items() if dim}


def whole_numbers(rows: DataFrame, id_col: str, label: Column, vector: str, scale: float = 256.0) -> DataFrame:
    """(id, label, q): rows that take part, with the components floored after scaling; equal rows once."""
    values = F.col(vector).cast("array<double>")
    # floor() makes a long; larger numbers have no fraction after scaling
    floored = F.transform(values, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * scale).cast("double")).otherwise(x * scale))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    told = rows.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite)
    told = told.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), floored.alias("q"))
    return told.where("label IS NOT NULL").dropDuplicates(["id", "label", "q"])


_PLACED = "id BIGINT, label BIGINT, dim INT, cell INT, norm DOUBLE, angles ARRAY<DOUBLE>, q ARRAY<DOUBLE>"


def placed(rows: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """(id, label, dim, cell, norm, angles, q): the nearest reference and the angles to all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                q = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                refs = directions.get(int(dim), np.zeros((0, dim)))
                unit, norm = _scaled(q)
                cosine = np.clip(unit @ refs.T, -1, 1)
                cell = cosine.argmax(1) if refs.shape[0] else np.zeros(len(at), int)
                angles = np.arccos(cosine)
                offsets = pa.array(np.arange(len(at) + 1) * refs.shape[0], pa.int32())
                columns = [part.column(0), part.column(1), pa.array(np.full(len(at), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(norm)]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())), part.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "dim", "cell", "norm", "angles", "q"])

    return rows.select("id", "label", "q").mapInArrow(run, _PLACED)


_BLOCK = (
    "block BIGINT, rows INT, dim INT, cell INT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>, least DOUBLE, most DOUBLE, "
    "ids BINARY, labels BINARY, norms BINARY, angles BINARY, q BINARY"
)


def _pack(table: pa.Table) -> pa.Table:
    """One block: rows sorted by the angle to its own reference, and the bounds of angles and norms."""
    n, dim, cell = table.num_rows, table["dim"][0].as_py(), table["cell"][0].as_py()
    table = table.combine_chunks()

    def flat(name: str) -> np.ndarray:
        return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))

    angles = flat("angles") if len(table["angles"][0]) else np.zeros((n, 0))
    q = flat("q") if dim else np.zeros((n, 0))
    ids, labels, norms = (table[c].to_numpy() for c in ("id", "label", "norm"))
    order = np.lexsort((ids, angles[:, cell] if angles.shape[1] else ids))
    row = {
        "block": [table["block"][0].as_py()], "rows": [n], "dim": [dim], "cell": [cell], "low": [angles.min(0).tolist()], "high": [angles.max(0).tolist()],
        "least": [norms.min()], "most": [norms.max()], "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()], "norms": [norms[order].tobytes()],
        "angles": [angles[order].tobytes()], "q": [np.ascontiguousarray(q[order]).tobytes()],
    }
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), _FLOATS, _FLOATS, pa.float64(), pa.float64(), *[pa.binary()] * 5]
    return pa.table({name: pa.array(v, k) for (name, v), k in zip(row.items(), kinds, strict=True)})


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of about ``size`` rows of one nearest reference, numbered from 0; a large cell is dealt into several by a hash."""
    # one row for each reference and dimension
    counts = sorted(map(tuple, rows.groupBy("dim", "cell").count().collect()))
    firsts, total = [], 0
    for dim, cell, n in counts:
        parts = -(-n // size)
        firsts.append((dim, cell, total, parts))
        total += parts
    if not firsts:
        return rows.sparkSession.createDataFrame([], _BLOCK)
    deal = rows.sparkSession.createDataFrame(firsts, "dim INT, cell INT, _first BIGINT, _parts BIGINT")
    numbered = rows.join(F.broadcast(deal), ["dim", "cell"]).withColumn("block", F.col("_first") + F.pmod(F.xxhash64("id", "label", "norm"), F.col("_parts")))
    return numbered.drop("_first", "_parts").groupBy("block").applyInArrow(_pack, _BLOCK)


class Block:
    """The arrays of a packed block."""

    def __init__(self, row: dict, prefix: str = "") -> None:
        self.ids, self.labels = (np.frombuffer(row[prefix + c], np.int64) for c in ("ids", "labels"))
        n = len(self.ids)
        self.norms = np.frombuffer(row[prefix + "norms"], np.float64)
        self.angles = np.frombuffer(row[prefix + "angles"], np.float64).reshape(n, -1)
        self.q = np.frombuffer(row[prefix + "q"], np.float64).reshape(n, -1)
        self.cell, self.number = row[prefix + "cell"], row[prefix + "block"]
        self.largest = np.abs(self.q).max(initial=0.0)


def scores(block: Block, start: int, stop: int, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products of a run of rows with an anchor; beyond 64 bits the nearest number of 64 bits."""
    if len(anchor) * block.largest * np.abs(anchor).max(initial=0.0) < 2.0**53:
        return (block.q[start:stop] @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    return np.array([max(-_LONG, min(_LONG, sum(int(x) * w for x, w in zip(row, whole, strict=True)))) for row in block.q[start:stop]], np.int64)


def window(block: Block, angle: float, norm: float, low: float, high: float) -> tuple[int, int]:
    """The run of rows whose score with an anchor may lie in [low, high]; ``angle`` is the anchor's to the block's reference.

    cos(angle + x) * norms <= score <= cos(angle - x) * norms for a row at the angle x.
    """
    if not block.angles.shape[1] or norm == 0:
        return 0, len(block.ids)
    own = block.angles[:, block.cell]
    least, most = norm * block.norms.min() * (1 - SLACK), norm * block.norms.max() * (1 + SLACK)
    first, last = -np.inf, np.inf
    if low - 1 > 0:
        near = np.arccos(min(1.0, (low - 1) / most)) + SLACK if most > 0 else 0.0
        first, last = angle - near, angle + near
    if 0 <= high + 1 < least:
        far = np.arccos((high + 1) / least) - SLACK
        first, last = max(first, far - angle), min(last, 2 * np.pi - far - angle)
    return int(np.searchsorted(own, first - SLACK)), int(np.searchsorted(own, last + SLACK, "right"))


def _best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` of the places ``at`` by falling score and rising id."""
    if len(at) > count:
        cut = np.partition(score[at], len(at) - count)[len(at) - count]
        at = at[score[at] >= cut]
    return at[np.lexsort((ids[at], -score[at]))][:count]


_HIT = [("ablock", pa.int64()), ("apos", pa.int32()), ("anchor_id", pa.int64()), ("of", pa.int32()), ("id", pa.int64()), ("block", pa.int64()), ("pos", pa.int32()), ("score", pa.int64())]
_HITS = "ablock BIGINT, apos INT, anchor_id BIGINT, of INT, id BIGINT, block BIGINT, pos INT, score BIGINT"


def _scored(pairs: DataFrame, find: Callable[[Block, Block, dict], Iterator[tuple[int, int, int, int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """Hits of ``find`` over rows that hold a block of anchors (``a_`` columns) and one of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors, block = Block(row, "a_"), Block(row)
                out: list[list] = [[] for _ in _HIT]
                for apos, of, start, score, best in find(anchors, block, row):
                    for k in best.tolist():
                        for column, value in zip(out, (anchors.number, apos, int(anchors.ids[apos]), of, int(block.ids[start + k]), block.number, start + k, int(score[k])), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(out, _HIT, strict=True)], names=[n for n, _ in _HIT])

    return pairs.mapInArrow(run, _HITS)


def _find_positives(anchors: Block, block: Block, row: dict) -> Iterator[tuple]:
    known = row.get("a_known") or [-np.inf] * len(anchors.ids)
    for i in range(len(anchors.ids)):
        angle = anchors.angles[i, block.cell] if anchors.angles.shape[1] else 0.0
        start, stop = window(block, angle, anchors.norms[i], known[i], np.inf)
        if start >= stop:
            continue
        same = np.flatnonzero(block.labels[start:stop] == anchors.labels[i])
        # the anchor itself, and not another row of its id
        own = (block.ids[start:stop][same] == anchors.ids[i]) & (block.q[start:stop][same] == anchors.q[i]).all(1)
        same = same[~own]
        if len(same):
            score = scores(block, start, stop, anchors.q[i])
            yield i, 0, start, score, _best(score, block.ids[start:stop], same, POSITIVES)


def _find_negatives(anchors: Block, block: Block, row: dict) -> Iterator[tuple]:
    wanted = np.array(row["a_positives"], np.int64).reshape(-1, 3)
    for i in np.unique(wanted[:, 0]).tolist():
        own = wanted[wanted[:, 0] == i]
        high = int(own[:, 2].max())
        low = int(own[:, 2].min()) * LEAST_PERCENT / 100
        if high < 0:
            # 80 p > 100 p: no score fits
            continue
        angle = anchors.angles[i, block.cell] if anchors.angles.shape[1] else 0.0
        start, stop = window(block, angle, anchors.norms[i], min(low, high) * (1 - SLACK), float(high))
        other = np.flatnonzero(block.labels[start:stop] != anchors.labels[i])
        if not len(other):
            continue
        score = scores(block, start, stop, anchors.q[i])
        for _, rank, positive in own.tolist():
            # LEAST_PERCENT * p <= 100 * s in whole numbers, without leaving 64 bits
            least = -((-LEAST_PERCENT * positive) // 100)
            fits = other[(score[other] >= least) & (score[other] <= positive)]
            if len(fits):
                yield i, rank, start, score, _best(score, block.ids[start:stop], fits, NEGATIVES)


def _angle_gap(side: str) -> Column:
    """Least (or greatest) angle between a row of the anchors' block and one of the other, over all references."""
    place = F.sequence(F.lit(0), F.size("low") - 1)
    pi = F.lit(float(np.pi))
    if side == "least":
        each = F.transform(place, lambda j: F.greatest(F.get("a_low", j) - F.get("high", j), F.get("low", j) - F.get("a_high", j), F.lit(0.0)))
        return F.when(F.size("low") > 0, F.array_max(each) - 2 * SLACK).otherwise(F.lit(0.0))
    each = F.transform(place, lambda j: F.least(F.get("a_high", j) + F.get("high", j), 2 * pi - F.get("a_low", j) - F.get("low", j)))
    return F.when(F.size("low") > 0, F.least(F.array_min(each) + 2 * SLACK, pi)).otherwise(pi)


def _meeting(anchor_blocks: DataFrame, row_blocks: DataFrame, count: int, low: str, high: str) -> DataFrame:
    """Pairs of blocks whose score bounds reach [low, high] of the anchors' block, with both blocks' arrays.

    The bounds decide before any array moves: every block of anchors names all blocks of rows, which
    are numbered, and meets their summaries by number.
    """
    summary = ["block", "dim", "low", "high", "least", "most"]
    names = anchor_blocks.select(F.col("block").alias("ablock"), *[F.col(c).alias(f"a_{c}") for c in summary[1:]], low, high)
    named = names.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))))
    met = named.join(row_blocks.select(*summary), "block").where("a_dim = dim")
    nearest, farthest = F.cos(F.greatest(_angle_gap("least"), F.lit(0.0))), F.cos(_angle_gap("most"))
    most, least = F.col("a_most") * F.col("most") * (1 + SLACK), F.col("a_least") * F.col("least") * (1 - SLACK)
    upper = F.when(nearest >= 0, nearest * most).otherwise(nearest * least) + SLACK * most + 1
    lower = F.when(farthest <= 0, farthest * most).otherwise(farthest * least) - SLACK * most - 1
    met = met.where((upper >= F.col(low)) & (lower <= F.col(high))).select("ablock", "block")
    # the arrays of the anchors, the smaller ones, travel to the rows'
    extra = [c for c in anchor_blocks.columns if c not in (low, high)]
    carried = met.join(anchor_blocks.select(F.col("block").alias("ablock"), *[F.col(c).alias(f"a_{c}") for c in extra]), "ablock").drop("ablock")
    return carried.join(row_blocks, "block")


def _ranked(hits: DataFrame, by: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "block", "pos")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: Column | None = None, vector: str = "embedding", rows_per_block: int = ROWS, anchors_per_block: int = ANCHORS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    An anchor's positives are its first other rows of the same label by falling score, ties by
    smaller id; the negatives of a positive are the first rows of another label whose score is
    from 80 to 100 percent of the positive's. ``is_anchor`` is a condition on ``id``. Rows with a
    null id, label, vector or component, or one that is not finite, take no part; equal rows count
    once; rows of one id and different vectors are different rows. Vectors of different lengths
    have no score with each other. Scores beyond 64 bits count as the nearest number of 64 bits.
    """
    empty = rows.sparkSession.createDataFrame([], "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT, negative_score BIGINT")
    whole = stored(whole_numbers(rows, id_col, F.col("label") if label is None else label, vector), "hardnegatives")
    located = stored(placed(whole, references(whole)), "hardnegatives")
    packed = stored(blocks(located, rows_per_block), "hardnegatives")
    anchors = stored(blocks(located.where(is_anchor), anchors_per_block), "hardnegatives")
    count = packed.count()
    if not count or anchors.isEmpty():
        return empty

    # a first threshold from one block of the same reference: positives below it need no search
    seed = packed.groupBy("dim", "cell").agg(F.min("block").alias("block")).select("dim", "cell", "block")
    own = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).join(seed, (F.col("a_dim") == F.col("dim")) & (F.col("a_cell") == F.col("cell"))).drop("dim", "cell")
    first = _ranked(_scored(own.join(packed, "block"), _find_positives), ["ablock", "apos"], POSITIVES).where(F.col("rank") == POSITIVES)
    fifth = first.groupBy(F.col("ablock").alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("apos", F.col("score").cast("double")))).alias("_fifth"))
    known = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.coalesce(F.try_element_at("_fifth", i), F.lit(float("-inf"))))
    begun = anchors.join(fifth, "block", "left").withColumn("known", known).drop("_fifth")
    begun = stored(begun.withColumns({"_low": F.array_min("known"), "_high": F.lit(float("inf"))}), "hardnegatives")
    hits = _scored(_meeting(begun, packed, count, "_low", "_high"), _find_positives)
    positives = stored(_ranked(hits, ["ablock", "apos"], POSITIVES), "hardnegatives")

    triples = F.collect_list(F.array(F.col("apos").cast("bigint"), F.col("rank").cast("bigint"), F.col("score")))
    wanted = positives.groupBy(F.col("ablock").alias("block")).agg(triples.alias("positives"), F.min("score").alias("_least"), F.max("score").cast("double").alias("_high"))
    wanted = wanted.where("_high >= 0").withColumn("_low", F.least(F.col("_least") * (LEAST_PERCENT / 100), "_high")).drop("_least")
    aimed = stored(anchors.join(wanted, "block"), "hardnegatives")
    found = _ranked(_scored(_meeting(aimed, packed, count, "_low", "_high"), _find_negatives), ["ablock", "apos", "of"], NEGATIVES)

    chosen = positives.select("ablock", "apos", F.col("rank").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(chosen, ["ablock", "apos", "of"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
