"""Ordered per-group operators that survive hot groups.

A window over ``partitionBy(episode)`` puts a whole episode into one task. When one episode
(or topic) holds a large share of all rows that task is the job. The functions here look for
such groups first and cut only those into ordered slices:

* ``plan_split`` counts rows per group (map-side combined) and keeps at most
  ``MAX_HOT_GROUPS`` groups above ``hot_rows``; any group left out therefore holds less than
  one ``MAX_HOT_GROUPS``-th of all rows.
* hot groups share at most ``MAX_TOTAL_SLICES`` slices by their size. The boundaries come from a
  hash-chosen sample of the order keys. The sample only places the boundaries; every row is
  still processed.
* the window then runs over (group, slice), and one summary row per slice carries what crosses
  a boundary (a row offset, a last value, a nearest neighbour).

A split may be coarser than the groups it serves: one split of a message table by (episode) and
time serves the per-topic number, the gaps and the nearest match. Any boundaries give the same
result as long as the order starts with the split's order columns; they only balance the work.

The boundary table has at most ``MAX_HOT_GROUPS`` rows and ``MAX_TOTAL_SLICES`` keys whatever the
data, so it may be broadcast. The summary tables are joined on (group, slice), the keys the
window is already partitioned by. Rows that agree in every order column stay in one slice; give
a unique last order column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT_GROUPS = 16_384
MAX_TOTAL_SLICES = 65_536
# slices of one group: COARSE runs of at most FINE boundaries, so a row compares with COARSE + FINE
COARSE, FINE = 64, 64
MAX_SLICES = COARSE * FINE
SAMPLES_PER_SLICE = 8
DEFAULT_HOT_ROWS = 1_000_000
HOT_ROWS_CONF = "spark.kinetable.hotGroupRows"
# rows that a task sorts, about: a larger table has more partitions than the session's number
ROWS_PER_TASK = 500_000

SLICE = "_slice"
_GLOBAL = "_all"


@dataclass(frozen=True)
class Split:
    """How a table is cut: ``bounds`` is None when no group is hot; ``rows`` of the whole table, when known."""

    by: tuple[str, ...]
    order: tuple[str, ...]
    bounds: DataFrame | None = None
    rows: int | None = None

    @property
    def hot(self) -> bool:
        return self.bounds is not None


def _set_rows(df: DataFrame, hot_rows: int | None) -> int | None:
    if hot_rows is not None:
        return hot_rows
    conf = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return int(conf) if conf else None


def _same_group(by: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for name in by:
        cond = cond & F.col(name).eqNullSafe(F.col(prefix + name))
    return cond


def _prefixed(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: prefix + name for name in names})


def plan_split(
    df: DataFrame, by: Sequence[str], order: Sequence[str], hot_rows: int | None = None, stored: bool = False
) -> Split:
    """Find hot groups of ``df`` and choose slice boundaries for them (one or two small jobs).

    ``stored`` says that ``df`` is a plain projection of stored rows: its row count comes from
    the file footers, and a table that is small as a whole needs no count per group. In a large
    one a group is hot when it holds more than the fair share of a shuffle partition, so fewer
    groups than partitions can be hot. A threshold that is set counts as it is.
    """
    by, order = tuple(by), tuple(order)
    given = _set_rows(df, hot_rows)
    limit = given or DEFAULT_HOT_ROWS
    if stored:
        total = df.count()
        if total <= limit:
            return Split(by, order, rows=total)
        if given is None:
            limit = max(limit, total // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = F.col("_rows") > limit
    # a row per hot group, one for all others together
    counted = (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(is_hot.alias("_hot"), *[F.when(is_hot, F.col(name)).alias(name) for name in by])
        .agg(F.sum("_rows").alias("_rows"))
        .orderBy("_hot", F.desc("_rows"))
        .limit(MAX_HOT_GROUPS + 1)
        .collect()
    )
    hot = [row for row in counted if row["_hot"]][:MAX_HOT_GROUPS]
    total = sum(row["_rows"] for row in counted)
    if not hot:
        return Split(by, order, rows=total)
    spark = df.sparkSession
    key_fields = [df.schema[name] for name in by]
    wanted = spark.createDataFrame(
        [
            tuple(row[name] for name in by) + (max(1, row["_rows"] // (slices * SAMPLES_PER_SLICE)), slices)
            for row, slices in zip(hot, _slice_counts([row["_rows"] for row in hot], limit), strict=True)
        ],
        T.StructType(
            [T.StructField("_h_" + f.name, f.dataType) for f in key_fields]
            + [T.StructField("_step", T.LongType()), T.StructField("_slices", T.IntegerType())]
        ),
    )
    # rows are sampled, not keys: a group with few different keys is sampled like any other
    keys = df.select(*by, F.struct(*order).alias("_key"), F.xxhash64(F.monotonically_increasing_id()).alias("_hash"))

    def run(i: Column) -> Column:
        return F.floor(i * F.col("_slices") / F.size("_keys"))

    sampled = (
        keys.join(F.broadcast(wanted), _same_group(by, "_h_"))
        .where(F.pmod(F.col("_hash"), F.col("_step")) == 0)
        .groupBy(*by, "_slices")
        .agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
        # the last key of each of _slices equal runs, but for the very last
        .withColumn("_last", F.element_at("_keys", -1))
        .select(*by, F.filter("_keys", lambda x, i: (run(i + 1) > run(i)) & (x < F.col("_last"))).alias("_bounds"))
        .withColumn("_bounds", F.array_distinct("_bounds"))
    )
    key_type = T.ArrayType(sampled.schema["_bounds"].dataType.elementType)
    schema = T.StructType(
        [*key_fields, T.StructField("_coarse", key_type), T.StructField("_fine", T.ArrayType(key_type))]
    )
    rows = []
    for row in sampled.collect():
        fine = [row["_bounds"][i : i + FINE] for i in range(0, len(row["_bounds"]), FINE)]
        rows.append(tuple(row[name] for name in by) + ([part[-1] for part in fine], fine))
    # fixed on the driver, so that every later use cuts at the same keys
    return Split(by, order, spark.createDataFrame(rows, schema), total)


def _slice_counts(sizes: Sequence[int], limit: int) -> list[int]:
    """Slices per hot group: about ``limit`` rows each, together at most ``MAX_TOTAL_SLICES``."""
    counts = [min(MAX_SLICES, math.ceil(size / limit) + 1) for size in sizes]
    shrink = min(1.0, (MAX_TOTAL_SLICES - 2 * len(sizes)) / sum(counts))
    return [max(2, int(count * shrink)) for count in counts]


def slice_rows(df: DataFrame, split: Split, key: Column | None = None) -> DataFrame:
    """Add ``_slice``: 0 for ordinary groups, 1.. in key order for hot ones."""
    if not split.hot:
        return df.withColumn(SLICE, F.lit(0))
    columns = df.columns
    bounds = F.broadcast(_prefixed(split.bounds, split.by, "_h_"))
    key = F.struct(*split.order) if key is None else key
    run = F.size(F.filter("_coarse", lambda b: b < key))
    inside = F.coalesce(F.size(F.filter(F.get("_fine", run), lambda b: b < key)), F.lit(0))
    number = F.when(F.col("_coarse").isNull(), F.lit(0)).otherwise(run * FINE + F.greatest(inside, F.lit(0)) + 1)
    return df.join(bounds, _same_group(split.by, "_h_"), "left").select(*columns, number.alias(SLICE))


def _spread(df: DataFrame, keys: Sequence[str], split: Split, times: int = 1) -> DataFrame:
    """``df`` of ``times`` the rows of the split's table, by ``keys`` in so many partitions that a task sorts few rows.

    A table that the session's number of partitions is enough for is left to the window's own shuffle.
    """
    wanted = math.ceil((split.rows or 0) * times / ROWS_PER_TASK)
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(wanted, *keys)


def _join_slices(df: DataFrame, extra: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join per-slice summary columns on (by, slice), the keys the window is partitioned by."""
    keys = [*by, SLICE]
    right = _prefixed(extra, keys, "_r_")
    drop = ["_r_" + k for k in keys]
    return df.join(right, _same_group(keys, "_r_"), "left").drop(*drop)


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str,
    start: int = 0,
    split: Split | None = None,
    hot_rows: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Dense row number per group in ascending ``order``; ``by=[]`` numbers the whole table.

    A given ``split`` must group by some of ``by`` and be ordered by a prefix of ``order``.
    ``stored`` is that of ``plan_split``; stage the result of a large computation first.
    """
    if not by:
        # 0 in every row, but not a constant: joins by a constant key would become nested loops
        everything = df.withColumn(_GLOBAL, F.pmod(F.xxhash64(*order), F.lit(1)))
        return number_rows(everything, [_GLOBAL], order, name, start, None, hot_rows, stored).drop(_GLOBAL)
    split = split or plan_split(df, by, order, hot_rows, stored)
    if not split.hot:
        w = Window.partitionBy(*by).orderBy(*order)
        return _spread(df, by, split).withColumn(name, F.row_number().over(w).cast("long") + (start - 1))
    sliced = slice_rows(df, split)
    w = Window.partitionBy(*by, SLICE).orderBy(*order)
    local = _spread(sliced, [*by, SLICE], split).withColumn(name, F.row_number().over(w).cast("long") + (start - 1))
    before = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.where(F.col(SLICE) > 0)
        .groupBy(*by, SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        _join_slices(local, offsets, by)
        .withColumn(name, F.col(name) + F.coalesce(F.col("_offset"), F.lit(0)))
        .drop(SLICE, "_offset")
    )


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    source: str,
    name: str,
    split: Split | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Value of ``source`` on the row before, per group in ascending ``order``."""
    split = split or plan_split(df, by, order, hot_rows)
    if not split.hot:
        return _spread(df, by, split).withColumn(name, F.lag(source).over(Window.partitionBy(*by).orderBy(*order)))
    sliced = slice_rows(df, split)
    w = Window.partitionBy(*by, SLICE).orderBy(*order)
    local = _spread(sliced, [*by, SLICE], split).withColumn(name, F.lag(source).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    ends = (
        sliced.where(F.col(SLICE) > 0)
        .groupBy(*by, SLICE)
        .agg(F.max_by(F.struct(source), F.struct(*order)).alias("_end"))
        .select(*by, SLICE, F.lag("_end").over(Window.partitionBy(*by).orderBy(SLICE)).alias("_carry"))
    )
    return (
        _join_slices(local, ends, by)
        .withColumn(name, F.when(F.col("_first"), F.col("_carry")[source]).otherwise(F.col(name)))
        .drop(SLICE, "_first", "_carry")
    )


def neighbours(
    targets: DataFrame,
    sources: DataFrame,
    by: Sequence[str],
    key: str,
    order: str,
    carry: Sequence[str] = (),
    split: Split | None = None,
) -> DataFrame:
    """Every target row with ``_prev`` (last source key <= its key) and ``_next`` (first one after).

    Both are STRUCT(key, order, carry...) of the same group, null without such a row; equal keys
    count with their smallest ``order``. ``split`` cuts hot groups by ``key``.
    """
    stacked = targets.select(
        *by,
        F.col(key).alias("_k"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(sources.schema[order].dataType).alias("_o"),
        F.struct(*targets.columns).alias("_target"),
        F.lit(None).alias("_source"),
    ).unionByName(
        sources.select(
            *by,
            F.col(key).alias("_k"),
            F.lit(0).alias("_kind"),
            F.col(order).alias("_o"),
            F.lit(None).alias("_target"),
            F.struct(*dict.fromkeys([key, order, *carry])).alias("_source"),
        )
    )
    return stacked_neighbours(stacked, by, split).select("_target.*", "_prev", "_next")


def stacked_neighbours(stacked: DataFrame, by: Sequence[str], split: Split | None = None) -> DataFrame:
    """``neighbours`` of rows stacked already: by..., _k, _kind (1 target, 0 source), _o, _target, _source.

    One shuffle by (by, slice). One running window in ascending and one in descending key order
    find the two neighbours; both frames end at the current row, so the cost per group is a sort.
    Target rows come back with ``_prev`` and ``_next``.
    """
    groups = [*by]
    hot = bool(split and split.hot)
    if hot:
        stacked = slice_rows(stacked, split, F.struct(F.col("_k").alias(split.order[0])))
        groups.append(SLICE)
    running = (Window.unboundedPreceding, Window.currentRow)
    asc = Window.partitionBy(*groups).orderBy("_k", "_kind", F.desc("_o")).rowsBetween(*running)
    desc = Window.partitionBy(*groups).orderBy(F.desc("_k"), F.desc("_kind"), F.desc("_o")).rowsBetween(*running)
    # a row may stand here as a source and as a target
    spread = stacked if split is None else _spread(stacked, groups, split, 2)
    around = spread.withColumn("_prev", F.last("_source", ignorenulls=True).over(asc)).withColumn(
        "_next", F.last("_source", ignorenulls=True).over(desc)
    )
    around = around.where(F.col("_kind") == 1)
    if not hot:
        return around
    edges = (
        stacked.where(F.col(SLICE) > 0)
        .groupBy(*by, SLICE)
        .agg(
            F.max_by("_source", F.when(F.col("_kind") == 0, F.struct("_k", -F.col("_o")))).alias("_end"),
            F.min_by("_source", F.when(F.col("_kind") == 0, F.struct("_k", "_o"))).alias("_start"),
        )
    )
    earlier = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*by).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        *by,
        SLICE,
        F.last("_end", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_start", ignorenulls=True).over(later).alias("_after"),
    )
    return (
        _join_slices(around, edges, by)
        .withColumn("_prev", F.coalesce("_prev", "_before"))
        .withColumn("_next", F.coalesce("_next", "_after"))
    )


def closer(position: Column, key: str) -> Column:
    """The nearer of ``_prev`` and ``_next``; equal distance takes the earlier."""
    prev_gap = position - F.col("_prev")[key]
    next_gap = F.col("_next")[key] - position
    return F.when(
        F.col("_next").isNull() | (F.col("_prev").isNotNull() & (prev_gap <= next_gap)), F.col("_prev")
    ).otherwise(F.col("_next"))


def nearest_match(
    targets: DataFrame,
    sources: DataFrame,
    by: Sequence[str],
    key: str,
    order: str,
    carry: Sequence[str] = (),
    prefix: str = "src_",
    split: Split | None = None,
) -> DataFrame:
    """For each target row the source row of the same group whose ``key`` is closest.

    Equal distance prefers the smaller key, equal keys the smaller ``order``. Every target row is
    kept.
    """
    around = neighbours(targets, sources, by, key, order, carry, split)
    source_cols = [key, order, *[c for c in carry if c not in (key, order)]]
    return around.select(*targets.columns, closer(F.col(key), key).alias("_hit")).select(
        *targets.columns, *[F.col("_hit")[c].alias(prefix + c) for c in source_cols]
    )
