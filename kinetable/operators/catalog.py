"""Catalogue writes and work queries.

A write takes the current table and the changes and returns the new table: one union and one
aggregate on the key, so repeated changes of one key are combined before the shuffle. With a
table format that has MERGE the same change set can be given to ``DataFrame.mergeInto``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.operators.ordered import number_rows
from kinetable.session import staged

# fixed values: conversion states
PENDING, PROCESSING, COMPLETED, FAILED = "pending", "processing", "completed", "failed"
TASK_SUCCESS = "success"
LEVEL_COLUMNS = [f"level{i}" for i in range(1, 6)]


def upsert(target: DataFrame, changes: DataFrame, key: str, order: Sequence[str] = (), keep_if_null: Sequence[str] = ()) -> DataFrame:
    """Insert or replace rows of ``target`` by ``key``; the last change by ``order`` wins.

    Columns in ``keep_if_null`` keep their last value that is not null. Columns that the changes
    do not have keep the value of the target.
    """
    columns = [c for c in target.columns if c != key]
    changed = [c for c in columns if c in changes.columns]
    nulls = [F.lit(None).alias(o) for o in order]
    old = target.select(key, *columns, F.lit(0).alias("_new"), F.struct(F.lit(0).alias("_v"), *nulls).alias("_rank"))
    new = changes.select(
        key,
        *[F.col(c) if c in changed else F.lit(None).alias(c) for c in columns],
        F.lit(1).alias("_new"),
        F.struct(F.lit(1).alias("_v"), *[F.col(o).alias(o) for o in order]).alias("_rank"),
    )
    rank = F.col("_rank")
    # one maximum for all columns that change together, one for those only the target has
    together = [c for c in changed if c not in keep_if_null]
    only_old = [c for c in columns if c not in changed]
    merged = [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in changed if c in keep_if_null]
    if together:
        merged.append(F.max_by(F.struct(*together), rank).alias("_changed"))
    if only_old:
        merged.append(F.max_by(F.struct(*only_old), F.when(F.col("_new") == 0, rank)).alias("_old"))
    where = {c: F.col("_changed")[c] for c in together} | {c: F.col("_old")[c] for c in only_old}
    grouped = old.unionByName(new).groupBy(key).agg(*merged) if merged else old.unionByName(new).select(key).distinct()
    return grouped.select(*[where[c].alias(c) if c in where else F.col(c) for c in target.columns])


def status_upsert(target: DataFrame, events: DataFrame, key: str = "dataset_uuid", order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Latest status per dataset; message and path keep their last value that is not null."""
    return upsert(target, events, key, order, keep_if_null=["update_message", "convert_path"])


def result_status(result: Column) -> Column:
    return F.when(result == TASK_SUCCESS, COMPLETED).otherwise(FAILED)


def get_or_create(existing: DataFrame, values: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """Existing (id, value) rows plus an id for every new distinct value, in value order."""
    fresh = values.select(value_col).where(F.col(value_col).isNotNull()).distinct().join(existing, value_col, "left_anti")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    numbered = number_rows(staged(fresh, "new-values"), [], [value_col], "_no", start=1, stored=True)
    return existing.select(id_col, value_col).unionByName(
        numbered.select((F.col("_no") + top).cast(existing.schema[id_col].dataType).alias(id_col), value_col)
    )


def upsert_objects(existing: DataFrame, objects: DataFrame, order: Sequence[str]) -> DataFrame:
    """Object dimension: new names get an id, the levels come from the last record of the name."""
    ids = get_or_create(existing.select("object_id", "object_name"), objects, "object_id", "object_name")
    old = existing.select("object_name", *LEVEL_COLUMNS)
    return ids.join(upsert(old, objects.select("object_name", *LEVEL_COLUMNS, *order), "object_name", order), "object_name").select(
        "object_id", "object_name", *LEVEL_COLUMNS
    )


def replace_links(links: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Bridge rows: those of touched keys are replaced, the others stay."""
    touched = fresh.select(key).distinct()
    kept = links.join(touched, key, "left_anti")
    return kept.unionByName(fresh.where(F.forall(F.array(*[F.col(c).isNotNull() for c in fresh.columns]), lambda x: x)).select(*links.columns).distinct())


def upsert_datasets(target: DataFrame, records: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Dataset table by ``dataset_uuid``; a list of device models counts with its first element."""
    if records.schema["device_model"].dataType.typeName() == "array":
        records = records.withColumn("device_model", F.get("device_model", F.lit(0)))
    return upsert(target, records, "dataset_uuid", order)


def pending(datasets: DataFrame, status: DataFrame, device_model: str | None = None, key: str = "dataset_uuid") -> DataFrame:
    """Datasets without a conversion record, optionally of one device model."""
    wanted = datasets.where(F.col("device_model") == device_model) if device_model else datasets
    return wanted.join(status.select(key), key, "left_anti")


def match_configs(datasets: DataFrame, configs: DataFrame, on: str = "device_model") -> DataFrame:
    """Datasets with the converter of their device model; ``matched`` says whether there is one."""
    found = datasets.join(configs.withColumn("matched", F.lit(True)), on, "left")
    return found.withColumn("matched", F.coalesce("matched", F.lit(False)))


def output_names(model: Column, name: Column, root: str, platform: str) -> dict[str, Column]:
    """Output folder and lower-case repository id of a dataset."""
    joined = F.concat_ws("_", model, name)
    return {
        "output_path": F.concat(F.lit(root.rstrip("/") + "/"), joined),
        "repo_id": F.concat(F.lit(platform + "/"), F.lower(joined)),
        "log_name": F.lower(joined),
    }


def changed_since(current: DataFrame, history: DataFrame, key: str, commit: str) -> DataFrame:
    """Rows without history or with another commit id than last time."""
    past = history.select(key, F.col(commit).alias("_past"))
    return current.join(past, key, "left").where(
        F.col("_past").isNull() | (F.col("_past") == "") | (F.col("_past") != F.col(commit))
    ).drop("_past")


def invalid_frame_lists(datasets: DataFrame, lists: DataFrame, key: str, column: str = "episode_frames_num") -> DataFrame:
    """Datasets whose frame list is missing or empty."""
    return datasets.join(lists.select(key, column), key, "left").where(F.col(column).isNull() | (F.size(column) == 0)).drop(column)


def skip_existing(datasets: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Datasets that have no output yet."""
    return datasets.join(outputs.select(key), key, "left_anti")


def filter_device(datasets: DataFrame, model: str = "") -> DataFrame:
    """Datasets whose first device model is ``model``; the empty text means all."""
    return datasets.where(F.get("device_model", F.lit(0)) == model) if model else datasets


def violations(table: DataFrame, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = ()) -> DataFrame:
    """(rule, columns, value, rows) of broken uniqueness and not-null rules.

    Null keys do not collide, as in a relational unique constraint.
    """
    parts = []
    for columns in unique:
        keyed = table.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        parts.append(
            keyed.select(
                F.lit("unique").alias("rule"),
                F.lit(",".join(columns)).alias("columns"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("value"),
                "rows",
            )
        )
    if not_null:
        counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        entries = F.array(*[F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("columns"), F.lit(None).cast("string").alias("value"), F.col(c).alias("rows")) for c in not_null])
        parts.append(counts.select(F.inline(entries)).where("rows > 0"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge_info(records: DataFrame, defaults: Mapping[str, Column], tags: DataFrame, name: str = "dataset_name") -> DataFrame:
    """Generated fields over template defaults, with the tags of the same name (empty without)."""
    joined = records.join(tags.select(name, "dataset_tags"), name, "left")
    filled = {c: F.coalesce(F.col(c), default) if c in records.columns else default for c, default in defaults.items()}
    empty = F.create_map().cast("map<string,array<string>>")
    return joined.withColumns(filled | {"dataset_tags": F.coalesce(F.col("dataset_tags"), empty)})


#: bits of a Bloom filter per key, and at most; a longer one would weigh more than what it saves
BITS_PER_KEY, MAX_BITS = 12, 1 << 26
PROBES = 4


def key_filter(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """One row with ``words ARRAY<LONG>``: a Bloom filter of ``bits`` bits over the keys, made by Spark.

    Bits are set by grouping on their word, so the keys stay where they are; the row has
    ``bits / 64`` numbers whatever the keys.
    """
    places = F.explode(F.array(*[_place(columns, i, bits) for i in range(PROBES)])).alias("_place")
    words = keys.select(places).groupBy(F.floor(F.col("_place") / 64).cast("int").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_place % 64 AS INT))")).alias("_bits"))
    entries = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda i: F.coalesce(F.try_element_at("_entries", i), F.lit(0).cast("bigint")))
    return words.agg(entries.alias("_entries")).select(filled.alias("words"))


def _place(columns: Sequence[str], probe: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe), *columns), F.lit(bits))


def may_contain(words: Column, columns: Sequence[str], bits: int) -> Column:
    """False only for keys that are not in the filter."""
    hit = F.lit(True)
    for i in range(PROBES):
        place = _place(columns, i, bits)
        hit = hit & (F.getbit(F.get(words, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1)
    return hit


def batch_violations(batch: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rule, columns, value, rows) of keys of ``batch`` that, with those of ``table``, occur more than once.

    What ``violations`` finds over both for the keys of the batch, without shuffling the table: a Bloom
    filter of the batch's keys lets through few rows of the table but those that are in the batch,
    and these are counted exactly. The filter is read by a scalar subquery and bounded by MAX_BITS;
    beyond that it lets more through, and the result is the same. Null keys do not collide. The batch
    is read twice.
    """
    keys = batch.select(*columns).dropna(subset=list(columns))
    bits = 1 << max(10, min(MAX_BITS, max(1, keys.count()) * BITS_PER_KEY).bit_length() - 1)
    words = key_filter(keys.distinct(), columns, bits).scalar()
    old = table.select(*columns).dropna(subset=list(columns)).where(may_contain(words, columns, bits))
    both = keys.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
    counted = both.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"), F.sum("_new").alias("_new")).where("rows > 1 AND _new > 0")
    value = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return counted.select(F.lit("unique").alias("rule"), F.lit(",".join(columns)).alias("columns"), value.alias("value"), "rows")
