"""Episode and dataset statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.functions.names import natural_key
from kinetable.operators.ordered import number_rows
from kinetable.session import staged

DATASET, EPISODE, FRAMES = "dataset_id", "episode", "n_frames"

# episodes per list, the chunk size of the stored layout
LIST_CHUNK = 1000
# fixed values: upper limits and labels of the size classes
SIZE_LIMITS = [
    (10**3, "<1K"),
    (10**4, "1K-10K"),
    (10**5, "10K-100K"),
    (10**6, "100K-1M"),
    (10**7, "1M-10M"),
    (10**8, "10M-100M"),
    (10**9, "100M-1B"),
    (10**10, "1B-10B"),
    (10**11, "10B-100B"),
    (10**12, "100B-1T"),
]
LARGEST = ">1T"
# fixed values: labels that do not count as sub-tasks
IGNORED_SUBTASKS = ["end", "abnormal"]


def size_label(count: Column) -> Column:
    """Class of a frame count."""
    label: Column | None = None
    for limit, text in SIZE_LIMITS:
        label = F.when(count < limit, text) if label is None else label.when(count < limit, text)
    return label.otherwise(LARGEST)


def frames_by_rowcount(rows: DataFrame, dataset: str = DATASET, episode: str = EPISODE) -> DataFrame:
    """Frames of an episode = its rows."""
    return rows.groupBy(F.col(dataset).alias(DATASET), F.col(episode).alias(EPISODE)).agg(F.count(F.lit(1)).alias(FRAMES))


def frames_by_arraysize(episodes: DataFrame, data: str = "data", dataset: str = DATASET, episode: str = EPISODE) -> tuple[DataFrame, DataFrame]:
    """Frames of an episode = length of its array; unreadable episodes go to the second table."""
    keyed = episodes.withColumnsRenamed({dataset: DATASET, episode: EPISODE})
    good = keyed.where(F.col(data).isNotNull()).select(DATASET, EPISODE, F.size(data).cast("long").alias(FRAMES))
    return good, keyed.where(F.col(data).isNull()).select(DATASET, EPISODE)


def frames_by_topic(messages: DataFrame, topic: str, dataset: Column, episode: str = "episode_id") -> DataFrame:
    """Frames of an episode = messages of one topic; the filter reaches the scan."""
    return (
        messages.where(F.col("topic") == topic)
        .groupBy(dataset.alias(DATASET), F.col(episode).alias(EPISODE))
        .agg(F.count(F.lit(1)).alias(FRAMES))
    )


def frames_by_meta(episodes: DataFrame, dataset: str = DATASET, episode: str = "episode_index", length: str = "length") -> DataFrame:
    """Frames of an episode as its metadata states."""
    return episodes.select(F.col(dataset).alias(DATASET), F.col(episode).alias(EPISODE), F.col(length).cast("long").alias(FRAMES))


def frame_lists(counts: DataFrame, chunk: int | None = LIST_CHUNK) -> DataFrame:
    """Ordered frame counts per dataset, as lists of ``chunk`` episodes with totals.

    One row per (dataset, chunk) keeps every list short however many episodes a dataset has.
    ``chunk=None`` gives one list per dataset, for datasets known to be of moderate size.
    """
    if chunk is None:
        keyed, keys = counts.withColumn("_at", F.col(EPISODE)), [DATASET]
    else:
        # one small row per episode out of a scan of all frames: staged, so the frames are read once
        numbered = number_rows(staged(counts, "frame-counts"), [DATASET], [EPISODE], "_at", stored=True)
        keyed = numbered.withColumn("chunk", F.floor(F.col("_at") / chunk))
        keys = [DATASET, "chunk"]
    return keyed.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", FRAMES))), lambda x: x[FRAMES]).alias("episode_frames_num"),
        F.count(F.lit(1)).alias("episodes_in_list"),
        F.sum(FRAMES).alias("frames_in_list"),
    )


def dataset_frame_lists(
    registry: DataFrame,
    layouts: Mapping[str, str],
    counters: Mapping[str, DataFrame],
    device_model: str = "device_model",
    chunk: int | None = LIST_CHUNK,
) -> DataFrame:
    """Attach the frame lists to each registry record; its device model chooses the layout.

    ``layouts`` maps device model -> layout, ``counters`` layout -> (dataset_id, episode, n_frames).
    A record has one row per chunk of its list, with the chunk's figures and the totals of the
    record. Records of an unmapped model keep an empty list.
    """
    by_layout: dict[str, list[str]] = {}
    for model, layout in layouts.items():
        by_layout.setdefault(layout, []).append(model)
    routed = registry.select(DATASET, F.col(device_model).alias("_model"))
    parts = []
    for layout, models in by_layout.items():
        chosen = routed.where(F.col("_model").isin(models)).select(DATASET)
        counted = counters[layout].join(chosen, DATASET, "left_semi")
        # layouts name their episodes by number or by path: one natural order serves both
        parts.append(counted.select(DATASET, natural_key(F.col(EPISODE).cast("string")).alias(EPISODE), FRAMES))
    lists = frame_lists(reduce(DataFrame.unionByName, parts), chunk)
    # one row per chunk of some hundred episodes: staged, it is summed without counting again
    lists = staged(lists, "frame-lists")
    totals = lists.groupBy(DATASET).agg(F.sum("episodes_in_list").alias("episodes_num"), F.sum("frames_in_list").alias("frames_num"))
    return registry.join(lists.join(totals, DATASET), DATASET, "left").withColumn(
        "episode_frames_num", F.coalesce("episode_frames_num", F.array().cast("array<bigint>"))
    )


def dataset_totals(frames: DataFrame, episode_tasks: DataFrame, task_text: Column) -> DataFrame:
    """Episodes, frames and task text (in task order) per dataset.

    Frames are counted per episode first; tasks are joined to that small table. An episode
    without a task counts in both totals and adds no text.
    """
    lengths = frames.groupBy(DATASET, "episode_index").agg(F.count(F.lit(1)).alias("_n"))
    per_task = lengths.join(episode_tasks, "episode_index", "left").groupBy(DATASET, "task_index").agg(
        F.count(F.lit(1)).alias("_episodes"), F.sum("_n").alias("_frames")
    )
    return (
        per_task.withColumn("_text", task_text)
        .groupBy(DATASET)
        .agg(
            F.sum("_episodes").alias("episodes_num"),
            F.sum("_frames").alias("frames_num"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.when(F.col("task_index").isNotNull(), F.struct("task_index", "_text")))),
                    lambda x: x["_text"],
                ),
                "\n",
            ).alias("tasks"),
        )
    )


def subtasks(annotations: DataFrame, key: str, path: str = "annotation", ignored: Sequence[str] = tuple(IGNORED_SUBTASKS)) -> DataFrame:
    """Distinct labels of ``annotation.videoLabels[].timelinelabels[]`` per dataset, sorted, one per line."""
    labels = (
        annotations.select(key, F.explode(f"{path}.videoLabels").alias("_v"))
        .select(key, F.explode("_v.timelinelabels").alias("_label"))
        .where(~F.col("_label").isin(list(ignored)))
    )
    return distinct_text(labels, key, "_label", "sub_tasks", "\n")


def distinct_text(rows: DataFrame, key: str, value: str, name: str, separator: str) -> DataFrame:
    """Sorted distinct values per key as one text; duplicates are removed before the grouping."""
    return rows.select(key, value).distinct().groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(value)), separator).alias(name))


def device_list(records: DataFrame, models: str = "device_model") -> DataFrame:
    """Distinct device models over all records of a list-valued field."""
    return records.select(F.explode(models).alias("device_model")).distinct()
