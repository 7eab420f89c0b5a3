"""Bring the topics of an episode to one timeline: by truncation or by nearest timestamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split, closer, stacked_neighbours
from kinetable.operators.timing import EPISODE, SEQ, TOPIC, TS, select_base_topic, split_messages, topic_timing
from kinetable.session import staged


@dataclass(frozen=True)
class AlignPreset:
    """Tolerances and limits of one way to align."""

    truncate: bool
    max_diff_ms: float
    warn_diff_ms: float
    min_quality: float = 0.8
    base_topic: str | None = None


# fixed values: tolerance and quality limits of the three presets
PRESETS = {
    "emergency": AlignPreset(truncate=True, max_diff_ms=1000.0, warn_diff_ms=500.0),
    "production": AlignPreset(truncate=False, max_diff_ms=50.0, warn_diff_ms=20.0, min_quality=0.9),
    "robot": AlignPreset(truncate=False, max_diff_ms=30.0, warn_diff_ms=15.0, min_quality=0.85),
}


def topic_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy(EPISODE, TOPIC).agg(F.count(F.lit(1)).alias("n"))


def truncation_loss(messages: DataFrame) -> DataFrame:
    """Per topic: messages, kept and lost when all topics are cut to the shortest."""
    counts = topic_counts(messages)
    shortest = counts.groupBy(EPISODE).agg(F.min("n").alias("kept"))
    return counts.join(shortest, EPISODE).select(EPISODE, TOPIC, "n", "kept", (F.col("n") - F.col("kept")).alias("lost"))


def align_truncate(messages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """First ``min count`` messages of every topic; seq is dense, so no window is needed."""
    shortest = topic_counts(messages).groupBy(EPISODE).agg(F.min("n").alias("_keep"))
    return (
        messages.join(shortest, EPISODE)
        .where(F.col(SEQ) < F.col("_keep"))
        .select(EPISODE, TOPIC, F.col(SEQ).alias("frame_index"), F.col(SEQ).alias("src_seq"), F.col(TS).alias("src_ts_ns"), *carry)
    )


def align_nearest(
    messages: DataFrame,
    base: str | DataFrame | None = None,
    max_diff_ms: float = 50.0,
    warn_diff_ms: float = 20.0,
    carry: Sequence[str] = (),
    split: Split | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """For every base-topic message the closest message of each other topic of the episode.

    ``base`` is a topic name, a table (episode, base_topic) or None for the best scored topic.
    Base rows map to themselves. Rows beyond the tolerance stay and are flagged.

    Messages are read once for the base topic and once here: every row is a source, a base row is
    also one target per topic of its episode, and all of them go through one shuffle together
    with the ``carry`` payload. ``topics`` names those wanted in the result: the base topic is still
    chosen among all, but messages of other topics do not go through the shuffle.
    """
    messages = messages.select(EPISODE, TOPIC, SEQ, TS, *carry)
    split = split or split_messages(messages)
    if isinstance(base, DataFrame):
        present = messages.groupBy(EPISODE).agg(F.collect_set(TOPIC).alias("topics"))
        chosen = base.select(EPISODE, "base_topic").join(present, EPISODE)
    else:
        chosen = select_base_topic(topic_timing(messages, split), base)
    targets = F.col("topics") if topics is None else F.array_intersect("topics", F.array(*[F.lit(t) for t in topics]))
    chosen = chosen.select(EPISODE, F.col("base_topic").alias(TOPIC), targets.alias("topics"))
    wanted = F.lit(True) if topics is None else F.col(TOPIC).isin(list(topics))
    payload = [F.col(c) for c in carry]

    def row(topic: Column, kind: int, target: Column, source: Column) -> Column:
        order = F.col(SEQ) if kind == 0 else F.lit(None).cast("long")
        return F.struct(
            topic.alias(TOPIC), F.lit(kind).alias("_kind"), order.alias("_o"), target.alias("_target"), source.alias("_source")
        )

    def target_struct(topic: Column) -> Column:
        own = F.struct(F.col(TS).alias(TS), F.col(SEQ).alias(SEQ), *payload)
        return F.struct(F.col(SEQ).alias("frame_index"), F.when(topic == F.col(TOPIC), own).alias("own"))

    own_type = f"struct<frame_index: bigint, own: {_struct_type(messages, [TS, SEQ, *carry])}>"
    source_type = _struct_type(messages, [TS, SEQ, *carry])
    as_source = row(F.col(TOPIC), 0, F.lit(None).cast(own_type), F.struct(TS, SEQ, *payload))
    as_targets = F.transform("topics", lambda t: row(t, 1, target_struct(t), F.lit(None).cast(source_type)))
    sources = F.when(wanted, F.array(as_source)).otherwise(F.array().cast(f"array<{_row_type(own_type, source_type)}>"))
    stacked = messages.join(chosen, [EPISODE, TOPIC], "left").select(
        EPISODE,
        F.col(TS).alias("_k"),
        F.explode(F.when(F.col("topics").isNull(), sources).otherwise(F.concat(sources, as_targets))).alias("_r"),
    )
    around = stacked_neighbours(stacked.select(EPISODE, "_k", "_r.*"), [EPISODE, TOPIC], split)
    own = F.col("_target.own")
    matched = around.select(
        EPISODE,
        TOPIC,
        F.col("_target.frame_index").alias("frame_index"),
        F.col("_k").alias("base_ts_ns"),
        own.isNotNull().alias("is_base"),
        F.coalesce(own, closer(F.col("_k"), TS)).alias("_hit"),
    )
    diff_ms = F.abs(F.col("src_ts_ns") - F.col("base_ts_ns")) / F.lit(1e6)
    return matched.select(
        EPISODE,
        TOPIC,
        "frame_index",
        "base_ts_ns",
        F.col("_hit")[SEQ].alias("src_seq"),
        F.col("_hit")[TS].alias("src_ts_ns"),
        "is_base",
        *[F.col("_hit")[c].alias(c) for c in carry],
    ).select(
        EPISODE,
        TOPIC,
        "frame_index",
        "base_ts_ns",
        "src_seq",
        "src_ts_ns",
        diff_ms.alias("time_diff_ms"),
        ((diff_ms > warn_diff_ms) & (diff_ms <= max_diff_ms)).alias("over_warn"),
        (diff_ms > max_diff_ms).alias("over_max"),
        "is_base",
        *carry,
    )


def _row_type(target_type: str, source_type: str) -> str:
    return f"struct<{TOPIC}: string, _kind: int, _o: bigint, _target: {target_type}, _source: {source_type}>"


def _struct_type(df: DataFrame, columns: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in columns) + ">"


def align_quality(aligned: DataFrame, max_diff_ms: float = 50.0, min_quality: float = 0.8) -> DataFrame:
    """Per topic mean distance, quality and rows over the limits; base topics count as 1."""
    mean = F.sum(F.abs(F.col("src_ts_ns") - F.col("base_ts_ns"))) / F.count(F.lit(1)) / F.lit(1e6)
    return (
        aligned.groupBy(EPISODE, TOPIC)
        .agg(
            F.count(F.lit(1)).alias("frames"),
            mean.alias("mean_diff_ms"),
            F.when(F.bool_and("is_base"), 1.0)
            .otherwise(F.greatest(F.lit(0.0), 1 - mean / F.lit(max_diff_ms)))
            .alias("quality"),
            F.count_if("over_warn").alias("warn_rows"),
            F.count_if("over_max").alias("max_rows"),
        )
        .withColumn("low_quality", F.col("quality") < min_quality)
    )


def episode_align_quality(quality: DataFrame) -> DataFrame:
    return quality.groupBy(EPISODE).agg(
        F.avg("quality").alias("avg_quality"), F.count_if("low_quality").alias("low_topics")
    )


def align(
    messages: DataFrame,
    preset: str | AlignPreset = "production",
    carry: Sequence[str] = (),
    drop_low_quality: bool = False,
    split: Split | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """Align by preset: (episode, topic, frame_index, src_seq, src_ts_ns, carry...).

    ``topics`` keeps those in the result; base topic and shortest length are still those of all.
    """
    config = PRESETS[preset] if isinstance(preset, str) else preset
    if config.truncate:
        out = align_truncate(messages, carry)
        return out if topics is None else out.where(F.col(TOPIC).isin(list(topics)))
    if drop_low_quality and topics is not None:
        # the quality counts every topic, so all of them are aligned
        every = align(messages, config, carry, True, split)
        return every.where(F.col(TOPIC).isin(list(topics)))
    aligned = align_nearest(messages, config.base_topic, config.max_diff_ms, config.warn_diff_ms, carry, split, topics)
    if drop_low_quality:
        good = episode_align_quality(align_quality(aligned, config.max_diff_ms, config.min_quality)).where(
            F.col("avg_quality") >= config.min_quality
        )
        aligned = aligned.join(good.select(EPISODE), EPISODE, "left_semi")
    return aligned.select(EPISODE, TOPIC, "frame_index", "src_seq", "src_ts_ns", *carry)


def align_presets(messages: DataFrame, presets: Mapping[str, bool], carry: Sequence[str] = (), split: Split | None = None) -> DataFrame:
    """Rows of ``align`` for several presets, with the name in ``preset``.

    ``presets`` says for each whether episodes of low quality go. The nearest match does not
    depend on tolerances: it runs once per base topic and is staged, the presets only judge it.
    """
    matches: dict[str | None, DataFrame] = {}
    parts = []
    columns = [EPISODE, TOPIC, "frame_index", "src_seq", "src_ts_ns", *carry]
    for name, drop_low_quality in presets.items():
        config = PRESETS[name]
        if config.truncate:
            rows = align_truncate(messages, carry)
        else:
            if config.base_topic not in matches:
                matched = align_nearest(messages, config.base_topic, config.max_diff_ms, config.warn_diff_ms, carry, split)
                matches[config.base_topic] = staged(matched, "matches")
            rows = matches[config.base_topic]
            if drop_low_quality:
                quality = episode_align_quality(align_quality(rows, config.max_diff_ms, config.min_quality))
                rows = rows.join(quality.where(F.col("avg_quality") >= config.min_quality).select(EPISODE), EPISODE, "left_semi")
        parts.append(rows.select(*columns, F.lit(name).alias("preset")))
    return reduce(DataFrame.unionByName, parts)
