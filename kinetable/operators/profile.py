"""Profiles of topics and of JSON metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.operators.ordered import number_rows
from kinetable.operators.timing import EPISODE, TOPIC, TS

# fixed values: words that give a topic its role
IMAGE_WORDS = ["camera", "image"]
SENSOR_WORDS = ["imu", "feedback", "joint", "state", "pose"]
CONTROL_WORDS = ["control", "target", "command", "cmd"]
# fixed values: the shorter lists of the export summary
SUMMARY_SENSOR_WORDS = ["imu", "feedback", "joint"]
SUMMARY_CONTROL_WORDS = ["control", "target", "command"]
# fixed values: proposed joint names and range of a state topic
PROPOSED_JOINTS = ["joint_1", "joint_2", "joint_3", "joint_4", "joint_5", "joint_6", "joint_7"]

VALUE_CHARS = 100


def _any_word(name: Column, words: Sequence[str]) -> Column:
    return name.rlike("|".join(words))


def topic_roles(topic: Column) -> Column:
    """Roles of a topic; they overlap. The image test is case-sensitive, the others are not."""
    lower = F.lower(topic)
    return F.array_compact(
        F.array(
            F.when(_any_word(topic, IMAGE_WORDS), "image"),
            F.when(_any_word(lower, SENSOR_WORDS), "sensor"),
            F.when(_any_word(lower, CONTROL_WORDS), "control"),
        )
    )


def topic_inventory(messages: DataFrame, msgtype: str | None = None) -> DataFrame:
    """Per topic: messages, mean per file, files and the type seen first.

    Counted per (file, topic) first, so the second step sees one row per file.
    """
    first_type = F.min_by(msgtype, TS) if msgtype else F.lit(None).cast("string")
    per_file = messages.groupBy(EPISODE, TOPIC).agg(
        F.count(F.lit(1)).alias("_n"), F.min(TS).alias("_ts"), first_type.alias("_type")
    )
    return per_file.groupBy(TOPIC).agg(
        F.sum("_n").alias("total_messages"),
        F.avg("_n").alias("avg_per_file"),
        F.count(F.lit(1)).alias("files"),
        F.min_by("_type", F.struct("_ts", EPISODE)).alias("msgtype"),
    )


def topic_frequency(messages: DataFrame) -> DataFrame:
    """Messages per second of the whole recording, 0 for a recording of no duration."""
    per_topic = messages.groupBy(EPISODE, TOPIC).agg(
        F.count(F.lit(1)).alias("n"), F.min(TS).alias("_lo"), F.max(TS).alias("_hi")
    )
    recording = per_topic.groupBy(EPISODE).agg((F.max("_hi") - F.min("_lo")).alias("duration_ns"))
    return per_topic.join(recording, EPISODE).select(
        EPISODE,
        TOPIC,
        "n",
        "duration_ns",
        F.when(F.col("duration_ns") > 0, F.col("n") / F.col("duration_ns") * F.lit(1e9)).otherwise(0.0).alias("frequency_hz"),
    )


def export_summary(messages: DataFrame) -> DataFrame:
    """Totals of an export: topics, messages, topics per role by the shorter word lists."""
    per_topic = messages.groupBy(TOPIC).agg(F.count(F.lit(1)).alias("_n"))
    lower = F.lower(F.col(TOPIC))
    return per_topic.agg(
        F.count(F.lit(1)).alias("total_topics"),
        F.sum("_n").alias("total_messages"),
        F.count_if(_any_word(F.col(TOPIC), IMAGE_WORDS)).alias("image_topics"),
        F.count_if(_any_word(lower, SUMMARY_SENSOR_WORDS)).alias("sensor_topics"),
        F.count_if(_any_word(lower, SUMMARY_CONTROL_WORDS)).alias("control_topics"),
    )


def common_keys(files: DataFrame, content: str = "content", order: str = "path") -> DataFrame:
    """Keys that every JSON file has, with the value of the first file cut to 100 characters."""
    values = F.try_variant_get(F.try_parse_json(content), F.lit("$"), "map<string,string>")

    def cut(value: Column) -> Column:
        return F.when(F.length(value) > VALUE_CHARS, F.concat(F.substring(value, 1, VALUE_CHARS), F.lit("..."))).otherwise(value)

    # values are cut before the rows multiply: a document is never repeated per key
    parsed = files.select(order, F.json_object_keys(content).alias("_keys"), values.alias("_values"))
    pairs = F.transform("_keys", lambda k: F.struct(k.alias("key"), cut(F.col("_values")[k]).alias("value")))
    per_key = parsed.select(order, F.inline(pairs)).groupBy("key").agg(F.count(F.lit(1)).alias("files"), F.min_by("value", order).alias("sample"))
    total = files.agg(F.count(F.lit(1))).scalar()
    return per_key.where(F.col("files") == total).select("key", "files", "sample")


def key_intersection(left: DataFrame, right: DataFrame, content: str = "content") -> DataFrame:
    """Keys that occur in both inputs.

    One aggregate over both sides: keys are combined before the shuffle, so what a task holds grows
    with the number of different keys and not with the files that have them.
    """

    def keys(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(F.explode(F.json_object_keys(content)).alias("key"), F.lit(is_left).alias("_left"))

    sides = keys(left, True).unionByName(keys(right, False)).groupBy("key").agg(F.bool_or("_left").alias("_in_left"), F.bool_and("_left").alias("_only_left"))
    return sides.where("_in_left AND NOT _only_left").select("key")


def union_topics(recordings: Sequence[DataFrame]) -> DataFrame:
    """Distinct topics over all recordings, sorted."""
    parts = [r.select(TOPIC) for r in recordings]
    return reduce(DataFrame.unionByName, parts).distinct().orderBy(TOPIC)


def first_rows(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """First n rows, of the table or per group; both forms cut before the shuffle."""
    if not by:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def _kind_rules(name: Column, kind: Column) -> dict[str, tuple[Column, Column]]:
    """(image test, state test) of each rule set, on the lower-case topic and on the type."""
    lower = F.lower(kind)
    joint = name.contains("joint")
    image = kind.contains("Image") | name.contains("image")
    return {
        "dataset": (image, kind.contains("JointState") | joint),
        "inspect": (image, lower.contains("joint") | joint | name.contains("state")),
        "by_type": (lower.contains("image") | lower.contains("compressed"), lower.contains("joint") | joint),
    }


def propose_features(topics: DataFrame, msgtype: str = "msgtype", rule: str = "dataset") -> DataFrame:
    """Feature config proposed from topics (topic, msgtype): cameras numbered, joint topics with ranges.

    The input is one row per topic. ``rule`` chooses the tests of image and state topics:
    ``dataset``, ``inspect`` or ``by_type``. The image test comes first.
    """
    lower = F.lower(F.col(TOPIC))
    image, joint = _kind_rules(lower, F.col(msgtype))[rule]
    kinds = topics.withColumn("kind", F.when(image, "image").when(joint, "state")).where("kind IS NOT NULL")
    side = (
        F.when(lower.contains("left"), "_left").when(lower.contains("right"), "_right").when(lower.contains("head"), "_head").otherwise("")
    )
    is_image = F.col("kind") == "image"
    joints = F.array(*[F.lit(j) for j in PROPOSED_JOINTS])
    return number_rows(kinds, ["kind"], [TOPIC], "_no", start=1).select(
        "kind",
        TOPIC,
        F.when(is_image, F.concat(F.lit("cam_"), F.col("_no"), side)).alias("cam_name"),
        F.when(~is_image, joints).alias("names"),
        F.when(~is_image, 0).alias("range_from"),
        F.when(~is_image, len(PROPOSED_JOINTS)).alias("range_to"),
    )


def mark_rejects(records: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add ``reject_reason``: the required fields that are null, or null for a good record."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return records.withColumn(
        "reject_reason", F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
    )
