"""Recordings to training frames: align, gather the configured topics, build the vectors."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.operators.align import AlignPreset, align
from kinetable.operators.features import assemble_features, source_name, validate_config
from kinetable.operators.frames import offset_action
from kinetable.operators.ordered import Split
from kinetable.operators.timing import EPISODE, TOPIC, split_messages


def config_topics(config: Mapping[str, Any]) -> tuple[dict[str, str], list[str]]:
    """Camera name -> topic, and the vector topics of state and action."""
    validate_config(config)
    features = config["features"]
    cameras = {i["cam_name"]: source_name(i["args"]) for i in features["observation"]["images"]}
    parts = [*features["observation"]["state"]["sub_state"], *features["action"]["sub_action"]]
    return cameras, list(dict.fromkeys(source_name(p["args"]) for p in parts))


def gather_topics(aligned: DataFrame, cameras: Mapping[str, str], topics: list[str], vector: str) -> DataFrame:
    """One row per (episode, frame): a vector per topic and the source message per camera.

    A frame lacking one of the topics is left out. The key includes the frame, so a long episode
    spreads over all tasks.
    """

    def of(topic: str, value: Column) -> Column:
        return F.any_value(F.when(F.col(TOPIC) == topic, value), F.lit(True))

    columns = [of(topic, F.col(vector)).alias(_column(i)) for i, topic in enumerate(topics)]
    images = [of(topic, F.struct("src_seq", "src_ts_ns")).alias(_image(cam)) for cam, topic in cameras.items()]
    complete = F.lit(True)
    for i in range(len(topics)):
        complete = complete & F.col(_column(i)).isNotNull()
    for cam in cameras:
        complete = complete & F.col(_image(cam)).isNotNull()
    return aligned.groupBy(EPISODE, "frame_index").agg(*columns, *images).where(complete)


def _column(i: int) -> str:
    return f"_topic_{i}"


def _image(camera: str) -> str:
    return f"image_{camera}"


def convert_recordings(
    messages: DataFrame,
    config: Mapping[str, Any],
    preset: str | AlignPreset = "production",
    vector: str = "vector",
    split: Split | None = None,
) -> DataFrame:
    """Frames of aligned recordings: episode_id, frame_index, observation_state, action, image_<camera>.

    ``messages`` carry a vector per message (see ``flatten_typed``); an image column names the
    message the picture comes from. A ``timeline_offset`` of the action section takes the action
    of a later frame and drops the last ones.
    """
    cameras, topics = config_topics(config)
    split = split or split_messages(messages)
    aligned = align(messages, preset, carry=[vector], split=split, topics=[*topics, *cameras.values()])
    gathered = gather_topics(aligned, cameras, topics, vector)
    columns = {topic: F.col(_column(i)) for i, topic in enumerate(topics)}
    frames = assemble_features(gathered, config, [EPISODE, "frame_index", *[_image(c) for c in cameras]], columns)
    offset = config["features"]["action"].get("timeline_offset", 0)
    if not offset:
        return frames
    renamed = frames.withColumnRenamed(EPISODE, "episode_index")
    # frames of an episode are as many as its base messages, so the split of the messages tells a hot one
    later = offset_action(renamed, offset, split=split)
    return later.drop("action").withColumnsRenamed({"offset_action": "action", "episode_index": EPISODE})
