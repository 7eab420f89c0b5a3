"""Listings and the JSON, JSONL, YAML and CSV files of a dataset."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetable.sources import walk

#: characters of one batch of texts
TEXT_BATCH = 8 << 20
CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of all files below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def _with_path(df: DataFrame) -> DataFrame:
    return df.select("*", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"))


FRAME_JSON = T.StructType(
    [
        T.StructField(
            part,
            T.StructType(
                [
                    T.StructField(limb, T.StructType([T.StructField("qpos", T.ArrayType(T.DoubleType()))]))
                    for limb in ("left_arm", "right_arm", "left_hand", "right_hand")
                ]
            ),
        )
        for part in ("states", "actions")
    ]
)


def read_json_episodes(
    spark: SparkSession, paths: str | list[str], frame: T.DataType = FRAME_JSON, pattern: str = "*.json"
) -> DataFrame:
    """(path, data ARRAY<frame>) per episode file; ``data`` is null for an unreadable file."""
    schema = T.StructType([T.StructField("data", T.ArrayType(frame)), T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", CORRUPT)
    raw = _with_path(reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(paths))
    return raw.select("path", F.when(F.col(CORRUPT).isNull(), F.col("data")).alias("data"))


def json_frames(episodes: DataFrame) -> DataFrame:
    """One row per frame of the readable episodes: path, frame_index and the frame's fields."""
    return episodes.select("path", F.posexplode("data").alias("frame_index", "frame")).select("path", "frame_index", "frame.*")


EPISODES_SCHEMA = "episode_index LONG, tasks ARRAY<STRING>, length LONG"
TASKS_SCHEMA = "task_index LONG, task STRING"


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, pattern: str = "*.jsonl") -> DataFrame:
    """Lines of JSONL metadata with their file; blank lines are skipped, a broken line is an error."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true")
    return _with_path(reader.option("pathGlobFilter", pattern).json(paths))


_VIDEO_INFO = "STRUCT<`video.fps`: DOUBLE, `video.height`: INT, `video.width`: INT, `video.channels`: INT, `video.codec`: STRING, `video.pix_fmt`: STRING, `video.is_depth_map`: BOOLEAN, has_audio: BOOLEAN>"
INFO_SCHEMA = (
    "codebase_version STRING, robot_type STRING, total_episodes LONG, total_frames LONG, total_tasks LONG, total_videos LONG, "
    "total_chunks LONG, chunks_size LONG, fps DOUBLE, splits MAP<STRING, STRING>, data_path STRING, video_path STRING, "
    f"features MAP<STRING, STRUCT<dtype: STRING, shape: ARRAY<INT>, names: ARRAY<STRING>, name: ARRAY<STRING>, info: {_VIDEO_INFO}>>"
)
DEVICE_SCHEMA = (
    "device_list ARRAY<STRUCT<device_id: STRING, device_type: STRING, device_type_info: STRING, "
    "device_info: MAP<STRING, STRUCT<type: STRING, dimension: MAP<STRING, STRING>, description: MAP<STRING, STRING>>>>>"
)
CAMERA_SCHEMA = (
    "device_list ARRAY<STRUCT<device_id: STRING, calibration_info: STRUCT<version: STRING, date: STRING, source: STRING, "
    "reprojection_error: DOUBLE>, camera_intrinsics: MAP<STRING, STRUCT<model: STRING, parameters: STRUCT<width: INT, height: INT, "
    "fx: DOUBLE, fy: DOUBLE, cx: DOUBLE, cy: DOUBLE>, distortion: STRUCT<model: STRING, k1: DOUBLE, k2: DOUBLE, k3: DOUBLE, "
    "p1: DOUBLE, p2: DOUBLE>>>>>"
)


def read_json_documents(spark: SparkSession, paths: str | list[str], schema: str, pattern: str = "*.json") -> DataFrame:
    """One row per JSON file."""
    reader = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST")
    return _with_path(reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(paths))


def info_features(info: DataFrame) -> DataFrame:
    """Feature rows of info files; element names are spelled ``names`` or ``name``."""
    rows = info.select("path", F.explode("features").alias("feature", "f"))
    return rows.select("path", "feature", "f.dtype", "f.shape", F.coalesce("f.names", "f.name").alias("names"), "f.info")


def device_joints(devices: DataFrame) -> DataFrame:
    """(path, device_id, device_type, part, part_type, joint, unit, description); parts without joints have one row."""
    parts = devices.select("path", F.explode("device_list").alias("d")).select(
        "path", "d.device_id", "d.device_type", F.explode("d.device_info").alias("part", "p")
    )
    return parts.select(
        "path", "device_id", "device_type", "part", F.col("p.type").alias("part_type"), F.col("p.description").alias("_text"), F.explode_outer("p.dimension").alias("joint", "unit")
    ).select(
        "path", "device_id", "device_type", "part", "part_type", "joint", "unit", F.when(F.col("joint").isNotNull(), F.col("_text")[F.col("joint")]).alias("description")
    )


def camera_intrinsics(cameras: DataFrame) -> DataFrame:
    """One row per calibrated camera."""
    rows = cameras.select("path", F.explode("device_list").alias("d")).select(
        "path", "d.device_id", F.col("d.calibration_info").alias("c"), F.explode("d.camera_intrinsics").alias("camera", "i")
    )
    return rows.select(
        "path",
        "device_id",
        "camera",
        "i.model",
        "i.parameters.*",
        F.col("i.distortion.model").alias("distortion_model"),
        *[F.col(f"i.distortion.{k}").alias(k) for k in ("k1", "k2", "k3", "p1", "p2")],
        "c.reprojection_error",
    )


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("dataset_uuid", T.StringType()),
        T.StructField("task_descriptions", T.ArrayType(T.StringType())),
        T.StructField("scene_type", T.ArrayType(T.StringType())),
        T.StructField("atomic_actions", T.ArrayType(T.StringType())),
        T.StructField("objects", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("operation_platform_height", T.DoubleType()),
        T.StructField("device_model", T.ArrayType(T.StringType())),
        T.StructField("end_effector_type", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)
REQUIRED_RECORD_FIELDS = ("dataset_name", "dataset_uuid")


def _texts(value) -> list[str] | None:
    if value is None:
        return None
    return [None if v is None else str(v) for v in value] if isinstance(value, list) else [str(value)]


def _number(value) -> float | None:
    try:
        return None if value is None else float(value)
    except (TypeError, ValueError):
        return None


def _object_map(entry) -> dict[str, str | None]:
    items = entry.items() if isinstance(entry, dict) else [(entry, None)]
    return {str(k): None if v is None else str(v) for k, v in items}


def _registry_row(path: str, text: str) -> dict:
    import yaml

    row = dict.fromkeys(REGISTRY_SCHEMA.fieldNames())
    row["path"] = path
    try:
        record = yaml.safe_load(text)
    except yaml.YAMLError as exc:
        return row | {"reject_reason": f"not YAML: {type(exc).__name__}"}
    if not record:
        return row | {"reject_reason": "empty"}
    if not isinstance(record, dict):
        return row | {"reject_reason": "not a mapping"}
    for name in ("dataset_name", "dataset_uuid", "end_effector_type"):
        row[name] = None if record.get(name) is None else str(record[name])
    for name in ("task_descriptions", "scene_type", "atomic_actions", "device_model"):
        row[name] = _texts(record.get(name))
    objects = record.get("objects")
    row["objects"] = [_object_map(o) for o in objects if o is not None] if isinstance(objects, list) else None
    # the files spell the key this way
    row["operation_platform_height"] = _number(record.get("operation_platform_heigth"))
    missing = [f for f in REQUIRED_RECORD_FIELDS if record.get(f) is None]
    if missing:
        row["reject_reason"] = "missing " + ", ".join(missing)
    return row


def _parse_registry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = REGISTRY_SCHEMA.fieldNames()
    for batch in batches:
        rows = [_registry_row(p, v) for p, v in zip(batch["path"], batch["value"], strict=True)]
        yield pd.DataFrame([[r[n] for n in names] for r in rows], columns=names)


def parse_registry(texts: DataFrame) -> DataFrame:
    """Registry records of YAML texts (path, value); ``reject_reason`` is set for refused files.

    Store the result before splitting it by the reason, else the files are parsed once per part.
    """
    return texts.select("path", "value").mapInPandas(_parse_registry, REGISTRY_SCHEMA)


def _hidden(name: str) -> bool:
    """Whether Spark's readers leave out what is named so."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(path: str) -> Iterator[walk.Entry]:
    """``walk.list_directory`` with links followed, without hidden names."""
    for name, below, size in walk.list_directory(path):
        if _hidden(name.rsplit("/", 1)[1]):
            continue
        if "://" not in name and os.path.islink(name):
            below, size = os.path.isdir(name), os.path.getsize(name)
        yield name, below, size


def _read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(held: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names=["path", "value"])

    for given in batches:
        held, size = [], 0
        for path in given.column(0).to_pylist():
            system, inner = walk.located(path)
            with system.open_input_stream(inner) as file:
                value = file.read().decode()
            # as Spark's file metadata spells it
            spelt = re.sub(r"[^A-Za-z0-9/_.!~'()*,;:$&+=@\x80-\U0010ffff-]", lambda m: f"%{ord(m[0]):02X}", path)
            held.append((spelt, value))
            size += len(value)
            if size >= TEXT_BATCH:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)


def read_texts(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, value) of whole text files below ``paths``: folders, files or patterns.

    Folders are listed and files read in tasks, dealt evenly, so many small ones cost neither a task each
    nor a place in the driver. Hidden and empty files are left out, as Spark's readers do.
    """
    folders, single = [], []
    for given in [paths] if isinstance(paths, str) else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(given)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if not found:
            raise FileNotFoundError(f"no such path: {given}")
        for status in found:
            name = re.sub("^file:/+", "/", status.getPath().toString())
            if status.isDirectory():
                folders.append(name)
            elif not _hidden(name.rsplit("/", 1)[1]):
                single.append((name, status.getLen()))
    listing = spark.createDataFrame(single, "path STRING, length LONG")
    if folders:
        listing = listing.unionByName(walk.walk(spark, folders, lister=_entries).select("path", "length"))
    if len(folders) + len(single) > 1:
        # a place that is given twice counts once
        listing = listing.dropDuplicates(["path"])
    wanted = listing.where("length > 0")
    if pattern is not None:
        shape = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
        wanted = wanted.where(walk.file_name(F.col("path")).rlike(f"(?s)^(?:{shape})$"))
    return wanted.repartition(walk.tasks(spark), "path").select("path").mapInArrow(_read_texts, "path STRING, value STRING")


def read_registry(spark: SparkSession, paths: str | list[str], pattern: str = "*.y*ml") -> DataFrame:
    """``parse_registry`` of many YAML files."""
    return parse_registry(read_texts(spark, paths, pattern))


TAG_COLUMNS = ("address_nas", "tags")


def read_tag_csv(spark: SparkSession, paths: str | list[str], required: Sequence[str] = TAG_COLUMNS) -> DataFrame:
    """Tag CSV with quoted line breaks: rows with an address; short rows are skipped.

    Raises when a required column is missing, and when a file has other columns or another order
    than the first: columns are never taken by place.
    """

    def reader():
        return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')

    columns = reader().csv(paths).columns
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"CSV lacks the columns {missing}")
    fields = [T.StructField(c, T.StringType()) for c in columns] + [T.StructField(CORRUPT, T.StringType())]
    rows = reader().option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", "false").schema(T.StructType(fields)).csv(paths)
    last = columns[max(columns.index(c) for c in required)]
    short = F.col(CORRUPT).isNotNull() & F.col(last).isNull()
    address = F.trim(F.col(TAG_COLUMNS[0]))
    return rows.where(~short & address.isNotNull() & (address != "")).select(
        address.alias("address_nas"), F.trim(F.coalesce("tags", F.lit(""))).alias("tags")
    )
