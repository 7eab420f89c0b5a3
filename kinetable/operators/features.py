"""State and action vectors from a feature config."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetable.functions.vectors import conversion, vector_slice

IMAGE_AXES = ["height", "width", "channels"]
PATH_KEYS = ("path", "h5_path", "json_path", "topic_name", "data_path")


class ConfigError(ValueError):
    """The feature config cannot be used."""


def _need(node: Mapping[str, Any], key: str, where: str) -> Any:
    if not isinstance(node, Mapping) or key not in node:
        raise ConfigError(f"{where} lacks '{key}'")
    return node[key]


def _vector_parts(parts: list[Mapping[str, Any]], where: str) -> list[str]:
    names: list[str] = []
    for part in parts:
        names.extend(_need(part, "names", where))
        _need(part, "args", where)
    if len(set(names)) < len(names):
        raise ConfigError(f"{where} repeats an element name")
    return names


def validate_config(config: Mapping[str, Any]) -> None:
    """Raise ConfigError before any plan is built."""
    features = _need(config, "features", "config")
    observation = _need(features, "observation", "features")
    cameras = []
    for image in _need(observation, "images", "observation"):
        cameras.append(_need(image, "cam_name", "images"))
        _need(image, "args", "images")
    if len(set(cameras)) < len(cameras):
        raise ConfigError("images repeats a camera name")
    state = _need(observation, "state", "observation")
    _vector_parts(_need(state, "sub_state", "state"), "sub_state")
    action = _need(features, "action", "features")
    _vector_parts(_need(action, "sub_action", "action"), "sub_action")


def source_name(args: Mapping[str, Any]) -> str:
    """Path, topic or column that an entry reads."""
    for key in PATH_KEYS:
        if key in args:
            return args[key]
    raise ConfigError(f"args names no source, expected one of {PATH_KEYS}")


def concat_vector(parts: list[Mapping[str, Any]], columns: Mapping[str, Column] | None = None) -> Column:
    """Slices of the source vectors, converted where the config says so, as ARRAY<FLOAT>."""
    columns = columns or {}
    pieces = []
    for part in parts:
        args = part["args"]
        path = source_name(args)
        value = columns[path] if path in columns else F.col(path)
        if "range_from" in args and "range_to" in args:
            value = vector_slice(value, args["range_from"], args["range_to"])
        fn = conversion(part.get("convert_func"))
        pieces.append((fn(value) if fn else value).cast("array<float>"))
    return F.concat(*pieces)


def assemble_features(
    frames: DataFrame, config: Mapping[str, Any], keys: list[str], columns: Mapping[str, Column] | None = None
) -> DataFrame:
    """Keys, ``observation_state`` and ``action`` of every frame; one projection, no shuffle."""
    validate_config(config)
    features = config["features"]
    return frames.select(
        *keys,
        concat_vector(features["observation"]["state"]["sub_state"], columns).alias("observation_state"),
        concat_vector(features["action"]["sub_action"], columns).alias("action"),
    )


FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("shape", T.ArrayType(T.IntegerType())),
        T.StructField("names", T.ArrayType(T.StringType())),
    ]
)


def feature_table(
    spark, config: Mapping[str, Any], image_shapes: Mapping[str, tuple[int, int, int]] | None = None
) -> DataFrame:
    """Feature key, dtype, shape and names of images, state and action."""
    validate_config(config)
    features = config["features"]
    rows = []
    for image in features["observation"]["images"]:
        shape = list((image_shapes or {}).get(image["cam_name"], ())) or None
        rows.append((f"observation.images.{image['cam_name']}", "video", shape, IMAGE_AXES))
    for key, parts in (
        ("observation.state", features["observation"]["state"]["sub_state"]),
        ("action", features["action"]["sub_action"]),
    ):
        names = [n for part in parts for n in part["names"]]
        rows.append((key, "float32", [len(names)], names))
    return spark.createDataFrame(rows, FEATURE_SCHEMA)


def measured_widths(assembled: DataFrame) -> DataFrame:
    """(feature, min_size, max_size, frames) of the vectors that were built."""
    sizes = assembled.agg(
        F.min(F.size("observation_state")).alias("s0"),
        F.max(F.size("observation_state")).alias("s1"),
        F.min(F.size("action")).alias("a0"),
        F.max(F.size("action")).alias("a1"),
        F.count(F.lit(1)).alias("n"),
    )
    return sizes.select(
        F.inline(
            F.array(
                F.struct(F.lit("observation.state").alias("feature"), F.col("s0").alias("min_size"), F.col("s1").alias("max_size"), F.col("n").alias("frames")),
                F.struct(F.lit("action").alias("feature"), F.col("a0").alias("min_size"), F.col("a1").alias("max_size"), F.col("n").alias("frames")),
            )
        )
    )


def feature_schema(assembled: DataFrame, config: Mapping[str, Any], image_shapes=None) -> DataFrame:
    """Declared features joined with the measured vector widths; ``matches`` is null for images."""
    declared = feature_table(assembled.sparkSession, config, image_shapes)
    return declared.join(measured_widths(assembled), "feature", "left").withColumn(
        "matches", (F.col("min_size") == F.col("shape")[0]) & (F.col("max_size") == F.col("shape")[0])
    )


def nested_path(root: str | Column, path: str, schemaless: bool = False, dtype: str = "array<double>", strict: bool = False) -> Column:
    """Value at a dotted path of a STRUCT (column pruning) or of a VARIANT.

    Null where the path is missing or not of the wanted type; ``strict`` raises instead.
    """
    if schemaless:
        value = F.try_variant_get(root if isinstance(root, Column) else F.col(root), "$." + path, dtype)
    else:
        value = F.col(f"{root}.{path}") if isinstance(root, str) else root.getField(path)
    if not strict:
        return value
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"path '{path}' not found")).cast(dtype))
