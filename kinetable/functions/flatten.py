"""Nested messages to vectors and to named numeric columns, driven by the schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

XYZ = ("x", "y", "z")
XYZW = ("x", "y", "z", "w")


def _has(schema: T.DataType, *path: str) -> bool:
    for name in path:
        if not isinstance(schema, T.StructType) or name not in schema.fieldNames():
            return False
        schema = schema[name].dataType
    return True


def _doubles(col: Column, names: tuple[str, ...]) -> list[Column]:
    return [col[n].cast("double") for n in names]


def flatten_typed(payload: Column, schema: T.StructType) -> Column:
    """Vector of a message by the first shape that is present.

    Order: joint state, IMU, twist, numeric array, pose (also with covariance), position,
    scalar. Image messages are not vectors and give null.
    """
    empty = F.lit(None).cast("array<double>")
    tests: list[tuple[Column, Column]] = []
    if _has(schema, "height") and _has(schema, "width"):
        tests.append((payload["height"].isNotNull() & payload["width"].isNotNull(), empty))
    if _has(schema, "format"):
        tests.append((payload["format"].isNotNull(), empty))
    joint = _has(schema, "name") and _has(schema, "position") and isinstance(schema["position"].dataType, T.ArrayType)
    if joint:
        tests.append((payload["name"].isNotNull() & payload["position"].isNotNull(), payload["position"].cast("array<double>")))
    if _has(schema, "linear_acceleration") and _has(schema, "angular_velocity"):
        a, g = payload["linear_acceleration"], payload["angular_velocity"]
        tests.append((a.isNotNull() & g.isNotNull(), F.array(*_doubles(a, XYZ), *_doubles(g, XYZ))))
    if _has(schema, "twist", "linear"):
        lin, ang = payload["twist"]["linear"], payload["twist"]["angular"]
        tests.append((lin.isNotNull(), F.array(*_doubles(lin, XYZ), *_doubles(ang, XYZ))))
    array_data = _has(schema, "data") and isinstance(schema["data"].dataType, T.ArrayType)
    if array_data:
        tests.append((payload["data"].isNotNull(), payload["data"].cast("array<double>")))
    for path in (("pose", "pose"), ("pose",)):
        if _has(schema, *path, "position"):
            pose = payload
            for name in path:
                pose = pose[name]
            values = F.array(*_doubles(pose["position"], XYZ), *_doubles(pose["orientation"], XYZW))
            tests.append((pose.isNotNull(), values))
    if _has(schema, "position", "x"):
        tests.append((payload["position"].isNotNull(), F.array(*_doubles(payload["position"], XYZ))))
    for name in ("data", "scalar"):
        if _has(schema, name) and isinstance(schema[name].dataType, T.NumericType):
            tests.append((payload[name].isNotNull(), F.array(payload[name].cast("double"))))
    if not tests:
        return empty
    out: Column | None = None
    for present, value in tests:
        out = F.when(present, value) if out is None else out.when(present, value)
    return out.otherwise(empty)


def imu_columns(payload: Column, with_orientation: bool = True) -> dict[str, Column]:
    out = {f"accel_{a}": payload["linear_acceleration"][a] for a in XYZ}
    out |= {f"gyro_{a}": payload["angular_velocity"][a] for a in XYZ}
    if with_orientation:
        out |= {f"orient_{a}": payload["orientation"][a] for a in XYZW}
    return out


def pose_columns(payload: Column) -> dict[str, Column]:
    out = {f"pos_{a}": payload["pose"]["position"][a] for a in XYZ}
    return out | {f"orient_{a}": payload["pose"]["orientation"][a] for a in XYZW}


def twist_columns(payload: Column) -> dict[str, Column]:
    out = {f"linear_{a}": payload["twist"]["linear"][a] for a in XYZ}
    return out | {f"angular_{a}": payload["twist"]["angular"][a] for a in XYZ}


def joint_names(messages: DataFrame, payload: str = "payload") -> list[str]:
    """Sorted joint names that occur: a robot's joints, a short list whatever the number of messages."""
    names = messages.select(F.explode(F.col(payload)["name"]).alias("name")).distinct().orderBy("name")
    return [r["name"] for r in names.collect()]


def joint_columns(payload: Column, joints: list[str]) -> dict[str, Column]:
    """``<joint>_position/_velocity/_effort``; null where the message lacks the joint.

    ``joints`` are the wanted ones; ``joint_names`` finds all that occur.
    """
    out = {}
    for joint in joints:
        at = F.array_position(payload["name"], joint).cast("int")
        for source in ("position", "velocity", "effort"):
            # try_element_at: position may be longer than velocity or effort
            out[f"{joint}_{source}"] = F.when(at > 0, F.try_element_at(payload[source], F.greatest(at, F.lit(1))))
    return out


def numeric_values(payload: Column, schema: T.StructType, prefix: str = "") -> Column:
    """ARRAY<STRUCT(name, value)> of every numeric or boolean leaf that is not null, arrays of any length.

    Names are joined by ``_``, the place in an array is appended. Fields come in name order.
    """
    parts: list[Column] = []
    for field in sorted(schema.fields, key=lambda f: f.name):
        name, value, kind = f"{prefix}{field.name}", payload[field.name], field.dataType
        if isinstance(kind, T.NumericType | T.BooleanType):
            parts.append(F.array(F.struct(F.lit(name).alias("name"), _number(value, kind).alias("value"))))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType | T.BooleanType):
            named = F.transform(value, _element(name, kind.elementType))
            parts.append(F.coalesce(named, F.array().cast("array<struct<name:string,value:double>>")))
        elif isinstance(kind, T.StructType):
            parts.append(numeric_values(value, kind, f"{name}_"))
    if not parts:
        return F.array().cast("array<struct<name:string,value:double>>")
    return F.filter(F.concat(*parts), lambda leaf: leaf["value"].isNotNull())


def _element(name: str, kind: T.DataType) -> Callable[[Column, Column], Column]:
    return lambda x, i: F.struct(F.concat(F.lit(name + "_"), i.cast("string")).alias("name"), _number(x, kind).alias("value"))


def _number(value: Column, kind: T.DataType) -> Column:
    return (value.cast("int") if isinstance(kind, T.BooleanType) else value).cast("double")


def numeric_leaves(payload: Column, schema: T.StructType, array_size: int, prefix: str = "") -> dict[str, Column]:
    """Every numeric or boolean leaf as a named column, names joined by ``_``, array index appended.

    Fields come in name order. ``array_size`` columns are made per array; a longer array is an error.
    Use ``numeric_values`` where the sizes are not known.
    """
    out: dict[str, Column] = {}
    for field in sorted(schema.fields, key=lambda f: f.name):
        name = f"{prefix}{field.name}"
        value = payload[field.name]
        kind = field.dataType
        if isinstance(kind, T.NumericType | T.BooleanType):
            out[name] = value
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType | T.BooleanType):
            too_long = F.raise_error(F.lit(f"{name} has more than {array_size} elements")).cast(kind.elementType)
            for i in range(array_size):
                out[f"{name}_{i}"] = F.when(F.size(value) > array_size, too_long).otherwise(F.get(value, F.lit(i)))
        elif isinstance(kind, T.StructType):
            out |= numeric_leaves(value, kind, array_size, f"{name}_")
    return out
