"""Queries of the vector, feature and message-flattening operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.functions import flatten as fl
from kinetable.functions import vectors as vec
from kinetable.operators import features as ft
from kinetable.plans.registry import Tables, query, r6


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


VEC = "vec_v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _elements(value: Column, n: int, name: str = "v") -> list[Column]:
    return [r6(value[i]).alias(f"{name}{i}") for i in range(n)]


def _sql_elements(expr: str, n: int, name: str = "v") -> str:
    return ", ".join(f"round({expr}[{i + 1}], 6) + 0.0 AS {name}{i}" for i in range(n))


@query("vector_slice", f"WITH {VEC} SELECT vec_id, len(v[61:70]) AS n, len(v[1:len(v)-1]) AS but_last, v[len(v)-2] AS third_last, len(v[len(v)-2:len(v)-1]) AS two, {_sql_elements('v[4:10]', 7)} FROM vec_v")
def _slice(t: Tables) -> DataFrame:
    df = vectors(t)
    short = F.size(vec.vector_slice(F.col("v"), 60, 70)).cast("long").alias("n")
    two = vec.vector_slice(F.col("v"), -3, -1)
    negative = [F.size(vec.vector_slice(F.col("v"), 0, -1)).cast("long").alias("but_last"), F.get(two, F.lit(0)).alias("third_last"), F.size(two).cast("long").alias("two")]
    return df.withColumn("s", vec.vector_slice(F.col("v"), 3, 10)).select("vec_id", short, *negative, *_elements(F.col("s"), 7))


@query(
    "unit_convert",
    f"""WITH {VEC} SELECT vec_id, round(v[1] / 100, 6) + 0.0 AS cm0, round(v[1] / 1000, 6) + 0.0 AS mm0,
 {_sql_elements('list_transform(v[1:3], lambda x: radians(x))', 3, 'rad')} FROM vec_v""",
)
def _units(t: Tables) -> DataFrame:
    v = F.col("v")
    return vectors(t).select(
        "vec_id",
        r6(vec.cm_to_m(v)[0]).alias("cm0"),
        r6(vec.mm_to_m(v)[0]).alias("mm0"),
        *_elements(vec.degree_to_rad(vec.vector_slice(v, 0, 3)), 3, "rad"),
    )


def _quat_sql(x: str, y: str, z: str, w: str) -> str:
    return f"""q AS (SELECT vec_id, {x}/n AS x, {y}/n AS y, {z}/n AS z, {w}/n AS w FROM (
  SELECT *, sqrt(v[1]*v[1] + v[2]*v[2] + v[3]*v[3] + v[4]*v[4]) AS n FROM vec_v))"""


_EULER = """round(atan2(2*(y*z + w*x), 1 - 2*(x*x + y*y)), 6) + 0.0 AS {p}roll,
 round(asin(greatest(-1.0, least(1.0, 2*(w*y - x*z)))), 6) + 0.0 AS {p}pitch,
 round(atan2(2*(x*y + w*z), 1 - 2*(y*y + z*z)), 6) + 0.0 AS {p}yaw"""


@query(
    "quat_to_euler",
    f"""WITH {VEC}, {_quat_sql('v[1]', 'v[2]', 'v[3]', 'v[4]')}, {_quat_sql('v[2]', 'v[3]', 'v[4]', 'v[1]').replace('q AS', 'u AS', 1)},
a AS (SELECT vec_id, {_EULER.format(p='xyzw_')} FROM q), b AS (SELECT vec_id, {_EULER.format(p='wxyz_')} FROM u)
SELECT * FROM a JOIN b USING (vec_id)""",
)
def _quat(t: Tables) -> DataFrame:
    q = vec.vector_slice(F.col("v"), 0, 4)
    both = vectors(t).select("vec_id", vec.quat_xyzw_to_euler(q).alias("a"), vec.quat_wxyz_to_euler(q).alias("b"))
    names = ["roll", "pitch", "yaw"]
    return both.select(
        "vec_id",
        *[r6(F.col("a")[i]).alias("xyzw_" + n) for i, n in enumerate(names)],
        *[r6(F.col("b")[i]).alias("wxyz_" + n) for i, n in enumerate(names)],
    )


_ROT = f"""{VEC},
r1 AS (SELECT vec_id, v, sqrt(v[1]*v[1] + v[2]*v[2] + v[3]*v[3]) AS n FROM vec_v),
r2 AS (SELECT *, v[1]/n AS x1, v[2]/n AS x2, v[3]/n AS x3 FROM r1),
r3 AS (SELECT *, v[4]*x1 + v[5]*x2 + v[6]*x3 AS d FROM r2),
r4 AS (SELECT *, v[4] - d*x1 AS p1, v[5] - d*x2 AS p2, v[6] - d*x3 AS p3 FROM r3),
r5 AS (SELECT *, sqrt(p1*p1 + p2*p2 + p3*p3) AS m FROM r4),
r6 AS (SELECT *, p1/m AS y1, p2/m AS y2, p3/m AS y3 FROM r5),
rot AS (SELECT *, x2*y3 - x3*y2 AS z1, x3*y1 - x1*y3 AS z2, x1*y2 - x2*y1 AS z3 FROM r6)"""


@query(
    "rot6d_to_matrix",
    f"WITH {_ROT} SELECT vec_id, "
    + ", ".join(f"round({a}{i}, 6) + 0.0 AS m{i}{j}" for i in (1, 2, 3) for j, a in ((1, "x"), (2, "y"), (3, "z")))
    + " FROM rot",
)
def _matrix(t: Tables) -> DataFrame:
    m = vectors(t).select("vec_id", vec.rot6d_to_matrix(F.col("v")).alias("m"))
    return m.select("vec_id", *[r6(F.col("m")[i][j]).alias(f"m{i + 1}{j + 1}") for i in range(3) for j in range(3)])


@query(
    "rot6d_to_euler",
    f"""WITH {_ROT} SELECT vec_id, round(atan2(y3, z3), 6) + 0.0 AS roll, round(asin(-x3), 6) + 0.0 AS pitch,
 round(atan2(x2, x1), 6) + 0.0 AS yaw FROM rot""",
)
def _rot_euler(t: Tables) -> DataFrame:
    e = vectors(t).select("vec_id", vec.rot6d_to_euler(F.col("v")).alias("e"))
    return e.select("vec_id", *[r6(F.col("e")[i]).alias(n) for i, n in enumerate(["roll", "pitch", "yaw"])])


def arm_config() -> dict:
    """Feature config over a vector column ``v``: pose with rotation, joints in degrees."""
    return {
        "fps": 30,
        "features": {
            "observation": {
                "images": [{"cam_name": "cam_high", "args": {"path": "cam_high"}}],
                "state": {
                    "sub_state": [
                        {"names": ["grip_m"], "args": {"path": "v", "range_from": 13, "range_to": 14}, "convert_func": "mm2m"},
                        {
                            "names": ["roll", "pitch", "yaw"],
                            "args": {"path": "v", "range_from": 0, "range_to": 6},
                            "convert_func": "rot6d_to_euler_xyz",
                        },
                        {
                            "names": [f"joint_{i}" for i in range(1, 8)],
                            "args": {"path": "v", "range_from": 6, "range_to": 13},
                            "convert_func": "degree2rad",
                        },
                    ]
                },
            },
            "action": {
                "sub_action": [
                    {"names": ["a", "b"], "args": {"path": "v", "range_from": 20, "range_to": 22}},
                    {"names": ["c"], "args": {"path": "v", "range_from": 30, "range_to": 31}, "convert_func": "not_registered"},
                ]
            },
        },
    }


@query(
    "vector_concat",
    f"""WITH {_ROT} SELECT vec_id, 11 AS state_size, round(CAST(v[14] / 1000 AS FLOAT)::DOUBLE, 5) + 0.0 AS s0,
 round(CAST(atan2(y3, z3) AS FLOAT)::DOUBLE, 5) + 0.0 AS s1, round(CAST(asin(-x3) AS FLOAT)::DOUBLE, 5) + 0.0 AS s2,
 round(CAST(atan2(x2, x1) AS FLOAT)::DOUBLE, 5) + 0.0 AS s3,
 {', '.join(f'round(CAST(radians(v[{7 + i}]) AS FLOAT)::DOUBLE, 5) + 0.0 AS s{4 + i}' for i in range(7))},
 round(CAST(v[21] AS FLOAT)::DOUBLE, 5) + 0.0 AS a0, round(CAST(v[22] AS FLOAT)::DOUBLE, 5) + 0.0 AS a1,
 round(CAST(v[31] AS FLOAT)::DOUBLE, 5) + 0.0 AS a2 FROM rot""",
)
def _concat(t: Tables) -> DataFrame:
    built = ft.assemble_features(vectors(t), arm_config(), ["vec_id"])
    return built.select(
        "vec_id",
        F.size("observation_state").alias("state_size"),
        *[r6(F.col("observation_state")[i], 5).alias(f"s{i}") for i in range(11)],
        *[r6(F.col("action")[i], 5).alias(f"a{i}") for i in range(3)],
    )


@query(
    "custom_conversion",
    f"WITH {VEC} SELECT vec_id, round(CAST(v[1] * 10 AS FLOAT)::DOUBLE, 5) + 0.0 AS s0, round(CAST(v[2] AS FLOAT)::DOUBLE, 5) + 0.0 AS s1 FROM vec_v",
)
def _custom(t: Tables) -> DataFrame:
    vec.register_conversion("tenfold", lambda v: F.transform(v, lambda x: x * 10))
    parts = [
        {"names": ["p"], "args": {"path": "v", "range_from": 0, "range_to": 1}, "convert_func": "tenfold"},
        {"names": ["q"], "args": {"path": "v", "range_from": 1, "range_to": 2}, "convert_func": "nobody_knows"},
    ]
    built = vectors(t).select("vec_id", ft.concat_vector(parts).alias("s"))
    return built.select("vec_id", *[r6(F.col("s")[i], 5).alias(f"s{i}") for i in range(2)])


@query(
    "feature_schema",
    """WITH n AS (SELECT count(*) AS frames FROM embeddings WHERE len(embedding) = 64)
SELECT 'observation.images.cam_high' AS feature, 'video' AS dtype, '480,640,3' AS shape, 'height,width,channels' AS names,
  CAST(NULL AS BIGINT) AS frames, CAST(NULL AS BOOLEAN) AS matches
UNION ALL SELECT 'observation.state', 'float32', '11', 'grip_m,roll,pitch,yaw,joint_1,joint_2,joint_3,joint_4,joint_5,joint_6,joint_7', frames, true FROM n
UNION ALL SELECT 'action', 'float32', '3', 'a,b,c', frames, true FROM n""",
)
def _schema(t: Tables) -> DataFrame:
    built = ft.assemble_features(vectors(t), arm_config(), ["vec_id"])
    table = ft.feature_schema(built, arm_config(), {"cam_high": (480, 640, 3)})
    return table.select(
        "feature",
        "dtype",
        F.array_join(F.col("shape").cast("array<string>"), ",").alias("shape"),
        F.array_join("names", ",").alias("names"),
        "frames",
        "matches",
    )


@query(
    "nested_path",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def _nested(t: Tables) -> DataFrame:
    parsed = t.events.select("event_id", F.parse_json("props").alias("p"))
    return parsed.select(
        "event_id",
        ft.nested_path("p", "k", schemaless=True, dtype="bigint").alias("k"),
        ft.nested_path("p", "states.left_arm", schemaless=True, dtype="string").alias("missing"),
    )


MSG_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_XYZ = "named_struct('x', {0}, 'y', {1}, 'z', {2})"


def typed_messages(t: Tables) -> DataFrame:
    """Line items as messages of four types; the parts of other types are null."""
    q, p, d, x = "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    kind = "l_linenumber % 4"
    payload = f"""named_struct(
      'name', CASE WHEN {kind} = 0 THEN array('j1', 'j2') END,
      'position', CASE WHEN {kind} = 0 THEN array({q}, {p}) END,
      'velocity', CASE WHEN {kind} = 0 THEN array({d}, {x}) END,
      'effort', CASE WHEN {kind} = 0 THEN array({x}) END,
      'linear_acceleration', CASE WHEN {kind} = 1 THEN {_XYZ.format(q, p, d)} END,
      'angular_velocity', CASE WHEN {kind} = 1 THEN {_XYZ.format(x, q, p)} END,
      'orientation', CASE WHEN {kind} = 1 THEN named_struct('x', {d}, 'y', {x}, 'z', {q}, 'w', {p}) END,
      'twist', CASE WHEN {kind} = 2 THEN named_struct('linear', {_XYZ.format(q, p, d)}, 'angular', {_XYZ.format(x, q, p)}) END,
      'pose', CASE WHEN {kind} = 3 THEN named_struct('position', {_XYZ.format(q, p, d)},
         'orientation', named_struct('x', {x}, 'y', {q}, 'z', {p}, 'w', {d})) END,
      'frame_id', l_returnflag, 'dense', l_discount > 0.05)"""
    return t.lineitem.select(*MSG_KEYS, F.expr(payload).alias("payload"))


def _payload_schema(df: DataFrame):
    return df.schema["payload"].dataType


_KEYS = ", ".join(MSG_KEYS)


@query(
    "flatten_typed",
    f"""SELECT {_KEYS}, CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 6 ELSE 7 END AS size,
 l_quantity AS v0, l_extendedprice AS v1, CASE WHEN l_linenumber % 4 > 0 THEN l_discount END AS v2,
 CASE WHEN l_linenumber % 4 > 0 THEN l_tax END AS v3, CASE WHEN l_linenumber % 4 > 0 THEN l_quantity END AS v4,
 CASE WHEN l_linenumber % 4 > 0 THEN l_extendedprice END AS v5, CASE WHEN l_linenumber % 4 = 3 THEN l_discount END AS v6 FROM lineitem""",
)
def _flat_typed(t: Tables) -> DataFrame:
    df = typed_messages(t)
    flat = df.select(*MSG_KEYS, fl.flatten_typed(F.col("payload"), _payload_schema(df)).alias("v"))
    return flat.select(*MSG_KEYS, F.size("v").alias("size"), *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(7)])


def _when(kind: int, expr: str, name: str) -> str:
    return f"CASE WHEN l_linenumber % 4 = {kind} THEN {expr} END AS {name}"


# (kind of message, value, column)
FLAT_COLUMNS = [
    (0, "l_quantity", "j1_position"),
    (0, "l_discount", "j1_velocity"),
    (0, "l_tax", "j1_effort"),
    (0, "l_extendedprice", "j2_position"),
    (0, "l_tax", "j2_velocity"),
    (0, "CAST(NULL AS DOUBLE)", "j2_effort"),
    (1, "l_quantity", "accel_x"),
    (1, "l_extendedprice", "accel_y"),
    (1, "l_discount", "accel_z"),
    (1, "l_tax", "gyro_x"),
    (1, "l_quantity", "gyro_y"),
    (1, "l_extendedprice", "gyro_z"),
    (1, "l_discount", "orient_x"),
    (1, "l_tax", "orient_y"),
    (1, "l_quantity", "orient_z"),
    (1, "l_extendedprice", "orient_w"),
    (2, "l_quantity", "linear_x"),
    (2, "l_extendedprice", "linear_y"),
    (2, "l_discount", "linear_z"),
    (2, "l_tax", "angular_x"),
    (2, "l_quantity", "angular_y"),
    (2, "l_extendedprice", "angular_z"),
    (3, "l_quantity", "pos_x"),
    (3, "l_extendedprice", "pos_y"),
    (3, "l_discount", "pos_z"),
    (3, "l_tax", "pose_orient_x"),
    (3, "l_quantity", "pose_orient_y"),
    (3, "l_extendedprice", "pose_orient_z"),
    (3, "l_discount", "pose_orient_w"),
]


@query(
    "flatten_columns",
    f"SELECT {_KEYS}, " + ", ".join(_when(k, e, n) for k, e, n in FLAT_COLUMNS) + " FROM lineitem",
)
def _flat_columns(t: Tables) -> DataFrame:
    payload = F.col("payload")
    columns = fl.joint_columns(payload, ["j1", "j2"]) | fl.imu_columns(payload) | fl.twist_columns(payload)
    columns |= {k.replace("orient_", "pose_orient_"): v for k, v in fl.pose_columns(payload).items()}
    return typed_messages(t).select(*MSG_KEYS, *[c.alias(n) for n, c in columns.items()])


# element counts differ from row to row: 2 positions, 2 velocities, 1 effort
_LEAVES = [(None, "CAST(l_discount > 0.05 AS INTEGER)", "dense"), (0, "l_tax", "effort_0")]
_LEAVES += [(0, "l_quantity", "position_0"), (0, "l_extendedprice", "position_1"), (0, "l_discount", "velocity_0"), (0, "l_tax", "velocity_1")]
for _name, _kind, _values in [
    ("linear_acceleration", 1, {"x": "l_quantity", "y": "l_extendedprice", "z": "l_discount"}),
    ("angular_velocity", 1, {"x": "l_tax", "y": "l_quantity", "z": "l_extendedprice"}),
    ("orientation", 1, {"x": "l_discount", "y": "l_tax", "z": "l_quantity", "w": "l_extendedprice"}),
    ("twist_linear", 2, {"x": "l_quantity", "y": "l_extendedprice", "z": "l_discount"}),
    ("twist_angular", 2, {"x": "l_tax", "y": "l_quantity", "z": "l_extendedprice"}),
    ("pose_position", 3, {"x": "l_quantity", "y": "l_extendedprice", "z": "l_discount"}),
    ("pose_orientation", 3, {"x": "l_tax", "y": "l_quantity", "z": "l_extendedprice", "w": "l_discount"}),
]:
    _LEAVES += [(_kind, _value, f"{_name}_{_axis}") for _axis, _value in _values.items()]


@query(
    "flatten_numeric",
    " UNION ALL ".join(
        f"SELECT {_KEYS}, '{name}' AS name, CAST({value} AS DOUBLE) AS value FROM lineitem" + ("" if kind is None else f" WHERE l_linenumber % 4 = {kind}")
        for kind, value, name in _LEAVES
    ),
)
def _flat_numeric(t: Tables) -> DataFrame:
    df = typed_messages(t)
    return df.select(*MSG_KEYS, F.inline(fl.numeric_values(F.col("payload"), _payload_schema(df))))
