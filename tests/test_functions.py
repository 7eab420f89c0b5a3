import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinetable.functions import names as nm
from kinetable.functions import tags as tg
from kinetable.functions import vectors as vec
from kinetable.operators import features as ft
from kinetable.operators.timing import keyword_score
from kinetable.operators.stats import size_label

SLOW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def matrix_of(angles):
    a, b, c = angles
    rx = np.array([[1, 0, 0], [0, math.cos(a), -math.sin(a)], [0, math.sin(a), math.cos(a)]])
    ry = np.array([[math.cos(b), 0, math.sin(b)], [0, 1, 0], [-math.sin(b), 0, math.cos(b)]])
    rz = np.array([[math.cos(c), -math.sin(c), 0], [math.sin(c), math.cos(c), 0], [0, 0, 1]])
    return rz @ ry @ rx


def quat_matrix(q):
    x, y, z, w = np.array(q) / np.linalg.norm(q)
    return np.array(
        [
            [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
            [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
            [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
        ]
    )


def gram_schmidt(v):
    a, b = np.array(v[:3]), np.array(v[3:])
    x = a / np.linalg.norm(a)
    p = b - (b @ x) * x
    y = p / np.linalg.norm(p)
    return np.column_stack([x, y, np.cross(x, y)])


def apply(spark, fn, rows):
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "i long, v array<double>")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_rotations_rebuild_the_matrix(spark):
    rng = np.random.default_rng(5)
    quats = rng.normal(size=(200, 4)) * 3
    for q, angles in zip(quats, apply(spark, vec.quat_xyzw_to_euler, quats), strict=True):
        assert np.allclose(matrix_of(angles), quat_matrix(q), atol=1e-9)
    rolled = np.roll(quats, 1, axis=1)  # xyzw stored as wxyz
    assert np.allclose(apply(spark, vec.quat_wxyz_to_euler, rolled), apply(spark, vec.quat_xyzw_to_euler, quats))
    six = rng.normal(size=(200, 6)) * 2
    for v, m, angles in zip(six, apply(spark, vec.rot6d_to_matrix, six), apply(spark, vec.rot6d_to_euler, six), strict=True):
        assert np.allclose(m, gram_schmidt(v), atol=1e-9)
        assert np.allclose(matrix_of(angles), gram_schmidt(v), atol=1e-8)


def test_gimbal_lock_sets_third_angle_to_zero(spark):
    s = math.sqrt(0.5)
    up, down = [0, s, 0, s], [0, -s, 0, s]
    half = [0.5, 0.5, -0.5, 0.5]  # 90 degrees about y after a turn about x
    for q in (up, down, half):
        (angles,) = apply(spark, vec.quat_xyzw_to_euler, [q])
        assert abs(abs(angles[1]) - math.pi / 2) < 1e-6 and angles[2] == 0.0
        assert np.allclose(matrix_of(angles), quat_matrix(q), atol=1e-6)
    column_down = [0, 0, -1, 0.6, 0.8, 0]
    (angles,) = apply(spark, vec.rot6d_to_euler, [column_down])
    assert np.allclose(matrix_of(angles), gram_schmidt(column_down), atol=1e-6) and angles[2] == 0.0


@pytest.mark.parametrize(
    ("fn", "row"),
    [(vec.quat_xyzw_to_euler, [0] * 4), (vec.rot6d_to_euler, [0] * 6), (vec.rot6d_to_matrix, [1, 0, 0, 2, 0, 0]), (vec.rot6d_to_euler, [1, 0, 0, 2, 0, 0])],
)
def test_degenerate_rotations_are_errors(spark, fn, row):
    with pytest.raises(Exception, match="zero norm"):
        apply(spark, fn, [row])


def test_units_and_slices(spark):
    assert apply(spark, vec.cm_to_m, [[100, 250]]) == [[1.0, 2.5]]
    assert apply(spark, vec.mm_to_m, [[1500]]) == [[1.5]]
    assert apply(spark, vec.degree_to_rad, [[180]]) == [[math.pi]]
    v = list(range(5))
    for a, b in [(0, 2), (1, 4), (3, 9), (5, 7), (2, 2), (0, -1), (-3, -1), (-2, 5), (-9, 2), (1, -9), (-1, -3)]:
        assert apply(spark, lambda c, a=a, b=b: vec.vector_slice(c, a, b), [v]) == [[float(x) for x in v[a:b]]]


@SLOW
@given(st.lists(st.text("ab01 _9.", min_size=1, max_size=12), min_size=2, max_size=30, unique=True))
def test_natural_key_orders_like_split_tuples(spark, names):
    import re

    def parts(name):
        return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.findall(r"\d+|\D+", name)]

    df = spark.createDataFrame([(n,) for n in names], "n string")
    keys = {r["n"]: r["k"] for r in df.select("n", nm.natural_key(F.col("n")).alias("k")).collect()}
    for a in names:
        for b in names:
            pa, pb = parts(a), parts(b)
            if len(pa) == len(pb) and all(x[0] == y[0] for x, y in zip(pa, pb, strict=True)) and [x[2] for x in pa] == [x[2] for x in pb]:
                # same text parts: the numbers alone decide
                assert (keys[a] < keys[b]) == ([x[1] for x in pa] < [x[1] for x in pb])


def test_scratch_folders_are_removed(spark):
    import os

    from kinetable.session import scratch, staged

    with scratch(spark):
        kept = staged(spark.range(3), "test")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        assert kept.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_natural_key_has_no_width(spark):
    names = ["ep2", "ep1" + "0" * 60 + "1", "ep1" + "0" * 60 + "2", "ep" + "0" * 70 + "3", "ep1" + "0" * 59, "ep10", "ep9"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["n"] for r in df.orderBy(nm.natural_key(F.col("n"))).collect()]
    assert got == sorted(names, key=lambda n: int(n[2:]))


def test_numeric_values_keep_every_element(spark):
    from kinetable.functions import flatten as fl

    schema = "p struct<b boolean, a array<double>, s struct<x int, t string>, n array<int>>"
    df = spark.createDataFrame([((True, [1.0, 2.0, 3.0], (7, "no"), []),), ((None, None, None, [5] * 300),)], schema)
    kind = df.schema["p"].dataType
    got = [{x["name"]: x["value"] for x in r[0]} for r in df.select(fl.numeric_values(F.col("p"), kind)).collect()]
    assert got == [{"a_0": 1.0, "a_1": 2.0, "a_2": 3.0, "b": 1.0, "s_x": 7.0}, {f"n_{i}": 5.0 for i in range(300)}]
    wide = fl.numeric_leaves(F.col("p"), kind, 2)
    with pytest.raises(Exception, match="more than 2 elements"):
        df.select(*[c.alias(n) for n, c in wide.items()]).collect()


def test_names(spark):
    df = spark.createDataFrame(
        [("/root/data1/task_a b/episode_3/00012_color_2.JPG",), ("x.jpeg",), ("/nas/数据/task_build_blocks _500/",), ("/nas/数据",)], "p string"
    )
    rows = df.select(
        nm.base_name(F.col("p")).alias("base"),
        nm.camera_index(nm.base_name(F.col("p"))).alias("cam"),
        nm.clean_dataset_name(F.col("p")).alias("clean"),
        nm.ancestors(F.col("p")).alias("up"),
    ).collect()
    assert rows[0]["cam"] == 2 and rows[1]["cam"] is None
    assert [r["clean"] for r in rows] == ["00012_color_2.JPG", "x.jpeg", "task_build_blocks", "unknown_dataset"]
    assert rows[0]["up"] == ["/root", "/root/data1", "/root/data1/task_a b", "/root/data1/task_a b/episode_3"]
    keys = spark.createDataFrame([("color_1",), ("camera",), ("cam_12",)], "k string")
    assert [r[0] for r in keys.select(nm.camera_key_index(F.col("k"))).collect()] == [1, 0, 12]


def test_tag_text_with_full_width_separators(spark):
    text = "场景类型: 餐厅、厨房，客厅\n 采集本体：arm_x\n\n桌面高度: 77.2cm\n相机数量：3\n无冒号\n物品: 容器-篮子-黑色篮子，其他\n相机数量: -4\n比例: 1.5　x\n空: ；；"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(tg.tag_map(F.col("t")).alias("m")).first()["m"]
    assert got == {
        "场景类型": ["餐厅", "厨房", "客厅"],
        "采集本体": ["arm_x"],
        "桌面高度": ["77.2cm"],
        "相机数量": ["-4"],
        "物品": ["容器-篮子-黑色篮子", "其他"],
        "比例": ["1.5", "x"],
        "空": [],
    }
    typed = df.select(F.explode(tg.tag_map(F.col("t"))).alias("k", "v")).select("k", *[c.alias(n) for n, c in tg.tag_values(F.col("k"), F.col("v")).items()])
    rows = {r["k"]: r for r in typed.collect()}
    assert rows["物品"]["hierarchy"].asDict() == {"level1": "容器", "level2": "篮子", "level3": "黑色篮子", "level4": None, "level5": None}
    assert rows["物品"]["items"] is None
    assert rows["相机数量"]["items"][0]["integer"] == -4
    assert rows["比例"]["items"][0]["decimal"] == 1.5 and rows["比例"]["is_list"]
    assert rows["空"]["is_list"] and rows["空"]["items"] == []


@SLOW
@given(st.dictionaries(st.text("abcxyz", min_size=1, max_size=5), st.lists(st.text("abc123.-", min_size=1, max_size=6), min_size=1, max_size=4), max_size=5))
def test_parse_of_rendered_tags(spark, tags):
    text = "\n".join(f"{k}： {'、'.join(v)}" for k, v in tags.items())
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tg.tag_map(F.col("t")).alias("m")).first()["m"] == tags


@pytest.mark.parametrize("value", ["12", "-7", "1.5", "1e3", ".5", "5.", "1_000", "inf", "nan", "abc", "1d", "--1", "+3", "1e", "0x10", "99999999999999999999", "-12345678901234567890123456789012345678", "7" * 45])
def test_numeric_tags_follow_float_rules(spark, value):
    row = spark.createDataFrame([(value,)], "s string").select(tg.tag_numeric(F.col("s")).alias("n")).first()["n"]
    if value.lstrip("-").isdigit() and value.count("-") <= 1:
        wanted = int(value)
        small, big = abs(wanted) < 2**63, abs(wanted) < 10**38
        got = (row["integer"], None if row["big"] is None else int(row["big"]), row["decimal"])
        assert got == (wanted if small else None, None if small or not big else wanted, None if big else float(wanted))
        return
    try:
        wanted = float(value)
    except ValueError:
        wanted = None
    assert row["integer"] is None
    assert row["decimal"] == wanted or (wanted != wanted and row["decimal"] != row["decimal"])


def test_size_labels(spark):
    values = [0, 999, 1000, 10**6 - 1, 10**9, 10**12 - 1, 10**12]
    df = spark.createDataFrame([(v,) for v in values], "n long").select(size_label(F.col("n")).alias("l"))
    assert [r["l"] for r in df.collect()] == ["<1K", "<1K", "1K-10K", "100K-1M", "1B-10B", "100B-1T", ">1T"]


def test_keyword_score_takes_first_match(spark):
    df = spark.createDataFrame([("/a/Depth/camera",), ("/x/image_color",), ("/joint",)], "t string")
    assert [r[0] for r in df.select(keyword_score(F.col("t"))).collect()] == [3, 5, 0]


CONFIG = {
    "features": {
        "observation": {
            "images": [{"cam_name": "c", "args": {"topic_name": "/c"}}],
            "state": {"sub_state": [{"names": ["a"], "args": {"path": "v", "range_from": 0, "range_to": 1}}]},
        },
        "action": {"sub_action": [{"names": ["b"], "args": {"path": "v", "range_from": 1, "range_to": 3}}]},
    }
}


def broken(path, value=None, drop=False):
    import copy

    config = copy.deepcopy(CONFIG)
    node = config
    for key in path[:-1]:
        node = node[key]
    if drop:
        del node[path[-1]]
    else:
        node[path[-1]] = value
    return config


@pytest.mark.parametrize(
    "config",
    [
        broken(["features"], drop=True),
        broken(["features", "observation", "images"], drop=True),
        broken(["features", "observation", "images", 0, "args"], drop=True),
        broken(["features", "observation", "images"], [{"cam_name": "c", "args": {}}, {"cam_name": "c", "args": {}}]),
        broken(["features", "observation", "state", "sub_state", 0, "names"], ["a", "a"]),
        broken(["features", "action", "sub_action"], drop=True),
    ],
)
def test_bad_configs_are_refused_before_planning(config):
    with pytest.raises(ft.ConfigError):
        ft.validate_config(config)


def test_feature_schema_reports_a_wrong_width(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "i long, v array<double>")
    built = ft.assemble_features(df, CONFIG, ["i"])
    rows = {r["feature"]: r for r in ft.feature_schema(built, CONFIG).collect()}
    assert rows["observation.state"]["matches"] and rows["observation.images.c"]["matches"] is None
    # one name is declared, but range 1:3 gives one element here; declare two and it must fail
    two = broken(["features", "action", "sub_action", 0, "names"], ["b", "d"])
    rows = {r["feature"]: r for r in ft.feature_schema(ft.assemble_features(df, two, ["i"]), two).collect()}
    assert rows["action"]["matches"] is False


def test_strict_nested_path_raises(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}}',)], "j string").select(F.parse_json("j").alias("p"))
    assert df.select(ft.nested_path("p", "a.b", schemaless=True)).first()[0] == [1.0, 2.0]
    assert df.select(ft.nested_path("p", "a.x", schemaless=True)).first()[0] is None
    with pytest.raises(Exception, match="not found"):
        df.select(ft.nested_path("p", "a.x", schemaless=True, strict=True)).collect()
