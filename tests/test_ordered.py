"""Hot groups are cut into slices; results must equal plain Python whatever the threshold."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinetable.operators import ordered as od
from kinetable.operators.align import align_nearest, align_truncate
from kinetable.operators.frames import nearest_image, offset_action
from kinetable.operators.timing import split_messages, topic_timing
from kinetable.plans import QUERIES, ORACLES, load_all
from tests.harness import compare, connect

load_all()
HOT = 20


def skewed(n: int, seed: int) -> list[tuple]:
    """A third of all rows in one group, with equal times and nulls in the payload."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rnd.random() < 0.4 else f"g{rnd.randrange(12)}"
        rows.append((group, rnd.randrange(n // 2), i, None if rnd.random() < 0.1 else rnd.random()))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = skewed(600, 1)
    return rows, spark.createDataFrame(rows, "g string, t long, id long, v double").repartition(4)


def by_group(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return {g: sorted(rs, key=lambda r: (r[1], r[2])) for g, rs in groups.items()}


def test_only_large_groups_are_hot(table):
    _, df = table
    assert not od.plan_split(df, ["g"], ["t", "id"], hot_rows=10_000).hot
    split = od.plan_split(df, ["g"], ["t", "id"], hot_rows=100)
    assert [r["g"] for r in split.bounds.collect()] == ["hot"]
    sizes = [r["count"] for r in od.slice_rows(df, split).where("g = 'hot'").groupBy("_slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 200


@pytest.mark.parametrize("hot_rows", [5, HOT, 100_000])
def test_number_rows(table, hot_rows):
    rows, df = table
    got = {(r["g"], r["id"]): r["n"] for r in od.number_rows(df, ["g"], ["t", "id"], "n", hot_rows=hot_rows).collect()}
    want = {(g, r[2]): i for g, rs in by_group(rows).items() for i, r in enumerate(rs)}
    assert got == want


@pytest.mark.parametrize("hot_rows", [HOT, 100_000])
def test_number_whole_table(table, hot_rows):
    rows, df = table
    got = {r["id"]: r["n"] for r in od.number_rows(df, [], ["t", "id"], "n", start=1, hot_rows=hot_rows).collect()}
    assert got == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}


@pytest.mark.parametrize("hot_rows", [5, HOT, 100_000])
def test_with_previous_keeps_nulls(table, hot_rows):
    rows, df = table
    got = {(r["g"], r["id"]): r["p"] for r in od.with_previous(df, ["g"], ["t", "id"], "v", "p", hot_rows=hot_rows).collect()}
    want = {}
    for g, rs in by_group(rows).items():
        for a, b in zip([None, *rs], rs, strict=False):
            want[(g, b[2])] = a[3] if a else None
    assert got == want


def test_many_slices_and_their_cap(spark):
    """More boundaries than one run holds, and a total that is shared by size."""
    assert od._slice_counts([10**12, 10**7], 10**6) == [od.MAX_SLICES, 11]
    counts = od._slice_counts([10**9] * 1000, 10**6)
    assert sum(counts) <= od.MAX_TOTAL_SLICES and min(counts) >= 2
    rows = [("hot", i // 3, i, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t long, id long, v double").repartition(4)
    split = od.plan_split(df, ["g"], ["t", "id"], hot_rows=10)
    bounds = split.bounds.first()
    assert len(bounds["_coarse"]) > 2 and max(len(f) for f in bounds["_fine"]) == od.FINE
    sliced = od.slice_rows(df, split).groupBy("_slice").agg({"id": "min", "*": "count"}).orderBy("_slice").collect()
    assert len(sliced) == 1 + sum(len(f) for f in bounds["_fine"])
    assert [r["min(id)"] for r in sliced] == sorted(r["min(id)"] for r in sliced)
    assert max(r["count(1)"] for r in sliced) < 60
    got = od.number_rows(df, ["g"], ["t", "id"], "n", split=split).where("n <> id").count()
    assert got == 0


def test_null_group_key(spark):
    rows = [(None, i % 50, i, float(i)) for i in range(200)] + [("a", 1, 900, 1.0)]
    df = spark.createDataFrame(rows, "g string, t long, id long, v double")
    out = od.number_rows(df, ["g"], ["t", "id"], "n", hot_rows=HOT).collect()
    assert sorted(r["n"] for r in out if r["g"] is None) == list(range(200))


def nearest_by_hand(targets, sources):
    out = {}
    for g, t, i, _ in targets:
        own = sorted((r for r in sources if r[0] == g), key=lambda r: (r[1], r[2]))
        if own:
            at = int(np.argmin(np.abs(np.array([r[1] for r in own]) - t)))
            out[(g, i)] = (own[at][1], own[at][2], own[at][3])
        else:
            out[(g, i)] = (None, None, None)
    return out


@pytest.mark.parametrize("hot_rows", [5, HOT, 100_000])
def test_nearest_match(spark, table, hot_rows):
    targets, df = table
    sources = [r for r in skewed(500, 2) if r[0] != "g3" and not (r[0] == "hot" and 60 < r[1] < 120)]
    src = spark.createDataFrame(sources, "g string, t long, id long, v double")
    split = od.plan_split(df, ["g"], ["t"], hot_rows=hot_rows)
    got = od.nearest_match(df, src, ["g"], "t", "id", ["v"], split=split).collect()
    assert {(r["g"], r["id"]): (r["src_t"], r["src_id"], r["src_v"]) for r in got} == nearest_by_hand(targets, sources)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    base=st.lists(st.integers(0, 40), min_size=1, max_size=25),
    other=st.lists(st.integers(0, 40), min_size=0, max_size=25),
    hot_rows=st.sampled_from([4, 10_000]),
)
def test_nearest_property(spark, base, other, hot_rows):
    targets = [("e", t, i, 0.0) for i, t in enumerate(base)]
    sources = [("e", t, i, float(i)) for i, t in enumerate(other)]
    schema = "g string, t long, id long, v double"
    tdf, sdf = spark.createDataFrame(targets, schema), spark.createDataFrame(sources, schema)
    split = od.plan_split(tdf.unionByName(sdf), ["g"], ["t"], hot_rows=hot_rows)
    got = od.nearest_match(tdf, sdf, ["g"], "t", "id", ["v"], split=split).collect()
    assert {(r["g"], r["id"]): (r["src_t"], r["src_id"], r["src_v"]) for r in got} == nearest_by_hand(targets, sources)


SPLIT_QUERIES = [
    "messages_load",
    "message_gaps",
    "topic_timing",
    "topic_timing_zero_gaps",
    "align_nearest",
    "align_nearest_ties",
    "align_quality",
    "align_presets",
    "sync_report",
    "episode_numbering",
    "frame_nearest_image",
    "action_offset",
    "frame_index_cols",
    "natural_sort",
    "episode_files",
    "dim_get_or_create",
    "heartbeat_gap_batch",
    "convert_recordings",
    "dataset_frame_lists",
    "episode_json_files",
    "camera_from_filename",
    "scan_dataset_tree",
    "bson_episode_ingest",
]


@pytest.mark.parametrize("name", SPLIT_QUERIES)
def test_queries_with_every_group_hot(spark, sf, name):
    """The registered queries give the same rows when nearly all groups are cut."""
    spark.conf.set(od.HOT_ROWS_CONF, "3")
    try:
        assert compare(spark, connect(sf), sf, name, QUERIES[name], ORACLES[name]) == ""
    finally:
        spark.conf.unset(od.HOT_ROWS_CONF)


def messages(spark, per_topic):
    rows = [("e1", topic, i, ts) for topic, stamps in per_topic.items() for i, ts in enumerate(sorted(stamps))]
    return spark.createDataFrame(rows, "episode_id string, topic string, seq long, ts_ns long")


def test_truncate_gives_equal_lengths(spark):
    df = messages(spark, {"a": range(5), "b": range(9), "c": range(7)})
    counts = {r["topic"]: r["count"] for r in align_truncate(df).groupBy("topic").count().collect()}
    assert counts == {"a": 5, "b": 5, "c": 5}


def test_single_message_topic_has_zero_stats(spark):
    row = topic_timing(messages(spark, {"a": [7]})).first()
    assert (row["n"], row["span_s"], row["rate_hz"], row["rate_std_hz"], row["max_gap_ms"]) == (1, 0.0, 0.0, 0.0, 0.0)


def test_rate_is_count_over_span_and_population_std(spark):
    row = topic_timing(messages(spark, {"a": [0, 10**9, 3 * 10**9]})).first()
    assert row["rate_hz"] == pytest.approx(3 / 3)
    assert row["rate_std_hz"] == pytest.approx(np.std([1.0, 0.5]))


def test_base_rows_map_to_themselves(spark):
    df = messages(spark, {"/rgb": [0, 5, 5, 9], "/joint": [4, 6]})
    rows = {(r["topic"], r["frame_index"]): r for r in align_nearest(df).collect()}
    assert [rows[("/rgb", i)]["src_seq"] for i in range(4)] == [0, 1, 2, 3]
    # 5 is as far from 4 as from 6: the earlier message
    assert [rows[("/joint", i)]["src_seq"] for i in range(4)] == [0, 0, 0, 1]


def test_wanted_topics_only(spark):
    """The base is chosen among all topics even when it is not wanted itself."""
    df = messages(spark, {"/rgb": [0, 5, 9], "/joint": [4, 6], "/imu": [1]})
    every = {tuple(r) for r in align_nearest(df).where("topic = '/joint'").collect()}
    assert len(every) == 3
    assert {tuple(r) for r in align_nearest(df, topics=["/joint"]).collect()} == every
    assert {r["topic"] for r in align_nearest(df, topics=["/joint", "/rgb", "/none"]).collect()} == {"/joint", "/rgb"}


def test_split_is_shared(spark):
    df = messages(spark, {"a": range(100), "b": range(0, 100, 7)})
    split = od.plan_split(df, ["episode_id"], ["ts_ns"], hot_rows=10)
    plain = topic_timing(df, split_messages(df)).orderBy("topic").collect()
    assert topic_timing(df, split).orderBy("topic").collect() == plain


def test_offset_action_hot_and_plain_agree(spark):
    rows = [(e, i, [float(i)] if i != 5 else None) for e in range(3) for i in range(12) if i % 5 != 2 + e]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, action array<double>")
    there = {(e, i): a for e, i, a in rows}
    hot = od.plan_split(frames, ["episode_index"], ["frame_index"], hot_rows=2)
    assert hot.hot
    for keep in (True, False):
        a = offset_action(frames, 2, keep_tail=keep).select("episode_index", "frame_index", "offset_action")
        b = offset_action(frames, 2, keep_tail=keep, split=hot).select("episode_index", "frame_index", "offset_action")
        want = [(e, i, there.get((e, i + 2))) for e, i in there if keep or (e, i + 2) in there]
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str) == sorted(want, key=str)


def test_few_different_keys_still_get_boundaries(spark):
    df = spark.range(4000).selectExpr("'g' AS g", "id % 4 AS t", "id")
    split = od.plan_split(df, ["g"], ["t"], hot_rows=100)
    assert split.hot
    sizes = [r["count"] for r in od.slice_rows(df, split).groupBy("_slice").count().collect()]
    assert sizes == [1000] * 4


def test_running_total_of_scattered_keys(spark):
    from kinetable.operators.frames import running_total

    rnd = random.Random(3)
    rows = [(rnd.randrange(1 << 60), rnd.randrange(9)) for _ in range(500)]
    got = {r["k"]: r["before"] for r in running_total(spark.createDataFrame(rows, "k long, v long"), "k", "v", "before", block=7).collect()}
    total = 0
    for k, v in sorted(rows):
        assert got[k] == total
        total += v


def test_nearest_image_prefers_lower_number(spark):
    frames = spark.createDataFrame([(1, i) for i in range(5)], "episode_index long, frame_index long")
    images = spark.createDataFrame([(1, 0, "a"), (1, 4, "b")], "episode_index long, frame_index long, name string")
    got = {r["frame_index"]: r["image_name"] for r in nearest_image(frames, images, ["name"]).collect()}
    assert got == {0: "a", 1: "a", 2: "a", 3: "b", 4: "b"}
