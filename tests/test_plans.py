"""Plans must stay free of cross products, Python in the relational part, and unpruned scans."""

import contextlib
import io
import re

import pytest

from kinetable.plans import QUERIES, load_all

load_all()
FILE_JOBS = {"yaml_registry_scan", "bson_episode_ingest", "media_integrity", "media_box_scan", "bson_range_ingest"}


def plan_of(spark, sf, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, sf).explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_product_and_no_python(spark, sf, name):
    plan = plan_of(spark, sf, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in FILE_JOBS:
        assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan)


@pytest.mark.parametrize("name", ["natural_sort", "scan_dataset_tree", "topic_timing", "frame_index_cols", "episode_numbering"])
def test_no_nested_loops_when_groups_are_cut(spark, sf, name):
    spark.conf.set("spark.kinetable.hotGroupRows", "20")
    try:
        plan = plan_of(spark, sf, name)
    finally:
        spark.conf.unset("spark.kinetable.hotGroupRows")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("topic_timing", {"ts", "user_id", "event_type"}),
        ("frames_by_topic", {"user_id", "event_type"}),
        ("align_truncate_loss", {"user_id", "event_type"}),
        ("frames_by_rowcount", {"l_orderkey", "conv_id"}),
        ("pending_work", {"c_custkey", "c_mktsegment", "o_custkey", "o_orderstatus"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, sf, name, columns):
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", plan_of(spark, sf, name)):
        read |= {part.split(":")[0] for part in schema.split(",") if part}
    assert read == columns


@pytest.mark.parametrize(
    ("name", "scans"), [("align_presets", 5), ("bad_field_reject", 3), ("camera_prune", 2), ("config_match", 4), ("frame_assemble", 3)]
)
def test_no_input_is_read_twice_without_need(spark, sf, name, scans):
    plan = plan_of(spark, sf, name)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) <= scans


def test_filters_reach_the_scan(spark, sf):
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan_of(spark, sf, "pending_work")


def test_alignment_shuffles_messages_three_times_at_most(spark, sf):
    """Number, timing and match; the two small per-episode aggregates come on top."""
    plan = plan_of(spark, sf, "align_nearest")
    by_topic = re.findall(r"hashpartitioning\(episode_id#\d+L?, topic#\d+", plan)
    assert len(by_topic) == 3
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 2


def test_first_rows_cut_before_the_shuffle(spark, sf):
    plan = plan_of(spark, sf, "sample_topk")
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan
