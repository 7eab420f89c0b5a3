"""Queries of the statistics and profile operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.operators import paths as pt
from kinetable.operators import profile as pf
from kinetable.operators import stats as st
from kinetable.plans.paths import IMAGES_SQL, image_listing
from kinetable.plans.registry import Tables, query, r6, rounded
from kinetable.plans.standin import MICROS, messages_sql, topic_col


def plain(t: Tables, scale: int = 6000) -> DataFrame:
    """Messages without a number: these operators need no order."""
    return t.events.select(
        F.col("user_id").alias("episode_id"),
        topic_col().alias("topic"),
        F.expr(f"({MICROS}) div {scale}").alias("ts_ns"),
        "event_id",
        "value",
        F.initcap("event_type").alias("msgtype"),
    )


@query(
    "topic_inventory",
    f"""WITH {messages_sql()}, c AS (SELECT episode_id, topic, event_type, count(*) AS n FROM messages GROUP BY 1, 2, 3)
SELECT topic, CAST(sum(n) AS BIGINT) AS total_messages, round(avg(n) + 1e-9, 6) AS avg_per_file, count(*) AS files,
  upper(event_type[1]) || event_type[2:] AS msgtype FROM c GROUP BY topic, event_type""",
)
def _inventory(t: Tables) -> DataFrame:
    out = pf.topic_inventory(plain(t), "msgtype")
    return out.withColumn("avg_per_file", r6(F.col("avg_per_file") + F.lit(1e-9)))


@query(
    "topic_frequency",
    f"""WITH {messages_sql()}, d AS (SELECT episode_id, max(ts_ns) - min(ts_ns) AS duration_ns FROM messages GROUP BY 1)
SELECT episode_id, topic, count(*) AS n, duration_ns, round(CASE WHEN duration_ns > 0 THEN count(*) / duration_ns * 1e9 ELSE 0.0 END, 6) AS frequency_hz
FROM messages JOIN d USING (episode_id) GROUP BY 1, 2, 4""",
)
def _frequency(t: Tables) -> DataFrame:
    return rounded(pf.topic_frequency(plain(t)), frequency_hz=6)


@query(
    "export_summary",
    f"""WITH {messages_sql()}, c AS (SELECT topic, count(*) AS n FROM messages GROUP BY 1)
SELECT count(*) AS total_topics, CAST(sum(n) AS BIGINT) AS total_messages, count(*) FILTER (WHERE topic LIKE '%camera%' OR topic LIKE '%image%') AS image_topics,
  count(*) FILTER (WHERE regexp_matches(topic, 'imu|feedback|joint')) AS sensor_topics,
  count(*) FILTER (WHERE regexp_matches(topic, 'control|target|command')) AS control_topics FROM c""",
)
def _summary(t: Tables) -> DataFrame:
    return pf.export_summary(plain(t))


_ROLE_TOPIC = "concat(CASE event_type WHEN 'click' THEN '/Camera_head/' WHEN 'view' THEN '/image_raw/' WHEN 'purchase' THEN '/Joint/target_' WHEN 'signup' THEN '/imu_camera/' ELSE '/other/' END, CASE user_id % 3 WHEN 0 THEN 'State' WHEN 1 THEN 'CMD' ELSE 'pose_image' END)"


@query(
    "topic_role",
    f"""WITH n AS (SELECT DISTINCT {_ROLE_TOPIC} AS topic FROM events)
SELECT topic, concat_ws(',', CASE WHEN regexp_matches(topic, 'camera|image') THEN 'image' END,
  CASE WHEN regexp_matches(lower(topic), 'imu|feedback|joint|state|pose') THEN 'sensor' END,
  CASE WHEN regexp_matches(lower(topic), 'control|target|command|cmd') THEN 'control' END) AS roles FROM n""",
)
def _roles(t: Tables) -> DataFrame:
    topics = t.events.select(F.expr(_ROLE_TOPIC).alias("topic")).distinct()
    return topics.select("topic", F.array_join(pf.topic_roles(F.col("topic")), ",").alias("roles"))


_SIDECAR = "concat('{\"k\": ', event_id % 97, ', \"type\": \"', repeat(event_type, 30), '\", \"unit\": \"m\", \"rate\": 30, \"note\": \"', repeat('n', cast((event_id + 120) % 150 as int)), '\"', CASE WHEN event_id % 3 = 0 THEN ', \"extra\": 1' ELSE '' END, '}')"


def _sidecars(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_id").alias("path"), F.expr(_SIDECAR).alias("content"))


@query(
    "metadata_key_profile",
    f"""WITH f AS (SELECT event_id, {_SIDECAR} AS content FROM events), k AS (SELECT event_id, unnest(json_keys(content)) AS key, content FROM f),
g AS (SELECT key, count(*) AS files, arg_min(content, event_id) AS first FROM k GROUP BY 1),
v AS (SELECT key, files, json_extract_string(first, '$.' || key) AS value FROM g WHERE files = (SELECT count(*) FROM events))
SELECT key, files, CASE WHEN len(value) > 100 THEN value[1:100] || '...' ELSE value END AS sample FROM v""",
)
def _keys(t: Tables) -> DataFrame:
    return pf.common_keys(_sidecars(t))


@query(
    "key_intersect",
    """WITH f AS (SELECT event_id, '{"a' || (event_id % 46) || '":1,"b' || (event_id % 10) || '":{"c":2}}' AS left_side, '{"a' || (event_id % 93) || '":1,"b' || (event_id % 15) || '":[3]}' AS right_side FROM events)
SELECT unnest(json_keys(left_side)) AS key FROM f WHERE event_id % 2 = 0 INTERSECT SELECT unnest(json_keys(right_side)) FROM f WHERE event_id % 2 = 1""",
)
def _intersect(t: Tables) -> DataFrame:
    """Keys that differ from file to file, some on one side only."""

    def side(parity: int, a: int, b: int, nested: str) -> DataFrame:
        text = f"""concat('{{"a', event_id % {a}, '":1,"b', event_id % {b}, '":{nested}}}')"""
        return t.events.where(f"event_id % 2 = {parity}").select(F.expr(text).alias("content"))

    return pf.key_intersection(side(0, 46, 10, '{"c":2}'), side(1, 93, 15, "[3]"))


@query("topic_union", f"WITH {messages_sql()} SELECT DISTINCT topic || '_' || (episode_id % 11) AS topic FROM messages")
def _union(t: Tables) -> DataFrame:
    df = plain(t).withColumn("topic", F.concat("topic", F.lit("_"), F.col("episode_id") % 11))
    return pf.union_topics([df.where("episode_id % 2 = 0"), df.where("episode_id % 2 = 1")])


@query(
    "sample_topk",
    f"""WITH {messages_sql()}, n AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts_ns, event_id) AS position FROM messages),
a AS (SELECT 'all' AS part, topic, event_id, CAST(NULL AS BIGINT) AS position FROM messages ORDER BY ts_ns, event_id LIMIT 5)
SELECT * FROM a UNION ALL SELECT 'topic', topic, event_id, position FROM n WHERE position <= 3""",
)
def _topk(t: Tables) -> DataFrame:
    df = plain(t).select("topic", "ts_ns", "event_id")
    order = ["ts_ns", "event_id"]
    first = pf.first_rows(df, 5, order).select(F.lit("all").alias("part"), "topic", "event_id", F.lit(None).cast("long").alias("position"))
    each = pf.first_rows(df, 3, order, ["topic"])
    return first.unionByName(each.select(F.lit("topic").alias("part"), "topic", "event_id", F.col("position").cast("long").alias("position")))


@query(
    "feature_map_infer",
    f"""WITH {messages_sql()}, s AS (SELECT DISTINCT concat(topic, '_', episode_id % 3) AS topic,
  CASE WHEN topic LIKE '%rgb%' AND episode_id % 3 = 1 THEN 'sensor_msgs/CompressedImage' WHEN topic LIKE '%imu%' AND episode_id % 3 = 2 THEN 'sensor_msgs/JointState' ELSE 'other' END AS msgtype FROM messages),
k AS (SELECT 'dataset' AS rule, topic, CASE WHEN contains(msgtype, 'Image') OR contains(lower(topic), 'image') THEN 'image' WHEN contains(msgtype, 'JointState') OR contains(lower(topic), 'joint') THEN 'state' END AS kind FROM s
  UNION ALL SELECT 'inspect', topic, CASE WHEN contains(msgtype, 'Image') OR contains(lower(topic), 'image') THEN 'image' WHEN contains(lower(msgtype), 'joint') OR contains(lower(topic), 'joint') OR contains(lower(topic), 'state') THEN 'state' END FROM s
  UNION ALL SELECT 'by_type', topic, CASE WHEN contains(lower(msgtype), 'image') OR contains(lower(msgtype), 'compressed') THEN 'image' WHEN contains(lower(msgtype), 'joint') OR contains(lower(topic), 'joint') THEN 'state' END FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY rule, kind ORDER BY topic) AS no FROM k WHERE kind IS NOT NULL)
SELECT rule, kind, topic, CASE WHEN kind = 'image' THEN 'cam_' || no || CASE WHEN contains(topic, 'left') THEN '_left' WHEN contains(topic, 'right') THEN '_right' WHEN contains(topic, 'head') THEN '_head' ELSE '' END END AS cam_name,
 CASE WHEN kind = 'state' THEN 'joint_1,joint_2,joint_3,joint_4,joint_5,joint_6,joint_7' END AS names,
 CASE WHEN kind = 'state' THEN 0 END AS range_from, CASE WHEN kind = 'state' THEN 7 END AS range_to FROM n""",
)
def _infer(t: Tables) -> DataFrame:
    rest = F.col("episode_id") % 3
    kind = (
        F.when(F.col("topic").contains("rgb") & (rest == 1), "sensor_msgs/CompressedImage")
        .when(F.col("topic").contains("imu") & (rest == 2), "sensor_msgs/JointState")
        .otherwise("other")
    )
    topics = plain(t).select(F.concat("topic", F.lit("_"), rest).alias("topic"), kind.alias("msgtype")).distinct()
    parts = [pf.propose_features(topics, rule=rule).withColumn("rule", F.lit(rule)) for rule in ("dataset", "inspect", "by_type")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("names", F.array_join("names", ","))


@query(
    "frames_by_rowcount",
    """SELECT 'frames' AS source, l_orderkey % 20 AS dataset_id, l_orderkey AS episode, count(*) AS n_frames FROM lineitem GROUP BY 1, 2, 3
UNION ALL SELECT 'turns', conv_id % 5, conv_id, count(*) FROM conversations GROUP BY 1, 2, 3""",
)
def _rowcount(t: Tables) -> DataFrame:
    lines = t.lineitem.select((F.col("l_orderkey") % 20).alias("dataset_id"), F.col("l_orderkey").alias("episode"))
    turns = t.conversations.select((F.col("conv_id") % 5).alias("dataset_id"), F.col("conv_id").alias("episode"))
    return (
        st.frames_by_rowcount(lines)
        .withColumn("source", F.lit("frames"))
        .unionByName(st.frames_by_rowcount(turns).withColumn("source", F.lit("turns")))
    )


CAMERA_TOPIC = "/camera_head/rgb/compressed"


@query(
    "frames_by_topic",
    f"""WITH {messages_sql()} SELECT episode_id % 10 AS dataset_id, episode_id AS episode, count(*) AS n_frames FROM messages WHERE topic = '{CAMERA_TOPIC}' GROUP BY 1, 2""",
)
def _by_topic(t: Tables) -> DataFrame:
    return st.frames_by_topic(plain(t), CAMERA_TOPIC, F.col("episode_id") % 10)


@query(
    "frames_by_meta",
    """WITH n AS (SELECT o_orderkey % 20 AS dataset_id, o_orderkey, o_custkey % 50 AS n, (row_number() OVER (PARTITION BY o_orderkey % 20 ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders)
SELECT dataset_id, chunk, count(*) AS episodes_in_list, CAST(sum(n) AS BIGINT) AS frames_in_list, string_agg(CAST(n AS VARCHAR), ',' ORDER BY o_orderkey) AS episode_frames_num FROM n GROUP BY 1, 2""",
)
def _by_meta(t: Tables) -> DataFrame:
    return _listed(st.frame_lists(st.frames_by_meta(_episode_meta(t))))


def _episode_meta(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_orderkey") % 20).alias("dataset_id"), F.col("o_orderkey").alias("episode_index"), (F.col("o_custkey") % 50).alias("length")
    )


def _listed(df: DataFrame) -> DataFrame:
    return df.withColumn("episode_frames_num", F.array_join(F.col("episode_frames_num").cast("array<string>"), ","))


@query(
    "dataset_frame_lists",
    f"""WITH {messages_sql()}, {IMAGES_SQL}, reg AS (SELECT s_suppkey AS dataset_id, n_name AS device_model, n_nationkey % 5 AS layout FROM supplier JOIN nation ON n_nationkey = s_nationkey),
c AS (SELECT 0 AS layout, l_suppkey AS dataset_id, l_orderkey AS ep, '' AS ep_s, count(*) AS n FROM lineitem GROUP BY 1, 2, 3
  UNION ALL SELECT 1, doc_id % 10, 0, regexp_extract(path, '^(.*?/episode[^/]*)/', 1), count(*) FROM images GROUP BY 1, 2, 3, 4
  UNION ALL SELECT 2, episode_id % 10, episode_id, '', count(*) FROM messages WHERE topic = '{CAMERA_TOPIC}' GROUP BY 1, 2, 3
  UNION ALL SELECT 3, o_orderkey % 20, o_orderkey, '', o_custkey % 50 FROM orders),
k AS (SELECT *, regexp_replace(regexp_replace(ep_s, '([0-9]+)', '0000000000\\1', 'g'), '[0-9]*([0-9]{{10}})', '\\1', 'g') AS key FROM c),
j AS (SELECT r.dataset_id, ep, key, n, (row_number() OVER (PARTITION BY r.dataset_id ORDER BY ep, key) - 1) // 1000 AS chunk FROM reg r JOIN k ON k.dataset_id = r.dataset_id AND k.layout = r.layout),
l AS (SELECT dataset_id, chunk, string_agg(CAST(n AS VARCHAR), ',' ORDER BY ep, key) AS episode_frames_num, count(*) AS episodes_in_list, CAST(sum(n) AS BIGINT) AS frames_in_list FROM j GROUP BY 1, 2)
SELECT r.dataset_id, device_model, chunk, coalesce(episode_frames_num, '') AS episode_frames_num, episodes_in_list, frames_in_list,
 CAST(sum(episodes_in_list) OVER (PARTITION BY r.dataset_id) AS BIGINT) AS episodes_num, CAST(sum(frames_in_list) OVER (PARTITION BY r.dataset_id) AS BIGINT) AS frames_num FROM reg r LEFT JOIN l USING (dataset_id)""",
)
def _frame_lists(t: Tables) -> DataFrame:
    registry = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("s_suppkey").alias("dataset_id"), F.col("n_name").alias("device_model")
    )
    layouts = {f"NATION_{i}": ["rows", "images", "topic", "meta"][i % 5] for i in range(25) if i % 5 < 4}
    lines = t.lineitem.select(F.col("l_suppkey").alias("dataset_id"), F.col("l_orderkey").alias("episode"))
    images = image_listing(t).select((F.col("doc_id") % 10).alias("dataset_id"), "path")
    counters = {
        "rows": st.frames_by_rowcount(lines),
        "images": pt.frames_by_images(images),
        "topic": st.frames_by_topic(plain(t), CAMERA_TOPIC, F.col("episode_id") % 10),
        "meta": st.frames_by_meta(_episode_meta(t)),
    }
    return _listed(st.dataset_frame_lists(registry, layouts, counters))


_LABEL_SQL = """CASE WHEN c < 1000 THEN '<1K' WHEN c < 10000 THEN '1K-10K' WHEN c < 100000 THEN '10K-100K' WHEN c < 1000000 THEN '100K-1M' WHEN c < 10000000 THEN '1M-10M'
 WHEN c < 100000000 THEN '10M-100M' WHEN c < 1000000000 THEN '100M-1B' WHEN c < 10000000000 THEN '1B-10B' WHEN c < 100000000000 THEN '10B-100B' WHEN c < 1000000000000 THEN '100B-1T' ELSE '>1T' END"""


@query(
    "size_label",
    f"""WITH s AS (SELECT o_orderkey, CAST(pow(10, o_orderkey % 13) AS BIGINT) * (1 + o_custkey % 9) - o_custkey % 2 AS c FROM orders)
SELECT o_orderkey, c AS frames, {_LABEL_SQL} AS size_label FROM s""",
)
def _size(t: Tables) -> DataFrame:
    frames = F.expr("cast(pow(10, o_orderkey % 13) as bigint) * (1 + o_custkey % 9) - o_custkey % 2").alias("frames")
    return t.orders.select("o_orderkey", frames).withColumn("size_label", st.size_label(F.col("frames")))


@query(
    "subtasks_distinct",
    """WITH w AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS label FROM documents),
d AS (SELECT DISTINCT doc_id, label FROM w WHERE label NOT IN ('end', 'abnormal', ''))
SELECT doc_id, string_agg(label, chr(10) ORDER BY label) AS sub_tasks FROM d GROUP BY 1""",
)
def _subtasks(t: Tables) -> DataFrame:
    """Words of the lines of a document as labels of the parts of a video."""
    words = "filter(split(line, ' '), w -> w <> '')"
    annotation = f"named_struct('videoLabels', transform(split(text, '\\n'), line -> named_struct('timelinelabels', {words})))"
    return st.subtasks(t.documents.select("doc_id", F.expr(annotation).alias("annotation")), "doc_id")


@query(
    "device_list",
    """SELECT DISTINCT n_name AS device_model FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION SELECT DISTINCT 'region_' || n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
)
def _devices(t: Tables) -> DataFrame:
    joined = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    models = F.array("n_name", F.concat(F.lit("region_"), F.col("n_regionkey")))
    return st.device_list(joined.select(models.alias("device_model")))


@query(
    "bad_field_reject",
    """SELECT d.doc_id, CASE WHEN l.quality IS NULL OR t.role IS NULL THEN 'missing ' || concat_ws(', ', CASE WHEN l.quality IS NULL THEN 'quality' END, CASE WHEN t.role IS NULL THEN 'role' END) END AS reject_reason
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT conv_id AS doc_id, min(role) AS role FROM conversations GROUP BY 1) t USING (doc_id)""",
)
def _reject(t: Tables) -> DataFrame:
    roles = t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.min("role").alias("role"))
    records = t.documents.select("doc_id").join(t.labels, "doc_id", "left").join(roles, "doc_id", "left")
    return pf.mark_rejects(records, ["quality", "role"]).select("doc_id", "reject_reason")


@query(
    "subdir_select",
    """SELECT 'all' AS mode, s_name FROM supplier WHERE s_name NOT IN ('Supplier#000000001', 'Supplier#000000003')
UNION ALL SELECT 'listed', s_name FROM supplier WHERE s_name IN ('Supplier#000000002', 'Supplier#000000005')""",
)
def _subdirs(t: Tables) -> DataFrame:
    names = t.supplier.select("s_name")
    ignored = ["Supplier#000000001", "Supplier#000000003"]
    everything = pt.select_subdirs(names, "s_name", None, ignored).withColumn("mode", F.lit("all"))
    wanted = ["Supplier#000000002", "Supplier#000000003", "Supplier#000000005", "not there"]
    return everything.unionByName(pt.select_subdirs(names, "s_name", wanted, ignored).withColumn("mode", F.lit("listed")))
