"""The driver tables seen as trajectory data, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split, number_rows, plan_split
from kinetable.plans.registry import Tables
from kinetable.sources.messages import load_messages

# fixed values: topic that stands for each event type
TOPICS = {
    "click": "/camera_head/rgb/compressed",
    "view": "/camera_wrist_left/color/image",
    "purchase": "/feedback_arm_left/joint",
    "signup": "/imu_chassis",
    "error": "/motion_target/cmd",
}
MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)"

_TOPIC_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOPICS.items()) + " END"


def topic_col() -> Column:
    return F.expr(_TOPIC_CASE)


def messages(t: Tables, scale: int = 6000, payload: tuple[str, ...] = ()) -> tuple[DataFrame, Split]:
    """Events as topic messages: episode = user, ts_ns = microseconds div scale.

    The number is by (ts_ns, event_id); dividing keeps the order of ts, so seq is by (ts, event_id)
    but for equal quotients.
    """
    return load_messages(
        t.events, F.col("user_id"), topic_col(), F.expr(f"({MICROS}) div {scale}"), F.col("event_id"), payload
    )


def messages_q(t: Tables) -> tuple[DataFrame, Split]:
    """Messages on a 20 ms grid: zero gaps and equal distances occur."""
    df, split = messages(t)
    return df.withColumn("ts_ns", F.expr("(ts_ns div 20000000) * 20000000")), split


_FACTOR = """CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
 WHEN 'signup' THEN CASE WHEN {user} % 3 = 0 THEN 2 ELSE 4 END
 ELSE CASE {user} % 4 WHEN 0 THEN 25 WHEN 1 THEN 12 ELSE 2 END END"""


def messages_r(t: Tables) -> tuple[DataFrame, Split]:
    """Messages at regular rates that reach every class of the timing rules."""
    numbered, split = load_messages(
        t.events, F.col("user_id"), topic_col(), F.expr(f"({MICROS}) div 6000"), F.col("event_id"), ("event_id", "event_type")
    )
    ts = F.expr(f"(seq * 33 + (event_id % 7) * (episode_id % 6)) * 1000000 * ({_FACTOR.format(user='episode_id')})")
    return numbered.select("episode_id", "topic", "seq", ts.cast("long").alias("ts_ns")), split


def messages_sql(scale: int = 6000) -> str:
    """CTE ``messages``; start a query with ``WITH`` + this."""
    return f"""messages_base AS (
  SELECT user_id AS episode_id, {_TOPIC_CASE} AS topic, event_id, event_type, value,
    CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // {scale} AS BIGINT) AS ts_ns
  FROM events),
messages AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY episode_id, topic ORDER BY ts_ns, event_id) - 1 AS BIGINT) AS seq
  FROM messages_base)"""


def messages_q_sql() -> str:
    return messages_sql().replace("messages AS (", "messages_v AS (") + """,
messages AS (SELECT * REPLACE ((ts_ns // 20000000) * 20000000 AS ts_ns) FROM messages_v)"""


def messages_r_sql() -> str:
    return messages_sql().replace("messages AS (", "messages_v AS (") + f""",
messages AS (SELECT * REPLACE (CAST((seq * 33 + (event_id % 7) * (episode_id % 6)) * 1000000
  * ({_FACTOR.format(user='episode_id')}) AS BIGINT) AS ts_ns) FROM messages_v)"""


FRAME_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def frames(t: Tables) -> DataFrame:
    """Line items as frames: episode = order, four-element state, two-element action."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("episode_index"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )
    split = plan_split(lines, ["episode_index"], FRAME_ORDER, stored=True)
    return (
        number_rows(lines, ["episode_index"], FRAME_ORDER, "frame_index", split=split)
        .withColumn("dataset_id", F.col("episode_index") % 20)
        .withColumn("state", F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
        .withColumn("action", F.array("l_quantity", "l_tax"))
    )


def frames_with_task(t: Tables) -> DataFrame:
    tasks = t.orders.select(F.col("o_orderkey").alias("episode_index"), (F.col("o_custkey") % 3).alias("task_index"))
    return frames(t).join(tasks, "episode_index")


FRAMES_SQL = """frames AS (
  SELECT l_orderkey AS episode_index, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_orderkey % 20 AS dataset_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS frame_index
  FROM lineitem)"""
FRAMES_TASK_SQL = FRAMES_SQL + """,
frames_t AS (SELECT f.*, o.o_custkey % 3 AS task_index FROM frames f JOIN orders o ON o.o_orderkey = f.episode_index)"""
