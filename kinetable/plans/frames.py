"""Queries of the frame and episode operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.operators import frames as fr
from kinetable.operators.ordered import number_rows
from kinetable.operators.stats import dataset_totals
from kinetable.plans.registry import Tables, query, rounded
from kinetable.plans.standin import FRAMES_SQL, FRAMES_TASK_SQL, frames
from kinetable.session import staged

FPS = 30


@query(
    "frame_assemble",
    f"""WITH {FRAMES_SQL} SELECT episode_index, frame_index, l_quantity AS s0, l_extendedprice AS s1, l_discount AS s2, l_tax AS s3,
 l_quantity AS a0, l_tax AS a1, 'cam_' || (l_partkey % 3) || '/' || frame_index || '.jpg' AS image FROM frames WHERE l_partkey % 7 > 0""",
)
def _assemble(t: Tables) -> DataFrame:
    # numbered once; the three sources are stored tables
    df = staged(frames(t).select("episode_index", "frame_index", "l_partkey", "state", "action"), "frames")
    key = ["episode_index", "frame_index"]
    images = df.where(F.col("l_partkey") % 7 > 0).select(
        *key, F.concat(F.lit("cam_"), F.col("l_partkey") % 3, F.lit("/"), F.col("frame_index"), F.lit(".jpg")).alias("image")
    )
    joined = fr.assemble_frames([images, df.select(*key, "state"), df.select(*key, "action")])
    return joined.select(
        *key,
        *[F.col("state")[i].alias(f"s{i}") for i in range(4)],
        *[F.col("action")[i].alias(f"a{i}") for i in range(2)],
        "image",
    )


@query(
    "frame_bounds_check",
    f"""WITH {FRAMES_SQL}, need AS (SELECT episode_index, max(frame_index) + 1 AS n FROM frames GROUP BY 1),
topics AS (SELECT unnest(['cam_0', 'cam_1', 'cam_9']) AS topic),
have AS (SELECT l_orderkey AS episode_index, 'cam_' || (l_partkey % 2) AS topic, count(*) AS available FROM lineitem GROUP BY 1, 2),
short AS (SELECT n.episode_index, t.topic, n.n, coalesce(h.available, 0) AS available FROM need n CROSS JOIN topics t
  LEFT JOIN have h ON h.episode_index = n.episode_index AND h.topic = t.topic)
SELECT episode_index, topic, f.frame_index, available FROM short JOIN frames f USING (episode_index) WHERE f.frame_index >= available""",
)
def _bounds(t: Tables) -> DataFrame:
    df = frames(t)
    sources = t.lineitem.select(
        F.col("l_orderkey").alias("episode_index"), F.concat(F.lit("cam_"), F.col("l_partkey") % 2).alias("topic")
    )
    return fr.frame_shortfall(df.select("episode_index", "frame_index"), sources, ["cam_0", "cam_1", "cam_9"])


@query(
    "episode_numbering",
    f"""WITH {FRAMES_TASK_SQL}, e AS (SELECT DISTINCT task_index, episode_index FROM frames_t)
SELECT task_index, episode_index, CAST(row_number() OVER (ORDER BY task_index, episode_index) - 1 AS BIGINT) AS global_episode,
  CAST(row_number() OVER (PARTITION BY task_index ORDER BY episode_index) - 1 AS BIGINT) AS task_episode FROM e""",
)
def _numbering(t: Tables) -> DataFrame:
    # only the episode keys are needed, so no frame is numbered here
    episodes = (
        t.lineitem.select(F.col("l_orderkey").alias("episode_index"))
        .distinct()
        .join(t.orders.select(F.col("o_orderkey").alias("episode_index"), (F.col("o_custkey") % 3).alias("task_index")), "episode_index")
    )
    numbered = number_rows(staged(episodes, "episodes"), ["task_index"], ["episode_index"], "task_episode", stored=True)
    return fr.number_episodes(numbered, "task_index", ["episode_index"])


@query(
    "frame_index_cols",
    f"""WITH {FRAMES_SQL}, len AS (SELECT episode_index, count(*) AS n FROM frames GROUP BY 1),
off AS (SELECT episode_index, n, coalesce(sum(n) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM len)
SELECT episode_index, frame_index, l_partkey, round(CAST(frame_index / 30 AS FLOAT)::DOUBLE, 5) AS timestamp,
  CAST(o + frame_index AS BIGINT) AS index, frame_index = n - 1 AS next_done FROM frames JOIN off USING (episode_index)""",
)
def _index(t: Tables) -> DataFrame:
    out = fr.add_frame_columns(frames(t).select("episode_index", "frame_index", "l_partkey"), FPS)
    return rounded(out, timestamp=5)


@query(
    "action_offset",
    f"""WITH {FRAMES_SQL}, g AS (SELECT * FROM frames WHERE frame_index % 4 <> 2)
SELECT g.episode_index, g.frame_index, g.l_quantity AS a0, n.l_quantity AS o0, n.l_tax AS o1
FROM g JOIN g n ON n.episode_index = g.episode_index AND n.frame_index = g.frame_index + 2""",
)
def _offset(t: Tables) -> DataFrame:
    """Frames with gaps: every fourth is left out."""
    gaps = frames(t).select("episode_index", "frame_index", "action").where(F.col("frame_index") % 4 != 2)
    out = fr.offset_action(gaps, 2)
    return out.select(
        "episode_index",
        "frame_index",
        F.col("action")[0].alias("a0"),
        F.col("offset_action")[0].alias("o0"),
        F.col("offset_action")[1].alias("o1"),
    )


@query(
    "frame_nearest_image",
    f"""WITH {FRAMES_SQL}, img AS (SELECT episode_index, frame_index AS f, l_partkey FROM frames WHERE frame_index % 3 = 0),
c AS (SELECT f.episode_index, f.frame_index, i.f, i.l_partkey, row_number() OVER (PARTITION BY f.episode_index, f.frame_index
  ORDER BY abs(i.f - f.frame_index), i.f) AS rn FROM frames f JOIN img i USING (episode_index))
SELECT episode_index, frame_index, f AS image_frame_index, l_partkey AS image_l_partkey FROM c WHERE rn = 1""",
)
def _nearest_image(t: Tables) -> DataFrame:
    df = frames(t).select("episode_index", "frame_index", "l_partkey")
    images = df.where(F.col("frame_index") % 3 == 0)
    return fr.nearest_image(df.select("episode_index", "frame_index"), images, ["l_partkey"])


@query(
    "dataset_totals",
    f"""WITH {FRAMES_TASK_SQL} SELECT dataset_id, count(DISTINCT episode_index) AS episodes_num, count(*) AS frames_num,
  coalesce((SELECT string_agg('task ' || t, chr(10) ORDER BY t) FROM (SELECT DISTINCT task_index AS t FROM frames_t g WHERE g.dataset_id = f.dataset_id AND episode_index % 7 <> 3)), '') AS tasks
FROM frames_t f GROUP BY 1""",
)
def _totals(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("episode_index"), (F.col("l_orderkey") % 20).alias("dataset_id"))
    # some episodes have no task row
    tasks = t.orders.where("o_orderkey % 7 <> 3").select(F.col("o_orderkey").alias("episode_index"), (F.col("o_custkey") % 3).alias("task_index"))
    return dataset_totals(rows, tasks, F.concat(F.lit("task "), F.col("task_index")))
