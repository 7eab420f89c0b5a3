"""Queries of the timing and alignment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.operators import align as al
from kinetable.operators import moments as mo
from kinetable.operators import timing as tm
from kinetable.operators.convert import convert_recordings
from kinetable.operators.ordered import Split
from kinetable.plans.registry import Tables, query, r6, rounded
from kinetable.plans.standin import messages, messages_q, messages_q_sql, messages_r, messages_r_sql, messages_sql
from kinetable.session import scratch_dir

GAPS_SQL = """gaps AS (
  SELECT *, ts_ns - lag(ts_ns) OVER (PARTITION BY episode_id, topic ORDER BY seq) AS gap_ns FROM messages)"""
TIMING_SQL = GAPS_SQL + """,
timing AS (
  SELECT episode_id, topic, count(*) AS n, min(ts_ns) AS first_ts, (max(ts_ns) - min(ts_ns)) / 1e9 AS span_s,
    CASE WHEN max(ts_ns) > min(ts_ns) THEN count(*) / ((max(ts_ns) - min(ts_ns)) / 1e9) ELSE 0.0 END AS rate_hz,
    coalesce(stddev_pop(CASE WHEN gap_ns > 0 THEN 1e9 / gap_ns END), 0.0) AS rate_std_hz,
    coalesce(min(gap_ns / 1e6), 0.0) AS min_gap_ms, coalesce(max(gap_ns / 1e6), 0.0) AS max_gap_ms,
    coalesce(sum(gap_ns) / count(gap_ns) / 1e6, 0.0) AS gap_mean_ms, coalesce(stddev_pop(gap_ns / 1e6), 0.0) AS gap_std_ms
  FROM gaps GROUP BY 1, 2)"""
SCORES_SQL = TIMING_SQL + """,
stable AS (
  SELECT *, CASE WHEN rate_hz > 0 THEN greatest(0.0, 1 - rate_std_hz / rate_hz) ELSE 0.0 END AS stability,
    CASE WHEN n > 1 AND gap_mean_ms > 0 THEN greatest(0.0, 1 - gap_std_ms / gap_mean_ms) ELSE 0.0 END AS uniformity,
    CASE WHEN contains(lower(topic), 'rgb') THEN 6 WHEN contains(lower(topic), 'color') THEN 5
      WHEN contains(lower(topic), 'image') THEN 4 WHEN contains(lower(topic), 'camera') THEN 3
      WHEN contains(lower(topic), 'compressed') THEN 2 WHEN contains(lower(topic), 'depth') THEN 1 ELSE 0 END AS keyword
  FROM timing),
scores AS (
  SELECT *, (stability + uniformity) / 2 AS topic_score,
    keyword * 0.5 + stability * 0.3 + least(1.0, n / 1000) * 0.2 AS base_score
  FROM stable)"""


@query(
    "messages_load",
    f"WITH {messages_sql()} SELECT episode_id, topic, seq, ts_ns, value FROM messages",
)
def _load(t: Tables) -> DataFrame:
    return messages(t, payload=("value",))[0]


@query(
    "message_gaps",
    f"""WITH {messages_sql()}, {GAPS_SQL}
SELECT episode_id, topic, seq, gap_ns, round(gap_ns / 1e6, 6) AS gap_ms FROM gaps""",
)
def _gaps(t: Tables) -> DataFrame:
    return rounded(tm.message_gaps(*messages(t)).select("episode_id", "topic", "seq", "gap_ns", "gap_ms"), gap_ms=6)


_TIMING_OUT = """SELECT episode_id, topic, n, round(span_s, 6) AS span_s, round(rate_hz, 3) AS rate_hz,
  round(rate_std_hz, 2) AS rate_std_hz, round(min_gap_ms, 6) AS min_gap_ms, round(max_gap_ms, 6) AS max_gap_ms FROM timing"""


def _timing_out(timing: DataFrame) -> DataFrame:
    return rounded(
        timing.select("episode_id", "topic", "n", "span_s", "rate_hz", "rate_std_hz", "min_gap_ms", "max_gap_ms"),
        span_s=6,
        rate_hz=3,
        rate_std_hz=2,
        min_gap_ms=6,
        max_gap_ms=6,
    )


@query("topic_timing", f"WITH {messages_sql()}, {TIMING_SQL} {_TIMING_OUT}")
def _timing(t: Tables) -> DataFrame:
    return _timing_out(tm.topic_timing(*messages(t)))


@query("topic_timing_zero_gaps", f"WITH {messages_q_sql()}, {TIMING_SQL} {_TIMING_OUT}")
def _timing_q(t: Tables) -> DataFrame:
    return _timing_out(tm.topic_timing(*messages_q(t)))


def _recordings(t: Tables, load, label: str) -> DataFrame:
    """Timing from three recordings, each added on its own: before, within and after the middle third of the time."""
    rows, _ = load(t)
    edges = rows.agg(F.min("ts_ns").alias("low"), F.max("ts_ns").alias("high")).first()
    store = mo.TimingStore(t.spark, scratch_dir(t.spark, label) + "/states")
    low, high = edges["low"] or 0, edges["high"] or 0
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 1]
    for i, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
        store.add(f"part{i}", rows.where((F.col("ts_ns") >= start) & (F.col("ts_ns") < stop)))
    return store.timing()


@query("topic_timing_merged", f"WITH {messages_sql()}, {TIMING_SQL} {_TIMING_OUT}")
def _timing_merged(t: Tables) -> DataFrame:
    return _timing_out(_recordings(t, messages, "timing-states"))


@query(
    "sync_quality_merged",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}
SELECT episode_id, round(avg(topic_score), 6) AS score, count(*) AS topics FROM scores GROUP BY 1""",
)
def _quality_merged(t: Tables) -> DataFrame:
    return rounded(tm.sync_quality(_recordings(t, messages_r, "quality-states")), score=6)


@query(
    "sync_quality",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}
SELECT episode_id, round(avg(topic_score), 6) AS score, count(*) AS topics FROM scores GROUP BY 1""",
)
def _quality(t: Tables) -> DataFrame:
    return rounded(tm.sync_quality(tm.topic_timing(*messages_r(t))), score=6)


@query(
    "data_loss",
    f"""WITH {messages_sql()}, c AS (SELECT episode_id, topic, count(*) AS n FROM messages GROUP BY 1, 2)
SELECT episode_id, CAST(sum(n) AS BIGINT) AS messages, min(n) * count(*) AS kept,
  round((sum(n) - min(n) * count(*)) / sum(n), 6) AS data_loss FROM c GROUP BY 1""",
)
def _loss(t: Tables) -> DataFrame:
    # needs counts only: no seq, no gaps
    return rounded(tm.data_loss(al.topic_counts(_plain(t))), data_loss=6)


def _plain(t: Tables) -> DataFrame:
    """Messages without a number, for operators that only count."""
    from kinetable.plans.standin import MICROS, topic_col

    return t.events.select(
        F.col("user_id").alias("episode_id"),
        topic_col().alias("topic"),
        F.expr(f"({MICROS}) div 6000").alias("ts_ns"),
        "event_id",
    )


_FEASIBLE = """feasible AS (
  SELECT episode_id, max(CASE WHEN rate_hz > 0 THEN rate_hz END) / min(CASE WHEN rate_hz > 0 THEN rate_hz END) AS rate_ratio,
    avg(topic_score) AS score, (sum(n) - min(n) * count(*)) / sum(n) AS data_loss FROM scores GROUP BY 1),
labelled AS (
  SELECT *, CASE WHEN rate_ratio <= 2 THEN 'excellent' WHEN rate_ratio <= 5 THEN 'good' WHEN rate_ratio <= 20 THEN 'poor'
    ELSE 'impossible' END AS feasibility,
    CASE WHEN score > 0.8 THEN 'interpolation' WHEN score > 0.5 THEN 'nearest_neighbor' ELSE 'emergency' END AS strategy
  FROM feasible)"""


@query(
    "align_feasibility",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}, {_FEASIBLE}
SELECT episode_id, round(rate_ratio, 6) AS rate_ratio, feasibility FROM labelled""",
)
def _feasibility(t: Tables) -> DataFrame:
    return rounded(tm.align_feasibility(tm.topic_timing(*messages_r(t))), rate_ratio=6)


@query(
    "align_strategy",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}, {_FEASIBLE}
SELECT episode_id, round(score, 6) AS score, strategy FROM labelled""",
)
def _strategy(t: Tables) -> DataFrame:
    return rounded(tm.align_strategy(tm.topic_timing(*messages_r(t))), score=6)


_ISSUES = """flags AS (
  SELECT *, rate_hz > 0 AND rate_std_hz / nullif(rate_hz, 0) > 0.5 AS unstable, n < 10 AS sparse,
    n > 1 AND max_gap_ms > 1000 AS gappy FROM scores),
numbered AS (
  SELECT *, sum(CAST(unstable AS INT)) OVER w AS u_no, sum(CAST(sparse AS INT)) OVER w AS s_no, sum(CAST(gappy AS INT)) OVER w AS g_no,
    row_number() OVER (PARTITION BY episode_id ORDER BY base_score DESC, first_ts, topic) AS rank
  FROM flags WINDOW w AS (PARTITION BY episode_id ORDER BY first_ts, topic ROWS UNBOUNDED PRECEDING)),
named AS (
  SELECT episode_id,
    string_agg(topic, ', ' ORDER BY u_no) FILTER (WHERE unstable AND u_no <= 3) AS u,
    string_agg(topic, ', ' ORDER BY s_no) FILTER (WHERE sparse AND s_no <= 3) AS s,
    string_agg(topic, ', ' ORDER BY g_no) FILTER (WHERE gappy AND g_no <= 3) AS g,
    string_agg(topic, ', ' ORDER BY rank) FILTER (WHERE rank <= 3) AS base_topics
  FROM numbered GROUP BY 1),
report AS (
  SELECT l.*, base_topics, concat_ws(' | ',
    CASE WHEN rate_ratio > 10 THEN 'Extreme frequency differences (ratio: ' || printf('%.1f', round(rate_ratio, 1)) || 'x)'
         WHEN rate_ratio > 5 THEN 'High frequency differences (ratio: ' || printf('%.1f', round(rate_ratio, 1)) || 'x)' END,
    'Unstable frequencies in topics: ' || u, 'Sparse data in topics: ' || s, 'Large time gaps in topics: ' || g) AS issues
  FROM labelled l JOIN named USING (episode_id))"""


def _report(df: DataFrame, split: Split) -> DataFrame:
    return tm.sync_report(tm.topic_timing(df, split)).withColumn("issues", F.array_join("issues", " | "))


@query("sync_issues", f"WITH {messages_r_sql()}, {SCORES_SQL}, {_FEASIBLE}, {_ISSUES} SELECT episode_id, issues FROM report")
def _issues(t: Tables) -> DataFrame:
    return _report(*messages_r(t)).select("episode_id", "issues")


@query(
    "sync_report",
    f"""WITH {messages_sql(60)}, {SCORES_SQL}, {_FEASIBLE}, {_ISSUES}
SELECT episode_id, round(score, 6) AS score, feasibility, strategy, base_topics, issues, round(data_loss, 6) AS data_loss FROM report""",
)
def _sync_report(t: Tables) -> DataFrame:
    report = _report(*messages(t, 60)).withColumn("base_topics", F.array_join("base_topics", ", "))
    return rounded(report, score=6, data_loss=6)


@query(
    "base_topic_rank",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY base_score DESC, first_ts, topic) AS rank FROM scores)
SELECT episode_id, topic, CAST(rank AS BIGINT) AS rank, round(base_score, 6) AS base_score FROM r WHERE rank <= 3""",
)
def _rank(t: Tables) -> DataFrame:
    ranked = tm.rank_base_topics(tm.topic_timing(*messages_r(t)))
    return ranked.select("episode_id", "topic", F.col("rank").cast("long").alias("rank"), r6(F.col("base_score")).alias("base_score"))


_BASE_PICK = """base AS (SELECT episode_id, arg_min(topic, rank) AS base_topic FROM (
  SELECT episode_id, topic, row_number() OVER (PARTITION BY episode_id ORDER BY base_score DESC, first_ts, topic) AS rank FROM scores)
  GROUP BY 1)"""


@query(
    "base_topic_select",
    f"""WITH {messages_sql()}, {SCORES_SQL}, {_BASE_PICK}, wanted AS (
  SELECT DISTINCT episode_id, topic FROM messages WHERE topic = '/imu_chassis' AND episode_id % 2 = 0)
SELECT b.episode_id, coalesce(w.topic, b.base_topic) AS base_topic, b.base_topic AS auto_topic
FROM base b LEFT JOIN wanted w USING (episode_id)""",
)
def _select(t: Tables) -> DataFrame:
    # the named topic exists in even episodes only, so both branches are taken
    timing = tm.topic_timing(*messages(t))
    auto = tm.select_base_topic(timing).select("episode_id", F.col("base_topic").alias("auto_topic"))
    named = timing.where((F.col("topic") != "/imu_chassis") | (F.col("episode_id") % 2 == 0))
    return tm.select_base_topic(named, "/imu_chassis").drop("topics").join(auto, "episode_id")


@query(
    "align_truncate",
    f"""WITH {messages_sql()}, c AS (SELECT episode_id, topic, count(*) AS n FROM messages GROUP BY 1, 2),
k AS (SELECT episode_id, min(n) AS keep FROM c GROUP BY 1)
SELECT episode_id, topic, seq AS frame_index, ts_ns AS src_ts_ns, value FROM messages JOIN k USING (episode_id) WHERE seq < keep""",
)
def _truncate(t: Tables) -> DataFrame:
    return al.align_truncate(messages(t, payload=("value",))[0], ["value"]).drop("src_seq")


@query(
    "align_truncate_loss",
    f"""WITH {messages_sql()}, c AS (SELECT episode_id, topic, count(*) AS n FROM messages GROUP BY 1, 2),
k AS (SELECT episode_id, min(n) AS kept FROM c GROUP BY 1)
SELECT episode_id, topic, n, kept, n - kept AS lost FROM c JOIN k USING (episode_id)""",
)
def _truncate_loss(t: Tables) -> DataFrame:
    return al.truncation_loss(_plain(t))


# two ASOF joins would not settle equal timestamps; one row per time and the two neighbours do
_NEAREST = """base_rows AS (
  SELECT m.episode_id, m.topic AS base_topic, m.seq AS frame_index, m.ts_ns AS base_ts_ns
  FROM messages m JOIN base b ON b.episode_id = m.episode_id AND b.base_topic = m.topic),
topics AS (SELECT DISTINCT episode_id, topic FROM messages),
targets AS (SELECT b.*, t.topic FROM base_rows b JOIN topics t ON t.episode_id = b.episode_id AND t.topic <> b.base_topic),
src AS (SELECT episode_id, topic, ts_ns AS src_ts_ns, min(seq) AS src_seq FROM messages GROUP BY 1, 2, 3),
before AS (SELECT g.*, s.src_ts_ns, s.src_seq FROM targets g ASOF LEFT JOIN src s
  ON s.episode_id = g.episode_id AND s.topic = g.topic AND s.src_ts_ns <= g.base_ts_ns),
around AS (SELECT b.*, s.src_ts_ns AS next_ts, s.src_seq AS next_seq FROM before b ASOF LEFT JOIN src s
  ON s.episode_id = b.episode_id AND s.topic = b.topic AND s.src_ts_ns >= b.base_ts_ns),
picked AS (SELECT episode_id, topic, frame_index, base_ts_ns,
  (next_ts IS NULL OR (src_ts_ns IS NOT NULL AND base_ts_ns - src_ts_ns <= next_ts - base_ts_ns)) AS use_before,
  src_ts_ns, src_seq, next_ts, next_seq FROM around),
aligned AS (
  SELECT episode_id, topic, frame_index, base_ts_ns, CASE WHEN use_before THEN src_seq ELSE next_seq END AS src_seq,
    CASE WHEN use_before THEN src_ts_ns ELSE next_ts END AS src_ts_ns, false AS is_base FROM picked
  UNION ALL SELECT episode_id, base_topic, frame_index, base_ts_ns, frame_index, base_ts_ns, true FROM base_rows),
matched AS (SELECT *, abs(src_ts_ns - base_ts_ns) / 1e6 AS time_diff_ms FROM aligned)"""
_NEAREST_OUT = """SELECT episode_id, topic, frame_index, base_ts_ns, src_seq, src_ts_ns, round(time_diff_ms, 6) AS time_diff_ms,
  time_diff_ms > 20 AND time_diff_ms <= 50 AS over_warn, time_diff_ms > 50 AS over_max FROM matched"""


def _nearest_out(aligned: DataFrame) -> DataFrame:
    return rounded(aligned.drop("is_base"), time_diff_ms=6)


@query("align_nearest", f"WITH {messages_sql()}, {SCORES_SQL}, {_BASE_PICK}, {_NEAREST} {_NEAREST_OUT}")
def _nearest(t: Tables) -> DataFrame:
    df, split = messages(t)
    return _nearest_out(al.align_nearest(df, split=split))


_FIXED_BASE = "base AS (SELECT DISTINCT episode_id, topic AS base_topic FROM messages WHERE topic = '/camera_head/rgb/compressed')"


@query("align_nearest_ties", f"WITH {messages_q_sql()}, {_FIXED_BASE}, {_NEAREST} {_NEAREST_OUT}")
def _nearest_q(t: Tables) -> DataFrame:
    df, split = messages_q(t)
    base = df.where(F.col("topic") == "/camera_head/rgb/compressed").select("episode_id", F.col("topic").alias("base_topic")).distinct()
    return _nearest_out(al.align_nearest(df, base, split=split))


_QUALITY = """quality AS (
  SELECT episode_id, topic, count(*) AS frames, sum(abs(src_ts_ns - base_ts_ns)) / count(*) / 1e6 AS mean_diff_ms,
    CASE WHEN bool_and(is_base) THEN 1.0 ELSE greatest(0.0, 1 - sum(abs(src_ts_ns - base_ts_ns)) / count(*) / 1e6 / 50.0) END AS quality,
    count(*) FILTER (WHERE time_diff_ms > 20 AND time_diff_ms <= 50) AS warn_rows,
    count(*) FILTER (WHERE time_diff_ms > 50) AS max_rows FROM matched GROUP BY 1, 2)"""


@query(
    "align_quality",
    f"""WITH {messages_sql()}, {SCORES_SQL}, {_BASE_PICK}, {_NEAREST}, {_QUALITY}
SELECT episode_id, topic, frames, round(mean_diff_ms + 1e-9, 6) AS mean_diff_ms, round(quality + 1e-9, 6) AS quality, warn_rows, max_rows,
  quality < 0.8 AS low_quality FROM quality""",
)
def _align_quality(t: Tables) -> DataFrame:
    df, split = messages(t)
    quality = al.align_quality(al.align_nearest(df, split=split))
    # a hair above, so that exact halves round alike in both engines
    nudged = quality.withColumns({c: F.col(c) + F.lit(1e-9) for c in ("mean_diff_ms", "quality")})
    return rounded(nudged, mean_diff_ms=6, quality=6)


@query(
    "align_presets",
    f"""WITH {messages_r_sql()}, {SCORES_SQL}, {_BASE_PICK}, {_NEAREST}, {_QUALITY},
good AS (SELECT episode_id FROM quality GROUP BY 1 HAVING avg(quality) >= 0.9),
c AS (SELECT episode_id, topic, count(*) AS n FROM messages GROUP BY 1, 2), k AS (SELECT episode_id, min(n) AS keep FROM c GROUP BY 1)
SELECT 'production' AS preset, episode_id, topic, frame_index, src_seq, src_ts_ns FROM matched WHERE episode_id IN (SELECT episode_id FROM good)
UNION ALL SELECT 'robot', episode_id, topic, frame_index, src_seq, src_ts_ns FROM matched
UNION ALL SELECT 'emergency', episode_id, topic, seq, seq, ts_ns FROM messages JOIN k USING (episode_id) WHERE seq < keep""",
)
def _presets(t: Tables) -> DataFrame:
    df, split = messages_r(t)
    return al.align_presets(df, {"production": True, "robot": False, "emergency": False}, split=split)


def recording_config() -> dict:
    """Two cameras, a state of two topics with a conversion, an action one frame later."""
    joint = {"topic_name": "/feedback_arm_left/joint", "range_from": 0, "range_to": 2}
    return {
        "features": {
            "observation": {
                "images": [
                    {"cam_name": "head", "args": {"topic_name": "/camera_head/rgb/compressed"}},
                    {"cam_name": "wrist", "args": {"topic_name": "/camera_wrist_left/color/image"}},
                ],
                "state": {
                    "sub_state": [
                        {"names": ["j1", "j2"], "args": joint, "convert_func": "degree2rad"},
                        {"names": ["imu"], "args": {"topic_name": "/imu_chassis", "range_from": 1, "range_to": 2}},
                    ]
                },
            },
            "action": {
                "timeline_offset": 1,
                "sub_action": [{"names": ["cmd"], "args": {"topic_name": "/motion_target/cmd", "range_from": 0, "range_to": 1}}],
            },
        }
    }


@query(
    "convert_recordings",
    f"""WITH {messages_sql()}, {SCORES_SQL}, {_BASE_PICK}, {_NEAREST}, v AS (
  SELECT a.episode_id, a.topic, a.frame_index, a.src_seq, a.src_ts_ns, m.value, CAST(m.seq AS DOUBLE) AS no
  FROM matched a JOIN messages m ON m.episode_id = a.episode_id AND m.topic = a.topic AND m.seq = a.src_seq),
p AS (SELECT episode_id, frame_index, max(value) FILTER (WHERE topic = '/feedback_arm_left/joint') AS jv, max(no) FILTER (WHERE topic = '/feedback_arm_left/joint') AS jn,
  max(no) FILTER (WHERE topic = '/imu_chassis') AS imu, max(value) FILTER (WHERE topic = '/motion_target/cmd') AS cmd,
  max(src_seq) FILTER (WHERE topic = '/camera_head/rgb/compressed') AS head_seq, max(src_ts_ns) FILTER (WHERE topic = '/camera_wrist_left/color/image') AS wrist_ts FROM v GROUP BY 1, 2),
full_rows AS (SELECT * FROM p WHERE jv IS NOT NULL AND imu IS NOT NULL AND cmd IS NOT NULL AND head_seq IS NOT NULL AND wrist_ts IS NOT NULL),
o AS (SELECT f.*, n.cmd AS next_cmd FROM full_rows f JOIN full_rows n ON n.episode_id = f.episode_id AND n.frame_index = f.frame_index + 1)
SELECT episode_id, frame_index, round(CAST(radians(jv) AS FLOAT)::DOUBLE, 4) AS s0, round(CAST(radians(jn) AS FLOAT)::DOUBLE, 4) AS s1, imu AS s2,
  round(CAST(next_cmd AS FLOAT)::DOUBLE, 2) AS a0, head_seq, wrist_ts FROM o WHERE next_cmd IS NOT NULL""",
)
def _convert(t: Tables) -> DataFrame:
    df, split = messages(t, payload=("value",))
    vectors = df.withColumn("vector", F.array("value", F.col("seq").cast("double")))
    frames = convert_recordings(vectors, recording_config(), split=split)
    return frames.select(
        "episode_id",
        "frame_index",
        *[r6(F.col("observation_state")[i], 4).alias(f"s{i}") for i in range(3)],
        r6(F.col("action")[0], 2).alias("a0"),
        F.col("image_head.src_seq").alias("head_seq"),
        F.col("image_wrist.src_ts_ns").alias("wrist_ts"),
    )
