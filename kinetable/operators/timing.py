"""Timing and synchronisation profile of multi-rate topics.

Input: a messages table (episode, topic, seq, ts_ns) with integer nanoseconds and a dense seq.
Differences are taken on integers; only ratios are floating point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split, plan_split, with_previous

EPISODE, TOPIC, SEQ, TS = "episode_id", "topic", "seq", "ts_ns"

# fixed values: keyword weights for choosing the base topic, first match counts
BASE_KEYWORDS = {"rgb": 6, "color": 5, "image": 4, "camera": 3, "compressed": 2, "depth": 1}
KEYWORD_WEIGHT, STABILITY_WEIGHT, VOLUME_WEIGHT = 0.5, 0.3, 0.2
FULL_VOLUME = 1000
# fixed values: class limits of the rate ratio, of the score and of the issue checks
EXCELLENT_RATIO, GOOD_RATIO, POOR_RATIO = 2, 5, 20
INTERPOLATION_SCORE, NEAREST_SCORE = 0.8, 0.5
EXTREME_RATIO, HIGH_RATIO = 10, 5
UNSTABLE_SHARE, SPARSE_COUNT, LONG_GAP_MS = 0.5, 10, 1000
NAMED_TOPICS = 3


def split_messages(messages: DataFrame, stored: bool = True) -> Split:
    """The split that every operator over this message table can share."""
    return plan_split(messages, [EPISODE], [TS], stored=stored)


def message_gaps(messages: DataFrame, split: Split | None = None, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """Gap to the previous message of the same topic, in integer ns and in ms."""
    split = split or split_messages(messages)
    gaps = with_previous(messages, [EPISODE, TOPIC], order, TS, "_prev_ts", split)
    return (
        gaps.withColumn("gap_ns", F.col(TS) - F.col("_prev_ts"))
        .withColumn("gap_ms", F.col("gap_ns") / F.lit(1e6))
        .drop("_prev_ts")
    )


def topic_timing(messages: DataFrame, split: Split | None = None) -> DataFrame:
    """One row per (episode, topic): count, span, rate, spread of the momentary rate, gap range."""
    # the set of gaps does not depend on the order of equal times, so the sort of the number is reused
    gaps = message_gaps(messages.select(EPISODE, TOPIC, SEQ, TS), split, order=[TS])
    per_topic = gaps.groupBy(EPISODE, TOPIC).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
        F.stddev_pop(F.when(F.col("gap_ns") > 0, F.lit(1e9) / F.col("gap_ns"))).alias("_rate_std"),
        F.min("gap_ms").alias("_min"),
        F.max("gap_ms").alias("_max"),
        # integer sum: the same on every recomputation, whatever the order
        (F.sum("gap_ns") / F.count("gap_ns") / F.lit(1e6)).alias("_mean"),
        F.stddev_pop("gap_ms").alias("_std"),
    )
    span = (F.col("last_ts") - F.col("first_ts")) / F.lit(1e9)

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return per_topic.select(
        EPISODE,
        TOPIC,
        "n",
        "first_ts",
        span.alias("span_s"),
        F.when(span > 0, F.col("n") / span).otherwise(0.0).alias("rate_hz"),
        zero("_rate_std").alias("rate_std_hz"),
        zero("_min").alias("min_gap_ms"),
        zero("_max").alias("max_gap_ms"),
        zero("_mean").alias("gap_mean_ms"),
        zero("_std").alias("gap_std_ms"),
    )


def keyword_score(topic: Column) -> Column:
    """Weight of the first base-topic keyword found in the name."""
    name = F.lower(topic)
    score: Column | None = None
    for word, weight in BASE_KEYWORDS.items():
        hit = name.contains(word)
        score = F.when(hit, weight) if score is None else score.when(hit, weight)
    return score.otherwise(0)


def score_topics(timing: DataFrame) -> DataFrame:
    """Add rate stability, gap uniformity, sync score and base-topic score."""
    stability = F.when(
        F.col("rate_hz") > 0, F.greatest(F.lit(0.0), 1 - F.col("rate_std_hz") / F.col("rate_hz"))
    ).otherwise(0.0)
    uniformity = F.when(
        (F.col("n") > 1) & (F.col("gap_mean_ms") > 0),
        F.greatest(F.lit(0.0), 1 - F.col("gap_std_ms") / F.col("gap_mean_ms")),
    ).otherwise(0.0)
    scored = timing.withColumn("stability", stability).withColumn("uniformity", uniformity)
    return scored.withColumn("topic_score", (F.col("stability") + F.col("uniformity")) / 2).withColumn(
        "base_score",
        keyword_score(F.col(TOPIC)) * KEYWORD_WEIGHT
        + F.col("stability") * STABILITY_WEIGHT
        + F.least(F.lit(1.0), F.col("n") / FULL_VOLUME) * VOLUME_WEIGHT,
    )


def sync_quality(timing: DataFrame) -> DataFrame:
    """Mean topic score per episode."""
    return score_topics(timing).groupBy(EPISODE).agg(F.avg("topic_score").alias("score"), F.count(F.lit(1)).alias("topics"))


def _rate_ratio() -> Column:
    positive = F.when(F.col("rate_hz") > 0, F.col("rate_hz"))
    return F.max(positive) / F.min(positive)


def feasibility_label(ratio: Column) -> Column:
    return (
        F.when(ratio.isNull(), "impossible")
        .when(ratio <= EXCELLENT_RATIO, "excellent")
        .when(ratio <= GOOD_RATIO, "good")
        .when(ratio <= POOR_RATIO, "poor")
        .otherwise("impossible")
    )


def strategy_label(score: Column) -> Column:
    return (
        F.when(score > INTERPOLATION_SCORE, "interpolation")
        .when(score > NEAREST_SCORE, "nearest_neighbor")
        .otherwise("emergency")
    )


def align_feasibility(timing: DataFrame) -> DataFrame:
    """Ratio of the fastest to the slowest topic and its class."""
    return (
        timing.groupBy(EPISODE)
        .agg(_rate_ratio().alias("rate_ratio"))
        .withColumn("feasibility", feasibility_label(F.col("rate_ratio")))
    )


def align_strategy(timing: DataFrame) -> DataFrame:
    """Recommended alignment per episode."""
    return sync_quality(timing).withColumn("strategy", strategy_label(F.col("score"))).select(EPISODE, "score", "strategy")


def data_loss(timing: DataFrame) -> DataFrame:
    """Share of messages lost when every topic is cut to the shortest."""
    return timing.groupBy(EPISODE).agg(
        F.sum("n").alias("messages"),
        (F.min("n") * F.count(F.lit(1))).alias("kept"),
        _loss().alias("data_loss"),
    )


def _loss() -> Column:
    total = F.sum("n")
    return (total - F.min("n") * F.count(F.lit(1))) / total


def rank_base_topics(timing: DataFrame, top: int | None = 3) -> DataFrame:
    """Base-topic candidates by score; equal scores keep first appearance."""
    w = Window.partitionBy(EPISODE).orderBy(F.desc("base_score"), "first_ts", TOPIC)
    ranked = score_topics(timing).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= top) if top else ranked


def select_base_topic(timing: DataFrame, preferred: str | None = None) -> DataFrame:
    """Per episode: the preferred topic if it occurs, else the best scored, else the shortest.

    ``topics`` lists the topic names of the episode (names, not messages).
    """
    first_seen = F.struct(F.col("first_ts"), F.col(TOPIC))
    best = F.min_by(TOPIC, F.struct(-F.col("base_score"), first_seen))
    shortest = F.min_by(TOPIC, F.struct(F.col("n"), first_seen))
    picks = [F.max(F.when(F.col(TOPIC) == preferred, F.col(TOPIC)))] if preferred else []
    return (
        score_topics(timing)
        .groupBy(EPISODE)
        .agg(F.coalesce(*picks, best, shortest).alias("base_topic"), F.collect_set(TOPIC).alias("topics"))
    )


def sync_report(timing: DataFrame) -> DataFrame:
    """Score, class, strategy, candidates, issues and loss in one row per episode.

    Two windows over the per-topic table and one aggregate, all on the same key: the messages
    are read once, for ``timing``.
    """
    seen = Window.partitionBy(EPISODE).orderBy("first_ts", TOPIC).rowsBetween(Window.unboundedPreceding, 0)
    scored = score_topics(timing).withColumn(
        "rank", F.row_number().over(Window.partitionBy(EPISODE).orderBy(F.desc("base_score"), "first_ts", TOPIC))
    )
    flags = {
        "unstable": F.when(F.col("rate_hz") > 0, F.col("rate_std_hz") / F.col("rate_hz") > UNSTABLE_SHARE).otherwise(False),
        "sparse": F.col("n") < SPARSE_COUNT,
        "gappy": (F.col("n") > 1) & (F.col("max_gap_ms") > LONG_GAP_MS),
    }
    # one window for the three running counts
    scored = scored.withColumns({"_" + flag: cond for flag, cond in flags.items()})
    scored = scored.withColumns({f"_{flag}_no": F.sum(F.col("_" + flag).cast("int")).over(seen) for flag in flags})

    def named(flag: str) -> Column:
        number = F.col(f"_{flag}_no")
        picked = F.collect_list(F.when(F.col("_" + flag) & (number <= NAMED_TOPICS), F.struct(number.alias("no"), F.col(TOPIC).alias("t"))))
        return F.array_join(F.transform(F.array_sort(picked), lambda x: x["t"]), ", ").alias(flag)

    candidates = F.collect_list(F.when(F.col("rank") <= NAMED_TOPICS, F.struct(F.col("rank"), F.col(TOPIC).alias("t"))))
    report = scored.groupBy(EPISODE).agg(
        F.avg("topic_score").alias("score"),
        _rate_ratio().alias("rate_ratio"),
        F.transform(F.array_sort(candidates), lambda x: x["t"]).alias("base_topics"),
        _loss().alias("data_loss"),
        *[named(flag) for flag in flags],
    )
    ratio = F.col("rate_ratio")
    ratio_text = F.format_string("%.1fx)", F.round(ratio, 1))

    def issue(prefix: str, flag: str) -> Column:
        return F.when(F.col(flag) != "", F.concat(F.lit(prefix), F.col(flag)))

    issues = F.array_compact(
        F.array(
            F.when(ratio > EXTREME_RATIO, F.concat(F.lit("Extreme frequency differences (ratio: "), ratio_text)).when(
                ratio > HIGH_RATIO, F.concat(F.lit("High frequency differences (ratio: "), ratio_text)
            ),
            issue("Unstable frequencies in topics: ", "unstable"),
            issue("Sparse data in topics: ", "sparse"),
            issue("Large time gaps in topics: ", "gappy"),
        )
    )
    return report.select(
        EPISODE,
        "score",
        feasibility_label(ratio).alias("feasibility"),
        strategy_label(F.col("score")).alias("strategy"),
        "base_topics",
        issues.alias("issues"),
        "data_loss",
    )
