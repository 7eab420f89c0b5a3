"""Mergeable timing states: what a recording adds to the profile of its topics, without the recordings before it.

A state holds counts, exact sums and squares (long and decimal, so merging in any order gives the same
digits), extremes, and the times at its edges. Recordings of one topic that follow each other in
time merge exactly: the gap between the last message of one and the first of the next is known
from their edges. Recordings that overlap in time do not merge, which ``merge_states`` says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split
from kinetable.operators.timing import EPISODE, SEQ, TOPIC, TS, message_gaps

STATE = (
    f"{EPISODE} LONG, {TOPIC} STRING, n LONG, first_ts LONG, last_ts LONG, gaps LONG, gap_sum DECIMAL(38,0), gap_squares DECIMAL(38,0), "
    "min_gap LONG, max_gap LONG, rates LONG, rate_sum DECIMAL(38,13), rate_squares DECIMAL(38,13)"
)
SUMS = ("n", "gaps", "gap_sum", "gap_squares", "rates", "rate_sum", "rate_squares")


def _gap_parts(gap: Column) -> dict[str, Column]:
    """What one gap (null: none) adds."""
    some, wide = gap.isNotNull(), gap.cast("decimal(19,0)")
    rate = F.when(gap > 0, F.lit(1e9) / gap)
    return {
        "gaps": F.when(some, 1).otherwise(0).cast("bigint"),
        "gap_sum": F.coalesce(gap, F.lit(0)).cast("decimal(38,0)"),
        "gap_squares": F.coalesce(wide * wide, F.lit(0)).cast("decimal(38,0)"),
        "rates": F.when(rate.isNotNull(), 1).otherwise(0).cast("bigint"),
        "rate_sum": F.coalesce(rate, F.lit(0.0)).cast("decimal(38,13)"),
        "rate_squares": F.coalesce(rate * rate, F.lit(0.0)).cast("decimal(38,13)"),
    }


def timing_states(messages: DataFrame, split: Split | None = None) -> DataFrame:
    """One state per (episode, topic) of the messages of one recording."""
    gaps = message_gaps(messages.select(EPISODE, TOPIC, SEQ, TS), split, order=[TS])
    parts = _gap_parts(F.col("gap_ns"))
    return gaps.groupBy(EPISODE, TOPIC).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
        F.min("gap_ns").alias("min_gap"),
        F.max("gap_ns").alias("max_gap"),
        *[F.sum(c).cast("bigint" if name in ("gaps", "rates") else "decimal(38,13)" if "rate" in name else "decimal(38,0)").alias(name) for name, c in parts.items()],
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per (episode, topic) of several, and ``overlaps``: true when recordings overlap in time, and the state is not exact.

    A topic has one row per recording here, so the window is short; messages are not read again.
    """
    order = Window.partitionBy(EPISODE, TOPIC).orderBy("first_ts", "last_ts")
    before = F.max("last_ts").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = states.withColumn("_before", before).withColumn("_edge", F.col("first_ts") - F.col("_before"))
    edge = _gap_parts(F.col("_edge"))
    return placed.groupBy(EPISODE, TOPIC).agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.min(F.least("min_gap", "_edge")).alias("min_gap"),
        F.max(F.greatest("max_gap", "_edge")).alias("max_gap"),
        F.sum("n").alias("n"),
        *[F.sum(F.col(c) + edge[c]).cast("bigint" if c in ("gaps", "rates") else "decimal(38,13)" if "rate" in c else "decimal(38,0)").alias(c) for c in SUMS[1:]],
        F.coalesce(F.bool_or(F.col("_edge") < 0), F.lit(False)).alias("overlaps"),
    )


def _spread(count: str, total: str, squares: str) -> Column:
    """Population deviation from exact sums; the last step in double loses the 1e-8th part of the mean at most."""
    mean = F.col(total).cast("double") / F.col(count)
    return F.sqrt(F.greatest(F.lit(0.0), F.col(squares).cast("double") / F.col(count) - mean * mean))


def timing_of_states(states: DataFrame) -> DataFrame:
    """The columns of ``timing.topic_timing`` from states."""
    span = (F.col("last_ts") - F.col("first_ts")) / F.lit(1e9)
    some, rated = F.col("gaps") > 0, F.col("rates") > 0
    return states.select(
        EPISODE,
        TOPIC,
        "n",
        "first_ts",
        span.alias("span_s"),
        F.when(span > 0, F.col("n") / span).otherwise(0.0).alias("rate_hz"),
        F.when(rated, _spread("rates", "rate_sum", "rate_squares")).otherwise(0.0).alias("rate_std_hz"),
        F.coalesce(F.col("min_gap") / F.lit(1e6), F.lit(0.0)).alias("min_gap_ms"),
        F.coalesce(F.col("max_gap") / F.lit(1e6), F.lit(0.0)).alias("max_gap_ms"),
        F.when(some, F.col("gap_sum").cast("double") / F.col("gaps") / F.lit(1e6)).otherwise(0.0).alias("gap_mean_ms"),
        F.when(some, _spread("gaps", "gap_sum", "gap_squares") / F.lit(1e6)).otherwise(0.0).alias("gap_std_ms"),
    )


class TimingStore:
    """States by recording in a folder: a recording is added, or written over, without reading the others' messages."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, recording: str, messages: DataFrame, split: Split | None = None) -> None:
        timing_states(messages, split).write.mode("overwrite").parquet(f"{self.root}/recording={recording}")

    def states(self) -> DataFrame:
        return self.spark.read.schema(f"{STATE}, recording STRING").parquet(self.root)

    def timing(self) -> DataFrame:
        """``timing.topic_timing`` over all recordings; refused when some overlap in time."""
        merged = merge_states(self.states())
        clash = merged.where("overlaps").select(EPISODE, TOPIC).limit(5).collect()
        if clash:
            raise ValueError(f"recordings overlap in time: {[tuple(r) for r in clash]}")
        return timing_of_states(merged)
