"""The landing table of topic recordings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split, number_rows
from kinetable.operators.timing import EPISODE, SEQ, TOPIC, TS, split_messages


def load_messages(
    raw: DataFrame,
    episode: Column,
    topic: Column,
    ts_ns: Column,
    tie_break: Column,
    payload: Sequence[str] = (),
    keep_only: Sequence[str] | None = None,
) -> tuple[DataFrame, Split]:
    """Messages (episode_id, topic, seq, ts_ns, payload...) ordered per topic by (time, tie_break).

    ``keep_only`` prunes topics at the scan. The shortest topic decides a truncation, so prune
    only for uses that name their topics.
    """
    rows = raw.select(
        episode.alias(EPISODE),
        topic.alias(TOPIC),
        ts_ns.cast("long").alias(TS),
        tie_break.alias("_id"),
        *payload,
    )
    if keep_only is not None:
        rows = rows.where(F.col(TOPIC).isin(list(keep_only)))
    split = split_messages(rows)
    return number_rows(rows, [EPISODE, TOPIC], [TS, "_id"], SEQ, split=split).drop("_id"), split
