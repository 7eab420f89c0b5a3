"""Episodes and frames: joins, numbers, bounds, offsets, nearest image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetable.operators.ordered import Split, nearest_match, number_rows, plan_split
from kinetable.session import staged

EPISODE, FRAME = "episode_index", "frame_index"
# frame numbers that one row generates at a time
SHORTFALL_BLOCK = 10_000


def assemble_frames(sources: Sequence[DataFrame], keys: Sequence[str] = (EPISODE, FRAME)) -> DataFrame:
    """Inner join of the per-frame sources.

    The key includes the frame number, so rows of a long episode spread over all tasks.
    """
    out = sources[0]
    for other in sources[1:]:
        out = out.join(other, list(keys), "inner")
    return out


def frame_shortfall(frames: DataFrame, sources: DataFrame, required: Sequence[str], topic: str = "topic") -> DataFrame:
    """Frames whose index lies beyond a required topic's length, one row each.

    ``frames`` and ``sources`` need only keys. Both are counted first; the violating indexes
    are then generated from the counts, in blocks, so no frame is joined and no row grows with an
    episode.
    """
    need = frames.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("frames"))
    have = sources.where(F.col(topic).isin(list(required))).groupBy(EPISODE, topic).agg(F.count(F.lit(1)).alias("available"))
    wanted = need.withColumn(topic, F.explode(F.array(*[F.lit(r) for r in required])))
    short = wanted.join(have, [EPISODE, topic], "left").withColumn("available", F.coalesce("available", F.lit(0)))
    short = short.where(F.col("available") < F.col("frames"))
    first, last, block = F.col("available"), F.col("frames") - 1, F.lit(SHORTFALL_BLOCK)
    cut = short.withColumn("_block", F.explode(F.sequence(F.floor(first / block), F.floor(last / block))))
    inside = F.sequence(F.greatest(first, F.col("_block") * block), F.least(last, (F.col("_block") + 1) * block - 1))
    return cut.select(EPISODE, topic, F.explode(inside).alias(FRAME), "available")


def number_episodes(episodes: DataFrame, task: str, local: Sequence[str], name: str = "global_episode") -> DataFrame:
    """Global episode number in task order, then in the order within the task.

    ``episodes`` is a stored (or staged) table of one row per episode.
    """
    return number_rows(episodes, [], [task, *local], name, stored=True)


def index_frames(frames: DataFrame, order: Sequence[str], fps: float, split: Split | None = None) -> DataFrame:
    """Stored columns of a frame: frame_index, timestamp, global index, next_done.

    The global index is the running total of episode lengths, taken over the episode table.
    """
    numbered = number_rows(frames, [EPISODE], order, FRAME, split=split)
    return add_frame_columns(numbered, fps)


def add_frame_columns(frames: DataFrame, fps: float) -> DataFrame:
    """``index_frames`` for frames that are numbered already (dense, from 0)."""
    # a count, not a maximum: it needs no frame number, so the numbering is not run twice
    lengths = frames.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_length"))
    offsets = running_total(lengths, EPISODE, "_length", "_offset")
    joined = frames.join(offsets, EPISODE)
    return joined.select(
        *frames.columns,
        (F.col(FRAME) / F.lit(float(fps))).cast("float").alias("timestamp"),
        (F.col("_offset") + F.col(FRAME)).alias("index"),
        (F.col(FRAME) == F.col("_length") - 1).alias("next_done"),
    )


def running_total(table: DataFrame, key: str, value: str, name: str, block: int = 100_000) -> DataFrame:
    """Sum of ``value`` over smaller keys, in two steps of bounded size.

    The rows are numbered in key order and cut into blocks of equal size, whatever the keys look
    like: totals per block first, then a window inside each block, so no task sees all keys.
    """
    numbered = number_rows(staged(table, "running-total"), [], [key], "_no", stored=True)
    blocked = numbered.withColumn("_block", F.floor(F.col("_no") / block))
    before = Window.partitionBy("_one").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocked.groupBy("_block")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_one", F.lit(0))
        .select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, "_block")
        .withColumn(name, F.col(name) + F.col("_base"))
        .drop("_block", "_base", "_no")
    )


def offset_action(
    frames: DataFrame, offset: int, action: str = "action", keep_tail: bool = False, split: Split | None = None
) -> DataFrame:
    """Action of the frame whose number is ``offset`` higher; frames without such a frame are dropped, or kept with null.

    Frame numbers are unique in an episode and may have gaps. Ordinary episodes use one window
    over the numbers. When an episode is hot the later frame is found by an equi-join on
    (episode, frame number), which spreads over all tasks.
    """
    name = "offset_action"
    split = split or plan_split(frames, [EPISODE], [FRAME])
    if not split.hot:
        w = Window.partitionBy(EPISODE).orderBy(FRAME).rangeBetween(offset, offset)
        out = frames.withColumn(name, F.first(action).over(w))
        return out if keep_tail else out.withColumn("_found", F.count(F.lit(1)).over(w)).where("_found > 0").drop("_found")
    later = frames.select(EPISODE, (F.col(FRAME) - offset).alias(FRAME), F.col(action).alias(name))
    return frames.join(later, [EPISODE, FRAME], "left" if keep_tail else "inner")


def nearest_image(frames: DataFrame, images: DataFrame, carry: Sequence[str] = (), split: Split | None = None) -> DataFrame:
    """For each wanted frame the image with the same or the closest number, lower on a tie.

    ``images`` holds (episode_index, frame_index, carry...); same operator as the time match.
    """
    split = split or plan_split(frames.select(EPISODE, FRAME), [EPISODE], [FRAME])
    images = images.withColumn("_no", F.col(FRAME))
    found = nearest_match(frames, images, [EPISODE], FRAME, "_no", carry, prefix="image_", split=split)
    return found.drop("image__no")
