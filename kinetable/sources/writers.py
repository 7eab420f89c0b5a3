"""Sinks: trajectory parquet with metadata, and CSV per topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.session import staged

CHUNK = 1000
EPISODE, FRAME = "episode_index", "frame_index"
# partitions that chunks are dealt to before small ones are merged: with few, a partition of many chunks would be cut
# by size, and each piece would write a file for each of its chunks
REBALANCED = 1000


# fixed values: version of the layout that the metadata names
CODEBASE_VERSION = "v2.1"
DATA_PATH = "data/episode_chunk={episode_chunk}"
VIDEO_PATH = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"


def write_trajectory(
    frames: DataFrame,
    root: str,
    tasks: DataFrame,
    fps: float = 30,
    mode: str = "errorifexists",
    robot_type: str = "unknown",
    features: DataFrame | None = None,
) -> DataFrame:
    """Frames below ``root/data/episode_chunk=…`` and the metadata below ``root/meta``.

    ``frames`` holds episode_index, frame_index, task_index and the vectors, ``tasks`` the task
    texts (task_index, task); an episode of an unknown task has no text. ``features`` is the table
    of ``features.feature_schema``. The rebalance hint brings a chunk together, cuts one that is
    too large into several files and needs no sampling pass. The metadata is computed from the
    files written, of which it reads two columns; the frames as written are returned, so that their
    folders need not be listed again. Metadata describes the whole dataset, so
    appending is refused: ``TrajectoryStore`` is the form that episodes are added to.
    """
    if mode == "append":
        raise ValueError("a trajectory is not appended to: its metadata describes the whole")
    chunked = frames.withColumn("episode_chunk", F.floor(F.col(EPISODE) / CHUNK))
    (
        chunked.hint("rebalance", REBALANCED, "episode_chunk")
        .sortWithinPartitions("episode_chunk", EPISODE, FRAME)
        .write.mode(mode)
        .partitionBy("episode_chunk")
        .parquet(f"{root}/data")
    )
    tasks.select("task_index", "task").distinct().write.mode(mode).json(f"{root}/meta/tasks")
    spark = frames.sparkSession
    tasks = spark.read.schema("task_index LONG, task STRING").json(f"{root}/meta/tasks")
    written = spark.read.parquet(f"{root}/data")
    per_task = written.groupBy(EPISODE, "task_index").agg(F.count(F.lit(1)).alias("_n"))
    episodes = (
        per_task.join(tasks, "task_index", "left")
        .groupBy(EPISODE)
        .agg(F.array_sort(F.collect_set("task")).alias("tasks"), F.sum("_n").alias("length"))
    )
    episodes.write.mode(mode).json(f"{root}/meta/episodes")
    lengths = spark.read.schema("episode_index LONG, length LONG").json(f"{root}/meta/episodes")
    totals = lengths.agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"),
        F.count_distinct(F.floor(F.col(EPISODE) / CHUNK)).alias("total_chunks"),
    ).first()
    # a handful of declared features, whatever the number of frames
    declared = [] if features is None else features.select("feature", "dtype", "shape", "names").orderBy("feature").collect()
    videos = sum(f["dtype"] in ("video", "image") for f in declared)
    row = (
        CODEBASE_VERSION, robot_type, totals["total_episodes"], totals["total_frames"], tasks.count(), videos * totals["total_episodes"],
        totals["total_chunks"], CHUNK, float(fps), {"train": f"0:{totals['total_episodes']}"}, DATA_PATH, VIDEO_PATH,
        {f["feature"]: (f["dtype"], f["shape"], f["names"]) for f in declared},
    )
    schema = (
        "codebase_version STRING, robot_type STRING, total_episodes LONG, total_frames LONG, total_tasks LONG, total_videos LONG, "
        "total_chunks LONG, chunks_size LONG, fps DOUBLE, splits MAP<STRING, STRING>, data_path STRING, video_path STRING, "
        "features MAP<STRING, STRUCT<dtype: STRING, shape: ARRAY<INT>, names: ARRAY<STRING>>>"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode(mode).json(f"{root}/meta/info")
    return written


class TrajectoryStore:
    """A trajectory that is added to: parts of frames with their summaries, and a manifest switched at the end.

    ``add`` writes the frames of new episodes as one part below ``root/data/part=N``, and its episode
    and chunk summaries and task texts below ``root/meta``; then the manifest of version N, which names
    the parts that count. A part without its manifest is not seen and is written over by the next
    attempt. The totals are merged from the chunk summaries, so adding reads nothing of the frames
    that are there. One writer at a time.
    """

    SUMMARIES = {
        "episodes": "episode_index LONG, tasks ARRAY<STRING>, length LONG",
        "chunks": "episode_chunk LONG, episodes LONG, frames LONG",
        "tasks": "task_index LONG, task STRING",
    }

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the complete manifests, rising."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(folder, "manifest/version=*/_SUCCESS"))
        return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in done)

    def parts(self, version: int | None = None) -> list[int]:
        """Parts of a version, of the newest by default; none before the first."""
        known = self.versions()
        if not known:
            return []
        path = f"{self.root}/manifest/version={known[-1] if version is None else version}"
        return sorted(r["part"] for r in self.spark.read.schema("part LONG").json(path).collect())

    def summary(self, name: str, version: int | None = None) -> DataFrame:
        """The rows of a summary (episodes, chunks or tasks) over the parts that count, with their part."""
        schema = self.SUMMARIES[name]
        parts = self.parts(version)
        if not parts:
            return self.spark.createDataFrame([], f"{schema}, part INT")
        read = self.spark.read.schema(f"{schema}, part INT").option("basePath", f"{self.root}/meta/{name}")
        return read.json([f"{self.root}/meta/{name}/part={p}" for p in parts])

    def frames(self, version: int | None = None) -> DataFrame:
        """The frames of the parts that count, with part and episode_chunk."""
        parts = self.parts(version)
        if not parts:
            raise FileNotFoundError(f"no part of a trajectory in {self.root}")
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/part={p}" for p in parts])

    def totals(self, version: int | None = None) -> DataFrame:
        """One row: total_episodes, total_frames, total_chunks, total_tasks."""
        chunks = self.summary("chunks", version).agg(
            F.coalesce(F.sum("episodes"), F.lit(0)).alias("total_episodes"), F.coalesce(F.sum("frames"), F.lit(0)).alias("total_frames"), F.count_distinct("episode_chunk").alias("total_chunks")
        )
        tasks = self.summary("tasks", version).agg(F.count_distinct("task_index").alias("total_tasks"))
        return chunks.withColumn("total_tasks", tasks.scalar())

    def add(self, frames: DataFrame, tasks: DataFrame) -> int:
        """Add the frames of new episodes and the texts of new tasks; the number of the new version.

        Refused are episodes that are there already and task texts that contradict a known one; then
        nothing of the attempt counts. Only episode and task summaries are compared, not frames.
        """
        known = self.versions()
        version = known[-1] + 1 if known else 0
        data = f"{self.root}/data/part={version}"
        # needed three times, and may come from all frames
        texts = staged(tasks.select("task_index", "task").distinct(), "tasks")
        every = self.summary("tasks").select("task_index", "task").unionByName(texts).distinct()
        clash = every.groupBy("task_index").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("task_index").limit(5).collect()
        if clash:
            raise ValueError(f"tasks with two texts: {[r[0] for r in clash]}")
        (
            frames.withColumn("episode_chunk", F.floor(F.col(EPISODE) / CHUNK))
            .hint("rebalance", REBALANCED, "episode_chunk")
            .sortWithinPartitions("episode_chunk", EPISODE, FRAME)
            .write.mode("overwrite")
            .partitionBy("episode_chunk")
            .parquet(data)
        )
        fresh = texts.join(self.summary("tasks").select("task_index"), "task_index", "left_anti")
        self._put(fresh, "tasks", version)
        written = self.spark.read.parquet(data)
        lengths = written.groupBy(EPISODE, "task_index").agg(F.count(F.lit(1)).alias("_n"))
        # texts of this part and of those before
        episodes = lengths.join(every, "task_index", "left").groupBy(EPISODE).agg(F.array_sort(F.collect_set("task")).alias("tasks"), F.sum("_n").alias("length"))
        self._put(episodes, "episodes", version)
        own = self.spark.read.schema(self.SUMMARIES["episodes"]).json(f"{self.root}/meta/episodes/part={version}")
        twice = own.join(self.summary("episodes").select(EPISODE), EPISODE, "left_semi").select(EPISODE).limit(5).collect()
        if twice:
            raise ValueError(f"episodes that are there already: {[r[0] for r in twice]}")
        chunks = own.groupBy(F.floor(F.col(EPISODE) / CHUNK).alias("episode_chunk")).agg(F.count(F.lit(1)).alias("episodes"), F.sum("length").alias("frames"))
        self._put(chunks, "chunks", version)
        manifest = self.spark.createDataFrame([(p,) for p in [*self.parts(), version]], "part LONG")
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/version={version}")
        return version

    def _put(self, rows: DataFrame, name: str, part: int) -> None:
        rows.write.mode("overwrite").json(f"{self.root}/meta/{name}/part={part}")


def topic_folder(topic: str = "topic"):
    """Folder name of a topic: slashes to underscores, none at the ends."""
    return F.btrim(F.regexp_replace(topic, "/", "_"), F.lit("_"))


def write_topic_csv(messages: DataFrame, root: str, topic: str = "topic", ts: str = "ts_ns", mode: str = "errorifexists") -> None:
    """One CSV folder per topic; every file is in time order, a hot topic has several files."""
    (
        messages.withColumn("topic_folder", topic_folder(topic))
        .hint("rebalance", "topic_folder")
        .sortWithinPartitions("topic_folder", ts)
        .write.mode(mode)
        .partitionBy("topic_folder")
        .option("header", "true")
        .csv(root)
    )


def write_flat_topic_csv(messages: DataFrame, root: str, kinds: Mapping[str, Mapping[str, Column]], keep: Sequence[str], ts: str = "ts_ns", mode: str = "errorifexists") -> None:
    """CSV with flattened columns: a folder per kind of message (its own columns), below it one per topic.

    ``kinds`` maps a kind to its columns, as the ``*_columns`` functions make them; a message
    belongs to the first kind of which it has a value, messages of no kind are left out.
    """
    kind = F.coalesce(*[F.when(_any_value(columns), F.lit(name)) for name, columns in kinds.items()])
    told = messages.withColumn("_kind", kind)
    for name, columns in kinds.items():
        flat = told.where(F.col("_kind") == name).select(*keep, *[c.alias(n) for n, c in columns.items()])
        write_topic_csv(flat, f"{root}/{name}", ts=ts, mode=mode)


def _any_value(columns: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns.values()])
