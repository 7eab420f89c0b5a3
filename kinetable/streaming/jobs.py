"""Two stream jobs over control-plane events: status folding and heartbeat gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinetable.operators.catalog import status_upsert
from kinetable.operators.ordered import neighbours, plan_split
from kinetable.session import remove

#: buckets of a status table: a manifest has that many rows at most
BUCKETS = 64

STATUS_SCHEMA = "dataset_uuid STRING, convert_status STRING, update_message STRING, convert_path STRING, updated_at LONG"


class StatusTable:
    """Status table in hash buckets; a batch rewrites only the buckets it touches.

    A version is a manifest: one row per bucket with the version that wrote its files, so it has at
    most ``buckets`` rows. Batch ``n`` reads version ``n``, writes the touched buckets under version
    ``n + 1``, and then its manifest: a reader sees the whole batch or nothing of it. A replayed batch
    reads the same version and writes the same one again, so a lost driver does no harm. Files and
    manifests that the two newest versions do not name are removed.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def _files(self, version: int, bucket: int | None = None) -> str:
        path = f"{self.root}/data/version={version}"
        return path if bucket is None else f"{path}/bucket={bucket}"

    def manifest(self, version: int) -> dict[int, int]:
        """The version that wrote the files of each bucket that has rows."""
        rows = self.spark.read.schema("bucket INT, written LONG").json(self._manifest(version)).collect()
        return {r["bucket"]: r["written"] for r in rows}

    def _read(self, manifest: dict[int, int]) -> DataFrame:
        paths = [self._files(written, bucket) for bucket, written in sorted(manifest.items())]
        if not paths:
            return self.spark.createDataFrame([], STATUS_SCHEMA)
        return self.spark.read.schema(STATUS_SCHEMA).parquet(*paths)

    def read(self, version: int) -> DataFrame:
        return self._read(self.manifest(version))

    def versions(self) -> list[int]:
        """Numbers of the versions whose manifests are written completely, rising."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(folder, "manifest/version=*/_SUCCESS"))
        return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in done)

    def newest(self) -> int:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no version of the status table in {self.root}")
        return versions[-1]

    def read_newest(self) -> DataFrame:
        return self.read(self.newest())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("dataset_uuid"), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> set[int]:
        """Write rows (with their bucket) as files of a version; the buckets that have some."""
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._files(version))
        written = self.spark.read.schema(f"{STATUS_SCHEMA}, bucket INT").parquet(self._files(version))
        return {r["bucket"] for r in written.select("bucket").distinct().collect()}

    def _publish(self, manifest: dict[int, int], version: int) -> None:
        rows = self.spark.createDataFrame(sorted(manifest.items()), "bucket INT, written LONG")
        rows.coalesce(1).write.mode("overwrite").json(self._manifest(version))

    def initialise(self, table: DataFrame) -> None:
        """Version 0 from ``table``, which must not be read from here; what an older run left goes."""
        remove(self.spark, self.root)
        filled = self._write(table.select("*", self._bucket().alias("bucket")), 0)
        self._publish(dict.fromkeys(filled, 0), 0)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        before = self.manifest(batch_id)
        # the batch is read twice: for the buckets it touches, and for the rows
        changes = batch.select("*", self._bucket().alias("bucket"))
        touched = {r["bucket"] for r in changes.select("bucket").distinct().collect()}
        version = batch_id + 1
        after = dict(before)
        if touched:
            old = self._read({b: v for b, v in before.items() if b in touched})
            merged = status_upsert(old, changes.drop("bucket"))
            after.update(dict.fromkeys(self._write(merged.select("*", self._bucket().alias("bucket")), version), version))
        self._publish(after, version)
        # a replay needs this batch's version and the one before
        if batch_id - 1 in self.versions():
            for bucket, written in self.manifest(batch_id - 1).items():
                if written not in (before.get(bucket), after.get(bucket)):
                    remove(self.spark, self._files(written, bucket))
            remove(self.spark, self._manifest(batch_id - 1))


def fold_status(events: DataFrame, table: StatusTable, checkpoint: str) -> StreamingQuery:
    """Fold a stream of task results into the status table, batch by batch."""
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: table.apply(batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def heartbeat_gaps(pings: DataFrame, pongs: DataFrame, timeout: str, delay: str, salts: int = 1) -> DataFrame:
    """Pings (client, ping_ts) without a pong (client, pong_ts) within ``timeout``, as a stream.

    Events may come up to ``delay`` late; ``late_events`` counts later ones, and ``correct_gaps`` makes
    up for them. Both watermarks and the interval bound the state. A ping is emitted once the watermark has passed its interval. ``salts`` spreads the pings of a busy client over that many keys and
    repeats its pongs for each.
    """
    left = pings.withWatermark("ping_ts", delay).withColumn("_salt", F.pmod(F.xxhash64("ping_ts"), F.lit(salts)).cast("int"))
    right = pongs.withWatermark("pong_ts", delay).select(
        F.col("client").alias("_client"), "pong_ts", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_pong_salt")
    )
    within = F.expr(
        f"client = _client AND _salt = _pong_salt AND pong_ts >= ping_ts AND pong_ts <= ping_ts + INTERVAL {timeout}"
    )
    joined = left.join(right, within, "left_outer")
    return joined.where(F.col("pong_ts").isNull()).select("client", "ping_ts")


def heartbeat_gaps_batch(pings: DataFrame, pongs: DataFrame, timeout: str) -> DataFrame:
    """The same question on stored events.

    The pong at or after a ping is its neighbour in time order, so no interval join multiplies
    rows, and a busy client is cut into time slices.
    """
    targets = pings.select("client", "ping_ts", F.unix_micros("ping_ts").alias("us"))
    sources = pongs.select("client", F.unix_micros("pong_ts").alias("us")).withColumn("_n", F.lit(0))
    split = plan_split(targets.select("client", "us").unionByName(sources.select("client", "us")), ["client"], ["us"], stored=True)
    around = neighbours(targets, sources, ["client"], "us", "_n", split=split)
    limit = F.unix_micros(F.expr(f"ping_ts + INTERVAL {timeout}"))
    answered = (F.col("_prev")["us"] == F.col("us")) | (F.col("_next")["us"] <= limit)
    return around.where(~F.coalesce(answered, F.lit(False))).select("client", "ping_ts")


def late_events(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and did not reach the stream's state, over the progress that Spark keeps.

    A dropped row counts at least once, so 0 says that nothing was lost.
    """
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])


def correct_gaps(emitted: DataFrame, pings: DataFrame, pongs: DataFrame, timeout: str, until: Column) -> DataFrame:
    """(client, ping_ts, change): what a stream's stored gaps lack (``add``) and have too much (``retract``).

    A batch over the stored events, late ones included, judges every ping up to ``until``, whose
    interval must have passed for the stream as well; a gap emitted twice is retracted once for
    each copy beyond the first. Run it when ``late_events`` is not 0, over the period it may concern.
    """
    right = heartbeat_gaps_batch(pings, pongs, timeout).where(F.col("ping_ts") <= until)
    have = emitted.where(F.col("ping_ts") <= until).select("client", "ping_ts", F.lit(1).alias("_n"))
    both = right.distinct().select("client", "ping_ts", F.lit(-1).alias("_n")).unionByName(have)
    # one grouping in place of two anti joins
    surplus = both.groupBy("client", "ping_ts").agg(F.sum("_n").alias("_n")).where("_n <> 0")
    change = F.when(F.col("_n") < 0, "add").otherwise("retract")
    return surplus.select("client", "ping_ts", F.explode(F.array_repeat(change, F.abs("_n").cast("int"))).alias("change"))
