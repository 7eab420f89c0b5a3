"""Session and scratch-folder helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "kinetable", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session that is given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KINETABLE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: scratch folders of this process, for ``scratch`` to remove
_MADE: list[str] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes the scratch folders that are made inside; write the results out before it ends."""
    before = len(_MADE)
    try:
        yield
    finally:
        made = _MADE[before:]
        del _MADE[before:]
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/kinetable/{label}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix=f"kinetable-{label}-")
    else:
        path = None
    if path:
        _MADE.append(path)
        return path
    raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")


@contextlib.contextmanager
def local_partitions(spark: SparkSession):
    """On a local master, no more shuffle partitions than cores: a stream keeps a state store for each."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the scratch folder and read back.

    For a small result of a large computation that is needed more than once: its lineage ends
    here, so neither a size check nor a lost executor runs the large computation again.
    """
    path = scratch_dir(df.sparkSession, label) + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
