"""Trees of files walked in tasks, and files read and written by ranges.

A frontier of directories is a DataFrame; tasks list its directories, the listing is written level by
level, and the directories of a level are the next frontier. The driver only learns whether a
frontier is empty, so it never holds the names of a large tree.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.session import scratch_dir

Entry = tuple[str, bool, int]
Lister = Callable[[str], Iterable[Entry]]
#: rows of one output batch
ROWS = 10_000
_LEVEL = "path STRING, directory BOOLEAN, length LONG, descend BOOLEAN"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; a path without a scheme is one of this machine's file system."""
    return (fs.LocalFileSystem(), path) if "://" not in path and not path.startswith("file:") else fs.FileSystem.from_uri(path)


def list_directory(path: str) -> Iterator[Entry]:
    """(path, is a directory, bytes) of what stands in one directory; nothing for one that is gone.

    Links to directories are entries without bytes and are not followed, so a link cannot lead round.
    """
    system, inner = located(path)
    base = path.rstrip("/")
    if isinstance(system, fs.LocalFileSystem):
        try:
            with os.scandir(inner) as found:
                for entry in found:
                    below = entry.is_dir(follow_symlinks=False)
                    linked = not below and entry.is_dir()
                    yield f"{base}/{entry.name}", below, 0 if below or linked else entry.stat(follow_symlinks=False).st_size
        except (FileNotFoundError, NotADirectoryError):
            return
        return
    for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        yield f"{base}/{info.base_name}", info.type == fs.FileType.Directory, info.size or 0


def _listed(lister: Lister, marker: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batch(rows: list[tuple], descend: bool) -> pa.RecordBatch:
        paths, below, sizes = zip(*rows, strict=True)
        columns = [pa.array(paths, pa.string()), pa.array(below, pa.bool_()), pa.array(sizes, pa.int64()), pa.array([descend and b for b in below], pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["path", "directory", "length", "descend"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for directory in given.column(0).to_pylist():
                # only with a marker the whole directory must be known before its first entry goes out
                entries = iter(lister(directory))
                descend = True
                if marker is not None:
                    known = list(entries)
                    descend = not any(not below and path.rsplit("/", 1)[1].startswith(marker) for path, below, _ in known)
                    entries = iter(known)
                rows: list[tuple] = []
                for entry in entries:
                    rows.append(entry)
                    if len(rows) == ROWS:
                        yield batch(rows, descend)
                        rows = []
                if rows:
                    yield batch(rows, descend)

    return run


def tasks(spark: SparkSession) -> int:
    """Tasks that small rows of much work are dealt to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def walk(spark: SparkSession, roots: Iterable[str] | DataFrame, marker: str | None = None, lister: Lister = list_directory) -> DataFrame:
    """(path, length, level) of all files below ``roots`` (paths, or a table with a ``path``); level 0 stands in a root.

    With ``marker`` a directory that holds a file of such a name (prefix) is not descended below: its own
    files are listed, its directories are not. Every level is written to the scratch folder before the
    next one starts, so a lost executor costs a part of one level. A directory is listed by one
    task; a level is dealt evenly over tasks. Roots are paths as they are; a root that is not there
    has no files; a root inside another gives its files twice.
    """
    base = scratch_dir(spark, "walk")
    level = 0
    frontier = roots.select("path") if isinstance(roots, DataFrame) else spark.createDataFrame([(r,) for r in roots], "path STRING")
    while True:
        # a number of tasks is given, else the few bytes of a frontier would all go to one
        dealt = frontier.repartition(tasks(spark), "path")
        dealt.mapInArrow(_listed(lister, marker), _LEVEL).write.parquet(f"{base}/level={level}")
        found = spark.read.schema(_LEVEL).parquet(f"{base}/level={level}")
        frontier = found.where("descend").select("path")
        if frontier.isEmpty():
            break
        level += 1
    listed = spark.read.schema(f"{_LEVEL}, level INT").parquet(base)
    return listed.where("NOT directory").select("path", "length", "level")


def read_range(path: str, offset: int, length: int) -> bytes:
    """Up to ``length`` bytes of a file from ``offset``."""
    system, inner = located(path)
    if isinstance(system, fs.LocalFileSystem):
        with open(inner, "rb") as file:
            return os.pread(file.fileno(), length, offset)
    with system.open_input_file(inner) as file:
        return file.read_at(min(length, max(0, file.size() - offset)), offset)


def write_files(contents: DataFrame, path: Column, content: Column) -> DataFrame:
    """(path, length) of the files written, one for each row, each in its own task's hands.

    A file is written beside its place and moved, so a repeated task leaves the same file. The
    folder must be shared by all executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for target, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = data.as_py() or b""
                system, inner = located(target)
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                beside = f"{inner}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(beside) as file:
                    file.write(body)
                system.move(beside, inner)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "length"])

    return contents.select(path.alias("path"), content.alias("content")).mapInArrow(run, "path STRING, length LONG")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)
