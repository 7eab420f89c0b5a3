"""BSON recordings cut at frame boundaries before they are decoded, so one large file spreads over tasks.

A first pass walks a file by its length prefixes: it reads names and sizes, jumps over what they
hold, and gives runs of frames as (offset, length). The runs are dealt over tasks, which read
and decode them alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kinetable.sources.binary import _FIXED, ARRAY, BOOL, DOCUMENT, FRAMES_SCHEMA, STRING, FrameRows, decode_bson
from kinetable.sources.boxes import Reader
from kinetable.sources.walk import read_range, tasks

RANGES = "path STRING, topic STRING, first LONG, frames LONG, offset LONG, length LONG, error STRING"
#: frames and bytes of one run, about, and bytes read ahead when walking
RUN_FRAMES, RUN_BYTES, AHEAD = 500, 1 << 20, 1 << 14
ROWS = 20_000


class _Walker:
    """Elements of a document in a file; only what is near the current place is held."""

    def __init__(self, path: str, read: Reader) -> None:
        self.path, self.read = path, read
        self.start, self.held = 0, b""

    def bytes(self, at: int, count: int) -> bytes:
        if not (self.start <= at and at + count <= self.start + len(self.held)):
            self.start, self.held = at, self.read(self.path, at, max(count, AHEAD))
        got = self.held[at - self.start : at - self.start + count]
        if len(got) < count:
            raise ValueError(f"cut at {at}")
        return got

    def size(self, at: int) -> int:
        return int.from_bytes(self.bytes(at, 4), "little")

    def name(self, at: int) -> tuple[str, int]:
        """A zero-ended name and the place after it."""
        count = 64
        while True:
            self.bytes(at, 1)
            got = self.held[at - self.start : at - self.start + count]
            end = got.find(b"\x00")
            if end >= 0:
                return got[:end].decode("utf-8", "ignore"), at + end + 1
            if len(got) < count:
                # the name goes on beyond what is held, or the file ends in it
                more = self.read(self.path, at, 2 * count)
                if len(more) <= len(got):
                    raise ValueError(f"cut at {at}")
                self.start, self.held = at, more
            count *= 2

    def elements(self, at: int, end: int) -> Iterator[tuple[int, str, int, int]]:
        """(kind, name, start of the element, start of the value) up to the document's last byte; ``at`` is after its size."""
        while at < end - 1:
            kind = self.bytes(at, 1)[0]
            name, value = self.name(at + 1)
            yield kind, name, at, value
            at = self.after(kind, value)

    def after(self, kind: int, value: int) -> int:
        if kind in _FIXED:
            return value + _FIXED[kind].size
        if kind == BOOL:
            return value + 1
        if kind == STRING:
            return value + 4 + self.size(value)
        if kind in (DOCUMENT, ARRAY):
            return value + self.size(value)
        raise ValueError(f"unknown element type {kind}")

    def runs(self, topic: str | None, at: int) -> Iterator[tuple]:
        """Runs of the elements of the array at a place."""
        end = at + self.size(at)
        first = start = count = None
        for number, (_, _, begin, _) in enumerate(self.elements(at + 4, end)):
            if count is not None and (count == RUN_FRAMES or begin - start >= RUN_BYTES):
                yield topic, first, count, start, begin - start
                count = None
            if count is None:
                first, start, count = number, begin, 0
            count += 1
        if count:
            yield topic, first, count, start, end - 1 - start


def frame_runs(path: str, length: int, read: Reader) -> Iterator[tuple]:
    """(topic, first frame, frames, offset, length) of the runs of a main document (``data``) or a hand document (``frames``)."""
    walker = _Walker(path, read)
    size = walker.size(0)
    if size > length:
        raise ValueError("no data and no frames")
    known = False
    for kind, name, _, value in walker.elements(4, size):
        if name == "data" and kind == DOCUMENT:
            known = True
            for inner, topic, _, at in walker.elements(value + 4, value + walker.size(value)):
                if inner == ARRAY:
                    yield from walker.runs(topic, at)
        elif name == "frames" and kind == ARRAY:
            known = True
            yield from walker.runs(None, value)
    if not known:
        raise ValueError("no data and no frames")


def _frame_vectors(topic: str | None, frame: object) -> Iterator[tuple[str, list]]:
    if not isinstance(frame, dict):
        return
    parts = [(topic, frame.get("data"))] if topic is not None else list(frame.items())
    for part, fields in parts:
        for field, values in fields.items() if isinstance(fields, dict) else ():
            if isinstance(values, list):
                yield f"{part}.{field}", values


def bson_ranges(listing: DataFrame, read: Reader = read_range) -> DataFrame:
    """Runs of frames of the files of ``listing(path, length)``; what cannot be walked is a row with ``error``."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["path", "topic", "first", "frames", "offset", "length", "error"]

    def rows(path: str, length: int) -> Iterator[tuple]:
        try:
            for run in frame_runs(path, length, read):
                yield path, *run, None
        except (ValueError, OSError) as exc:
            yield path, None, None, None, None, None, str(exc) if isinstance(exc, ValueError) else f"not readable: {type(exc).__name__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held: list[tuple] = []
                for row in rows(path, length):
                    held.append(row)
                    if len(held) == ROWS:
                        yield _batch(held, kinds, names)
                        held = []
                if held:
                    yield _batch(held, kinds, names)

    return listing.select("path", "length").mapInArrow(run, RANGES)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def ingest_ranges(ranges: DataFrame, read: Reader = read_range) -> DataFrame:
    """Frame vectors of the runs, dealt evenly over tasks; a file that cannot be walked has one row with ``error``.

    The same rows as ``binary.ingest_bson`` gives for whole contents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = FrameRows()
        for batch in batches:
            for row in batch.to_pylist():
                if row["error"] is not None:
                    held.add(row["path"], None, None, None, row["error"])
                else:
                    body = read(row["path"], row["offset"], row["length"])
                    # a run of elements is a document without its size and its end
                    document = decode_bson((len(body) + 5).to_bytes(4, "little") + body + b"\x00") or {}
                    for number, frame in enumerate(document.values(), row["first"]):
                        for name, values in _frame_vectors(row["topic"], frame):
                            held.add(row["path"], name, number, [float(v) for v in values])
                if len(held) >= ROWS:
                    yield held.take()
        if len(held):
            yield held.take()

    # a number of tasks is given, else the few bytes of the runs' places would all go to one
    dealt = ranges.repartition(tasks(ranges.sparkSession), "path", "topic", "first")
    return dealt.mapInArrow(run, FRAMES_SCHEMA)
