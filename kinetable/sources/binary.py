"""Jobs over binary files: BSON episodes and a container check of videos.

Each file is one row of a ``binaryFile`` table; a small decoder runs inside the tasks.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: BSON element types
DOUBLE, STRING, DOCUMENT, ARRAY, BOOL, INT32, INT64 = 0x01, 0x02, 0x03, 0x04, 0x08, 0x10, 0x12
_FIXED = {DOUBLE: struct.Struct("<d"), INT32: struct.Struct("<i"), INT64: struct.Struct("<q")}
_SIZE = struct.Struct("<I")


# arrays of up to ten numbers by their size: one form reads kinds, names and numbers at once
_VECTORS = {5 + 11 * n: (struct.Struct("<" + "3sd" * n), tuple(b"\x01%d\x00" % i for i in range(n))) for n in range(1, 11)}


class _Layout(NamedTuple):
    """Frames that differ by their numbers only: one form reads what stands between the numbers, and the numbers."""

    form: struct.Struct
    heads: tuple[bytes, ...]
    #: (.field, first number, last) of the vectors below ``data``, and (part.field, first, last) of those below any part
    main: list[tuple[str, int, int]]
    hand: list[tuple[str, int, int]]


#: layouts by the size of a frame; sizes, layouts of one size and bytes of a frame that are kept
_LAYOUTS: dict[int, list[_Layout | None]] = {}
KEPT_SIZES, KEPT_LAYOUTS, LAYOUT_BYTES = 256, 4, 1 << 14


def _layout(doc: bytes, start: int, stop: int) -> _Layout | None:
    """Layout of the frame in ``doc[start:stop]``; None when it is cut, repeats a name or has lists of other things than numbers."""
    spots: list[tuple[int, struct.Struct]] = []
    vectors: list[tuple[str, str, int, int]] = []

    def walk(start: int, stop: int, path: tuple[str, ...], keyed: bool = True) -> bool:
        at, names = start + 4, set()
        while at < stop - 1:
            value_at = doc.find(0, at + 1, stop) + 1
            kind, name = doc[at], doc[at + 1 : value_at - 1].decode("utf-8", "ignore")
            if not value_at or name in names or not (keyed or kind in _FIXED) or (path, name) == ((), "data") and kind != DOCUMENT:
                return False
            names.update([name] if keyed else [])
            if kind in _FIXED:
                after = value_at + _FIXED[kind].size
                spots.append((value_at, _FIXED[kind]))
            elif kind == BOOL:
                after = value_at + 1
            elif kind in (STRING, DOCUMENT, ARRAY) and value_at + 4 <= stop:
                size = _SIZE.unpack_from(doc, value_at)[0]
                after = value_at + size + (4 if kind == STRING else 0)
                if kind != STRING:
                    first = len(spots)
                    if size < 4 or after > stop or not walk(value_at, after, (*path, name), kind == DOCUMENT):
                        return False
                    if kind == ARRAY and len(path) == 1:
                        vectors.append((path[0], name, first, len(spots)))
            else:
                return False
            if after > stop:
                return False
            at = after
        return True

    if stop - start > LAYOUT_BYTES or not walk(start, stop, ()):
        return None
    form, at = "<", start
    for place, number in spots:
        form, at = f"{form}{place - at}s{number.format[1:]}", place + number.size
    made = struct.Struct(f"{form}{stop - at}s")
    main = [(f".{field}", a, b) for part, field, a, b in vectors if part == "data"]
    return _Layout(made, made.unpack_from(doc, start)[::2], main, [(f"{part}.{field}", a, b) for part, field, a, b in vectors])


def _known_frame(doc: bytes, start: int, stop: int) -> tuple[_Layout, tuple] | None:
    """Layout and numbers of a frame; None when it has to be read element by element."""
    size = stop - start
    known = _LAYOUTS.get(size)
    if known is None:
        if len(_LAYOUTS) >= KEPT_SIZES:
            return None
        known = _LAYOUTS[size] = []
    for layout in known:
        if layout is not None:
            found = layout.form.unpack_from(doc, start)
            if found[::2] == layout.heads:
                return layout, found[1::2]
    if len(known) < KEPT_LAYOUTS:
        known.append(_layout(doc, start, stop))
        if known[-1] is not None:
            return known[-1], known[-1].form.unpack_from(doc, start)[1::2]
    return None


def _read(doc: bytes, start: int, stop: int, keyed: bool, frames: bool = False) -> dict | list:
    """Values of the document in ``doc[start:stop]`` in stored order, up to the first element that is unknown or cut.

    With ``frames``, documents in its lists come as (layout, numbers) where the layout is known.
    """
    out: dict | list = {} if keyed else []
    at, last, find = start + 4, stop - 1, doc.find
    while at < last:
        value_at = find(0, at + 1, stop) + 1
        if not value_at:
            break
        kind = doc[at]
        if kind in _FIXED:
            form = _FIXED[kind]
            after = value_at + form.size
            if after > stop:
                break
            value = form.unpack_from(doc, value_at)[0]
        elif kind == BOOL:
            after = value_at + 1
            if after > stop:
                break
            value = doc[value_at] != 0
        elif kind in (STRING, DOCUMENT, ARRAY) and value_at + 4 <= stop:
            size = _SIZE.unpack_from(doc, value_at)[0]
            if kind == STRING:
                after = value_at + 4 + size
                if after > stop:
                    break
                value = doc[value_at + 4 : max(value_at + 4, after - 1)].decode("utf-8", "ignore")
            else:
                after = value_at + size
                if size < 4 or after > stop:
                    break
                value = None
                if kind == ARRAY and size in _VECTORS:
                    form, heads = _VECTORS[size]
                    found = form.unpack_from(doc, value_at + 4)
                    if found[::2] == heads:
                        value = list(found[1::2])
                if frames and not keyed and kind == DOCUMENT:
                    value = _known_frame(doc, value_at, after)
                if value is None:
                    # an array is a document whose elements count in the order in which they are stored
                    value = _read(doc, value_at, after, kind == DOCUMENT, frames and keyed)
        else:
            break
        if keyed:
            out[doc[at + 1 : value_at - 1].decode("utf-8", "ignore")] = value
        else:
            out.append(value)
        at = after
    return out


def decode_bson(data: bytes, frames: bool = False) -> dict | None:
    """One document; what stands before an unknown or cut element is kept. None when the size does not fit."""
    size = _SIZE.unpack_from(data)[0] if len(data) >= 4 else len(data) + 1
    return _read(bytes(data), 0, size, True, frames) if size <= len(data) else None


FRAMES_SCHEMA = "path STRING, data_path STRING, frame_index LONG, values ARRAY<DOUBLE>, error STRING"
FrameRow = tuple[str, int, list[float]]
# rows per output batch: many small files share one, a long file is cut
OUTPUT_ROWS = 20_000


class FrameRows:
    """Rows of ``FRAMES_SCHEMA`` collected for one Arrow batch."""

    def __init__(self) -> None:
        self.columns: tuple[list, ...] = ([], [], [], [], [])

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, path: str, name: str | None, frame: int | None, values: list[float] | None, error: str | None = None) -> None:
        paths, names, frames, vectors, errors = self.columns
        paths.append(path)
        names.append(name)
        frames.append(frame)
        vectors.append(values)
        errors.append(error)

    def take(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.string()]
        names = ["path", "data_path", "frame_index", "values", "error"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)], names=names)
        self.__init__()
        return batch


def bson_frames(content: bytes) -> Iterator[FrameRow]:
    """(data_path, frame_index, vector) of a main document (``data``) or a hand document (``frames``)."""
    doc = decode_bson(content, frames=True)
    if doc is None or not ("data" in doc or "frames" in doc):
        raise ValueError("no data and no frames")
    for topic, frames in (doc.get("data") or {}).items():
        for i, frame in enumerate(frames if isinstance(frames, list) else ()):
            if isinstance(frame, tuple):
                layout, numbers = frame
                for field, first, last in layout.main:
                    yield topic + field, i, list(numbers[first:last])
                continue
            for field, values in (frame.get("data") or {}).items():
                if isinstance(values, list):
                    yield f"{topic}.{field}", i, values
    for i, frame in enumerate(doc.get("frames") or ()):
        if isinstance(frame, tuple):
            layout, numbers = frame
            for name, first, last in layout.hand:
                yield name, i, list(numbers[first:last])
            continue
        for part, hands in frame.items():
            for hand, values in (hands.items() if isinstance(hands, dict) else ()):
                if isinstance(values, list):
                    yield f"{part}.{hand}", i, values


def ingest_bson(files: DataFrame, decoder: Callable[[bytes], Iterator[FrameRow]] = bson_frames) -> DataFrame:
    """Frame vectors of binary files (path, content); a file that cannot be read has one row with ``error``.

    Store the result before splitting it by ``error``, else the files are decoded once per part.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = FrameRows()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    for name, i, values in decoder(content.as_py()):
                        rows.add(path, name, i, [float(v) for v in values])
                        if len(rows) >= OUTPUT_ROWS:
                            yield rows.take()
                except (ValueError, TypeError, AttributeError) as exc:
                    rows.add(path, None, None, None, str(exc))
                if len(rows) >= OUTPUT_ROWS:
                    yield rows.take()
        if len(rows):
            yield rows.take()

    return files.select("path", "content").mapInArrow(decode, FRAMES_SCHEMA)


# fixed values: video extensions
VIDEO_EXTENSIONS = [".mp4", ".avi", ".mov", ".mkv", ".flv", ".wmv", ".webm", ".m4v"]
_ISO = (".mp4", ".mov", ".m4v")
# fixed values: first bytes of the other containers
_SIGNATURES = {
    ".avi": b"RIFF",
    ".mkv": b"\x1a\x45\xdf\xa3",
    ".webm": b"\x1a\x45\xdf\xa3",
    ".flv": b"FLV",
    ".wmv": b"\x30\x26\xb2\x75\x8e\x66\xcf\x11",
}


def check_container(path: str, content: bytes) -> list[str]:
    """Errors of a video container: signature, and for ISO files the chain of boxes."""
    ext = "." + path.rsplit(".", 1)[-1].lower()
    if not content:
        return ["empty file"]
    if ext not in _ISO:
        return [] if content.startswith(_SIGNATURES[ext]) else [f"no {ext[1:]} signature"]
    if content[4:8] != b"ftyp":
        return ["no ftyp box at the start"]
    at, kinds = 0, set()
    while at + 8 <= len(content):
        size = int.from_bytes(content[at : at + 4], "big")
        kinds.add(content[at + 4 : at + 8])
        if size == 1:
            size = int.from_bytes(content[at + 8 : at + 16], "big")
        if size == 0:
            at = len(content)
            break
        if size < 8 or at + size > len(content):
            return [f"box at {at} is cut"]
        at += size
    errors = [] if at == len(content) else [f"{len(content) - at} bytes after the last box"]
    return errors if b"moov" in kinds else [*errors, "no moov box"]


def read_binary(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, content) of all files below ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")


def bad_media(files: DataFrame, checker: Callable[[str, bytes], list[str]] = check_container) -> DataFrame:
    """(path, errors) of the videos that fail; ``checker`` may be a full decoder."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    errors = checker(path, content)
                except Exception as exc:  # a decoder may fail in any way; that is a finding
                    errors = [f"unhandled error: {exc}"]
                if errors:
                    rows.append((path, errors))
            yield pd.DataFrame(rows, columns=["path", "errors"])

    pattern = "(?i)(" + "|".join(e.replace(".", r"\.") for e in VIDEO_EXTENSIONS) + ")$"
    videos = files.where(F.col("path").rlike(pattern)).select("path", "content")
    return videos.mapInPandas(check, "path STRING, errors ARRAY<STRING>")
