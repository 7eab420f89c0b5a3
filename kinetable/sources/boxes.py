"""Container checks of media files by range reads: box headers as rows, whatever the size of a file.

A task reads the headers of a file only, some bytes each, and jumps over what a box holds. What is
wrong with a file then follows from its rows by DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.sources.binary import _ISO, _SIGNATURES, VIDEO_EXTENSIONS
from kinetable.sources.walk import read_range

#: (path, offset, length) to bytes
Reader = Callable[[str, int, int], bytes]
ROWS = 10_000
#: fixed value: bytes of a box header with a 64-bit size
HEADER = 16
BOXES = "path STRING, length LONG, no LONG, offset LONG, kind STRING, size LONG, error STRING"


def box_headers(path: str, length: int, read: Reader) -> Iterator[tuple]:
    """(no, offset, kind, size, error) of the boxes of an ISO file, in order; a box that does not fit is the last.

    Size 0 means up to the end of the file. Fewer than 8 bytes at the end are a row without a kind.
    """
    at = no = 0
    while at < length:
        head = read(path, at, HEADER)
        if len(head) < 8:
            yield no, at, None, length - at, "bytes after the last box"
            return
        size, kind = int.from_bytes(head[:4], "big"), head[4:8].decode("latin-1")
        if size == 1:
            size = int.from_bytes(head[8:16], "big") if len(head) == HEADER else 0
            least = HEADER
        else:
            size, least = size or length - at, 8
        cut = size < least or at + size > length
        yield no, at, kind, size, "cut" if cut else None
        if cut:
            return
        at, no = at + size, no + 1


def read_boxes(listing: DataFrame, read: Reader = read_range) -> DataFrame:
    """Box rows of the videos of ``listing(path, length)``; other containers have one row with their first bytes in hex as kind.

    A file that cannot be read has one row with the error. Every file has at least one row; that of an
    empty file has no kind.
    """
    names = ["path", "length", "no", "offset", "kind", "size", "error"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def rows(path: str, length: int) -> Iterator[tuple]:
        try:
            if not length:
                yield 0, 0, None, 0, "empty file"
            elif path.lower().endswith(_ISO):
                yield from box_headers(path, length, read)
            else:
                yield 0, 0, read(path, 0, HEADER).hex(), length, None
        except OSError as exc:
            yield 0, 0, None, 0, f"not readable: {type(exc).__name__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

        for given in batches:
            for path, length in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
                for row in rows(path, length):
                    held.append((path, length, *row))
                    if len(held) == ROWS:
                        yield batch()
                        held = []
        if held:
            yield batch()

    pattern = "(?i)(" + "|".join(e.replace(".", r"\.") for e in VIDEO_EXTENSIONS) + ")$"
    return listing.where(F.col("path").rlike(pattern)).select("path", "length").mapInArrow(run, BOXES)


def box_findings(boxes: DataFrame) -> DataFrame:
    """(path, boxes, errors) of every file of ``read_boxes``; ``errors`` is empty for a sound one.

    The same findings as the check of whole contents gives, in its order. Grouping is pre-aggregated.
    """
    ext = F.lower(F.regexp_extract("path", r"\.[^./]*$", 0))
    iso = ext.isin(*_ISO)
    signature = F.create_map(*[F.lit(v) for e, s in _SIGNATURES.items() for v in (e, s.hex())])
    told = boxes.withColumns(
        {
            "_whole": (F.col("error") == "empty file") | F.col("error").startswith("not readable"),
            "_start": iso & (F.col("no") == 0) & ~F.coalesce(F.col("kind") == "ftyp", F.lit(False)),
            "_cut": F.when(F.col("error") == "cut", F.concat(F.lit("box at "), "offset", F.lit(" is cut"))),
            "_tail": F.when(F.col("error") == "bytes after the last box", F.concat("size", F.lit(" bytes after the last box"))),
            "_unsigned": ~iso & ~F.coalesce(F.startswith("kind", F.element_at(signature, ext)), F.lit(False)),
        }
    )
    files = told.groupBy("path").agg(
        F.count(F.when(F.col("kind").isNotNull() & iso, 1)).alias("boxes"),
        F.max(F.when(F.col("_whole"), F.col("error"))).alias("_whole"),
        F.bool_or("_start").alias("_start"),
        F.max("_cut").alias("_cut"),
        F.max("_tail").alias("_tail"),
        F.bool_or(F.coalesce(F.col("kind") == "moov", F.lit(False))).alias("_moov"),
        F.bool_or("_unsigned").alias("_unsigned"),
    )
    missing = F.when(~F.col("_moov"), "no moov box")
    errors = (
        F.when(F.col("_whole").isNotNull(), F.array("_whole"))
        .when(~iso, F.array_compact(F.array(F.when(F.col("_unsigned"), F.concat(F.lit("no "), F.substring(ext, 2, 9), F.lit(" signature"))))))
        .when(F.col("_start"), F.array(F.lit("no ftyp box at the start")))
        .when(F.col("_cut").isNotNull(), F.array("_cut"))
        .otherwise(F.array_compact(F.array("_tail", missing)))
    )
    return files.select("path", "boxes", errors.alias("errors"))
