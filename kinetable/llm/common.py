"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.session import remove, scratch_dir

#: ASCII white space: what separates words
SPACE = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"

TABLES = {
    "documents": "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
    "embeddings": "vec_id LONG, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id LONG, url STRING, html STRING",
    "labels": "doc_id LONG, quality INT, toxic INT",
    "conversations": "conv_id LONG, turn LONG, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Stored:
    """A table written to the shared scratch folder, and how to remove it."""

    def __init__(self, df: DataFrame, label: str) -> None:
        self.spark = df.sparkSession
        self.path = scratch_dir(self.spark, label) + "/table"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only when no later plan reads them."""
        remove(self.spark, self.path.removesuffix("/table"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: its lineage ends here, in files that all executors share."""
    return Stored(df, label).df


def steps(sizes: np.ndarray, rows: int = 512, limit: int = 16 << 20) -> list[tuple[int, int]]:
    """(start, rows) runs of at most ``rows`` texts and about ``limit`` bytes, one text at least."""
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (i - start == rows or held + size > limit):
            out.append((start, i - start))
            start, held = i, 0
        held += size
    if len(sizes):
        out.append((start, len(sizes) - start))
    return out


def map_texts(
    df: DataFrame, text: str, keep: list[str], new: list[tuple[str, str, pa.DataType]], fn: Callable[[list[str | None]], list[list]]
) -> DataFrame:
    """``keep`` columns of ``df`` and new columns (name, Spark type, Arrow type) from ``fn`` over the texts of a batch.

    No shuffle: every Arrow batch, which Spark bounds by its bytes, is handled on its own in small
    steps. ``fn`` gives one list per new column.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]
    schema = ", ".join(fields + [f"`{n}` {t}" for n, t, _ in new])
    names = [*keep, *[n for n, _, _ in new]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # small steps: the Python copies of a batch's texts never stand beside each other
            for at, rows in steps(pc.binary_length(batch.column(len(keep))).fill_null(0).to_numpy()):
                part = batch.slice(at, rows)
                made = fn(part.column(len(keep)).to_pylist())
                columns = [part.column(i) for i in range(len(keep))]
                columns += [pa.array(values, type=kind) for values, (_, _, kind) in zip(made, new, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def join_on(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner", nulls: tuple[str, ...] = ()) -> DataFrame:
    """Equi-join on ``names`` that keeps the left key columns; in the columns of ``nulls`` null equals null.

    ``right`` must not have other columns named like ``left``'s.
    """
    renamed = right.select(*[F.col(c).alias(f"_right{c}") if c in names else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in names:
        same = same & (F.col(c).eqNullSafe(F.col(f"_right{c}")) if c in nulls else F.col(c) == F.col(f"_right{c}"))
    return left.join(renamed, same, how).drop(*[f"_right{c}" for c in names])
