"""JSON documents of layouts that no schema names, as variant columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_texts(texts: DataFrame, value: str = "value") -> DataFrame:
    """``texts`` with ``document VARIANT`` in place of the JSON text; null where the text is no JSON."""
    return texts.withColumn("document", F.try_parse_json(value)).drop(value)


def document_frames(documents: DataFrame, path: str = "$.data") -> DataFrame:
    """One row per element of the array at ``path``, as ``frame_index`` and ``frame VARIANT``; other documents have none."""
    frames = F.try_variant_get("document", path, "array<variant>")
    return documents.select(*[c for c in documents.columns if c != "document"], F.posexplode(frames).alias("frame_index", "frame"))


def leaves(rows: DataFrame, column: str, keep: list[str], depth: int = 8) -> DataFrame:
    """(keep..., leaf, kind, value): the scalar leaves of a variant with their path, whatever the layout.

    A JSON null is a leaf of kind VOID without a value. Objects and arrays are opened level by level, ``depth`` at most; what is deeper is one leaf
    with its JSON. Array places are part of the path. Needs no schema and no look at the data first.
    """
    told = rows.select(*keep, F.lit("$").alias("leaf"), F.col(column).alias("_v"))
    found: DataFrame | None = None
    for level in range(depth + 1):
        nested = _nested(F.col("_v"))
        done = told if level == depth else told.where(~nested)
        kind = F.schema_of_variant("_v")
        value = F.when(kind != "VOID", F.coalesce(F.try_variant_get("_v", "$", "string"), F.to_json("_v")))
        done = done.select(*keep, "leaf", kind.alias("kind"), value.alias("value"))
        found = done if found is None else found.unionByName(done)
        if level < depth:
            opened = told.where(nested).lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_v").outer()))
            step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
            told = opened.select(*keep, F.concat("leaf", step).alias("leaf"), F.col("value").alias("_v"))
    return found


def _nested(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")
