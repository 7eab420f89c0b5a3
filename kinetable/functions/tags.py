"""Tag text: ``key: value`` lines to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: patterns of a tag line and of the value separators, and the hierarchy keys
TAG_LINE = r"(?U)^([^:：]+?)\s*[:：]\s*(.+)$"
SEPARATORS = r"(?U)[、，,\s;；]+"
HIERARCHY_KEYS = ["物品类别", "物品", "category", "object_path", "物体类别", "分类"]
LEVELS = 5

_EDGES = r"(?U)^\s+|\s+$"
_INTEGER = r"^-?[0-9]+$"
_DECIMAL = r"(?i)^[+-]?(?:(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)(?:e[+-]?[0-9]+)?|inf|infinity|nan)$"


def strip(text: Column) -> Column:
    """Both ends without white space of any kind."""
    return F.regexp_replace(text, _EDGES, "")


def tag_numeric(value: Column) -> Column:
    """STRUCT(text, integer, big, decimal): one of the last three is set when the text is a number.

    Whole numbers beyond 64 bits are ``big`` (38 digits); beyond that they are the nearest
    ``decimal``, and the text keeps the digits.
    """
    text = strip(value)
    whole = text.rlike(_INTEGER)
    integer = F.when(whole, text.try_cast("bigint"))
    big = F.when(whole & integer.isNull(), text.try_cast("decimal(38,0)"))
    number = F.when(whole, integer.isNull() & big.isNull()).otherwise(text.rlike(_DECIMAL))
    decimal = F.when(number, F.regexp_replace(text, "_", "").try_cast("double"))
    return F.struct(text.alias("text"), integer.alias("integer"), big.alias("big"), decimal.alias("decimal"))


def tag_hierarchy(path: Column, delimiter: str = "-", levels: int = LEVELS) -> Column:
    """``A-B-C`` to STRUCT(level1..): parts trimmed, empty ones dropped, padded with null."""
    parts = F.filter(F.transform(F.split(path, _quote(delimiter)), strip), lambda p: p != "")
    return F.struct(*[F.get(parts, F.lit(i)).alias(f"level{i + 1}") for i in range(levels)])


def _quote(delimiter: str) -> str:
    return r"\Q" + delimiter + r"\E"


def tag_entries(text: Column) -> Column:
    """ARRAY<STRUCT(key, values)> of the matching lines; the last line of a repeated key counts."""
    lines = F.filter(F.transform(F.split(text, r"\R"), strip), lambda line: line.rlike(TAG_LINE))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            strip(F.regexp_extract(line, TAG_LINE, 1)).alias("key"),
            F.filter(F.split(strip(F.regexp_extract(line, TAG_LINE, 2)), SEPARATORS), lambda v: v != "").alias("values"),
        ),
    )
    return F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))


def tag_map(text: Column) -> Column:
    """MAP<STRING, ARRAY<STRING>> of a tag text."""
    return F.map_from_entries(tag_entries(text))


def tag_values(key: Column, values: Column, hierarchy_keys: Sequence[str] = tuple(HIERARCHY_KEYS)) -> dict[str, Column]:
    """Typed alternatives of one tag: a hierarchy for the listed keys, else numbers and texts."""
    hierarchical = key.isin(list(hierarchy_keys)) & (F.size(values) > 0)
    return {
        "hierarchy": F.when(hierarchical, tag_hierarchy(F.get(values, F.lit(0)))),
        "items": F.when(~hierarchical, F.transform(values, tag_numeric)),
        "is_list": ~hierarchical & (F.size(values) != 1),
    }
