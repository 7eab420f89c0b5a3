"""Cleaning of registry records and the text of a dataset card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetable.functions.names import squeeze_blanks, stable_uuid

# fixed values: keys an object may have
OBJECT_KEYS = ["object_name", "level1", "level2", "level3", "level4", "level5"]

# fixed values: layout of a dataset card
CARD = """---
license: {license}
language:{language}
task_categories:{task_categories}
tags:{tags}
size_categories: {size_categories}
configs:
- config_name: {config_name}
  data_files: {data_files}
---

## Dataset Authors
This dataset is contributed by [{contributed_by}]

This dataset is annotated by [{annotated_by}]

## Dataset Description
{dataset_description}

- **Homepage:** {homepage}
- **Paper:** {paper}
- **License:** {license}

## Dataset Tags
{tag_lines}

## Task Descriptions
### tasks
{tasks}

### sub_tasks
{sub_tasks}

## Dataset Structure

[meta/info.json](meta/info.json):
```json
{meta_info}
```

## Citation
```bibtex
{citation_bibtex}
```"""


def normalise_object(entry: Column) -> Column:
    """One object map to STRUCT(object_name, level1..level5).

    A key that is not an object key is the name itself. When both occur the later one counts.
    """
    pairs = F.map_entries(entry)
    named = F.filter(pairs, lambda e: (e["key"] == "object_name") | ~e["key"].isin(OBJECT_KEYS))
    last = F.try_element_at(named, F.lit(-1))
    name = F.when(last["key"] == "object_name", last["value"]).otherwise(last["key"])
    levels = [F.regexp_replace(entry[k], r"(?U)\s+", "_").alias(k) for k in OBJECT_KEYS[1:]]
    return F.struct(F.regexp_replace(name, r"(?U)\s+", "_").alias("object_name"), *levels)


def normalise_records(records: DataFrame, objects: str = "objects") -> DataFrame:
    """Blanks to underscores in every top-level text; object maps to one shape."""
    out = {}
    for field in records.schema.fields:
        if field.name == objects:
            present = F.filter(objects, lambda o: o.isNotNull() & (F.size(o) > 0))
            out[objects] = F.transform(present, normalise_object)
        elif isinstance(field.dataType, T.StringType):
            out[field.name] = squeeze_blanks(F.col(field.name))
    return records.withColumns(out)


def assign_uuid(records: DataFrame, key: Sequence[str], column: str = "dataset_uuid") -> DataFrame:
    """Keep existing ids, derive missing ones from the key, so a recomputation gives the same id."""
    return records.withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), stable_uuid(F.concat_ws("/", *key))))


def _bullets(items: Column, lead: str) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit(lead), x)), "")


def _people(items: Column) -> Column:
    return F.array_join(
        F.transform(items, lambda p: F.concat(F.lit("["), p["name"], F.lit("]("), F.coalesce(p["url"], F.lit("")), F.lit(")"))), ", "
    )


def card_text(fields: dict[str, Column]) -> Column:
    """Card of one record: lists ``language task_categories tags``, people lists, and texts.

    The layout is cut at its fields and joined with the values; a missing text is empty.
    """
    values = dict(fields)
    values["tag_lines"] = F.array_join(F.transform(fields["tags"], lambda x: F.concat(F.lit("\n- "), x, F.lit("\n"))), "")
    for name in ("language", "task_categories", "tags"):
        values[name] = _bullets(fields[name], "\n  - ")
    for name in ("contributed_by", "annotated_by"):
        values[name] = _people(fields[name])
    pieces: list[Column] = []
    for part in CARD.split("{"):
        name, found, rest = part.partition("}")
        if not pieces and not found:
            pieces.append(F.lit(name))
            continue
        pieces += [F.coalesce(values[name].cast("string"), F.lit("")), F.lit(rest)]
    return F.concat(*pieces)
