"""Path and name columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPISODE_DIR = r"(?i)^(?:episode_?|ep_?)?([0-9]+)$"
IMAGE_NAME = r"(?i)([0-9])\.jpe?g$"
JPG_NAME = r"(?i)\.jpe?g$"


def number_key(digits: Column) -> Column:
    """Text of a digit run that sorts by its value, however long: the length's length, the length, the digits."""
    value = F.regexp_replace(digits, r"^0+(?=[0-9])", "")
    length = F.length(value).cast("string")
    return F.concat(F.length(length).cast("string"), length, value)


def natural_key(name: Column) -> Column:
    """Text that sorts digit runs by value, without a limit on their length."""
    runs = F.regexp_extract_all(name, F.lit("[0-9]+|[^0-9]+"), 0)
    return F.array_join(F.transform(runs, lambda run: F.when(run.rlike("^[0-9]"), number_key(run)).otherwise(run)), "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def ancestors(path: Column) -> Column:
    """All proper ancestor directories: '/a/b/c' -> ['/a', '/a/b']."""
    parts = F.split(path, "/")
    count = F.size(parts)
    return F.when(
        count > 2, F.transform(F.sequence(F.lit(2), count - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ).otherwise(F.array().cast("array<string>"))


def camera_index(name: Column) -> Column:
    """Last digit before a jpg/jpeg extension, null for other names."""
    digit = F.regexp_extract(name, IMAGE_NAME, 1)
    return F.when(digit != "", digit.cast("int"))


def camera_key_index(key: Column) -> Column:
    """Number at the end of a camera key, 0 without one."""
    digits = F.regexp_extract(key, r"([0-9]+)$", 1)
    return F.when(digits != "", digits.cast("int")).otherwise(0)


def frame_number(name: Column) -> Column:
    """Number before the first underscore of an image name ('00379_color_0.jpg' -> 379), null for other names."""
    digits = F.regexp_extract(stem(name), r"^([0-9]+)(?:_|$)", 1)
    return F.when(digits != "", digits.cast("long"))


def clean_dataset_name(address: Column) -> Column:
    """Leading ``[A-Za-z0-9_.-]+`` of the last path part, else ``unknown_dataset``."""
    last = base_name(F.regexp_replace(F.trim(address), r"/+$", ""))
    return F.coalesce(F.nullif(F.regexp_extract(last, r"^[a-zA-Z0-9_.\-]+", 0), F.lit("")), F.lit("unknown_dataset"))


def squeeze_blanks(text: Column) -> Column:
    """White-space runs to one underscore, then underscore runs to one."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", "_"), "_+", "_")


def stable_uuid(key: Column) -> Column:
    """UUID-shaped text from the SHA-256 of a key; the same on every recomputation."""
    digest = F.sha2(key.cast("string"), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])
