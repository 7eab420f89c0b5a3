"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def sample_ids(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """Distinct ids of ``rows``: all when there are ``most`` at most, else about ``most`` by the hash of the id.

    The result has a bounded number of rows, so it may be broadcast. The same rows give the same
    sample.
    """
    ids = rows.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    count = ids.count()
    if count > most:
        ids = ids.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(_RANGE)) < int(most / count * _RANGE))
    return ids
