"""SimHash near-dedup by multi-index hashing.

Fingerprints are 64-bit majorities over the XXH64 of word shingles. Links (at most ``RADIUS``
differing bits) are found by two 32-bit segment tables: two fingerprints within 2 bits agree in
one segment up to 1 bit, so every fingerprint probes the 33 keys of the ball of radius 1 in each
segment, and a match is kept when the complete distance is small enough. Equal fingerprints
collapse before anything is probed, so a group of copies, however large, is one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import map_texts, stored
from kinetable.llm.components import components

SEED = 42
WIDTH = 3
RADIUS = 2
BLOCK_BYTES = 1 << 20
#: numbers below stand for rows without an id
NO_ID = -(1 << 62)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACES = b" \t\n\x0b\x0c\r"


def _blocks(data: bytes):
    """Word lists of pieces of about BLOCK_BYTES, cut at white space: memory stays bounded for any text."""
    at, end = 0, len(data)
    while at < end:
        stop = min(end, at + BLOCK_BYTES)
        while stop < end and data[stop] not in _SPACES:
            stop += 1
        yield data[at:stop].split()
        at = stop


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of one text; 0 for null and for a text without words."""
    counts, total, held = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in _blocks((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        words = held + words
        if len(words) >= width:
            shingles = [words[i:] for i in range(width)]
            hashes = np.fromiter((digest(b" ".join(s), seed) for s in zip(*shingles, strict=False)), "<u8")
            for i in range(0, len(hashes), 1 << 16):
                counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
            total += len(hashes)
        held = words[len(words) - width + 1 :] if len(words) >= width else words
    if not total and held:
        counts += np.unpackbits(np.array([digest(b" ".join(held), seed)], "<u8").view(np.uint8), bitorder="little")
        total = 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``fp``, the signed SimHash, one row per row of ``docs``."""
    return map_texts(docs, text, keep, [("fp", "bigint", pa.int64())], lambda texts: [[fingerprint(t) for t in texts]])


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of the different values of ``distinct(fp)`` within ``radius`` bits.

    Only for a radius of 2 or less: with two segments a ball of radius 1 misses no such pair.
    A fingerprint has a bounded number of such neighbours, so the result grows with the input.
    """
    if radius > 2:
        raise ValueError("two segments with balls of radius 1 cover a distance of 2 at most")
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    halves = F.array(F.struct(F.lit(0).alias("seg"), low.alias("key")), F.struct(F.lit(1).alias("seg"), high.alias("key")))
    entries = distinct.select("fp", F.inline(halves))
    masks = F.array(*[F.lit(m).cast("bigint") for m in [0, *[1 << i for i in range(32)]]])
    probes = entries.select(F.col("fp").alias("a"), "seg", F.explode(F.transform(masks, lambda m: F.col("key").bitwiseXOR(m))).alias("key"))
    tables = entries.select(F.col("fp").alias("b"), "seg", "key")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    same = (F.col("p.seg") == F.col("t.seg")) & (F.col("p.key") == F.col("t.key"))
    return probes.alias("p").join(tables.alias("t"), same & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of fingerprints, itself included. Null
    and word-less texts have fingerprint 0 and link like any other; a null id is no id, so a
    group without any id has a null component. Repeated rows give repeated rows. Only the id
    and the fingerprint are shuffled.
    """
    rows = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), ["id"]), "simhash")
    groups = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash")
    roots = components(links(groups.select("fp")), "simhash")
    # fingerprints without a link are their own root
    member = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, find: Callable[[DataFrame, str, str], DataFrame], id_col: str, text: str) -> DataFrame:
    """One row of ``docs`` for each component that ``find`` gives: the one with the smallest id, all its columns.

    A row without an id stands under a number made from its text; of rows that repeat an id one
    stays.
    """
    key = F.coalesce(F.col(id_col), F.lit(NO_ID) - 1 - F.shiftrightunsigned(F.xxhash64(text), 2))
    keyed = docs.withColumn("_key", key)
    found = find(keyed, "_key", text)
    # the own number of a row without an id loses against any id
    winners = found.withColumn("_known", F.when(F.col("_key") >= NO_ID, F.col("_key")))
    ids = winners.groupBy("component_id").agg(F.coalesce(F.min("_known"), F.min("_key")).alias("_key")).select("_key")
    return keyed.join(ids, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, chosen by ``keep_first``."""
    return keep_first(docs, near_duplicates, id_col, text)
