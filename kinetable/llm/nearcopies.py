"""Near copies of texts: five-word Jaccard similarity of 0.8 or more, verified exactly.

Candidates come from min-hash bands over the word shingles: 24 keys of 5 minima miss a pair at the
limit with a probability of 0.00007. (Pairs at the limit differ in 10 bits of a 64-bit SimHash in
the mean, which no set of segments and balls finds without a share of all pairs.) Texts of the same
words collapse first, so a group of copies, however large, is one row. A key's texts meet its two
end points; whatever is then still apart meets the rest of the key, so a large group of near copies
is not compared pair by pair and no link of the candidates is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import map_texts, stored
from kinetable.llm.components import components
from kinetable.llm.simhash import _LOWER, _blocks, keep_first

SEED = 42
WIDTH = 5
BANDS, ROWS = 24, 5
#: shingles whose BANDS * ROWS hashes stand in memory at once
STEP = 512

_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) << np.uint64(1)
_MUL = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) << np.uint64(1) | np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, width: int = WIDTH):
    """Arrays of the 64-bit hashes of all shingles, in order; a text of fewer words is one shingle."""
    digest, held, some = xxhash.xxh64_intdigest, np.empty(0, np.uint64), False
    for words in _blocks((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        held = np.concatenate([held, np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))])
        n = len(held) - width + 1
        if n > 0:
            out = np.zeros(n, np.uint64)
            for i in range(width):
                out = (out + held[i : i + n]) * _PRIME
            yield _mix(out)
            held, some = held[n:], True
    if not some and len(held):
        out = np.full(1, len(held), np.uint64)
        for h in held:
            out = (out + h) * _PRIME
        yield _mix(out)


def text_hash(text: str | None) -> int:
    """Signed hash of the words in order."""
    state = xxhash.xxh64(seed=SEED)
    for words in _blocks((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        for w in words:
            state.update(w + b" ")
    return state.intdigest() - (1 << 63)


def band_keys(text: str | None) -> list[int]:
    """BANDS signed keys of one text; none for a text without words."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    some = False
    for hashes in shingles(text):
        some = True
        for i in range(0, len(hashes), STEP):
            np.minimum(low, ((hashes[None, i : i + STEP] ^ _XOR) * _MUL).min(1), out=low)
    if not some:
        return []
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        keys = _mix((keys + column) * _PRIME)
    return keys.view(np.int64).tolist()


def shingle_set(text: str | None) -> list[int]:
    found = [np.unique(h) for h in shingles(text)]
    return np.unique(np.concatenate(found)).view(np.int64).tolist() if found else []


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of ``pairs(a, b)`` whose shingle sets have a Jaccard similarity of 0.8 or more: 9 * common >= 4 * (n + m)."""
    left, right = sets.select(F.col("doc").alias("a"), F.col("s").alias("sa")), sets.select(F.col("doc").alias("b"), F.col("s").alias("sb"))
    both = 4 * (F.size("sa") + F.size("sb"))
    near = (9 * F.least(F.size("sa"), F.size("sb")) >= both) & (9 * F.size(F.array_intersect("sa", "sb")) >= both)
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, component_id) for every row of ``docs``: the smallest id reachable over links, itself included.

    Linked are texts of the same words and texts with a Jaccard similarity of 0.8 or more of their
    different five-word shingles. Ids are not null; a repeated id stands for each of its texts.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    new = [("doc", "bigint", pa.int64()), ("bands", "array<bigint>", pa.list_(pa.int64()))]
    rows = stored(map_texts(base, "text", ["id"], new, lambda ts: [[text_hash(t) for t in ts], [band_keys(t) for t in ts]]), "nearcopies")
    texts = stored(rows.groupBy("doc").agg(F.min("id").alias("first"), F.first("bands").alias("bands")), "nearcopies")
    entries = stored(texts.select("doc", F.explode("bands").alias("band")), "nearcopies")
    ends = entries.groupBy("band").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    # stored, so that the join below is a plain one, whose hot keys Spark can split
    members = stored(entries.join(stored(ends, "nearcopies"), "band"), "nearcopies")

    met = members.select("doc", F.explode(F.array("low", "high")).alias("end")).where("doc <> end")
    met = stored(met.select(F.least("doc", "end").alias("a"), F.greatest("doc", "end").alias("b")).distinct(), "nearcopies")
    wanted = texts.join(members.select("doc").distinct(), "doc", "left_semi").select(F.col("first").alias("id"), "doc")
    sets = map_texts(
        base.join(wanted, "id"), "text", ["doc"], [("own", "bigint", pa.int64()), ("s", "array<bigint>", pa.list_(pa.int64()))],
        lambda ts: [[text_hash(t) for t in ts], [shingle_set(t) for t in ts]],
    )
    # an id may stand for several texts
    sets = stored(sets.where("own = doc").dropDuplicates(["doc"]).select("doc", "s"), "nearcopies")
    links = stored(_verified(met, sets), "nearcopies")
    roots = components(links, "nearcopies")

    placed = stored(members.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select("band", "doc", F.coalesce("root", "doc").alias("root")), "nearcopies")
    parts = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("band").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "root"))["root"].alias("main")).where("parts > 1")
    mixed = stored(mixed.select("band", "main"), "nearcopies")
    split = stored(placed.join(mixed, "band"), "nearcopies")
    # of two texts that are still apart, one at least is outside the largest part of the key
    outside = split.where("root <> main").select("band", F.col("doc").alias("x"), F.col("root").alias("rx"))
    apart = outside.join(split.select("band", "doc", "root"), "band").where("rx <> root")
    apart = apart.select(F.least("x", "doc").alias("a"), F.greatest("x", "doc").alias("b")).distinct().join(met, ["a", "b"], "left_anti")
    more = stored(_verified(apart, sets), "nearcopies")
    if not more.isEmpty():
        roots = components(links.union(more), "nearcopies")

    member = texts.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "first", F.coalesce("root", "doc").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(smallest, "root").select("doc", "component_id")
    return rows.select("id", "doc").join(named, "doc").select(F.col("id").alias(id_col), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of near copies, as ``simhash.drop_near_duplicates`` keeps it."""
    return keep_first(docs, near_copies, id_col, text)
