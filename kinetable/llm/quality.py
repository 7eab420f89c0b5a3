"""Quality rules with cross-document line frequency; DataFrame functions only.

Base rules look at one text. The frequency rule hashes the normalised lines, counts the
different documents of a host that hold a line, takes the lines above the limit away, and
rejects documents that are left depleted. Exact copies of a text count as one document, so a
group of copies does not make its own lines frequent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import BLANKS, SPACE, join_on, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: a line is frequent in more than this many documents of its host, and more than this percentage of them
LINE_DOCS, LINE_PERCENT = 10, 1
#: a document is depleted when less than this share of its words remains
REMAINING = 0.5
#: up to so many different repeated windows are looked up directly, more by a sort
FEW = 64


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def base_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Everything is computed inside the row: no shuffle. Null texts have no words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    has_word = F.filter(F.split(whole, "\n", -1), lambda line: F.translate(line, BLANKS, "") != "")
    df = docs.withColumns({"_words": F.transform(words(whole), lambda w: F.xxhash64(w)), "_lines": has_word})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.translate(whole, BLANKS, "")).cast("bigint"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            # hashes of all windows of three words
            "_windows": F.transform(
                F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        }
    )
    df = df.withColumn("_sorted", F.sort_array("_windows"))
    df = df.withColumn("_again", F.array_distinct(F.filter("_sorted", lambda h, i: h == F.get("_sorted", i + 1))))
    # places of the repeated windows: looked up when they are few, else neighbours in a sort of (hash, place)
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_pairs", F.when(F.size("_again") > FEW, pairs))
    looked_up = F.filter(F.transform("_windows", lambda h, i: F.when(F.array_contains("_again", h), i)), lambda i: i.isNotNull())
    near = F.filter(
        "_pairs", lambda p, i: (p["h"] == F.get("_pairs", i + 1)["h"]) | F.coalesce(p["h"] == F.get("_pairs", i - 1)["h"], F.lit(False))
    )
    places = (
        F.when(F.size("_again") == 0, F.array().cast("array<int>"))
        .when(F.col("_pairs").isNull(), looked_up)
        .otherwise(F.sort_array(F.transform(near, lambda p: p["i"])))
    )
    df = df.withColumn("_places", places)
    # a window covers three words, fewer when the next repeated one begins before
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_places", i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    df = df.withColumn("n_repeat_words", covered.cast("bigint"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_words", "_windows", "_sorted", "_again", "_pairs", "_places")


METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, f"[{SPACE}]+", " ")))


def quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", percent: int = LINE_PERCENT, spare: bool = False) -> DataFrame:
    """(id, host, text hash, metrics, n_removed_words, removed line hashes, kept), one row per row of ``docs``.

    A line is frequent in more than LINE_DOCS texts of its host and more than ``percent`` percent of
    them: the count keeps the lines of a small host, the percentage the ordinary short lines of a
    host of millions. ``spare`` leaves it in one text of the host, the one with the least hash, so
    that a group of near copies is not lost altogether.

    A null host is a host of its own. Rows that repeat id, host and text get the same result.
    Only hashes and counts are shuffled, never a text; counts are pre-aggregated, so a frequent
    line or a hot host does not meet in one task.
    """
    keys = ["_id", "_host", "_hash"]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    rows = base_metrics(rows.withColumn("_hash", F.xxhash64("_text")), "_text")
    blanks = lambda line: F.length(line) - F.length(F.translate(line, " ", ""))
    hashed = F.transform(F.transform("_lines", normal), lambda n: F.struct(F.xxhash64(n).alias("h"), (blanks(n) + 1).cast("bigint").alias("w")))
    rows = stored(rows.select(*keys, *METRICS, hashed.alias("_lines")), "quality")

    texts = rows.select("_host", "_hash")
    hosts = texts.distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("n_docs"))
    lines = rows.select("_host", "_hash", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("h"))
    counts = lines.distinct().groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n"), F.min("_hash").alias("_spared")).where(F.col("n") > LINE_DOCS)
    common = join_on(counts, hosts, ["_host"], nulls=("_host",)).where(100 * F.col("n") > percent * F.col("n_docs")).select("_host", "h", "_spared")

    once = rows.select(*keys, "_lines").dropDuplicates(keys).select(*keys, F.inline("_lines"))
    found = join_on(once, common, ["_host", "h"], nulls=("_host",))
    if spare:
        found = found.where(F.col("_hash") != F.col("_spared"))
    removed = found.groupBy(*keys).agg(F.sum("w").alias("_removed"), F.collect_set("h").alias("_gone"))
    joined = join_on(rows, removed, keys, "left", nulls=("_id", "_host"))
    joined = joined.select(*keys, *METRICS, F.coalesce("_removed", F.lit(0)).alias("n_removed_words"), "_gone")
    enough = F.col("n_words") - F.col("n_removed_words") >= REMAINING * F.col("n_words")
    return joined.withColumn("kept", ~F.col("base_failed") & enough)


def clean_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", percent: int = LINE_PERCENT, spare: bool = False) -> DataFrame:
    """Rows of ``docs`` that are kept, their frequent lines taken out of ``text``, and n_removed_words."""
    verdicts = quality(docs, id_col, text, host, percent, spare).where(~F.col("kept") | F.col("_gone").isNotNull())
    verdicts = verdicts.select("_id", "_host", "_hash", "kept", "n_removed_words", "_gone").dropDuplicates(["_id", "_host", "_hash"])
    verdicts = verdicts.withColumnsRenamed({"kept": "_kept", "n_removed_words": "_words"})
    marked = docs.withColumns({"_id": F.col(id_col), "_host": F.col(host), "_hash": F.xxhash64(text)})
    joined = join_on(marked, verdicts, ["_id", "_host", "_hash"], "left", nulls=("_id", "_host")).where(F.coalesce("_kept", F.lit(True)))
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains("_gone", F.xxhash64(normal(line)))), "\n")
    joined = joined.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    joined = joined.withColumn("n_removed_words", F.coalesce("_words", F.lit(0)))
    return joined.drop("_id", "_host", "_hash", "_kept", "_words", "_gone")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", percent: int = LINE_PERCENT, spare: bool = False) -> DataFrame:
    """``clean_good`` with the columns of ``docs`` alone."""
    return clean_good(docs, id_col, text, host, percent, spare).select(*[F.col(f"`{c}`") for c in docs.columns])
