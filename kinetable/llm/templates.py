"""Line dedup by a log-template tree; DataFrame functions only.

A line goes down a tree of fixed depth: its number of tokens, then its leading tokens (digits
generalised). Below, a template leaves out one run of at most a fifth of the tokens, the
variable field; two lines with the same path that differ only inside that run share the
template, and so does a line that repeats exactly. A template that occurs in several documents
recurs: its lines stay in the first document that has it and are dropped from all others, so
no text is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import BLANKS, SPACE, join_on, stored

#: lines of fewer tokens are no template
MIN_TOKENS = 3
#: depth of the tree below the number of tokens
LEAD = 2
#: documents in which a template must occur to recur
MIN_DOCS = 3
#: share of the tokens that one variable field may take: lines agree in 0.8 or more
FIELD = 0.2
#: a passage has more tokens than this
PASSAGE = 50


def line_templates(docs: DataFrame, id_col: str, text: str, every: bool = False) -> DataFrame:
    """(_id, _hash, _no, _keys, _least_docs): template hashes of every line with enough tokens, and documents to recur.

    ``every``: lines of one or two tokens are whole-line templates too, and passages recur from two documents on.
    """
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), F.posexplode(F.split(text, "\n", -1)).alias("_no", "_line")
    )
    masked = F.regexp_replace(F.btrim("_line", F.lit(BLANKS)), "[0-9]+", "0")
    rows = rows.select("_id", "_hash", "_no", F.split(masked, f"[{SPACE}]+").alias("_tokens"))
    rows = rows.where((F.size("_tokens") >= MIN_TOKENS) | (F.lit(every) & (F.element_at("_tokens", 1) != "")))
    n = F.size("_tokens")
    rows = rows.withColumns({"_n": n, "_w": F.floor(n * FIELD).cast("int"), "_path": F.xxhash64(n, F.slice("_tokens", 1, LEAD))})
    # hash of every run of tokens below the path; in short lines all of them are one run
    width = F.when(F.col("_w") > 0, F.col("_w")).otherwise(F.col("_n"))
    rows = rows.withColumn("_width", width)
    starts = F.sequence(F.lit(0), F.ceil((F.col("_n") - LEAD) / F.col("_width")).cast("int") - 1)
    rows = rows.withColumn("_runs", F.transform(starts, lambda b: F.xxhash64(F.slice("_tokens", b * F.col("_width") + LEAD + 1, F.col("_width")))))
    # lines that repeat exactly share every template with a field; those without a field share the whole
    fields = F.transform(
        "_runs", lambda h, b: F.xxhash64("_path", b, F.concat(F.slice("_runs", F.lit(1), b), F.slice("_runs", b + 2, F.size("_runs"))))
    )
    keys = F.when(F.col("_w") > 0, fields).otherwise(F.array(F.xxhash64("_path", F.lit(-1), "_runs")))
    least = F.when(F.lit(every) & (F.col("_n") > PASSAGE), F.lit(2)).otherwise(F.lit(MIN_DOCS))
    return rows.select("_id", "_hash", "_no", keys.alias("_keys"), least.alias("_least_docs"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: bool = False) -> DataFrame:
    """(_id, _hash, _drop): for every document with such lines the sorted numbers (from 0) of those to drop.

    Rows that repeat id and text count once. Rows without an id are one document. Only hashes
    are shuffled. Counting is pre-aggregated, and a template's rows are split over tasks by the
    join, so a line of all documents does not meet in one task.
    """
    lines = stored(line_templates(docs, id_col, text, every), "templates")
    keyed = lines.select("_id", "_hash", "_no", "_least_docs", F.explode("_keys").alias("_key"))
    # a key holds the number of tokens, so all its rows have one limit
    limit = F.max("_least_docs").alias("_limit")
    often = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_least"), F.max("_id").alias("_most"), limit)
    often = often.where((F.col("_rows") >= F.col("_limit")) & (F.col("_least") < F.col("_most"))).select("_key")
    # only rows of templates that repeat go on: few, and the exact count needs a document once
    repeated = stored(keyed.join(often, "_key"), "templates")
    recurring = (
        repeated.groupBy("_key", "_id")
        .agg(F.max("_least_docs").alias("_least_docs"))
        .groupBy("_key")
        .agg(F.count("_least_docs").alias("_docs"), F.min("_id").alias("_first"), limit)
        .where(F.col("_docs") >= F.col("_limit"))
        .select("_key", "_first")
    )
    # stored, so that the join below is a plain one, whose hot keys Spark can split
    recurring = stored(recurring, "templates")
    later = repeated.join(recurring, "_key").where(~F.col("_id").eqNullSafe(F.col("_first")))
    return later.groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("_no")).alias("_drop"))


def drop_template_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: bool = False) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and n_lines, n_dropped (long).

    ``every`` as in ``line_templates``. One row per row. A null text stays null with 0 lines; a text may end up empty.
    """
    drops = dropped_lines(docs, id_col, text, every)
    marked = docs.withColumns({"_id": F.col(id_col), "_hash": F.xxhash64(text)})
    joined = join_on(marked, drops, ["_id", "_hash"], "left", nulls=("_id",)).drop("_id", "_hash")
    lines = F.split(text, "\n", -1)
    joined = joined.withColumn("n_lines", F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint"))
    joined = joined.withColumn("n_dropped", F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint"))
    joined = joined.withColumn("n_dropped", F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.col("n_dropped")))
    joined = joined.withColumn("_lines", F.when(F.col("_drop").isNotNull(), lines))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_drop")
    joined = joined.withColumn("_stay", F.when(F.col("_drop").isNotNull(), stay))
    cleaned = F.array_join(F.transform("_stay", lambda i: F.get("_lines", i)), "\n")
    return joined.withColumn(text, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(cleaned)).drop("_drop", "_lines", "_stay")
