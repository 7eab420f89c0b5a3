"""Training corpus from ``documents``: filter, clean, deduplicate, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.llm import mixing, nearcopies, quality, queries, simhash, templates
from kinetable.llm.common import stored, table
from kinetable.session import remove, scratch, scratch_dir


def with_n_chars(cleaned: DataFrame, taken: str, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; n_chars counted again where ``taken`` says that text went."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(taken) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return cleaned.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go, and so do lines that are frequent in a source but for one text; n_chars follows."""
    cleaned = quality.clean_good(docs, spare=True)
    return with_n_chars(cleaned, "n_removed_words", docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, but for their first document; n_chars follows the text.

    A document that loses lines and is left with too few words for the quality rules, or with less than
    the share that they ask to remain, goes: what it held stands in the documents before it. So the
    later ones of near copies go here, where their common lines do.
    """
    words = docs.withColumn("_words", F.size(quality.words(F.coalesce("text", F.lit("")))))
    cleaned = templates.drop_template_lines(words, every=True)
    left = F.size(quality.words(F.col("text")))
    enough = (left >= quality.MIN_WORDS) & (left >= quality.REMAINING * F.col("_words"))
    return with_n_chars(cleaned.where((F.col("n_dropped") == 0) | enough), "n_dropped", docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id.

    Groups are those of the SimHash fingerprints; among their first documents those of near copies,
    which differ in more bits than segment tables can look up.
    """
    return nearcopies.drop_near_copies(stored(simhash.drop_near_duplicates(docs), "simhash"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, not at all or up to three times."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row and the decoded bytes, as digests."""
    return queries.encode_digest(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: SimHash groups, Newton iterations and BPE are beyond SQL; tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before has written.

    What a stage made on its way is removed once its result is written, and its input once the next
    result is; only the last stage's input stays, which the result reads.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = scratch_dir(spark, name)
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(f"{folder}/table")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/table")
        if before is not None:
            remove(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
