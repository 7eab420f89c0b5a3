"""The queries of the numbered operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.llm import bytebpe, hardnegatives, langid, lattice, mixing, oracles, quality, repair, simhash, sitetemplates, templates, tokens, toxicity, urlrules
from kinetable.llm.common import table
from kinetable.llm.sampling import sample_ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def crc(id_col: str, modulus: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


@query("op1_lattice", oracles.LATTICE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op2_line_templates", oracles.TEMPLATES)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = templates.drop_template_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, ["doc_id"], public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(F.col("toxic").isNotNull() & (crc("doc_id", 4) != 2))
    chosen = known.join(F.broadcast(sample_ids(known, "doc_id", toxicity.MAX_TRAIN_DOCS)), "doc_id")
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = toxicity.train(docs.join(F.broadcast(chosen), "doc_id"))
    scored = toxicity.score(docs, ["doc_id"], model)
    held = F.coalesce(crc("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "clauses")


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_digest(docs)


def encode_digest(docs: DataFrame) -> DataFrame:
    """Encoded and decoded again; digests of both."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode(docs, ["doc_id"], ranks, public_tokenizers.PATTERN)
    decoded = bytebpe.decode(encoded, ["doc_id"], ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocab = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    known = docs.where(F.col("lang").isNotNull() & (crc("doc_id", 5) != 0))
    chosen = known.join(F.broadcast(sample_ids(known, "doc_id", langid.MAX_TRAIN_DOCS)), "doc_id")
    found = langid.predict(docs, ["doc_id"], langid.train(chosen, vocab), vocab)
    return found.select("doc_id", F.coalesce(crc("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op6_quality", oracles.QUALITY)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), *quality.METRICS, "kept", "n_removed_words")


@query("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@query("op10_url_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a page is labelled by the row of its id: low quality or toxic is to be blocked
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when(bad, 1).otherwise(0)).alias("bad"))
    labels = labels.select("id", F.when(F.col("bad") == 1, "block").otherwise("allow").alias("verdict"))
    found = urlrules.judge(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@query("op11_site_templates")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetemplates.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(100)) == 0, label=label)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_summary(conversations, repair.damage(conversations))
