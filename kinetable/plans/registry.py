"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# given schemas: without them every read starts a job that looks into the files
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
    "embeddings": "vec_id LONG, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id LONG, url STRING, html STRING",
    "labels": "doc_id LONG, quality INT, toxic INT",
    "conversations": "conv_id LONG, turn LONG, role STRING, text STRING",
}


class Tables:
    """Lazy access to the parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round named columns; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: r6(F.col(c), d) for c, d in digits.items()})


def r6(value: Column, digits: int = 6) -> Column:
    return F.round(value.cast("double"), digits) + F.lit(0.0)
