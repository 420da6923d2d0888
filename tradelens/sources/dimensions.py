"""Static dimension files and the CSV fallback for scoring rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MCAP_SCHEMA = "ticker string, fbd date, market_cap bigint"


def read_market_caps(spark: SparkSession, path: str) -> DataFrame:
    """Cached market caps (parquet) in the one schema (ticker, fbd, market_cap)."""
    return spark.read.parquet(path).select(F.upper(F.trim("ticker")).alias("ticker"),
                                           F.col("fbd").cast("date"),
                                           F.col("market_cap").cast("bigint"))


def read_cik_map(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON ``{"exchange": {cik: ...}, "sic": {cik: ...}}`` (one
    multi-line document) -> rows ``(cik, exchange, sic)``; the maps are
    exploded on the executors, a CIK missing from one map gets NULL there."""
    m = T.MapType(T.StringType(), T.StringType())
    doc = spark.read.schema(T.StructType([T.StructField("exchange", m), T.StructField("sic", m)])) \
        .option("multiLine", True).json(path)
    ex = doc.select(F.explode("exchange").alias("cik", "exchange"))
    sic = doc.select(F.explode("sic").alias("cik", "sic"))
    return ex.join(sic, "cik", "full")


def read_cik_map_lines(spark: SparkSession, path: str) -> DataFrame:
    """The CIK map as JSON Lines (one ``{"cik", "exchange", "sic"}`` object per
    line): splittable, so it is read by as many tasks as its size needs."""
    return spark.read.schema("cik string, exchange string, sic string").json(path)


def write_cik_map_lines(cik_map: DataFrame, path: str) -> None:
    cik_map.select("cik", "exchange", "sic").write.mode("overwrite").json(path)


def read_scoring_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Scoring rows from CSV instead of the store: explicit schema, header."""
    return spark.read.schema(schema).option("header", True).csv(path)
