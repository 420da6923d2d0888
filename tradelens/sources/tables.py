"""Reading the landed driver tables (one parquet file per table)."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def is_missing_path(e: AnalysisException) -> bool:
    """The one read error that means "not written yet"."""
    return e.getCondition() == "PATH_NOT_FOUND"


def input_stamp(spark: SparkSession, path: str) -> str:
    """A fingerprint of the files under ``path`` (names, sizes, times) as Spark
    sees them, so it holds for any store; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    h = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    r = files.agg(F.count("*").alias("n"), F.sum("length").alias("size"), F.sum(h).alias("h")).first()
    return f"{r.n}-{r.size}-{r.h}"
