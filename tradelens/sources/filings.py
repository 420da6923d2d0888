"""Landed filing texts.

Two layouts: one file per filing (``read_filing_files``: whole-text read, the
file path is the filing id) or many filings packed into larger files, each
record starting with its path line and records separated by the ASCII record
separator (``read_filing_records``: split like lines, so big files are read by
several tasks). The packed layout avoids millions of small files on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SEP = "\u001e"
RECORDS_PER_FILE = 20_000


def read_filing_files(spark: SparkSession, path: str, *, root: str | None = None) -> DataFrame:
    """``(file_path, raw)``; ``file_path`` relative to ``root`` when given."""
    df = spark.read.text(path, wholetext=True)
    fp = F.col("_metadata.file_path")
    if root:
        # quoted: the root is a path, not a pattern
        fp = F.regexp_replace(fp, r"^(file:(//)?)?\Q" + root.rstrip("/") + r"\E/", "")
    return df.select(fp.alias("file_path"), F.col("value").alias("raw"))


def pack_filings(texts: DataFrame, path: str, *, n_files: int | None = None) -> None:
    """Write ``(file_path, raw)`` as packed records: path line + text. The files are
    compressed (the texts repeat their tags; whole they outgrow the disks before the tables
    do) and of bounded size, because a compressed file is read by one task."""
    rec = F.concat(F.col("file_path"), F.lit("\n"), F.col("raw"))
    out = texts.select(rec.alias("value"))
    if n_files:
        out = out.repartition(n_files)
    out.write.mode("overwrite").option("lineSep", RECORD_SEP).option(
        "compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_filing_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, raw)`` from packed records; a missing text gives no row."""
    recs = spark.read.option("lineSep", RECORD_SEP).text(path)
    recs = recs.where(F.length("value") > 0)
    return recs.select(F.substring_index("value", "\n", 1).alias("file_path"),
                       F.expr("substring(value, instr(value, '\\n') + 1)").alias("raw"))
