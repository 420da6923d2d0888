"""A training-data pipeline over ``documents`` built from the operators in ``tradelens.llm``.

Quality classifier (rejected documents go), line dedup, n-gram Jaccard join (one
document of each group stays), benchmark decontamination (documents that hold a
benchmark window go), source mixing. Every stage works on all that the one
before kept, written as Parquet and read again; all but the last return the
columns of ``documents``, the last adds n_tokens, epoch and block.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tradelens.llm.decontaminate import remove_contaminated
from tradelens.llm.jaccard_join import one_of_each_group
from tradelens.llm.line_dedup import remove_repeated_lines
from tradelens.llm.mixing import mix
from tradelens.llm.quality import quality_filter
from tradelens.session import scratch_path
from tradelens.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

# A trained classifier and exact set similarity are not SQL; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; each result is written as Parquet and read as the next one's docs."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
