"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .ann import nearest
from .decontaminate import contamination
from .divergence import ORACLE_SQL as DIVERGENCE_SQL
from .divergence import divergence
from .html_extract import main_text
from .jaccard_join import jaccard_join
from .license_scan import license_scan
from .line_dedup import ORACLE_SQL as LINE_SQL
from .line_dedup import line_dedup
from .mixing import ORACLE_SQL as MIX_SQL
from .mixing import mix
from .quality import quality_scores
from .registry import ORACLES, QUERIES, register  # noqa: F401
from .substring_dedup import substring_dedup
from .toxicity import toxicity_scores
from .warc import ORACLE_SQL as WARC_SQL
from .warc import pages_to_warc
from .whitening import whiten


@register("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


@register("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))


@register("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "labels"))


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"),
                           read_table(spark, sf_dir, "labels"))


@register("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))


@register("op4_line_dedup", LINE_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"))


@register("op9_warc", WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_to_warc(read_table(spark, sf_dir, "pages"))


@register("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return nearest(emb, emb.where(F.col("vec_id") % 100 == 0))


@register("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


@register("op1_source_mixing", MIX_SQL)
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "n_tokens", "epoch", "block")


@register("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents")).withColumn(
        "value", F.col("value").cast("long"))


@register("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents")).drop("spans")


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").cast("long"))
