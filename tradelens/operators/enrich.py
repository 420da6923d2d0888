"""Enrichment from static dimensions and the dead-letter split.

Dimensions (market caps per ticker-month, CIK -> exchange / SIC, SIC sector
ranges) are joined with left joins. Only the sector table is broadcast by
hint: it has a fixed, tiny number of rows. The market-cap and CIK tables grow
with the ticker / company universe, so their joins are left to Catalyst + AQE,
which broadcast them only when their measured size is under the threshold and
otherwise keep a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

# SIC code sectors as half-open code ranges [lo, hi).
SIC_SECTORS = (
    ("All Industries", 100, 9900),
    ("Agriculture, Forestry, and Fishing", 100, 900),
    ("Mining", 1000, 1500),
    ("Construction", 1500, 1800),
    ("Manufacturing", 2000, 4000),
    ("Transportation, Communications, Electric, Gas, and Sanitary Services", 4000, 5000),
    ("Wholesale Trade", 5000, 5200),
    ("Retail Trade", 5200, 6000),
    ("Finance, Insurance, and Real Estate", 6000, 6800),
    ("Services", 7000, 9000),
    ("Public Administration", 9100, 9800),
    ("Nonclassifiable Establishments", 9900, 9901),
)

DEAD_LETTER_KINDS = ("missing_mcap", "missing_date", "missing_sic", "missing_exchange")


def sic_sector_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SIC_SECTORS), "sector string, lo int, hi int")


def sic_sectors(df: DataFrame, code_col: str, sectors: DataFrame) -> DataFrame:
    """Every sector whose range holds the code (a code can sit in two: the
    catch-all and its division). Range join against a fixed 12-row table."""
    code = F.col(code_col).cast("int")
    return df.join(F.broadcast(sectors), (code >= F.col("lo")) & (code < F.col("hi")), "left") \
             .drop("lo", "hi")


def enrich_market_cap(tx: DataFrame, cached: DataFrame, recent: DataFrame, *,
                      cutoff: str) -> DataFrame:
    """Market cap on (upper ticker, first business day of the month); rows on
    or after ``cutoff`` take the recent source. Adds ``fbd`` and ``market_cap``
    plus ``_mcap_from_cache`` (whether the cache was consulted). A dimension with
    several rows of one key counts by its largest cap: it never multiplies rows."""
    t = tx.withColumn("__t", S.normalize_key("ticker")).withColumn(
        "fbd", S.first_business_day(S.parse_date_with_suffix(F.col("date").cast("string"))))
    c = cached.groupBy(F.col("ticker").alias("__t"), "fbd").agg(F.max("market_cap").alias("__cached"))
    r = recent.groupBy(F.col("ticker").alias("__t")).agg(F.max("market_cap").alias("__recent"))
    use_recent = F.col("fbd") >= F.lit(cutoff).cast("date")
    out = (t.join(c, ["__t", "fbd"], "left").join(r, ["__t"], "left")
            .withColumn("market_cap", F.when(use_recent, F.col("__recent"))
                        .otherwise(F.col("__cached")))
            .withColumn("_mcap_from_cache", F.col("fbd").isNotNull() & ~use_recent))
    return out.drop("__t", "__cached", "__recent")


def enrich_exchange_sic(tx: DataFrame, cik_map: DataFrame, exchange_fallback: DataFrame | None = None
                        ) -> DataFrame:
    """Exchange and SIC by company CIK; exchange falls back to a by-ticker
    source. Misses stay null (and are dead-lettered by ``dead_letters``). Several
    rows of one key count by their greatest (exchange, sic)."""
    m = cik_map.groupBy(F.col("cik").alias("company_cik")).agg(
        F.max(F.struct("exchange", "sic")).alias("__m")).select(
        "company_cik", F.col("__m.exchange").alias("__ex"), F.col("__m.sic").alias("sic"))
    out = tx.join(m, "company_cik", "left")
    if exchange_fallback is not None:
        fb = exchange_fallback.groupBy(F.col("ticker").alias("__t")).agg(
            F.max("exchange").alias("__fb"))
        out = (out.withColumn("__t", S.normalize_key("ticker")).join(fb, "__t", "left")
                  .withColumn("exchange", F.coalesce("__ex", "__fb")).drop("__t", "__fb"))
    else:
        out = out.withColumn("exchange", F.col("__ex"))
    return out.drop("__ex")


def _letter(kind: str, ticker=None, fbd=None, cik=None) -> F.Column:
    return F.struct(F.lit(kind).alias("kind"),
                    (ticker if ticker is not None else F.lit(None)).cast("string").alias("ticker"),
                    (fbd if fbd is not None else F.lit(None)).cast("date").alias("fbd"),
                    (cik if cik is not None else F.lit(None)).cast("string").alias("cik"))


def dead_letters(enriched: DataFrame) -> DataFrame:
    """One pass over the enriched rows: every failure reason becomes a row
    ``(kind, ticker, fbd, cik)``. A missing cache hit with an unusable date is
    recorded as ``missing_date``."""
    ticker = S.normalize_key("ticker")
    reasons = F.array_compact(F.array(
        F.when(F.col("fbd").isNull(), _letter("missing_date", ticker=ticker)),
        F.when(F.col("_mcap_from_cache") & F.col("market_cap").isNull(),
               _letter("missing_mcap", ticker=ticker, fbd=F.col("fbd"))),
        F.when(F.col("sic").isNull(), _letter("missing_sic", cik=F.col("company_cik"))),
        F.when(F.col("exchange").isNull(), _letter("missing_exchange", cik=F.col("company_cik")))))
    return enriched.select(F.explode(reasons).alias("r")).select("r.*")


def write_dead_letters(dl: DataFrame, path: str, batch: int) -> None:
    """Add a batch of failures to the dead-letter table. A batch has its own folder, so
    writing it again after a failure replaces its rows and no others."""
    dl.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch_id={int(batch)}")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """(kind, ticker, fbd, cik, batch_id) of all batches, none for batches without failures."""
    return spark.read.schema("ticker string, fbd date, cik string, batch_id long, kind string").parquet(
        path).select("kind", "ticker", "fbd", "cik", "batch_id")
