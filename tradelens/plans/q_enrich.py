"""Registered queries: enrichment, dead letters, SIC sectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import enrich as EN
from ..sources.tables import read_table
from .proxies import PRICES_SQL, TRANSACTIONS_SQL, price_bars, transactions, with_ctes
from .registry import register

CUTOFF = "2001-01-01"


def cached_mcaps(spark, sf, known="ticker < 'T8'"):
    """Market caps per (ticker, first business day), known for part of the
    tickers only, so that lookups can miss."""
    p = price_bars(spark, sf).where(known)
    return (p.groupBy("ticker", S.first_business_day("date").alias("fbd"))
             .agg((F.floor(F.max("close")) * 1000).alias("market_cap")))


def recent_mcaps(spark, sf):
    s = read_table(spark, sf, "supplier")
    return s.select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"),
                    (F.floor("s_acctbal") * 10).alias("market_cap"))


def cik_map(spark, sf, known="p_retailprice < 1500"):
    p = read_table(spark, sf, "part").where(known)
    return p.select(F.col("p_partkey").cast("string").alias("cik"),
                    F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("exchange"),
                    (F.col("p_size") * 100).cast("string").alias("sic"))


def exchange_fallback(spark, sf):
    s = read_table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    n = read_table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"),
        F.col("n_name").alias("exchange"))


def enriched(spark, sf):
    tx = transactions(spark, sf).select("key", "ticker", "company_cik", "date")
    e = EN.enrich_market_cap(tx, cached_mcaps(spark, sf), recent_mcaps(spark, sf), cutoff=CUTOFF)
    return EN.enrich_exchange_sic(e, cik_map(spark, sf), exchange_fallback(spark, sf))


_FBD = ("case dayofweek(date_trunc('month', date)) when 6 then date_trunc('month', date)::date + 2 "
        "when 0 then date_trunc('month', date)::date + 1 else date_trunc('month', date)::date end")

_ENRICH_CTES = dict(
    tx=TRANSACTIONS_SQL, p=PRICES_SQL,
    cm=("select ticker, fbd, floor(max(close))::bigint * 1000 as market_cap from "
        f"(select ticker, close, {_FBD} as fbd from p where ticker < 'T8') group by ticker, fbd"),
    rm="select concat('T', s_suppkey::varchar) as ticker, floor(s_acctbal)::bigint * 10 as market_cap "
       "from supplier",
    cmap="select p_partkey::varchar as cik, case when p_type <> 'ECONOMY' then p_type end as exchange, "
         "(p_size * 100)::varchar as sic from part where p_retailprice < 1500",
    fb="select concat('T', s_suppkey::varchar) as ticker, n_name as exchange from supplier "
       "join nation on s_nationkey = n_nationkey where s_acctbal > 0",
    t=f"select key, ticker, company_cik, date, {_FBD} as fbd from tx",
    e=("select t.key, t.ticker, t.company_cik, t.date, t.fbd, "
       f"case when t.fbd >= date '{CUTOFF}' then rm.market_cap else cm.market_cap end as market_cap, "
       f"t.fbd is not null and not (t.fbd >= date '{CUTOFF}') as _mcap_from_cache, "
       "cmap.sic, coalesce(cmap.exchange, fb.exchange) as exchange from t "
       "left join cm on upper(trim(t.ticker)) = cm.ticker and t.fbd = cm.fbd "
       "left join rm on upper(trim(t.ticker)) = rm.ticker "
       "left join cmap on t.company_cik = cmap.cik "
       "left join fb on upper(trim(t.ticker)) = fb.ticker"),
)


@register("enrich_market_cap", with_ctes(
    "select key, fbd, market_cap from e", **_ENRICH_CTES))
def q_enrich_market_cap(spark, sf):
    return enriched(spark, sf).select("key", "fbd", "market_cap")


@register("enrich_exchange_sic", with_ctes(
    "select key, company_cik, exchange, sic from e", **_ENRICH_CTES))
def q_enrich_exchange_sic(spark, sf):
    return enriched(spark, sf).select("key", "company_cik", "exchange", "sic")


@register("sink_dead_letter", with_ctes(
    "select 'missing_mcap' as kind, upper(trim(ticker)) as ticker, fbd, null as cik from e "
    "where _mcap_from_cache and market_cap is null "
    "union all select 'missing_sic', null, null, company_cik from e where sic is null "
    "union all select 'missing_exchange', null, null, company_cik from e where exchange is null",
    **_ENRICH_CTES))
def q_sink_dead_letter(spark, sf):
    """Failures added to the dead-letter table in two batches, the first of them
    twice as after a restart; the rows read back."""
    import uuid

    from ..session import cut_lineage, scratch_path
    path = scratch_path(spark, f"dead-{uuid.uuid4().hex[:12]}")
    dl = cut_lineage(EN.dead_letters(enriched(spark, sf)))
    for batch in (0, 1, 0):
        EN.write_dead_letters(dl.where(F.pmod(F.xxhash64("ticker", "cik"), F.lit(2)) == batch),
                              path, batch)
    return EN.read_dead_letters(spark, path).drop("batch_id")


_SECTORS_SQL = "select * from (values " + ", ".join(
    f"('{n}', {lo}, {hi})" for n, lo, hi in EN.SIC_SECTORS) + ") s(sector, lo, hi)"


@register("sic_sector", with_ctes(
    "select p_partkey, sector from part left join s on p_partkey >= lo and p_partkey < hi",
    s=_SECTORS_SQL))
def q_sic_sector(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey")
    return EN.sic_sectors(part, "p_partkey", EN.sic_sector_table(spark))


@register("src_dimension_files", with_ctes(
    "select cmap.cik, cmap.exchange, cmap.sic, count(cm.ticker) as n_mcap_rows from cmap "
    "left join cm on cm.ticker = concat('T', cmap.cik) group by all",
    **{**_ENRICH_CTES, "cm": _ENRICH_CTES["cm"].replace("where ticker < 'T8'", ""),
       "cmap": _ENRICH_CTES["cmap"].replace("where p_retailprice < 1500", "")}))
def q_src_dimension_files(spark, sf):
    """Dimension files landed in the shared folder (market caps as Parquet,
    the CIK map as JSON Lines), loaded back and combined."""
    import os
    import uuid

    from ..session import scratch_path
    from ..sources import dimensions as DIM
    root = scratch_path(spark, f"dims-{uuid.uuid4().hex[:12]}")
    cached_mcaps(spark, sf, "true").write.mode("overwrite").parquet(os.path.join(root, "mcaps"))
    DIM.write_cik_map_lines(cik_map(spark, sf, "true"), os.path.join(root, "cik_map"))
    mc = DIM.read_market_caps(spark, os.path.join(root, "mcaps"))
    cm = DIM.read_cik_map_lines(spark, os.path.join(root, "cik_map"))
    counts = mc.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_mcap_rows"))
    j = cm.join(counts, counts.ticker == F.concat(F.lit("T"), cm.cik), "left")
    return j.select("cik", "exchange", "sic",
                    F.coalesce("n_mcap_rows", F.lit(0)).alias("n_mcap_rows"))
