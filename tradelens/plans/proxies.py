"""Driver-table stand-ins for the engine's stored tables.

The engine's tables (transactions ``bt4``/``bi4``, prices ``p``, filing index,
dimensions) are derived from the driver's TPC-H-like tables so every query
reads real data whose volume scales with the scale factor:

* transactions <- ``lineitem`` (ticker <- supplier, date <- ship date,
  shares <- quantity, price <- extended price, direction <- return flag ...)
* prices      <- ``lineitem`` grouped per (supplier, ship day), close = max price
* index rows  <- ``orders``; dimensions <- ``part``/``supplier``/``nation``.

Each builder has a SQL twin (``*_SQL``) used by the DuckDB oracles, written so
both engines produce bit-identical values (integer / exact arithmetic only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.tables import read_table

# ------------------------------------------------------------ transactions ---


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transaction rows in the stored ``bt4`` shape (raw ticker case)."""
    li = read_table(spark, sf_dir, "lineitem")
    d = F.col("l_discount")
    t = F.col("l_tax")
    return li.select(
        F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in
               ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]), 256).alias("key"),
        F.col("l_partkey").cast("string").alias("company_cik"),
        F.concat(F.lit(" t"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        S.date_to_epoch_ms(F.col("l_shipdate")).alias("timestamp"),
        F.col("l_quantity").cast("int").alias("shares"),
        (F.col("l_linenumber") * 10).alias("remaining_shares"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("acquired_disposed"),
        S.owner_code_bits(F.when(t >= F.lit(0.04), "1"), F.when(d >= F.lit(0.05), "1"),
                          F.when(F.col("l_linestatus") == "O", "true"), F.lit(None))
         .alias("owner_code"),
        F.col("l_linestatus").alias("coding"),
        F.when(d >= F.lit(0.05), F.lit("I")).otherwise(F.lit("D")).alias("ownership"),
        (F.col("l_linestatus") == "O").alias("derivative"),
        (t >= F.lit(0.07)).alias("equity_swap"),
        (d == F.lit(0.0)).alias("rule105b1"),
        F.col("l_linenumber").cast("bigint").alias("direct_holding"),
        F.col("l_quantity").cast("bigint").alias("indirect_holding"),
        F.concat(F.lit("edgar/data/"), F.col("l_orderkey").cast("string"),
                 F.lit(".txt")).alias("link"),
    )


TRANSACTIONS_SQL = """
select sha256(concat_ws('|', l_orderkey::varchar, l_linenumber::varchar,
                         l_partkey::varchar, l_suppkey::varchar)) as key,
       l_partkey::varchar as company_cik,
       concat(' t', l_suppkey::varchar, ' ') as ticker,
       l_shipdate::date as date,
       epoch_ms(l_shipdate) as timestamp,
       l_quantity::integer as shares,
       l_linenumber * 10 as remaining_shares,
       l_extendedprice as price,
       l_returnflag as acquired_disposed,
       concat(case when l_tax >= 0.04e0 then '1' else '0' end,
              case when l_discount >= 0.05e0 then '1' else '0' end,
              case when l_linestatus = 'O' then '1' else '0' end, '0') as owner_code,
       l_linestatus as coding,
       case when l_discount >= 0.05e0 then 'I' else 'D' end as ownership,
       l_linestatus = 'O' as derivative,
       l_tax >= 0.07e0 as equity_swap,
       l_discount = 0e0 as rule105b1,
       l_linenumber::bigint as direct_holding,
       l_quantity::bigint as indirect_holding,
       concat('edgar/data/', l_orderkey::varchar, '.txt') as link
from lineitem
"""

# ------------------------------------------------------------------ prices ---


def price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close bars ``(ticker, date, close)``, unique on (ticker, date)."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.select(F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("ticker"),
                      F.col("l_shipdate").cast("date").alias("date"),
                      F.col("l_extendedprice"))
              .groupBy("ticker", "date")
              .agg(F.max("l_extendedprice").alias("close")))


PRICES_SQL = """
select concat('T', l_suppkey::varchar) as ticker, l_shipdate::date as date,
       max(l_extendedprice) as close
from lineitem group by 1, 2
"""


def with_ctes(sql: str, **ctes: str) -> str:
    """Prefix ``sql`` with named CTEs."""
    parts = ",\n".join(f"{name} as ({body})" for name, body in ctes.items())
    return f"with {parts}\n{sql}"
