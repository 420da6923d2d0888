"""Topic-message stand-ins derived from ``events``.

Each event becomes one raw message as the store writer receives it: string
fields straight from JSON (numbers, dates and flags not yet typed), a few of
them deliberately unparsable so the reject paths are exercised, plus the JSON
value of the message. Built with Spark expressions; ``MESSAGES_SQL`` is the
DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    day = F.col("ts").cast("date").cast("string")
    return e.select(
        F.col("event_id"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("key"),
        F.col("user_id"),
        F.col("ts"),
        et.alias("event_type"),
        F.when(et == "error", F.lit("x")).otherwise(F.col("value").cast("string")).alias("shares"),
        F.when(et == "signup", F.lit("None")).when(et == "view", F.lit("---"))
         .otherwise(F.concat(F.lit(" t"), F.col("user_id").cast("string"))).alias("ticker"),
        F.when(et == "click", F.concat(day, F.lit("-05:00")))
         .when(et == "error", F.lit("bad")).otherwise(day).alias("date"),
        F.when(et == "purchase", F.lit("TRUE")).when(et == "view", F.lit("0"))
         .when(et == "signup", F.lit(None).cast("string")).otherwise(F.lit("1")).alias("equity_swap"),
        F.when(et == "error", F.substring(F.col("props"), 1, 5)).otherwise(F.col("props"))
         .alias("value"),
    )


MESSAGES_SQL = """
select event_id, sha256(event_id::varchar) as key, user_id, ts, event_type,
  case when event_type = 'error' then 'x' else value::varchar end as shares,
  case when event_type = 'signup' then 'None' when event_type = 'view' then '---'
       else concat(' t', user_id::varchar) end as ticker,
  case when event_type = 'click' then concat(ts::date::varchar, '-05:00')
       when event_type = 'error' then 'bad' else ts::date::varchar end as date,
  case when event_type = 'purchase' then 'TRUE' when event_type = 'view' then '0'
       when event_type = 'signup' then null else '1' end as equity_swap,
  case when event_type = 'error' then substr(props, 1, 5) else props end as value
from events
"""
