"""Registered queries: forward-return target, as-of joins, daily aggregation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof as A
from ..operators import clean as C
from ..operators.aggregate import DAILY_POLICY, policy_aggregate
from ..operators.window import expanding_lagged_avg, latest_row_per_key
from ..session import partitions_for, scratch_path
from ..sources.catalog import FeatureStore, load_catalog
from ..sources.tables import read_table
from . import refresh as RF
from . import target as TG
from .proxies import PRICES_SQL, TRANSACTIONS_SQL, price_bars, transactions, with_ctes
from .registry import register

PERIOD = 30
PERIOD_MS = PERIOD * 86400000
MODE_COLS = ("derivative", "owner_code", "ownership", "coding")


def _tx_dir(spark, sf, direction="R"):
    tx = transactions(spark, sf)
    tx = C.normalize_text_keys(TG.filter_direction(tx, "acquired_disposed", direction),
                               ("ticker", "acquired_disposed"))
    return tx


def _prices(spark, sf):
    return C.normalize_text_keys(price_bars(spark, sf), ("ticker",))


def _daily(spark, sf, direction="R"):
    return policy_aggregate(_tx_dir(spark, sf, direction), DAILY_POLICY)


# ------------------------------------------------------------- SQL pieces ---

def _t_sql(direction: str) -> str:
    return (f"select * replace (upper(trim(ticker)) as ticker, "
            f"upper(trim(acquired_disposed)) as acquired_disposed) "
            f"from tx where acquired_disposed = '{direction}'")


def daily_sql(src: str) -> str:
    """DuckDB twin of ``policy_aggregate(DAILY_POLICY)`` over CTE ``src``.

    Mode ties resolve to the smallest value (count + row_number), the mean is
    an exact decimal sum over a count.
    """
    first = ",\n".join(
        f"arg_min({c}, (timestamp, key)) filter (where {c} is not null) as {c}"
        for c in ("company_cik", "key", "timestamp"))
    sums = ",\n".join(f"coalesce(sum({c}), 0)::bigint as {c}"
                      for c in ("shares", "remaining_shares", "direct_holding", "indirect_holding"))
    anys = ",\n".join(f"coalesce(bool_or({c}), false) as {c}" for c in ("equity_swap", "rule105b1"))
    modes = "\n".join(
        f"left join (select ticker, date, {c} from (select ticker, date, {c}, "
        f"row_number() over (partition by ticker, date order by count(*) desc, {c}) as rn "
        f"from {src} where {c} is not null and ticker is not null and date is not null "
        f"group by ticker, date, {c}) where rn = 1) m_{c} using (ticker, date)"
        for c in MODE_COLS)
    return f"""select g.*, {", ".join(f"m_{c}.{c}" for c in MODE_COLS)} from (
  select ticker, date,
  {first},
  {sums},
  {anys},
  cast(sum(price::varchar::decimal(38,18))::varchar as double) / count(price) as price
  from {src} where ticker is not null and date is not null group by ticker, date) g
{modes}"""


def _target_ctes(direction="R", tx=TRANSACTIONS_SQL, prices=PRICES_SQL):
    return dict(
        tx=tx, t=_t_sql(direction),
        p=(f"select upper(trim(ticker)) as ticker, date, close from ({prices}) "
           f"where upper(trim(ticker)) in (select ticker from t)"),
        daily=daily_sql("t"),
        a=("select d.*, p.close as start_price, d.date + 30 as future_date from daily d "
           "asof left join p on d.ticker = p.ticker and d.date >= p.date"),
        b=("select a.*, p.close as end_price from "
           "(select * from a where future_date <= (select max(date) from p)) a "
           "asof left join p on a.ticker = p.ticker and a.future_date <= p.date"),
        c=("select *, case when price = 0 then start_price else price end as price2, "
           "cast(floor((end_price - start_price) / nullif(start_price, 0) * 100000e0 + 0.5e0) "
           "as bigint) as e5 from b"),
        d=("select *, cast(sum(e5) over w as double) / nullif(count(e5) over w * 100000e0, 0) "
           "as avg_target_expanding from c window w as (partition by ticker order by timestamp "
           f"range between unbounded preceding and {PERIOD_MS} preceding)"),
    )


RT4_SELECT = """select ticker, date, company_cik, key, timestamp,
  direct_holding * price2 as direct_holding, indirect_holding * price2 as indirect_holding,
  equity_swap, rule105b1, derivative, owner_code, ownership, coding, price2 as price,
  e5 / 100000e0 as pct_change, shares * price2 as tx_value,
  remaining_shares * price2 as remaining_value, avg_target_expanding
from d"""


def target_sql(tx: str, prices: str) -> str:
    """The training target over other transactions and bars."""
    return with_ctes(RT4_SELECT + " where e5 is not null and avg_target_expanding is not null",
                     **_target_ctes(tx=tx, prices=prices))


# ---------------------------------------------------------------- queries ---

@register("build_training_target",
          with_ctes(RT4_SELECT + " where e5 is not null and avg_target_expanding is not null",
                    **_target_ctes()))
def q_build_training_target(spark, sf):
    return TG.build_training_target(transactions(spark, sf), price_bars(spark, sf),
                                    period=PERIOD, direction="R")


@register("refresh_training_target",
          with_ctes(RT4_SELECT + " where e5 is not null and avg_target_expanding is not null",
                    **_target_ctes()))
def q_refresh_training_target(spark, sf):
    """The stored target after two deliveries of transactions and bars, the second of which
    recomputes only the days that it reaches."""
    store = FeatureStore(spark, scratch_path(spark, f"refresh-{uuid.uuid4().hex[:12]}"),
                         load_catalog(RF.REFRESH_CATALOG, 1))
    tx, bars = transactions(spark, sf), price_bars(spark, sf)
    day = bars.agg(F.date_sub(F.max("date"), 90)).first()[0]
    rows = read_table(spark, sf, "lineitem").count()
    for part in (F.col("date") < F.lit(day), F.col("date") >= F.lit(day)):
        with partitions_for(spark, rows):
            store.upsert("bt4", tx.where(part), landed=True)
            store.upsert("p", bars.where(part))
            RF.refresh_training(store, period=PERIOD, direction="R")
    return store.read("rt4")


@register("forward_return", with_ctes(
    "select ticker, date, company_cik, key, timestamp, direct_holding * price2 as direct_holding, "
    "indirect_holding * price2 as indirect_holding, equity_swap, rule105b1, derivative, "
    "owner_code, ownership, coding, price2 as price, e5 / 100000e0 as pct_change, "
    "shares * price2 as tx_value, remaining_shares * price2 as remaining_value from c",
    **{k: v for k, v in _target_ctes().items() if k != "d"}))
def q_forward_return(spark, sf):
    prices = TG.semi_join_tickers(_prices(spark, sf), _tx_dir(spark, sf))
    return TG.forward_return(_daily(spark, sf), prices, PERIOD).drop("pct_e5")


@register("expanding_lagged_avg", with_ctes(
    "select ticker, date, timestamp, e5 / 100000e0 as pct_change, avg_target_expanding from d",
    **_target_ctes()))
def q_expanding_lagged_avg(spark, sf):
    prices = TG.semi_join_tickers(_prices(spark, sf), _tx_dir(spark, sf))
    fr = TG.forward_return(_daily(spark, sf), prices, PERIOD)
    return (expanding_lagged_avg(fr, value_e5="pct_e5", delta_days=PERIOD)
            .select("ticker", "date", "timestamp", "pct_change", "avg_target_expanding"))


@register("daily_policy_agg", with_ctes(daily_sql("t"), tx=TRANSACTIONS_SQL, t=_t_sql("R")))
def q_daily_policy_agg(spark, sf):
    return _daily(spark, sf)


# The individual policy ops over the raw (un-normalised, all-direction) rows.
_RAW = dict(tx=TRANSACTIONS_SQL)


@register("agg_first", with_ctes(
    "select ticker, date, arg_min(company_cik, (timestamp, key)) filter "
    "(where company_cik is not null) as company_cik from tx group by ticker, date", **_RAW))
def q_agg_first(spark, sf):
    return policy_aggregate(transactions(spark, sf), {"company_cik": "first"})


@register("agg_sum", with_ctes(
    "select ticker, date, coalesce(sum(shares), 0)::bigint as shares, "
    "coalesce(sum(remaining_shares), 0)::bigint as remaining_shares from tx group by ticker, date",
    **_RAW))
def q_agg_sum(spark, sf):
    return policy_aggregate(transactions(spark, sf),
                            {"shares": "sum", "remaining_shares": "sum"})


@register("agg_any", with_ctes(
    "select ticker, date, coalesce(bool_or(equity_swap), false) as equity_swap, "
    "coalesce(bool_or(rule105b1), false) as rule105b1 from tx group by ticker, date", **_RAW))
def q_agg_any(spark, sf):
    return policy_aggregate(transactions(spark, sf),
                            {"equity_swap": "any", "rule105b1": "any"})


@register("agg_mode_first", with_ctes(
    "select ticker, date, coding from (select ticker, date, coding, row_number() over "
    "(partition by ticker, date order by count(*) desc, coding) as rn from tx "
    "where coding is not null group by ticker, date, coding) where rn = 1", **_RAW))
def q_agg_mode_first(spark, sf):
    return policy_aggregate(transactions(spark, sf), {"coding": "mode_first"})


@register("agg_mean", with_ctes(
    "select ticker, date, cast(sum(price::varchar::decimal(38,18))::varchar as double) / count(price) as price "
    "from tx group by ticker, date", **_RAW))
def q_agg_mean(spark, sf):
    return policy_aggregate(transactions(spark, sf), {"price": "mean"})


@register("agg_mean_subcent", with_ctes(
    "select ticker, date, cast(sum(((cast(round(price * 100) as bigint) * 100 + shares * 37 % 97) "
    "/ 10000::double)::varchar::decimal(38,18))::varchar as double) / count(price) as price from tx "
    "group by ticker, date", **_RAW))
def q_agg_mean_subcent(spark, sf):
    """The mean over prices of four decimals, as filings carry them."""
    cents = F.round(F.col("price") * 100).cast("bigint")
    tx = transactions(spark, sf).withColumn(
        "price", (cents * 100 + F.col("shares") * 37 % 97) / F.lit(10000.0))
    return policy_aggregate(tx, {"price": "mean"})


@register("asof_backward", with_ctes(
    "select tx.key, tx.ticker, tx.date, p.close as start_price from "
    "(select key, upper(trim(ticker)) as ticker, date from tx) tx "
    "asof left join p on tx.ticker = p.ticker and tx.date >= p.date",
    tx=TRANSACTIONS_SQL, p=PRICES_SQL))
def q_asof_backward(spark, sf):
    """Raw transactions (many per ticker-day) against daily bars."""
    tx = C.normalize_text_keys(transactions(spark, sf)).select("key", "ticker", "date")
    return A.asof_join(tx, price_bars(spark, sf), by="ticker", left_on="date",
                       right_on="date", values=["close"], direction="backward",
                       prefix="").withColumnRenamed("close", "start_price")


@register("asof_forward", with_ctes(
    "select tx.key, tx.ticker, tx.future_date, p.close as end_price from "
    "(select key, upper(trim(ticker)) as ticker, date + 30 as future_date from tx) tx "
    "asof left join p on tx.ticker = p.ticker and tx.future_date <= p.date",
    tx=TRANSACTIONS_SQL, p=PRICES_SQL))
def q_asof_forward(spark, sf):
    tx = (C.normalize_text_keys(transactions(spark, sf))
          .select("key", "ticker", S.add_days("date", PERIOD).alias("future_date")))
    return A.asof_join(tx, price_bars(spark, sf), by="ticker", left_on="future_date",
                       right_on="date", values=["close"], direction="forward"
                       ).withColumnRenamed("close", "end_price")


@register("asof_intraday",
          "with r as (select user_id, ts, max(event_id) as click from events where event_type = "
          "'click' group by user_id, ts) select e.event_id, b.click as click_before, "
          "f.click as click_after from events e asof left join r b on e.user_id = b.user_id and "
          "e.ts >= b.ts asof left join r f on e.user_id = f.user_id and e.ts <= f.ts")
def q_asof_intraday(spark, sf):
    """Every event with its user's last click at or before it and first at or after it:
    as-of joins on times of day, where a user's rows have no calendar bound."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click"))
    on = dict(by="user_id", left_on="ts", right_on="ts", values=["click"])
    e = A.asof_join_ranged(e.select("event_id", "user_id", "ts"), clicks, **on
                           ).withColumnRenamed("click", "click_before")
    return A.asof_join_ranged(e, clicks, direction="forward", **on).select(
        "event_id", "click_before", F.col("click").alias("click_after"))


@register("filter_horizon", with_ctes(
    "select key, ticker, date from tx where date + 30 <= (select max(date) from p)",
    tx=TRANSACTIONS_SQL, p=PRICES_SQL))
def q_filter_horizon(spark, sf):
    max_date = price_bars(spark, sf).select(F.max("date")).scalar()
    return (transactions(spark, sf).select("key", "ticker", "date")
            .where(S.add_days("date", PERIOD) <= max_date))


@register("scalar_max_cross", with_ctes(
    "select key, date, (select max(date) from p) as max_date, "
    "date + 30 <= (select max(date) from p) as within_horizon from tx",
    tx=TRANSACTIONS_SQL, p=PRICES_SQL))
def q_scalar_max_cross(spark, sf):
    """Every row compared with one global maximum: the maximum is a scalar
    subquery (one aggregate job, its value inlined), not a join."""
    m = TG.global_max_date(price_bars(spark, sf)).select("max_date").scalar()
    return (transactions(spark, sf).select("key", "date", m.alias("max_date"))
            .withColumn("within_horizon", S.add_days("date", PERIOD) <= F.col("max_date")))


@register("global_max_date", with_ctes("select max(date) as max_date from p", p=PRICES_SQL))
def q_global_max_date(spark, sf):
    return TG.global_max_date(price_bars(spark, sf))


@register("max_date_per_ticker", with_ctes(
    "select ticker, max(date) as max_date from p group by ticker", p=PRICES_SQL))
def q_max_date_per_ticker(spark, sf):
    return price_bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("max_date"))


@register("distinct_tickers", with_ctes(
    "select distinct upper(trim(ticker)) as ticker from tx", tx=TRANSACTIONS_SQL))
def q_distinct_tickers(spark, sf):
    return C.normalize_text_keys(transactions(spark, sf)).select("ticker").distinct()


@register("semi_join_tickers", with_ctes(
    "select * from p where ticker in (select ticker from t)",
    tx=TRANSACTIONS_SQL, t=_t_sql("R"), p=PRICES_SQL))
def q_semi_join_tickers(spark, sf):
    return TG.semi_join_tickers(_prices(spark, sf), _tx_dir(spark, sf))


@register("filter_direction", with_ctes(
    "select key, ticker, acquired_disposed from tx where acquired_disposed = 'R'",
    tx=TRANSACTIONS_SQL))
def q_filter_direction(spark, sf):
    return (TG.filter_direction(transactions(spark, sf), "acquired_disposed", "R")
            .select("key", "ticker", "acquired_disposed"))


@register("normalize_text_keys", with_ctes(
    "select key, upper(trim(ticker)) as ticker, upper(trim(acquired_disposed)) as "
    "acquired_disposed from tx", tx=TRANSACTIONS_SQL))
def q_normalize_text_keys(spark, sf):
    return C.normalize_text_keys(transactions(spark, sf).select(
        "key", "ticker", "acquired_disposed"), ("ticker", "acquired_disposed"))


@register("assert_all_direction", with_ctes(
    "select coalesce(acquired_disposed, 'NULL') as acquired_disposed, count(*) as n_quarantined "
    "from tx where acquired_disposed is distinct from 'R' group by 1", tx=TRANSACTIONS_SQL))
def q_assert_all_direction(spark, sf):
    """Quarantine mode of the direction assertion: the rejected rows per value."""
    _, bad = C.assert_all_equal(transactions(spark, sf), "acquired_disposed", "R")
    return (bad.groupBy(F.coalesce("acquired_disposed", F.lit("NULL")).alias("acquired_disposed"))
               .agg(F.count(F.lit(1)).alias("n_quarantined")))


@register("assert_no_null_dates", with_ctes(
    "select count(*) as n_rows, count(date) as n_dated from tx", tx=TRANSACTIONS_SQL))
def q_assert_no_null_dates(spark, sf):
    checked = C.assert_no_nulls(transactions(spark, sf), "date", "transaction dates")
    return checked.agg(F.count(F.lit(1)).alias("n_rows"), F.count("date").alias("n_dated"))


@register("latest_row_per_ticker", with_ctes(
    "select ticker, date, key, price from (select *, row_number() over (partition by ticker "
    "order by date desc, key desc) as rn from daily) where rn = 1",
    tx=TRANSACTIONS_SQL, t=_t_sql("R"), daily=daily_sql("t")))
def q_latest_row_per_ticker(spark, sf):
    return latest_row_per_key(_daily(spark, sf), by="ticker", order=("date", "key")).select(
        "ticker", "date", "key", "price")


def _rt4_sql_cte():
    return with_ctes(RT4_SELECT + " where e5 is not null and avg_target_expanding is not null",
                     **_target_ctes())


@register("lookup_latest_target", with_ctes(
    "select i.*, l.avg_target_expanding from daily_a i left join (select ticker, "
    "arg_max(avg_target_expanding, (date, key)) as avg_target_expanding from rt4 group by ticker) l "
    "using (ticker)",
    rt4=_rt4_sql_cte(), tx=TRANSACTIONS_SQL, ta=_t_sql("A"), daily_a=daily_sql("ta")))
def q_lookup_latest_target(spark, sf):
    rt4 = q_build_training_target(spark, sf)
    return TG.lookup_latest_target(_daily(spark, sf, "A"), rt4)


@register("build_inference_features", with_ctes(
    "select * from (select i.*, l.avg_target_expanding from daily_a i left join (select ticker, "
    "arg_max(avg_target_expanding, (date, key)) as avg_target_expanding from rt4 group by ticker) l "
    "using (ticker)) where avg_target_expanding is not null",
    rt4=_rt4_sql_cte(), tx=TRANSACTIONS_SQL, ta=_t_sql("A"), daily_a=daily_sql("ta")))
def q_build_inference_features(spark, sf):
    rt4 = q_build_training_target(spark, sf)
    return TG.build_inference_features(transactions(spark, sf), rt4, direction="A")


@register("expanding_lagged_avg_raw", with_ctes(
    "select key, ticker, timestamp, shares, cast(sum(shares) over w as double) / "
    "nullif(count(shares) over w * 1e0, 0) as avg_shares_lagged from tx "
    f"window w as (partition by ticker order by timestamp range between unbounded preceding "
    f"and {PERIOD_MS} preceding)", tx=TRANSACTIONS_SQL))
def q_expanding_lagged_avg_raw(spark, sf):
    """The leakage guard over raw (not daily-aggregated) rows, where one
    ticker may hold a large share of all rows: range-partitioned prefix sums
    instead of one window partition per ticker."""
    from ..operators.window import lagged_mean_by_prefix_sums
    tx = transactions(spark, sf).select("key", "ticker", "timestamp", "shares")
    return lagged_mean_by_prefix_sums(tx, value="shares", delta_days=PERIOD, by="ticker",
                                      time_ms="timestamp", scale=1.0, out="avg_shares_lagged")
