"""Registered queries: cleaning, typing, scalar functions, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean as C
from ..operators.window import fixed_size_batches
from ..sources.tables import read_table
from .messages import MESSAGES_SQL, raw_messages
from .proxies import PRICES_SQL, TRANSACTIONS_SQL, price_bars, transactions, with_ctes
from .registry import register

_M = dict(m=MESSAGES_SQL)
_T = dict(tx=TRANSACTIONS_SQL)


@register("null_sentinels", with_ctes(
    "select event_id, case when ticker in ('None', '---') then null else ticker end as ticker, "
    "case when equity_swap in ('None', '---') then null else equity_swap end as equity_swap from m",
    **_M))
def q_null_sentinels(spark, sf):
    return C.null_sentinels(raw_messages(spark, sf).select("event_id", "ticker", "equity_swap"))


@register("dedup_exact", "select distinct user_id, event_type, ts::date as day from events")
def q_dedup_exact(spark, sf):
    e = read_table(spark, sf, "events")
    return C.dedup_exact(e.select("user_id", "event_type", F.col("ts").cast("date").alias("day")))


@register("dropna_any", with_ctes(
    "select event_id, ticker, equity_swap from (select event_id, case when ticker in "
    "('None', '---') then null else ticker end as ticker, equity_swap from m) "
    "where ticker is not null and equity_swap is not null", **_M))
def q_dropna_any(spark, sf):
    m = C.null_sentinels(raw_messages(spark, sf).select("event_id", "ticker", "equity_swap"))
    return C.dropna_any(m)


@register("dropna_subset", with_ctes(
    "select event_id, ticker, equity_swap from (select event_id, case when ticker in "
    "('None', '---') then null else ticker end as ticker, equity_swap from m) "
    "where ticker is not null", **_M))
def q_dropna_subset(spark, sf):
    m = C.null_sentinels(raw_messages(spark, sf).select("event_id", "ticker", "equity_swap"))
    return C.dropna_subset(m, ["ticker", "pct_change_absent"])


@register("cast_numeric_or_reject", with_ctes(
    "select event_id, trunc(try_cast(shares as double))::integer as shares from m "
    "where try_cast(shares as double) is not null", **_M))
def q_cast_numeric_or_reject(spark, sf):
    m = raw_messages(spark, sf).select("event_id", "shares")
    return C.cast_numeric_or_reject(m, {"shares": "int"})


@register("parse_bool_flags", with_ctes(
    "select event_id, coalesce(lower(trim(equity_swap)) in ('true', '1'), false) as equity_swap "
    "from m", **_M))
def q_parse_bool_flags(spark, sf):
    return C.parse_bool_flags(raw_messages(spark, sf).select("event_id", "equity_swap"),
                              ["equity_swap", "absent_flag"])


@register("parse_date_with_suffix", with_ctes(
    "select event_id, coalesce(try_strptime(trim(date), '%Y-%m-%d'), "
    "try_strptime(array_to_string(string_split(trim(date), '-')[1:3], '-'), '%Y-%m-%d'))::date "
    "as date from m", **_M))
def q_parse_date_with_suffix(spark, sf):
    m = raw_messages(spark, sf)
    return m.select("event_id", S.parse_date_with_suffix("date").alias("date"))


@register("cast_date_or_reject", with_ctes(
    "select event_id, d as date from (select event_id, coalesce(try_strptime(trim(date), "
    "'%Y-%m-%d'), try_strptime(array_to_string(string_split(trim(date), '-')[1:3], '-'), "
    "'%Y-%m-%d'))::date as d from m) where d is not null", **_M))
def q_cast_date_or_reject(spark, sf):
    return C.cast_date_or_reject(raw_messages(spark, sf).select("event_id", "date"), "date")


@register("date_to_epoch_ms", with_ctes(
    "select key, date, epoch_ms(date::timestamp) as timestamp from tx", **_T))
def q_date_to_epoch_ms(spark, sf):
    return transactions(spark, sf).select("key", "date",
                                          S.date_to_epoch_ms("date").alias("timestamp"))


@register("epoch_ms_to_ts",
          "select event_id, epoch_us(ts) // 1000 as ms, make_timestamp((epoch_us(ts) // 1000) * 1000) "
          "as ts_back "
          "from events")
def q_epoch_ms_to_ts(spark, sf):
    e = read_table(spark, sf, "events")
    ms = S.date_to_epoch_ms(F.col("ts"))
    return e.select("event_id", ms.alias("ms"),
                    S.epoch_ms_to_ts(ms).cast("timestamp_ntz").alias("ts_back"))


@register("key_from_path",
          "select o_orderkey, substr(sha256(concat('edgar/data/', o_custkey::varchar, '/', "
          "o_orderkey::varchar, '.txt')), 1, 16) as key from orders")
def q_key_from_path(spark, sf):
    o = read_table(spark, sf, "orders")
    path = F.concat(F.lit("edgar/data/"), F.col("o_custkey").cast("string"), F.lit("/"),
                    F.col("o_orderkey").cast("string"), F.lit(".txt"))
    return o.select("o_orderkey", S.key_from_path(path).alias("key"))


@register("key_composite", with_ctes(
    "select link, remaining_shares, derivative, sha256(concat(coalesce(link, ''), "
    "coalesce(remaining_shares::varchar, 'None'), case when derivative then '1' else '0' end)) "
    "as key from tx", **_T))
def q_key_composite(spark, sf):
    tx = transactions(spark, sf)
    return tx.select("link", "remaining_shares", "derivative",
                     S.key_composite("link", "remaining_shares", "derivative").alias("key"))


@register("quarter_of_date",
          "select o_orderkey, concat('QTR', quarter(o_orderdate)::varchar) as quarter, "
          "year(o_orderdate)::integer as year from orders")
def q_quarter_of_date(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", S.quarter_label("o_orderdate").alias("quarter"),
                    F.year("o_orderdate").alias("year"))


@register("first_business_day", with_ctes(
    "select distinct date_trunc('month', date)::date as month, "
    "case dayofweek(date_trunc('month', date)) when 6 then date_trunc('month', date)::date + 2 "
    "when 0 then date_trunc('month', date)::date + 1 else date_trunc('month', date)::date end "
    "as fbd from tx", **_T))
def q_first_business_day(spark, sf):
    tx = transactions(spark, sf)
    return tx.select(F.trunc("date", "MM").alias("month"),
                     S.first_business_day("date").alias("fbd")).distinct()


@register("to_naive_utc",
          "select event_id, ts + to_hours(event_id % 24 - 12) as ts_utc, "
          "(ts + to_hours(event_id % 24 - 12))::date as day from events")
def q_to_naive_utc(spark, sf):
    """Texts with a zone offset (event times written with offsets from +12:00 to
    -11:00) become naive UTC times and days."""
    e = read_table(spark, sf, "events")
    off = F.lit(12) - F.col("event_id") % 24
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                    F.when(off < 0, "-").otherwise("+"),
                    F.lpad(F.abs(off).cast("string"), 2, "0"), F.lit(":00"))
    aware = text.cast("timestamp")
    return e.select("event_id", aware.cast("timestamp_ntz").alias("ts_utc"),
                    aware.cast("date").alias("day"))


@register("add_days", with_ctes("select key, date, date + 30 as future_date from tx", **_T))
def q_add_days(spark, sf):
    return transactions(spark, sf).select("key", "date", S.add_days("date", 30).alias("future_date"))


@register("pct_change", with_ctes(
    "select ticker, date, close, lead(close) over w as next_close, "
    "floor((lead(close) over w - close) / nullif(close, 0) * 100000e0 + 0.5e0) / 100000e0 "
    "as pct_change from p window w as (partition by ticker order by date)", p=PRICES_SQL))
def q_pct_change(spark, sf):
    from pyspark.sql import Window
    p = price_bars(spark, sf)
    w = Window.partitionBy("ticker").orderBy("date")
    nxt = F.lead("close").over(w)
    return p.select("ticker", "date", "close", nxt.alias("next_close"),
                    S.pct_change(F.col("close"), nxt).alias("pct_change"))


@register("price_fallback", with_ctes(
    "select t.key, case when t.txn_price = 0 then p.close else t.txn_price end as price "
    "from (select key, upper(trim(ticker)) as ticker, date, "
    "case when derivative then 0e0 else price end as txn_price from tx) t "
    "asof left join p on t.ticker = p.ticker and t.date >= p.date",
    tx=TRANSACTIONS_SQL, p=PRICES_SQL))
def q_price_fallback(spark, sf):
    """Derivative rows report no price (0): they fall back to the start price
    of the day (backward as-of on the daily bars)."""
    from ..operators import asof as A
    tx = C.normalize_text_keys(transactions(spark, sf)).select(
        "key", "ticker", "date",
        F.when(F.col("derivative"), F.lit(0.0)).otherwise(F.col("price")).alias("txn_price"))
    j = A.asof_join(tx, price_bars(spark, sf), by="ticker", left_on="date", right_on="date",
                    values=["close"], prefix="start_")
    return j.select("key", S.price_fallback("txn_price", "start_close").alias("price"))


@register("shares_to_usd", with_ctes(
    "select key, shares * price as tx_value, remaining_shares * price as remaining_value, "
    "direct_holding * price as direct_value, indirect_holding * price as indirect_value from tx",
    **_T))
def q_shares_to_usd(spark, sf):
    tx = transactions(spark, sf)
    return tx.select("key", *[(F.col(c) * F.col("price")).alias(n) for c, n in (
        ("shares", "tx_value"), ("remaining_shares", "remaining_value"),
        ("direct_holding", "direct_value"), ("indirect_holding", "indirect_value"))])


_BRANCHES_SQL = (
    "select key, case when not derivative then case when ownership = 'I' then 'N/A' else ownership end "
    "end as n_own, case when derivative then ownership end as d_own, "
    "case when not derivative then shares end as n_shares, "
    "case when derivative then shares end as d_shares, "
    "case when not derivative then price::decimal(18,4) end as n_price, "
    "case when derivative then price::decimal(18,4) end as d_price from tx")


@register("unified_tx_view", with_ctes(
    "select key, coalesce(nullif(n_own, 'N/A'), d_own) as ownership, coalesce(n_shares, d_shares) "
    "as shares, round(coalesce(n_shares * n_price, d_shares * d_price), 0)::bigint as tx_value from b",
    **_T, b=_BRANCHES_SQL))
def q_unified_tx_view(spark, sf):
    """One view over the two transaction branches (non-derivative first, 'N/A' as
    null): COALESCE of the fields, ROUND of the branch's own shares * price."""
    tx = transactions(spark, sf)
    d = F.col("derivative")
    price = F.col("price").cast("decimal(18,4)")
    b = tx.select(
        "key", F.when(~d, F.when(F.col("ownership") == "I", F.lit("N/A")).otherwise(
            F.col("ownership"))).alias("n_own"), F.when(d, F.col("ownership")).alias("d_own"),
        F.when(~d, F.col("shares")).alias("n_shares"), F.when(d, F.col("shares")).alias("d_shares"),
        F.when(~d, price).alias("n_price"), F.when(d, price).alias("d_price"))
    return b.select("key", F.coalesce(F.nullif("n_own", F.lit("N/A")), "d_own").alias("ownership"),
                    F.coalesce("n_shares", "d_shares").alias("shares"),
                    F.round(F.coalesce(F.col("n_shares") * F.col("n_price"),
                                       F.col("d_shares") * F.col("d_price")), 0)
                    .cast("bigint").alias("tx_value"))


@register("json_codec", with_ctes(
    "select event_id, json_extract(value, '$.k')::bigint as k, to_json({'k': "
    "json_extract(value, '$.k')::bigint})::varchar as value_json from (select event_id, "
    "case when json_valid(value) then value else '{\"k\":null}' end as value from m)", **_M))
def q_json_codec(spark, sf):
    """Decode and encode again; an undecodable value becomes a record of nulls."""
    m = raw_messages(spark, sf)
    rec = F.from_json("value", "k bigint")
    return m.select("event_id", rec["k"].alias("k"),
                    F.to_json(F.struct(rec["k"].alias("k")), {"ignoreNullFields": "false"})
                    .alias("value_json"))


@register("json_decode_skip_bad", with_ctes(
    "select event_id, json_extract(value, '$.k')::bigint as k from m "
    "where json_valid(value)", **_M))
def q_json_decode_skip_bad(spark, sf):
    from ..sources.topics import decode_json
    good, _bad = decode_json(raw_messages(spark, sf).select("event_id", "value"), "k bigint")
    return good.select("event_id", "k")


@register("project_message", with_ctes(
    "select key, to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})"
    "::varchar as value from m", **_M))
def q_project_message(spark, sf):
    from ..sources.topics import to_message
    m = raw_messages(spark, sf).select("key", "event_id", "user_id", "event_type")
    return to_message(m, key="key")


@register("drop_if_present", with_ctes(
    "select * exclude (company_cik, link) from tx", **_T))
def q_drop_if_present(spark, sf):
    return C.drop_if_present(transactions(spark, sf), ["company_cik", "link", "not_a_column"])


@register("split_feature_columns", with_ctes(
    "select shares, remaining_shares, owner_code, ownership, derivative, "
    "equity_swap, rule105b1, direct_holding, indirect_holding from tx", **_T))
def q_split_feature_columns(spark, sf):
    from ..operators.ml import feature_columns
    from .q_ml import DROPPED, IDS
    tx = C.drop_if_present(transactions(spark, sf), (*DROPPED, "acquired_disposed", "link"))
    feats = feature_columns(tx, target="pct_change", ids=IDS)
    return tx.select(*feats)


@register("limit_trial", with_ctes(
    "select event_id, key from m order by event_id limit 100", **_M))
def q_limit_trial(spark, sf):
    """Trial mode: the first ``n`` records in offset order (the limit is the
    feature; Spark runs it as a distributed top-k)."""
    return raw_messages(spark, sf).select("event_id", "key").orderBy("event_id").limit(100)


@register("filter_recent",
          "select event_id, ts from events where ts >= timestamp '2024-01-30 00:00:00' "
          "- interval 7 day")
def q_filter_recent(spark, sf):
    from ..sources.master_index import filter_recent
    e = read_table(spark, sf, "events").select("event_id", "ts")
    return filter_recent(e, ts_ms=S.date_to_epoch_ms(F.col("ts")),
                         now="2024-01-30 00:00:00", days_back=7)


@register("sort_by_keys", with_ctes(
    "select ticker, date, close from p order by ticker, date", p=PRICES_SQL))
def q_sort_by_keys(spark, sf):
    return price_bars(spark, sf).orderBy("ticker", "date")


@register("head_rows", with_ctes("select * from tx order by key limit 5", **_T))
def q_head_rows(spark, sf):
    return transactions(spark, sf).orderBy("key").limit(5)


@register("fixed_size_batches", with_ctes(
    "select event_id, floor((row_number() over (order by event_id) - 1) / 500)::bigint as batch "
    "from m", **_M))
def q_fixed_size_batches(spark, sf):
    m = raw_messages(spark, sf).select("event_id")
    return fixed_size_batches(m, size=500, order=["event_id"])


@register("fixed_size_batches_by_key", with_ctes(
    "select ticker, floor((row_number() over (partition by ticker order by date) - 1) / 50)"
    "::bigint as batch, date from p", p=PRICES_SQL))
def q_fixed_size_batches_by_key(spark, sf):
    p = price_bars(spark, sf).select("ticker", "date")
    return fixed_size_batches(p, size=50, order=["date"], by=["ticker"])


@register("union_frames", with_ctes(
    "select ticker, date, close, null::varchar as event_type from p union all "
    "select concat('U', user_id::varchar), ts::date, value, event_type from events", p=PRICES_SQL))
def q_union_frames(spark, sf):
    e = read_table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("ts").cast("date").alias("date"), F.col("value").alias("close"), "event_type")
    return price_bars(spark, sf).unionByName(e, allowMissingColumns=True)


@register("intersect_keys", with_ctes(
    "select key from tx where acquired_disposed in ('R', 'N') intersect "
    "select key from tx where derivative", **_T))
def q_intersect_keys(spark, sf):
    tx = transactions(spark, sf)
    a = tx.where(F.col("acquired_disposed").isin("R", "N")).select("key")
    b = tx.where(F.col("derivative")).select("key")
    return a.intersect(b)


@register("assert_rows_aligned", with_ctes(
    "select count(*) as n_rows, 0::bigint as n_mismatched, "
    "count(*) filter (where acquired_disposed = 'N') as n_detected from tx", **_T))
def q_assert_rows_aligned(spark, sf):
    """Scored frame minus its prediction equals the input: multiset check
    both ways. Reports the rows checked, the mismatches of a correct scorer
    (0) and those found against a scorer that silently lost the 'N' rows."""
    tx = transactions(spark, sf).select("key", "ticker", "price", "acquired_disposed")
    scored = tx.withColumn("prediction", F.col("price") * 0.0)
    # fingerprints: one aggregate per frame, no shuffle of whole rows
    full, same, lossy = (C.multiset_fingerprint(f) for f in (
        tx, scored.drop("prediction"),
        scored.where(F.col("acquired_disposed") != "N").drop("prediction")))
    f = full.select(F.struct("n", "h1", "h2").alias("a"),
                    same.select(F.struct("n", "h1", "h2")).scalar().alias("b"),
                    lossy.select(F.struct("n", "h1", "h2")).scalar().alias("c"))
    return f.select(F.col("a.n").alias("n_rows"),
                    F.when(F.col("a") == F.col("b"), F.lit(0).cast("bigint")).otherwise(
                        F.greatest(F.abs(F.col("a.n") - F.col("b.n")), F.lit(1))).alias("n_mismatched"),
                    F.when(F.col("a") == F.col("c"), F.lit(0).cast("bigint")).otherwise(
                        F.abs(F.col("a.n") - F.col("c.n"))).alias("n_detected"))
