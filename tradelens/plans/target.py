"""Forward-return target (``rt4``) and inference features (``bir4``).

Physical shape of ``build_training_target`` (see ``explain``):

  lineitem scan (pushed direction filter, pruned columns)
    -> partial agg -> Exchange hash(ticker, date) -> final daily policy agg
  lineitem scan -> partial max -> Exchange hash(ticker, date) -> daily bars
  union -> Exchange hash(ticker) -> sort + backward carry, sort + forward carry
        -> horizon filter (scalar subquery over the bars)
        -> sort + lagged expanding average (same partitioning, no exchange)

After the daily aggregate each ticker holds at most one row per day on each
side, so the per-ticker window partitions are bounded by the calendar, not by
the data volume.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof as A
from ..operators import clean as C
from ..operators.aggregate import DAILY_POLICY, policy_aggregate
from ..operators.window import expanding_lagged_avg, latest_value_per_key
from ..session import in_part, shuffles_removed

TARGET_DROP = ("start_price", "end_price", "remaining_shares", "shares")


def filter_direction(tx: DataFrame, key: str = "acquired_disposed", value: str = "R") -> DataFrame:
    """Equality filter on a configurable column (pushed into the scan)."""
    return tx.where(F.col(key) == F.lit(value))


def semi_join_tickers(prices: DataFrame, tx: DataFrame) -> DataFrame:
    """Prices restricted to tickers present in the transactions (no driver list)."""
    # distinct first: a partial aggregate bounded by the ticker universe, so the
    # semi-join's build side never grows with the transaction volume
    return prices.join(tx.select("ticker").distinct(), on="ticker", how="left_semi")


def global_max_date(prices: DataFrame) -> DataFrame:
    return prices.agg(F.max("date").alias("max_date"))


def forward_return(daily: DataFrame, prices: DataFrame, period: int, last=None) -> DataFrame:
    """Start price (backward as-of on date), horizon filter, end price (forward
    as-of on date + period), return, price fallback, USD values.

    ``daily`` must be unique on (ticker, date); ``prices`` on (ticker, date). ``last``: the
    latest day of all bars, where ``prices`` are a part of them.
    Keeps the integer return ``pct_e5`` for the exact expanding average.
    """
    # scalar subquery, no cross join
    max_date = prices.select(F.max("date")).scalar() if last is None else F.lit(last)
    left = daily.withColumn("future_date", S.add_days("date", period))
    both = A.asof_both(left, prices, by="ticker", on="date", forward_on="future_date",
                       right_on="date", value="close",
                       back_name="start_price", fwd_name="end_price")
    out = (both.where(F.col("future_date") <= max_date)
               .withColumn("pct_e5", S.return_e5("start_price", "end_price"))
               .withColumn("pct_change", F.col("pct_e5") / F.lit(S.RETURN_SCALE))
               .withColumn("price", S.price_fallback("price", "start_price")))
    usd = {"tx_value": "shares", "remaining_value": "remaining_shares",
           "direct_holding": "direct_holding", "indirect_holding": "indirect_holding"}
    out = out.withColumns({dst: F.col(src) * F.col("price") for dst, src in usd.items()
                           if src in out.columns})
    return C.drop_if_present(out, TARGET_DROP + ("future_date",))


def clean_target(df: DataFrame, subset=("pct_change", "avg_target_expanding")) -> DataFrame:
    """Exact dedup, sentinels -> null, drop rows without target / average.

    The dedup runs before the sentinel rewrite so its grouping keys are the
    untouched columns and the per-ticker hash partitioning of the windows
    satisfies it (no extra shuffle). It differs from dedup-after-rewrite only
    for two rows identical except for 'None' vs '---' spellings, impossible
    for rows unique on (ticker, date) with upper-cased tickers.
    """
    return C.dropna_subset(C.null_sentinels(C.dedup_exact(df)), subset)


def build_training_target(tx: DataFrame, prices: DataFrame, *, period: int = 30,
                          direction_key: str = "acquired_disposed", direction: str = "R",
                          policy: Mapping[str, str] = DAILY_POLICY,
                          direction_mode: str = "raise", last=None) -> DataFrame:
    """``rt4``: one row per (ticker, day) with forward return and leakage-safe
    expanding average of earlier returns. ``last`` as in ``forward_return``."""
    tx = C.normalize_text_keys(filter_direction(tx, direction_key, direction),
                               ("ticker", direction_key))
    tx, _ = C.assert_all_equal(tx, direction_key, direction, mode=direction_mode)
    daily = policy_aggregate(tx, policy)
    daily = C.assert_no_nulls(daily, "date", "transaction dates")
    # tickers come from the aggregated rows, so the semi-join's build side
    # re-reads the daily aggregate's shuffle output instead of rescanning
    prices = semi_join_tickers(C.normalize_text_keys(prices, ("ticker",)), daily)
    fr = forward_return(daily, prices, period, last)
    rt4 = expanding_lagged_avg(fr, value_e5="pct_e5", delta_days=period)
    return clean_target(rt4.drop("pct_e5"))


def training_target_in_parts(tx: DataFrame, prices: DataFrame, parts: int, *,
                             direction_key: str = "acquired_disposed", direction: str = "R",
                             **how) -> Iterator[DataFrame]:
    """The rows of ``build_training_target`` in frames of whole tickers, no ticker's rows depending
    on another's but for the latest day of the bars. Written one after the other, each holds its
    own shuffles on disk; the inputs are read once for each."""
    if parts == 1:
        yield build_training_target(tx, prices, direction_key=direction_key, direction=direction, **how)
        return
    met = C.normalize_text_keys(filter_direction(tx, direction_key, direction).where(
        "date is not null"), ("ticker",))
    with shuffles_removed(tx.sparkSession):
        last = global_max_date(semi_join_tickers(
            C.normalize_text_keys(prices, ("ticker",)), met)).first()[0]
    for i in range(parts):
        mine = in_part(S.normalize_key("ticker"), i, parts)
        yield build_training_target(tx.where(mine), prices.where(mine), direction_key=direction_key,
                                    direction=direction, last=last, **how)


def inference_features_in_parts(tx: DataFrame, rt4: DataFrame, parts: int,
                                **how) -> Iterator[DataFrame]:
    """The rows of ``build_inference_features`` in frames of whole tickers."""
    for i in range(parts):
        mine = in_part(S.normalize_key("ticker"), i, parts)
        yield build_inference_features(tx.where(mine), rt4.where(mine), **how)


def lookup_latest_target(inference: DataFrame, rt4: DataFrame) -> DataFrame:
    """Attach each ticker's latest ``avg_target_expanding`` (null if unknown).

    The per-ticker summary is a partial-aggregated ``max_by`` (one row per
    ticker); the join is left to Catalyst/AQE, which broadcasts it only when
    its measured size is under the threshold and sort-merges otherwise.
    """
    latest = latest_value_per_key(rt4, by="ticker", value="avg_target_expanding",
                                  order=("date", "key"))
    return inference.join(latest, on="ticker", how="left")


def build_inference_features(tx: DataFrame, rt4: DataFrame, *,
                             direction_key: str = "acquired_disposed", direction: str = "A",
                             policy: Mapping[str, str] = DAILY_POLICY) -> DataFrame:
    """``bir4``: daily-aggregated inference transactions + latest ticker target."""
    tx = C.normalize_text_keys(filter_direction(tx, direction_key, direction),
                               ("ticker", direction_key))
    tx, _ = C.assert_all_equal(tx, direction_key, direction, mode="raise")
    daily = policy_aggregate(tx, policy)
    bir4 = lookup_latest_target(daily, rt4)
    return clean_target(bir4)


# The stored-table catalog of the target service (reference key
# -> primary key and event time).
TARGET_CATALOG = {
    "p": {"primary_key": ["ticker", "date"], "event_time": "date"},
    # a transaction's key comes from its filing, whose date does not change
    "bt4": {"primary_key": ["key"], "event_time": "date", "stable_event_time": True},
    "bi4": {"primary_key": ["key"], "event_time": "date", "stable_event_time": True},
    "rt4": {"primary_key": ["key"], "event_time": "date", "stable_event_time": True},
    "bir4": {"primary_key": ["key"], "event_time": "date", "stable_event_time": True},
}


def run_training(store, *, period: int = 30, direction_key: str = "acquired_disposed",
                 direction: str = "D") -> int | None:
    """The training-side service: read ``bt4`` (direction pushed into the
    scan) and ``p`` from the store, build ``rt4`` and upsert it."""
    tx = store.read("bt4", where=lambda fg: fg[direction_key] == direction)
    prices = store.read_or_empty("p", "ticker string, date date, close double")
    rt4 = build_training_target(tx, prices, period=period, direction_key=direction_key,
                                direction=direction)
    return store.upsert("rt4", rt4)


def run_inference(store, *, direction_key: str = "acquired_disposed",
                  direction: str = "D") -> int | None:
    """The inference-side service: ``bi4`` + latest ``rt4`` target -> ``bir4``."""
    tx = store.read("bi4", where=lambda fg: fg[direction_key] == direction)
    bir4 = build_inference_features(tx, store.read("rt4"), direction_key=direction_key,
                                    direction=direction)
    return store.upsert("bir4", bir4)
