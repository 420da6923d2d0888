"""Column builders for the scalar / date / string functions of the engine.

All of them are built-in Catalyst expressions (no Python UDF), so they stay in
whole-stage codegen. Each returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding of the forward return to 5 decimals, the truthy
# spellings of XML/JSON flags, the null sentinels of the cleaning step.
RETURN_SCALE = 100000.0
TRUTHY = ("true", "1")
NULL_SENTINELS = ("None", "---")
DAY_MS = 24 * 60 * 60 * 1000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- returns ---

def return_e5(start: Column | str, end: Column | str) -> Column:
    """Forward return in units of 1e-5, rounded half up: floor(r*1e5 + 0.5).

    A zero (or null) start price gives NULL instead of +-inf. The integer form
    is what the expanding average sums, so averages are exact.
    """
    s, e = _c(start), _c(end)
    return F.floor(F.try_divide(e - s, s) * F.lit(RETURN_SCALE) + F.lit(0.5))


def pct_change(start: Column | str, end: Column | str) -> Column:
    """(end - start) / start rounded to 5 places (half up, IEEE-reproducible)."""
    return return_e5(start, end) / F.lit(RETURN_SCALE)


def price_fallback(price: Column | str, start_price: Column | str) -> Column:
    """A transaction price of 0 is replaced by the start price."""
    p = _c(price)
    return F.when(p == 0, _c(start_price)).otherwise(p)


# ------------------------------------------------------------------ flags ---

def truthy_flag(c: Column | str) -> Column:
    """Case-insensitive 'true' / '1'; null and anything else is false."""
    return F.coalesce(F.lower(F.trim(_c(c).cast("string"))).isin(*TRUTHY), F.lit(False))


def owner_code_bits(director, officer, ten_percent, other) -> Column:
    """Four-character 0/1 string (director, officer, 10% owner, other)."""
    return F.concat(*[F.when(truthy_flag(x), F.lit("1")).otherwise(F.lit("0"))
                      for x in (director, officer, ten_percent, other)])


# ------------------------------------------------------------------ dates ---

def date_to_epoch_ms(d: Column | str) -> Column:
    """Date (or timestamp) -> epoch milliseconds under the UTC session zone."""
    return F.unix_millis(_c(d).cast("timestamp"))


def epoch_ms_to_ts(ms: Column | str) -> Column:
    return F.timestamp_millis(_c(ms))


def parse_date_with_suffix(c: Column | str) -> Column:
    """``yyyy-MM-dd``; a value with more dash parts keeps its first three.

    Unparsable -> NULL (routed to the dead letter by the caller).
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"),
                      F.try_to_date(F.substring_index(s, "-", 3), "yyyy-MM-dd"))


def quarter_label(d: Column | str) -> Column:
    return F.concat(F.lit("QTR"), F.quarter(_c(d)).cast("string"))


def first_business_day(d: Column | str) -> Column:
    """First Monday-Friday day of the month of ``d``."""
    m = F.trunc(_c(d), "MM")
    dow = F.dayofweek(m)  # 1 = Sunday, 7 = Saturday
    return (F.when(dow == 7, F.date_add(m, 2))
             .when(dow == 1, F.date_add(m, 1))
             .otherwise(m))


def add_days(d: Column | str, n: int) -> Column:
    return F.date_add(_c(d), n)


# ------------------------------------------------------------------- keys ---

def key_from_path(path: Column | str, exact_digest: bool = True) -> Column:
    """64-bit hex identity of a filing path.

    ``exact_digest`` uses the first 16 hex digits of SHA-256 (portable across
    engines); otherwise Spark's xxhash64, which is cheaper.
    """
    p = _c(path)
    if exact_digest:
        return F.substring(F.sha2(p, 256), 1, 16)
    return F.lower(F.lpad(F.hex(F.xxhash64(p)), 16, "0"))


def key_composite(link, remaining_shares, derivative) -> Column:
    """SHA-256 of link + remaining shares + derivative bit (missing link -> '')."""
    return F.sha2(F.concat(F.coalesce(_c(link), F.lit("")),
                           F.coalesce(_c(remaining_shares).cast("string"), F.lit("None")),
                           F.when(_c(derivative), F.lit("1")).otherwise(F.lit("0"))), 256)


# ---------------------------------------------------------------- strings ---

def normalize_key(c: Column | str) -> Column:
    """upper + strip, used for tickers and the direction code."""
    return F.upper(F.trim(_c(c)))


def strip_prefix(c: Column | str, prefix_regex: str = "^/Archives/") -> Column:
    return F.regexp_replace(_c(c), prefix_regex, "")


def add_base_url(c: Column | str, base: str) -> Column:
    return F.concat(F.lit(base), _c(c))


def null_if_sentinel(c: Column | str) -> Column:
    x = _c(c)
    return F.when(x.isin(*NULL_SENTINELS), F.lit(None).cast("string")).otherwise(x)
