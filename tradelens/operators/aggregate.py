"""Per-column aggregation policy (daily collapse of same-ticker transactions).

The policy is data (column -> op token); each token maps to a built-in
aggregate expression, so the whole policy becomes one aggregate (object-hash
when a string ``mode`` or ``min_by`` is present, falling back to sort-based
aggregation under memory pressure) with a map-side partial step before the
shuffle on the group keys. No UDAF. Sums, flags, boolean modes, means and a
"first" of the leading order column use fixed-width buffers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_SCALE = 18

# The daily aggregation policy of the transaction tables.
DAILY_POLICY: dict[str, str] = {
    "company_cik": "first",
    "key": "first",
    "timestamp": "first",
    "date": "first",
    "market_cap": "first",
    "shares": "sum",
    "remaining_shares": "sum",
    "direct_holding": "sum",
    "indirect_holding": "sum",
    "equity_swap": "any",
    "rule105b1": "any",
    "derivative": "mode_first",
    "owner_code": "mode_first",
    "ownership": "mode_first",
    "coding": "mode_first",
    "price": "mean",
}


def agg_first(c: str, order: Sequence[str]) -> Column:
    """First non-null value by a deterministic row order (``order`` columns).

    When the column is itself the leading order column this is just its
    minimum (a fixed-width, hash-aggregate-friendly buffer)."""
    col = F.col(c)
    if order and order[0] == c:
        return F.min(col)
    rank = F.struct(*[F.col(o) for o in order])
    return F.min_by(col, F.when(col.isNotNull(), rank))


def agg_sum(c: str) -> Column:
    """Null-skipping sum; all-null (or no rows) gives 0 like pandas."""
    return F.coalesce(F.sum(F.col(c)), F.lit(0)).cast("bigint")


def agg_any(c: str) -> Column:
    return F.coalesce(F.bool_or(F.col(c)), F.lit(False))


def agg_mode_first(c: str, dtype: T.DataType | None = None) -> Column:
    """Most frequent non-null value; ties resolve to the smallest value.

    Booleans use two counters (declarative, hash-aggregate friendly: no
    per-group map); other types use the built-in deterministic ``mode``.
    """
    col = F.col(c)
    if isinstance(dtype, T.BooleanType):
        n_true, n_false = F.count_if(col), F.count_if(~col)
        return F.when(n_true > n_false, F.lit(True)).when(n_false > 0, F.lit(False))
    return F.mode(col, deterministic=True)


def agg_mean(c: str, exact_scale: int | None = None) -> Column:
    """Null-skipping mean. With ``exact_scale`` the sum is taken in decimal of
    that many places, so the result does not depend on the order rows reach the
    aggregate; a scale of ``EXACT_SCALE`` keeps every digit of a double from
    0.01 to 1e20, so it only removes the dependence on order."""
    col = F.col(c)
    if exact_scale is None:
        return F.avg(col)
    return F.sum(col.cast(f"decimal(38,{exact_scale})")).cast("double") / F.count(col)


def build_policy(policy: Mapping[str, str], *, order: Sequence[str],
                 mean_scale: int | None = None,
                 types: Mapping[str, T.DataType] | None = None
                 ) -> dict[str, Callable[[str], Column]]:
    types = types or {}
    ops: dict[str, Callable[[str], Column]] = {
        "first": lambda c: agg_first(c, order),
        "sum": agg_sum,
        "any": agg_any,
        "mode_first": lambda c: agg_mode_first(c, types.get(c)),
        "mean": lambda c: agg_mean(c, mean_scale),
    }
    unknown = {op for op in policy.values() if op not in ops}
    if unknown:
        raise ValueError(f"unknown aggregation ops {sorted(unknown)}")
    return {c: ops[op] for c, op in policy.items()}


def policy_aggregate(df: DataFrame, policy: Mapping[str, str] = DAILY_POLICY, *,
                     keys: Sequence[str] = ("ticker", "date"),
                     order: Sequence[str] = ("timestamp", "key"),
                     mean_scale: int | None = EXACT_SCALE) -> DataFrame:
    """Group by ``keys`` applying ``policy``.

    Policy entries whose column is absent are ignored, columns outside the
    policy are dropped, rows with a null key are dropped (pandas groupby).
    """
    present = {c: op for c, op in policy.items() if c in df.columns and c not in keys}
    builders = build_policy(present, order=[o for o in order if o in df.columns],
                            mean_scale=mean_scale,
                            types={f.name: f.dataType for f in df.schema.fields})
    keyed = df.where(_all_not_null(keys))
    return keyed.groupBy(*keys).agg(*[fn(c).alias(c) for c, fn in builders.items()])


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond
