"""As-of joins (backward / forward) as union + carry-forward windows.

Spark has no public as-of join, and an inequality join followed by a
``max_by`` would emit every earlier right row per left row. Instead both sides
are stacked into one frame, sorted per ``by`` key on the as-of key and the last
right-hand record seen is carried onto each left row:

* one shuffle (hash on ``by``) plus a sort per direction, linear per key;
* the right side must be unique on ``(by, on)`` (prices are one bar per
  ticker-day, the table's primary key), and the left side is reduced to its
  distinct ``(by, on)`` keys first unless the caller says it is already unique.
  Both sides are then bounded per ``by`` key by the number of distinct as-of
  values (calendar days for daily bars), independent of data volume, so a hot
  ticker can not build an unbounded window partition;
* the distinct keys are joined back to the full left side with an equi-join on
  ``(by, on)``; AQE splits a skewed left partition of that join.

The payload of the matched right row travels as one struct, so a null value in
the right row is returned as null rather than skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SIDE = "__asof_side"      # 0 = right (reference rows), 1 = left (probe rows)
_KEY = "__asof_key"
_HIT = "__asof_hit"


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _carry(direction: str, by: list[str]) -> Column:
    if direction == "backward":
        order = [F.col(_KEY).asc(), F.col(_SIDE).asc()]
    elif direction == "forward":
        order = [F.col(_KEY).desc(), F.col(_SIDE).asc()]
    else:
        raise ValueError("direction must be 'backward' or 'forward'")
    w = (Window.partitionBy(*by).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.last(F.col(_HIT), ignorenulls=True).over(w)


def asof_join(left: DataFrame, right: DataFrame, *, by: str | Sequence[str],
              left_on: str | Column, right_on: str, values: Sequence[str],
              direction: str = "backward", left_unique: bool = False,
              prefix: str = "") -> DataFrame:
    """Left as-of join.

    For every left row pick the right row with the same ``by`` key whose
    ``right_on`` is the latest ``<=`` (backward) or earliest ``>=`` (forward)
    ``left_on``; exact matches allowed, no tolerance, unmatched -> nulls.
    ``values`` are the right columns to attach (renamed with ``prefix``).
    """
    by = _as_list(by)
    lkey = F.col(left_on) if isinstance(left_on, str) else left_on
    probe_cols = by + [_KEY]

    if left_unique:
        probes = left.withColumn(_KEY, lkey)
    else:
        probes = left.select(*[F.col(b) for b in by], lkey.alias(_KEY)).distinct()

    refs = right.select(*[F.col(b) for b in by], F.col(right_on).alias(_KEY),
                        F.struct(*[F.col(v).alias(v) for v in values]).alias(_HIT),
                        F.lit(0).alias(_SIDE))
    stacked = probes.withColumn(_SIDE, F.lit(1)).unionByName(refs, allowMissingColumns=True)
    carried = (stacked.withColumn(_HIT, _carry(direction, by))
               .where(F.col(_SIDE) == 1).drop(_SIDE))
    out_vals = [F.col(f"{_HIT}.{v}").alias(prefix + v) for v in values]

    if left_unique:
        return carried.select(*[c for c in left.columns], *out_vals)

    matched = carried.select(*probe_cols, *out_vals)
    joined = left.withColumn(_KEY, lkey).join(matched, on=probe_cols, how="left")
    return joined.drop(_KEY)


def asof_both(left: DataFrame, right: DataFrame, *, by: str | Sequence[str],
              on: str, forward_on: str, right_on: str, value: str,
              back_name: str, fwd_name: str) -> DataFrame:
    """Backward as-of on ``on`` and forward as-of on ``forward_on`` in one pass.

    ``left`` must be unique on ``(by, on)``. Both windows share the hash
    partitioning on ``by`` so the two as-of joins cost a single shuffle; each
    direction adds one sort. Used by the forward-return computation.
    """
    by = _as_list(by)
    fkey = "__asof_fkey"
    probes = (left.withColumn(_KEY, F.col(on)).withColumn(fkey, F.col(forward_on))
              .withColumn(_SIDE, F.lit(1)))
    refs = right.select(*[F.col(b) for b in by], F.col(right_on).alias(_KEY),
                        F.col(right_on).alias(fkey),
                        F.struct(F.col(value).alias(value)).alias(_HIT),
                        F.lit(0).alias(_SIDE))
    stacked = probes.unionByName(refs, allowMissingColumns=True)
    wb = (Window.partitionBy(*by).orderBy(F.col(_KEY).asc(), F.col(_SIDE).asc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wf = (Window.partitionBy(*by).orderBy(F.col(fkey).desc(), F.col(_SIDE).asc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = (stacked
               .withColumn(back_name, F.last(F.col(_HIT), ignorenulls=True).over(wb)[value])
               .withColumn(fwd_name, F.last(F.col(_HIT), ignorenulls=True).over(wf)[value])
               .where(F.col(_SIDE) == 1))
    return carried.select(*left.columns, back_name, fwd_name)


def asof_join_ranged(left: DataFrame, right: DataFrame, *, by: str | Sequence[str],
                     left_on: str, right_on: str, values: Sequence[str],
                     direction: str = "backward", prefix: str = "") -> DataFrame:
    """``asof_join`` for keys whose distinct as-of values are not bounded by a calendar
    (intraday times): no ``by`` key has to fit one window partition.

    Both sides are reduced to one row per (by, time), stacked and range-partitioned on
    that pair, so a hot key spans many tasks and equal times meet in one. Inside a
    (partition, key) slice the last right row is carried as usual; a probe before the
    first right row of its slice takes the one that an earlier slice of the key ends
    with (a later slice begins with, forward), from a table of one row per slice.

    Of right rows with equal (by, time) the one with the greatest ``values`` is taken.
    A null key or time matches nothing. ``values`` need an order (no maps).
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    back = direction == "backward"
    names = [f"__asof_by{i}" for i in range(len(_as_list(by)))]
    keys = [*names, _KEY]

    def keyed(df: DataFrame, on: str, *more: Column) -> DataFrame:
        return df.select(*[F.col(b).alias(n) for b, n in zip(_as_list(by), names)],
                         F.col(on).alias(_KEY), *more).dropna(subset=keys)

    refs = keyed(right, right_on, F.struct(*[F.col(v).alias(v) for v in values]).alias(_HIT))
    refs = refs.groupBy(*keys).agg(F.max(_HIT).alias(_HIT)).withColumn(_SIDE, F.lit(0))
    probes = keyed(left, left_on).distinct().withColumn(_SIDE, F.lit(1))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stacked = (refs.unionByName(probes, allowMissingColumns=True)
               .repartitionByRange(n, *keys).withColumn("__asof_part", F.spark_partition_id()))
    # two branches read the partition ids: one assignment for both, as in
    # ``lagged_mean_by_prefix_sums``
    from ..session import cut_lineage
    stacked = cut_lineage(stacked)
    slices = ["__asof_part", *names]
    order = [F.col(_KEY).asc() if back else F.col(_KEY).desc(), F.col(_SIDE).asc()]
    inside = (Window.partitionBy(*slices).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = stacked.withColumn(_HIT, F.last(_HIT, ignorenulls=True).over(inside)).where(
        F.col(_SIDE) == 1)
    edge = F.max_by if back else F.min_by
    only = F.when(F.col(_SIDE) == 0, F.col(_KEY))     # probes have no part in an edge
    ends = stacked.groupBy(*slices).agg(edge(_HIT, only).alias("__asof_end"))
    part = F.col("__asof_part")
    before = (Window.partitionBy(*names).orderBy(part.asc() if back else part.desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(*slices, F.last("__asof_end", ignorenulls=True).over(before).alias(
        "__asof_end"))
    found = local.join(ends, slices).select(*keys, F.coalesce(_HIT, "__asof_end").alias(_HIT))
    out = left.withColumns({**{n: F.col(b) for b, n in zip(_as_list(by), names)},
                            _KEY: F.col(left_on)}).join(found, keys, "left")
    return out.select(*[out[c] for c in left.columns],
                      *[F.col(f"{_HIT}.{v}").alias(prefix + v) for v in values])
