"""Window operators: lagged expanding average, latest row per key, batching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import DAY_MS, RETURN_SCALE


def expanding_lagged_avg(df: DataFrame, *, value_e5: str | Column, delta_days: int,
                         by: str = "ticker", time_ms: str = "timestamp",
                         out: str = "avg_target_expanding") -> DataFrame:
    """Per ``by`` key, mean of the value over all rows with
    ``time <= current time - delta`` (inclusive, nulls skipped, none -> null).

    The value is given in integer 1e-5 units (``return_e5``) so the running sum
    is exact and the result is independent of evaluation order. A range frame
    over the numeric time grows incrementally: linear per key after the sort.
    Rows sharing a time are peers, i.e. all of them are in or out together.

    One window partition per key: meant for daily-aggregated input (at most
    one row per key and day, so a partition is bounded by the calendar). For
    raw rows where one key may hold a large share of the data use
    ``lagged_mean_by_prefix_sums``, which gives the same values.
    """
    v = F.col(value_e5) if isinstance(value_e5, str) else value_e5
    w = (Window.partitionBy(by).orderBy(F.col(time_ms))
         .rangeBetween(Window.unboundedPreceding, -int(delta_days) * DAY_MS))
    avg = F.try_divide(F.sum(v).over(w).cast("double"),
                       F.count(v).over(w) * F.lit(RETURN_SCALE))
    return df.withColumn(out, avg)


def latest_row_per_key(df: DataFrame, *, by: Sequence[str] | str = "ticker",
                       order: Sequence[str] = ("date", "key")) -> DataFrame:
    """Last row by ``order`` per key (``order`` must make the choice unique).

    An aggregate (``max_by`` of the whole row), not a window: partial
    aggregation collapses a hot key map-side instead of sorting it in one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    payload = [c for c in df.columns if c not in by]
    agg = df.groupBy(*by).agg(F.max_by(F.struct(*[F.col(c) for c in payload]),
                                       F.struct(*[F.col(o) for o in order])).alias("__row"))
    return agg.select(*by, *[F.col(f"__row.{c}").alias(c) for c in payload]).select(*df.columns)


def latest_value_per_key(df: DataFrame, *, by: str, value: str,
                         order: Sequence[str] = ("date", "key")) -> DataFrame:
    """One value per key from its last row: a plain aggregate with map-side
    partial ``max_by`` (no sort of the whole group, skew-safe)."""
    return df.groupBy(by).agg(
        F.max_by(F.col(value), F.struct(*[F.col(o) for o in order])).alias(value))


def fixed_size_batches(df: DataFrame, *, size: int, order: Sequence[str],
                       by: Sequence[str] | None = None, out: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order`` (per ``by`` group if
    given): ``floor((row position - 1) / size)``.

    No window over a whole group: rows are range-partitioned on
    ``(*by, *order)`` — so a hot group is spread over several partitions —
    and sorted inside each partition; a row's position is its offset inside
    the partition (``monotonically_increasing_id``) plus the number of rows of
    its group in earlier partitions, taken from a per-(partition, group)
    count table whose size is bounded by partitions + groups, not by rows.
    ``order`` must be unique within a group so re-computed tasks agree.
    """
    by = list(by or [])
    keys = by + list(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pid, mid = "__pid", "__mid"
    # explicit partition count: AQE leaves the layout alone, so both reads
    # of the exchange (rows and counts) see the same partitions
    ordered = (df.repartitionByRange(n, *[F.col(k) for k in keys])
                 .sortWithinPartitions(*keys)
                 .withColumn(pid, F.spark_partition_id())
                 .withColumn(mid, F.monotonically_increasing_id()))
    # partition ids and positions are read by two branches: pin them with a
    # reliable checkpoint in the shared folder
    from ..session import cut_lineage
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy(pid, *by).agg(F.min(mid).alias("__first"),
                                           F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # null-safe: a null group is a group of its own
    offs = offs.select(F.col(pid).alias("__opid"), *[F.col(b).alias(f"__o_{b}") for b in by],
                       "__first", "__off")
    on = ordered[pid] == offs["__opid"]
    for b in by:
        on = on & ordered[b].eqNullSafe(offs[f"__o_{b}"])
    res = ordered.join(offs, on).drop("__opid", *[f"__o_{b}" for b in by])
    pos = F.col("__off") + F.col(mid) - F.col("__first")
    return (res.withColumn(out, F.floor(pos / F.lit(size)).cast("bigint"))
               .drop(pid, mid, "__first", "__off"))


def lagged_mean_by_prefix_sums(df: DataFrame, *, value: str, delta_days: int,
                               by: str = "ticker", time_ms: str = "timestamp",
                               scale: float = 1.0, out: str = "avg_target_expanding"
                               ) -> DataFrame:
    """Same result as ``expanding_lagged_avg`` (sum / (count * scale) over all
    rows of the key with ``time <= current - delta``), without putting a key's
    rows into one task, for inputs where one key may hold a large share of
    all rows (e.g. raw intraday rows).

    Every row is stacked twice: as a value at its own time and as a probe at
    ``time - delta``. The stack is range-partitioned on (key, time, side), so
    a hot key spans many partitions; running sums inside each
    (partition, key) slice plus the totals of the same key in earlier
    partitions (a table with one row per (partition, key)) give each probe
    the sum and count of all values at or before it. Values sort before
    probes at equal times (inclusive bound). ``value`` should be integral for
    order-independent exact sums.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pid = "__pid"
    cut = F.col(time_ms) - F.lit(int(delta_days) * DAY_MS)
    # A probe's answer depends only on (key, cut-off): distinct probes, joined
    # back on that pair at the end (no row ids, which would not survive a
    # recomputation of a shuffled input).
    probes = (df.select(F.col(by), cut.alias("__t")).distinct()
                .select(by, "__t", F.lit(None).cast("long").alias("__v"),
                      F.lit(0).cast("long").alias("__n"), F.lit(1).alias("__side")))
    # values of one (key, time) are summed before the shuffle: however many rows
    # share a time, they are one row of the stack
    values = df.groupBy(F.col(by), F.col(time_ms).alias("__t")).agg(
        F.sum(F.col(value).cast("long")).alias("__v"), F.count(value).alias("__n")).select(
        by, "__t", "__v", "__n", F.lit(0).alias("__side"))
    stacked = (values.unionByName(probes)
               .repartitionByRange(n, F.col(by), F.col("__t"), F.col("__side"))
               .withColumn(pid, F.spark_partition_id()))
    # The partition id is read by two branches (running sums and per-slice
    # totals); a reliable checkpoint in the shared folder pins one assignment
    # for both instead of trusting two evaluations of the range exchange.
    from ..session import cut_lineage
    stacked = cut_lineage(stacked)
    run = (Window.partitionBy(pid, by).orderBy("__t", "__side")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (stacked.withColumn("__ls", F.sum("__v").over(run))
                    .withColumn("__lc", F.sum("__n").over(run))
                    .where(F.col("__side") == 1))
    totals = stacked.groupBy(pid, by).agg(F.sum("__v").alias("__s"), F.sum("__n").alias("__c"))
    before = Window.partitionBy(by).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(pid, by, F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__os"),
                         F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__oc"))
    offs = offs.withColumnsRenamed({pid: "__opid", by: "__oby"})
    probed = local.join(offs, (local[pid] == offs["__opid"])
                        & local[by].eqNullSafe(offs["__oby"])).select(
        F.col(by).alias("__pby"), F.col("__t").alias("__pt"),
        (F.coalesce(F.col("__ls"), F.lit(0)) + F.col("__os")).alias("__sum"),
        (F.col("__lc") + F.col("__oc")).alias("__cnt"))
    avg = F.try_divide(F.col("__sum").cast("double"), F.col("__cnt") * F.lit(float(scale)))
    # many rows may share one (key, cut-off): an equi-join AQE can split
    cutoff = df.withColumn("__t", cut)
    joined = cutoff.join(probed, cutoff[by].eqNullSafe(probed["__pby"])
                         & cutoff["__t"].eqNullSafe(probed["__pt"]), "left")
    return joined.withColumn(out, F.when(F.col("__cnt") > 0, avg)).drop(
        "__t", "__pby", "__pt", "__sum", "__cnt")
