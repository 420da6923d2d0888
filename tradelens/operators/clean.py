"""Cleaning, typing and validation operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
INT_RANGE = {"int": (-(2 ** 31), 2 ** 31 - 1), "bigint": (-(2 ** 63), 2 ** 63 - 1024)}


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_sentinels(df: DataFrame) -> DataFrame:
    """Strings 'None' and '---' become NULL in every string column."""
    cols = set(string_columns(df))
    return df.select(*[S.null_if_sentinel(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop duplicate full rows."""
    return df.dropDuplicates()


def dropna_any(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def dropna_subset(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows null in any of ``subset`` ∩ columns (absent columns ignored)."""
    present = [c for c in subset if c in df.columns]
    return df.na.drop(how="any", subset=present) if present else df


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def normalize_text_keys(df: DataFrame, cols: Sequence[str] = ("ticker",)) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: S.normalize_key(c) for c in present})


def cast_numeric_or_reject(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast to numeric; unparsable / out-of-range values make the row go away.

    Integer targets take the integral cast first, which is exact over the whole
    64-bit range; only what it rejects ('10.5', '1e3') goes through double and is
    truncated, its range checked so ANSI overflow can not raise. Doubles and whole numbers
    are cast as they are: a double's text is never whole, and its rejection costs an
    exception a value.
    """
    out = {}
    for c, typ in casts.items():
        kind = df.schema[c].dataType
        if isinstance(kind, (T.DoubleType, *WHOLE)):
            lo, hi = INT_RANGE.get(typ, (None, None))
            if typ not in INT_RANGE:
                out[c] = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast(typ))
            elif isinstance(kind, T.LongType) and typ == "bigint":
                out[c] = F.col(c)
            else:     # a NaN is greater than any bound
                out[c] = F.when((F.col(c) >= lo) & (F.col(c) <= hi), F.col(c).cast(typ))
            continue
        text = F.trim(F.col(c).cast("string"))
        as_double = text.try_cast("double")
        ok = as_double.isNotNull() & ~F.isnan(as_double)
        if typ in INT_RANGE:
            lo, hi = INT_RANGE[typ]
            ok = ok & (as_double >= lo) & (as_double <= hi)
        cast = F.when(ok, as_double).cast(typ)
        out[c] = F.coalesce(text.try_cast(typ), cast) if typ in INT_RANGE else cast
    keep = None
    for c in casts:
        keep = F.col(c).isNotNull() if keep is None else keep & F.col(c).isNotNull()
    typed = df.withColumns(out)
    return typed if keep is None else typed.where(keep)


def parse_bool_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Explicit boolean parsing: 'true'/'1' (any case) -> true, else false."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: S.truthy_flag(c) for c in present})


def cast_date_or_reject(df: DataFrame, col: str = "date") -> DataFrame:
    return df.withColumn(col, S.parse_date_with_suffix(col)).where(F.col(col).isNotNull())


# Types of the stored transaction columns
NUMERIC = {"shares": "int", "price": "double", "remaining_shares": "int", "direct_holding": "bigint",
           "indirect_holding": "bigint", "market_cap": "bigint", "timestamp": "bigint"}
FLAGS = ("rule105b1", "derivative", "equity_swap")


def clean_transactions(tx: DataFrame, dedup: bool = True) -> DataFrame:
    """The store writer's steps, on the columns present: sentinels to null, exact
    duplicates and rows with a null dropped, tickers normalised, flags parsed,
    numbers and dates typed or rejected. ``dedup=False`` leaves exact duplicates to a
    keyed upsert that follows."""
    out = null_sentinels(tx)
    out = normalize_text_keys(dropna_any(dedup_exact(out) if dedup else out), ("ticker",))
    strings = set(string_columns(out))
    out = parse_bool_flags(out, [c for c in FLAGS if c in strings])
    out = cast_numeric_or_reject(out, {c: t for c, t in NUMERIC.items() if c in out.columns})
    return cast_date_or_reject(out, "date")


def assert_all_equal(df: DataFrame, col: str, value: str, *, mode: str = "quarantine",
                     name: str = "direction_check") -> tuple[DataFrame, DataFrame]:
    """Validate ``col == value`` (null fails). Returns (good, bad).

    ``mode='raise'`` makes the first bad row fail the job through
    ``raise_error`` inside the plan (no driver-side collect); 'quarantine'
    returns the bad rows for a dead-letter sink.
    """
    ok = F.col(col).eqNullSafe(F.lit(value))
    if mode == "raise":
        checked = df.withColumn(
            col, F.when(ok, F.col(col)).otherwise(
                F.raise_error(F.concat(F.lit(f"{name}: {col} is not '{value}': "),
                                       F.coalesce(F.col(col), F.lit("NULL"))))))
        return checked, df.limit(0)
    return df.where(ok), df.where(~ok)


def assert_no_nulls(df: DataFrame, col: str, name: str = "null_check") -> DataFrame:
    """Fail the job on a null in ``col`` (raise_error, evaluated lazily)."""
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.col(col)).otherwise(
        F.raise_error(F.lit(f"{name}: {col} contains NULL")).cast(df.schema[col].dataType)))


def rows_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways; empty result means the frames are equal."""
    return a.exceptAll(b).withColumn("__side", F.lit("left_only")).unionByName(
        b.exceptAll(a).withColumn("__side", F.lit("right_only")))


def multiset_fingerprint(df: DataFrame) -> DataFrame:
    """One row (n, h1, h2): row count and two sums of independent 64-bit row
    hashes (decimal sums, no overflow). Equal multisets give equal
    fingerprints; computed with map-side partial aggregation, no shuffle of
    the rows themselves, so it scales where ``exceptAll`` would not."""
    cols = [F.col(c) for c in df.columns]
    h1 = F.xxhash64(*cols).cast("decimal(38,0)")
    h2 = F.xxhash64(F.lit("salt"), *cols).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("h1"), F.sum(h2).alias("h2"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality by fingerprint (columns matched by name)."""
    fa = multiset_fingerprint(a.select(*sorted(a.columns))).first()
    fb = multiset_fingerprint(b.select(*sorted(b.columns))).first()
    return tuple(fa) == tuple(fb)
