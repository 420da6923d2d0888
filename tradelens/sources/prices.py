"""Daily close bars: landed-bar reader and incremental refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_SCHEMA = T.StructType([T.StructField("ticker", T.StringType()),
                           T.StructField("date", T.DateType()),
                           T.StructField("close", T.DoubleType()),
                           T.StructField("_corrupt_record", T.StringType())])


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed bars ``ticker,date,close``; unparsable lines are skipped (the
    failing symbol's rows vanish, the rest load); the result always has the
    three columns, even when empty."""
    df = (spark.read.schema(BAR_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    return (df.where(F.col("_corrupt_record").isNull() & F.col("ticker").isNotNull()
                     & F.col("date").isNotNull())
              .select(F.upper(F.trim("ticker")).alias("ticker"), "date", "close"))


def high_water_marks(stored: DataFrame) -> DataFrame:
    """Per ticker, the last stored date (null maxima ignored)."""
    return stored.groupBy("ticker").agg(F.max("date").alias("hw"))


def new_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars after each ticker's high-water mark; unknown tickers (or a null
    mark) take the full history. The marks are one row per ticker; the join
    is planned by Catalyst/AQE (broadcast only when measured small)."""
    return bars_after(bars, high_water_marks(stored))


def bars_after(bars: DataFrame, marks: DataFrame) -> DataFrame:
    """Bars after the mark ``hw`` of their ticker; all of a ticker without one."""
    j = bars.join(marks, on="ticker", how="left")
    return j.where(F.col("hw").isNull() | (F.col("date") > F.col("hw"))).select(*bars.columns)


# The stored bars and the last stored date of every ticker.
PRICE_CATALOG = {
    "p": {"primary_key": ["ticker", "date"], "event_time": "date"},
    "p_marks": {"primary_key": ["ticker"], "event_time": "date", "conflict": "event_time"},
}


def stored_marks(store) -> DataFrame:
    """ticker, hw: the marks kept with each refresh; ``p`` itself is not read."""
    return store.read_or_empty("p_marks", "ticker string, date date").withColumnRenamed("date", "hw")


def refresh_bars(store, bars: DataFrame) -> int | None:
    """Upserts the bars after each ticker's stored mark into ``p`` and moves the marks.

    The marks follow the bars: a death between the two makes the next refresh bring the same
    bars once more, which changes nothing. The new marks come from the folders that this
    upsert wrote."""
    batch = store.upsert("p", bars_after(bars, stored_marks(store)))
    if batch is not None:
        store.upsert("p_marks", store.changes("p", batch - 1).groupBy("ticker").agg(
            F.max("date").alias("date")))
    return batch


def write_bars(bars: DataFrame, path: str) -> None:
    """Range-partitioned and sorted by (ticker, date): a heavy ticker spans files."""
    bars.repartitionByRange("ticker", "date").sortWithinPartitions("ticker", "date") \
        .write.mode("overwrite").parquet(path)


def write_bars_csv(bars: DataFrame, path: str) -> None:
    """Bars as landed CSV files with a header."""
    bars.select("ticker", "date", "close").write.mode("overwrite").option("header", True).csv(path)
