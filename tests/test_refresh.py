"""A refresh of the target gives what a rebuild gives, from fewer months."""

import datetime as dt
import random

from tradelens.plans import target as TG
from tradelens.plans.refresh import REFRESH_CATALOG, refresh_training
from tradelens.sources.catalog import FeatureStore, load_catalog

DAY = dt.date(2023, 1, 1)
TX = ("key string, ticker string, company_cik string, date date, timestamp long, shares double, "
      "remaining_shares double, direct_holding double, indirect_holding double, equity_swap boolean, "
      "rule105b1 boolean, derivative boolean, owner_code string, ownership string, coding string, "
      "price double, acquired_disposed string")


def tx_row(rng, n, ticker, day):
    date = DAY + dt.timedelta(days=day)
    ms = int(dt.datetime(date.year, date.month, date.day, tzinfo=dt.timezone.utc).timestamp()) * 1000
    return (f"k{n:05}", ticker, "c", date, ms, float(rng.randrange(1, 50)), 10.0, 1.0, 2.0, False,
            rng.random() < 0.5, False, "1000", "D", rng.choice("PS"),
            float(rng.randrange(0, 9)), rng.choice("DDDA"))


def test_refresh_equals_rebuild(spark, tmp, monkeypatch):
    rng = random.Random(3)
    tickers = [f"T{i}" for i in range(6)]
    days = [sorted(rng.sample(range(100), 30)) for _ in tickers]
    deliveries = [
        # all of the past, but of the last ticker
        ([(t, d) for t, ds in zip(tickers[:5], days) for d in ds], range(0, 100, 3), tickers[:5]),
        # the next days of two tickers, and days of one without a new bar
        ([("T0", 101), ("T1", 104), ("T0", 118), ("T2", 103)], range(102, 160, 3), tickers[:2]),
        # a late transaction, a new ticker, a correction of an old bar
        ([("T3", 41), *[("T5", d) for d in days[5]]], range(0, 120, 5), ["T5"]),
        ([], [51, 52], ["T4"]),
    ]
    fs = FeatureStore(spark, tmp + "/a", load_catalog(REFRESH_CATALOG, 1))
    whole = FeatureStore(spark, tmp + "/b", load_catalog(REFRESH_CATALOG, 1))
    read, n = [], 0
    plain = FeatureStore.read

    def watched(self, ref, where=None, since=None):
        read.append((ref, since))
        return plain(self, ref, where, since)

    for k, (txs, bar_days, bar_tickers) in enumerate(deliveries):
        rows = [tx_row(rng, n + i, t, d) for i, (t, d) in enumerate(txs)]
        n += len(rows)
        bars = [(t, DAY + dt.timedelta(days=d), float(rng.randrange(1, 99)))
                for t in bar_tickers for d in bar_days]
        for store in (fs, whole):
            store.upsert("bt4", spark.createDataFrame(rows, TX))
            store.upsert("p", spark.createDataFrame(bars, "ticker string, date date, close double"))
        with monkeypatch.context() as m:
            m.setattr(FeatureStore, "read", watched)
            read.clear()
            refresh_training(fs, period=30)
        if k == 1:      # new days: only the last months of either table
            assert all(since >= dt.date(2023, 2, 1) for ref, since in read if ref in ("bt4", "p"))
        TG.run_training(whole, period=30)
        order = fs.read("rt4").columns
        got, want = (sorted(map(tuple, s.read("rt4").select(*order).collect())) for s in (fs, whole))
        assert got == want and got, k
    assert refresh_training(fs, period=30) is None
