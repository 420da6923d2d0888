"""Registered queries: index, pages, price bars / refresh, keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import master_index as MI
from ..sources.catalog import latest_by_key
from ..sources.html import page_links
from ..sources.tables import read_table
from .index_docs import INDEX_SQL, index_lines
from .messages import MESSAGES_SQL, raw_messages
from .proxies import PRICES_SQL, TRANSACTIONS_SQL, price_bars, with_ctes
from .registry import register

_I = dict(ix=INDEX_SQL)
NOW = "2001-05-15"
CUTOFF = "1999-06-30"


def _index(spark, sf):
    return MI.parse_index_lines(index_lines(spark, sf))


@register("src_master_index", with_ctes(
    "select cik, company, form_type, date, file_path, year, quarter from ix", **_I))
def q_src_master_index(spark, sf):
    """Index files landed per quarter as text, read by the index reader."""
    import uuid

    from ..session import scratch_path
    path = scratch_path(spark, f"index-{uuid.uuid4().hex[:12]}")
    index_lines(spark, sf).write.partitionBy("year", "quarter").text(path)
    return MI.read_master_index(spark, path).select(
        "cik", "company", "form_type", "date", "file_path", "year", "quarter")


@register("filter_form_type", with_ctes(
    "select cik, form_type, file_path from ix where form_type = '4'", **_I))
def q_filter_form_type(spark, sf):
    return MI.filter_form_type(_index(spark, sf), "4").select("cik", "form_type", "file_path")


@register("index_backfill", with_ctes(
    "select cik, date, file_path, year, quarter from ix where year between 1998 and 2001 "
    "and form_type = '4'", **_I))
def q_index_backfill(spark, sf):
    ix = MI.index_backfill(_index(spark, sf), now_year=2001, years=3, form_type="4")
    return ix.select("cik", "date", "file_path", "year", "quarter")


@register("index_current_quarter", with_ctes(
    "select cik, date, file_path from ix where year = 2001 and quarter = 2 and form_type = '4'",
    **_I))
def q_index_current_quarter(spark, sf):
    return MI.index_current_quarter(_index(spark, sf), now=NOW, form_type="4").select(
        "cik", "date", "file_path")


@register("index_messages", with_ctes(
    "select cik, company, form_type, date, file_path, epoch_ms(date::date::timestamp) as timestamp, "
    "substr(sha256(file_path), 1, 16) as key from ix where form_type = '4'", **_I))
def q_index_messages(spark, sf):
    return MI.index_messages(MI.filter_form_type(_index(spark, sf), "4"))


@register("html_links",
          "select distinct regexp_replace(h, '^/Archives/', '') as link from "
          "(select unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) as h from pages) "
          "where h like '%a'")
def q_html_links(spark, sf):
    """Anchor targets with a suffix, as the listing pages are searched for texts."""
    return page_links(read_table(spark, sf, "pages"), suffix="a")


@register("union_distinct_links",
          "select distinct regexp_replace(h, '^/Archives/', '') as link from "
          "(select unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as h from pages)")
def q_union_distinct_links(spark, sf):
    """Links gathered page batch by page batch, then a set union."""
    pages = read_table(spark, sf, "pages")
    a = page_links(pages.where(F.col("url").startswith("https")))
    b = page_links(pages.where(~F.col("url").startswith("https")))
    return a.union(b).distinct()


@register("src_price_bars", with_ctes("select ticker, date, close from p", p=PRICES_SQL))
def q_src_price_bars(spark, sf):
    """Bars landed as CSV, read by the bar reader, stored sorted and read back."""
    import os
    import uuid

    from ..session import scratch_path
    from ..sources import prices as PR
    root = scratch_path(spark, f"bars-{uuid.uuid4().hex[:12]}")
    PR.write_bars_csv(price_bars(spark, sf), os.path.join(root, "landed"))
    PR.write_bars(PR.read_bars_csv(spark, os.path.join(root, "landed")), os.path.join(root, "bars"))
    return spark.read.parquet(os.path.join(root, "bars")).select("date", "close", "ticker")


def _stored_prices(spark, sf):
    """The stored bars: history up to a cutoff, only for part of the tickers."""
    p = price_bars(spark, sf)
    return p.where((F.col("date") <= F.lit(CUTOFF).cast("date")) & (F.col("ticker") < "T5"))


_STORED_SQL = (f"select * from p where date <= date '{CUTOFF}' and ticker < 'T5'")


@register("price_refresh_incremental", with_ctes(
    "select p.ticker, p.date, p.close from p left join (select ticker, max(date) as hw from s "
    "group by ticker) h using (ticker) where h.hw is null or p.date > h.hw",
    p=PRICES_SQL, s=_STORED_SQL))
def q_price_refresh_incremental(spark, sf):
    """The history is stored once; the bars after the marks kept with it are the new ones."""
    from ..sources import prices as PR
    store = _price_store(spark)
    PR.refresh_bars(store, _stored_prices(spark, sf))
    return PR.bars_after(price_bars(spark, sf), PR.stored_marks(store))


def _price_store(spark):
    import uuid

    from ..session import scratch_path
    from ..sources.catalog import FeatureStore, load_catalog
    from ..sources.prices import PRICE_CATALOG
    return FeatureStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}"),
                        load_catalog(PRICE_CATALOG, 1))


@register("refresh_prices", with_ctes(
    "select ticker, date, close from s union all select p.ticker, p.date, p.close from p "
    "left join (select ticker, max(date) as hw from s group by ticker) h using (ticker) "
    "where (h.hw is null or p.date > h.hw) and p.ticker in "
    "(select distinct upper(trim(ticker)) from tx)",
    p=PRICES_SQL, s=_STORED_SQL, tx=TRANSACTIONS_SQL))
def q_refresh_prices(spark, sf):
    """Incremental refresh composite: tickers taken from the transaction table, their bars
    after each stored mark upserted into the stored ``p``, which is read back."""
    from ..operators import clean as C
    from ..sources.prices import refresh_bars
    from .proxies import transactions
    from .target import semi_join_tickers
    store = _price_store(spark)
    refresh_bars(store, _stored_prices(spark, sf))
    tickers = C.normalize_text_keys(transactions(spark, sf).select("ticker"))
    refresh_bars(store, semi_join_tickers(price_bars(spark, sf), tickers))
    return store.read("p")


def _store(spark, name, key):
    """A store of one fresh table in the shared folder."""
    import uuid

    from ..session import scratch_path
    from ..sources.catalog import FeatureStore, load_catalog
    return FeatureStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}"),
                        load_catalog({name: {"primary_key": key, "event_time": "ts"}}, 1))


@register("fg_upsert",
          "select event_id, user_id, ts, event_type, value from (select *, row_number() over "
          "(partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def q_fg_upsert(spark, sf):
    """Three batches (one per ten days of events) upserted into a stored table
    keyed by user, and the table read back."""
    e = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    day = F.dayofmonth("ts")
    store = _store(spark, "user_latest", ["user_id"])
    for b in (e.where(day <= 10), e.where((day > 10) & (day <= 20)), e.where(day > 20)):
        # within a batch the event id breaks ties between equal times
        store.upsert("user_latest", latest_by_key(b, ("user_id",), "ts", order_extra=("event_id",)))
    return store.read("user_latest").select(*e.columns)


@register("fg_read", "select event_id, user_id, value from events where event_type = 'purchase'")
def q_fg_read(spark, sf):
    """Stored-table read with a caller predicate (pushed into the scan)."""
    store = _store(spark, "events", ["event_id", "ts"])
    store.upsert("events", read_table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", "value"))
    return store.read("events", lambda fg: fg["event_type"] == "purchase").select(
        "event_id", "user_id", "value")


@register("fg_catalog", "select 'events_by_user' as name, 2 as version, count(distinct user_id) as n "
          "from events union all select 'events_by_type', 2, count(distinct event_type) from events")
def q_fg_catalog(spark, sf):
    """Two tables of one catalog, written and read through their references: the
    name defaults to the reference key, the version is injected."""
    import uuid

    from ..session import scratch_path
    from ..sources.catalog import FeatureStore, load_catalog
    catalog = load_catalog({"u": {"name": "events_by_user", "primary_key": ["user_id"],
                                  "event_time": "ts"},
                            "events_by_type": {"primary_key": ["event_type"], "event_time": "ts"}}, 2)
    store = FeatureStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}"), catalog)
    e = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    out = None
    for ref, spec in catalog.items():
        store.upsert(ref, e)
        one = store.read(ref).agg(F.lit(spec.name).alias("name"), F.lit(spec.version).alias("version"),
                                  F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@register("route_by_mode", with_ctes(
    "select event_type = 'purchase' as training, count(*) as n from m group by 1", m=MESSAGES_SQL))
def q_route_by_mode(spark, sf):
    """The drain loop routes every micro-batch to the training or the
    inference table by a per-row mode flag (two filtered writes inside one
    ``foreachBatch``, both idempotent per batch id); the query reports the
    rows each table received."""
    import os

    from ..streaming import streams as ST
    from ..sources import topics as TP
    run = ST.run_dir(spark, "route")
    m = raw_messages(spark, sf).withColumn("training", F.col("event_type") == "purchase")
    path = os.path.join(run, "in")
    ST.land(m, path)
    stream = TP.read_topic_stream(spark, path=path, schema=m.schema,
                                  batch_size=ST.files_per_batch(spark, path))
    train_out, infer_out = os.path.join(run, "train"), os.path.join(run, "infer")

    def sink(batch, batch_id):
        batch.persist()
        for flag, out in ((True, train_out), (False, infer_out)):
            batch.where(F.col("training") == flag).select("key", "event_id") \
                .write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
        batch.unpersist()

    ST.drain(stream, sink, os.path.join(run, "ckpt"))
    counts = [ST.read_batches(spark, out).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("training", F.lit(flag))
              for flag, out in ((True, train_out), (False, infer_out))]
    return counts[0].unionByName(counts[1]).select("training", "n")


@register("fg_read_or_empty", "select event_id, user_id, ts, event_type from events")
def q_fg_read_or_empty(spark, sf):
    """Stored version 1 is read; the absent version 2 reads as an empty frame
    with the same schema (the flow continues), and the two are stacked."""
    import uuid

    from ..session import scratch_path
    from ..sources.catalog import FeatureStore, load_catalog
    root = scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}")
    spec = {"events": {"primary_key": ["event_id"], "event_time": "ts"}}
    v1 = FeatureStore(spark, root, load_catalog(spec, 1))
    v2 = FeatureStore(spark, root, load_catalog(spec, 2))
    rows = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    v1.upsert("events", rows)
    schema = rows.schema
    return v1.read_or_empty("events", schema).unionByName(v2.read_or_empty("events", schema))
