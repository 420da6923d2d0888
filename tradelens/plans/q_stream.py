"""Registered queries: the streaming services, drained with availableNow.

Inputs are landed files derived from the driver tables (events -> topic
messages, orders x lineitem -> filing texts, lineitem -> transactions) in a
fresh run folder under the shared checkpoint directory; each query drains a
file-source stream through ``foreachBatch`` and returns what the sink holds.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import form4 as X
from ..operators import clean as C
from ..sources import topics as TP
from ..session import shuffles_removed
from ..sources.catalog import FeatureStore, grouped, load_catalog
from ..sources.segments import Consumer, SegmentTopic
from ..sources.tables import read_table
from ..streaming import streams as ST
from .filing_docs import PARSED_SQL, stored_filing_texts
from .index_docs import INDEX_SQL
from .messages import MESSAGES_SQL, raw_messages
from .proxies import with_ctes
from .q_enrich import _ENRICH_CTES
from .registry import register

_M = dict(m=MESSAGES_SQL)


def _landed_messages(spark, sf, run):
    """Topic messages landed as files that many tasks read."""
    m = raw_messages(spark, sf)
    return ST.land(m, os.path.join(run, "in")), m.schema


def _stream(spark, path, schema, batch_files=None):
    return TP.read_topic_stream(spark, path=path, schema=schema,
                                batch_size=batch_files or ST.files_per_batch(spark, path))


def _topic(spark, sf, run):
    """The messages published as a topic of several segments, and a limit in records that
    takes a few polls."""
    topic = SegmentTopic(spark, os.path.join(run, "topic"))
    n = topic.publish(raw_messages(spark, sf))
    return topic, max(1, -(-n // 3))


@register("topic_read_bounded", with_ctes("select event_id, key, value from m", **_M))
def q_topic_read_bounded(spark, sf):
    """Consume the topic to its end, a bounded number of records at a time; values not
    decoded."""
    run = ST.run_dir(spark, "bounded")
    topic, limit = _topic(spark, sf, run)
    out = os.path.join(run, "out")
    Consumer(topic, "bounded").drain(ST.batch_sink(out), limit)
    return ST.read_batches(spark, out).select("event_id", "key", "value")


@register("stream_rate_limit", with_ctes(
    "select count(*) as n_rows, true as several_batches, true as within_limit from m", **_M))
def q_stream_rate_limit(spark, sf):
    """A bounded number of records per poll: all records arrive, in several batches, none
    of which has more records than the limit."""
    run = ST.run_dir(spark, "rate")
    topic, limit = _topic(spark, sf, run)
    out = os.path.join(run, "out")
    Consumer(topic, "rate").drain(ST.batch_sink(out), limit)
    per_batch = ST.read_batches(spark, out).groupBy("batch_id").count()
    return per_batch.agg(F.sum("count").alias("n_rows"), (F.count("*") > 1).alias("several_batches"),
                         (F.max("count") <= limit).alias("within_limit"))


@register("topic_read_at_least_once", with_ctes(
    "select event_id, json_extract(value, '$.k')::bigint as k from m where json_valid(value)",
    **_M))
def q_topic_read_at_least_once(spark, sf):
    """Long-lived consumer: decode, skip bad messages (dead letter), write; offsets commit
    after the sink, the sink is idempotent per batch. The first consumer dies after its
    second sink and before the commit; another one of the group takes over."""
    run = ST.run_dir(spark, "alo")
    topic, limit = _topic(spark, sf, run)
    out, dead = os.path.join(run, "out"), os.path.join(run, "dead")

    def sink(batch, batch_id):
        good, bad = TP.decode_json(batch.select("event_id", "value"), "k bigint")
        good.select("event_id", "k").write.mode("overwrite").parquet(
            os.path.join(out, f"batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(os.path.join(dead, f"batch_id={batch_id}"))

    first = Consumer(topic, "store")
    for last in (False, True):
        poll = first.poll(limit)
        if poll.size:
            sink(poll.records, poll.batch)
            if not last:
                first.commit(poll)
    Consumer(topic, "store").drain(sink, limit)
    return ST.read_batches(spark, out).drop("batch_id")


@register("topic_write", with_ctes(
    "select key, event_id, user_id, event_type, epoch_us(ts) // 1000 as timestamp from m", **_M))
def q_topic_write(spark, sf):
    """Publish (key, JSON value) through a streaming sink, read back, decode:
    decode(encode(x)) = x."""
    run = ST.run_dir(spark, "write")
    path, schema = _landed_messages(spark, sf, run)
    out = os.path.join(run, "topic")
    from ..functions import scalars as S
    # the event time travels inside the value (epoch ms), as on the topics
    msgs = TP.to_message(_stream(spark, path, schema).select(
        "key", "event_id", "user_id", "event_type",
        S.date_to_epoch_ms(F.col("ts")).alias("timestamp")), key="key")
    q = TP.write_topic(msgs, path=out, checkpoint=os.path.join(run, "ckpt")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    back = spark.read.schema("key string, value string").json(out)
    rec = F.from_json("value", "event_id bigint, user_id bigint, event_type string, "
                               "timestamp bigint")
    return back.select("key", *[rec[c].alias(c) for c in ("event_id", "user_id", "event_type",
                                                          "timestamp")])


# The topic's promises: a message comes again within REDELIVERY days, files hold PERIOD days.
REDELIVERY, PERIOD = 1, 5


def delivered_twice(events):
    """Events as they arrive: all once at their time, clicks again 20 hours later (within
    the re-delivery window), purchases again 25 days later (far outside)."""
    e = events.select("event_id", "event_type", F.col("ts").alias("arrived"))
    return e.unionByName(e.where("event_type = 'click'").withColumn(
        "arrived", F.expr("arrived + interval 20 hours"))).unionByName(
        e.where("event_type = 'purchase'").withColumn(
            "arrived", F.expr("arrived + interval 25 days")))


def dedup_topic(spark, path, schema, periods, sink, checkpoint):
    """Drain a landed topic through the dedup. State is kept for the re-delivery window
    and one period of disorder, measured in arrival time, so no first delivery is late."""
    stream = _stream(spark, path, schema, batch_files=ST.files_per_batch(spark, path, periods))
    deduped = ST.dedup_within_watermark(stream, key=["event_id"], ts="arrived",
                                        delay=f"{REDELIVERY + PERIOD} days")
    return ST.drain(deduped, sink, checkpoint)


@register("stream_dedup", "select event_id, event_type from events")
def q_stream_dedup(spark, sf):
    """An ordered topic delivers many events twice. Copies within the re-delivery window
    are dropped from bounded, evicted state; a copy that comes later passes the stream
    and meets its event in the table keyed by event id."""
    run = ST.run_dir(spark, "dedup")
    landed = delivered_twice(read_table(spark, sf, "events"))
    path = os.path.join(run, "in")
    periods = ST.land_in_order(landed, path, ts="arrived", days=PERIOD)
    store = FeatureStore(spark, run, load_catalog({"seen": {
        "primary_key": ["event_id"], "event_time": "arrived", "conflict": "event_time"}}, 1))
    dedup_topic(spark, path, landed.schema, periods,
                lambda batch, batch_id: store.upsert("seen", batch, batch_id),
                os.path.join(run, "ckpt"))
    return store.read("seen").drop("arrived")


@register("stream_drop_stale", with_ctes(
    "select event_id from m where ts >= timestamp '2024-01-30 00:00:00' - interval 10 day", **_M))
def q_stream_drop_stale(spark, sf):
    run = ST.run_dir(spark, "stale")
    path, schema = _landed_messages(spark, sf, run)
    out = os.path.join(run, "out")
    fresh = ST.stale_filter(_stream(spark, path, schema), "ts", now="2024-01-30 00:00:00",
                            days_back=10)
    ST.drain(fresh.select("event_id"), ST.batch_sink(out), os.path.join(run, "ckpt"))
    return ST.read_batches(spark, out).drop("batch_id")


_DRAIN_SQL = ("select key, user_id, ticker, shares, date, equity_swap from (select *, row_number() "
              "over (partition by user_id order by date desc, key desc) as rn from (select key, "
              "user_id, case when ticker in ('None', '---') then null else upper(trim(ticker)) end "
              "as ticker, trunc(try_cast(shares as double))::integer as shares, "
              "coalesce(try_strptime(trim(date), '%Y-%m-%d'), try_strptime(array_to_string("
              "string_split(trim(date), '-')[1:3], '-'), '%Y-%m-%d'))::date as date, "
              "coalesce(lower(trim(equity_swap)) in ('true', '1'), false) as equity_swap from m) "
              "where ticker is not null and shares is not null and date is not null) where rn = 1")


def _store_clean(batch):
    """The store writer's cleaning and typing of one batch."""
    b = C.null_sentinels(batch.select("key", "user_id", "ticker", "shares", "date", "equity_swap"))
    b = C.dedup_exact(b)
    b = C.normalize_text_keys(b, ("ticker",))
    b = C.cast_numeric_or_reject(b, {"shares": "int"})
    b = C.parse_bool_flags(b, ["equity_swap"])
    b = C.cast_date_or_reject(b, "date")
    return C.dropna_any(b)


@register("stream_drain_to_table", with_ctes(_DRAIN_SQL, **_M))
def q_stream_drain_to_table(spark, sf):
    """Consume until empty; clean, type and upsert each batch into a stored table
    keyed by user. Files arrive in any order, so this table keeps the latest event
    (date, then key) over all batches; replaying a batch changes nothing."""
    run = ST.run_dir(spark, "drain")
    path, schema = _landed_messages(spark, sf, run)
    store = FeatureStore(spark, run, load_catalog({"user_state": {
        "primary_key": ["user_id"], "event_time": "moment", "conflict": "event_time"}}, 1))

    def sink(batch, batch_id):
        rows = _store_clean(batch).withColumn("moment", F.struct("date", "key"))
        store.upsert("user_state", rows, batch_id)

    ST.drain(_stream(spark, path, schema), sink, os.path.join(run, "ckpt"))
    return store.read("user_state").drop("moment")


FILING_NOW, FILING_DAYS = "2001-05-15", 1500
TEXTS_PER_LOOKUP = 1_000_000


@register("stream_parse_filings", with_ctes(
    "select link, shares, derivative, rule105b1, date, sha256(concat(link, remaining_shares, "
    "case when derivative then '1' else '0' end)) as key from parsed join orders "
    "on o_orderkey = l_orderkey where parsed.o_orderpriority in ('1-URGENT', '2-HIGH') and "
    f"o_orderdate >= timestamp '{FILING_NOW}' - interval {FILING_DAYS} day", parsed=PARSED_SQL))
def q_stream_parse_filings(spark, sf):
    """Path messages (one per indexed form 4), in order of filing -> stale filter -> look up
    the stored texts, of which a micro-batch opens only the months and buckets it names ->
    parse -> publish one message per transaction; the query reads the published messages back."""
    from ..sources import master_index as MI
    from .index_docs import index_lines
    run = ST.run_dir(spark, "parse")
    store = stored_filing_texts(spark, sf)
    index = MI.filter_form_type(MI.parse_index_lines(index_lines(spark, sf)), "4")
    paths = MI.index_messages(index).select("file_path", "timestamp", "key",
                                            F.to_date("date").alias("filed"))
    path = os.path.join(run, "in")
    ST.land_in_order(paths, path, ts="filed", days=730)
    out = os.path.join(run, "topic")
    record = ("link", "shares", "derivative", "rule105b1", "date", "key")

    def sink(batch, batch_id):
        fresh = MI.filter_recent(batch, ts_ms=F.col("timestamp"), now=FILING_NOW,
                                 days_back=FILING_DAYS).select("file_path", "filed")
        # some months of filing after the others: the texts of one group's buckets are shuffled
        # at a time. The first write replaces what an earlier try left.
        month = F.coalesce(F.date_format("filed", "yyyy-MM"), F.lit("none"))
        counts = dict(fresh.groupBy(month).count().collect())
        for k, months in enumerate(grouped(counts, TEXTS_PER_LOOKUP) or [[]]):
            tx = X.with_message_fields(X.explode_transactions(X.parse_filings(store.lookup(
                "texts", fresh.where(month.isin(months))).select("file_path", "raw"))))
            messages = TP.to_message(tx.select(*record))
            with shuffles_removed(messages.sparkSession):
                messages.write.mode("append" if k else "overwrite").option(
                    "compression", "gzip").json(os.path.join(out, f"batch_id={batch_id}"))

    ST.drain(_stream(spark, path, paths.schema), sink, os.path.join(run, "ckpt"))
    sent = spark.read.schema("key string, value string").json(out)
    good, _ = TP.decode_json(sent, "link string, shares string, derivative boolean, "
                                   "rule105b1 boolean, date string")
    return good.select(*record)


_DEAD = ("select 'missing_mcap' as kind, null as key, upper(trim(ticker)) as subject, null as exchange, "
         "null as sic from e where _mcap_from_cache and market_cap is null union all "
         "select 'missing_sic', null, company_cik, null, null from e where sic is null union all "
         "select 'missing_exchange', null, company_cik, null, null from e where exchange is null")


@register("stream_enrich", with_ctes(
    "select 'message' as kind, key, company_cik as subject, exchange, sic from e union all "
    + _DEAD, **_ENRICH_CTES))
def q_stream_enrich(spark, sf):
    """Stream-static enrichment: streamed transactions meet the dimensions, which
    are landed once; every batch publishes its messages and appends its failures
    to the dead-letter table, both under its batch id. The query reads back both."""
    from . import q_enrich as QE
    from ..operators import enrich as EN
    from .proxies import transactions
    run = ST.run_dir(spark, "enrich")
    tx = transactions(spark, sf).select("key", "ticker", "company_cik", "date")
    path = ST.land(tx, os.path.join(run, "in"))
    dims = []
    for build in (QE.cached_mcaps, QE.recent_mcaps, QE.cik_map, QE.exchange_fallback):
        at = os.path.join(run, build.__name__)
        build(spark, sf).write.option("compression", "zstd").parquet(at)
        dims.append(spark.read.parquet(at))
    topic, dead = os.path.join(run, "topic"), os.path.join(run, "dead")

    def sink(batch, batch_id):
        e = EN.enrich_exchange_sic(EN.enrich_market_cap(batch, dims[0], dims[1], cutoff=QE.CUTOFF),
                                   dims[2], dims[3])
        TP.to_message(e.select("key", "company_cik", "exchange", "sic")).write.mode(
            "overwrite").option("compression", "gzip").json(
            os.path.join(topic, f"batch_id={batch_id}"))
        EN.dead_letters(e).write.mode("overwrite").option("compression", "zstd").parquet(
            os.path.join(dead, f"batch_id={batch_id}"))

    ST.drain(_stream(spark, path, tx.schema), sink, os.path.join(run, "ckpt"))
    sent, _ = TP.decode_json(spark.read.schema("key string, value string").json(topic),
                             "company_cik string, exchange string, sic string")
    none = F.lit(None).cast("string")
    return sent.select(F.lit("message").alias("kind"), "key", F.col("company_cik").alias("subject"),
                       "exchange", "sic").unionByName(
        ST.read_batches(spark, dead).select(
            "kind", none.alias("key"), F.coalesce("ticker", "cik").alias("subject"),
            none.alias("exchange"), none.alias("sic")))


@register("stream_poll_interval", with_ctes(
    "select cik, form_type, date, file_path from ix where form_type = '4'",
    ix=INDEX_SQL))
def q_stream_poll_interval(spark, sf):
    """Live polling of landed index quarters: a processing-time trigger every
    second, stopped when every landed file has gone through the sink."""
    from ..sources import master_index as MI
    from .index_docs import index_lines
    run = ST.run_dir(spark, "poll")
    lines = index_lines(spark, sf)
    path = os.path.join(run, "in")
    # rows are dealt over the tasks by content: a quarter spans several files
    lines.repartition("value").write.mode("overwrite").partitionBy("year", "quarter").parquet(path)
    n_files = ST.files_per_batch(spark, path, 1)
    per_poll = ST.files_per_batch(spark, path, 3)
    polls = -(-n_files // per_poll)  # every landed file is consumed by some poll
    stream = _stream(spark, path, lines.schema, batch_files=per_poll)
    rows = MI.filter_form_type(MI.parse_index_lines(stream), "4")
    out = os.path.join(run, "out")
    ST.run_live(rows.select("cik", "form_type", "date", "file_path"), ST.batch_sink(out),
                os.path.join(run, "ckpt"), interval="1 second", iterations=polls, timeout_s=300)
    return ST.read_batches(spark, out).drop("batch_id")
