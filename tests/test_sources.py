"""Sources, filings, keyed tables, topics and streaming on inline fixtures."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tradelens.functions import form4 as X
from tradelens.sources import master_index as MI
from tradelens.sources import topics as TP
from tradelens.sources.catalog import FeatureStore, load_catalog
from tradelens.sources.prices import new_bars, read_bars_csv

FILING = """SEC-HEADER text
<XML>
<?xml version="1.0"?>
<ownershipDocument>
  <issuer><issuerCik>0000001</issuerCik><issuerTradingSymbol> aaa </issuerTradingSymbol></issuer>
  <reportingOwner>
    <reportingOwnerId><rptOwnerCik>0000009</rptOwnerCik><rptOwnerName>DOE J</rptOwnerName></reportingOwnerId>
    <reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>true</isOfficer></reportingOwnerRelationship>
  </reportingOwner>
  <aff10b5One>0</aff10b5One>
  <nonDerivativeTable>
    <nonDerivativeTransaction>
      <transactionDate><value>2024-01-02</value></transactionDate>
      <transactionCoding><transactionCode>S</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>
      <transactionAmounts>
        <transactionShares><value>10.5</value><footnoteId id="F1"/></transactionShares>
        <transactionPricePerShare><value>20</value></transactionPricePerShare>
        <transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode>
      </transactionAmounts>
      <postTransactionAmounts><sharesOwnedFollowingTransaction><value>90</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
      <ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature>
    </nonDerivativeTransaction>
    <nonDerivativeHolding>
      <postTransactionAmounts><sharesOwnedFollowingTransaction><value>5</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
      <ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature>
    </nonDerivativeHolding>
    <nonDerivativeHolding>
      <postTransactionAmounts><sharesOwnedFollowingTransaction><value>7</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
      <ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership></ownershipNature>
    </nonDerivativeHolding>
  </nonDerivativeTable>
  <footnotes><footnote id="F1">Sold under a 10b5-1 plan</footnote></footnotes>
</ownershipDocument>
</XML>
"""


def _parse(spark, texts):
    df = spark.createDataFrame([(f"p{i}.txt", t) for i, t in enumerate(texts)],
                               "file_path string, raw string")
    return X.explode_transactions(X.parse_filings(df)).collect()


def test_form4_inline_fixture(spark):
    rows = _parse(spark, [FILING])
    assert len(rows) == 1
    r = rows[0]
    assert (r.ticker, r.owner_code, r.rule105b1, r.derivative, r.shares, r.price,
            r.remaining_shares, r.direct_holding, r.indirect_holding, r.equity_swap,
            r.acquired_disposed) == ("aaa", "1100", True, False, "10.5", "20", "90", 5.0, 7.0,
                                     False, "D")


def test_form4_bad_documents_give_no_rows(spark):
    no_xml = FILING.replace("<XML>", "").replace("</XML>", "")
    malformed = FILING.replace("</issuer>", "")
    assert _parse(spark, [no_xml, malformed]) == []


def test_form4_derivative_only_and_two_owners(spark):
    deriv = (FILING.replace("nonDerivativeTransaction", "derivativeTransaction")
                   .replace("<nonDerivativeTable>", "<derivativeTable>")
                   .replace("</nonDerivativeTable>", "</derivativeTable>")
                   .replace("nonDerivativeHolding", "derivativeHolding"))
    two = FILING.replace("</reportingOwner>", "</reportingOwner><reportingOwner><reportingOwnerId>"
                         "<rptOwnerCik>2</rptOwnerCik><rptOwnerName>X</rptOwnerName>"
                         "</reportingOwnerId></reportingOwner>", 1)
    rows = _parse(spark, [deriv, two])
    assert sorted(r.derivative for r in rows) == [False, True]
    assert all(r.insider_name == "DOE J" for r in rows)
    d = [r for r in rows if r.derivative][0]
    assert d.equity_swap is False and d.direct_holding == 5.0


def test_rule_10b5_1_cases(spark):
    def flag(doc):
        return _parse(spark, [doc])[0].rule105b1
    assert flag(FILING.replace("<aff10b5One>0", "<aff10b5One>1")
                .replace("10b5-1 plan", "plan")) is True
    assert flag(FILING.replace('footnote id="F1"', 'footnote id="F9"')) is False
    assert flag(FILING.replace("Sold under a 10b5-1 plan", "")) is False
    assert flag(FILING.replace("<footnotes><footnote id=\"F1\">Sold under a 10b5-1 plan</footnote>"
                               "</footnotes>", "")) is False


def test_holdings_only_direct(spark):
    doc = FILING.replace("<value>I</value></directOrIndirectOwnership></ownershipNature>\n"
                         "    </nonDerivativeHolding>",
                         "<value>D</value></directOrIndirectOwnership></ownershipNature>\n"
                         "    </nonDerivativeHolding>")
    r = _parse(spark, [doc])[0]
    assert (r.direct_holding, r.indirect_holding) == (0.0, 0.0)


def test_filing_text_reader(spark, tmp):
    for i in range(2):
        with open(os.path.join(tmp, f"f{i}.txt"), "w") as fh:
            fh.write(FILING)
    df = spark.read.text(tmp, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("raw"))
    assert len(X.explode_transactions(X.parse_filings(df)).collect()) == 2


def test_master_index(spark, tmp):
    text = ("Description: Master Index\nCIK|Company Name|Form Type|Date Filed|Filename\n"
            + "-" * 80 + "\n1000045|ACME CORP|4|2024-01-03|edgar/data/1000045/a.txt\n"
            "1000046|BETA INC|10-K|2024-01-04|edgar/data/1000046/b.txt\n")
    d = os.path.join(tmp, "year=2024", "quarter=1")
    os.makedirs(d)
    with open(os.path.join(d, "master.idx"), "w") as fh:
        fh.write(text)
    ix = MI.read_master_index(spark, tmp)
    assert ix.count() == 2
    assert [r.cik for r in MI.filter_form_type(ix, "4").collect()] == ["1000045"]
    assert MI.index_current_quarter(ix, now="2024-02-10").count() == 1


def test_catalog_defaults():
    cat = load_catalog({"bi4": {"primary_key": ["key"], "event_time": "date"},
                        "custom": {"name": "override_name", "primary_key": ["id"],
                                   "event_time": "ts"}}, 3)
    assert cat["bi4"].name == "bi4" and cat["custom"].name == "override_name"
    assert cat["bi4"].version == 3 and cat["custom"].primary_key == ("id",)


def test_feature_store_upsert(spark, tmp):
    cat = load_catalog({"t": {"primary_key": ["k"], "event_time": "d"}}, 1)
    fs = FeatureStore(spark, tmp, cat)
    schema = "k string, d date, v int"
    empty = fs.read_or_empty("t", schema)
    assert empty.count() == 0 and empty.columns == ["k", "d", "v"]
    assert fs.upsert("t", spark.createDataFrame([], schema)) is None
    b1 = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 1), 2)], schema)
    fs.upsert("t", b1)
    fs.upsert("t", b1)
    assert sorted((r.k, r.v) for r in fs.read("t").collect()) == [("a", 1), ("b", 2)]
    fs.upsert("t", spark.createDataFrame([("a", dt.date(2024, 1, 2), 9),
                                          ("b", dt.date(2023, 1, 1), 0)], schema))
    # the last batch overwrites, also with an older event time
    assert sorted((r.k, r.v) for r in fs.read("t").collect()) == [("a", 9), ("b", 0)]
    assert [r.k for r in fs.read("t", where=lambda t: t["v"] > 5).collect()] == ["a"]


def test_price_refresh(spark):
    schema = "ticker string, date date, close double"
    stored = spark.createDataFrame([("AAA", dt.date(2024, 1, 2), 1.0)], schema)
    bars = spark.createDataFrame([("AAA", dt.date(2024, 1, 1), 1.0), ("AAA", dt.date(2024, 1, 3), 2.0),
                                  ("NEW", dt.date(2024, 1, 1), 3.0)], schema)
    got = sorted((r.ticker, r.date) for r in new_bars(bars, stored).collect())
    assert got == [("AAA", dt.date(2024, 1, 3)), ("NEW", dt.date(2024, 1, 1))]
    assert new_bars(stored, stored).count() == 0


def test_bars_csv_skips_bad_rows(spark, tmp):
    p = os.path.join(tmp, "bars.csv")
    with open(p, "w") as fh:
        fh.write("ticker,date,close\naapl,2024-01-01,10.0\nBAD,notadate,x\nmsft,2024-01-02,11.0\n")
    got = sorted((r.ticker, r.close) for r in read_bars_csv(spark, p).collect())
    assert got == [("AAPL", 10.0), ("MSFT", 11.0)]


def test_json_decode_skip_bad(spark):
    df = spark.createDataFrame([("1", '{"k":1}'), ("2", "{bad")], "id string, value string")
    good, bad = TP.decode_json(df, "k bigint")
    assert [(r.id, r.k) for r in good.collect()] == [("1", 1)]
    assert [r.id for r in bad.collect()] == ["2"]


def test_message_roundtrip(spark):
    df = spark.createDataFrame([("k1", 1, 111), ("k2", 2, 222)], "key string, a int, timestamp long")
    m = TP.to_message(df, key="key")
    back = m.select("key", F.from_json("value", "a int, timestamp long").alias("v")).select(
        "key", "v.a", "v.timestamp")
    assert sorted(map(tuple, back.collect())) == [("k1", 1, 111), ("k2", 2, 222)]


HOLDINGS_REPORT = """<?xml version="1.0"?>
<informationTable xmlns="http://www.sec.gov/edgar/document/thirteenf/informationtable">
  <infoTable><nameOfIssuer>ACME CORP</nameOfIssuer><titleOfClass>COM</titleOfClass>
    <cusip>000000001</cusip><shrsOrPrnAmt><sshPrnamt>1200</sshPrnamt></shrsOrPrnAmt></infoTable>
  <infoTable><nameOfIssuer>BETA INC</nameOfIssuer><titleOfClass>CL A</titleOfClass>
    <cusip>000000002</cusip><shrsOrPrnAmt><sshPrnamt>n/a</sshPrnamt></shrsOrPrnAmt></infoTable>
</informationTable>"""


def test_thirteen_f_fields(spark):
    df = spark.createDataFrame([("r1", HOLDINGS_REPORT)], "report string, xml string")
    rows = X.holdings_report_rows(df).collect()
    assert [(r.issuer_name, r.issuer_cusip, r.title_class, r.shares) for r in rows] == [
        ("ACME CORP", "000000001", "COM", 1200), ("BETA INC", "000000002", "CL A", None)]


def test_dimension_files(spark, tmp):
    from tradelens.sources.dimensions import read_cik_map, read_market_caps, read_scoring_csv
    p = os.path.join(tmp, "map.json")
    with open(p, "w") as fh:
        fh.write('{\n "exchange": {"1": "NMS", "2": "NYQ"},\n "sic": {"1": "3571"}\n}\n')
    got = sorted((r.cik, r.exchange, r.sic) for r in read_cik_map(spark, p).collect())
    assert got == [("1", "NMS", "3571"), ("2", "NYQ", None)]
    mc = os.path.join(tmp, "mcaps")
    spark.createDataFrame([(" aapl", dt.date(2024, 6, 3), 123)], "ticker string, fbd date, market_cap int") \
        .write.parquet(mc)
    r = read_market_caps(spark, mc).collect()[0]
    assert (r.ticker, r.market_cap) == ("AAPL", 123)
    csv = os.path.join(tmp, "score.csv")
    with open(csv, "w") as fh:
        fh.write("key,ticker,price\nk1,AAA,1.5\nk2,BBB,2.5\n")
    rows = read_scoring_csv(spark, csv, "key string, ticker string, price double").collect()
    assert [r.price for r in rows] == [1.5, 2.5]


def test_live_polling_stream(spark, tmp):
    from tradelens.streaming import streams as ST
    src = os.path.join(tmp, "in")
    for i in range(2):
        spark.createDataFrame([(i, f"v{i}")], "id int, v string").write.mode("append").parquet(src)
    out = os.path.join(tmp, "out")
    stream = TP.read_topic_stream(spark, path=src, schema=spark.read.parquet(src).schema,
                                  batch_size=1)
    ST.run_live(stream, ST.batch_sink(out), os.path.join(tmp, "ckpt"), interval="1 second",
                iterations=2, timeout_s=60)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1]


def test_upsert_rewrites_only_touched_buckets(spark, tmp):
    cat = load_catalog({"t": {"primary_key": ["k"], "event_time": "d", "buckets": 8}}, 1)
    fs = FeatureStore(spark, tmp, cat)
    schema = "k string, d date, v int"
    rows = [(f"k{i}", dt.date(2024, 1, 1), i) for i in range(40)]
    fs.upsert("t", spark.createDataFrame(rows, schema))
    data = os.path.join(tmp, "t_v1", "data")

    def files():
        return {os.path.join(dp, f) for dp, _, fns in os.walk(data) for f in fns
                if f.endswith(".parquet")}
    before = files()
    fs.upsert("t", spark.createDataFrame([("k3", dt.date(2024, 1, 2), 99)], schema))
    after = files()
    changed = {os.path.basename(os.path.dirname(f)) for f in after ^ before}
    assert len(changed) == 1  # one bucket directory replaced, the rest untouched
    got = {r.k: r.v for r in fs.read("t").collect()}
    assert len(got) == 40 and got["k3"] == 99


def test_drained_stream_resumes_from_checkpoint(spark, tmp):
    from tradelens.streaming import streams as ST
    src, out, ckpt = (os.path.join(tmp, x) for x in ("in", "out", "ckpt"))
    schema = "id int, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.mode("append").parquet(src)
    stream = lambda: TP.read_topic_stream(spark, path=src, schema=spark.read.parquet(src).schema,
                                          batch_size=1)
    ST.drain(stream(), ST.batch_sink(out), ckpt)
    ST.drain(stream(), ST.batch_sink(out), ckpt)  # nothing new: no batch, no duplicates
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(src)
    ST.drain(stream(), ST.batch_sink(out), ckpt)  # only the new file is read
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_target_services_through_the_store(spark, tmp):
    from tradelens.plans.proxies import price_bars, transactions
    from tradelens.plans.target import TARGET_CATALOG, run_inference, run_training
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    fs = FeatureStore(spark, tmp, load_catalog(TARGET_CATALOG, 1))
    tx = transactions(spark, sf)
    fs.upsert("bt4", tx.where(F.col("acquired_disposed") == "R"))
    fs.upsert("bi4", tx.where(F.col("acquired_disposed") == "A"))
    fs.upsert("p", price_bars(spark, sf))
    assert run_training(fs, direction="R") == 0
    assert run_inference(fs, direction="A") == 0
    rt4 = fs.read("rt4")
    assert rt4.count() > 0 and rt4.where(F.col("avg_target_expanding").isNull()).count() == 0
    assert fs.read("bir4").where(F.col("avg_target_expanding").isNull()).count() == 0


def test_index_quarter_selection_prunes_partitions(spark, tmp):
    for y, q in ((2023, 4), (2024, 1)):
        d = os.path.join(tmp, f"year={y}", f"quarter={q}")
        os.makedirs(d)
        with open(os.path.join(d, "master.idx"), "w") as fh:
            fh.write(f"1|A|4|{y}-01-03|edgar/data/1/{y}.txt\n")
    sel = MI.index_backfill(MI.read_master_index(spark, tmp), now_year=2024, years=0)
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [r.date for r in sel.collect()] == ["2024-01-03"]
