"""The explode repeats no work of a filing for its transactions, and parses no text twice."""

from pyspark.sql import functions as F

from tradelens.functions import form4 as X

TX = ("<{0}><transactionAmounts><transactionShares>{1}</transactionShares></transactionAmounts>"
      "</{0}>")
HOLDING = ("<{0}><postTransactionAmounts><sharesOwnedFollowingTransaction><value>{1}</value>"
           "</sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature>"
           "<directOrIndirectOwnership><value>{2}</value></directOrIndirectOwnership>"
           "</ownershipNature></{0}>")


def _docs(spark, *bodies):
    rows = [(f"{i}.txt", f'<XML>\n<?xml version="1.0"?>\n<d><issuer><issuerCik>{i}</issuerCik>'
                         f"</issuer>{b}</d>\n</XML>") for i, b in enumerate(bodies)]
    return X.parse_filings(spark.createDataFrame(rows, "file_path string, raw string"))


def test_filing_values_are_computed_below_the_explode(spark):
    rows = X.explode_transactions(_docs(spark, "")).select(*X.PARSED_COLUMNS)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    for work in ("aggregate(", "filter(", "exists(", "isDirector"):
        assert work not in above
    assert "aggregate(" in below and "isDirector" in below
    assert plan.count("from_xml(") == 1


def test_rows_of_both_tables(spark):
    plain, other = "nonDerivativeTransaction", "derivativeTransaction"
    body = ("<nonDerivativeTable>" + TX.format(plain, '<value>1</value><footnoteId id="A"/>')
            + TX.format(plain, '<footnoteId id="A"/>') + TX.format(plain, "<value>3</value>")
            + HOLDING.format("nonDerivativeHolding", "4", "D")
            + HOLDING.format("nonDerivativeHolding", "n/a", "I")
            + HOLDING.format("nonDerivativeHolding", "5", "I") + "</nonDerivativeTable>"
            "<derivativeTable>" + TX.format(other, '<value>6</value><footnoteId id="B"/>')
            + TX.format(other, '<footnoteId id="A"/>')
            + HOLDING.format("derivativeHolding", "7", "D") + "</derivativeTable>"
            '<footnotes><footnote id="A">a 10b5-1 plan</footnote><footnote id="B">none</footnote>'
            "<footnote>10b5-1</footnote></footnotes>")
    lone = "<derivativeTable>" + TX.format(other, "<value>8</value>") + "</derivativeTable>"
    got = X.explode_transactions(_docs(spark, body, "", lone, "<nonDerivativeTable></nonDerivativeTable>"),
                                 with_ordinal=True)
    rows = got.select("company_cik", "node_ordinal", "shares", "derivative", "rule105b1",
                      "direct_holding", "indirect_holding").collect()
    assert sorted(map(tuple, rows)) == [
        ("0", 0, "1", False, True, 4.0, 5.0), ("0", 1, None, True, False, 0.0, 0.0),
        ("0", 2, "3", False, False, 4.0, 5.0), ("0", 3, "6", True, False, 0.0, 0.0),
        ("0", 4, None, True, True, 0.0, 0.0), ("2", 0, "8", True, False, 0.0, 0.0)]


def test_cut_is_the_first_match_of_the_pattern(spark):
    doc = '<?xml version="1.0"?><d>é</d>'
    texts = [f"a<XML>\n \t{doc}\n</XML>b", f"<XML>x</XML><XML>{doc}</XML>", f"<XML><XML>{doc}</XML></XML>",
             f"</XML><XML>{doc}</XML>", f"<XML>{doc}", f"{doc}</XML>", "", "<XML></XML>", "<XML>", "</XML>",
             f"<XML>{doc}</XML><XML>{doc}{doc}</XML>", None]
    t = spark.createDataFrame([(x,) for x in texts], "raw string")
    got = X.with_xml(t, raw="raw", keep=["raw"]).select(
        F.coalesce("__xml", F.lit("")).alias("got"),
        F.coalesce(F.regexp_extract("raw", X.XML_BLOCK, 1), F.lit("")).alias("want")).collect()
    assert [r.got for r in got] == [r.want for r in got]
