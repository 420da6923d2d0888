"""Registered queries: filing text, XML parse / explode and flag functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import form4 as X
from ..functions import scalars as S
from .filing_docs import HOLDINGS_SQL, PARSED_SQL, filing_texts, holdings_reports, \
    landed_filing_texts
from . import q_target
from .proxies import with_ctes
from .registry import register

_P = dict(parsed=PARSED_SQL)
_COLS = ", ".join(X.PARSED_COLUMNS)


def _docs(spark, sf):
    return X.parse_filings(landed_filing_texts(spark, sf))


@register("regex_embedded_xml", """
select concat('edgar/data/', o_custkey::varchar, '/', o_orderkey::varchar, '.txt') as file_path,
       case when has then lpad(o_custkey::varchar, 10, '0') else '' end as issuer_cik,
       case when has then concat('OWNER ', o_custkey::varchar) else '' end as owner_name, has as whole
from (select *, not (o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED') as has from orders)
""")
def q_regex_embedded_xml(spark, sf):
    """The embedded document cut out of each text: what it says of issuer and
    owner, and whether it is there from its first to its last tag."""
    t = X.with_xml(landed_filing_texts(spark, sf), raw="raw", keep=["file_path"])
    xml = F.coalesce("__xml", F.lit(""))
    return t.select("file_path",
                    F.regexp_extract(xml, "<issuerCik>(.*?)</issuerCik>", 1).alias("issuer_cik"),
                    F.regexp_extract(xml, "<rptOwnerName>(.*?)</rptOwnerName>", 1).alias("owner_name"),
                    xml.rlike(r"(?s)^\s*<(\?xml|ownershipDocument).*</ownershipDocument>\s*$")
                    .alias("whole"))


@register("form4_parse", """
select concat('https://www.sec.gov/Archives/edgar/data/', o_custkey::varchar, '/',
              o_orderkey::varchar, '.txt') as link,
       lpad(o_custkey::varchar, 10, '0') as company_cik, concat('c', o_custkey::varchar) as ticker,
       lpad((o_custkey + 1000000)::varchar, 10, '0') as insider_cik, 2::integer as n_owners,
       case when o_orderpriority = '3-MEDIUM' then '1' else '0' end as plan_flag,
       (count(*) filter (where l_linestatus <> 'O'))::integer as n_plain,
       (count(*) filter (where l_linestatus = 'O'))::integer as n_derivative
from orders left join lineitem on o_orderkey = l_orderkey
where not (o_orderstatus = 'P' and o_orderpriority in ('4-NOT SPECIFIED', '5-LOW'))
group by o_custkey, o_orderkey, o_orderpriority""")
def q_form4_parse(spark, sf):
    """Typed documents recovered from the filing texts (malformed / missing XML
    dropped): issuer, owners, plan flag and the number of transactions."""
    owner = F.col("doc.reportingOwner")[0]["reportingOwnerId"]["rptOwnerCik"]

    def n(c):
        return F.coalesce(F.size(F.coalesce(F.col(c), F.array())), F.lit(0))

    d = _docs(spark, sf).select(
        "link", F.col("doc.issuer.issuerCik").alias("company_cik"),
        F.col("doc.issuer.issuerTradingSymbol").alias("ticker"), owner.alias("insider_cik"),
        F.size("doc.reportingOwner").alias("n_owners"), F.col("doc.aff10b5One").alias("plan_flag"),
        n("doc.nonDerivativeTable.nonDerivativeTransaction").alias("n_plain"),
        n("doc.derivativeTable.derivativeTransaction").alias("n_derivative"),
        F.posexplode(F.when(F.col("doc").isNotNull(), F.array(F.lit(1)))).alias("_p", "_one"))
    return d.drop("_p", "_one")


@register("form4_explode", with_ctes(f"select {_COLS} from parsed", **_P))
def q_form4_explode(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select(*X.PARSED_COLUMNS)


@register("xml_attribute", with_ctes(
    "select link, shares, footnote_id from parsed",
    **_P))
def q_xml_attribute(spark, sf):
    docs = _docs(spark, sf)
    rows = docs.select("link", F.explode(F.concat(
        F.coalesce(F.col("doc.nonDerivativeTable.nonDerivativeTransaction"), F.array()),
        F.coalesce(F.col("doc.derivativeTable.derivativeTransaction"), F.array()))).alias("tx"))
    return rows.select("link", F.col("tx.transactionAmounts.transactionShares.value").alias("shares"),
                       F.col("tx.transactionAmounts.transactionShares.footnoteId")[0]["_id"]
                       .alias("footnote_id"))


@register("rule_10b5_1", with_ctes(
    "select link, shares, derivative, rule105b1 from parsed", **_P))
def q_rule_10b5_1(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select("link", "shares", "derivative",
                                                           "rule105b1")


@register("sum_holdings_by_ownership", with_ctes(
    "select link, shares, derivative, direct_holding, indirect_holding from parsed", **_P))
def q_sum_holdings(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select(
        "link", "shares", "derivative", "direct_holding", "indirect_holding")


@register("coalesce_tx_branches", with_ctes(
    "select link, derivative, shares, remaining_shares, date, equity_swap from parsed", **_P))
def q_coalesce_tx_branches(spark, sf):
    """The values that both branches fill, row by row: plain and derivative transactions
    name them alike after the explode."""
    return X.explode_transactions(_docs(spark, sf)).select(
        "link", "derivative", "shares", "remaining_shares", "date", "equity_swap")


@register("is_derivative", with_ctes(
    "select link, shares, remaining_shares, derivative from parsed", **_P))
def q_is_derivative(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select("link", "shares", "remaining_shares",
                                                           "derivative")


@register("owner_code_bits", with_ctes(
    "select link, shares, derivative, owner_code from parsed", **_P))
def q_owner_code_bits(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select("link", "shares", "derivative",
                                                           "owner_code")


@register("truthy_flag", with_ctes(
    "select link, shares, derivative, equity_swap from parsed", **_P))
def q_truthy_flag(spark, sf):
    return X.explode_transactions(_docs(spark, sf)).select("link", "shares", "derivative",
                                                           "equity_swap")


@register("strip_prefix", """
select distinct regexp_replace(concat('/Archives/edgar/data/', o_custkey::varchar, '/',
       o_orderkey::varchar, '.txt'), '^/Archives/', '') as path,
       concat('https://www.sec.gov/Archives/', path) as url
from orders""")
def q_strip_prefix(spark, sf):
    from ..sources.tables import read_table
    o = read_table(spark, sf, "orders")
    href = F.concat(F.lit("/Archives/edgar/data/"), F.col("o_custkey").cast("string"), F.lit("/"),
                    F.col("o_orderkey").cast("string"), F.lit(".txt"))
    p = o.select(S.strip_prefix(href).alias("path")).distinct()
    return p.withColumn("url", S.add_base_url("path", X.ARCHIVE_BASE))


# what decides between rows of one key, after the date
_SURVIVOR = ("shares", "price", "coding", "acquired_disposed", "ownership", "rule105b1", "equity_swap")
_INGEST_SQL = with_ctes(
    "select * exclude (rn) from (select *, row_number() over (partition by key order by date desc, "
    + ", ".join(f"{c} desc" for c in _SURVIVOR) + ") as rn from (select company_cik, "
    "upper(trim(ticker)) as ticker, insider_cik, insider_name, owner_code, rule105b1, derivative, "
    "link, trunc(shares::double)::integer as shares, acquired_disposed, price::double as price, "
    "date::date as date, (remaining_shares::double)::integer as remaining_shares, ownership, coding, "
    "direct_holding::bigint as direct_holding, indirect_holding::bigint as indirect_holding, "
    "equity_swap, epoch_ms(date::date::timestamp) as timestamp, sha256(concat(link, remaining_shares, "
    "case when derivative then '1' else '0' end)) as key from parsed "
    "where o_orderpriority in ('1-URGENT', '2-HIGH') and acquired_disposed is not null "
    "and coding is not null)) where rn = 1", **_P)
_BARS_SQL = ("select concat('C', o_custkey::varchar) as ticker, l_shipdate::date as date, "
             "max(l_extendedprice) as close from lineitem join orders on o_orderkey = l_orderkey "
             "group by 1, 2")


def ingested(spark, sf):
    """index -> form-4 filter -> filing text -> parse -> explode -> key and
    timestamp -> cleaning and typing -> upsert into the stored table, read back."""
    import uuid

    from ..operators import clean as C
    from ..session import partitions_for, scratch_path, stored
    from ..sources import master_index as MI
    from ..sources.catalog import FeatureStore, load_catalog
    from ..sources.tables import read_table
    from .index_docs import index_lines
    from .target import TARGET_CATALOG
    lines = read_table(spark, sf, "lineitem").count()
    index = MI.filter_form_type(MI.parse_index_lines(index_lines(spark, sf)), "4")
    # the paths are hashed and the texts stream past them: a sort would hold and spill the texts
    texts = landed_filing_texts(spark, sf).join(index.select("file_path").hint("shuffle_hash"),
                                                "file_path", "left_semi")
    # parsed once and stored, as the topic between parser and store writer holds it:
    # the cleaning filters would otherwise be pushed into the parse and repeat it
    with partitions_for(spark, lines):
        tx = stored(X.with_message_fields(X.explode_transactions(X.parse_filings(texts))))
    typed = C.clean_transactions(tx, dedup=False)
    # The composite key is not unique inside a filing (two nodes with the same
    # link, remaining shares and branch): the upsert keeps one of them, the
    # latest date, then the larger shares, price and so on, so the survivor is
    # deterministic. Exact duplicates share their key and go with it, in the same shuffle.
    store = FeatureStore(spark, scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}"),
                         load_catalog({"bt4": {**TARGET_CATALOG["bt4"], "order": _SURVIVOR}}, 1))
    store.upsert("bt4", typed, landed=True)     # a projection of the stored rows
    return store.read("bt4")


@register("ingest_filings", _INGEST_SQL)
def q_ingest_filings(spark, sf):
    """Filings to the stored transaction table, with all its columns."""
    return ingested(spark, sf)


def _filing_bars(spark, sf):
    """Daily bars of the filings' tickers, from the line items behind them."""
    from ..sources.tables import read_table
    li, o = read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice").groupBy(
        "ticker", "date").agg(F.max("l_extendedprice").alias("close"))


@register("ingest_to_target", q_target.target_sql(_INGEST_SQL, _BARS_SQL))
def q_ingest_to_target(spark, sf):
    """The stored output of the ingest fed to the forward-return target."""
    from . import target as TG
    return TG.build_training_target(ingested(spark, sf), _filing_bars(spark, sf),
                                    period=q_target.PERIOD, direction="R")


@register("thirteen_f_fields", HOLDINGS_SQL)
def q_thirteen_f_fields(spark, sf):
    """Holdings reports (namespaced XML) -> one row per information-table entry."""
    return X.holdings_report_rows(holdings_reports(spark, sf))


@register("src_filing_text", """
select concat('edgar/data/', o_custkey::varchar, '/', o_orderkey::varchar, '.txt') as file_path,
       not (o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED') as has_xml
from orders""")
def q_src_filing_text(spark, sf):
    """Filing texts landed as packed records in the shared folder, read back
    as one row per filing (path + whole text)."""
    import uuid

    from ..session import scratch_path
    from ..sources.filings import pack_filings, read_filing_records
    path = scratch_path(spark, f"filings-{uuid.uuid4().hex[:12]}")
    pack_filings(filing_texts(spark, sf), path)
    t = X.with_xml(read_filing_records(spark, path), raw="raw", keep=["file_path"])
    return t.select("file_path", (F.coalesce(F.col("__xml"), F.lit("")) != "").alias("has_xml"))
