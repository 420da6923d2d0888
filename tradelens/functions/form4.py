"""Insider-filing XML: extraction, typed parse and one row per transaction.

The filing text carries one embedded XML document. It is parsed on the
executors with the built-in ``from_xml`` against an explicit schema (no
inference pass over the data); repeated nodes are arrays and are exploded, the
per-filing computations (owner-code bits, footnote lookup, holdings sums) are
higher-order array expressions. A filing without an XML block or with
malformed XML parses to a null document and yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scalars as S

# The pattern that isolates the embedded XML document of a
# filing (dot matches newline, first hit), the archive base URL, the marker of
# a 10b5-1 trading plan inside footnotes.
XML_BLOCK = r"(?s)<XML>\s*(<\?xml[^>]+?>.*?)</XML>"
ARCHIVE_BASE = "https://www.sec.gov/Archives/"
PLAN_MARKER = "10b5-1"

_V = T.StructType([T.StructField("value", T.StringType())])
_FOOTREF = T.ArrayType(T.StructType([T.StructField("_id", T.StringType())]))
_POST = T.StructType([T.StructField("sharesOwnedFollowingTransaction", _V)])
_NATURE = T.StructType([T.StructField("directOrIndirectOwnership", _V)])

TX = T.StructType([
    T.StructField("transactionDate", _V),
    T.StructField("transactionCoding", T.StructType([
        T.StructField("transactionCode", T.StringType()),
        T.StructField("equitySwapInvolved", T.StringType())])),
    T.StructField("transactionAmounts", T.StructType([
        T.StructField("transactionShares", T.StructType([
            T.StructField("value", T.StringType()),
            T.StructField("footnoteId", _FOOTREF)])),
        T.StructField("transactionPricePerShare", _V),
        T.StructField("transactionAcquiredDisposedCode", _V)])),
    T.StructField("postTransactionAmounts", _POST),
    T.StructField("ownershipNature", _NATURE),
])
HOLDING = T.StructType([T.StructField("postTransactionAmounts", _POST),
                        T.StructField("ownershipNature", _NATURE)])

FORM4_SCHEMA = T.StructType([
    T.StructField("issuer", T.StructType([
        T.StructField("issuerCik", T.StringType()),
        T.StructField("issuerTradingSymbol", T.StringType())])),
    T.StructField("reportingOwner", T.ArrayType(T.StructType([
        T.StructField("reportingOwnerId", T.StructType([
            T.StructField("rptOwnerCik", T.StringType()),
            T.StructField("rptOwnerName", T.StringType())])),
        T.StructField("reportingOwnerRelationship", T.StructType([
            T.StructField("isDirector", T.StringType()),
            T.StructField("isOfficer", T.StringType()),
            T.StructField("isTenPercentOwner", T.StringType()),
            T.StructField("isOther", T.StringType())]))]))),
    T.StructField("aff10b5One", T.StringType()),
    T.StructField("nonDerivativeTable", T.StructType([
        T.StructField("nonDerivativeTransaction", T.ArrayType(TX)),
        T.StructField("nonDerivativeHolding", T.ArrayType(HOLDING))])),
    T.StructField("derivativeTable", T.StructType([
        T.StructField("derivativeTransaction", T.ArrayType(TX)),
        T.StructField("derivativeHolding", T.ArrayType(HOLDING))])),
    T.StructField("footnotes", T.StructType([
        T.StructField("footnote", T.ArrayType(T.StructType([
            T.StructField("_VALUE", T.StringType()),
            T.StructField("_id", T.StringType())])))])),
])

PARSED_COLUMNS = ("company_cik", "ticker", "insider_cik", "insider_name", "owner_code",
                  "rule105b1", "derivative", "link", "shares", "acquired_disposed", "price",
                  "date", "remaining_shares", "ownership", "coding", "direct_holding",
                  "indirect_holding", "equity_swap")


def _xml_cut(r: Column) -> Column:
    """Text between the first ``</XML>`` and the ``<XML>`` before it, left-trimmed. ``split``
    skips ahead for its literal, where ``substring_index`` compares at every byte."""
    before = F.split(r, "</XML>", 2)[0]
    return F.ltrim(F.element_at(F.split(before, "<XML>"), -1), F.lit(" \t\n\r\f\u000b"))


def _xml_pick(r: Column, body: Column) -> Column:
    """``body`` when it is a document (declaration first), else the regex.

    Each expensive input appears once, so subexpression elimination can not
    hoist the regex out of its branch: it only runs when the cut fails. An
    empty regex result parses to an all-null struct and is dropped later.
    """
    has_tags = F.contains(r, F.lit("<XML>")) & F.contains(r, F.lit("</XML>"))
    # "<?xml" + at least one character that is not '>' + a closing '>'
    declared = (body.startswith("<?xml") & (F.substring(body, 6, 1) != ">")
                & (F.instr(body, ">") > 6))
    return F.when(has_tags & declared, body).when(has_tags, F.regexp_extract(r, XML_BLOCK, 1))


def embedded_xml(raw: Column | str) -> Column:
    """The XML document inside a filing ('' or NULL when there is none).

    Same result as ``XML_BLOCK``'s first match. The common case (one block)
    is cut out with literal searches, several times faster
    than the lazy regex on multi-kilobyte texts; the regex only runs when the
    cut does not yield a document although the text holds both tags. Prefer
    ``with_xml`` on DataFrames: it computes the cut once.
    """
    r = F.col(raw) if isinstance(raw, str) else raw
    return _xml_pick(r, _xml_cut(r))


def with_xml(filings: DataFrame, *, raw: str, keep: list) -> DataFrame:
    """``keep`` columns + ``__xml`` (the embedded document, '' / NULL when
    absent), the cut text computed once in its own projection."""
    s1 = filings.select(*keep, F.col(raw).alias("__raw"))
    base = [c for c in s1.columns if c != "__raw"]
    s2 = s1.select(*base, "__raw", _xml_cut(F.col("__raw")).alias("__body"))
    return s2.select(*base, _xml_pick(F.col("__raw"), F.col("__body")).alias("__xml"))


def with_documents(filings: DataFrame, *, raw: str, keep: list) -> DataFrame:
    """Adds ``doc`` (typed document or NULL) in staged projections: each
    expensive value (the cut text, the parsed struct) is computed in its own
    projection and referenced by column, so it is evaluated once per filing.
    Malformed XML parses to a struct of nulls (PERMISSIVE) and becomes NULL."""
    s3 = with_xml(filings, raw=raw, keep=keep)
    base = [c for c in s3.columns if c != "__xml"]
    s4 = s3.select(*base, F.from_xml(F.col("__xml"), FORM4_SCHEMA, {"mode": "PERMISSIVE"})
                   .alias("__doc"))
    return s4.select(*base, F.when(F.col("__doc.issuer").isNotNull(), F.col("__doc")).alias("doc"))


def parse_document(xml: Column) -> Column:
    """Typed document struct; malformed XML gives NULL (PERMISSIVE, no raise)."""
    doc = F.from_xml(xml, FORM4_SCHEMA, {"mode": "PERMISSIVE"})
    # a malformed document comes back as a struct of nulls: treat it as absent
    return F.when(doc["issuer"].isNotNull(), doc)


def holdings_totals(holdings: Column) -> tuple[Column, Column]:
    """(direct, indirect) sums of holding amounts; unparsable amounts skipped."""
    def total(code: str) -> Column:
        return F.aggregate(
            F.filter(F.coalesce(holdings, F.array()),
                     lambda h: h["ownershipNature"]["directOrIndirectOwnership"]["value"] == code),
            F.lit(0.0).cast("double"),
            lambda acc, h: acc + F.coalesce(
                h["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]["value"]
                .try_cast("double"), F.lit(0.0)))
    return total("D"), total("I")


def holdings_split(d: Column, i: Column) -> tuple[Column, Column]:
    """(direct, indirect) of the ``holdings_totals``: both are kept only when both are
    non-zero, else (0, 0)."""
    both = (d != 0) & (i != 0)
    return (F.when(both, d).otherwise(F.lit(0.0)), F.when(both, i).otherwise(F.lit(0.0)))


def plan_notes(footnotes: Column) -> Column:
    """Ids of the footnotes that mention the plan (an empty footnote does not)."""
    return F.transform(F.filter(F.coalesce(footnotes, F.array()),
                                lambda f: F.contains(f["_VALUE"], F.lit(PLAN_MARKER))),
                       lambda f: f["_id"])


def plan_flag(flag: Column, notes: Column, footnote_id: Column) -> Column:
    """10b5-1: the filing's flag, or the transaction's footnote is one of its ``plan_notes``
    (missing ids are simply false)."""
    return flag | F.coalesce(F.array_contains(notes, footnote_id), F.lit(False))


def parse_filings(filings: DataFrame, *, raw: str = "raw", path: str = "file_path",
                  base_url: str = ARCHIVE_BASE) -> DataFrame:
    """Filing text -> one typed document per filing; ``doc`` is NULL for a
    filing without a (well-formed) document. No filter here on purpose: a
    filter on ``doc`` would be pushed below the projection and parse every
    document twice; the explode drops null documents by itself."""
    return with_documents(filings, raw=raw,
                          keep=[S.add_base_url(path, base_url).alias("link")])


def explode_transactions(docs: DataFrame, *, with_ordinal: bool = False) -> DataFrame:
    """One row per non-derivative and per derivative transaction; filing-level
    fields repeated. Output columns follow the parsed-transaction contract
    (values still strings except flags and holdings)."""
    owner = F.col("doc.reportingOwner")[0]
    rel = owner["reportingOwnerRelationship"]
    common = {
        "company_cik": F.col("doc.issuer.issuerCik"),
        "ticker": F.col("doc.issuer.issuerTradingSymbol"),
        "insider_cik": owner["reportingOwnerId"]["rptOwnerCik"],
        "insider_name": owner["reportingOwnerId"]["rptOwnerName"],
        "owner_code": S.owner_code_bits(rel["isDirector"], rel["isOfficer"],
                                        rel["isTenPercentOwner"], rel["isOther"]),
        "link": F.col("link"),
    }
    nd_d, nd_i = holdings_totals(F.col("doc.nonDerivativeTable.nonDerivativeHolding"))
    dv_d, dv_i = holdings_totals(F.col("doc.derivativeTable.derivativeHolding"))

    def nodes(arr: str) -> Column:
        return F.coalesce(F.col(arr), F.array().cast(T.ArrayType(TX)))

    # What a filing says once is computed below the explode, where no transaction repeats it.
    # Both tables become one array, so the document is parsed once and exploded once; a node's
    # place in it tells its table. The explode is an outer one: of an inner one Spark infers a
    # filter on the array's size, which is pushed below the parse and parses again.
    plain = nodes("doc.nonDerivativeTable.nonDerivativeTransaction")
    once = docs.select(
        *[v.alias(k) for k, v in common.items()],
        S.truthy_flag(F.col("doc.aff10b5One")).alias("_aff"),
        plan_notes(F.col("doc.footnotes.footnote")).alias("_fn"),
        nd_d.alias("_ndd"), nd_i.alias("_ndi"), dv_d.alias("_dvd"), dv_i.alias("_dvi"),
        F.size(plain).alias("_plain"),
        F.concat(plain, nodes("doc.derivativeTable.derivativeTransaction")).alias("_tx"))
    rows = once.select(*[c for c in once.columns if c != "_tx"],
                       F.posexplode_outer("_tx").alias("node_ordinal", "tx")).where(
        F.col("node_ordinal").isNotNull())
    in_dt = F.col("node_ordinal") >= F.col("_plain")
    nd_d, nd_i = holdings_split(F.col("_ndd"), F.col("_ndi"))
    dv_d, dv_i = holdings_split(F.col("_dvd"), F.col("_dvi"))
    tx = F.col("tx")
    amounts = tx["transactionAmounts"]
    shares = amounts["transactionShares"]["value"]
    # A node is derivative when it sits in the derivative table, or when a
    # non-derivative node carries no share count; such a node then reads the
    # (absent) derivative fields and the derivative holdings.
    deriv = in_dt | shares.isNull()

    def field(c: Column) -> Column:
        return F.when(in_dt | shares.isNotNull(), c)

    out = rows.select(
        *common.keys(),
        plan_flag(F.col("_aff"), F.col("_fn"),
                  field(amounts["transactionShares"]["footnoteId"][0]["_id"])).alias("rule105b1"),
        deriv.alias("derivative"),
        field(shares).alias("shares"),
        field(amounts["transactionAcquiredDisposedCode"]["value"]).alias("acquired_disposed"),
        field(amounts["transactionPricePerShare"]["value"]).alias("price"),
        field(tx["transactionDate"]["value"]).alias("date"),
        field(tx["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]["value"])
        .alias("remaining_shares"),
        field(tx["ownershipNature"]["directOrIndirectOwnership"]["value"]).alias("ownership"),
        field(tx["transactionCoding"]["transactionCode"]).alias("coding"),
        F.when(deriv, dv_d).otherwise(nd_d).alias("direct_holding"),
        F.when(deriv, dv_i).otherwise(nd_i).alias("indirect_holding"),
        # the derivative table has no swap-flag path
        F.when(in_dt, F.lit(False))
         .otherwise(S.truthy_flag(tx["transactionCoding"]["equitySwapInvolved"])).alias("equity_swap"),
        F.col("node_ordinal"))
    return out if with_ordinal else out.drop("node_ordinal")


def with_message_fields(tx: DataFrame) -> DataFrame:
    """Event timestamp from the transaction date (suffix-tolerant; NULL when
    unparsable) and the composite key."""
    d = S.parse_date_with_suffix("date")
    return (tx.withColumn("timestamp", F.when(d.isNotNull(), S.date_to_epoch_ms(d)))
              .withColumn("key", S.key_composite("link", "remaining_shares", "derivative")))


# Holdings reports (13F information tables): namespaced XML, one row per
# holding. Declared by the reference but not wired into its services.
INFO_TABLE = T.StructType([
    T.StructField("nameOfIssuer", T.StringType()),
    T.StructField("titleOfClass", T.StringType()),
    T.StructField("cusip", T.StringType()),
    T.StructField("shrsOrPrnAmt", T.StructType([T.StructField("sshPrnamt", T.StringType())])),
])
HOLDINGS_SCHEMA = T.StructType([T.StructField("infoTable", T.ArrayType(INFO_TABLE))])


def holdings_report_rows(reports: DataFrame, *, xml: str = "xml") -> DataFrame:
    """One row per ``infoTable`` entry: issuer, CUSIP, class, shares
    (namespaces ignored, shares typed with reject-to-null)."""
    doc = F.from_xml(F.col(xml), HOLDINGS_SCHEMA, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    rows = reports.select(*[c for c in reports.columns if c != xml],
                          F.explode(doc["infoTable"]).alias("h"))
    return rows.select(*[c for c in reports.columns if c != xml],
                       F.col("h.nameOfIssuer").alias("issuer_name"),
                       F.col("h.cusip").alias("issuer_cusip"),
                       F.col("h.titleOfClass").alias("title_class"),
                       F.col("h.shrsOrPrnAmt.sshPrnamt").try_cast("bigint").alias("shares"))
