"""Stand-in feed input built from the driver tables (orders, lineitem, customer, nation).

Nothing here does the parser's work: it only writes Atom ``<entry>`` text in the schema
the feed jobs expect. The jobs read that text like any other feed; their DuckDB oracles
compute the expected values straight from the tables.

Layout of one entry (one per order):

* atom: ``id`` = ``https://host/o/{o_orderkey}/``, two links (the last with href wins, an
  href-less ``<link/>`` in between), ``title`` = ``o_orderpriority``, ``summary``,
  ``updated`` = order date.
* contract block: status = ``o_orderstatus``; party = customer and nation; project with a
  country name placed before the project name, an empty name for status ``F`` and a second
  name that must lose; budget amounts; lots = lineitems; one tender result per return flag.
* lots: ``ID_LOTE`` id = ``l_linenumber`` plus a decoy ID with another scheme; CPV codes
  ``l_partkey`` and ``l_suppkey`` with a leading empty code (flag ``R``) or an inner empty
  code (flag ``A``); the lot country sits under an inner ProcurementProject.
* results: lot ids = the flag's line numbers, none for flag ``N`` (sentinel ``'0'``), an
  extra empty lot id for flag ``R`` (must be dropped).

With ``omit_atom`` the id is left out for priority ``5-LOW`` and the title for
status ``P`` so that entries with neither are dropped by the parser.

The tables' rows stay columns until an entry is written: ``entry_texts`` joins them to texts, a batch at a time, with
Arrow's string functions (``concat`` in SQL, called for every value of a lot inside lambda functions, took far longer).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this module run in Python workers: ship them by value so the workers do not
# need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOST = "https://host"

#: A constant text, or one text a row.
Text = str | pa.Array


def cat(*parts: Text) -> Text:
    """The parts joined row by row, null where one of them is."""
    merged: list[Text] = []
    for part in parts:
        if isinstance(part, str) and merged and isinstance(merged[-1], str):
            merged[-1] += part
        else:
            merged.append(part)
    if len(merged) == 1:
        return merged[0]
    return pc.binary_join_element_wise(*merged, "") if merged else ""


def text_of(value: pa.Array) -> pa.Array:
    return value if pa.types.is_string(value.type) else pc.cast(value, pa.string())


def esc(value: Text) -> Text:
    """Escape text for XML content and attribute values."""
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = value.replace(raw, escaped) if isinstance(value, str) else pc.replace_substring(value, raw, escaped)
    return value


def either(condition: pa.Array, yes: Text, no: Text) -> pa.Array:
    """``yes`` where the condition holds, ``no`` where it does not or is null."""
    return pc.if_else(pc.fill_null(condition, False), yes, no)


def el(tag: str, value: Text | None = None, **attrs: Text) -> Text:
    """``<tag a="..">value</tag>``; ``<tag/>`` when value is None. Null value -> ''."""
    parts: list[Text] = ["<" + tag]
    for k, v in attrs.items():
        parts += [f' {k}="', esc(v), '"']
    if value is None:
        return cat(*parts, "/>")
    if isinstance(value, pa.Array):
        value = esc(value) if pa.types.is_string(value.type) else text_of(value)
        return pc.coalesce(cat(*parts, ">", value, f"</{tag}>"), "")
    return cat(*parts, ">", esc(value), f"</{tag}>")


def wrap(tag: str, *children: Text) -> Text:
    return cat(f"<{tag}>", *children, f"</{tag}>")


def joined(texts: pa.Array, counts: np.ndarray) -> pa.Array:
    """Runs of ``texts``, of so many each, as one text each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts), "")


def _elements(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The elements of all lists, and how many each list has (a null one none)."""
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _in_order(keys: dict[str, pa.Array]) -> pa.Array:
    """Rows sorted by the keys, nulls first."""
    return pc.sort_indices(pa.table(keys), sort_keys=[(k, "ascending") for k in keys], null_placement="at_start")




def dec(c: Column) -> Column:
    """Amount text: value as decimal(15,2)."""
    return c.cast("decimal(15,2)").cast("string")


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def period_of(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lot_xml(line) -> pa.Array:
    """One lot for each line; ``line`` gives a column of theirs by its name."""
    flag = line("l_returnflag")
    ln = text_of(line("l_linenumber"))
    part = el("cbc:ItemClassificationCode", line("l_partkey"), listURI="https://codes/part")
    supp = el("cbc:ItemClassificationCode", line("l_suppkey"), listURI="https://codes/supplier")
    codes = either(pc.equal(flag, "R"), cat("<cbc:ItemClassificationCode/>", part, supp),
                   either(pc.equal(flag, "A"), cat(part, "<cbc:ItemClassificationCode></cbc:ItemClassificationCode>", supp), cat(part, supp)))
    name = el("cbc:Name", cat("Line ", ln))
    names = either(pc.equal(line("l_linestatus"), "O"), cat("<cbc:Name/>", name), cat(name, el("cbc:Name", "Extra")))
    return wrap(
        "cac:ProcurementProjectLot",
        el("cbc:ID", ln, schemeName="ID_LOTE"),
        el("cbc:ID", line("l_partkey"), schemeName="ID_PARTIDA"),
        names,
        wrap("cac:BudgetAmount",
             el("cbc:TotalAmount", line("l_extendedprice"), currencyID="EUR"),
             el("cbc:TaxExclusiveAmount", line("l_quantity"))),
        wrap("cac:RequiredCommodityClassification", codes),
        wrap("cac:ProcurementProject", wrap("cac:RealizedLocation", wrap("cac:Address", wrap(
            "cac:Country", el("cbc:IdentificationCode", flag, listURI="https://codes/flag"))))),
    )


def _result_xml(result) -> pa.Array:
    """One TenderResult for each return flag of an order (aggregates already computed)."""
    flag = result("flag")
    lns, counts = _elements(result("lns"))
    lot_ids = joined(cat("<cbc:ProcurementProjectLotID>", text_of(lns), "</cbc:ProcurementProjectLotID>"), counts)
    lot_ids = either(pc.equal(flag, "N"), "", either(pc.equal(flag, "R"), cat(lot_ids, "<cbc:ProcurementProjectLotID/>"), lot_ids))
    return wrap(
        "cac:TenderResult",
        el("cbc:ResultCode", flag, listURI="https://codes/flag"),
        el("cbc:Description", cat(text_of(result("n")), " lines")),
        wrap("cac:WinningParty", wrap("cac:PartyName", el("cbc:Name", cat("Flag ", flag)))),
        el("cbc:SMEAwardedIndicator", either(pc.equal(flag, "A"), "true", "false")),
        el("cbc:AwardDate", result("first_ship")),
        wrap("cac:AwardedTenderedProject", lot_ids, wrap(
            "cac:LegalMonetaryTotal",
            el("cbc:TaxExclusiveAmount", result("total"), currencyID="EUR"),
            el("cbc:PayableAmount", result("qty_total"), currencyID="EUR"))),
    )


LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]


def lineitem_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: ``flags`` (one struct for each return flag, with its lines), last ship day, total.

    lineitem is hash-partitioned by order key once; both aggregations reuse that partitioning.
    """
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).repartition("l_orderkey")
    li = li.withColumns({c: F.col(c).cast("decimal(15,2)") for c in ("l_extendedprice", "l_quantity")})   # no wider than a double
    ship, ext, qty = day(F.col("l_shipdate")), F.col("l_extendedprice"), F.col("l_quantity")
    per_flag = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.count("*").alias("n"), F.sum(ext).alias("total"), F.sum(qty).alias("qty_total"),
        F.min(ship).alias("first_ship"), F.max(ship).alias("last_ship"),
        F.array_sort(F.collect_list("l_linenumber")).alias("lns"), F.collect_list(F.struct(*LINE)).alias("lines"))
    flag = F.struct(F.col("l_returnflag").alias("flag"), "n", "total", "qty_total", "first_ship", "lns", "lines")
    return per_flag.groupBy("l_orderkey").agg(
        F.collect_list(flag).alias("flags"), F.max("last_ship").alias("last_ship"), F.sum("total").alias("lines_total"))


def _lots_and_results(flags: pa.Array) -> tuple[pa.Array, pa.Array]:
    """All lots of each order, in line order, and all its results, by return flag."""
    n = len(flags)
    results, n_flags = _elements(flags)
    result = lambda name: pc.struct_field(results, name)
    order = np.repeat(np.arange(n), n_flags)
    xml = _result_xml(result)
    results_xml = joined(xml.take(_in_order({"order": pa.array(order), "flag": result("flag"), "xml": xml})), n_flags)

    lines, n_lines = _elements(result("lines"))
    line = lambda name: pc.struct_field(lines, name)
    order = np.repeat(order, n_lines)
    xml = _lot_xml(line)
    in_order = _in_order({
        "order": pa.array(order), "ln": line("l_linenumber"), "flag": line("l_returnflag"), "ship": pc.floor_temporal(line("l_shipdate"), unit="day"),
        "ext": line("l_extendedprice"), "qty": line("l_quantity"), "xml": xml})
    return joined(xml.take(in_order), np.bincount(order, minlength=n)), results_xml


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its ``period`` and what ``entry_fields`` needs: a small part of the text's size."""
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    lines = lineitem_groups(spark, sf_dir)
    # nation last: its columns need not go through the shuffle by order key
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
                  .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
                  .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
                  .withColumn("period", period_of(F.col("o_orderdate"))))


FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
          "n_nationkey", "n_name", "n_regionkey", "flags", "last_ship"]


def entry_fields(omit_atom: bool | Column = False, broken: bool | Column = False) -> list[Column]:
    """What ``entry_texts`` reads of a row of ``entry_rows``; ``broken`` entries lose their ``</title>``."""
    as_column = lambda c: c if isinstance(c, Column) else F.lit(c)
    return [
        "period", *FIELDS, day(F.col("o_orderdate")).alias("updated"), dec(F.col("o_totalprice")).alias("total"),
        F.substring("o_orderpriority", 1, 1).alias("urgency"), F.coalesce(F.col("lines_total").cast("string"), F.lit("0.00")).alias("lines_total"),
        as_column(omit_atom).alias("omit_atom"), as_column(broken).alias("broken")]


def entry_texts(rows: pa.RecordBatch) -> pa.Array:
    """The Atom entries of rows with the columns ``entry_fields``."""
    col = rows.column
    okey, cust = text_of(col("o_orderkey")), text_of(col("c_custkey"))
    status, prio, omit = col("o_orderstatus"), col("o_orderpriority"), col("omit_atom")
    lots, results = _lots_and_results(col("flags"))
    id_el = either(pc.and_kleene(omit, pc.equal(prio, "5-LOW")), "", el("id", cat(HOST + "/o/", okey, "/")))
    title_el = either(pc.and_kleene(omit, pc.equal(status, "P")), "", el("title", prio))
    title_el = either(col("broken"), pc.replace_substring(title_el, "</title>", ""), title_el)
    project_names = cat(
        either(pc.equal(status, "F"), "<cbc:Name/>", ""),
        el("cbc:Name", cat("Order ", okey)),
        el("cbc:Name", cat("Alt ", okey)),
    )
    block = wrap(
        "cac-place-ext:ContractFolderStatus",
        el("cbc:ContractFolderID", okey),
        el("cbc-place-ext:ContractFolderStatusCode", status, listURI="https://codes/status"),
        wrap("cac-place-ext:LocatedContractingParty",
             el("cbc:ContractingPartyTypeCode", col("c_mktsegment"), listURI="https://codes/segment"),
             el("cbc:ActivityCode", col("c_nationkey"), listURI="https://codes/nation"),
             wrap("cac:Party",
                  el("cbc:WebsiteURI", cat(HOST + "/c/", cust)),
                  wrap("cac:PartyName", el("cbc:Name", col("c_name"))),
                  wrap("cac:PostalAddress",
                       el("cbc:CityName", col("n_name")),
                       el("cbc:PostalZone", cust),
                       wrap("cac:Country", el("cbc:IdentificationCode", col("n_nationkey"),
                                              listURI="https://codes/country"))))),
        wrap("cac:ProcurementProject",
             wrap("cac:RealizedLocation", wrap("cac:Country",
                  el("cbc:Name", col("n_name")),
                  el("cbc:IdentificationCode", col("n_regionkey"), listURI="https://codes/region"))),
             project_names,
             el("cbc:TypeCode", col("urgency"), listURI="https://codes/priority"),
             el("cbc:SubTypeCode", status, listURI="https://codes/status"),
             wrap("cac:BudgetAmount",
                  el("cbc:TotalAmount", col("total"), currencyID="EUR"),
                  el("cbc:TaxExclusiveAmount", col("lines_total")),
                  el("cbc:TaxExclusiveAmount", "0.00", currencyID="USD")),
             wrap("cac:RequiredCommodityClassification",
                  el("cbc:ItemClassificationCode", col("o_custkey"), listURI="https://codes/customer"))),
        lots,
        results,
        wrap("cac:TenderingTerms", el("cbc:FundingProgramCode", prio, listURI="https://codes/funding")),
        wrap("cac:TenderingProcess",
             el("cbc:ProcedureCode", status, listURI="https://codes/procedure"),
             el("cbc:UrgencyCode", col("urgency")),
             wrap("cac:TenderSubmissionDeadlinePeriod", el("cbc:EndDate", col("last_ship")))),
    )
    return cat(
        "<entry>",
        id_el,
        el("link", None, href=cat(HOST + "/o/", okey, "/v1")),
        "<link/>",
        el("link", None, href=cat(HOST + "/o/", okey)),
        el("summary", cat("Order ", okey, " & ", pc.coalesce(col("c_name"), ""))),
        title_el,
        el("updated", col("updated")),
        block,
        "</entry>",
    )
