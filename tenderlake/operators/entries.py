"""Parsed entry (RAW struct) -> output row (ENTRY schema), as narrow projections.

This is the whole "path projection" of the feed: every output leaf is an expression over
the RAW struct, so the step is narrow (no shuffle), runs inside whole-stage code
generation next to ``from_xml`` and scales with the number of input splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.reduce import (
    amount,
    chained,
    child,
    coded,
    concat_values,
    field,
    first_non_empty,
    last_non_empty,
    last_present,
    values,
    walk,
)
from tenderlake.functions.scalars import id_from_url
from tenderlake.schema import RAW_XML_COLUMN, RESULT_FIELDS

LOT_SCHEME = "ID_LOTE"          # fixed value: lot ids carry schemeName="ID_LOTE"
NO_LOT_ID = "0"                 # fixed value: sentinel lot id of a result without lots


def _countries(locations: Column) -> Column:
    """IdentificationCode under RealizedLocation/Country and RealizedLocation/Address/Country."""
    return chained(walk(locations, "Country", "IdentificationCode"),
                   walk(locations, "Address", "Country", "IdentificationCode"))


# The projection runs in layers. Each layer materialises arrays the next one reads several
# times, so every nested walk is evaluated once per entry (inside lambda functions there is
# no common-subexpression elimination) and the reductions only read cheap field references.

def _layer_blocks(cfs: Column) -> list[Column]:
    """Layer 1: array members of the (last) contract block."""
    return [
        field(cfs, "ContractFolderID").alias("_cid"),
        field(cfs, "ContractFolderStatusCode").alias("_status"),
        field(cfs, "ProcurementProject").alias("_pj"),
        field(cfs, "LocatedContractingParty").alias("_lcp"),
        child(field(cfs, "TenderingTerms"), "FundingProgramCode").alias("_funding"),
        field(cfs, "TenderingProcess").alias("_tp"),
        F.transform(field(cfs, "ProcurementProjectLot"), _lot_parts).alias("_lots"),
        F.transform(field(cfs, "TenderResult"), _result_parts).alias("_res"),
    ]


def _lot_parts(lot: Column) -> Column:
    """Lot groups; leaves directly under the lot come before those of an inner project."""
    inner = field(lot, "ProcurementProject")
    return F.struct(
        values(F.filter(field(lot, "ID"), lambda x: x["_schemeName"] == F.lit(LOT_SCHEME))).alias("ids"),
        chained(field(lot, "Name"), child(inner, "Name")).alias("names"),
        chained(field(lot, "BudgetAmount"), child(inner, "BudgetAmount")).alias("budgets"),
        chained(field(lot, "RequiredCommodityClassification"),
                child(inner, "RequiredCommodityClassification")).alias("classes"),
        chained(field(lot, "RealizedLocation"), child(inner, "RealizedLocation")).alias("locations"),
    )


def _result_parts(result: Column, index: Column) -> Column:
    awarded = field(result, "AwardedTenderedProject")
    return F.struct(
        (index + F.lit(1)).cast("string").alias("result_id"),
        F.filter(chained(field(result, "ProcurementProjectLotID"), child(awarded, "ProcurementProjectLotID")),
                 lambda x: F.coalesce(x, F.lit("")) != F.lit("")).alias("lot_ids"),
        child(awarded, "LegalMonetaryTotal").alias("totals"),
        field(result, "ResultCode").alias("codes"),
        field(result, "Description").alias("descriptions"),
        walk(field(result, "WinningParty"), "PartyName", "Name").alias("winners"),
        field(result, "SMEAwardedIndicator").alias("sme"),
        field(result, "AwardDate").alias("dates"),
    )


def _layer_groups() -> list[Column]:
    """Layer 2: second-level groups."""
    pj, lcp = F.col("_pj"), F.col("_lcp")
    parties = child(lcp, "Party")
    return [
        child(pj, "BudgetAmount").alias("_pj_budgets"),
        child(pj, "RealizedLocation").alias("_pj_locations"),
        parties.alias("_parties"),
        F.transform("_lots", lambda l: F.struct(
            l["ids"].alias("ids"), l["names"].alias("names"),
            child(l["budgets"], "TotalAmount").alias("totals"),
            child(l["budgets"], "TaxExclusiveAmount").alias("taxes"),
            child(l["classes"], "ItemClassificationCode").alias("codes"),
            _countries(l["locations"]).alias("countries"),
        )).alias("_lots2"),
        F.transform("_res", lambda r: F.struct(
            r["result_id"].alias("result_id"),
            F.when(F.size(r["lot_ids"]) > 0, r["lot_ids"]).otherwise(F.array(F.lit(NO_LOT_ID))).alias("lot_ids"),
            child(r["totals"], "TaxExclusiveAmount").alias("taxes"),
            child(r["totals"], "PayableAmount").alias("payables"),
            *[r[n].alias(n) for n in ("codes", "descriptions", "winners", "sme", "dates")],
        )).alias("_res2"),
    ]


def _layer_leaves() -> list[Column]:
    """Layer 3: remaining leaf arrays read more than once."""
    return [
        child(F.col("_parties"), "PostalAddress").alias("_addresses"),
    ]


def _project() -> Column:
    pj, budgets = F.col("_pj"), F.col("_pj_budgets")
    type_code, type_uri = coded(child(pj, "TypeCode"))
    sub_code, sub_uri = coded(child(pj, "SubTypeCode"))
    total, total_cur = amount(child(budgets, "TotalAmount"))
    tax, tax_cur = amount(child(budgets, "TaxExclusiveAmount"))
    cpv, cpv_uri = coded(walk(pj, "RequiredCommodityClassification", "ItemClassificationCode"))
    country, country_uri = coded(_countries(F.col("_pj_locations")))
    return F.struct(
        first_non_empty(child(pj, "Name")).alias("name"),
        type_code.alias("type_code"), type_uri.alias("type_code_list_uri"),
        sub_code.alias("sub_type_code"), sub_uri.alias("sub_type_code_list_uri"),
        total.alias("total_amount"), total_cur.alias("total_currency"),
        tax.alias("tax_exclusive_amount"), tax_cur.alias("tax_exclusive_currency"),
        cpv.alias("cpv_code"), cpv_uri.alias("cpv_code_list_uri"),
        country.alias("country_code"), country_uri.alias("country_code_list_uri"),
    )


def _contracting_party() -> Column:
    lcp, parties, addresses = F.col("_lcp"), F.col("_parties"), F.col("_addresses")
    type_code, type_uri = coded(child(lcp, "ContractingPartyTypeCode"))
    activity, activity_uri = coded(child(lcp, "ActivityCode"))
    country, country_uri = coded(walk(addresses, "Country", "IdentificationCode"))
    return F.struct(
        concat_values(walk(parties, "PartyName", "Name")).alias("name"),
        concat_values(child(parties, "WebsiteURI")).alias("website"),
        type_code.alias("type_code"), type_uri.alias("type_code_list_uri"),
        activity.alias("activity_code"), activity_uri.alias("activity_code_list_uri"),
        concat_values(child(addresses, "CityName")).alias("city"),
        concat_values(child(addresses, "PostalZone")).alias("zip"),
        country.alias("country_code"), country_uri.alias("country_code_list_uri"),
    )


def _lot(l: Column) -> Column:
    total, total_cur = amount(l["totals"])
    tax, tax_cur = amount(l["taxes"])
    cpv, cpv_uri = coded(l["codes"])
    country, country_uri = coded(l["countries"])
    return F.struct(
        concat_values(l["ids"]).alias("id"),
        first_non_empty(l["names"]).alias("name"),
        total.alias("total_amount"), total_cur.alias("total_currency"),
        tax.alias("tax_exclusive_amount"), tax_cur.alias("tax_exclusive_currency"),
        cpv.alias("cpv_code"), cpv_uri.alias("cpv_code_list_uri"),
        country.alias("country_code"), country_uri.alias("country_code_list_uri"),
    )


def _result(r: Column) -> Column:
    """One reduced result (without its lot id) and its lot ids."""
    code, code_uri = coded(r["codes"])
    tax, tax_cur = amount(r["taxes"])
    pay, pay_cur = amount(r["payables"])
    return F.struct(
        r["result_id"].alias("result_id"), r["lot_ids"].alias("lot_ids"),
        code.alias("result_code"), code_uri.alias("result_code_list_uri"),
        concat_values(r["descriptions"]).alias("result_description"),
        concat_values(r["winners"]).alias("result_winning_party"),
        concat_values(r["sme"]).alias("result_sme_awarded_indicator"),
        concat_values(r["dates"]).alias("result_award_date"),
        tax.alias("result_tax_exclusive_amount"), tax_cur.alias("result_tax_exclusive_currency"),
        pay.alias("result_payable_amount"), pay_cur.alias("result_payable_currency"),
    )


def _tender_results() -> Column:
    """Results expanded per lot id: one row per non-empty lot id, or one with lot id '0'."""
    results = F.transform("_res2", _result)
    return F.flatten(F.transform(results, lambda r: F.transform(r["lot_ids"], lambda lot_id: F.struct(
        r["result_id"].alias("result_id"), lot_id.alias("result_lot_id"),
        *[r[n].alias(n) for n in RESULT_FIELDS[2:]]))))


def _process() -> Column:
    tp = F.col("_tp")
    procedure, procedure_uri = coded(child(tp, "ProcedureCode"))
    urgency, urgency_uri = coded(child(tp, "UrgencyCode"))
    end_date = concat_values(walk(tp, "TenderSubmissionDeadlinePeriod", "EndDate"))
    return F.struct(
        end_date.alias("end_date"),
        procedure.alias("procedure_code"), procedure_uri.alias("procedure_code_list_uri"),
        urgency.alias("urgency_code"), urgency_uri.alias("urgency_code_list_uri"),
    )


def atom_columns(raw: Column) -> list[Column]:
    """Atom text fields: an element without text counts as absent, the last one with text wins."""
    return [
        id_from_url(last_non_empty(raw["id"])).alias("id"),
        last_non_empty(raw["title"]).alias("title"),
        last_present(raw["link"]["_href"]).alias("link"),
        last_non_empty(raw["summary"]).alias("summary"),
        last_non_empty(raw["updated"]).alias("updated"),
    ]


def _block_columns() -> list[Column]:
    status_code, status_uri = coded(F.col("_status"))
    funding_code, funding_uri = coded(F.col("_funding"))
    return [
        F.struct(status_code.alias("code"), status_uri.alias("list_uri")).alias("status"),
        concat_values(F.col("_cid")).alias("contract_id"),
        _contracting_party().alias("contracting_party"),
        _project().alias("project"),
        F.transform("_lots2", _lot).alias("project_lots"),
        _tender_results().alias("tender_results"),
        F.struct(funding_code.alias("code"), funding_uri.alias("list_uri")).alias("terms_funding_program"),
        _process().alias("process"),
    ]


BLOCK_COLUMNS = ["status", "contract_id", "contracting_party", "project", "project_lots", "tender_results",
                 "terms_funding_program", "process"]
ATOM = ["id", "title", "link", "summary", "updated"]


def to_entries(parsed: DataFrame, raw_col: str = "e", keep: list[str] | None = None,
               raw_xml_col: str | None = None, columns=None) -> DataFrame:
    """Project parsed entries into the ENTRY schema and drop entries without id and title.

    When an entry holds several contract blocks the last one replaces all block fields.
    ``columns`` must be what the parse was limited to, if it was: of the block's columns only
    those are returned, so that what was not parsed never looks like an absent value.
    ``keep`` lists pass-through columns (e.g. ``period``) placed after the entry columns.
    All layers are narrow projections of the same rows (no shuffle).
    """
    keep = list(keep or [])
    raw = F.col(raw_col)
    tail = [RAW_XML_COLUMN] if raw_xml_col else []
    extra = [F.col(raw_xml_col).alias(RAW_XML_COLUMN)] if raw_xml_col else []
    df = parsed.select(
        *atom_columns(raw),
        F.try_element_at(raw["ContractFolderStatus"], F.lit(-1)).alias("_cfs"),
        *extra, *[F.col(k) for k in keep],
    ).where(F.col("id").isNotNull() | F.col("title").isNotNull())
    passthrough = [*ATOM, *tail, *keep]
    df = df.select(*passthrough, *_layer_blocks(F.col("_cfs")))
    l1 = ["_cid", "_status", "_pj", "_lcp", "_funding", "_tp"]
    df = df.select(*passthrough, *l1, *_layer_groups())
    l2 = ["_pj_budgets", "_pj_locations", "_parties", "_lots2", "_res2"]
    df = df.select(*passthrough, *l1, *l2, *_layer_leaves())
    wanted = [c for n, c in zip(BLOCK_COLUMNS, _block_columns(), strict=True) if columns is None or n in columns]
    return df.select(*ATOM, *wanted, *tail, *keep)
