"""Schemas: the fixed output table (ENTRY) and the read schema of one feed entry (RAW).

Every leaf of the output is a nullable string; amounts, dates and flags stay text.
The RAW schema is what ``from_xml`` / the XML source parse an ``<entry>`` into. Element
names are local names (namespaces are ignored on read); attributes carry the ``_`` prefix
and element text sits in ``_VALUE``. Every leaf that may repeat is an ARRAY so that the
repeat rules (concat / first / last) can be applied afterwards in document order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Output schema (column order and struct field order are part of the contract)
# ---------------------------------------------------------------------------

STATUS_FIELDS = ["code", "list_uri"]
FUNDING_FIELDS = ["code", "list_uri"]
PARTY_FIELDS = [
    "name", "website", "type_code", "type_code_list_uri", "activity_code",
    "activity_code_list_uri", "city", "zip", "country_code", "country_code_list_uri",
]
PROJECT_FIELDS = [
    "name", "type_code", "type_code_list_uri", "sub_type_code", "sub_type_code_list_uri",
    "total_amount", "total_currency", "tax_exclusive_amount", "tax_exclusive_currency",
    "cpv_code", "cpv_code_list_uri", "country_code", "country_code_list_uri",
]
LOT_FIELDS = [
    "id", "name", "total_amount", "total_currency", "tax_exclusive_amount",
    "tax_exclusive_currency", "cpv_code", "cpv_code_list_uri", "country_code",
    "country_code_list_uri",
]
RESULT_FIELDS = [
    "result_id", "result_lot_id", "result_code", "result_code_list_uri", "result_description",
    "result_winning_party", "result_sme_awarded_indicator", "result_award_date",
    "result_tax_exclusive_amount", "result_tax_exclusive_currency", "result_payable_amount",
    "result_payable_currency",
]
PROCESS_FIELDS = [
    "end_date", "procedure_code", "procedure_code_list_uri", "urgency_code",
    "urgency_code_list_uri",
]

RAW_XML_COLUMN = "cfs_raw_xml"


def _struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def entry_schema(keep_raw_xml: bool = False) -> T.StructType:
    """The 13-column output schema, 14 with the raw contract block."""
    s = _struct(["id", "title", "link", "summary", "updated"])
    s = s.add("status", _struct(STATUS_FIELDS), True)
    s = s.add("contract_id", T.StringType(), True)
    s = s.add("contracting_party", _struct(PARTY_FIELDS), True)
    s = s.add("project", _struct(PROJECT_FIELDS), True)
    s = s.add("project_lots", T.ArrayType(_struct(LOT_FIELDS), True), True)
    s = s.add("tender_results", T.ArrayType(_struct(RESULT_FIELDS), True), True)
    s = s.add("terms_funding_program", _struct(FUNDING_FIELDS), True)
    s = s.add("process", _struct(PROCESS_FIELDS), True)
    if keep_raw_xml:
        s = s.add(RAW_XML_COLUMN, T.StringType(), True)
    return s


ENTRY_SCHEMA = entry_schema(False)
ENTRY_SCHEMA_RAW = entry_schema(True)
ENTRY_COLUMNS = [f.name for f in ENTRY_SCHEMA.fields]

# Partition columns of the stored table. Both are strings: periods compare as text.
PARTITION_COLUMNS = ["procurement_type", "period"]


def stored_schema(keep_raw_xml: bool = False) -> T.StructType:
    """Schema of the partitioned table on disk (entry columns + partition columns)."""
    s = entry_schema(keep_raw_xml)
    for c in PARTITION_COLUMNS:
        s = s.add(c, T.StringType(), True)
    return s


# ---------------------------------------------------------------------------
# RAW read schema of one <entry>, built from small typed pieces
# ---------------------------------------------------------------------------

def _arr(t: str) -> str:
    return f"ARRAY<{t}>"


def _st(*fields: tuple[str, str]) -> str:
    return "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in fields) + ">"


S = "STRING"
CODE = _st(("_VALUE", S), ("_listURI", S))          # code with listURI attribute
AMOUNT = _st(("_VALUE", S), ("_currencyID", S))     # amount with currencyID attribute
SCHEMED_ID = _st(("_VALUE", S), ("_schemeName", S))

COUNTRY = _st(("IdentificationCode", _arr(CODE)))
# A country may sit right under RealizedLocation or one level lower under Address.
LOCATION = _st(("Country", _arr(COUNTRY)), ("Address", _arr(_st(("Country", _arr(COUNTRY))))))
BUDGET = _st(("TotalAmount", _arr(AMOUNT)), ("TaxExclusiveAmount", _arr(AMOUNT)))
CLASSIFICATION = _st(("ItemClassificationCode", _arr(CODE)))

PROJECT_BODY = _st(
    ("Name", _arr(S)),
    ("TypeCode", _arr(CODE)),
    ("SubTypeCode", _arr(CODE)),
    ("BudgetAmount", _arr(BUDGET)),
    ("RequiredCommodityClassification", _arr(CLASSIFICATION)),
    ("RealizedLocation", _arr(LOCATION)),
)
# Lot leaves are read both directly under the lot and under a ProcurementProject inside it.
LOT = _st(
    ("ID", _arr(SCHEMED_ID)),
    ("Name", _arr(S)),
    ("BudgetAmount", _arr(BUDGET)),
    ("RequiredCommodityClassification", _arr(CLASSIFICATION)),
    ("RealizedLocation", _arr(LOCATION)),
    ("ProcurementProject", _arr(PROJECT_BODY)),
)
PARTY_NAME = _st(("Name", _arr(S)))
PARTY = _st(
    ("WebsiteURI", _arr(S)),
    ("PartyName", _arr(PARTY_NAME)),
    ("PostalAddress", _arr(_st(("CityName", _arr(S)), ("PostalZone", _arr(S)),
                               ("Country", _arr(COUNTRY))))),
)
CONTRACTING_PARTY = _st(
    ("ContractingPartyTypeCode", _arr(CODE)),
    ("ActivityCode", _arr(CODE)),
    ("Party", _arr(PARTY)),
)
TENDER_RESULT = _st(
    ("ResultCode", _arr(CODE)),
    ("Description", _arr(S)),
    ("WinningParty", _arr(_st(("PartyName", _arr(PARTY_NAME))))),
    ("SMEAwardedIndicator", _arr(S)),
    ("AwardDate", _arr(S)),
    ("ProcurementProjectLotID", _arr(S)),
    ("AwardedTenderedProject", _arr(_st(
        ("ProcurementProjectLotID", _arr(S)),
        ("LegalMonetaryTotal", _arr(_st(("TaxExclusiveAmount", _arr(AMOUNT)),
                                        ("PayableAmount", _arr(AMOUNT))))),
    ))),
)
TENDERING_TERMS = _st(("FundingProgramCode", _arr(CODE)))
TENDERING_PROCESS = _st(
    ("ProcedureCode", _arr(CODE)),
    ("UrgencyCode", _arr(CODE)),
    ("TenderSubmissionDeadlinePeriod", _arr(_st(("EndDate", _arr(S))))),
)
# Members of the contract block, in document order of the schema.
CONTRACT_FOLDER_MEMBERS = [
    ("ContractFolderID", _arr(S)),
    ("ContractFolderStatusCode", _arr(CODE)),
    ("LocatedContractingParty", _arr(CONTRACTING_PARTY)),
    ("ProcurementProject", _arr(PROJECT_BODY)),
    ("ProcurementProjectLot", _arr(LOT)),
    ("TenderResult", _arr(TENDER_RESULT)),
    ("TenderingTerms", _arr(TENDERING_TERMS)),
    ("TenderingProcess", _arr(TENDERING_PROCESS)),
]
CONTRACT_FOLDER = _st(*CONTRACT_FOLDER_MEMBERS)

# Atom fields may repeat: the last occurrence with text wins.
ATOM_FIELDS = [("id", _arr(S)), ("title", _arr(S)), ("summary", _arr(S)), ("updated", _arr(S)),
               ("link", _arr(_st(("_href", S))))]

# Output column -> contract block members it is computed from.
BLOCK_MEMBERS_FOR = {
    "status": {"ContractFolderStatusCode"},
    "contract_id": {"ContractFolderID"},
    "contracting_party": {"LocatedContractingParty"},
    "project": {"ProcurementProject"},
    "project_lots": {"ProcurementProjectLot"},
    "tender_results": {"TenderResult"},
    "terms_funding_program": {"TenderingTerms"},
    "process": {"TenderingProcess"},
}


def block_members_for(columns) -> set[str] | None:
    """Block members needed for the given output columns; None (= all) when not given."""
    if columns is None:
        return None
    need: set[str] = set()
    for c in columns:
        need |= BLOCK_MEMBERS_FOR.get(c, set())
    return need


def raw_entry_ddl(members: set[str] | None = None) -> str:
    """RAW read schema; with ``members`` only those block members are parsed."""
    kept = [m for m in CONTRACT_FOLDER_MEMBERS if members is None or m[0] in members]
    kept = kept or CONTRACT_FOLDER_MEMBERS[:1]
    return ", ".join([f"{n} {t}" for n, t in ATOM_FIELDS] + ["ContractFolderStatus " + _arr(_st(*kept))])


RAW_ENTRY_DDL = raw_entry_ddl()

# Options shared by every XML parse (from_xml, the XML source, streaming).
XML_OPTIONS = {
    "ignoreNamespace": "true",
    "attributePrefix": "_",
    "valueTag": "_VALUE",
    "ignoreSurroundingSpaces": "true",
}
