"""Feed entries: parsing, repeat rules, blocks and lists, and their corners."""

import pytest

from tenderlake.schema import ENTRY_COLUMNS, ENTRY_SCHEMA, ENTRY_SCHEMA_RAW
from tenderlake.sinks.table import empty_entries

from helpers import entries_of, one

HEAD = '<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom">'


def feed(*entries, head=HEAD):
    return head + "".join(entries) + "</feed>"


def test_two_entries(spark):
    f = feed("<entry><id>id1</id><title>T1</title><link href='http://x/1'/><summary>S1</summary>"
             "<updated>2023-01-01</updated></entry>",
             "<entry><id>id2</id><title>T2</title><updated>2023-06-15T10:30:00Z</updated></entry>")
    rows = sorted(entries_of(spark, f).collect(), key=lambda r: r.id)
    assert [(r.id, r.title, r.link, r.summary, r.updated) for r in rows] == [
        ("id1", "T1", "http://x/1", "S1", "2023-01-01"), ("id2", "T2", None, None, "2023-06-15T10:30:00Z")]


def test_id_only_title_only_and_dropped(spark):
    f = feed("<entry><id>https://host/path/123/</id></entry>", "<entry><title>only</title></entry>",
             "<entry><summary>neither</summary></entry>", "<entry><id></id><title/></entry>")
    rows = sorted(entries_of(spark, f).collect(), key=lambda r: str(r.id))
    assert [(r.id, r.title) for r in rows] == [("123", None), (None, "only")]


def test_link_without_href_and_last_href_wins(spark):
    r = one(spark, feed("<entry><id>a</id><link/></entry>"))
    assert r.link is None
    r = one(spark, feed("<entry><id>a</id><link href='1'/><link/><link href='2'></link></entry>"))
    assert r.link == "2"


def test_no_entries(spark):
    assert entries_of(spark, feed()).count() == 0
    assert entries_of(spark, feed(head=HEAD + "<title>Feed</title><updated>2023</updated>")).count() == 0


def test_mismatched_tag_fails(spark):
    with pytest.raises(Exception):
        entries_of(spark, feed("<entry><id>a</title></entry>")).collect()


def test_cdata_and_entities(spark):
    r = one(spark, feed("<entry><id>a</id><title><![CDATA[A <b> title]]></title>"
                        "<summary>x &amp; y</summary></entry>"))
    assert r.title == "A <b> title" and r.summary == "x & y"


BLOCK = """<entry><id>e1</id><title>t</title>
<cac-place-ext:ContractFolderStatus>
 <cbc:ContractFolderID>EXP/7</cbc:ContractFolderID>
 <cbc-place-ext:ContractFolderStatusCode listURI="L">200</cbc-place-ext:ContractFolderStatusCode>
 <cac:ProcurementProject>
  <cac:RealizedLocation><cac:Country><cbc:Name>Norge</cbc:Name><cbc:IdentificationCode listURI="C">NO</cbc:IdentificationCode></cac:Country></cac:RealizedLocation>
  <cbc:Name/><cbc:Name>Harbour wall</cbc:Name><cbc:Name>Sea wall</cbc:Name>
  <cac:BudgetAmount><cbc:TotalAmount currencyID="EUR">10</cbc:TotalAmount><cbc:TotalAmount>20</cbc:TotalAmount></cac:BudgetAmount>
 </cac:ProcurementProject>
 <cac:ProcurementProjectLot>
  <cbc:ID schemeName="ID_LOTE">N1</cbc:ID><cbc:ID schemeName="OTHER">X</cbc:ID><cbc:Name>North quay</cbc:Name>
  <cac:RequiredCommodityClassification><cbc:ItemClassificationCode>45.1</cbc:ItemClassificationCode><cbc:ItemClassificationCode>45.2</cbc:ItemClassificationCode></cac:RequiredCommodityClassification>
 </cac:ProcurementProjectLot>
 <cac:ProcurementProjectLot>
  <cbc:ID schemeName="ID_LOTE">N2</cbc:ID>
  <cac:RequiredCommodityClassification><cbc:ItemClassificationCode>71</cbc:ItemClassificationCode></cac:RequiredCommodityClassification>
 </cac:ProcurementProjectLot>
 <cac:TenderResult><cbc:ResultCode>8</cbc:ResultCode>
  <cac:AwardedTenderedProject><cbc:ProcurementProjectLotID>1</cbc:ProcurementProjectLotID><cbc:ProcurementProjectLotID></cbc:ProcurementProjectLotID><cbc:ProcurementProjectLotID>2</cbc:ProcurementProjectLotID>
   <cac:LegalMonetaryTotal><cbc:PayableAmount currencyID="EUR">5</cbc:PayableAmount></cac:LegalMonetaryTotal></cac:AwardedTenderedProject></cac:TenderResult>
 <cac:TenderResult><cbc:ResultCode>9</cbc:ResultCode></cac:TenderResult>
 <cac:TenderResult><cac:AwardedTenderedProject><cbc:ProcurementProjectLotID>7</cbc:ProcurementProjectLotID></cac:AwardedTenderedProject></cac:TenderResult>
</cac-place-ext:ContractFolderStatus></entry>"""


def test_contract_block(spark):
    r = one(spark, feed(BLOCK), keep_raw_xml=True)
    assert r.contract_id == "EXP/7"
    assert (r.status.code, r.status.list_uri) == ("200", "L")
    assert r.project.name == "Harbour wall"
    assert (r.project.country_code, r.project.country_code_list_uri) == ("NO", "C")
    assert (r.project.total_amount, r.project.total_currency) == ("10_20", "EUR")
    assert [(l.id, l.name, l.cpv_code) for l in r.project_lots] == [
        ("N1", "North quay", "45.1_45.2"), ("N2", None, "71")]
    res = [(t.result_id, t.result_lot_id, t.result_code, t.result_payable_amount) for t in r.tender_results]
    assert res == [("1", "1", "8", "5"), ("1", "2", "8", "5"), ("2", "0", "9", None), ("3", "7", None, None)]
    assert r.cfs_raw_xml.startswith("<cac-place-ext:ContractFolderStatus>")
    assert "<cbc:Name>Harbour wall</cbc:Name>" in r.cfs_raw_xml


def test_raw_off_and_widths(spark):
    df = entries_of(spark, feed(BLOCK))
    assert df.columns == ENTRY_COLUMNS and len(df.columns) == 13
    assert len(entries_of(spark, feed(BLOCK), keep_raw_xml=True).columns) == 14
    assert df.schema.simpleString() == ENTRY_SCHEMA.simpleString()


def test_no_block_gives_empty_lists(spark):
    r = one(spark, feed("<entry><id>a</id></entry>"))
    assert r.project_lots == [] and r.tender_results == []
    assert r.contract_id is None and r.project.name is None and r.status.code is None


def test_two_blocks_last_wins(spark):
    f = feed("<entry><id>a</id><x:ContractFolderStatus><cbc:ContractFolderID>1</cbc:ContractFolderID></x:ContractFolderStatus>"
             "<x:ContractFolderStatus><cbc:ContractFolderID>2</cbc:ContractFolderID></x:ContractFolderStatus></entry>")
    assert one(spark, f).contract_id == "2"


def test_empty_table_schema(spark):
    assert empty_entries(spark).count() == 0
    assert empty_entries(spark).schema == ENTRY_SCHEMA
    assert empty_entries(spark, True).schema == ENTRY_SCHEMA_RAW


def test_atom_fields_with_attributes_and_blanks(spark):
    f = feed('<entry><id>https://h/1</id><title type="text">T &amp; U</title>'
             '<summary type="text">Importe: 10 EUR</summary><updated>2024-01-01T10:00:00.000+01:00</updated>'
             '<link href="https://h/x?a=1&amp;b=2" rel="alternate"/></entry>'
             '<entry><id> https://h/2/ </id><title>  </title><summary></summary></entry>')
    rows = sorted(entries_of(spark, f).collect(), key=lambda r: r.id)
    assert [(r.id, r.title, r.summary, r.link) for r in rows] == [
        ("1", "T & U", "Importe: 10 EUR", "https://h/x?a=1&b=2"), ("2", None, None, None)]


def test_pruned_parse_matches_full_parse(spark):
    from tenderlake.operators.entries import to_entries
    from tenderlake.schema import BLOCK_MEMBERS_FOR
    from tenderlake.sources.xml_feed import cut_documents, parse_entries

    texts = cut_documents(spark.createDataFrame([(feed(BLOCK, "<entry><id>z</id></entry>").encode(),)], "content binary"))
    full = {r.id: r.asDict(recursive=True) for r in to_entries(parse_entries(texts)).collect()}
    for col in BLOCK_MEMBERS_FOR:
        part = to_entries(parse_entries(texts, columns=["id", col]), columns=["id", col]).select("id", col).collect()
        got = {d["id"]: d[col] for d in (x.asDict(recursive=True) for x in part)}
        assert got == {k: v[col] for k, v in full.items()}, col


def test_last_text_wins_over_empty_repeats(spark):
    f = feed("<entry><id>9</id><id/><title>A</title><title></title><summary>x</summary><summary>y</summary></entry>",
             "<entry><title/><title>only</title><id/></entry>")
    rows = sorted(entries_of(spark, f).collect(), key=lambda r: str(r.id))
    assert [(r.id, r.title, r.summary) for r in rows] == [("9", "A", "y"), (None, "only", None)]


def test_raw_block_is_the_last_one_with_or_without_prefix(spark):
    two = "<entry><id>a</id><p:ContractFolderStatus><c>1</c></p:ContractFolderStatus><ContractFolderStatus a='1'>2</ContractFolderStatus></entry>"
    assert one(spark, feed(two), keep_raw_xml=True).cfs_raw_xml == "<ContractFolderStatus a='1'>2</ContractFolderStatus>"
    assert one(spark, feed("<entry><id>a</id></entry>"), keep_raw_xml=True).cfs_raw_xml is None


def test_lot_ids_right_below_a_result(spark):
    f = feed("<entry><id>a</id><x:ContractFolderStatus><x:TenderResult><c:ProcurementProjectLotID>4</c:ProcurementProjectLotID>"
             "</x:TenderResult></x:ContractFolderStatus></entry>")
    assert [(t.result_id, t.result_lot_id) for t in one(spark, f).tender_results] == [("1", "4")]


def test_columns_not_parsed_are_not_returned(spark):
    from tenderlake.operators.entries import to_entries
    from tenderlake.sources.xml_feed import cut_documents, parse_entries

    texts = cut_documents(spark.createDataFrame([(feed(BLOCK).encode(),)], "content binary"))
    part = to_entries(parse_entries(texts, columns=["contract_id"]), columns=["contract_id"])
    assert part.columns == ["id", "title", "link", "summary", "updated", "contract_id"]


def test_raw_block_is_looked_for_once(spark):
    from pyspark.sql import functions as F

    from tenderlake.sources.xml_feed import RAW_BLOCK_PATTERN, raw_block

    name = "ContractFolderStatus"
    forms = [f"<entry><p:{name}><c:{name}Code>1</c:{name}Code></p:{name} >x</entry>", f"<entry><a><q.r:{name}\n a='1'>2</{name}></a></entry>", f"<entry><p:{name}/></entry>",
             f"<entry><p:{name}>1</p:{name}><q:{name}>2</q:{name}></entry>", f"<p:{name}>a</x>", f"</p:{name}><p:{name}>", f"<a:b:{name}>1</a:b:{name}>", f"<p:{name}>&lt;{name}><!-- <{name}> --></p:{name}>",
             f"<p:{name}>\nline\n<p:{name}>inner</p:{name}>tail</p:{name}>", "<entry/>", f"<p:{name} ></p:{name}\t><p:{name}x></p:{name}x>", None]
    rows = spark.createDataFrame([(t,) for t in forms], "t string")
    found = rows.select("t", raw_block(F.col("t")).alias("b"), F.regexp_extract("t", RAW_BLOCK_PATTERN, 1).alias("plain"))
    for r in found.collect():
        assert r.b == (r.plain or None), r.t
    assert found.select("b")._jdf.queryExecution().optimizedPlan().toString().count(r"[\s>].*?") == 1
