"""Stand-in feed files: gzipped, of bounded size, written without a shuffle of texts; scans of gzipped files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from tenderlake.plans import feed_files
from tenderlake.sources.xml_feed import GZIP_GLOB, list_feed_files, malformed, parse_entries, read_entries_strict, read_entry_texts

N = 600


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feed"))
    rows = spark.range(N).select("id", F.concat(F.lit("20230"), (F.col("id") % 2 + 1).cast("string")).alias("period"))
    text = F.concat(F.lit("<entry><id>"), F.col("id").cast("string"), F.lit("</id><title>"), F.repeat(F.lit("same "), F.lit(400)), F.lit("</title></entry>"))
    writes = feed_files.write_feed(rows, text, root)
    manifest = writes.collect()
    return root, writes._jdf.queryExecution().toString(), manifest


def test_feed_files_are_compressed_and_whole(spark, feed):
    root, _, manifest = feed
    assert sum(r.n_entries for r in manifest) == N
    assert sum(os.path.getsize(f"{root}/{r.file}") for r in manifest) * 10 < sum(r.bytes for r in manifest)
    assert list_feed_files(spark, root, glob=GZIP_GLOB).count() == len(manifest) and list_feed_files(spark, root).count() == 0
    for found in (parse_entries(read_entry_texts(spark, root, glob=GZIP_GLOB)), read_entries_strict(spark, root, glob=GZIP_GLOB)):
        assert sorted((int(r.id), r.period) for r in found.select(F.col("e.id")[0].alias("id"), "period").collect()) == [(k, f"20230{k % 2 + 1}") for k in range(N)]


def test_texts_are_neither_shuffled_nor_sorted(feed):
    plan = feed[1].split("== Physical Plan ==")[1]
    assert "Exchange" not in plan
    assert plan.index("entry_xml") < plan.index("Sort [period")   # read upwards: the text is made after the sort


def test_a_file_ends_at_its_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_files, "FILE_BYTES", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = spark.range(0, 100, 1, 1).select("id", F.lit("202301").alias("period"))
        text = F.concat(F.lit("<entry><id>"), F.col("id").cast("string"), F.lit("</id><title>"), F.repeat(F.lit("x"), F.lit(100)), F.lit("</title></entry>"))
        files = feed_files.write_feed(rows, text, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r.file for r in files}) == 10 and sum(r.n_entries for r in files) == 100
    assert read_entry_texts(spark, str(tmp_path), glob=GZIP_GLOB).count() == 100


def test_gzipped_file_cut_short(spark, tmp_path):
    entries = "".join(f"<entry><id>{k}</id></entry>" for k in range(3))
    os.makedirs(f"{tmp_path}/202301")
    with gzip.open(f"{tmp_path}/202301/a.xml.gz", "wt") as f:
        f.write(f"<feed>{entries}<entry><id>3</id><title>left")
    e = parse_entries(read_entry_texts(spark, str(tmp_path), glob=GZIP_GLOB), mode="PERMISSIVE")
    assert e.where(~malformed(F.col("e"))).count() == 3
    assert [r.entry_xml for r in e.where(malformed(F.col("e"))).collect()] == ["<entry><id>3</id><title>left"]


def test_both_feeds_come_from_one_shuffle_of_the_tables(spark, tmp_path, monkeypatch):
    tables = {
        "orders": """SELECT id AS o_orderkey, id % 3 AS o_custkey, element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus, 1.5D AS o_totalprice,
            timestamp'1995-01-01' + make_interval(0, CAST(id % 4 AS INT)) AS o_orderdate, if(id % 2 = 0, '5-LOW', '1-URGENT') AS o_orderpriority FROM range(24)""",
        "lineitem": """SELECT id % 20 AS l_orderkey, id AS l_partkey, id AS l_suppkey, CAST(id AS INT) AS l_linenumber, 2.0D AS l_quantity, 3.0D AS l_extendedprice,
            if(id % 2 = 0, 'R', 'N') AS l_returnflag, 'O' AS l_linestatus, timestamp'1995-02-01' AS l_shipdate FROM range(60)""",
        "customer": "SELECT id AS c_custkey, 'c' || id AS c_name, CAST(id AS INT) AS c_nationkey, 'BUILDING' AS c_mktsegment FROM range(2)",
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, 'n' || id AS n_name, 1 AS n_regionkey FROM range(1)"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    reads, entry_rows = [], feed_files.entry_rows
    monkeypatch.setattr(feed_files, "entry_rows", lambda *a: reads.append(a) or entry_rows(*a))
    both = feed_files.feed_roots(spark, str(tmp_path))
    assert len(reads) == 1 and feed_files.feed_roots(spark, str(tmp_path)) == both and len(reads) == 1
    monkeypatch.setattr(feed_files, "_MEMO", {})
    alone = feed_files.feed_root(spark, str(tmp_path)), feed_files.feed_root(spark, str(tmp_path), omit_atom=True)
    texts = [sorted((r.period, r.entry_xml) for r in read_entry_texts(spark, root, glob=GZIP_GLOB).collect()) for root in both + alone]
    assert [len(t) for t in texts] == [24] * 4 and texts[0] == texts[2] != texts[1] == texts[3]


ODD = {
    "orders": """SELECT * FROM VALUES (1L, 7L, 'F', 10.005D, timestamp'1995-01-31', '5-LOW'), (2L, null, null, null, timestamp'1995-02-01', null), (3L, 8L, 'P', 1D, null, '1<2')
        AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""",
    "lineitem": """SELECT * FROM VALUES (1L, 5L, 6L, 2, 1D, 2.5D, 'R', 'O', timestamp'1995-03-01'), (1L, 4L, 6L, 1, 1D, 2.5D, null, null, timestamp'1995-03-02'),
        (1L, 9L, null, null, null, 3D, 'R', 'F', null) AS t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate)""",
    "customer": "SELECT 7L AS c_custkey, 'A & \"B\"' AS c_name, 1 AS c_nationkey, 'S>T' AS c_mktsegment",
    "nation": "SELECT 1 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey"}


def test_entries_are_made_where_they_are_written(spark, tmp_path):
    for name, sql in ODD.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    writes = feed_files.write_entry_feed(feed_files.entry_rows(spark, str(tmp_path)), f"{tmp_path}/feed", omit_atom=True, broken=F.col("o_orderkey") == 2)
    assert writes.collect() and "<entry>" not in writes._jdf.queryExecution().toString()   # no text is made in SQL
    got = {r.period: r.entry_xml for r in read_entry_texts(spark, f"{tmp_path}/feed", glob=GZIP_GLOB).collect()}
    assert set(got) == {"199501", "199502"}   # none without a period
    one, two = got["199501"], got["199502"]
    assert one.startswith('<entry><link href="https://host/o/1/v1"/><link/><link href="https://host/o/1"/><summary>Order 1 &amp; A &amp; &quot;B&quot;</summary>'
                          "<title>5-LOW</title><updated>1995-01-31</updated><cac-place-ext:ContractFolderStatus>")
    assert '<cbc:TotalAmount currencyID="EUR">10.01</cbc:TotalAmount><cbc:TaxExclusiveAmount>8.00</cbc:TaxExclusiveAmount>' in one and ">S&gt;T<" in one
    lots = [lot.split('schemeName="ID_PARTIDA">')[1].split("<")[0] for lot in one.split("<cac:ProcurementProjectLot>")[1:]]
    assert lots == ["9", "4", "5"]   # by line number, nulls first
    assert '<cbc:ItemClassificationCode/><cbc:ItemClassificationCode listURI="https://codes/part">9</cbc:ItemClassificationCode></cac:Required' in one
    first, second = one.split("<cac:TenderResult>")[1:]
    assert first.startswith("<cbc:Description>1 lines</cbc:Description><cac:WinningParty><cac:PartyName></cac:PartyName></cac:WinningParty>")
    assert "<cbc:Description>2 lines</cbc:Description>" in second and "<cbc:ProcurementProjectLotID>2</cbc:ProcurementProjectLotID><cbc:ProcurementProjectLotID/>" in second
    assert two.startswith('<entry><id>https://host/o/2/</id>') and "<summary>Order 2 &amp; </summary><updated>" in two and "TenderResult" not in two
