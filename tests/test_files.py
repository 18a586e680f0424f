"""Discovery (S1), the text and strict scans (S2), ZIP archives (S3) and the table sink (K1-K5)."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.entries import to_entries
from tenderlake.sinks.table import read_entries, table_files, write_entries
from tenderlake.sources.archives import read_archive_entries
from tenderlake.sources.xml_feed import list_feed_files, malformed, parse_entries, read_entries_strict, read_entry_texts

FEED = ('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:x="urn:x" xmlns:cbc="urn:c">'
        '<title>f</title>{}</feed>')


def entry(i):
    return (f"<entry><id>https://h/{i}/</id><title>t{i}</title><x:ContractFolderStatus>"
            f"<cbc:ContractFolderID>C{i}</cbc:ContractFolderID></x:ContractFolderStatus></entry>")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def tree(root):
    write(f"{root}/202301/a.xml", FEED.format(entry(1) + entry(2)))
    write(f"{root}/202301/sub/deep/b.ATOM", FEED.format(entry(3)))
    write(f"{root}/202302/c.XML", FEED.format(entry(4)))
    write(f"{root}/202302/notes.txt", "ignored")
    write(f"{root}/202303/empty.xml", FEED.format(""))
    os.makedirs(f"{root}/202304", exist_ok=True)
    write(f"{root}/top.xml", FEED.format(entry(9)))


def test_discovery(spark, tmp_root):
    tree(tmp_root)
    got = sorted((r.period, os.path.basename(r.path)) for r in list_feed_files(spark, tmp_root).collect())
    assert got == [("202301", "a.xml"), ("202301", "b.ATOM"), ("202302", "c.XML"), ("202303", "empty.xml")]


def test_text_and_strict_scans_agree(spark, tmp_root):
    tree(tmp_root)
    a = to_entries(parse_entries(read_entry_texts(spark, tmp_root)), keep=["period"])
    b = to_entries(read_entries_strict(spark, tmp_root), keep=["period"])
    rows_a = sorted((r.period, r.id, r.contract_id) for r in a.collect())
    rows_b = sorted((r.period, r.id, r.contract_id) for r in b.collect())
    assert rows_a == rows_b == [("202301", "1", "C1"), ("202301", "2", "C2"), ("202301", "3", "C3"),
                                ("202302", "4", "C4")]
    only = read_entry_texts(spark, tmp_root, [f"{tmp_root}/202302"])
    assert [r.period for r in only.collect()] == ["202302"]


def test_archives(spark, tmp_root):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("dir/", "")
        zf.writestr("dir/feed.xml", FEED.format(entry(1) + entry(2)))
        zf.writestr("../evil.xml", FEED.format(entry(3)))
        zf.writestr("readme.txt", "x")
    os.makedirs(tmp_root, exist_ok=True)
    with open(f"{tmp_root}/202401.zip", "wb") as fh:
        fh.write(buf.getvalue())
    rows = read_archive_entries(spark, tmp_root).collect()
    assert sorted((r.period, r.member) for r in rows) == [("202401", "dir/feed.xml")] * 2


CUT = FEED.format(entry(1) + entry(2)).split("<title>t2")[0]


def test_roots_however_they_are_spelled(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/my root"
    write(f"{root}/202301/a.xml", FEED.format(entry(1)))
    write(f"{root}/2023 02/b.xml", FEED.format(entry(2)))
    for spelled in (root, f"file:{root}", f"file://{root}/", f"{tmp_root}/./my root", os.path.relpath(root)):
        assert {r.period for r in list_feed_files(spark, spelled).collect()} == {"202301", "2023 02"}
        assert {r.period for r in read_entry_texts(spark, spelled).collect()} == {"202301", "2023 02"}


def test_files_elsewhere_raise(spark, tmp_root):
    write(f"{tmp_root}/in/202301/a.xml", FEED.format(entry(1)))
    write(f"{tmp_root}/other/202301/a.xml", FEED.format(entry(1)))
    with pytest.raises(Exception, match="not below"):
        read_entry_texts(spark, f"{tmp_root}/in", [f"{tmp_root}/other/202301"]).collect()


def test_truncated_file_is_malformed_in_every_scan(spark, tmp_root):
    write(f"{tmp_root}/in/202301/a.xml", CUT)
    with zipfile.ZipFile(f"{tmp_root}/202301.zip", "w") as zf:
        zf.writestr("a.xml", CUT)
    texts = [read_entry_texts(spark, f"{tmp_root}/in"), read_archive_entries(spark, tmp_root)]
    for t in texts:
        parsed = parse_entries(t, mode="PERMISSIVE")
        assert sorted(r.bad for r in parsed.select(malformed(parsed.e).alias("bad")).collect()) == [False, True]
        with pytest.raises(Exception, match="(?i)malformed"):
            parse_entries(t).collect()
    strict = read_entries_strict(spark, f"{tmp_root}/in", mode="PERMISSIVE")
    assert any(r.e["_corrupt_record"] for r in strict.collect())
    with pytest.raises(Exception, match="(?i)malformed"):
        read_entries_strict(spark, f"{tmp_root}/in").collect()


def test_archives_by_member_and_period(spark, tmp_root):
    for period in ("202401", "202402"):
        with zipfile.ZipFile(f"{tmp_root}/{period}.zip", "w") as zf:
            for k in range(3):
                zf.writestr(f"part {k}.xml", FEED.format(entry(k)))
    df = read_archive_entries(spark, tmp_root, periods=["202402"])
    assert sorted((r.period, r.member) for r in df.collect()) == [("202402", f"part {k}.xml") for k in range(3)]


def test_sink_overwrite_and_compaction(spark, tmp_root):
    tree(tmp_root)
    e = to_entries(parse_entries(read_entry_texts(spark, tmp_root)), keep=["period"]).withColumn(
        "procurement_type", F.lit("public-tenders"))
    out = f"{tmp_root}/out"
    write_entries(e, out, max_records_per_file=1)
    assert table_files(spark, out).where("period = '202301'").count() == 3
    # second run with only 202302 replaces that period, keeps 202301
    write_entries(e.where("period = '202302'").withColumn("title", F.lit("new")), out, compact=True)
    t = read_entries(spark, out)
    assert dict(t.groupBy("period").count().collect()) == {"202301": 3, "202302": 1}
    assert [r.title for r in t.where("period = '202302'").collect()] == ["new"]
    assert dict(t.schema.fields[-1].jsonValue()).get("type") == "string"
    assert table_files(spark, out).where("period = '202302'").count() == 1


def test_directory_size(spark, tmp_root):
    from tenderlake.operators.metrics import directory_size

    for name, text in (("y2020/one.bin", "abc"), ("y2020/q1/two.bin", "defgh"), ("three.bin", "i"), ("empty.bin", "")):
        write(f"{tmp_root}/store/{name}", text)
    r = directory_size(spark, f"{tmp_root}/store").first()
    assert (r.files, r.bytes) == (3, 9)  # files without content are not listed


def test_compaction_splits_a_hot_period(spark, tmp_root):
    """A period with most of the rows is spread over several files, nothing is lost."""
    n = 20000
    text = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 256) for k in range(3)])
    df = spark.range(n).select(
        F.col("id").cast("string").alias("id"), text.alias("title"),
        F.when(F.col("id") % 10 == 0, F.lit("202301")).otherwise(F.lit("202302")).alias("period"),
        F.lit("public-tenders").alias("procurement_type"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        out = f"{tmp_root}/hot"
        write_entries(df, out, compact=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = dict(table_files(spark, out).groupBy("period").count().collect())
    assert files["202302"] > 1
    back = spark.read.parquet(out)
    assert back.count() == n and back.where("period = '202302'").count() == n - n // 10
