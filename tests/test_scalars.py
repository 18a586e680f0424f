"""Type aliases, names, file and member predicates."""

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S


def vals(spark, col, data):
    df = spark.createDataFrame([(d,) for d in data], "v string")
    return [r[0] for r in df.select(col).collect()]


def test_type_aliases(spark):
    data = ["mc", "MC", " minor-contracts ", "min", "pt", "pub", "public-tenders", "unknown", "", "\tMin\n"]
    assert vals(spark, S.procurement_type(F.col("v")), data) == (
        ["minor-contracts"] * 4 + ["public-tenders"] * 5 + ["minor-contracts"])
    assert vals(spark, S.is_known_type(F.col("v")), data) == [True] * 7 + [False, False, True]
    assert vals(spark, S.display_name(S.procurement_type(F.col("v"))), ["mc", "x"]) == ["Minor Contracts", "Public Tenders"]


def test_files_and_members(spark):
    assert vals(spark, S.is_feed_file(F.col("v")), ["a/b.XML", "c.atom", "d.txt", "e", "f.xml.bak"]) == [
        True, True, False, False, False]
    data = ["a.xml", "d/", "../a.xml", "a/../../b.xml", "a/./b/../c.xml", "/abs.xml", "C:/x.xml", "a/.."]
    assert vals(spark, S.is_safe_member(F.col("v")), data) == [True, False, False, False, True, False, False, False]
    assert vals(spark, S.archive_stem(F.col("v")), ["s3a://in/box/201911.zip"]) == ["201911"]
    assert vals(spark, S.period_from_archive_name(F.col("v")), ["x_2023_202301.zip", "x202301.zip", "a_b.zip"]) == [
        "202301", "", ""]
    assert vals(spark, S.url_path_last_segment(F.col("v")), ["https://e.com/a/b_1.zip?x=1#f"]) == ["b_1.zip"]
