"""Repeat rules (concat / first / last) and small scalars on literal arrays."""

from pyspark.sql import functions as F

from tenderlake.functions.reduce import concat_values, first_non_empty, last_present
from tenderlake.functions.scalars import format_duration, id_from_url, local_name, mb_from_bytes, round_two


def _eval(spark, col, data, ddl="v array<string>"):
    df = spark.createDataFrame([(d,) for d in data], ddl)
    return [r[0] for r in df.select(col).collect()]


def test_concat_rule(spark):
    data = [["", "A", "", "B"], ["A", "B"], [""], None, [], ["A", ""], [None, "A"], ["A", None, "B"]]
    assert _eval(spark, concat_values(F.col("v")), data) == ["A__B", "A_B", "", None, None, "A_", "A", "A__B"]


def test_first_rule(spark):
    data = [["", "N"], ["N", "M"], [""], [], None, [None, "x"]]
    assert _eval(spark, first_non_empty(F.col("v")), data) == ["N", "N", "", None, None, "x"]


def test_last_rule(spark):
    data = [["a", None], [None, "a"], ["a", "b"], ["a", ""], [None], [], None]
    assert _eval(spark, last_present(F.col("v")), data) == ["a", "a", "b", "", None, None, None]


def test_id_from_url(spark):
    data = ["id1", "https://host/path/123/", "https://host/path/123", "/", "", None, "a//b//"]
    got = _eval(spark, id_from_url(F.col("v")), data, "v string")
    assert got == ["id1", "123", "123", "/", "", None, "b"]


def test_local_name(spark):
    assert _eval(spark, local_name(F.col("v")), ["cbc:ID", "ID", "a:b:C"], "v string") == ["ID", "ID", "C"]


def test_units(spark):
    df = spark.createDataFrame([(0, 0, 1.234), (61, 1048576, 1.235), (3661, 0, 2.0)], "s long, b long, x double")
    rows = df.select(format_duration(F.col("s")), mb_from_bytes(F.col("b")), round_two(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [("00:00:00", 0.0, 1.23), ("00:01:01", 1.0, 1.24), ("01:01:01", 0.0, 2.0)]
    assert df.select(format_duration(F.lit(100 * 3600))).first()[0] == "100:00:00"
