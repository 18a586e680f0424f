"""Helpers shared by the operators: reading, shared intermediate tables, names, bounded samples."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import scratch_path

#: Java pattern of what separates words: ASCII space and the control characters 9 to 13.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def by_value(module_name: str) -> None:
    """Send this module's functions to the executors with the task, so that they need no installed copy."""
    module = sys.modules[module_name]
    if isinstance(module, ModuleType):
        cloudpickle.register_pickle_by_value(module)


def per_worker(slot: str, key, make: Callable[[], Any]) -> Any:
    """``make()`` once for each Python worker process; a slot keeps the value of the last key only.

    Code that travels with the tasks is unpickled anew for each, so a cache in this module would be too.
    """
    held = sys.modules.setdefault("_tenderlake_worker", ModuleType("_tenderlake_worker")).__dict__
    if slot not in held or held[slot][0] != key:
        held[slot] = (key, make())
    return held[slot][1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a written table up to which it may be broadcast to a join.
SMALL_ROWS = 250_000


def few(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether a written table has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table with a broadcast hint if it has few rows; else as it is, for an ordinary join."""
    return F.broadcast(df) if few(df, rows) else df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the decimal doc_id modulo ``parts``; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def words(text: Column) -> Column:
    """The maximal runs of other characters than SEPARATORS; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def bounded_sample(rows: DataFrame, doc_id: str, bound: int) -> DataFrame:
    """All rows if there are at most ``bound``; else about ``bound`` of them, chosen by a hash of doc_id.

    The choice depends on doc_id and the number of rows only, so every run takes the same rows.
    """
    n = rows.count()
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id)), F.lit(1 << 30)) < int((1 << 30) * bound / n))


by_value(__name__)
