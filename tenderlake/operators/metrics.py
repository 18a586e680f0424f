"""Run metrics (A6, A8-A10, H9-H12) as small aggregates.

A run is summarised per group from per-item rows ``(group, bytes, seconds, error)``:
items processed and skipped, total size in MiB, elapsed time as ``HH:MM:SS``, throughput in
MiB/s (the size itself when no time elapsed), the number of errors and the first message.
Every aggregate is of constant size per group and aggregated before its shuffle. The messages
themselves stay rows; ``joined_errors`` joins them into rows of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions.scalars import format_duration, mb_from_bytes, round_two, throughput
from tenderlake.session import scratch_path

ERROR_SEPARATOR = "; "
#: Characters of joined messages in one row.
ERROR_CHARACTERS = 1 << 20


def files_by_period(files: DataFrame) -> DataFrame:
    """``(period, n_files, bytes)`` from a file listing ``(period, path, length)``."""
    return files.groupBy("period").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def summarize(items: DataFrame, group: str, bytes_col: str = "bytes", seconds_col: str = "seconds",
              skipped: Column | None = None, error: Column | None = None) -> DataFrame:
    """A8-A10 + H9-H12 per ``group``."""
    skipped = skipped if skipped is not None else F.lit(False)
    error = error if error is not None else F.lit(None).cast("string")
    g = items.groupBy(group).agg(
        F.count_if(~skipped).alias("processed"),
        F.count_if(skipped).alias("skipped"),
        F.sum(bytes_col).alias("total_bytes"),
        F.sum(seconds_col).alias("seconds"),
        F.count(error).alias("n_errors"),
        F.min(error).alias("first_error"),
    )
    mb = mb_from_bytes(F.col("total_bytes"))
    return g.select(
        group, "processed", "skipped", "total_bytes",
        round_two(mb).alias("size_mb"),
        format_duration(F.col("seconds")).alias("elapsed"),
        round_two(throughput(mb, F.col("seconds"))).alias("throughput_mb_s"),
        "n_errors", "first_error",
    )


def joined_errors(items: DataFrame, group: str, error_col: str = "error", limit: int = ERROR_CHARACTERS) -> DataFrame:
    """A10: ``(group, part, errors)``, the messages of each group joined with ``'; '``, in their order.

    A group's text is cut into numbered parts: a message belongs to the part in which it starts, at ``limit``
    characters a part, so no row holds more than that and one message. No group is read by one task either: the
    messages are dealt by ranges of (group, message), each range adds up its lengths, and where a range's part of a
    group starts follows from the few sums before it.
    """
    spark = items.sparkSession
    messages = items.where(F.col(error_col).isNotNull()).select(F.col(group).alias("g"), F.col(error_col).alias("m"), F.monotonically_increasing_id().alias("k"))
    path = scratch_path(spark, "messages")
    messages.repartitionByRange("g", "m", "k").withColumn("r", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(messages.withColumn("r", F.lit(0)).schema).parquet(path).withColumn("n", F.length("m") + F.lit(len(ERROR_SEPARATOR)))
    sums = ranged.groupBy("g", "r").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("g").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("g", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("g", "r").orderBy("m", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, ["g", "r"])
    part = F.floor((F.col("start") + F.col("at")) / F.lit(limit)).cast("long")
    parts = placed.withColumn("part", part).groupBy("g", "part").agg(F.array_sort(F.collect_list(F.struct("m", "k"))).alias("ms"))
    return parts.select(F.col("g").alias(group), "part", F.array_join("ms.m", ERROR_SEPARATOR).alias("errors"))


def directory_size(spark, path: str) -> DataFrame:
    """``(files, bytes)`` of everything below ``path``, any depth, from file metadata only.

    Files without content are not listed by the source, so they do not count among ``files``.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(path).select("length"))
    return listing.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
