"""Sharding by Karmarkar-Karp differencing: groups of equal texts go to shards of near-equal bytes.

A group of equal texts is indivisible. Its bytes are the sum over its rows of the UTF-8 bytes of the
text plus ``ROW_OVERHEAD``. Differencing runs over *items*: every group of at least 1/(shards * FINE)
of all bytes is an item of its own (so there are at most shards * FINE of these), and the lighter groups
are bundled by a hash of their text into ``shards * FINE`` items. The number of items is thus at most
2 * shards * FINE whatever the size of the input. Differencing then keeps a heap of partial partitions,
each a vector of one load per shard: the two with the largest spread are combined, the largest load of
one meeting the smallest of the other, until one partition is left.

Edge cases: a null text counts as an empty one (16 bytes) and is grouped with it; fewer groups than shards leave
shards empty; an empty table gives no rows; rows with equal or null doc_ids are rows like others; only doc_id
and text are read, so extra columns do not matter. Ties are broken by the item's name, so any run gives the
same shards.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import text_key, written

ROW_OVERHEAD = 16
#: Items per shard of either kind: bounds what the driver differences and what is broadcast.
FINE = 128
#: Slots are numbered in so many parts of each shard, so no task sorts a whole shard.
SLOT_PARTS = 1024


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item by largest differencing over ``shards`` ways."""
    if not sizes:
        return []
    heap: list[tuple[int, int, np.ndarray, list[list[int]]]] = []
    for i, size in enumerate(sizes):
        loads = np.zeros(shards, dtype=np.int64)
        loads[0] = size
        heap.append((-size, i, loads, [[i]] + [[] for _ in range(shards - 1)]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a, own = heapq.heappop(heap)
        _, _, b, other = heapq.heappop(heap)
        # a is kept in falling order, b joins it in rising order
        loads = a + b[::-1]
        merged = []
        for x, y in zip(own, reversed(other), strict=True):
            if len(x) < len(y):
                x, y = y, x
            x.extend(y)
            merged.append(x)
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), tie, loads, [merged[k] for k in order]))
    out = [0] * len(sizes)
    for shard, members in enumerate(heap[0][3]):
        for i in members:
            out[i] = shard
    return out


def _bundle(key: Column, bundles: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bundle"), key), F.lit(bundles)).cast("int")


def shard(spark: SparkSession, docs: DataFrame, shards: int = 40, fine: int = FINE, slot_parts: int = SLOT_PARTS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and text_key (equal for equal texts) of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        spark,
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            text_key(F.col("text")).alias("text_key"),
        ),
        "shard-rows",
    )
    bundles = shards * fine
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    heavy = F.col("bytes") * bundles >= F.lit(total)
    items = (
        groups.select(
            F.when(heavy, F.col("text_key")).alias("own"),
            F.when(heavy, F.lit(-1)).otherwise(_bundle(F.col("text_key"), bundles)).alias("bundle"),
            "bytes",
        )
        .groupBy("own", "bundle")
        .agg(F.sum("bytes").alias("bytes"))
    )
    found = sorted(((r["bytes"], bytes(r["own"] or b""), r["bundle"]) for r in items.toLocalIterator()), key=lambda x: (-x[0], x[1], x[2]))
    to = difference([b for b, _, _ in found], shards)
    own = spark.createDataFrame([(k, s) for (_, k, n), s in zip(found, to, strict=True) if n < 0], "text_key binary, own_shard int")
    bundled = spark.createDataFrame([(n, s) for (_, _, n), s in zip(found, to, strict=True) if n >= 0], "bundle int, bundle_shard int")
    placed = (
        rows.join(F.broadcast(own), "text_key", "left")
        .withColumn("bundle", _bundle(F.col("text_key"), bundles))
        .join(F.broadcast(bundled), "bundle", "left")
        .select(
            "doc_id", "size", "text_crc32", "text_key",
            F.coalesce("own_shard", "bundle_shard").alias("shard"),
            F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(slot_parts)).cast("int").alias("part"),
        )
    )
    # slots: a number within each part of a shard, after the rows of the parts before it
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_key")
    return (
        placed.withColumn("nth", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth")).cast("long").alias("slot"), "text_key")
    )
