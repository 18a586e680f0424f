"""SimHash near-duplicates, found with BK-trees.

A document's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it. Two fingerprints
link if they differ in at most ``radius`` bits; a document's component is everything reachable over links.

Fingerprints are first brought together in *buckets*. The 64 bits are cut into ``radius + 1`` blocks, and two
fingerprints within the radius agree on at least one whole block, so some bits of each block are a bucket key and every
link lies inside some bucket. As many bits are taken as leave a quarter to a half of ``SHARD`` fingerprints in a bucket on
average (none, and one bucket, for few fingerprints), so that trees have thousands of nodes at every size of the input.
A bucket of more than ``SHARD`` is cut finer: its fingerprints agree on the whole block and on one of ``radius + 1``
parts of the other bits. What is still larger is dealt to shards by a hash. A shard's fingerprints form a BK-tree: a node's children are keyed by their
integer Hamming distance to it. Each shard's tree is sent to every block of queries of its own bucket, bounded
by the shard size on both sides, and a query at distance d from a node follows only the edges d - radius to
d + radius. Inside a task all trees of a batch are searched side by side with arrays, some queries at a time. Each block yields one link
per fingerprint, to the smallest it is connected with there, never all pairs.

Edge cases: null and empty texts have fingerprint 0 and link like others; a text of fewer words than a shingle is
hashed whole; equal texts share a fingerprint and so a component; null doc_ids take part but never name a component
that has a doc_id; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import by_value, fresh, written
from tenderlake.llm.components import components

SHINGLE = 3
RADIUS = 2
SHARD = 8192
SEED = 42
_CHUNK = 1 << 16
#: Queries that are led through the trees at once.
_ASKED = 1 << 11


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer; A-Z are lower-cased, words are split at ASCII white space."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):  # bounded memory for very long texts
        part = words[at : min(at + _CHUNK, n) + shingle - 1]
        m = max(len(part) - shingle + 1, 1)
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = [0, *(ends[: m - 1] + 1).tolist()]
        stops = ends[min(shingle, len(part)) - 1 :].tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), dtype="<u8", count=m)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed 64-bit value."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).astype(np.int64))

    return of(text)


def bk_forest(values: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees over unsigned values; ``tree`` numbers each value's tree. (root of each tree, child by node and distance.)

    Same trees as inserting the values one after the other: of the values that reach a free edge, the first becomes
    the child and the others go on from it.
    """
    n = len(values)
    child = np.full((n, 65), -1, dtype=np.int32)
    _, roots = np.unique(tree, return_index=True)
    at = roots[tree].astype(np.int64)
    pending = np.flatnonzero(at != np.arange(n))
    at = at[pending]
    while len(pending):
        edge = at * 65 + np.bitwise_count(values[pending] ^ values[at])
        _, first, which = np.unique(edge, return_index=True, return_inverse=True)
        child.reshape(-1)[edge[first]] = pending[first]
        at = pending[first][which]
        rest = at != pending
        pending, at = pending[rest], at[rest]
    return roots, child


def bk_search(values: np.ndarray, child: np.ndarray, queries: np.ndarray, start: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all nodes within the radius of each query, from its root; edges outside the radius are not followed."""
    found_q, found_n = [], []
    q, node = np.arange(len(queries)), start.astype(np.int64)
    while len(q):
        d = np.bitwise_count(queries[q] ^ values[node]).astype(np.int64)
        hit = d <= radius
        found_q.append(q[hit])
        found_n.append(node[hit])
        next_q, next_n = [], []
        for off in range(-radius, radius + 1):
            edge = d + off
            inside = (edge >= 0) & (edge <= 64)
            to = child[node[inside], edge[inside]]
            there = to >= 0
            next_q.append(q[inside][there])
            next_n.append(to[there].astype(np.int64))
        q, node = np.concatenate(next_q), np.concatenate(next_n)
    return (np.concatenate(found_q), np.concatenate(found_n)) if found_q else (q, node)


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index connected with each of 0..n-1 over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _block_links(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links of whole query blocks: rows of (key columns, query, fp), sorted by the key columns."""
    block = rows.groupby(["pair", "key", "tree", "block"], sort=False).ngroup().to_numpy()
    fp = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    asks = rows["asks"].to_numpy(dtype=bool)
    nodes = np.flatnonzero(~asks)
    if not len(nodes):
        return pd.DataFrame({"a": [], "b": []})
    _, tree = np.unique(block[nodes], return_inverse=True)
    roots, child = bk_forest(fp[nodes], tree)
    root_of = np.full(int(block.max()) + 1, -1, dtype=np.int64)
    root_of[block[nodes[roots]]] = roots
    # a block's own shard asks itself; other shards bring their queries along
    has_asks = np.zeros(len(root_of), dtype=bool)
    has_asks[block[asks]] = True
    queries = np.flatnonzero((asks | ~has_asks[block]) & (root_of[block] >= 0))
    found = [(queries[:0], queries[:0])]
    for at in range(0, len(queries), _ASKED):
        some = queries[at : at + _ASKED]
        q, node = bk_search(fp[nodes], child, fp[some], root_of[block[some]], radius)
        found.append((q + at, node))
    q, node = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(fp, kind="stable")
    rank = np.empty(len(fp), dtype=np.int64)
    rank[order] = np.arange(len(fp))
    least = _smallest(len(fp), rank[queries[q]], rank[nodes[node]])
    moved = np.flatnonzero(least != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[order[moved]].view(np.int64), "b": fp[order[least[moved]]].view(np.int64)})


def _linked(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the last, perhaps unfinished, block
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["pair", "key", "tree", "block"]].to_numpy()
            last = (keys == keys[-1]).all(axis=1)
            done = int(len(batch) - np.argmin(last[::-1])) if not last.all() else 0
            if done or (held and (held[-1][["pair", "key", "tree", "block"]].iloc[-1].to_numpy() != keys[0]).any()):
                yield _block_links(pd.concat([*held, batch.iloc[:done]], ignore_index=True), radius)
                held = []
            held.append(batch.iloc[done:])
        if held:
            yield _block_links(pd.concat(held, ignore_index=True), radius)

    return run


def _key(number: int, bits: Sequence[int]) -> Column:
    """A bucket key: the fingerprint at these bits, with a number for the choice of bits."""
    mask = sum(1 << b for b in bits)
    signed = mask - (1 << 64) if mask >> 63 else mask
    return F.struct(F.lit(number).alias("pair"), F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("key"))


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all within the radius."""
    blocks = [range(64 * k // (radius + 1), 64 * (k + 1) // (radius + 1)) for k in range(radius + 1)]
    n_bits = min(len(blocks[0]), max(0, math.ceil(math.log2(max(2 * prints.count() / shard, 1)))))
    coarse = [_key(k, block[:n_bits]) for k, block in enumerate(blocks)] if n_bits else [_key(0, [])]
    keyed = prints.select("fp", F.explode(F.array(*coarse)).alias("k")).select("fp", "k.pair", "k.key")
    sizes = keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = F.array(F.struct("pair", "key"))
    for k, block in enumerate(blocks):
        others = [x for x in range(64) if x not in block]
        parts = [others[len(others) * j // (radius + 1) : len(others) * (j + 1) // (radius + 1)] for j in range(radius + 1)]
        finer = [_key((k + 1) * (radius + 1) + j, [*block, *part]) for j, part in enumerate(parts)]
        keys = F.when((F.col("n") > shard) & (F.col("pair") == k), F.array(*finer)).otherwise(keys)
    keyed = keyed.join(sizes, ["pair", "key"]).select("fp", F.explode(keys).alias("k")).select("fp", "k.pair", "k.key")
    sizes = keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / shard).cast("int")
    dealt = keyed.join(sizes, ["pair", "key"]).select(
        "pair", "key", "fp", shards.alias("shards"), F.pmod(F.xxhash64("fp", F.lit("shard")), shards).cast("int").alias("own")
    )
    # the own shard is a node of its tree in every block of queries (blocks 0..own), and asks the trees after its own
    node = F.transform(F.sequence(F.lit(0), F.col("own")), lambda b: F.struct(F.col("own").alias("tree"), b.alias("block"), F.lit(False).alias("asks")))
    ask = F.when(
        F.col("own") + 1 < F.col("shards"),
        F.transform(F.sequence(F.col("own") + 1, F.col("shards") - 1), lambda t: F.struct(t.alias("tree"), F.col("own").alias("block"), F.lit(True).alias("asks"))),
    ).otherwise(F.array().cast("array<struct<tree:int,block:int,asks:boolean>>"))
    rows = dealt.select("pair", "key", "fp", F.explode(F.concat(node, ask)).alias("r")).select("pair", "key", "r.tree", "r.block", "r.asks", "fp")
    dealt_out = rows.repartition("pair", "key", "tree", "block").sortWithinPartitions("pair", "key", "tree", "block", "fp")
    return dealt_out.mapInPandas(_linked(radius), "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of ``docs`` (doc_id, text)."""
    rows = written(spark, docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    return component_ids(spark, rows, radius, shard)


def component_ids(spark: SparkSession, rows: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """``rows`` (doc_id, fp) with component_id, the smallest doc_id that can be reached."""
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(spark, links(firsts.select("fp"), radius, shard)).withColumnsRenamed({"node": "fp", "root": "root"})
    rooted = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near duplicates (the smallest doc_id; of equal doc_ids any one row), columns unchanged.

    Groups without any doc_id keep one row as well.
    """
    fp, row, root = (fresh(docs, x) for x in ("near_fp", "near_row", "near_root"))
    prints = docs.withColumn(fp, fingerprint_column(F.col("text"), shingle)).withColumn(row, F.xxhash64(*docs.columns))
    rows = written(spark, prints, "simhash-docs")
    roots = components(spark, links(rows.select(F.col(fp).alias("fp")).distinct(), radius)).select(F.col("node").alias(fp), F.col("root").alias(root))
    # the winner of each fingerprint, then of each group: by doc_id and the hash of the whole row
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    best = rows.groupBy(fp).agg(F.min(rank).alias("w")).join(roots, fp, "left").groupBy(F.coalesce(root, fp).alias("group")).agg(F.min("w").alias("w"))
    # joined by fingerprint and row, so that a large group's rows spread; a group has one such pair, and of rows equal
    # in every column one stays
    kept = rows.join(best.select(F.col("w.fp").alias(fp), F.col("w.row").alias(row)), [fp, row])
    return kept.dropDuplicates([fp, row]).select(*docs.columns)


by_value(__name__)
