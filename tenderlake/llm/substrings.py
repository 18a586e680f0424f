"""Removal of long passages that occur more than once, by a compacted De Bruijn graph of word windows.

The graph's edges are the windows of ``WINDOW`` consecutive words, each joining the windows' first and last words but
one. It is never built window by window: neighbouring windows of a document that share the same smallest ``KMER``-word
hash (their anchor) form a path, and since the anchor depends on the words alone, the same passage falls into the same
paths wherever it stands. A path's occurrences with equal labels (a hash of all its words) compact into one edge with a
count. A path that occurs twice or more is repeated as a whole. Where an anchor has a single label there is no branch
and nothing else to do; where it has several, the paths that occur once are expanded into their windows, which are
counted against the windows of the other paths at that anchor. Source coordinates (a digest of the text, and word
positions) carry the verdicts back to the documents, whose words under any repeated window are removed.

Two paths are taken as equal if their 64-bit anchors, their 64-bit labels, lengths and anchor places agree. Counts are
aggregated before shuffles, and verdicts are kept by text, so very many copies of a text cost one row a task.

Edge cases: a null text has no words; a text shorter than a window loses nothing; all copies lose a repeated passage,
also the first; equal rows are copies of each other; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import by_value, written

WINDOW = 35
KMER = 8
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Documents that a task works on at once; bounds its memory.
SLICE = 512
_BLOCK = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SEPARATES = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
#: What is done with a path of a document: all of it goes, its windows are looked up, or it shows its windows to others.
WHOLE, CHECK, SHOW = 0, 1, 2


_tables = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the factor and of its inverse; kept and lengthened as needed."""
    if len(_tables[0]) <= n:
        for k, factor in enumerate((_FACTOR, _INVERSE)):
            _tables[k] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(2 * n, factor))), dtype=np.uint64)
    return _tables[0][: n + 1], _tables[1][: n + 1]


def prefix_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of items a to b is (sums[b] - sums[a]) * inverse[a]."""
    powers, inverse = _powers(len(hashes))
    return np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers[:-1], dtype=np.uint64))), inverse


def _block_hashes(block: np.ndarray) -> np.ndarray:
    apart = np.concatenate(([True], _SEPARATES[block], [True]))
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums, inverse = prefix_hashes(block.astype(np.uint64) + np.uint64(1))
    return _mixed((sums[ends] - sums[starts]) * inverse[starts] + _mixed((ends - starts).astype(np.uint64)))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word of a text, from running hashes of its bytes; in blocks, for bounded memory."""
    out, at = [], 0
    while at < len(data):
        gap = _GAP.search(data, at + _BLOCK)
        end = gap.start() if gap else len(data)
        out.append(_block_hashes(np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)))
        at = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def anchors(hashes: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-mer hashes, for each window the place of its first smallest k-mer)."""
    kmers = hashes
    done, factor = 1, int(_FACTOR)
    while done < kmer:  # doubled as far as possible, then lengthened by overlap
        step = min(done, kmer - done)
        kmers = kmers[:-step] * np.uint64(factor) + kmers[step:]
        factor = factor * factor % (1 << 64)
        done += step
    kmers = _mixed(kmers)
    span, done = window - kmer + 1, 1
    place = np.arange(len(kmers))
    while done < span:
        step = min(done, span - done)
        left, right = place[:-step], place[step:]
        place = np.where(kmers[right] < kmers[left], right, left)
        done += step
    return kmers, place


def paths(hashes: np.ndarray, window: int = WINDOW, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, label) of each path of a document's word hashes."""
    if len(hashes) < window:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    kmers, place = anchors(hashes, window, kmer)
    start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.append(start, len(place)))
    sums, inverse = prefix_hashes(hashes)
    label = (sums[start + count - 1 + window] - sums[start]) * inverse[start]
    shape = (place[start] - start).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64)
    label = _mixed(label ^ _mixed(shape + np.uint64(1)))
    return start, count, kmers[place[start]].astype(np.int64), label.astype(np.int64)


def windows(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    sums, inverse = prefix_hashes(hashes)
    at = np.arange(len(hashes) - window + 1)
    return _mixed((sums[at + window] - sums[at]) * inverse[at]).astype(np.int64)


def _data(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE]


def _keys(text: Column) -> list[Column]:
    """128 bits for a text, as two longs."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit("first"), t).alias("k1"), F.xxhash64(F.lit("second"), t, F.lit(2)).alias("k2")]


def _paths_of(window: int, kmer: int, coordinates: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _sliced(batches):
            got = [paths(word_hashes(_data(t)), window, kmer) for t in part["text"]]
            start, count, anchor, label = (np.concatenate(x) for x in zip(*got))
            out = {"anchor": anchor, "label": label}
            if coordinates:
                sizes = [len(x[0]) for x in got]
                out |= {"k1": np.repeat(part["k1"].to_numpy(), sizes), "k2": np.repeat(part["k2"].to_numpy(), sizes)}
                out |= {"start": start.astype(np.int32), "count": count.astype(np.int32)}
            yield pd.DataFrame(out)

    return run


def _kept(words: list[bytes], covered: np.ndarray) -> tuple[list[list[int]], str]:
    """Covered spans [start, end) and the digest of the other words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    left = b" ".join([w for w, c in zip(words, covered.tolist()) if not c]) if len(edge) else b" ".join(words)
    return edge.reshape(-1, 2).tolist(), hashlib.sha256(left).hexdigest()


_RESULT = "doc_id {id}, n_words long, spans array<array<int>>, kept_sha256 string"


def _first_pass(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _sliced(batches):
            rows = []
            for doc_id, k1, k2, text, start, count, kind, anchor, label in batch.itertuples(index=False, name=None):
                words = _data(text).split()
                covered = np.zeros(len(words), dtype=bool)
                if start is None or not len(start):
                    rows.append((doc_id, len(words), *_kept(words, covered), k1, k2, None, None, None, None, None, None))
                    continue
                for s, n in zip(start[kind == WHOLE].tolist(), count[kind == WHOLE].tolist()):
                    covered[s : s + n - 1 + window] = True
                spans, digest = _kept(words, covered)
                lookup = np.flatnonzero(kind != WHOLE)
                if not len(lookup):
                    rows.append((doc_id, len(words), spans, digest, k1, k2, None, None, None, None, None, None))
                    continue
                hashes = windows(word_hashes(_data(text)), window)
                at = np.concatenate([np.arange(start[i], start[i] + count[i]) for i in lookup])
                times = count[lookup]
                checks = bool((kind == CHECK).any())
                rows.append((doc_id, len(words), spans, digest, k1, k2, text if checks else None, at.astype(np.int32), hashes[at],
                             np.repeat(anchor[lookup], times), np.repeat(label[lookup], times), np.repeat(kind[lookup] == CHECK, times)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "spans", "kept_sha256", "k1", "k2", "text", "at", "hash", "anchor", "label", "check"])

    return run


def _second_pass(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _sliced(batches):
            rows = []
            for doc_id, text, spans, at in batch.itertuples(index=False, name=None):
                words = _data(text).split()
                covered = np.zeros(len(words), dtype=bool)
                for a, b in spans:
                    covered[a:b] = True
                for s in () if at is None else at:
                    covered[s : s + window] = True
                rows.append((doc_id, len(words), *_kept(words, covered)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "spans", "kept_sha256"])

    return run


def repeated_paths(spark: SparkSession, texts: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(k1, k2, start, count, kind, anchor, label) of the paths of ``texts`` (k1, k2, text) to remove, look up or show."""
    plain = texts.select("text").mapInPandas(_paths_of(window, kmer, False), "anchor long, label long")
    edges = plain.groupBy("anchor", "label").agg(F.count(F.lit(1)).alias("n"))
    # an anchor with one label does not branch
    per_anchor = edges.groupBy("anchor").agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("total")).where("total > 1")
    known = edges.join(per_anchor.select("anchor", "labels"), "anchor").select("anchor", "label", (F.col("n") > 1).alias("whole"), (F.col("labels") > 1).alias("branches"))
    known = written(spark, known, "paths")
    placed = texts.mapInPandas(_paths_of(window, kmer, True), "anchor long, label long, k1 long, k2 long, start int, count int")
    placed = written(spark, placed.join(known, ["anchor", "label"]), "placed-paths")
    where = ["k1", "k2", "start", "count"]
    own = placed.select(*where, F.when(F.col("whole"), WHOLE).otherwise(CHECK).alias("kind"), "anchor", "label")
    # of a path that occurs often at a branching anchor, one occurrence shows its windows
    shown = placed.where("whole and branches").groupBy("anchor", "label").agg(F.min(F.struct(*where)).alias("w"))
    return own.unionAll(shown.select("w.*", F.lit(SHOW).alias("kind"), "anchor", "label"))


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, spans (removed words, [start, end)) and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    result = _RESULT.format(id=docs.schema["doc_id"].dataType.simpleString())
    rows = docs.select("doc_id", *_keys(F.col("text")), "text")
    found = repeated_paths(spark, rows.select("k1", "k2", "text"), window, kmer)
    fields = ("start", "count", "kind", "anchor", "label")
    per_text = found.groupBy("k1", "k2").agg(F.collect_set(F.struct(*fields)).alias("p"))
    per_text = per_text.select("k1", "k2", *[F.col(f"p.{f}").alias(f) for f in fields])
    first = rows.join(per_text, ["k1", "k2"], "left").select("doc_id", "k1", "k2", "text", *fields)
    kinds = f"{result}, k1 long, k2 long, text string, at array<int>, hash array<long>, anchor array<long>, label array<long>, check array<boolean>"
    first = written(spark, first.mapInPandas(_first_pass(window), kinds), "first-pass")
    # windows at branching anchors: repeated if they stand in paths with different labels
    zipped = F.explode(F.arrays_zip("at", "hash", "anchor", "label", "check")).alias("w")
    looked = first.where("at is not null").select("k1", "k2", zipped).select("k1", "k2", "w.*")
    twice = looked.groupBy("anchor", "hash").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("anchor", "hash")
    hits = looked.where("check").join(twice, ["anchor", "hash"]).groupBy("k1", "k2").agg(F.collect_set("at").alias("at"))
    open_rows = first.where("text is not null").select("doc_id", "k1", "k2", "text", "spans").join(hits, ["k1", "k2"], "left")
    done = open_rows.select("doc_id", "text", "spans", "at").mapInPandas(_second_pass(window), result)
    return first.where("text is null").select("doc_id", "n_words", "spans", "kept_sha256").unionAll(done)


by_value(__name__)
