"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the bytes cuts texts into chunks, so the same passage gives the same chunks in whichever document
it stands. Within a chunk, every blank that follows a visible ASCII character is a *sync point*: the vocabulary's
split pattern always begins a new piece there, whatever stands before or after. What lies between a chunk's first and
last sync point (its core) has therefore the same ids in every document and is encoded once; what lies around a chunk
join is re-encoded from the last sync point before it to the first after it, over as many chunks as that takes. There
both encodings agree, so the ids are exactly those of the whole text.

Chunks are counted over the whole corpus. The ``SHARED`` chunks that save the most bytes are encoded once, as a table,
and sent to the tasks (its size is bounded by ``SHARED`` * ``LONGEST``); all other chunks are encoded where they stand,
each once for a task's recent chunks. Either way the ids are the same; texts are never shuffled.

Edge cases: a null text is encoded as an empty one; a special token's text becomes its id, as the tokenizers library
does by default; repeated rows and extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm.common import by_value, per_worker, written

#: Fixed values of the public vocabulary: how it splits a text, and its special token.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}

WINDOW_DOUBLINGS = 5  # the rolling hash covers 2 ** 5 bytes
AVERAGE_BITS = 9  # a cut every 2 ** 9 bytes on average
LONGEST = 4096
SHARED = 16_384
RECENT = 4096
SLICE = 256
_BLOCK = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
#: Places where the vocabulary's pattern must split, whatever stands around them: before a blank or line break behind a
#: character that is no white space (of those that need several bytes, ranges without any), and between a full stop or
#: comma of East Asian scripts and a letter.
_SYNC = re.compile(
    rb"(?:(?<=[!-~])|(?<=[\xc3-\xdf][\x80-\xbf])|(?<=[\xe0\xe4-\xef][\x80-\xbf][\x80-\xbf])|(?<=\xe3[\x81-\xbf][\x80-\xbf])"
    rb"|(?<=[\xf0-\xf4][\x80-\xbf][\x80-\xbf][\x80-\xbf]))(?=[ \n])|(?:(?<=\xe3\x80\x82)|(?<=\xef\xbc\x8c))(?=[\xe5-\xe8])"
)
#: Bytes at a chunk's end that are searched for its last sync point before the rest.
_NEAR_END = 48


def vocabulary(path: str):
    """The encoding of a rank file, one for each worker process."""
    import tiktoken

    def load():
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=SPECIAL)

    return per_worker("vocabulary", path, load)


def cuts(data: bytes) -> list[int]:
    """Where chunks begin, without 0: after each place where the rolling hash's top bits are zero, and every LONGEST bytes at least."""
    span = 1 << WINDOW_DOUBLINGS
    found = []
    for at in range(0, max(len(data) - span, 0), _BLOCK):
        part = np.frombuffer(data, dtype=np.uint8, count=min(_BLOCK + span - 1, len(data) - at), offset=at)
        h = (part.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
        factor = _FACTOR
        for k in range(WINDOW_DOUBLINGS):
            step = 1 << k
            h = h[:-step] * np.uint64(factor) + h[step:]
            factor = factor * factor % (1 << 64)
        found.append(np.flatnonzero(h >> np.uint64(64 - AVERAGE_BITS) == 0) + (at + span))
    out: list[int] = []
    last = 0
    for cut in [*(np.concatenate(found).tolist() if found else []), len(data)]:
        while cut - last > LONGEST:
            last += LONGEST
            out.append(last)
        if cut < len(data) and cut > last:
            out.append(cut)
            last = cut
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], [*ends, len(data)])] if data else []


def parts(chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
    """(head, core, tail) around the first and the last sync point; None if there is none."""
    first = _SYNC.search(chunk, 1)
    if not first:
        return None
    a = b = first.start()
    for start in (max(a, len(chunk) - _NEAR_END), a):
        for last in _SYNC.finditer(chunk, start):
            b = last.start()
        if b > a or start == a:
            break
    return chunk[:a], chunk[a:b], chunk[b:]


def digest(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def plain_encoder(path: str) -> Callable[[bytes], list[int]]:
    vocab = vocabulary(path)

    def encode(data: bytes) -> list[int]:
        text = data.decode("utf-8")
        return vocab.encode(text, allowed_special="all") if "<|" in text else vocab.encode_ordinary(text)

    return encode


def encode_text(text: str | None, encode: Callable[[bytes], list[int]], known: dict[bytes, np.ndarray], recent: dict[bytes, list[int]]) -> np.ndarray:
    """Ids of a whole text from its chunks' cores and the re-encoded joins."""
    out: list = []
    carry: list[bytes] = []
    for chunk in chunks((text or "").encode("utf-8", "replace")):
        split = parts(chunk)
        if split is None:
            carry.append(chunk)
            continue
        head, core, tail = split
        if any(carry) or head:
            out.append(encode(b"".join([*carry, head])))
        if core:
            key = digest(core)
            ids = known.get(key)
            if ids is None:
                ids = recent.get(key)
            if ids is None:
                ids = encode(core)
                if len(recent) >= RECENT:
                    recent.clear()
                recent[key] = ids
            out.append(ids)
        carry = [tail]
    if any(carry):
        out.append(encode(b"".join(carry)))
    return np.concatenate([np.asarray(x, dtype=np.int32) for x in out]) if out else np.empty(0, dtype=np.int32)


def _cores(text: str | None) -> Iterator[bytes]:
    for chunk in chunks((text or "").encode("utf-8", "replace")):
        split = parts(chunk)
        if split and split[1]:
            yield split[1]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: dict[bytes, list[int]] = {}
        for text in batch["text"]:
            for core in _cores(text):
                n = seen.setdefault(digest(core), [0, len(core)])
                n[0] += 1
        if seen:
            yield pd.DataFrame([(k, n, size) for k, (n, size) in seen.items()], columns=["core", "n", "bytes"])


def shared_chunks(spark: SparkSession, docs: DataFrame, path: str, most: int = SHARED) -> DataFrame:
    """(core digest, ids) of the chunks whose repetition saves the most bytes, each encoded once."""
    counted = docs.select("text").mapInPandas(_counted, "core binary, n long, bytes long")
    repeated = counted.groupBy("core").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes")).where("n > 1")
    best = repeated.orderBy(F.desc(F.expr("(n - 1) * bytes")), "core").limit(most)
    wanted = spark.sparkContext.broadcast({bytes(r["core"]) for r in best.select("core").collect()})

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for batch in batches:
            got = {k: core for text in batch["text"] for core in _cores(text) if (k := digest(core)) in wanted.value and k not in seen}
            seen.update(got)
            if got:
                yield pd.DataFrame({"core": list(got), "data": list(got.values())})

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = plain_encoder(path)
        for batch in batches:
            yield pd.DataFrame({"core": batch["core"], "ids": [encode(x) for x in batch["data"]]})

    texts = docs.select("text").mapInPandas(taken, "core binary, data binary").groupBy("core").agg(F.min("data").alias("data"))
    return written(spark, texts.mapInPandas(encoded, "core binary, ids array<int>"), "bpe-chunks")


def encode(spark: SparkSession, docs: DataFrame, path: str, ids: str = "token_ids", decoded: str | None = None, most: int = SHARED) -> DataFrame:
    """``docs`` with the ids of its column ``text``, and with the text decoded from them if ``decoded`` names a column.

    Chunks that ``docs`` shares are encoded once. Rows leave a task in slices of ``SLICE``, which bounds its memory.
    """
    table = {bytes(r["core"]): np.array(r["ids"], dtype=np.int32) for r in shared_chunks(spark, docs, path, most).toLocalIterator()}
    known = spark.sparkContext.broadcast(table)
    place = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, vocab, recent = plain_encoder(path), vocabulary(path), {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = [encode_text(t, plain, known.value, recent) for t in part.column(place).to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
                out = [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))]
                if decoded:
                    out.append(pa.array([vocab.decode(x.tolist()) for x in rows], type=pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.mapInArrow(run, schema)


by_value(__name__)
