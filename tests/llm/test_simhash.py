import random
import re

import numpy as np
import pytest
import xxhash

from tenderlake.llm import simhash
from tenderlake.llm.components import components


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{index: smallest index reachable}"""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c", "É a ß b c d e a b c", "x\x0by\x0cz w " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_long_text_in_chunks(monkeypatch):
    rnd = random.Random(3)
    text = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(700))
    whole = brute_fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text) == whole


def test_bk_search_equals_brute_force():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base ^ np.uint64(1 << 9), base ^ np.uint64(3 << 40), base ^ np.uint64(7)]))
    tree = rng.integers(0, 3, len(values))
    _, tree = np.unique(tree, return_inverse=True)
    roots, child = simhash.bk_forest(values, tree)
    q, n = simhash.bk_search(values, child, values, roots[tree], 2)
    got = set(zip(q.tolist(), n.tolist()))
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if tree[i] == tree[j] and int(values[i] ^ values[j]).bit_count() <= 2}
    assert got == want


@pytest.mark.parametrize("shard", [8192, 64, 3])
def test_components_of_planted_prints(spark, shard):
    rnd = random.Random(11)
    prints = []
    for _ in range(30):
        fp = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            prints.append(fp)
            for bit in rnd.sample(range(64), rnd.randint(0, 4)):
                fp ^= 1 << bit
    prints += [0, 0, 3, (1 << 64) - 1]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.component_ids(spark, rows, shard=shard).collect()}
    assert [got[i] for i in range(len(prints))] == brute_components(prints)


@pytest.mark.parametrize("shard", [512, 40])
def test_no_link_is_lost_in_crowded_buckets(spark, shard):
    # a third of the prints agree on whole blocks, so their buckets are cut finer and dealt to several shards
    rnd = random.Random(23)
    prints = {rnd.getrandbits(64) for _ in range(600)}
    crowd = rnd.getrandbits(64)
    prints |= {crowd & ~(((1 << 14) - 1) << 30) | rnd.getrandbits(14) << 30 for _ in range(300)}
    prints |= {fp ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for fp in rnd.sample(sorted(prints), 200)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.component_ids(spark, rows, shard=shard).collect()}
    assert [got[i] for i in range(len(prints))] == brute_components(prints)


def test_components_of_a_chain_and_of_nothing(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in components(spark, df).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
    assert components(spark, df.limit(0)).count() == 0


SCHEMA = "doc_id long, text string, fp int, near_fp string"


def test_rows_null_empty_and_repeated(spark):
    long = "word tail end " * 3000
    rows = [(5, "a b c d", 1, "x"), (2, "A b C d", 1, None), (None, "a b c d", 1, None), (7, None, 1, None), (8, "", 1, None), (9, long, None, None), (9, long, None, None), (None, "alone here", 0, "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(spark, docs).collect()}
    assert len(got) == 7 and got[(7, 0)] == got[(8, 0)] == 7
    assert {v for (i, _), v in got.items() if i in (5, 2)} == {2}
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.near_fp or "") for r in kept.collect()) == [(-1, "y"), (2, ""), (7, ""), (9, "")]
    assert simhash.near_duplicates(spark, docs.limit(0)).count() == 0
    assert simhash.keep_one(spark, docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    from tenderlake.llm.queries import queries

    query = next(f for n, f in queries().items() if n.startswith("op1_"))
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [brute_fingerprint(docs[i]) for i in ids]
    comps = brute_components(prints)
    want = {(i, f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, comps)}
    assert {tuple(r) for r in query(spark, "/root/testdata/sf0.001").collect()} == want
