import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tenderlake.llm import substrings


def brute(texts, window):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if count[tuple(d[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["a", "b", "c", "É", "the", "of", "word\x00x"] + [f"w{i}" for i in range(40)]
    text = lambda n, v: " ".join(rnd.choice(v) for _ in range(n))
    texts = [None, "", "one", text(6, vocab), text(7, vocab), "same " * 60, "x y " * 40, "same " * 30]
    base = [text(rnd.randint(5, 120), vocab) for _ in range(25)]
    passage = text(30, vocab)
    for t in base:
        words = t.split()
        texts.append(t)
        texts += [t] * rnd.choice([0, 0, 1, 3])
        for _ in range(rnd.choice([0, 1, 2])):  # near copies
            copy = list(words)
            for _ in range(rnd.randint(1, 4)):
                copy[rnd.randrange(len(copy))] = "edit"
            texts.append("\n".join(copy))
        if rnd.random() < 0.5:
            cut = rnd.randrange(len(words))
            texts.append(" ".join([*words[:cut], passage, *words[cut:]]))
    return texts + [text(80, ["p", "q"]) for _ in range(5)]


@pytest.mark.parametrize("seed,window,kmer", [(1, 7, 3), (2, 12, 5), (3, 35, 8), (4, 8, 8)])
def test_equals_brute_force(spark, seed, window, kmer):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, anchor string")
    got = {r.doc_id: (r.n_words, sum(b - a for a, b in r.spans), r.kept_sha256) for r in substrings.remove_repeats(spark, docs, window, kmer).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_anchor_is_the_first_smallest():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 5, 300, dtype=np.uint64)
    kmers, place = substrings.anchors(hashes, 13, 4)
    assert len(kmers) == 297
    for i, p in enumerate(place):
        assert p == i + int(np.argmin(kmers[i : i + 10]))
    words = [tuple(hashes[i : i + 4]) for i in range(297)]
    same = {}
    for w, k in zip(words, kmers):
        assert same.setdefault(w, k) == k


def test_word_hashes_follow_the_words(monkeypatch):
    rnd = random.Random(5)
    texts = ["", " \n", "a", " a\tb ", "é a\x0bé", "ab a b ba aba", " ".join("xyz"[: rnd.randint(1, 3)] * rnd.randint(1, 9) for _ in range(3000))]
    for block in (substrings._BLOCK, 16):
        monkeypatch.setattr(substrings, "_BLOCK", block)
        known = {}
        for t in texts:
            words = t.encode().split()
            hashes = substrings.word_hashes(t.encode()).tolist()
            assert len(hashes) == len(words)
            assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes))
        assert len(set(known.values())) == len(known)


def test_null_and_repeated_ids(spark):
    long = " ".join(f"v{i}" for i in range(50))
    docs = spark.createDataFrame([(None, long), (None, long), (3, long + " more"), (3, "short"), (4, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, [list(x) for x in r.spans]) for r in substrings.remove_repeats(spark, docs).collect())
    assert got == [(0, 50, [[0, 50]]), (0, 50, [[0, 50]]), (3, 1, []), (3, 51, [[0, 50]]), (4, 0, [])]
    assert substrings.remove_repeats(spark, docs.limit(0)).count() == 0


def test_query(spark):
    from tenderlake.llm.queries import queries

    query = next(f for n, f in queries().items() if n.startswith("op10_"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = {(d.doc_id, *b) for d, b in zip(docs, brute([d.text for d in docs], 35))}
    assert {tuple(r) for r in query(spark, "/root/testdata/sf0.001").collect()} == want
