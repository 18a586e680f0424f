import itertools
import random
import re

import pytest

from tenderlake.llm import decontaminate as dc
from tenderlake.llm.common import small


def tokens(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(docs, items):
    """Pairs that have a stretch of equal enough words that holds a mask's hit."""
    out = set()
    for d, dt in docs:
        dw = tokens(dt)
        for i, it in items:
            iw = tokens(it)
            n = min(dc.OVERLAP, len(iw))
            for mask in dc.MASKS:
                ones = [k for k, c in enumerate(mask) if c == "1"]
                for a in range(len(dw) - len(mask) + 1):
                    for b in range(len(iw) - len(mask) + 1):
                        if all(dw[a + k] == iw[b + k] for k in ones):
                            for s in range(max(0, b - a, b + len(mask) - n), min(b, len(iw) - n, len(dw) - (a - b) - n) + 1):
                                same = sum(iw[s + j] == dw[s + j + a - b] for j in range(n))
                                if same >= -(-n * dc.SIMILAR * 1000 // 1000) - 1e-9:
                                    out.add((d, i))
    return out


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([40, 25, 13, 9, 8, 7, 3, 60])] + [(8, None), (9, "")]
    docs = [(0, None), (1, ""), (2, "word " * 3000)]
    for k in range(40):
        item = items[k % 8][1].split()
        part = list(item)
        for _ in range(k % 4):
            part[rnd.randrange(len(part))] = "other"
        if k % 5 == 4:
            part = part[: max(10, len(part) // 2)]
        docs.append((10 + k, ", ".join(text(30)) + ". " + " ".join(part).upper() + "; " + " ".join(text(20))))
    docs += [(100 + k, " ".join(text(80))) for k in range(10)]
    return docs, items


@pytest.mark.parametrize("block", [1_000_000, 100])
def test_equals_brute_force(spark, planted, block):
    docs, items = planted
    got = dc.leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"), block=block).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items) and len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert not any(r.doc_id >= 100 for r in got) and all(0 < r.equal_words <= r.item_words for r in got)


@pytest.mark.parametrize("bound", [250_000, 0])
def test_odd_rows(spark, planted, bound, monkeypatch):
    monkeypatch.setattr(dc, "small", lambda df: small(df, bound))  # broadcast or not
    docs, items = planted
    leak = docs[3][1]
    rows = [(None, leak, "k"), (1, leak, "k"), (1, leak, None), (2, "clean words here", "k"), (None, None, None), (5, "", "k")]
    mine = spark.createDataFrame(rows, "doc_id int, text string, leak_key string")
    theirs = spark.createDataFrame(items * 2, "item_id int, text string")
    kept = dc.drop_leaks(spark, mine, theirs)
    assert kept.columns == mine.columns and sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (2, "clean words here"), (5, "")]
    assert dc.leaks(mine.limit(0), theirs).count() == dc.leaks(mine, theirs.limit(0)).count() == 0
    assert {r.item_id for r in dc.leaks(mine, theirs).collect()} == {0}


def test_query(spark):
    from tenderlake.llm.queries import op6_spaced_seed_leaks

    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: " ".join(tokens(r.text)) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    items = {r.item_id: " ".join(tokens(r.text)) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()}
    want = {(i, j) for i, t in docs.items() for j, x in items.items() if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in op6_spaced_seed_leaks(spark, d).collect()}
    assert want and want <= got and len(got) <= len(want) + 2


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_short_items_against_brute_force_without_masks(spark, block):
    """Every place of the allowed substitutions, and of one more, in items of 1 to 13 words and more."""
    from itertools import combinations

    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in [*range(1, 14), 40]]
    docs = [(None, None), (-1, "")]
    for n, text in items[:-1]:
        allowed = n - -(-8 * n // 10)
        for gone in [*combinations(range(n), allowed), *list(combinations(range(n), allowed + 1))[:20]]:
            docs.append((len(docs), "Some words, " + " ".join("other" if k in gone else w for k, w in enumerate(text.split())).upper() + " end."))
    docs.append((len(docs), items[-1][1]))
    docs.append((len(docs), items[5][1].rsplit(" ", 1)[0]))  # the item's last word is cut off
    want = set()
    for d, t in docs:
        dw = tokens(t)
        for i, it in items[:-1]:
            iw = tokens(it)
            if any(10 * sum(a == b for a, b in zip(iw, dw[s:])) >= 8 * len(iw) for s in range(len(dw) - len(iw) + 1)):
                want.add((d, i))
    want.add((docs[-2][0], 40))
    got = dc.leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"), block=block, short=True).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 250


def leaked(doc, item):
    """Whether some stretch of both, as long as the check's or the whole item, is equal enough place by place; no masks."""
    dw, iw = tokens(doc), tokens(item)
    n = min(dc.OVERLAP, len(iw))
    need = -(-n * 4 // 5)
    return any(
        sum(x == y for x, y in zip(dw[a : a + n], iw[b : b + n])) >= need for a in range(len(dw) - n + 1) for b in range(len(iw) - n + 1)
    )


def test_every_place_of_two_replaced_words_is_found(spark):
    rnd = random.Random(31)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(n))) for k, n in enumerate((14, 15, 20, 41))]
    docs = []
    for k, item in items:
        w = item.split()
        for a, b in itertools.combinations(range(dc.OVERLAP), 2):
            at = rnd.randrange(len(w) - dc.OVERLAP + 1)
            part = w[at : at + dc.OVERLAP]
            part[a] = part[b] = "other"
            if (a + b) % 5 == 0:  # a third one is too many
                part[next(j for j in range(dc.OVERLAP) if j not in (a, b))] = "third"
            docs.append((len(docs), " ".join(["before"] * rnd.randrange(4) + part + ["after"] * rnd.randrange(4))))
    got = dc.leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"), short=True)
    want = {(d, i) for d, dt in docs for i, it in items if leaked(dt, it)}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and 0 < len(want) < len(docs)


def test_items_of_too_few_words_drop_nothing(spark):
    docs = spark.createDataFrame([(1, "yes it is so"), (2, "one two three four five six"), (3, None)], "doc_id int, text string")
    items = spark.createDataFrame([(1, "Yes"), (2, "two three four five six"), (3, "it is so")], "item_id int, text string")
    kept = lambda **o: {r.doc_id for r in dc.drop_leaks(spark, docs, items, short=True, **o).collect()}
    assert kept() == {3} and kept(least_words=5) == {1, 3} and kept(least_words=6) == {1, 2, 3}


def test_items_of_one_text_make_one_block(spark, monkeypatch):
    blocks, found = [], dc._found
    monkeypatch.setattr(dc, "_found", lambda *a: blocks.append(found(*a)) or blocks[-1])
    text = " ".join(f"w{k}" for k in range(20))
    items = spark.createDataFrame([(i, text) for i in range(50)], "item_id int, text string")
    docs = spark.createDataFrame([(1, f"a {text} b"), (2, "w1 w2")], "doc_id int, text string")
    got = dc.leaks(docs, items, block=20 * len(dc.MASKS))
    assert {(r.doc_id, r.item_id, r.start_word) for r in got.collect()} == {(1, i, 1) for i in range(50)} and [len(b) for b in blocks] == [1]
