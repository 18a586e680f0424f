from collections import Counter

import numpy as np

from tenderlake.llm import langid


def brute_grams(text):
    out = []
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        padded = f" {word} "
        out += list(word) + [padded[i : i + 2] for i in range(len(padded) - 1)] + [padded[i : i + 3] for i in range(len(padded) - 2)]
    return Counter(out)


def name(code):
    out = ""
    while code:
        out = chr(code & 0x1FFFFF) + out
        code >>= 21
    return out


def test_grams_equal_brute_force():
    for text in (None, "", "  12 ", "a", "Ab, cd!", "Straße über\n\nÉté 日本", "x" * 5000, "ñ.ñ"):
        got = Counter(name(int(c)) for c in langid.grams(text))
        assert got == brute_grams(text), text


def test_out_of_place_distance():
    profiles = {"aa": langid.ranked("ab ab abc", 5), "bb": langid.ranked("xyz xy x", 5)}
    predict = langid.classifier(profiles, 5)

    def distance(text, lang):
        ranks = {int(c): i for i, c in enumerate(profiles[lang])}
        return sum(abs(ranks[int(c)] - i) if int(c) in ranks else 5 for i, c in enumerate(langid.ranked(text, 5)))

    for text in ("ab abc", "xy", "abxy x"):
        best, score = predict(text)
        other = "bb" if best == "aa" else "aa"
        assert distance(text, best) <= distance(text, other)
        assert np.isclose(score, distance(text, other) / (distance(text, best) + distance(text, other)))
    assert predict(None) == predict("12!") == ("und", 0.0) and langid.classifier({}, 5)("ab") == ("und", 0.0)


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, "the cat", "en", 1), (None, None, "en", 2), (2, "der hund", None, 3), (2, "der hund", "de", 3), (3, "", "de", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, lang_pred int")
    profiles = langid.learn(docs)
    assert set(profiles) == {"en", "de"}
    got = langid.identify(docs.select("doc_id", "text"), profiles).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "und"), (1, "en"), (2, "de"), (2, "de"), (3, "und")]
    assert langid.learn(docs.limit(0)) == {}
    assert langid.identify(docs.select("doc_id", "text").limit(0), profiles).count() == 0


def test_held_out_accuracy(spark):
    from tenderlake.llm.queries import op3_rank_order_language

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op3_rank_order_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    rows = out.collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
