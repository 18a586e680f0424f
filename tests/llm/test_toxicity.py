import random

import numpy as np

from tenderlake.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    for _ in range(800):
        terms = list({"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 5))) for _ in range(6)})
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 6)))
        got = dict(tx.automaton_matches(tx.Trie(terms, False).root, word))
        assert got == {t: distance(t, word) for t in terms if distance(t, word) <= 1}


def test_lexicon_matches_what_brute_force_matches():
    rnd = random.Random(2)
    terms = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 8))): float(k + 1) for k in range(60)}
    lexicon = tx.Lexicon(terms)
    for _ in range(1500):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 9)))
        near = [(w, distance(t, word)) for t, w in terms.items() if distance(t, word) <= 1 and len(t) >= tx.FUZZY]
        want = (terms[word], 0) if word in terms else max(near) if near and len(word) >= tx.FUZZY else None
        assert lexicon.match(word) == want


def test_quotation_is_told_from_abuse():
    lexicon = tx.Lexicon({"nastyword": 5.0})
    plain = tx.evidence("you are a nastyword indeed", lexicon, {})
    typo = tx.evidence("you are a nasty-word and nastywrd indeed", lexicon, {})
    quoted = tx.evidence('the term "nastyword" is listed here', lexicon, {})
    assert plain[0] > 0 == plain[2] and typo[1] > 0 and quoted[2] > 0 == quoted[0]
    # another quotation before it, or a word of punctuation after it, quotes nothing
    for text in ('"fine" you nastyword ...', 'he said "fine", then you nastyword !!', 'the "good" and nastyword and "bad" ones'):
        assert tx.evidence(text, lexicon, {})[2] == 0 < tx.evidence(text, lexicon, {})[0]
    assert tx.evidence('they wrote "all of the nastyword lot".', lexicon, {})[0] == 0
    assert not tx.evidence(None, lexicon, {}).any() and not tx.evidence("", lexicon, {}).any()


def test_fit_on_small_table(spark):
    rnd = random.Random(3)
    vocab = [f"plain{i}" for i in range(200)]
    text = lambda: [rnd.choice(vocab) for _ in range(40)]
    rows, labels = [], []
    for i in range(300):
        words, toxic = text(), int(i % 3 == 0)
        if toxic:
            words[rnd.randrange(40)] = words[rnd.randrange(40)] = rnd.choice(["horrid", "vilest"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, toxic))
    rows += [(None, None, None), (900, "", None), (901, "a horird thing or a horid one, horrids", None), (902, "fine words", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score string")
    model = tx.fit(docs, spark.createDataFrame(labels + [(None, 1)], "doc_id int, label int"))
    assert {"horrid", "vilest"} <= set(model.lexicon.weights)
    got = {r.doc_id: r.s for r in docs.select("doc_id", tx.score(docs.text, model).alias("s")).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, t in labels)
    assert got[None] == got[900] < 0.5 and got[901] > got[902]
    none = tx.fit(docs, spark.createDataFrame([(1, 0)], "doc_id int, label int"))
    assert none.scores(np.ones((2, 7))).max() < 1e-9
    assert docs.limit(0).select(tx.score(docs.text, none)).count() == 0


def test_held_out_accuracy(spark):
    from tenderlake.llm.queries import op9_levenshtein_toxicity

    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op9_levenshtein_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    hit = {t: np.mean([r.predicted == t for r in rows if r.toxic == t]) for t in (0, 1)}
    assert hit[0] > 0.99 and hit[1] > 0.85
