import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tenderlake.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def texts():
    rnd = random.Random(8)
    bits = ["a", "b", "c", "É", "#x", "w|w", "\n", "\n", " ", "\t", "\x0b", "a b c", "🙂", " "]
    return [None, "", " \n ", "a", "a b", "a b c a b c", "a a a a", "x\nx\n \n \nx", "word " * 5000] + [" ".join(rnd.choice(bits) for _ in range(rnd.randint(1, 120))) for _ in range(150)]


def test_counts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id int, text string, n_words string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in rows}


def plain_em(patterns, names, rounds):
    """Expectation-maximisation in plain Python over [(votes, n)]."""
    q = [rules.CLEAN if 0 not in v else rules.DOUBT ** v.count(0) for v, _ in patterns]
    rate = lambda a, n: (a + rules.PRIOR * 0.5) / (n + rules.PRIOR)
    for _ in range(rounds):
        g = [n * x for (_, n), x in zip(patterns, q)]
        b = [n * (1 - x) for (_, n), x in zip(patterns, q)]
        model = {"good": rate(sum(g), sum(g) + sum(b))}
        for k, name in enumerate(names):
            up = max(rate(sum(w for (v, _), w in zip(patterns, g) if v[k] == 1), sum(w for (v, _), w in zip(patterns, g) if v[k] is not None)), rules.FAIR)
            bad = rate(sum(w for (v, _), w in zip(patterns, b) if v[k] == 1), sum(w for (v, _), w in zip(patterns, b) if v[k] is not None))
            model[name] = (up, min(up, bad))
        q = []
        for v, _ in patterns:
            logit = math.log(model["good"] / (1 - model["good"]))
            for x, name in zip(v, names):
                up, bad = model[name]
                logit += 0 if x is None else math.log(up / bad) if x else math.log((1 - up) / (1 - bad))
            q.append(1 / (1 + math.exp(-logit)))
    return model


def test_estimates_equal_plain_em(spark):
    rnd = random.Random(5)
    names = ["r0", "r1", "r2", "r3"]
    patterns = list({tuple(rnd.choice([0, 1, 1, None]) for _ in names): rnd.randint(1, 50) for _ in range(40)}.items())
    df = spark.createDataFrame([(*v, n) for v, n in patterns], "r0 int, r1 int, r2 int, r3 int, n long")
    got, want = rules.estimate(df, names, rounds=6), plain_em(patterns, names, 6)
    for k in want:
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(*[x if isinstance(x, tuple) else (x,) for x in (got[k], want[k])]))


def test_empty_table_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id int, text string")
    got = rules.judged(spark, docs)
    assert got.where("base_failed and not kept").count() == 3
    assert rules.judged(spark, docs.limit(0)).count() == 0


def test_query_keeps_clean_text_and_drops_junk(spark):
    from tenderlake.llm.queries import op5_weak_supervision_rules

    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    out = op5_weak_supervision_rules(spark, d).join(labels, "doc_id").where("not base_failed")
    share = {r.quality: r.k for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.99 and share[0] < 0.05


def test_verdicts_differ_from_all_must_pass(spark):
    """One vote against does not always reject: good texts with repeated lines stay, junk that passes the base rule goes."""
    d = "/root/testdata/sf0.1"
    names = rules.votes()
    against = sum((F.coalesce((v == 0).cast("int"), F.lit(0)) for v in names.values()), F.lit(0))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    out = rules.judged(spark, spark.read.parquet(f"{d}/documents.parquet")).where("not base_failed").withColumn("against", against)
    got = out.join(labels, "doc_id", "left").groupBy("quality", "kept", (F.col("against") > 0).alias("faulted")).count().collect()
    count = {(r.quality, r.kept, r.faulted): r["count"] for r in got}
    assert sum(n for (_, kept, faulted), n in count.items() if kept == faulted) > 0
    assert sum(n for (quality, kept, _), n in count.items() if quality == int(not kept)) == 0, count
