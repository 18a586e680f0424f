"""Quality rules under weak supervision, in DataFrame operations only.

Each rule votes for a document (1), against it (0) or abstains (null), from statistics of the whole text.
Expectation-maximisation over the vote patterns estimates, for each rule, how often it votes for good and for bad
documents, and the share of good ones; a document's posterior probability of being good replaces the demand that
it pass every rule. There are at most 3 ** rules different patterns, so every iteration is one aggregation of a
table whose size does not depend on the corpus. Only documents that pass the base rule are learned from: the others
are rejected whatever the votes say, and their many kinds of junk would draw the classes to another split.

Start: a document without a vote against it counts as good with probability ``CLEAN``, one with votes against it
with ``DOUBT`` to the power of their number. Estimates are smoothed by ``PRIOR`` imagined votes, so a rule that
never votes, a table of one class and an empty table are all defined.

Edge cases: null and empty texts have no words and fail the base rule; repeated rows and null doc_ids are scored
like others; only doc_id and text are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import words, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
CLEAN, DOUBT = 0.95, 0.05
PRIOR = 1.0
#: ``estimate`` by default: a rule's votes against good documents are at most this share. One vote against then rejects.
#: What ``judged`` asks of every rule instead: to be no worse than chance on good documents.
FAIR = 0.5
ROUNDS = 20
THRESHOLD = 0.5


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words(w: Column) -> Column:
    """From a words column: the sorted (hash, position) of all 3-word windows."""
    last = F.size(w) - 3
    window = lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("p"))
    empty = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.when(last >= 0, F.sort_array(F.transform(F.sequence(F.lit(0), last), window))).otherwise(empty)


def covered(ordered: Column) -> Column:
    """Words that lie in a window found twice or more; ``ordered`` as from repeated_words."""
    twice = F.filter(
        ordered,
        lambda x, i: F.get(ordered, i - 1)["h"].eqNullSafe(x["h"]) | F.get(ordered, i + 1)["h"].eqNullSafe(x["h"]),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
    step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text that the rules use."""
    t, w, lines = F.col("t"), F.col("w"), F.col("lines")
    split = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    split = split.select(
        "doc_id", "t", words(t).alias("w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    split = split.withColumn("windows", repeated_words(w))
    count = lambda c: c.cast("long")
    return split.select(
        "doc_id",
        count(F.size(w)).alias("n_words"),
        count(F.length(_without(t, BLANKS))).alias("word_chars"),
        count(F.length(t) - F.length(_without(t, SYMBOLS))).alias("n_symbols"),
        count(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        count(covered(F.col("windows"))).alias("n_repeat_words"),
        count(F.size(lines)).alias("n_lines"),
        count(F.length(t) - F.length(_without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).alias("n_upper"),
        count(F.length(t) - F.length(_without(t, "!"))).alias("n_calls"),
        count(F.length(t) - F.length(_without(t, "0123456789"))).alias("n_digits"),
        count(F.size(F.array_distinct(w))).alias("n_distinct"),
    )


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), None).when(good, 1).when(bad, 0)


def votes() -> dict[str, Column]:
    """The rules, over the columns of ``statistics``."""
    n = F.nullif(F.col("n_words").cast("double"), F.lit(0.0))
    chars = F.nullif(F.col("word_chars").cast("double"), F.lit(0.0))

    def share(name: str, of: Column, good: float, bad: float) -> Column:
        part = F.col(name) / of
        return _vote(part, part <= good, part > bad)

    length = F.col("word_chars") / n
    dup = F.col("n_dup_lines") / F.when(F.col("n_lines") > 1, F.col("n_lines").cast("double"))
    return {
        "size": _vote(n, (n >= MIN_WORDS) & (n <= 100_000), (n < 20) | (n > 1_000_000)),
        "word_length": _vote(n, (length >= 3) & (length <= 10), (length < 2) | (length > 15)),
        "symbols": share("n_symbols", n, 0.02, 0.1),
        "dup_lines": _vote(dup, dup <= 0.1, dup > 0.3),
        "repeats": share("n_repeat_words", n, 0.1, 0.3),
        "upper": share("n_upper", chars, 0.1, 0.3),
        "calls": share("n_calls", n, 0.02, 0.1),
        "digits": share("n_digits", chars, 0.1, 0.3),
        "variety": _vote(n, F.col("n_distinct") >= 0.2 * n, (n >= MIN_WORDS) & (F.col("n_distinct") < 0.1 * n)),
    }


def _logit(model: dict, cast: dict[str, Column]) -> Column:
    """Log odds of good from the votes in the columns ``cast`` under a model's estimates."""
    out = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name, c in cast.items():
        up, up_bad = model[name]
        out = out + F.when(c == 1, math.log(up / up_bad)).when(c == 0, math.log((1 - up) / (1 - up_bad))).otherwise(0.0)
    return out


def _posterior(logit: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-500.0)), F.lit(500.0))))


def estimate(patterns: DataFrame, names: list[str], rounds: int = ROUNDS, least: float = FAIR) -> dict:
    """Expectation-maximisation over ``patterns`` (a column of votes for each name, and n rows with them).

    ``least`` is the smallest rate at which a rule may be taken to vote for good documents.
    """
    cast = {x: F.col(x) for x in names}
    against = reduce(lambda a, b: a + b, [F.when(c == 0, 1).otherwise(0) for c in cast.values()])
    good = F.when(against == 0, CLEAN).otherwise(F.pow(F.lit(DOUBT), against))
    model: dict = {}
    for _ in range(rounds):
        weighed = patterns.select(*names, (F.col("n") * good).alias("g"), (F.col("n") * (1 - good)).alias("b"))
        sums = [F.sum("g").alias("g"), F.sum("b").alias("b")]
        for x, c in cast.items():
            for k in ("g", "b"):
                sums += [F.sum(F.when(c == 1, F.col(k))).alias(f"{x}_{k}_for"), F.sum(F.when(c.isNotNull(), F.col(k))).alias(f"{x}_{k}_all")]
        s = {k: v or 0.0 for k, v in weighed.agg(*sums).first().asDict().items()}
        rate = lambda a, n: (a + PRIOR * 0.5) / (n + PRIOR)
        model = {"good": rate(s["g"], s["g"] + s["b"])}
        for x in names:
            up, up_bad = rate(s[f"{x}_g_for"], s[f"{x}_g_all"]), rate(s[f"{x}_b_for"], s[f"{x}_b_all"])
            up = max(up, least)
            model[x] = (up, min(up, up_bad))
        good = _posterior(_logit(model, cast))
    return model


def judged(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Statistics, base_failed, posterior and kept of every row of ``docs`` (doc_id, text)."""
    stats = written(spark, statistics(docs.select("doc_id", "text")), "rules")
    rules = votes()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = stats.where(~failed).select(*[v.alias(k) for k, v in rules.items()]).groupBy(*rules).agg(F.count(F.lit(1)).alias("n"))
    model = estimate(written(spark, counted, "vote-patterns"), list(rules))
    return (
        stats.withColumn("base_failed", failed)
        .withColumn("posterior", _posterior(_logit(model, rules)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )
