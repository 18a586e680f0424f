"""Toxicity from a learned lexicon that tolerates misspellings, read in context.

Lexicon: terms that stand in many more toxic than other documents (smoothed log odds), held as a trie of the terms and
one of the reversed terms. A word matches a term at up to one edit (from ``FUZZY`` letters on) if the Levenshtein
automaton of the word meets the term's path in the trie. One edit leaves the first or the second half of the word
as it is, so the automaton starts below the half that matches exactly, forwards or backwards.

Context: a match counts as quoted if a quotation is open at it and closes after it, both within ``WINDOW`` words, or a
word of reporting stands just before it; other matches near it and words of address strengthen it. A logistic
regression weighs exact, misspelled and quoted matches into a score.

Learning uses at most about ``SAMPLE`` labelled rows (a bounded sample by a hash of doc_id); half of it yields the
lexicon and half the weights, so the weights are not learned on the rows that chose the terms. Whole texts are read.

Edge cases: null and empty texts have no match and get the score of a clean text; without toxic examples every score is
0; null labels and doc_ids are not learned from; rows are scored one by one, so repeated rows and extra columns do not
matter.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import bounded_sample, by_value, per_worker

SAMPLE = 40_000
LEAST_DOCUMENTS = 5
LEAST_ODDS = 3.0
TERMS = 20_000
FUZZY = 4
WINDOW = 8
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
_CACHE = 200_000
#: Documents whose words are counted at once; bounds a task's memory.
SLICE = 500

_STRIP = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„‘’‹›…–—¿¡"
_OPEN, _CLOSE = "\"'«“„‘‹»", "\"'»”“’›«"
#: Fixed lists: words that report speech, and words that address somebody.
_REPORTS = frozenset("said says called calls term word phrase wrote quoted quote dit mot sagte wort dijo palabra".split())
_ADDRESS = frozenset("you your you're u he she they them tu vous du ihr usted".split())


def spelled(raw: str) -> str:
    """A raw word without punctuation at its ends."""
    return raw.strip(_STRIP)


class Trie:
    """Nested dictionaries; the key "" holds the whole term."""

    def __init__(self, terms: list[str], reverse: bool):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in reversed(term) if reverse else term:
                node = node.setdefault(c, {})
            node[""] = term

    def descend(self, text: str) -> dict | None:
        node: dict | None = self.root
        for c in text:
            node = node.get(c)
            if node is None:
                return None
        return node


def automaton_matches(node: dict, word: str) -> Iterator[tuple[str, int]]:
    """(term, edits) below a trie node whose rest is within one edit of ``word``.

    The automaton's state is a pair of bit sets: the places in ``word`` that are reached without and with one edit.
    """
    n = len(word)
    places: dict[str, int] = {}
    for i, c in enumerate(word):
        places[c] = places.get(c, 0) | 1 << i
    accept = 1 << n
    stack = [(node, 1, 2)]  # an edit may drop the first letter of the word
    while stack:
        at, exact, one = stack.pop()
        if "" in at:
            if exact & accept:
                yield at[""], 0
            elif one & accept:
                yield at[""], 1
        for c, below in at.items():
            if c:
                here = places.get(c, 0)
                same = (exact & here) << 1
                # one edit: a kept letter after it, a letter put in, a letter replaced, or one dropped after a kept letter
                edited = (one & here) << 1 | exact | exact << 1 | same << 1
                edited &= (accept << 1) - 1
                if same | edited:
                    stack.append((below, same, edited))


@dataclass
class Lexicon:
    """The terms' weights; the tries are built once in each worker process, not sent with every task."""

    weights: dict[str, float]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def tries(self) -> tuple[Trie, Trie]:
        return per_worker("tries", self.name, lambda: (Trie(sorted(self.weights), False), Trie(sorted(self.weights), True)))

    def cache(self) -> dict:
        """Words matched so far by this process."""
        return per_worker("words", self.name, dict)

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the closest term (of the heaviest, at a tie)."""
        own = self.weights.get(word)
        if own is not None:
            return own, 0
        if len(word) < FUZZY:
            return None
        half = len(word) // 2
        found = []
        forward, backward = self.tries()
        for trie, fixed, rest in ((forward, word[:half], word[half:]), (backward, word[half:][::-1], word[:half][::-1])):
            node = trie.descend(fixed)
            if node is not None:
                found += [(self.weights[t], e) for t, e in automaton_matches(node, rest) if len(t) >= FUZZY]
        return max(found, default=None)


def _closes(word: str) -> bool:
    """Whether a quotation ends with this word."""
    end = word.rstrip(".,;:!?")
    return len(end) > 1 and end[-1] in _CLOSE


def _still_open(words: list[str]) -> bool:
    """Whether a quotation that opens within ``words`` is open at the last of them."""
    open_ = False
    for word in words[:-1]:
        open_ = (open_ or word[0] in _OPEN) and not _closes(word)
    return open_ or words[-1][0] in _OPEN


def evidence(text: str | None, lexicon: Lexicon, cache: dict) -> np.ndarray:
    """The context-window sums of one text: exact, misspelled, quoted, strongest, crowding, address, share of words."""
    raw = (text or "").lower().split()
    hits = []
    for i, w in enumerate(raw):
        try:
            m = cache[w]
        except KeyError:
            if len(cache) >= _CACHE:
                cache.clear()
            word = spelled(w)
            m = cache[w] = lexicon.match(word) if word else None
        if m is not None:
            hits.append((i, *m))
    exact = fuzzy = quoted = strongest = crowd = address = 0.0
    for k, (i, weight, edits) in enumerate(hits):
        before, after = raw[max(0, i - WINDOW) : i + 1], raw[i : i + WINDOW + 1]
        if (_still_open(before) and any(map(_closes, after))) or any(spelled(x) in _REPORTS for x in before[-4:-1]):
            quoted += weight
            continue
        if edits:
            fuzzy += weight
        else:
            exact += weight
            strongest = max(strongest, weight)
        crowd += (k > 0 and i - hits[k - 1][0] <= WINDOW) + (k + 1 < len(hits) and hits[k + 1][0] - i <= WINDOW)
        address += any(spelled(x) in _ADDRESS for x in before + after)
    share = 100 * len(hits) / max(len(raw), 1)
    return np.array([math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), strongest, math.log1p(crowd), math.log1p(address), math.log1p(share)])


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # the last is the constant

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -500, 500)))


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part, n = batch.iloc[at : at + SLICE], {0: Counter(), 1: Counter()}
            for label, text in zip(part["label"], part["text"]):
                n[int(label)].update({s for w in set((text or "").lower().split()) if (s := spelled(w))})
            words = sorted(n[0].keys() | n[1].keys())
            yield pd.DataFrame({"word": words, "toxic": [n[1][w] for w in words], "clean": [n[0][w] for w in words]})


def learn_lexicon(rows: DataFrame, terms: int = TERMS) -> Lexicon:
    """From rows (label, text): the terms with the highest smoothed log odds of standing in a toxic document."""
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = rows.mapInPandas(_document_counts, "word string, toxic long, clean long").groupBy("word")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    best = (
        counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "word").limit(terms)
    )
    return Lexicon({r["word"]: float(r["odds"]) for r in best.collect()})


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights (the constant last) by Newton's method."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    known = bounded_sample(labels.where("doc_id is not null and label in (0, 1)").select("doc_id", "label"), "doc_id", sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    first = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    lexicon = learn_lexicon(rows.where(first).select("label", "text"))

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = lexicon.cache()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [evidence(t, lexicon, cache).tolist() for t in batch["text"]]})

    got = rows.where(~first).select("label", "text").mapInPandas(seen, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in got], dtype=float)
    if not y.sum():
        return Model(lexicon, np.append(np.zeros(len(evidence("", lexicon, {}))), -500.0))
    x = np.array([r["x"] for r in got])
    return Model(lexicon, logistic(x, y))


def score(text: Column, model: Model) -> Column:
    """The probability that each text is toxic."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = model.lexicon.cache()
        for batch in texts:
            yield pd.Series(model.scores(np.stack([evidence(t, model.lexicon, cache) for t in batch])) if len(batch) else [], dtype="float64")

    return scored(text)


by_value(__name__)
