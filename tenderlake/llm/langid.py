"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (one to three letters, words padded with a
blank) in falling order of frequency. A document's own list is compared with every language's: each of its
n-grams costs the difference of the two ranks, or ``size`` if the language's list lacks it, and the language
with the smallest sum wins (ties: the first in alphabetical order).

The profiles are learned from at most ``SAMPLE`` rows of each language (a bounded sample, chosen by a hash of
doc_id); documents are always read whole.

Edge cases: a text that is null or holds no letter is ``und`` with score 0; with no labelled row every text is
``und``. Rows are scored one by one, so repeated rows, null or repeated doc_ids and extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import by_value, per_worker

SIZE = 400
SAMPLE = 4000
#: Documents whose n-grams are counted at once; bounds a task's memory.
SLICE = 256
UNKNOWN = "und"
_BITS = np.uint64(21)
_BLANK = 32


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return per_worker("letters", None, lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of one to three characters of a text's words; 21 bits a character."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    chars = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return np.empty(0, dtype=np.uint64)
    line = np.where(letter, chars, _BLANK).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each word
    line = np.concatenate(([_BLANK], line[keep], [_BLANK])).astype(np.uint64)
    one = line[line != _BLANK]
    two = (line[:-1] << _BITS) | line[1:]
    three = (two[:-1] << _BITS) | line[2:]
    # a blank may begin or end a gram, not stand inside it
    two = two[(line[:-1] != _BLANK) | (line[1:] != _BLANK)]
    three = three[line[1:-1] != _BLANK]
    return np.concatenate((one, two, three))


def ranked(text: str | None, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams in falling order of frequency (ties: by code)."""
    codes = np.sort(grams(text))
    if not len(codes):
        return codes
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    counts = np.diff(np.append(first, len(codes)))
    return codes[first][np.argsort(-counts, kind="stable")[:size]]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            for lang, texts in batch.iloc[at : at + SLICE].groupby("lang")["text"]:
                codes, n = np.unique(np.concatenate([grams(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": codes.astype(np.int64), "n": n.astype(np.int64)})


def learn(labelled: DataFrame, size: int = SIZE, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The profile of every language in ``labelled`` (doc_id, text, lang); rows with a null lang do not count."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    share = {r["lang"]: min(1.0, sample / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return {}
    limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 30)))])
    taken = rows.where(F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 30)) < limit[F.col("lang")])
    counts = taken.select("lang", "text").mapInPandas(_counted, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = totals.withColumn("nth", nth).where(F.col("nth") <= size).select("lang", "gram", "nth").collect()
    out: dict[str, list] = {lang: [] for lang in sorted(share)}
    for r in sorted(top, key=lambda r: r["nth"]):
        out[r["lang"]].append(r["gram"])
    return {lang: np.array(v, dtype=np.int64).astype(np.uint64) for lang, v in out.items() if v}


def classifier(profiles: dict[str, np.ndarray], size: int = SIZE) -> Callable[[str | None], tuple[str, float]]:
    """A function from a text to its language and a score: how much closer the winner is than the next."""
    langs = sorted(profiles)
    known = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.empty(0, dtype=np.uint64)
    ranks = np.full((len(known) + 1, len(langs)), -1, dtype=np.int64)
    for k, lang in enumerate(langs):
        ranks[np.searchsorted(known, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(text: str | None) -> tuple[str, float]:
        own = ranked(text, size)
        if not len(own) or not langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(known, own)
        at[at >= len(known)] = 0
        theirs = np.where((known[at] == own)[:, None], ranks[at], -1)
        off = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(off))
        rest = np.delete(off, best)
        worst = size * len(own)
        second = int(rest.min()) if len(rest) else worst
        return langs[best], float(second / (off[best] + second)) if off[best] + second else 1.0

    return predict


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = SIZE) -> DataFrame:
    """``docs`` (doc_id, text and any other columns it needs) with lang_pred and score instead of the text."""
    predict = classifier(profiles, size)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([predict(t) for t in batch], columns=["lang_pred", "score"])

    others = [c for c in docs.columns if c != "text"]
    return docs.select(*others, guess("text").alias("guess")).select(*others, "guess.lang_pred", "guess.score")


by_value(__name__)
