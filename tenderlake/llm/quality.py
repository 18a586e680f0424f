"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every document becomes a vector of statistics of its whole text (logarithms of sizes, square roots of shares).
Each class gets a mean and a covariance, shrunk towards the pooled covariance (``POOL``) and that towards a
multiple of the identity (``RIDGE``). The score of a text is the logistic of the difference of the two classes'
log densities (half the difference of the squared Mahalanobis distances and of the log determinants, plus the
log ratio of the class sizes); the Cholesky factors of both covariances are computed once.

The classes are fitted on at most about ``SAMPLE`` labelled rows (a bounded sample, chosen by a hash of doc_id);
all documents are scored over their whole texts.

Edge cases: null and empty texts have the statistics of an empty text; rows with a null label or doc_id are not
learned from; with no example of label 0 every score is 1, with none of label 1 but some of label 0 it is 0.
Rows are scored one by one, so repeated rows and extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import bounded_sample, by_value, fold, fresh

SAMPLE = 20_000
POOL = 0.1
RIDGE = 0.05
THRESHOLD = 0.7
#: Held out: the rows whose fold is this, of so many.
FOLDS, HELD_OUT = 4, 2

_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~=+{}[]\\/_", dtype=np.uint8)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text."""
    data = (text or "").encode("utf-8", "replace")
    size = max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper, digits = counts[65:91].sum(), counts[48:58].sum()
    letters = upper + counts[97:123].sum() + counts[128:].sum()
    held = counts[counts > 0] / size
    return np.array([
        np.log1p(len(words)),
        np.log1p(len(data) / n),
        np.log1p(len(data) / max(len(lines), 1)),
        np.sqrt(upper / size),
        np.sqrt(digits / size),
        np.sqrt(1 - min(letters / size, 1)),
        np.sqrt(counts[_SYMBOLS].sum() / size),
        np.sqrt(counts[33] / size),
        np.sqrt(counts[124] / size),
        np.sqrt((counts[46] + counts[44]) / size),
        np.sqrt(len(set(words)) / n),
        np.sqrt(1 - len(set(zip(words, words[1:]))) / max(len(words) - 1, 1)) if len(words) > 1 else 0.0,
        np.sqrt(1 - len(set(lines)) / max(len(lines), 1)) if lines else 0.0,
        np.sqrt(sum(map(bytes.isupper, words)) / n),
        float(-(held * np.log(held)).sum()),
    ])


@dataclass
class Discriminant:
    """Two Gaussians over shifted and scaled statistics; ``None`` in place of a class without examples."""

    shift: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray | None]
    whiten: list[np.ndarray | None]  # inverse Cholesky factors
    logs: list[float]  # log prior - log determinant / 2

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.means[0] is None:
            return np.ones(len(stats))
        if self.means[1] is None:
            return np.zeros(len(stats))
        x = (stats - self.shift) / self.scale
        density = [log - 0.5 * (((x - mean) @ w.T) ** 2).sum(axis=1) for mean, w, log in zip(self.means, self.whiten, self.logs, strict=True)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, sums and sums of products of each class, one row a cell."""
    for batch in batches:
        for label, texts in batch.groupby("label")["text"]:
            x = np.stack([statistics(t) for t in texts])
            cells = np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))
            yield pd.DataFrame({"label": int(label), "cell": np.arange(len(cells)), "value": cells})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label); only sums reach the driver."""
    known = bounded_sample(labels.where("doc_id is not null and label in (0, 1)").select("doc_id", "label"), "doc_id", sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text")
    cells = rows.mapInPandas(_moments, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    d = len(statistics(""))
    sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for r in cells.collect():
        sums[r["label"]][r["cell"]] = r["value"]
    total = sums[0] + sums[1]
    n = max(total[0], 1.0)
    shift = total[1 : d + 1] / n
    scale = np.sqrt(np.maximum(total[d + 1 :].reshape(d, d).diagonal() / n - shift**2, 1e-6))
    means, spreads = [], []
    for k in (0, 1):
        m = max(sums[k][0], 1.0)
        mean = sums[k][1 : d + 1] / m
        cov = sums[k][d + 1 :].reshape(d, d) / m - np.outer(mean, mean)
        means.append((mean - shift) / scale)
        spreads.append(cov / np.outer(scale, scale))
    pooled = (spreads[0] * sums[0][0] + spreads[1] * sums[1][0]) / n
    pooled = (1 - ridge) * pooled + ridge * np.eye(d) * max(np.trace(pooled) / d, 1e-3)
    whiten, logs = [], []
    for k in (0, 1):
        cov = (1 - pool) * spreads[k] + pool * pooled
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        logs.append(float(np.log(max(sums[k][0], 1.0) / n) - np.log(factor.diagonal()).sum()))
    return Discriminant(shift, scale, [x if sums[k][0] else None for k, x in enumerate(means)], [x if sums[k][0] else None for k, x in enumerate(whiten)], logs)


def score(text: Column, model: Discriminant) -> Column:
    """The probability of label 1 of each text."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.scores(np.stack([statistics(t) for t in batch])) if len(batch) else [], dtype="float64")

    return scored(text)


def train_labels(labels: DataFrame, label: str, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from."""
    return labels.where(fold(F.col("doc_id"), folds) != held_out).select("doc_id", F.col(label).alias("label"))


def keep_good(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns unchanged."""
    name = fresh(docs, "quality_score")
    return docs.withColumn(name, score(F.col("text"), model)).where(F.col(name) >= threshold).select(*docs.columns)


by_value(__name__)
