"""Whitening of embeddings onto their leading components, each found by slicing the spectrum.

Vectors become whole numbers, ``floor(256 * entry)``. The covariance is taken over the *fit list*, which holds each
distinct vector once: Spark sums the vectors, then the products of their distances from a whole-number centre next to
the mean. Both sums are exact (products of a batch are whole numbers below 2^53, sums travel in limbs), so the
covariance is the correctly rounded one whatever the partitioning.

The components of the covariance V are found one after the other, from the largest eigenvalue e on. An LDL' factor of
``V - s I`` has as many positive pivots as V has eigenvalues above s (Sylvester); such inertia counts bisect the
spectrum until an interval holds the wanted eigenvalue alone. Rayleigh quotient iteration, started from inverse iteration
inside that interval, then converges cubically. Two more counts, just below and just above the result, certify that it
is the eigenvalue with that number. Eigenvalues that cannot be told apart in double precision form a cluster; their
vectors are kept at right angles to those found before.

Only d x d numbers reach the driver (d: the vectors' length, at most ``MOST_DIMENSIONS``).

Edge cases: a vector that is null, empty, of another than the most frequent length (of equally frequent ones the
longest), or that holds a null or non-finite entry is dropped; entries beyond 2^53 in size after scaling are held there;
repeated vectors count once in the fit and all get rows; directions without variance are no components, so one distinct
vector, or none, gives no rows; a deviation beyond 64 bits is null; null vec_ids keep their rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import by_value, written

SCALE = 256
COMPONENTS = 4
MOST_DIMENSIONS = 4096
#: Rows that are multiplied at a time; products of so many rows stay exact if entries are below 2^20 or so.
BLOCK = 4096
_EPS = np.finfo(float).eps
_LIMB = 42
#: Bunch and Parlett's bound between pivots of one and of two rows.
_PIVOT = (1 + 17 ** 0.5) / 8


def whole_vectors(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable vectors in the column, their whole numbers)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    usable = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dimensions)
    entries = column.take(pa.array(usable)).flatten().cast(pa.float64()).fill_null(np.nan)
    values = entries.to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(axis=1)
    most = float(1 << 53)
    return usable[finite], np.clip(np.floor(SCALE * values[finite]), -most, most).astype(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.reshape(-1)))


def _read(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers in three limbs, the last with the sign, so that sums of very many stay within 64 bits."""
    low = (1 << _LIMB) - 1
    parts = ([int(v) & low for v in x], [int(v) >> _LIMB & low for v in x], [int(v) >> 2 * _LIMB for v in x])
    return [np.array(p, dtype=np.int64) for p in parts]


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as whole numbers (64-bit, or Python's where those might overflow)."""
    size = int(np.abs(y).max(initial=0))
    total: np.ndarray = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    rows = (1 << 53) // max(size * size, 1)
    if rows < 1:
        big = y.astype(object)
        return big.T @ big
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(float)
        total += (part.T @ part).astype(np.int64)
    return total


def _summed(fit: DataFrame, dimensions: int, partial: Callable[[np.ndarray], np.ndarray]) -> dict[int, int]:
    """Exact sums, by place, over all vectors of ``fit``; ``partial`` sums a block into whole numbers by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _read(batch.column(0), dimensions)
            for at in range(0, len(x), BLOCK):
                part = partial(x[at : at + BLOCK])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *map(pa.array, _limbs(total))], ["place", "a", "b", "c"])

    limbs = fit.select("x").mapInArrow(run, "place long, a long, b long, c long")
    sums = limbs.groupBy("place").agg(*[F.sum(c).alias(c) for c in "abc"])
    return {r["place"]: r["a"] + (r["b"] << _LIMB) + (r["c"] << 2 * _LIMB) for r in sums.collect()}


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``: the positive pivots of an LDL' factor.

    Bunch and Parlett's pivoting: the largest diagonal entry, or the two rows of the largest other one, whose
    block always has one pivot of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        p = int(diagonal.argmax())
        top = float(diagonal[p])
        np.fill_diagonal(size, 0)
        r, s = divmod(int(size.argmax()), len(a))
        if top == 0 and size[r, s] == 0:
            break  # what is left are eigenvalues at the shift itself
        if top >= _PIVOT * size[r, s]:
            rest = np.delete(np.arange(len(a)), p)
            positive += bool(a[p, p] > 0)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[p, rest] / a[p, p])
        else:
            rest = np.delete(np.arange(len(a)), [r, s])
            positive += 1
            pair = a[np.ix_([r, s], [r, s])]
            a = a[np.ix_(rest, rest)] - a[np.ix_(rest, [r, s])] @ np.linalg.solve(pair, a[np.ix_([r, s], rest)])
        a = (a + a.T) / 2
    return positive


@dataclass
class Component:
    number: int
    value: float
    vector: np.ndarray
    #: Eigenvalues counted above value + tolerance and above value - tolerance: below the number, and not below it.
    above: int
    reached: int


def _solved(matrix: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """A unit vector along (matrix - shift I)^-1 x; a singular shift is moved by a rounding error."""
    for step in (0.0, 1.0, 4.0, 16.0):
        try:
            y = np.linalg.solve(matrix - (shift + step * _EPS * np.abs(matrix).max()) * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all() and y.any():
            return y / np.abs(y).max() / np.linalg.norm(y / np.abs(y).max())
    raise ArithmeticError("no solution near the shift")


def leading(matrix: np.ndarray, most: int = COMPONENTS) -> list[Component]:
    """The components with the largest eigenvalues, in falling order; only those that rounding leaves above zero."""
    d, scale = len(matrix), float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if scale == 0:
        return []
    v = matrix / scale  # all eigenvalues within -1..1
    tolerance = 64 * d * _EPS
    counts = {1.0 + tolerance: 0, tolerance: count_above(v, tolerance)}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(v, shift)
        return counts[shift]

    found: list[Component] = []
    for number in range(1, min(most, counts[tolerance]) + 1):
        def interval() -> tuple[float, float]:
            return max(s for s, c in counts.items() if c >= number), min(s for s, c in counts.items() if c < number)

        def halved() -> bool:
            low, high = interval()
            middle = low + (high - low) / 2
            if high - low <= tolerance or not low < middle < high:
                return False
            count(middle)
            return True

        low, high = interval()
        while count(low) - count(high) > 1 and halved():
            low, high = interval()
        before = np.array([c.vector for c in found]).reshape(-1, d)
        while True:
            low, high = interval()
            narrow = high - low <= tolerance
            x = _start(d, number, before)
            for _ in range(3):
                x = _orthogonal(_solved(v, low + (high - low) / 2, x), before)
            value = float(x @ v @ x)
            for _ in range(12):
                off = float(np.linalg.norm(v @ x - value * x))
                if off <= 4 * d ** 0.5 * _EPS or not low <= value <= high:
                    break
                x = _orthogonal(_solved(v, value, x), before)
                value = float(x @ v @ x)
            # an eigenvalue lies within ``off`` of the value: it must be the one inside the interval
            off = float(np.linalg.norm(v @ x - value * x))
            edge = tolerance if narrow else -off
            settled = off <= tolerance and low - edge < value < high + edge
            if settled or not halved():
                break
        if not settled:
            raise ArithmeticError(f"component {number} did not settle")
        above, reached = count(value + tolerance), count(value - tolerance)
        if not above < number <= reached:
            raise ArithmeticError(f"component {number} is not certified: {above} above, {reached} reached")
        x = x * np.sign(x[np.abs(x).argmax()])
        found.append(Component(number, value * scale, x, above, reached))
    return found


def _start(d: int, number: int, before: np.ndarray) -> np.ndarray:
    """A fixed vector with a part in every direction, at right angles to those found."""
    return _orthogonal(np.cos(np.arange(1, d + 1) * (1.0 + 0.37 * number)) + 0.25, before)


def _orthogonal(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - before.T @ (before @ x)
        x = x / np.linalg.norm(x)
    return x


@dataclass
class Whitener:
    n: int
    sums: list[int]
    covariance: np.ndarray
    components: list[Component]
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(x - S/n, exact sums of (n x - S)^2 as Python's whole numbers or 64-bit ones)."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if bound * bound * max(x.shape[1], 1) < 1 << 62:
            moved = self.n * x - np.array(self.sums, dtype=np.int64)
            return moved / self.n, (moved * moved).sum(axis=1)
        moved = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return (moved / self.n).astype(float), (moved * moved).sum(axis=1)

    def whitened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centred, deviation = self.centred(x)
        axes = np.array([c.vector / np.sqrt(c.value) for c in self.components]).reshape(-1, x.shape[1])
        return centred @ axes.T, deviation


def dimensions_of(vectors: DataFrame) -> int:
    """The most frequent length of a vector, of equally frequent ones the longest; 0 if there is none."""
    sizes = vectors.select(F.size("embedding").alias("d")).where("embedding is not null and d > 0").groupBy("d").count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return first[0]["d"] if first else 0


def fit(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Learns from ``vectors`` (embedding); null if there is no vector."""
    d = dimensions_of(vectors)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MOST_DIMENSIONS}")
    if not d:
        return None

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_lists(whole_vectors(batch.column(0), d)[1])], ["x"])

    listed = written(spark, vectors.select("embedding").mapInArrow(numbers, "x array<long>").distinct(), "fit-list")
    sums = _summed(listed, d, lambda x: np.append(x.astype(object).sum(axis=0), len(x)))
    n = sums.pop(d, 0)
    if not n:
        return None
    total = [sums[i] for i in range(d)]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    upper = np.triu_indices(d)
    products = _summed(listed, d, lambda x: _exact_products(x - centre)[upper])
    shifted = [s - n * int(c) for s, c in zip(total, centre)]
    covariance = np.zeros((d, d))
    for place, (i, j) in enumerate(zip(*upper)):
        covariance[i, j] = covariance[j, i] = (n * products[place] - shifted[i] * shifted[j]) / (n * n)
    model = Whitener(n, total, covariance, leading(covariance, components))
    model.identity_error = _identity_error(listed, d, model)
    return model


def _identity_error(listed: DataFrame, d: int, model: Whitener) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity."""
    k = len(model.components)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            x = _read(batch.column(0), d)
            for at in range(0, len(x), BLOCK):
                # the mean of what whitened() gives is zero by construction: rows are centred before they are multiplied
                w = model.whitened(x[at : at + BLOCK])[0]
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.reshape(-1))], ["place", "v"])

    rows = listed.select("x").mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    got = np.zeros(k * k)
    got[[r["place"] for r in rows]] = [r["v"] for r in rows]
    return float(np.abs(got.reshape(k, k) / model.n - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitener | None) -> DataFrame:
    """vec_id, component, n, deviation and whitened of every usable row of ``vectors`` (vec_id, embedding)."""
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double"
    d, k = (len(model.sums), len(model.components)) if model else (0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k:
                continue
            rows, x = whole_vectors(batch.column(1), d)
            for at in range(0, len(rows), BLOCK):
                w, deviation = model.whitened(x[at : at + BLOCK])
                fits = [int(v) if v < 1 << 63 else None for v in deviation] if deviation.dtype == object else deviation
                each = np.repeat(np.arange(len(w)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[at : at + BLOCK][each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                     pa.array(np.full(len(each), model.n)), pa.array(fits, pa.int64()).take(pa.array(each)), pa.array(w.reshape(-1))],
                    ["vec_id", "component", "n", "deviation", "whitened"],
                )

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def explained(model: Whitener | None):
    """The share of all variance that the row's component explains."""
    shares = [c.value / float(np.trace(model.covariance)) for c in model.components] if model else []
    return F.element_at(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("component")) if shares else F.lit(None).cast("double")


by_value(__name__)
