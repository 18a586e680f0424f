import math

import numpy as np
import pytest

from tenderlake.llm import whitening as wh


def test_counts_equal_numpy_eigenvalues():
    rnd = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 25):
        for _ in range(20):
            a = rnd.normal(size=(d, d))
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            for shift in np.concatenate([rnd.normal(size=4) * d, (e[1:] + e[:-1]) / 2]):
                assert wh.count_above(a, shift) == (e > shift).sum()
    zero_diagonal = np.array([[0.0, 1, 0], [1, 0, 2], [0, 2, 0]])
    assert wh.count_above(zero_diagonal, 0.0) == 1 and wh.count_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", [[9, 4, 2, 1, 0.5], [5, 5 - 1e-9, 5 - 2e-9, 1, 1], [3, 3, 3, 3, 1], [1e9, 1, 1e-5, 1e-9, 0], [7, 0, 0, 0, 0], [2, 1.999, 1.998, 1.997, 1.996]])
def test_components_by_slicing(values):
    rnd = np.random.default_rng(3)
    q, _ = np.linalg.qr(rnd.normal(size=(5, 5)))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    got = wh.leading(v, 4)
    positive = [x for x in sorted(values, reverse=True)[:4] if x > 1e-12 * max(values)]
    assert len(got) == len(positive)
    for c, want in zip(got, positive):
        assert abs(c.value - want) <= 1e-13 * max(values)
        assert np.linalg.norm(v @ c.vector - c.value * c.vector) <= 1e-13 * max(values)
        assert c.above < c.number <= c.reached
    axes = np.array([c.vector for c in got])
    assert np.abs(axes @ axes.T - np.eye(len(got))).max() < 1e-9
    assert wh.leading(np.zeros((4, 4))) == []


def brute(rows, k=4):
    """Covariance of the distinct whole-number vectors and its eigenvectors by numpy."""
    x = {i: tuple(math.floor(256 * c) for c in v) for i, v in rows}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(float) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    out = {}
    for i, v in x.items():
        moved = np.array(v, dtype=object) * n - s
        out[i] = (int((moved * moved).sum()), (moved / n).astype(float) @ axes / np.sqrt(e))
    return n, e, out, np.trace(centred.T @ centred / n)


def test_whitened_vectors_equal_numpy(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=12) * np.arange(1, 13)).astype(np.float32).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    rows += [(None, rows[8][1]), (2000, [-0.0] * 12)]
    bad = [(3000, None), (3001, []), (3002, [1.0] * 5), (3003, [None] + [1.0] * 11), (3004, [float("nan")] + [1.0] * 11), (3005, [float("inf")] + [1.0] * 11)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<double>, n string").repartition(7)
    model = wh.fit(spark, vectors)
    n, e, want, trace = brute([(i, v) for i, v in rows])
    assert model.n == n == 301 and model.identity_error < 1e-10
    assert np.allclose([c.value for c in model.components], e, rtol=1e-12, atol=0)
    got = wh.whiten(vectors, model).withColumn("explained", wh.explained(model)).collect()
    assert len(got) == 4 * len(rows)
    sign = {}
    for r in got:
        deviation, w = want[r.vec_id]
        k = r.component - 1
        sign.setdefault(k, np.sign(w[k] * r.whitened) or 1)
        assert r.n == n and r.deviation == deviation and abs(w[k] * sign[k] - r.whitened) < 1e-9
        assert abs(r.explained - e[k] / trace) < 1e-12
    again = wh.fit(spark, vectors.repartition(2))
    assert (again.covariance == model.covariance).all()


def test_few_vectors_and_directions(spark):
    def rows_of(data):
        vectors = spark.createDataFrame(data, "vec_id int, embedding array<float>")
        model = wh.fit(spark, vectors)
        return wh.whiten(vectors, model).withColumn("explained", wh.explained(model)).collect()

    assert rows_of([]) == [] and rows_of([(1, None)]) == [] and rows_of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    line = rows_of([(i, [float(i), 2.0 * i, 5.0]) for i in range(5)])
    assert len(line) == 5 and all(r.component == 1 and abs(r.explained - 1) < 1e-12 for r in line)
    huge = rows_of([(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])])
    assert all(r.deviation is None or r.deviation > 0 for r in huge) and {r.component for r in huge} >= {1}


def test_query_on_embeddings(spark):
    from tenderlake.llm.queries import op12_spectrum_whitening

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    good = [(r.vec_id, r.embedding) for r in rows if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    n, e, want, trace = brute(good)
    got = op12_spectrum_whitening(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 4 * len(good)
    for r in got:
        deviation, w = want[r.vec_id]
        assert r.n == n and r.deviation == deviation and abs(abs(w[r.component - 1]) - abs(r.whitened)) < 1e-8
        assert abs(r.explained / (e[r.component - 1] / trace) - 1) < 1e-9 and r.identity_error < 1e-9
