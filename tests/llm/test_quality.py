import numpy as np

from tenderlake.llm import quality


def test_scores_equal_the_plain_formula():
    rng = np.random.default_rng(3)
    d = len(quality.statistics("x y"))
    means = [rng.normal(size=d), rng.normal(size=d)]
    covs = []
    for _ in range(2):
        a = rng.normal(size=(d, d))
        covs.append(a @ a.T + np.eye(d))
    whiten = [np.linalg.inv(np.linalg.cholesky(c)) for c in covs]
    logs = [np.log(p) - 0.5 * np.linalg.slogdet(c)[1] for p, c in zip((0.3, 0.7), covs)]
    model = quality.Discriminant(np.zeros(d), np.ones(d), means, whiten, logs)
    x = rng.normal(size=(20, d))
    density = [np.log(p) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m) for p, c, m in zip((0.3, 0.7), covs, means)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_moments_and_fit_on_small_table(spark):
    good = [(i, f"A calm sentence number {i} follows, with words and more words.") for i in range(40)]
    bad = [(100 + i, "BUY!! " * (i + 3) + "$$$ ###") for i in range(40)]
    docs = spark.createDataFrame(good + bad + [(None, None), (999, "")], "doc_id int, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad] + [(None, 1), (1, None)], "doc_id int, label int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality.score(docs.text, model).alias("s")).collect()}
    assert min(got[i] for i, _ in good) > 0.7 > max(got[i] for i, _ in bad)
    assert all(0 <= s <= 1 for s in got.values())
    kept = quality.keep_good(docs.withColumn("quality_score", docs.text), model)
    assert kept.columns == ["doc_id", "text", "quality_score"] and {i for i, _ in good} <= {r.doc_id for r in kept.collect()}


def test_missing_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id int, text string")
    for rows, want in (([], 1.0), ([(1, 1)], 1.0), ([(1, 0)], 0.0)):
        model = quality.fit(docs, spark.createDataFrame(rows, "doc_id int, label int"))
        assert {r.s for r in docs.select(quality.score(docs.text, model).alias("s")).collect()} == {want}
    assert docs.limit(0).select(quality.score(docs.text, model)).count() == 0


def test_held_out_accuracy(spark):
    from tenderlake.llm.queries import op4_quadratic_quality

    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op4_quadratic_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    hit = {q: np.mean([r.predicted == q for r in rows if r.quality == q]) for q in (0, 1)}
    assert hit[0] > 0.97 and hit[1] > 0.99
