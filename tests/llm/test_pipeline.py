import corpus_pipeline
from tenderlake.llm import decontaminate, quality, simhash
from tests_llm_brute import brute_pii_mask, fingerprint_groups, tokenizer

D = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage's rows from the rows of the one before, recomputed outside Spark."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(spark, stage(spark, docs, D), "test")
        out[name] = (before, docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns

    before, after = out["quality classifier"]
    model = quality.fit(before, quality.train_labels(spark.read.parquet(f"{D}/labels.parquet"), "quality"))
    import numpy as np

    want = {r.doc_id for r in before.collect() if model.scores(np.stack([quality.statistics(r.text)]))[0] >= quality.THRESHOLD}
    assert {r.doc_id for r in after.collect()} == want and len(want) < before.count()

    before, after = out["SimHash near-dedup"]
    groups = fingerprint_groups({r.doc_id: simhash.fingerprint(r.text) for r in before.collect()})
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)

    before, after = out["benchmark decontamination"]
    items = [" ".join(decontaminate_tokens(r.text)) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in before.collect() if any(f" {x} " in f" {' '.join(decontaminate_tokens(r.text))} " for x in items)}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == leaky

    before, after = out["PII"]
    old = {r.doc_id: r for r in before.collect()}
    for r in after.collect():
        text = brute_pii_mask(old[r.doc_id].text)
        assert r.text == text and r.n_chars == (len(text) if text != old[r.doc_id].text else old[r.doc_id].n_chars)
        assert (r.lang, r.source) == (old[r.doc_id].lang, old[r.doc_id].source)

    before, after = out["BPE encoding"]
    for r in after.collect():
        ids = tokenizer().encode(r.text, add_special_tokens=False).ids
        assert r.token_ids == ids and r.n_tokens == len(ids)
    assert after.count() == before.count()


def decontaminate_tokens(text):
    import re

    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def test_run_writes_the_same_rows(spark):
    docs = corpus_pipeline.run(spark, D)
    assert docs.count() > 50 and {"token_ids", "n_tokens", "doc_id", "text"} <= set(docs.columns)
    assert decontaminate.MASKS and corpus_pipeline.ORACLE_SQL is None


def test_odd_documents_pass_every_stage(spark):
    rows = [(None, None, None, "s", None, "x"), (1, "", "en", None, 0, "x"), (1, "", "en", None, 0, "x"), (2, "long text here " * 4000, None, None, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, token_ids string")
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.written(spark, stage(spark, docs, D), "odd")
    got = docs.collect()
    assert "_token_ids" in docs.columns and sorted(len(r.text or "") for r in got) == [0, 60_000]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.written(spark, stage(spark, empty, D), "none")
    assert empty.count() == 0
