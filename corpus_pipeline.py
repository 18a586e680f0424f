"""The corpus pipeline: quality, near copies, benchmark leaks, personal data, token ids.

Every stage takes all rows its predecessor kept and decides by texts, so null and repeated doc_ids, empty texts and
extra columns pass through: a null or empty text is scored, fingerprinted and encoded like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import bpe, decontaminate, pii, quality, simhash
from tenderlake.llm.common import fresh, table, written
from tenderlake.llm.queries import default_ranks


#: Benchmark items of fewer words, such as a one-word answer, stand in clean texts too: they drop nothing.
LEAST_ITEM_WORDS = 5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    model = quality.fit(docs, quality.train_labels(table(spark, sf_dir, "labels"), "quality"))
    return quality.keep_good(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(spark, docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that leak no benchmark item of ``LEAST_ITEM_WORDS`` words or more."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.drop_leaks(spark, docs, items, short=True, least_words=LEAST_ITEM_WORDS)


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by tags."""
    return pii.mask(spark, docs)


def with_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and number."""
    ids = fresh(docs, "token_ids")
    return bpe.encode(spark, docs, default_ranks(), ids).withColumn(fresh(docs, "n_tokens"), F.size(ids).cast("long"))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("benchmark decontamination", no_benchmark),
    ("PII", no_personal_data),
    ("BPE encoding", with_token_ids),
]

#: The classifier's fit, the components and the token ids have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
