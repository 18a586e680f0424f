"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Texts become lower-case words (runs of letters and digits). Fixed masks slide over the words; a mask's hash covers
the words at its ones and ignores those at its zeros, so a replaced word breaks only the seeds that look at it.
Hashes of the items are joined with hashes of the documents. Around each hit the two texts are laid over each other:
the document leaks the item if some stretch of ``OVERLAP`` words there (or the whole item, if shorter), holding the
hit, has ``SIMILAR`` of its words equal place by place.

With ``short``, items of at most ``OVERLAP`` words are found by runs of equal words instead of masks, each run as long
as the longest that must be left when as many words are replaced as the check allows: none of their leaks is missed.
Longer items are found by masks, chosen so that a stretch of ``OVERLAP`` words is hit wherever its replaced words stand.
Items of fewer than ``least_words`` words are left out.

The items' hashes are broadcast in blocks of at most ``BLOCK`` seeds, so the size of a broadcast has a bound, and the
documents are read once for each block. Documents' words are never shuffled; hits are aggregated before they are.

Edge cases: a null or empty text, and without ``short`` an item with fewer words than the shortest mask, have no seeds
and match nothing; repeated documents and items give the same result for each; a null key is a key like others; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import fresh, small, text_key, written

#: Wherever two of 13 words are replaced, one of these masks has a place among the 13 that looks at neither.
MASKS = ("11011011", "11101001011", "111001001011")
OVERLAP = 13
SIMILAR = 0.8
BLOCK = 1_000_000


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def hashed(w: Column) -> Column:
    """The words' hashes: combining these is cheaper than hashing the words under every mask."""
    return F.transform(w, lambda x: F.xxhash64(x))


def seeded(rows: DataFrame, hashes: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``rows`` once for every place and mask: ``at``, ``span`` and ``h``, the hash of the words at the mask's ones.

    ``hashes`` names a column of word hashes. Places come from a generator and the hashes from plain expressions over
    it, so that all of it is generated code; inside lambda functions the same takes several times as long. The outer
    forms are used since Spark would test the others' arrays for being empty beforehand, by computing them twice.
    """
    n = F.size(hashes)
    places = rows.select("*", F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("at"))
    each = []
    for k, mask in enumerate(masks):
        ones = [F.col(hashes)[F.col("at") + j] for j, c in enumerate(mask) if c == "1"]
        each.append(F.when(F.col("at") + len(mask) <= n, F.xxhash64(F.lit(k), *ones)))
    out = places.select("*", F.posexplode_outer(F.array(*each)).alias("mask", "h")).where(F.col("h").isNotNull())
    span = reduce(lambda c, k: c.when(F.col("mask") == k, len(masks[k])), range(1, len(masks)), F.when(F.col("mask") == 0, len(masks[0])))
    return out.withColumn("span", span).drop("mask", hashes)


def run_length(n: Column, similar: float) -> Column:
    """Equal words in a row that are left at least when ``n`` words have ``similar`` of them equal."""
    need = F.ceil(n * similar - 1e-9)
    return F.ceil(need / (n - need + 1)).cast("int")


def _equal_stretch(overlap: int, similar: float) -> Column:
    """Whether a stretch around the hit is equal enough; over doc_w, item_w, doc_at, item_at, span."""
    n = F.least(F.lit(overlap), F.size("item_w"))
    need = F.ceil(n * similar - 1e-9)
    lag = F.col("doc_at") - F.col("item_at")
    same = lambda j: F.when(F.get("item_w", j) == F.get("doc_w", j + lag), 1).otherwise(0)
    first = F.greatest(F.lit(0), -lag, F.col("item_at") + F.col("span") - n)
    last = F.least(F.col("item_at"), F.size("item_w") - n, F.size("doc_w") - lag - n)
    total = lambda s: F.aggregate(F.transform(F.sequence(s, s + n - 1), same), F.lit(0), lambda a, x: a + x)
    return F.when(first <= last, F.exists(F.sequence(first, last), lambda s: total(s) >= need)).otherwise(F.lit(False))


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP, similar: float = SIMILAR, block: int = BLOCK, short: bool = False,
    least_words: int = 1,
) -> DataFrame:
    """One row for each key of ``docs`` (key, text) and item_id of ``items`` (item_id, text) that leaks: hits, equal words, first place."""
    known = items.select("item_id", tokens(F.col("text")).alias("item_w")).withColumn("item_key", F.xxhash64("item_w"))
    known = known.where(F.size("item_w") >= least_words)
    read = docs.select(F.col(key).alias("key"), tokens(F.col("text")).alias("doc_w")).withColumn("hashes", hashed(F.col("doc_w")))
    n = F.size("item_w")
    if not short:
        found = _found(read, known, masks, None, overlap, similar, block)
    else:
        found = _found(read, known.where(n > overlap), masks, None, overlap, similar, block)
        run = run_length(n, similar)
        lengths = sorted(r["run"] for r in known.where(n.between(1, overlap)).select(run.alias("run")).distinct().collect())
        if lengths:  # at most one for each number of words up to overlap
            found += _found(read, known.where(n.between(1, overlap)), tuple("1" * k for k in lengths), run, overlap, similar, block)
    out = reduce(DataFrame.unionAll, found)
    return out.select(F.col("key").alias(key), "item_id", "hits", "equal_words", "item_words", "start_word")


def _found(read: DataFrame, known: DataFrame, masks: tuple[str, ...], span: Column | None, overlap: int, similar: float, block: int) -> list[DataFrame]:
    """The leaks for each block of the items; an item's masks are those of the length ``span``, or all."""
    # a text that several items share is broadcast once, and by its key it falls into one block
    size = known.select("item_key", "item_w").distinct().agg(F.sum(F.size("item_w")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size * len(masks) // block))
    found = []
    for k in range(blocks):
        part = known.where(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == k)
        texts = part.select("item_key", "item_w").distinct()
        wanted = F.lit(None).cast("int") if span is None else span
        theirs = seeded(texts.select("item_key", wanted.alias("wanted"), hashed(F.col("item_w")).alias("hashes")), "hashes", masks)
        theirs = theirs.where(F.coalesce(F.col("span") == F.col("wanted"), F.lit(True))).select("item_key", F.col("at").alias("item_at"), "h")
        # all up to the check is one generated stage, in which a document's words are not copied
        ours = seeded(read, "hashes", masks).withColumnRenamed("at", "doc_at")
        hits = ours.join(F.broadcast(theirs), "h").join(F.broadcast(texts), "item_key")
        lag = F.col("doc_at") - F.col("item_at")
        equal = F.aggregate(
            F.transform(F.sequence(F.lit(0), F.size("item_w") - 1), lambda j: F.when((j + lag >= 0) & (F.get("item_w", j) == F.get("doc_w", j + lag)), 1).otherwise(0)),
            F.lit(0), lambda a, x: a + x,
        )
        good = hits.where(_equal_stretch(overlap, similar)).select("key", "item_key", lag.alias("start"), equal.alias("equal"), F.size("item_w").alias("item_words"))
        per_key = good.groupBy("key", "item_key").agg(
            F.count(F.lit(1)).alias("hits"), F.max("equal").alias("equal_words"), F.max("item_words").alias("item_words"), F.min("start").alias("start_word")
        )
        found.append(per_key.join(F.broadcast(part.select("item_key", "item_id").distinct()), "item_key"))
    return found


def drop_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, columns unchanged; decided by the text, so doc_id does not matter.

    The leaking texts' keys are written first; while they are few, the rows need not be shuffled to be told from them.
    """
    name = fresh(docs, "leak_key")
    keyed = docs.withColumn(name, text_key(F.col("text")))
    found = leaks(keyed.select(name, "text"), items, key=name, **options)
    keys = written(spark, found.select(name).distinct(), "leaking-texts")
    return keyed.join(small(keys), name, "left_anti").select(*docs.columns)
