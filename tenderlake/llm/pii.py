"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are the e-mail addresses, IP addresses, card numbers and phone numbers that fixed patterns find (``KINDS``).
The words just before a seed form a lexical pattern; pieces of text that look like identifiers but that no fixed
pattern takes are candidates, with the pattern before them. Patterns and instances (seeds and candidates) form a
graph that is scored in turns: a pattern's confidence for a kind is the sum of its instances' scores for it over the
number of its instances that could be of the kind plus ``DOUBT``; a candidate's score is the chance that at least one
of the patterns before it is right. A pattern counts for a kind once it has ``SUPPORT`` different seeds or candidates
that score ``ACCEPT``. Turns go on until no confidence changes by ``SETTLED``; a candidate that the kind's own test
refutes (a card number with a wrong check digit) never speaks for a pattern. Candidates behind a pattern of confidence
``ACCEPT`` become spans of the kind as well; they never replace a seed or overlap one.

Positions count code points from 0, ends exclusive. The patterns below give the same matches as those they are named
after, but need time in proportion to the text: runs are taken whole, and a match begins where a run does.

Edge cases: a null text has no spans; equal texts have equal spans (added spans are kept by a digest of the text, so
null and repeated doc_ids do not matter); an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import few, fresh, small, text_key, written

KINDS = ("email", "ip", "card", "phone")
_USER, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": f"(?:\\G|(?<!{_USER})){_USER}++@{_HOST}+(?:\\.{_HOST}+)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "phone": "+", "ip": ".", "card": None}
#: Pieces that look like identifiers: words with an @, and runs of digits that no letter touches.
CANDIDATE = (
    "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D@]{1,64}+@[^\\x20\\x09-\\x0D@]{1,255}+"
    "|(?<![\\p{L}\\p{N}_])[+(]?[0-9](?:[0-9().-]|\\x20(?=[0-9(]))*+(?![\\p{L}\\p{N}_])"
)
LEFT = "[\\p{L}]{2,40}[^\\p{L}\\p{N}]{0,4}$"
CONTEXT = 48
SETTLED = 1e-3
DOUBT = 2.0
SUPPORT = 3
ACCEPT = 0.8
TAGS = tuple(f"[{k.upper()}]" for k in KINDS)
SALTS = 32
_BLOCK = 512


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running(lengths: Column) -> Column:
    """Running sums of an array<int>, in blocks so that the work stays near the array's size."""
    add = lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)
    none = F.array().cast("array<int>")
    ids = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.element_at(b, -1))
        before = F.aggregate(F.slice(totals, 1, F.size(totals) - 1), F.array(F.lit(0)), add)
        return F.flatten(F.zip_with(blocks, before, lambda b, at: F.transform(b, lambda x: x + at)))

    blocks = F.transform(ids, lambda b: F.aggregate(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)), none, add))
    return F.when(F.size(lengths) > 0, let(blocks, joined)).otherwise(none)


def found(text: Column, pattern: str) -> Column:
    """array of (s, e, value, left): the pattern's matches in turn, and the text before each back to the one before."""
    kind = "array<struct<s:int,e:int,value:string,left:string>>"
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        def cut(pieces: Column) -> Column:
            steps = F.zip_with(pieces, m, lambda p, x: F.length(p) + F.coalesce(F.length(x), F.lit(0)))
            spans = lambda ends: F.transform(
                m, lambda x, i: F.struct((ends[i] - F.length(x)).alias("s"), ends[i].alias("e"), x.alias("value"), F.right(pieces[i], F.lit(CONTEXT)).alias("left"))
            )
            return let(running(steps), spans)

        return F.when(F.size(m) > 0, let(F.split(text, pattern, -1), cut)).otherwise(F.array().cast(kind))

    return let(matches, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    one = lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _octet(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(F.when(F.length(bare) <= 3, bare).try_cast("int"), F.lit(0)) <= 255)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, "\\."), _octet),
    "card": lambda v: let(_digits(v), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False))),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def seeds(text: Column) -> Column:
    """array of (k, s, e, value, left) of the fixed patterns, by kind and start."""
    out = []
    for k, kind in enumerate(KINDS):
        tagged = F.transform(_valid(found(text, PATTERNS[kind]), kind), _tag(k))
        if NEEDS[kind]:
            tagged = F.when(F.contains(text, F.lit(NEEDS[kind])), tagged).otherwise(F.array().cast("array<struct<k:int,s:int,e:int,value:string,left:string>>"))
        out.append(tagged)
    return F.concat(*out)


def _valid(matches: Column, kind: str) -> Column:
    return F.filter(matches, lambda x: VALID[kind](x["value"]))


def _tag(k: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["value"].alias("value"), x["left"].alias("left"))


def _pattern(left: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(left), LEFT, 0), "[\\x20\\x09-\\x0D]+", " ")


def candidates(text: Column, base: Column) -> Column:
    """array of (s, e, value, pattern) of identifier-like pieces with a pattern before them that overlap no span of ``base``."""
    core = "^.*[\\p{L}\\p{N}]"  # without punctuation at its end

    def bare(x: Column) -> Column:
        return let(
            F.regexp_extract(x["value"], core, 0),
            lambda v: F.struct(x["s"].alias("s"), (x["s"] + F.length(v)).alias("e"), v.alias("value"), _pattern(x["left"]).alias("pattern")),
        )

    likely = lambda x: (x["pattern"] != "") & (F.contains(x["value"], F.lit("@")) | (F.length(_digits(x["value"])) >= 5))
    free = lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    return F.filter(F.filter(F.transform(found(text, CANDIDATE), bare), likely), free)


def _fits(kind: str, value: Column) -> Column:
    """Whether a candidate's shape could be of the kind at all."""
    n = F.length(_digits(value))
    return {
        "email": F.contains(value, F.lit("@")),
        "ip": value.rlike("^[0-9]+(\\.[0-9]+){3}$"),
        "card": n.between(12, 19) & ~value.rlike("[.()@]"),
        "phone": n.between(7, 15) & ~value.rlike("[@]") & ~value.rlike("^[0-9]+(\\.[0-9]+){3}$"),
    }[kind]


def _refuted(value: Column, k: Column) -> Column:
    """Whether a candidate has the form that the fixed pattern of its kind asks for, but fails its test."""
    n = F.length(_digits(value))
    return ((k == KINDS.index("card")) & n.between(13, 19) & ~VALID["card"](value)) | ((k == KINDS.index("ip")) & ~VALID["ip"](value))


def trusts(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(pattern, k, trust) of the patterns that count, settled; from ``edges`` (pattern, value, k, seed, refuted).

    Confidences only grow from turn to turn. A pattern's own part in its candidates' scores is solved for at once: with
    miss the chance that all other patterns before a candidate are wrong, its score is 1 - miss + miss * trust, so
    trust * (n + DOUBT) = seeds + sum(1 - miss) + sum(miss) * trust. Turns then only carry trust between patterns.
    """
    n = F.count(F.lit(1))
    totals = edges.groupBy("pattern", "k").agg(n.alias("n"), F.sum(F.col("seed").cast("long")).alias("seeds"))
    totals = written(spark, totals, "pii-patterns")
    open_edges = written(spark, edges.where("not seed and not refuted").select("pattern", "value", "k"), "pii-candidates")
    known = None
    while True:
        if known is None:
            trust = totals.where(F.col("seeds") >= SUPPORT).select("pattern", "k", (F.col("seeds") / (F.col("n") + DOUBT)).alias("trust"))
            trust = written(spark, trust, "pii-trust")
        else:
            own = open_edges.join(small(known.withColumnRenamed("trust", "own")), ["pattern", "k"], "left")
            miss = F.log1p(-F.least("own", F.lit(1 - 1e-9)))
            all_miss = written(spark, own.where("own is not null").groupBy("value", "k").agg(F.sum(miss).alias("all_miss")), "pii-scores")
            seen = own.join(all_miss, ["value", "k"]).withColumn("miss", F.exp(F.least(F.col("all_miss") - F.coalesce(miss, F.lit(0.0)), F.lit(0.0))))
            sums = seen.groupBy("pattern", "k").agg(
                F.sum("miss").alias("miss"), n.alias("heard"), F.sum((1 - F.exp("all_miss") >= ACCEPT).cast("long")).alias("taken"),
            )
            total = totals.join(sums, ["pattern", "k"], "left").na.fill(0, ["miss", "heard", "taken"])
            solved = (F.col("seeds") + F.col("heard") - F.col("miss")) / (F.col("n") + DOUBT - F.col("miss"))
            trust = total.join(small(known.withColumnRenamed("trust", "old")), ["pattern", "k"], "left")
            trust = trust.where((F.col("seeds") + F.col("taken") >= SUPPORT) | F.col("old").isNotNull())
            trust = written(spark, trust.select("pattern", "k", F.greatest(solved, F.coalesce("old", F.lit(0.0))).alias("trust"), "old"), "pii-trust")
            if not trust.where(F.col("old").isNull() | (F.col("trust") - F.col("old") >= SETTLED)).limit(1).count():
                return trust.drop("old")
        known = trust.select("pattern", "k", "trust")


def accepted(spark: SparkSession, seen: DataFrame, free: DataFrame) -> DataFrame:
    """(pattern, value, k) of the candidates that the graph's confident patterns take.

    ``seen`` has the seeds (pattern, value, k), ``free`` the candidates (pattern, value); repeated rows count once.
    """
    own = seen.where("pattern <> ''").select("pattern", "value", "k", F.lit(True).alias("seed"))
    fits = F.array_compact(F.array(*[F.when(_fits(kind, F.col("value")), k) for k, kind in enumerate(KINDS)]))
    other = free.select("pattern", "value", F.explode(fits).alias("k"), F.lit(False).alias("seed"))
    edges = own.unionAll(other).groupBy("pattern", "value", "k").agg(F.max("seed").alias("seed"))
    edges = written(spark, edges.withColumn("refuted", ~F.col("seed") & _refuted(F.col("value"), F.col("k"))), "pii-edges")
    sure = written(spark, trusts(spark, edges).where(F.col("trust") >= ACCEPT), "pii-sure")
    taken = edges.where("not seed").join(small(sure), ["pattern", "k"])
    best = F.max(F.struct("trust", (-F.col("k")).alias("k")))
    return taken.groupBy("pattern", "value").agg(best.alias("b")).select("pattern", "value", (-F.col("b.k")).alias("k"))


def _spans(x: Column) -> Column:
    return F.transform(x, lambda b: F.struct(b["k"].alias("k"), b["s"].alias("s"), b["e"].alias("e")))


def surveyed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, base spans) of ``docs`` (doc_id, text), and the added spans (text_key, added) of its texts."""
    t = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", t.alias("text"), text_key(F.col("text")).alias("text_key")).withColumn("seeds", seeds(F.col("text")))
    read = read.withColumn("free", F.when(F.col("text").rlike("[0-9@]"), candidates(F.col("text"), F.col("seeds"))))
    read = read.withColumn("seen", F.transform("seeds", lambda x: F.struct(_pattern(x["left"]).alias("pattern"), x["value"].alias("value"), x["k"].alias("k"))))
    rows = written(spark, read.select("doc_id", "text_key", _spans(F.col("seeds")).alias("base"), "seen", "free"), "pii-rows")
    free = rows.select("text_key", F.explode("free").alias("x")).select("text_key", "x.*")
    takes = accepted(spark, rows.select(F.explode("seen").alias("x")).select("x.*"), free)
    added = free.join(takes, ["pattern", "value"]).groupBy("text_key").agg(F.collect_set(F.struct("k", "s", "e")).alias("added"))
    return rows.select("doc_id", "text_key", "base"), added


def merged(base: Column, added: Column) -> Column:
    """All spans, by kind and start."""
    return F.sort_array(F.concat(base, F.coalesce(added, F.array().cast("array<struct<k:int,s:int,e:int>>"))))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of (k, s, e), k an index of KINDS) of every row of ``docs`` (doc_id, text)."""
    rows, added = surveyed(spark, docs)
    return _with_added(spark, rows, added, "text_key", "added").select("doc_id", "base", merged(F.col("base"), F.col("added")).alias("spans"))


def _with_added(spark: SparkSession, rows: DataFrame, added: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the added spans of their text. While few texts have any, the rows are not shuffled for them."""
    added = written(spark, added.select(F.col("text_key").alias(key), F.col("added").alias(name)), "pii-added")
    if few(added):
        return rows.join(F.broadcast(added), key, "left")
    # very many copies of a text are spread over SALTS parts; only texts with added spans are repeated for them
    salt = fresh(rows, "pii_salt")
    rows = rows.withColumn(salt, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    added = added.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.join(added, [key, salt], "left").drop(salt)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the tag of its first kind."""
    by_start = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))
    tags = F.array(*[F.lit(x) for x in TAGS])
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        fresh_span = x["s"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), tags[x["k"]])
        return F.struct(F.when(fresh_span, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["e"]).alias("at"))

    end = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(by_start, start, step, end)).otherwise(text)


def mask(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of its texts replaced by tags; a column n_chars follows the new text, others stay."""
    key, base, added = (fresh(docs, x) for x in ("pii_key", "pii_base", "pii_added"))
    _, extra = surveyed(spark, docs.select("doc_id", "text"))
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn(key, text_key(F.col("text"))).withColumn(base, seeds(t)).withColumn(base, _spans(F.col(base)))
    rows = _with_added(spark, rows, extra, key, added).withColumn(base, merged(F.col(base), F.col(added)))
    rows = rows.withColumn("text", F.when(F.size(base) > 0, masked(F.col("text"), F.col(base))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size(base) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
