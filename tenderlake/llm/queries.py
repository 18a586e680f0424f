"""The registered query of each operator, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import bpe, decontaminate, langid, phrases, pii, quality, rules, secrets, shards, simhash, substrings, toxicity, whitening
from tenderlake.llm.common import fold, table


def default_ranks() -> str:
    """The public vocabulary that the queries use; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _held_out(folds: int, held: int):
    return F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))


def op1_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and near-duplicate component (at most 2 differing bits a link)."""
    out = simhash.near_duplicates(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40 and slot, by differencing of groups of equal texts."""
    out = shards.shard(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by out-of-place distance to profiles learned from the other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = _held_out(4, 2)
    profiles = langid.learn(docs.where(~held))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), profiles)


def op4_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by the regularised quadratic discriminant."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.train_labels(table(spark, sf_dir, "labels"), "quality"))
    return docs.select(
        "doc_id", _held_out(quality.FOLDS, quality.HELD_OUT).alias("held_out"), quality.score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op5_weak_supervision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and the verdict of the weakly supervised rules."""
    out = rules.judged(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op6_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it leaks: hits, equal words and where the item would start."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), short=True)


def op7_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of token ids, and digests of the ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(spark, docs, default_ranks(), ids="ids", decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the fixed patterns' spans, and all spans."""
    found = pii.find(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[_kind_count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


def _kind_count(k: int):
    return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")


def op9_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score from misspelling-tolerant lexicon matches in context."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = quality.train_labels(table(spark, sf_dir, "labels"), "toxic", toxicity.FOLDS, toxicity.HELD_OUT)
    model = toxicity.fit(docs, labels)
    return docs.select(
        "doc_id", _held_out(toxicity.FOLDS, toxicity.HELD_OUT).alias("held_out"), toxicity.score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_de_bruijn_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, those in 35-word passages that occur twice or more, and the digest of the rest."""
    out = substrings.remove_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts and digest of the base patterns' spans, and all spans."""
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [secrets.count_kind(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.BASE]
    base = secrets.listed(secrets.base_only(F.col("spans")))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op12_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector projected on the four leading components, each to unit variance."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(spark, vectors)
    error = F.lit(model.identity_error if model else None).cast("double")
    return whitening.whiten(vectors, model).withColumns({"explained": whitening.explained(model), "identity_error": error})


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's 2,000 strongest phrases of two and three words."""
    return phrases.collocations(spark, table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_simhash_bk_trees, op2_karmarkar_karp_shards, op3_rank_order_language, op4_quadratic_quality, op5_weak_supervision_rules, op6_spaced_seed_leaks, op7_chunk_reuse_bpe, op8_bootstrapped_pii, op9_levenshtein_toxicity, op10_de_bruijn_substrings, op11_secret_scans, op12_spectrum_whitening, op13_phrase_collocations)}


def _leaks_sql() -> str:
    """The seeds as the masked words themselves, joined and checked as the operator does."""
    def seeded(name: str, row: str) -> str:
        parts = []
        for k, mask in enumerate(decontaminate.MASKS):
            key = " || ' ' || ".join(f"w[i + {j + 1}]" for j, c in enumerate(mask) if c == "1")
            parts.append(f"SELECT {row}, w, i AS at, {len(mask)} AS span, '{k} ' || {key} AS seed FROM {name}, unnest(range(0, greatest(0, len(w) - {len(mask) - 1}))) u(i)")
        return " UNION ALL ".join(parts)

    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w"
    same = "CASE WHEN item_w[j + 1] = doc_w[j + lag + 1] THEN 1 ELSE 0 END"
    return f"""
    WITH d AS (SELECT doc_id, {words} FROM documents), b AS (SELECT item_id, {words} FROM benchmark),
    ds AS ({seeded("d", "doc_id")}), bs AS ({seeded("b", "item_id")}),
    h AS (SELECT doc_id, item_id, ds.w AS doc_w, bs.w AS item_w, bs.at AS item_at, ds.at - bs.at AS lag, ds.span AS span,
                 least({decontaminate.OVERLAP}, len(bs.w)) AS n
          FROM ds JOIN bs USING (seed)),
    c AS (SELECT *, greatest(0, -lag, item_at + span - n) AS low, least(item_at, len(item_w) - n, len(doc_w) - lag - n) AS high,
                 ceil(n * {decontaminate.SIMILAR} - 1e-9) AS need FROM h),
    g AS (SELECT doc_id, item_id, lag, len(item_w) AS m,
                 list_sum(list_transform(range(0, len(item_w)), lambda j: CASE WHEN j + lag >= 0 THEN {same} ELSE 0 END)) AS equal
          FROM c WHERE low <= high AND len(list_filter(range(low, high + 1), lambda s: list_sum(list_transform(range(s, s + n), lambda j: {same})) >= need)) > 0)
    SELECT doc_id, item_id, count(*) AS hits, CAST(max(equal) AS INTEGER) AS equal_words, CAST(max(m) AS INTEGER) AS item_words,
           CAST(min(lag) AS INTEGER) AS start_word
    FROM g GROUP BY doc_id, item_id"""


def _substrings_sql(window: int = substrings.WINDOW) -> str:
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                      list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    win AS (SELECT r, i, array_to_string(w[i : i + {window - 1}], ' ') AS s FROM d, unnest(range(1, greatest(1, len(w) - {window - 2}))) u(i)),
    twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
    gone AS (SELECT DISTINCT r, i + j AS p FROM win JOIN twice USING (s), range({window}) t(j)),
    words AS (SELECT r, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) u(p)),
    kept AS (SELECT r, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS text
             FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


def _secrets_sql() -> str:
    """Each pattern run over whole texts: a match stands behind what it and the matches before it leave; checksums by folds over characters."""
    def spans(kind: str, pattern: str, good: str, flags: str = "c") -> str:
        quoted = "'" + pattern.replace("'", "''") + "'"
        return f"""SELECT r, {secrets.KINDS.index(kind)} AS k, '{kind}' AS kind, s, s + len(x) AS e FROM (
          SELECT r, t, x[i] AS x, CAST(list_sum(list_transform(gap[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(x[1:i - 1], lambda m: len(m))), 0) AS BIGINT) AS s
          FROM (SELECT r, t, regexp_extract_all(t, {quoted}, 0, '{flags}') AS x, regexp_split_to_array(t, {quoted}, '{flags}') AS gap FROM d), unnest(range(1, len(x) + 1)) u(i))
          WHERE {good}"""

    def alone(extra: str = "") -> str:
        return f"NOT regexp_matches(substr(t, s, CASE WHEN s > 0 THEN 1 ELSE 0 END), '[A-Za-z0-9{extra}]') AND NOT regexp_matches(substr(t, s + len(x) + 1, 1), '[A-Za-z0-9{extra}]')"

    shift = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)"

    def crc(body: str) -> str:
        codes = f"list_transform(range(1, 31), lambda j: CAST(ascii(substr({body}, j, 1)) AS BIGINT))"
        folded = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {shift}), CAST(4294967295 AS BIGINT))"
        digits = ", ".join(str(62 ** k) for k in range(5, -1, -1))
        return f"array_to_string(list_transform([{digits}], lambda p: substr('{secrets.BASE62}', 1 + ({folded} // p) % 62, 1)), '')"

    def bech32(prefix: str, data: str) -> str:
        head = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
        values = f"list_concat([CAST(1 AS BIGINT), {', '.join(map(str, head))}], list_transform(range(1, 59), lambda j: CAST(instr('{secrets.BECH32}', substr({data}, j, 1)) - 1 AS BIGINT)))"
        state = "xor((c & 33554431) << 5, v)"
        for bit, step in enumerate(secrets.BECH32_STEPS):
            state = f"xor({state}, CASE WHEN ((c >> 25) >> {bit}) & 1 = 1 THEN CAST({step} AS BIGINT) ELSE 0 END)"
        return f"list_reduce({values}, lambda c, v: {state}) = 1"

    assign = secrets.PATTERNS["assign"].pattern.decode()
    value = "regexp_extract(x, '^" + assign.replace("'", "''") + "$', 1, 'i')"
    letters = "[A-Za-z0-9]{36}"
    parts = [
        spans("assign", assign, f"len({value}) >= {secrets.ASSIGN_LEAST}", "i"),
        spans("access", "AKIA[A-Z0-9]+", f"len(x) >= {secrets.ACCESS_LEAST}"),
        spans("hex", "[0-9a-f]+", f"len(x) >= {secrets.HEX_LEAST}"),
        spans("github", "gh[pousr]_" + letters, f"{alone('_')} AND substr(x, 35, 6) = {crc('substr(x, 5, 30)')}"),
        spans("npm", "npm_" + letters, f"{alone('_')} AND substr(x, 35, 6) = {crc('substr(x, 5, 30)')}"),
        spans("age", "AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}", f"{alone()} AND {bech32(secrets.PREFIXES['age'], 'lower(substr(x, 17))')}"),
        spans("nostr", "nsec1[02-9ac-hj-np-z]{58}", f"{alone()} AND {bech32(secrets.PREFIXES['nostr'], 'substr(x, 6)')}"),
    ]
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k){}, '')"
    base = f" FILTER (WHERE k < {len(secrets.BASE)})"
    counts = ", ".join(f"CAST(count(k) FILTER (WHERE k = {k}) AS BIGINT) AS n_{kind}" for k, kind in enumerate(secrets.BASE))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    f AS ({" UNION ALL ".join(parts)})
    SELECT any_value(doc_id) AS doc_id, {counts}, sha256({listed.format(base)}) AS base_sha256, {listed.format("")} AS spans
    FROM d LEFT JOIN f USING (r) GROUP BY r"""


def _phrases_sql(least: int = phrases.LEAST, top: int = phrases.TOP) -> str:
    """All runs of one to three words counted as strings."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = " UNION ALL ".join(f"SELECT lang, {n} AS k, array_to_string(w[i : i + {n - 1}], ' ') AS s FROM p, unnest(range(1, len(w) - {n - 2})) u(i) WHERE len(w) >= {n}" for n in (1, 2, 3))
    score = "CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST({l} AS HUGEINT) * {r}) AS BIGINT)"
    return f"""
    WITH t AS (SELECT coalesce(lang, '{phrases.UNKNOWN_LANG}') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents),
    q AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS q FROM t),
    p AS (SELECT lang, list_filter(regexp_split_to_array(q, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM q),
    f AS (SELECT lang, k, s, count(*) AS a FROM ({runs}) GROUP BY lang, k, s),
    n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    g AS (SELECT lang, k, s, a, string_split(s, ' ') AS w FROM f WHERE k > 1 AND a >= {least}),
    cuts AS (SELECT g.lang, g.k, g.s, g.a, x.a AS l, y.a AS r, c, {score.format(l="x.a", r="y.a").replace("(a AS", "(g.a AS").replace("* a //", "* g.a //")} AS score
             FROM g, unnest([1, 2]) c(c), f x, f y
             WHERE c < g.k AND x.lang = g.lang AND y.lang = g.lang AND x.s = array_to_string(g.w[1:c], ' ') AND y.s = array_to_string(g.w[c + 1:], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, c) = 1),
    held AS (SELECT lang, s, max(a) AS a FROM (SELECT lang, array_to_string(w[1:2], ' ') AS s, a FROM g WHERE k = 3
             UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM g WHERE k = 3) GROUP BY lang, s),
    ranked AS (SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.s) AS rank, best.s AS phrase, best.a, l, r, score
               FROM best LEFT JOIN held ON held.lang = best.lang AND held.s = best.s AND best.k = 2
               WHERE held.a IS NULL OR 100 * held.a < 50 * best.a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""


def oracles() -> dict[str, str]:
    return {"op6_spaced_seed_leaks": _leaks_sql(), "op10_de_bruijn_substrings": _substrings_sql(), "op11_secret_scans": _secrets_sql(), "op13_phrase_collocations": _phrases_sql()}
