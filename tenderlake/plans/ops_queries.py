"""Queries for period selection, links, manifests, scalars, the table sink, archives and metrics.

Inputs are derived from the driver tables (order and ship months, page HTML, customer
segments, part types, documents); every query runs the library operator over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import links as L
from tenderlake.operators import manifest as M
from tenderlake.operators import metrics as MT
from tenderlake.operators import periods as P
from tenderlake.operators.entries import to_entries
from tenderlake.plans.feed_files import feed_root, feed_roots
from tenderlake.session import scratch_path
from tenderlake.sinks.table import COMPACT_BYTES, compact_stored, empty_entries, read_entries, table_files, write_entries
from tenderlake.sources.archives import read_archive_entries
from tenderlake.sources.fsio import folders
from tenderlake.sources.xml_feed import GZIP_GLOB, list_feed_files, parse_entries, read_entries_strict, read_entry_texts


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(c) -> F.Column:
    return F.date_format(c, "yyyyMM")


def period_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Available (period, url): every order month and year, as a listing would offer them."""
    o = _t(spark, sf_dir, "orders").select("o_orderdate")
    p = o.select(F.explode(F.array(_month("o_orderdate"), F.date_format("o_orderdate", "yyyy"))).alias("period"))
    p = p.distinct()
    return p.select("period", F.concat(F.lit("https://host/data_"), F.col("period"), F.lit(".zip")).alias("url"))


# ----------------------------------------------------------------------------- periods

def period_format(spark, sf_dir):
    """F2/F6 over text keys of mixed shape taken from customers and orders."""
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    cand = (c.select(F.col("c_custkey").cast("string").alias("candidate"))
             .unionByName(c.select(F.col("c_mktsegment").alias("candidate")))
             .unionByName(c.select(F.substring("c_mktsegment", 100, 5).alias("candidate")))
             .unionByName(o.select(_month("o_orderdate").alias("candidate")))
             .unionByName(o.select(F.date_format("o_orderdate", "yyyy").alias("candidate")))
             .unionByName(o.select(F.date_format("o_orderdate", "yyyyMMdd").alias("candidate")))
             .unionByName(o.select(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("\n")).alias("candidate"))))
    cand = cand.distinct()
    return cand.select("candidate", P.is_valid_period(F.col("candidate")).alias("is_valid"),
                       P.period_reason(F.col("candidate")).alias("reason"))


def period_range(spark, sf_dir):
    return P.filter_periods(period_links(spark, sf_dir), "1995", "199612")


def period_range_open(spark, sf_dir):
    return P.filter_periods(period_links(spark, sf_dir), "1997", None)


BOUNDS = ["199213", "1995", "2099", "199507"]


def period_bounds_missing(spark, sf_dir):
    """requested bounds absent from the available periods, with the sorted list of those."""
    links = period_links(spark, sf_dir)
    avail = P.available(links).first()  # one aggregated row, as in the error message
    return P.missing_bounds(links, BOUNDS).withColumn("available", F.lit(avail.available if avail else ""))


def period_available(spark, sf_dir):
    return P.available(period_links(spark, sf_dir))


# ----------------------------------------------------------------------------- links

def page_links(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return L.page_links(pages).select("page_id", "href", "url")


LINK_FORMS = 9


def link_forms(spark, sf_dir):
    """Hrefs with references and odd addresses, and text that only looks like an anchor; one page per customer."""
    k = F.col("c_custkey").cast("string")
    forms = [
        F.concat(F.lit('<a href="x&eacute;_'), k, F.lit('.zip">')),
        F.concat(F.lit("<a href='\\q\\"), k, F.lit("?a\\b'>")),
        F.concat(F.lit('<A HREF="./%2e%2E/'), k, F.lit('/.%2e/z">')),
        F.concat(F.lit('<a href="http://H.Example:80/'), k, F.lit('">')),
        F.concat(F.lit('<a href="#é '), k, F.lit('">')),
        F.concat(F.lit('<textarea><a href="no"></textarea><title><a href="no"></title><a href="yes'), k, F.lit('"><!-- <a href="no">')),
        F.concat(F.lit("<img alt='<a href=\"no\">'><a href=k&copy=1&amp;lt;n="), k, F.lit("&copy;>")),
        F.concat(F.lit('<a href="&#150;&#x41;&nosuch;'), k, F.lit('">')),
        F.concat(F.lit('<script>"<a href=no>"</script><a href="http://h.example"><iframe><a href="no'), k, F.lit('">')),
    ]
    html = F.lit(None).cast("string")
    for n, form in enumerate(forms):
        html = F.when(F.col("c_custkey") % LINK_FORMS == n, form).otherwise(html)
    pages = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), F.lit("https://Example.com:443/a/b?x").alias("url"), html.alias("html"))
    return L.page_links(pages).select("page_id", "url")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small listing page per order with archive and non-archive links (relative hrefs)."""
    o = _t(spark, sf_dir, "orders")
    okey = F.col("o_orderkey").cast("string")
    month, year = _month("o_orderdate"), F.date_format("o_orderdate", "yyyy")
    prio = F.substring("o_orderpriority", 1, 1)
    html = F.concat(
        F.lit("<html><body><!-- <a href=\"hidden_"), month, F.lit(".zip\">x</a> -->"),
        F.lit("<a href=\"files/"), F.lower("o_orderstatus"), F.lit("_"), month, F.lit(".zip\">a</a>"),
        F.lit("<a class='x' href='../"), prio, F.lit("/d_"), year, F.lit("_"), month, F.lit(".zip'>b</a>"),
        F.lit("<a href=\"x_"), month, F.lit(".ZIP\">c</a>"),
        F.lit("<a href=\"y"), month, F.lit(".zip\">d</a>"),
        F.lit("<a>no href</a></body></html>"),
    )
    url = F.concat(F.lit("https://example.com/"), year, F.lit("/list/?o="), okey)
    pages = o.select(F.col("o_orderkey").alias("page_id"), url.alias("url"), html.alias("html"))
    # as many parts as a pages table of this size would have; the orders come in one small file
    return pages.repartition(2 * spark.sparkContext.defaultParallelism)


def link_period_last_wins(spark, sf_dir):
    return L.link_map(L.archive_links(listing_pages(spark, sf_dir)))


# ----------------------------------------------------------------------------- manifests

def _order_months(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(_month("o_orderdate").alias("period")).distinct()


# Manifests of finished work: the ship months of all lines but every fifth (third) month, so gaps
# exist at any size and only the period decides on them.
DONE_GAP, ARCHIVED_GAP = 5, 3


def _ship_months(spark, sf_dir, gap: int):
    li = _t(spark, sf_dir, "lineitem").select(_month("l_shipdate").alias("period"))
    return li.where(F.col("period").cast("int") % gap != 0).distinct()


def targets_semi(spark, sf_dir):
    """Months found 'on disk' (ship months without gaps) that are requested targets (order months)."""
    return M.found_in_targets(_ship_months(spark, sf_dir, DONE_GAP), _order_months(spark, sf_dir))


def targets_todo(spark, sf_dir):
    """Target months not yet downloaded (done = ship months but every fifth)."""
    return M.not_done(_order_months(spark, sf_dir), _ship_months(spark, sf_dir, DONE_GAP))


def archives_todo(spark, sf_dir):
    """Archives (ship months but every third) not yet extracted (extracted = months of finished orders)."""
    done = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(_month("o_orderdate").alias("period"))
    return M.not_done(_ship_months(spark, sf_dir, ARCHIVED_GAP), done)


def targets_missing(spark, sf_dir):
    """Target months without an archive (archives = ship months but every third)."""
    return M.missing(_order_months(spark, sf_dir), _ship_months(spark, sf_dir, ARCHIVED_GAP))


def stage_counts(spark, sf_dir):
    return M.stage_counts(_order_months(spark, sf_dir), _ship_months(spark, sf_dir, DONE_GAP),
                          _ship_months(spark, sf_dir, ARCHIVED_GAP))


# ----------------------------------------------------------------------------- scalars

def _alias_of_segment():
    seg = F.col("c_mktsegment")
    return (F.when(seg == "MACHINERY", F.lit(" MC "))
             .when(seg == "BUILDING", F.lit("Minor-Contracts"))
             .when(seg == "AUTOMOBILE", F.lit("pub"))
             .when(seg == "FURNITURE", F.lit("PT\t"))
             .otherwise(seg))


def type_alias(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", _alias_of_segment().alias("alias"))
    t = S.procurement_type(F.col("alias"))
    return c.select("c_custkey", "alias", t.alias("procurement_type"),
                    S.display_name(t).alias("display_name"), S.is_known_type(F.col("alias")).alias("is_known"))


def type_select(spark, sf_dir):
    """customers selected by type (minor contracts), counted per segment."""
    c = type_alias(spark, sf_dir).where(F.col("procurement_type") == S.MINOR_CONTRACTS)
    return c.groupBy("alias").agg(F.count("*").alias("n"))


def local_name(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_type", " ", ":").alias("qname"))
    return p.select("p_partkey", "qname", S.local_name(F.col("qname")).alias("local"),
                    S.matches_local_name(F.col("qname"), "TIN").alias("is_tin"))


def id_clean(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("k"), F.col("url").alias("raw"))
    orders = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderstatus") == "F", F.lit("/"))
         .when(F.col("o_orderstatus") == "O", F.concat(F.lit("https://host/o/"), F.col("o_orderkey").cast("string"), F.lit("//")))
         .otherwise(F.col("o_orderkey").cast("string")).alias("raw"))
    ids = pages.unionByName(orders)
    return ids.select("k", "raw", S.id_from_url(F.col("raw")).alias("id"))


def _paths(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    okey = F.col("o_orderkey").cast("string")
    ext = (F.when(F.col("o_orderstatus") == "F", F.lit(".XML")).when(F.col("o_orderstatus") == "O", F.lit(".atom"))
            .otherwise(F.lit(".txt")))
    ext = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("")).otherwise(ext)
    return o.select(okey.alias("k"), F.concat(F.lit("/data/"), _month("o_orderdate"), F.lit("/"), okey, ext).alias("path"))


def file_extension(spark, sf_dir):
    p = _paths(spark, sf_dir)
    return p.select("path", S.file_extension(F.col("path")).alias("ext"), S.is_feed_file(F.col("path")).alias("is_feed"))


def archive_member_filter(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    okey = F.col("o_orderkey").cast("string")
    prio = F.col("o_orderpriority")
    member = (F.when(prio == "1-URGENT", F.concat(okey, F.lit(".xml")))
               .when(prio == "2-HIGH", F.concat(F.lit("dir/"), okey, F.lit("/")))
               .when(prio == "3-MEDIUM", F.concat(F.lit("../"), okey, F.lit(".xml")))
               .when(prio == "4-NOT SPECIFIED", F.concat(F.lit("a/./b/../"), okey, F.lit(".xml")))
               .otherwise(F.concat(F.lit("/abs/"), okey, F.lit(".xml"))))
    m = o.select(member.alias("member"))
    return m.select("member", S.is_safe_member(F.col("member")).alias("is_safe"))


def archive_stem(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.concat(F.lit("/data/"), _month("o_orderdate"), F.lit(".zip")).alias("path"))
    return o.select("path", S.archive_stem(F.col("path")).alias("stem"))


# ----------------------------------------------------------------------------- sources and sinks

def _entries_from_root(spark, root, paths=None, strict=False, columns=None):
    if strict:
        parsed = read_entries_strict(spark, root, paths, glob=GZIP_GLOB, columns=columns)
    else:
        parsed = parse_entries(read_entry_texts(spark, root, paths, GZIP_GLOB), columns=columns)
    e = to_entries(parsed, keep=["period"], columns=columns)
    return e.withColumn("procurement_type", F.lit(S.PUBLIC_TENDERS))


def discovery_by_period(spark, sf_dir):
    """S1 + A6: feed files found per period, and the entries read from them (S2 text scan)."""
    root = feed_root(spark, sf_dir)
    per = MT.files_by_period(list_feed_files(spark, root, glob=GZIP_GLOB))
    n = read_entry_texts(spark, root, glob=GZIP_GLOB).groupBy("period").agg(F.count("*").alias("n_entries"))
    return per.join(n, "period", "full").select("period", (F.col("n_files") > 0).alias("has_files"), "n_entries")


def strict_scan_by_period(spark, sf_dir):
    """S2 strict form: the XML source over the same feed files."""
    root = feed_root(spark, sf_dir)
    e = _entries_from_root(spark, root, strict=True, columns=["project_lots"])
    return e.groupBy("period").agg(F.count("*").alias("n_entries"),
                                   F.sum(F.size("project_lots")).cast("bigint").alias("n_lots"))


def archive_scan(spark, sf_dir):
    """S3: entries read straight out of ZIP archives, counted per period."""
    root = feed_root(spark, sf_dir, archive=True)
    texts = read_archive_entries(spark, root)
    columns = ["project_lots"]   # as ``feed_entries_by_period``: what the counts are made of
    e = to_entries(parse_entries(texts, columns=columns), keep=["period"], columns=columns)
    return e.groupBy("period").agg(F.count("*").alias("n_entries"),
                                   F.sum(F.size("project_lots")).cast("bigint").alias("n_lots"))


def batch_union(spark, sf_dir):
    """K1 + K2 + S4/U1: write with bounded files, read every batch back, count per partition."""
    root = feed_root(spark, sf_dir)
    out = scratch_path(spark, "table")
    write_entries(_entries_from_root(spark, root), out, max_records_per_file=50)
    t = read_entries(spark, out)
    return t.groupBy("procurement_type", "period").agg(F.count("*").alias("n_entries"))


def compact_counts(spark, sf_dir):
    """K3: compacted write -> files per period bounded by its size; rows per period read back."""
    root = feed_root(spark, sf_dir)
    out = scratch_path(spark, "table")
    write_entries(_entries_from_root(spark, root), out, compact=True)
    files = table_files(spark, out).groupBy("period").agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"))
    rows = read_entries(spark, out).groupBy("period").agg(F.count("*").alias("n_entries"))
    # a file may hold less than the size aimed at: Parquet packs rows tighter than the shuffle does
    most = 1 + F.floor(16 * F.col("bytes") / COMPACT_BYTES)
    return rows.join(files, "period").select("period", "n_entries", (F.col("n_files") <= most).alias("compacted"))


FILE_ROWS = 20


def _order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stored entry rows; a status is a procurement type's alias."""
    alias = F.when(F.col("o_orderstatus") == "F", "MC").when(F.col("o_orderstatus") == "O", " Public-Tenders ").otherwise("minor-contracts")
    rows = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        S.procurement_type(alias).alias("procurement_type"), _month("o_orderdate").alias("period"))
    return empty_entries(spark).unionByName(rows, allowMissingColumns=True)


def compact_small_files(spark, sf_dir):
    """K3 + S4 on a stored table: files of 20 rows are compacted where a partition holds several; exact file counts."""
    out = scratch_path(spark, "table-of-small-files")
    write_entries(_order_entries(spark, sf_dir), out, compact=True, max_records_per_file=FILE_ROWS)
    counted = lambda name: table_files(spark, out).groupBy("procurement_type", "period").agg(F.count("*").alias(name))
    before = spark.createDataFrame(counted("files_before").collect(), "procurement_type string, period string, files_before long")
    plan = compact_stored(spark, out)
    done = plan.select("procurement_type", "period", F.lit(True).alias("compacted"))
    rows = read_entries(spark, out).groupBy("procurement_type", "period").agg(
        F.count("*").alias("n_entries"), F.sum(F.col("id").cast("long")).alias("key_sum"))
    keys = ["procurement_type", "period"]
    return (rows.join(before, keys).join(counted("files_after"), keys).join(done, keys, "left")
            .select(*keys, "n_entries", "key_sum", "files_before", "files_after", F.coalesce("compacted", F.lit(False)).alias("compacted")))


def type_partitions(spark, sf_dir):
    """F12 as the partition filter it is: of a table with both types, the folders of one are read."""
    out = scratch_path(spark, "table-of-both-types")
    write_entries(_order_entries(spark, sf_dir), out, compact=True)
    t = read_entries(spark, out).where(F.col("procurement_type") == S.procurement_type(F.lit("Minor-Contracts ")))
    return t.groupBy("procurement_type", "period").agg(F.count("*").alias("n_entries"), F.countDistinct("title").alias("n_titles"))


def period_overwrite(spark, sf_dir):
    """K1 + K4: full write, then a second run over 1995 only with another feed; other periods stay."""
    out = scratch_path(spark, "table")
    first, again = feed_roots(spark, sf_dir)
    write_entries(_entries_from_root(spark, first), out)
    year = [f"{again}/{p}" for p in folders(spark, again) if "199501" <= p <= "199512"]
    if year:
        write_entries(_entries_from_root(spark, again, year), out)
    t = read_entries(spark, out)
    return t.groupBy("period").agg(F.count("*").alias("n_entries"), F.count("id").alias("n_with_id"))


def ingest_run(spark, sf_dir):
    """The whole job: select 1995..199612 among the available periods, discover and scan
    those folders, parse, project, write (compacted); read back rows per period."""
    from tenderlake.plans.ingest import IngestOptions, ingest

    out = scratch_path(spark, "table")
    opts = IngestOptions(input_path=feed_root(spark, sf_dir), feed_glob=GZIP_GLOB, output_path=out, procurement_type="pt",
                         start="1995", end="199612", compact=True)
    ingest(spark, period_links(spark, sf_dir), opts)
    return read_entries(spark, out).groupBy("procurement_type", "period").agg(F.count("*").alias("n_entries"))


RUN_COUNTS = ["selected", "found", "missing", "missing_periods", "done", "processed", "skipped", "entries", "malformed"]


def ingest_archives(spark, sf_dir):
    """The whole job from ZIP archives: same selection and result as ``ingest_run``."""
    from tenderlake.plans.ingest import IngestOptions, ingest

    out = scratch_path(spark, "table")
    ingest(spark, period_links(spark, sf_dir), IngestOptions(
        input_path=feed_root(spark, sf_dir, archive=True), output_path=out, procurement_type="pt",
        start="1995", end="199612", compact=True, input="archives"))
    return read_entries(spark, out).groupBy("procurement_type", "period").agg(F.count("*").alias("n_entries"))


def ingest_metrics(spark, sf_dir):
    """The counts that the job reports (A8, J4): a first run over 1995, a second one up to 199612 that skips it."""
    from tenderlake.plans.ingest import IngestOptions, ingest

    out, links = scratch_path(spark, "table"), period_links(spark, sf_dir)
    opts = IngestOptions(input_path=feed_root(spark, sf_dir), feed_glob=GZIP_GLOB, output_path=out, start="1995", end="199512", mode="PERMISSIVE")
    first = ingest(spark, links, opts).select(F.lit(1).alias("run"), *RUN_COUNTS)
    opts.end, opts.overwrite = "199612", False
    return first.unionByName(ingest(spark, links, opts).select(F.lit(2).alias("run"), *RUN_COUNTS))


def files_and_bytes(spark, sf_dir):
    """A6 + A9: one text file per order month and status is written; files and bytes per month, and of the whole folder."""
    root = scratch_path(spark, "files")
    o = _t(spark, sf_dir, "orders").select(_month("o_orderdate").alias("period"), "o_orderstatus", F.col("o_orderkey").cast("string").alias("value"))
    o.repartition("period", "o_orderstatus").write.partitionBy("period", "o_orderstatus").text(root)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    per = MT.files_by_period(listing.withColumn("period", F.regexp_extract("path", "/period=([^/]+)/", 1)))
    return per.unionByName(MT.directory_size(spark, root).select(F.lit("all").alias("period"), F.col("files").alias("n_files"), "bytes"))


def empty_result(spark, sf_dir):
    """K5: a run that keeps no entry has all columns of the table and no row."""
    none = _entries_from_root(spark, feed_root(spark, sf_dir)).where("id is null and title is null").drop("period", "procurement_type")
    both = none.unionByName(empty_entries(spark))
    return both.agg(F.count("*").alias("n_entries"), F.lit(", ".join(both.columns)).alias("column_names"))


def range_reasons(spark, sf_dir):
    """pairs of bounds from order months, years and priorities, with the reason why they are no range."""
    o = _t(spark, sf_dir, "orders").select(_month("o_orderdate").alias("m"), F.date_format("o_orderdate", "yyyy").alias("y"), F.substring("o_orderpriority", 1, 3).alias("p"))
    pairs = o.select(F.explode(F.array(*[F.struct(F.col(a).alias("start"), F.col(b).alias("end")) for a, b in (("m", "y"), ("y", "m"), ("m", "p"))])).alias("r"))
    return pairs.select("r.*").distinct().withColumn("reason", P.range_reason(F.col("start"), F.col("end")))


def period_errors(spark, sf_dir):
    """A10: per order month, the messages of its archives (one per status; one with an odd number of orders fails)."""
    items = _t(spark, sf_dir, "orders").groupBy(_month("o_orderdate").alias("period"), "o_orderstatus").agg(F.count("*").alias("n"))
    error = F.when(F.col("n") % 2 == 1, F.concat(F.lit("archive "), "o_orderstatus", F.lit(": "), F.col("n").cast("string"), F.lit(" orders")))
    return MT.joined_errors(items.select("period", error.alias("error")), "period").select("period", "errors")


PART_CHARACTERS = 400


def error_parts(spark, sf_dir):
    """A10 in rows of bounded length: one message per order of a status, in parts of 400 characters."""
    o = _t(spark, sf_dir, "orders")
    message = F.concat(F.lit("order "), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(" of "), "o_orderpriority")
    parts = MT.joined_errors(o.select("o_orderstatus", message.alias("error")), "o_orderstatus", limit=PART_CHARACTERS)
    return parts.select("o_orderstatus", "part", F.length("errors").alias("n_chars"), F.md5("errors").alias("digest"))


def stream_by_period(spark, sf_dir):
    """The feed scan as a streaming query (available-now trigger, file sink); rows per period."""
    from tenderlake.streaming.feed_stream import start_stream

    out, ckpt = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    q = start_stream(spark, feed_root(spark, sf_dir), out, ckpt, max_files_per_trigger=200, glob=GZIP_GLOB)
    q.awaitTermination()
    return read_entries(spark, out).groupBy("period").agg(
        F.count("*").alias("n_entries"), F.sum(F.size("tender_results")).cast("bigint").alias("n_results"))


# ----------------------------------------------------------------------------- metrics

def run_metrics(spark, sf_dir):
    """Per language, documents as processed items (bytes = characters,
    seconds = characters / 50,000, skipped, with an error, below 100 characters)."""
    d = _t(spark, sf_dir, "documents")
    items = d.select("lang", F.col("n_chars").alias("bytes"), F.floor(F.col("n_chars") / 50000).alias("seconds"),
                     "doc_id")
    err = F.when(F.col("bytes") < 100, F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(": too short")))
    return MT.summarize(items, "lang", skipped=F.col("bytes") < 100, error=err)


def queries() -> dict:
    return {
        "period_format": period_format,
        "period_range": period_range,
        "period_range_open": period_range_open,
        "period_bounds_missing": period_bounds_missing,
        "period_available": period_available,
        "page_links": page_links,
        "link_period_last_wins": link_period_last_wins,
        "targets_semi": targets_semi,
        "targets_todo": targets_todo,
        "archives_todo": archives_todo,
        "targets_missing": targets_missing,
        "stage_counts": stage_counts,
        "type_alias": type_alias,
        "type_select": type_select,
        "local_name": local_name,
        "id_clean": id_clean,
        "file_extension": file_extension,
        "archive_member_filter": archive_member_filter,
        "archive_stem": archive_stem,
        "discovery_by_period": discovery_by_period,
        "strict_scan_by_period": strict_scan_by_period,
        "archive_scan": archive_scan,
        "batch_union": batch_union,
        "compact_counts": compact_counts,
        "period_overwrite": period_overwrite,
        "run_metrics": run_metrics,
        "ingest_run": ingest_run,
        "ingest_archives": ingest_archives,
        "ingest_metrics": ingest_metrics,
        "files_and_bytes": files_and_bytes,
        "empty_result": empty_result,
        "range_reasons": range_reasons,
        "period_errors": period_errors,
        "link_forms": link_forms,
        "error_parts": error_parts,
        "compact_small_files": compact_small_files,
        "type_partitions": type_partitions,
        "stream_by_period": stream_by_period,
    }


# ----------------------------------------------------------------------------- oracles

_MONTHS = "(SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period FROM orders)"
_LINKS = """(SELECT DISTINCT period, 'https://host/data_' || period || '.zip' AS url FROM (
    SELECT strftime(o_orderdate, '%Y%m') AS period FROM orders
    UNION ALL SELECT strftime(o_orderdate, '%Y') FROM orders))"""
_VALID = "regexp_full_match(period, '[0-9]{4}|[0-9]{6}')"
_ORDER_COUNTS = "SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries FROM orders GROUP BY 1"


def _ship(gap: int) -> str:
    return f"(SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS period FROM lineitem WHERE CAST(strftime(l_shipdate, '%Y%m') AS INT) % {gap} <> 0)"


_RETURNED = _ship(DONE_GAP)
_OPEN = _ship(ARCHIVED_GAP)


def oracles() -> dict[str, str]:
    return {
        "period_format": """WITH c AS (
  SELECT CAST(c_custkey AS VARCHAR) AS candidate FROM customer
  UNION SELECT c_mktsegment FROM customer
  UNION SELECT substr(c_mktsegment, 100, 5) FROM customer
  UNION SELECT strftime(o_orderdate, '%Y%m') FROM orders
  UNION SELECT strftime(o_orderdate, '%Y') FROM orders
  UNION SELECT strftime(o_orderdate, '%Y%m%d') FROM orders
  UNION SELECT strftime(o_orderdate, '%Y') || chr(10) FROM orders)
SELECT candidate, regexp_full_match(candidate, '[0-9]{4}|[0-9]{6}') AS is_valid,
       CASE WHEN candidate = '' THEN 'empty'
            WHEN NOT regexp_full_match(candidate, '[0-9]+') THEN 'non_digit'
            WHEN length(candidate) NOT IN (4, 6) THEN 'length' END AS reason
FROM c""",
        "period_range": f"SELECT period, url FROM {_LINKS} WHERE period >= '1995' AND period <= '199612' AND {_VALID}",
        "period_range_open": f"SELECT period, url FROM {_LINKS} WHERE period >= '1997' AND {_VALID}",
        "period_bounds_missing": f"""WITH l AS {_LINKS},
b AS (SELECT unnest(['199213', '1995', '2099', '199507']) AS bound)
SELECT bound, (SELECT string_agg(period, ', ' ORDER BY period) FROM (SELECT DISTINCT period FROM l)) AS available
FROM b WHERE bound NOT IN (SELECT period FROM l)""",
        "period_available": f"""SELECT string_agg(period, ', ' ORDER BY period) AS available, count(*) AS n_periods
FROM (SELECT DISTINCT period FROM {_LINKS})""",
        # every href of these pages is a rooted path; its segments are percent-encoded, commas stay
        "page_links": """SELECT page_id, href, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)
       || array_to_string(list_transform(string_split(href, '/'), lambda s: replace(url_encode(s), '%2C', ',')), '/') AS url
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""",
        "link_period_last_wins": """SELECT strftime(o_orderdate, '%Y%m') AS period,
       arg_max('https://example.com/' || strftime(o_orderdate, '%Y') || '/' || substr(o_orderpriority, 1, 1)
               || '/d_' || strftime(o_orderdate, '%Y') || '_' || strftime(o_orderdate, '%Y%m') || '.zip', o_orderkey) AS url
FROM orders GROUP BY 1""",
        "targets_semi": f"SELECT period FROM {_RETURNED} WHERE period IN {_MONTHS}",
        "targets_todo": f"SELECT period FROM {_MONTHS} WHERE period NOT IN {_RETURNED}",
        "archives_todo": f"""SELECT period FROM {_OPEN}
WHERE period NOT IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders WHERE o_orderstatus = 'F')""",
        "targets_missing": f"SELECT period FROM {_MONTHS} WHERE period NOT IN {_OPEN}",
        "stage_counts": f"""SELECT count(*) AS total,
       count(*) FILTER (WHERE period IN {_RETURNED}) AS skipped,
       count(*) FILTER (WHERE period NOT IN {_RETURNED} AND period NOT IN {_OPEN}) AS missing,
       count(*) FILTER (WHERE period NOT IN {_RETURNED} AND period IN {_OPEN}) AS to_process
FROM {_MONTHS}""",
        "type_alias": """WITH a AS (
  SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN ' MC ' WHEN 'BUILDING' THEN 'Minor-Contracts'
         WHEN 'AUTOMOBILE' THEN 'pub' WHEN 'FURNITURE' THEN 'PT' || chr(9) ELSE c_mktsegment END AS alias
  FROM customer)
SELECT c_custkey, alias,
       CASE WHEN lower(trim(alias, ' ' || chr(9))) IN ('mc', 'minor-contracts', 'min') THEN 'minor-contracts' ELSE 'public-tenders' END AS procurement_type,
       CASE WHEN lower(trim(alias, ' ' || chr(9))) IN ('mc', 'minor-contracts', 'min') THEN 'Minor Contracts' ELSE 'Public Tenders' END AS display_name,
       lower(trim(alias, ' ' || chr(9))) IN ('mc', 'minor-contracts', 'min', 'pt', 'pub', 'public-tenders') AS is_known
FROM a""",
        "type_select": """SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN ' MC ' ELSE 'Minor-Contracts' END AS alias, count(*) AS n
FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING') GROUP BY 1""",
        "local_name": """SELECT p_partkey, replace(p_type, ' ', ':') AS qname,
       string_split(replace(p_type, ' ', ':'), ':')[-1] AS local,
       string_split(replace(p_type, ' ', ':'), ':')[-1] = 'TIN' AS is_tin
FROM part""",
        "id_clean": """WITH ids AS (
  SELECT page_id AS k, url AS raw FROM pages
  UNION ALL
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '/' WHEN 'O' THEN 'https://host/o/' || CAST(o_orderkey AS VARCHAR) || '//'
         ELSE CAST(o_orderkey AS VARCHAR) END FROM orders)
SELECT k, raw, coalesce(list_filter(string_split(raw, '/'), lambda x: x <> '')[-1], raw) AS id FROM ids""",
        "file_extension": """WITH p AS (
  SELECT '/data/' || strftime(o_orderdate, '%Y%m') || '/' || CAST(o_orderkey AS VARCHAR) ||
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderstatus = 'F' THEN '.XML'
              WHEN o_orderstatus = 'O' THEN '.atom' ELSE '.txt' END AS path FROM orders)
SELECT path, lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS ext,
       lower(regexp_extract(path, '\\.([^./]+)$', 1)) IN ('xml', 'atom') AS is_feed FROM p""",
        "archive_member_filter": """WITH m AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) || '.xml'
              WHEN '2-HIGH' THEN 'dir/' || CAST(o_orderkey AS VARCHAR) || '/'
              WHEN '3-MEDIUM' THEN '../' || CAST(o_orderkey AS VARCHAR) || '.xml'
              WHEN '4-NOT SPECIFIED' THEN 'a/./b/../' || CAST(o_orderkey AS VARCHAR) || '.xml'
              ELSE '/abs/' || CAST(o_orderkey AS VARCHAR) || '.xml' END AS member FROM orders),
s AS (
  SELECT member, list_filter(string_split(member, '/'), lambda p: p <> '' AND p <> '.') AS parts FROM m),
d AS (
  SELECT member, parts,
         list_transform(range(1, len(parts) + 1),
                        lambda i: list_sum(list_transform(parts[1:i], lambda p: CASE WHEN p = '..' THEN -1 ELSE 1 END))) AS depths
  FROM s)
SELECT member,
       member <> '' AND NOT ends_with(member, '/') AND NOT starts_with(member, '/')
       AND NOT contains(member, chr(92)) AND NOT regexp_matches(member, '^[A-Za-z]:')
       AND coalesce(list_min(depths), 0) >= 0 AND coalesce(depths[-1], 0) > 0 AS is_safe
FROM d""",
        "archive_stem": """SELECT '/data/' || strftime(o_orderdate, '%Y%m') || '.zip' AS path, strftime(o_orderdate, '%Y%m') AS stem
FROM orders""",
        "discovery_by_period": f"SELECT period, true AS has_files, n_entries FROM ({_ORDER_COUNTS})",
        "strict_scan_by_period": """WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_lots
FROM orders LEFT JOIN n ON o_orderkey = l_orderkey GROUP BY 1""",
        "archive_scan": """WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_lots
FROM orders LEFT JOIN n ON o_orderkey = l_orderkey GROUP BY 1""",
        "batch_union": f"SELECT 'public-tenders' AS procurement_type, period, n_entries FROM ({_ORDER_COUNTS})",
        "compact_counts": f"SELECT period, n_entries, true AS compacted FROM ({_ORDER_COUNTS})",
        "period_overwrite": """SELECT strftime(o_orderdate, '%Y%m') AS period,
       count(*) FILTER (WHERE strftime(o_orderdate, '%Y') <> '1995' OR NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')) AS n_entries,
       count(*) FILTER (WHERE strftime(o_orderdate, '%Y') <> '1995' OR o_orderpriority <> '5-LOW') AS n_with_id
FROM orders GROUP BY 1""",
        "ingest_run": """SELECT 'public-tenders' AS procurement_type, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries
FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '1995' AND '199612' GROUP BY 2""",
        "stream_by_period": """WITH flags AS (
  SELECT l_orderkey, l_returnflag, count(*) AS c FROM lineitem GROUP BY ALL),
per_order AS (
  SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE c END) AS n_res FROM flags GROUP BY 1)
SELECT strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries, CAST(coalesce(sum(n_res), 0) AS BIGINT) AS n_results
FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey GROUP BY 1""",
        "run_metrics": """WITH g AS (
  SELECT lang, count(*) FILTER (WHERE n_chars >= 100) AS processed, count(*) FILTER (WHERE n_chars < 100) AS skipped,
         sum(n_chars) AS total_bytes, sum(floor(n_chars / 50000)) AS seconds,
         count(*) FILTER (WHERE n_chars < 100) AS n_errors,
         min(CASE WHEN n_chars < 100 THEN 'doc ' || CAST(doc_id AS VARCHAR) || ': too short' END) AS first_error
  FROM documents GROUP BY lang)
SELECT lang, processed, skipped, CAST(total_bytes AS BIGINT) AS total_bytes,
       round(total_bytes / 1048576.0 * 100) / 100 AS size_mb,
       format('{:02d}:{:02d}:{:02d}', CAST(seconds // 3600 AS BIGINT), CAST((seconds % 3600) // 60 AS BIGINT), CAST(seconds % 60 AS BIGINT)) AS elapsed,
       round(CASE WHEN seconds > 0 THEN total_bytes / 1048576.0 / seconds ELSE total_bytes / 1048576.0 END * 100) / 100 AS throughput_mb_s,
       n_errors, first_error
FROM g""",
        "ingest_archives": """SELECT 'public-tenders' AS procurement_type, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries
FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '1995' AND '199612' GROUP BY 2""",
        "ingest_metrics": f"""WITH l AS (SELECT DISTINCT period FROM {_LINKS}),
m AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period FROM orders),
r AS (SELECT 1 AS run, '199512' AS last, 0 AS skip UNION ALL SELECT 2, '199612', 1),
s AS (SELECT run, period, period IN (SELECT period FROM m) AS there, skip = 1 AND period <= '199512' AS old
      FROM r JOIN l ON period >= '1995' AND period <= last)
SELECT run, count(*) AS selected, count(*) FILTER (WHERE there) AS found, count(*) FILTER (WHERE NOT there) AS missing,
       string_agg(CASE WHEN NOT there THEN period END, ', ' ORDER BY period) AS missing_periods,
       count(*) FILTER (WHERE there AND old) AS done, count(*) FILTER (WHERE there AND NOT old) AS processed, CAST(0 AS BIGINT) AS skipped,
       CAST((SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y%m') IN
             (SELECT period FROM s AS t WHERE t.run = s.run AND there AND NOT old)) AS BIGINT) AS entries,
       CAST(0 AS BIGINT) AS malformed
FROM s GROUP BY run""",
        "files_and_bytes": """WITH f AS (SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderstatus, length(CAST(o_orderkey AS VARCHAR)) + 1 AS b FROM orders)
SELECT period, count(DISTINCT o_orderstatus) AS n_files, CAST(sum(b) AS BIGINT) AS bytes FROM f GROUP BY period
UNION ALL SELECT 'all', count(DISTINCT period || o_orderstatus), CAST(sum(b) AS BIGINT) FROM f""",
        "empty_result": """SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS n_entries,
       'id, title, link, summary, updated, status, contract_id, contracting_party, project, project_lots, tender_results, terms_funding_program, process' AS column_names
FROM orders""",
        "range_reasons": """WITH o AS (SELECT strftime(o_orderdate, '%Y%m') AS m, strftime(o_orderdate, '%Y') AS y, substr(o_orderpriority, 1, 3) AS p FROM orders),
r AS (SELECT m AS "start", y AS "end" FROM o UNION SELECT y, m FROM o UNION SELECT m, p FROM o)
SELECT "start", "end", CASE WHEN NOT regexp_full_match("end", '[0-9]+') THEN 'non_digit' WHEN "start" > "end" THEN 'reversed' END AS reason FROM r""",
        "link_forms": f"""SELECT c_custkey AS page_id, CASE c_custkey % {LINK_FORMS}
  WHEN 0 THEN 'https://example.com/a/x%C3%A9_' || c_custkey || '.zip' WHEN 1 THEN 'https://example.com/q/' || c_custkey || '?a\\b'
  WHEN 2 THEN 'https://example.com/z' WHEN 3 THEN 'http://h.example/' || c_custkey
  WHEN 4 THEN 'https://example.com/a/b?x#%C3%A9%20' || c_custkey WHEN 5 THEN 'https://example.com/a/yes' || c_custkey
  WHEN 6 THEN 'https://example.com/a/k&copy=1&lt;n=' || c_custkey || '%C2%A9'
  WHEN 7 THEN 'https://example.com/a/%E2%80%93A&nosuch;' || c_custkey ELSE 'http://h.example' END AS url
FROM customer""",
        "error_parts": f"""WITH m AS (SELECT o_orderstatus, 'order ' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || ' of ' || o_orderpriority AS m FROM orders),
p AS (SELECT *, coalesce(sum(length(m) + 2) OVER (PARTITION BY o_orderstatus ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM m),
j AS (SELECT o_orderstatus, CAST(floor(start / {PART_CHARACTERS}) AS BIGINT) AS part, string_agg(m, '; ' ORDER BY m) AS errors FROM p GROUP BY ALL)
SELECT o_orderstatus, part, CAST(length(errors) AS INTEGER) AS n_chars, md5(errors) AS digest FROM j""",
        "compact_small_files": f"""SELECT CASE WHEN o_orderstatus = 'O' THEN 'public-tenders' ELSE 'minor-contracts' END AS procurement_type,
       strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT) AS files_before, CAST(1 AS BIGINT) AS files_after, count(*) > {FILE_ROWS} AS compacted
FROM orders GROUP BY 1, 2""",
        "type_partitions": """SELECT 'minor-contracts' AS procurement_type, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n_entries,
       count(DISTINCT o_orderpriority) AS n_titles FROM orders WHERE o_orderstatus <> 'O' GROUP BY 2""",
        "period_errors": """WITH a AS (SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL)
SELECT period, string_agg('archive ' || s || ': ' || CAST(n AS VARCHAR) || ' orders', '; ' ORDER BY s) AS errors
FROM a WHERE n % 2 = 1 GROUP BY period""",
    }
