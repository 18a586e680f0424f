"""Feed sources: discovery of feed files (S1) and the entry scan (S2), plus the raw block.

Default scan: the text source reads splits of the files, in records that end with ``entry>``; a narrow Arrow step per
split cuts them into entries (``entry_cut``: any prefix, any encoding that the file declares, blind to tags in comments and
CDATA), and each is parsed with ``from_xml`` against the RAW schema. Files of more than one split are read once before:
every split tells in which mode it would end for each mode it may begin in, a fold over these few rows gives the
modes they do begin in, and the pieces of entries that reach over a split's border are put together.
Strict scan: the built-in XML source with ``rowTag=entry`` (one task per file, full XML validation of the whole file).
Both give the same parsed struct ``e``.

An entry without an end tag (a truncated file) is malformed in every scan: FAILFAST raises,
PERMISSIVE keeps its text in ``e._corrupt_record`` so that it can be counted; bytes that the file's encoding does not have
make an entry malformed too, and an unknown encoding raises. A file whose path does not lie below the scanned root raises;
no file is dropped without a word.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.session import scratch_path
from tenderlake.sources import entry_cut
from tenderlake.sources.fsio import qualified
from tenderlake.sources.scopes import canonical
from tenderlake.schema import (
    ATOM_FIELDS,
    CONTRACT_FOLDER_MEMBERS,
    RAW_ENTRY_DDL,
    XML_OPTIONS,
    block_members_for,
    raw_entry_ddl,
)

# Fixed value: feed files are *.xml / *.atom in any letter case.
FEED_GLOB = "*.{[xX][mM][lL],[aA][tT][oO][mM]}"
#: Where they are stored gzipped, a scan is told so by this glob; such a file is one split.
GZIP_GLOB = FEED_GLOB + ".gz"
#: The text source's records end with this: start tags without attributes and end tags, of any prefix.
RECORD_END = "entry>"
#: Files up to this size are never split by the text source (Spark's least split, its cost of opening a file).
LEAST_SPLIT = "spark.sql.files.openCostInBytes"
#: Splits that do not begin in plain UTF-8 text, at most; their modes and encodings go to all tasks.
MOST_ODD_SPLITS = 1_000_000
_BATCH_ENTRIES, _BATCH_BYTES = 2_000, 8 << 20
# The last contract block, kept as source text (with or without a prefix, CDATA and entities untouched).
RAW_BLOCK_PATTERN = r"(?s).*(<(?:[\w.-]+:)?ContractFolderStatus[\s>].*?</(?:[\w.-]+:)?ContractFolderStatus\s*>)"
# Where the name stands twice, in one start tag and one end tag, that block: found by two looks instead of one from every place on the way.
BLOCK_NAME_PATTERN = r"ContractFolderStatus[\s>]"
ONE_BLOCK_PATTERN = r"(?s)<(?:[\w.-]++:)?+ContractFolderStatus[\s>].*</(?:[\w.-]++:)?+ContractFolderStatus\s*+>"
CORRUPT = "_corrupt_record"

# Functions of this module run in Python workers: ship them by value so the workers do not
# need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def xml_options(mode: str = "FAILFAST") -> dict[str, str]:
    return {**XML_OPTIONS, "mode": mode}


def parse_entry_text(text: Column, mode: str = "FAILFAST", ddl: str = RAW_ENTRY_DDL) -> Column:
    """``from_xml`` of one ``<entry>`` text into the RAW struct (with CORRUPT in PERMISSIVE mode)."""
    options = xml_options(mode)
    if mode.upper() == "PERMISSIVE":
        ddl = f"{ddl}, {CORRUPT} STRING"
        options["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_xml(text, ddl, options)


def malformed(e: Column) -> Column:
    """Whether a struct parsed in PERMISSIVE mode stands for an entry that is no well-formed XML."""
    return e[CORRUPT].isNotNull()


def _widen(e: Column, members: set[str], corrupt: bool) -> Column:
    """A struct parsed with some block members only, given the full RAW type (others null).

    Building the nested struct is most of the parse cost, so members no output needs are
    not parsed at all; this cheap re-typing keeps the projection code unchanged.
    """
    def block(c: Column) -> Column:
        return F.struct(*[(c[n] if n in members else F.lit(None).cast(t)).alias(n)
                          for n, t in CONTRACT_FOLDER_MEMBERS])

    atoms = [e[n].alias(n) for n, _ in ATOM_FIELDS] + ([e[CORRUPT].alias(CORRUPT)] if corrupt else [])
    return F.struct(*atoms, F.transform(e["ContractFolderStatus"], block).alias("ContractFolderStatus"))


def raw_block(text: Column) -> Column:
    """The contract block of an entry as it appears in the source, null when absent."""
    one = F.regexp_count(text, F.lit(BLOCK_NAME_PATTERN)) == 2
    # nullif names its value once; a condition on it would have it computed again
    return F.nullif(F.when(one, F.regexp_extract(text, ONE_BLOCK_PATTERN, 0)).otherwise(F.regexp_extract(text, RAW_BLOCK_PATTERN, 1)), F.lit(""))


def below(path: Column, root_path: str) -> Column:
    """The part of a file's URI below the root's URI path; raises for a file that lies elsewhere."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?\Q" + root_path.rstrip("/") + r"\E/+(.+)$"
    rel = F.regexp_extract(path, pattern, 1)
    return F.when(rel != F.lit(""), rel).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {root_path}: "), path)).cast("string"))


def decoded_name(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def period_from_path(path: Column, root_path: str) -> Column:
    """Name of the folder right below the root that holds the file; '' for files right below the root.

    ``path`` is a file's URI and ``root_path`` the root's URI path (``fsio.qualified``).
    """
    rel = below(path, root_path)
    return F.when(rel.contains("/"), decoded_name(F.substring_index(rel, "/", 1))).otherwise(F.lit(""))


def list_feed_files(spark: SparkSession, root: str, paths: list[str] | None = None, glob: str = FEED_GLOB) -> DataFrame:
    """``(period, path, length)`` of every feed file below ``root/<period>/`` (any depth).

    Only file metadata is read (the binary source skips content when it is not selected).
    Top-level files are ignored; empty period directories give no row. ``paths`` lists those
    folders only, ``glob`` names the files.
    """
    full, root_path = qualified(spark, root)
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob)
             .load(paths if paths else full)
             .select("path", "length", F.col("_metadata.file_path").alias("_uri")))
    return (files.select(period_from_path(F.col("_uri"), root_path).alias("period"), "path", "length")
                 .where(F.col("period") != F.lit("")))


def _gzipped(path: str) -> bool:
    return path.lower().endswith(".gz")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, Iterator[bytes]]]:
    """(path, start, length, the file's size, records) of each split in a task's rows, in order.

    Records get back the end that the text source has taken off; the last one of a file has one only if the
    file's size says so (known where the split is all of the file, and that is not gzipped).
    """
    rows = ((path, start, length, size, value.as_py() or b"")
            for batch in batches
            for path, start, length, size, value in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4)))
    ahead = next(rows, None)

    def records(key: tuple, length: int, size: int) -> Iterator[bytes]:
        nonlocal ahead
        total = 0
        while ahead is not None and ahead[:2] == key:
            value = ahead[4]
            total += len(value) + len(RECORD_END)
            ahead = next(rows, None)
            yield value if length >= size and total > size and not _gzipped(key[0]) else value + RECORD_END.encode()

    while ahead is not None:
        path, start, length, size, _ = ahead
        yield path, start, length, size, records((path, start), length, size)


def _pieces(records: Iterator[bytes], start: int, added: bool, odd: tuple[int, str] | None) -> Iterator[tuple[str, str]]:
    """(kind, text) of all entries and pieces of a split; ``odd`` is the mode it begins in and its file's encoding, ``added``
    whether its last record may have been given an end that it has not."""
    end = RECORD_END.encode()
    mode, encoding = odd or (entry_cut.TEXT, entry_cut.UTF8)
    first = next(records, b"")
    if start == 0:
        encoding = entry_cut.declared_encoding(first)
        if encoding == "utf-16":   # has no such record ends: the record is the file
            first, encoding = first.removesuffix(end).decode("utf-16").encode(), entry_cut.UTF8
    cutter = entry_cut.EntryCutter(mode, leading=start > 0)
    for data in chain([first], records):
        for kind, text in cutter.feed(data):
            yield kind, entry_cut.decoded(text, encoding)
    for kind, text in cutter.feed(b"", True):
        if added and kind == entry_cut.OPEN and not text.endswith(b"<" + end):
            text = text.removesuffix(end)   # the file's last record had no such end
        yield kind, entry_cut.decoded(text, encoding)


def _cut(odd: dict[tuple[str, int], tuple[int, str]], pieces: bool):
    """Entries of each split, or with ``pieces`` what reaches over the borders of files' splits instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for path, start, length, size, records in _splits(batches):
            if pieces and length >= size:
                deque(records, maxlen=0)   # a file of one split has none
                continue
            added = start + length >= size and (start > 0 or _gzipped(path))
            for kind, text in _pieces(records, start, added, odd.get((path, start))):
                if kind == entry_cut.OPEN and length >= size:
                    kind = entry_cut.ENTRY
                if (kind == entry_cut.ENTRY) != pieces:
                    out.append((path, start, kind, text))
                    held += len(text)
                    if len(out) >= _BATCH_ENTRIES or held >= _BATCH_BYTES:
                        yield _rows(out)
                        out, held = [], 0
        if out:
            yield _rows(out)

    return run


#: An entry with leaves at other places than the read schema lists, with all of them at listed ones; null for the others.
CANONICAL = "canonical_xml"
_CUT_ROWS = f"path string, start long, kind string, entry_xml string, {CANONICAL} string"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string(), pa.string())
    columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
    moved = pa.array([canonical(text) if kind == entry_cut.ENTRY else None for _, _, kind, text in out], pa.string())
    return pa.RecordBatch.from_arrays([*columns, moved], ["path", "start", "kind", "entry_xml", CANONICAL])


def with_canonical(texts: DataFrame) -> DataFrame:
    """``texts`` with the column CANONICAL after its others, of which the last is ``entry_xml``."""
    schema = texts.withColumn(CANONICAL, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = [canonical(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(moved, pa.string())], schema.names)

    return texts.mapInArrow(run, schema)


_MODES = "path string, start long, ends array<int>, encoding string"


def _modes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split, the mode it ends in for each mode it may begin in, and the encoding a file's first split names."""
    out = []
    for path, start, length, size, records in _splits(batches):
        if length >= size:
            deque(records, maxlen=0)
            continue
        ends, encoding = list(range(4)), None
        for data in records:
            if start == 0 and encoding is None:
                encoding = entry_cut.declared_encoding(data)
            after = {mode: entry_cut.mode_after(mode, data) for mode in set(ends)}
            ends = [after[mode] for mode in ends]
        out.append((path, start, ends, encoding))
    types = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.string())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["path", "start", "ends", "encoding"])


def _odd_splits(splits: DataFrame) -> dict[tuple[str, int], tuple[int, str]]:
    """(mode, encoding) of the splits behind a file's first one that begin in a section, or in another encoding than UTF-8."""
    modes = splits.mapInArrow(_modes, _MODES)
    of_file = modes.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "ends"))).alias("s"), F.max("encoding").alias("encoding"))
    begun = F.aggregate(
        "s", F.struct(F.lit(entry_cut.TEXT).alias("mode"), F.array().cast("array<struct<start:bigint,mode:int>>").alias("out")),
        lambda seen, s: F.struct(F.get(s["ends"], seen["mode"]).alias("mode"),
                                 F.array_append(seen["out"], F.struct(s["start"].alias("start"), seen["mode"].alias("mode"))).alias("out")),
        lambda seen: seen["out"])
    odd = (of_file.select("path", "encoding", F.explode(begun).alias("b")).select("path", "b.start", "b.mode", "encoding")
           .where((F.col("start") > 0) & ((F.col("mode") != entry_cut.TEXT) | (F.col("encoding") != entry_cut.UTF8))))
    rows = odd.limit(MOST_ODD_SPLITS + 1).collect()
    if len(rows) > MOST_ODD_SPLITS:
        raise ValueError(f"more than {MOST_ODD_SPLITS} splits begin in a section or in another encoding than UTF-8; scan fewer periods at a time")
    return {(r.path, r.start): (r.mode, r.encoding) for r in rows}


def _stitched(pieces: DataFrame) -> DataFrame:
    """Entries put together from their pieces; a few rows a split, so these are shuffled, by file and entry."""
    in_file = Window.partitionBy("path").orderBy("start", F.when(F.col("kind") == entry_cut.LEAD, 0).when(F.col("kind") == entry_cut.THROUGH, 1).otherwise(2))
    numbered = pieces.withColumn("entry", F.sum(F.when(F.col("kind") == entry_cut.OPEN, 1).otherwise(0)).over(in_file))
    # text before a file's first entry, or between two, is no piece of an entry; an end tag without a start is malformed
    before = F.last(F.when(F.col("kind") != entry_cut.THROUGH, F.col("kind")), True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    loose = (F.col("kind") == entry_cut.THROUGH) & F.coalesce(before == entry_cut.LEAD, F.lit(False))
    kept = numbered.withColumn("loose", loose).where(~F.col("loose") & ((F.col("entry") > 0) | (F.col("kind") == entry_cut.LEAD)))
    texts = kept.groupBy("path", "entry").agg(F.array_sort(F.collect_list(F.struct("start", "entry_xml"))).alias("p"))
    return texts.select("path", F.array_join("p.entry_xml", "").alias("entry_xml"))


def read_entry_texts(spark: SparkSession, root: str, paths: list[str] | None = None, glob: str = FEED_GLOB) -> DataFrame:
    """S2 (text form): ``(period, path, entry_xml, canonical_xml)`` for every entry of every feed file.

    ``paths`` restricts the scan to those directories/files (built from selected periods, so
    unselected periods are never listed or read), ``glob`` names the files. Where a file has several splits, they are read twice and must be the
    same both times: the files, the split size and, for inputs of less than a split a core, the number of cores.
    """
    full, root_path = qualified(spark, root)
    raw = (spark.read.format("text")
           .option("lineSep", RECORD_END)
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", glob)
           .load(paths if paths else full))
    meta = F.col("_metadata")
    columns = [meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), meta["file_block_length"].alias("length"),
               meta["file_size"].alias("size"), F.col("value").cast("binary").alias("value")]
    splits = raw.select(*columns)
    least = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(LEAST_SPLIT))
    whole = F.lower("path").endswith(".gz")
    largest = list_feed_files(spark, root, paths, glob).where(~whole).agg(F.max("length")).first()[0] or 0
    if largest <= least:
        texts = splits.mapInArrow(_cut({}, False), _CUT_ROWS).select("path", "entry_xml", CANONICAL)
    else:
        # the same files in every read, so that Spark splits them alike (a filter on their sizes would be pushed into the
        # listing and change the splits); the tasks step over files of one split
        odd = _odd_splits(splits)
        path = scratch_path(spark, "entry-pieces")
        splits.mapInArrow(_cut(odd, True), _CUT_ROWS).write.parquet(path)
        pieces = spark.read.schema(_CUT_ROWS).parquet(path)
        texts = splits.mapInArrow(_cut(odd, False), _CUT_ROWS).select("path", "entry_xml", CANONICAL).unionByName(with_canonical(_stitched(pieces)))
    return (texts.withColumn("period", period_from_path(F.col("path"), root_path)).where(F.col("period") != F.lit(""))
                 .select("period", "path", "entry_xml", CANONICAL))


def cut_documents(files: DataFrame, content_col: str = "content") -> DataFrame:
    """Rows with a whole feed file's bytes -> one row for each of its entries, in ``entry_xml`` and ``canonical_xml``."""
    others = [c for c in files.columns if c != content_col]
    schema = files.select(*others, F.lit("").alias("entry_xml")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                texts = list(entry_cut.cut_file(iter([batch.column(len(others))[row].as_py() or b""])))
                same = [pa.repeat(batch.column(k)[row], len(texts)) for k in range(len(others))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(texts, pa.string())], schema.names)

    return with_canonical(files.select(*others, F.col(content_col).cast("binary")).mapInArrow(run, schema))


def read_entries_strict(spark: SparkSession, root: str, paths: list[str] | None = None,
                        mode: str = "FAILFAST", glob: str = FEED_GLOB, columns=None) -> DataFrame:
    """S2 (strict form): the XML source, ``rowTag=entry``; ``(period, path, e)``. ``columns`` as in ``parse_entries``."""
    full, root_path = qualified(spark, root)
    members, permissive = block_members_for(columns), mode.upper() == "PERMISSIVE"
    ddl = raw_entry_ddl(members) + (f", {CORRUPT} STRING" if permissive else "")
    reader = (spark.read.format("xml").options(**xml_options(mode))
              .option("rowTag", "entry")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob)
              .schema(ddl))
    df = reader.load(paths if paths else full)
    cols = [F.col(c) for c in df.columns]
    e = F.struct(*cols)
    if permissive:
        # Spark refuses to read the malformed text alone; a generator keeps the other columns beside it
        e = F.explode(F.array(e))
    df = df.select(e.alias("e"), F.col("_metadata.file_path").alias("path"))
    if members is not None:
        df = df.withColumn("e", _widen(F.col("e"), members, permissive))
    return (df.withColumn("period", period_from_path(F.col("path"), root_path))
              .where(F.col("period") != F.lit("")))


def parse_entries(texts: DataFrame, text_col: str = "entry_xml", mode: str = "FAILFAST",
                  keep_raw_xml: bool = False, columns=None) -> DataFrame:
    """Add the parsed RAW struct ``e`` (and ``raw_block`` when asked) to a frame of entry texts.

    ``columns`` (output column names) limits the parse to the contract-block members those
    columns are computed from; by default everything is parsed. Of an entry with a text in the
    column CANONICAL, if there is one, that text is parsed.
    """
    members = block_members_for(columns)
    ddl = RAW_ENTRY_DDL if members is None else raw_entry_ddl(members)
    # The parse is produced by a generator so that the optimizer cannot inline the
    # (expensive) from_xml call into every later use of ``e`` or into pushed-down filters:
    # each entry is parsed exactly once.
    cols = [F.col(c) for c in texts.columns if c != CANONICAL]
    text = F.coalesce(CANONICAL, text_col) if CANONICAL in texts.columns else F.col(text_col)
    out = texts.select(*cols, F.explode(F.array(parse_entry_text(text, mode, ddl))).alias("e"))
    if members is not None:
        out = out.withColumn("e", _widen(F.col("e"), members, mode.upper() == "PERMISSIVE"))
    if keep_raw_xml:
        out = out.withColumn("raw_block", raw_block(F.col(text_col)))
    return out
