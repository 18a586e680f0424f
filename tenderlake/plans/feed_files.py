"""Stand-in feed files: the fixture entries written as gzipped Atom XML files or ZIP archives.

Layout (what the scans expect): ``<root>/<period>/part-<task>-<n>.xml.gz`` or
``<root>/<period>/part-<task>-<n>.zip`` (one feed file in each archive). A task writes its rows in
the order of their periods, one file at a time and a new one at every period and about every
``FILE_BYTES`` of text. An entry's text is some fifty times its table rows, so it is made from them only
where it is written: it is neither shuffled nor sorted. A retried task rewrites the same file names.

Files go under the shared checkpoint folder (``spark.checkpoint.dir``), written with
pyarrow's file systems (local, HDFS and S3 URIs).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this module run in Python workers: ship them by value so the workers do not
# need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.plans.fixtures import entry_fields, entry_rows, entry_texts
from tenderlake.session import ensure_checkpoint_dir, scratch_path
from tenderlake.sources.fsio import folders, fs_and_path

FEED_HEAD = ('<?xml version="1.0" encoding="{}"?>\n'
             '<feed xmlns="http://www.w3.org/2005/Atom" '
             'xmlns:cac="urn:cac" xmlns:cbc="urn:cbc" '
             'xmlns:cac-place-ext="urn:cac-place-ext" xmlns:cbc-place-ext="urn:cbc-place-ext">\n'
             '<title>feed</title><updated>2024-01-01</updated>\n')
FEED_TAIL = "</feed>\n"

_MEMO: dict[tuple, str] = {}


SALTS = 4                # a period is written by up to so many tasks
FILE_BYTES = 64 << 20    # of text in a file, or little more: a gzipped file is read by one task
LEVEL = 6                # of compression


ROWS = 1_000             # whose texts are made at a time


def _texts(rows: pa.RecordBatch) -> pa.Array:
    return rows.column("entry_xml")


def _runs(values: list) -> Iterator[tuple[str, int, int]]:
    """(value, start, end) of each run of equal values, without those of nulls."""
    start = 0
    for at in range(1, len(values) + 1):
        if at == len(values) or values[at] != values[start]:
            if values[start] is not None:
                yield values[start], start, at
            start = at


def _writer(root: str, archive: bool, encoding: str, make: Callable[[pa.RecordBatch], pa.Array]):
    """Rows sorted by period -> the files of each period, written as the rows come; ``make`` gives their entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        import zipfile

        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        fs, base = fs_and_path(root)
        open_period, out, member, zf, name, n, size = None, None, None, None, None, 0, 0
        manifest = []

        def close() -> None:
            member.write(FEED_TAIL.encode())
            member.close()
            if zf:
                zf.writestr("README.txt", "not a feed")
                zf.close()
            out.close()
            manifest.append((open_period, f"{open_period}/{name}", n, size))

        for rows in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
            texts = make(rows)
            for period, start, end in _runs(rows.column("period").to_pylist()):
                if period != open_period or size >= FILE_BYTES:
                    if open_period is not None:
                        close()
                    open_period, n, size = period, 0, 0
                    stem = f"part-{pid:05d}-{len(manifest):05d}"
                    name = stem + (".zip" if archive else ".xml.gz")
                    fs.create_dir(f"{base}/{period}", recursive=True)
                    out = fs.open_output_stream(f"{base}/{period}/{name}", compression=None)
                    if archive:
                        zf = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=LEVEL)
                        zf.writestr("feeds/", "")
                        member = zf.open(f"feeds/{stem}.xml", "w")
                    else:
                        member = gzip.GzipFile(f"{stem}.xml", "wb", LEVEL, out, mtime=0)
                    member.write(FEED_HEAD.format(encoding).encode())
                data = ("\n".join(texts.slice(start, end - start).to_pylist()) + "\n").encode(encoding)
                member.write(data)
                n, size = n + end - start, size + len(data)
        if open_period is not None:
            close()
        names = ["period", "file", "n_entries", "bytes"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in manifest], MANIFEST)

    return run


MANIFEST = pa.schema([("period", pa.string()), ("file", pa.string()), ("n_entries", pa.int64()), ("bytes", pa.int64())])


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``period``, dealt to tasks by it and a salt."""
    n = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n, F.col("period"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))


def write_feed(rows: DataFrame, text: Column | Callable[[pa.RecordBatch], pa.Array], root: str, archive: bool = False,
               encoding: str = "UTF-8") -> DataFrame:
    """Write an entry for each row, of which ``text`` is the XML, as feed files of its ``period`` below ``root``, by the
    tasks that hold the rows; returns the manifest. ``text`` may be a function that makes the entries of a batch of rows,
    in the task that writes them."""
    rows, make = rows.sortWithinPartitions("period"), text
    if isinstance(text, Column):
        rows, make = rows.select("period", text.alias("entry_xml")), _texts
    return rows.mapInArrow(_writer(root, archive, encoding, make), "period string, file string, n_entries long, bytes long")


def write_entry_feed(rows: DataFrame, root: str, archive: bool = False, **options) -> DataFrame:
    """``write_feed`` of the entries of ``entry_rows``; ``options`` are those of ``entry_fields``."""
    return write_feed(rows.select(*entry_fields(**options)), entry_texts, root, archive)


def _key(spark: SparkSession, sf_dir: str, omit_atom: bool = False, archive: bool = False) -> tuple:
    return (sf_dir, omit_atom, archive, ensure_checkpoint_dir(spark), spark.sparkContext.applicationId)


def feed_root(spark: SparkSession, sf_dir: str, omit_atom: bool = False, archive: bool = False) -> str:
    """Feed files of ``sf_dir`` written once per session and checkpoint folder; returns the root."""
    key = _key(spark, sf_dir, omit_atom, archive)
    if key not in _MEMO or not folders(spark, _MEMO[key]):   # may have been cleared meanwhile
        root = scratch_path(spark, "feed-zip" if archive else "feed")
        write_entry_feed(entry_rows(spark, sf_dir), root, archive, omit_atom=omit_atom).count()
        _MEMO[key] = root
    return _MEMO[key]


def feed_roots(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Roots of the feed and of the one with ``omit_atom``; where neither is there, both are written from the same rows, so
    that the tables are shuffled once."""
    keys = [_key(spark, sf_dir, omit) for omit in (False, True)]
    if not any(key in _MEMO and folders(spark, _MEMO[key]) for key in keys):
        base, omit = scratch_path(spark, "feeds"), F.col("omit")
        rows = entry_rows(spark, sf_dir).withColumn("omit", F.explode(F.array(F.lit(False), F.lit(True))))
        rows = rows.withColumn("period", F.concat(F.when(omit, "omit/").otherwise("full/"), "period"))
        write_entry_feed(rows, base, omit_atom=omit).count()
        _MEMO.update(zip(keys, (f"{base}/full", f"{base}/omit")))
    return feed_root(spark, sf_dir), feed_root(spark, sf_dir, omit_atom=True)
