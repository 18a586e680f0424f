"""File-system access: pyarrow file systems inside tasks, Spark's own on the driver."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Runs in Python workers: shipped by value so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fs_and_path(uri: str):
    """``(filesystem, path)`` for a Spark-style URI (``file:/x``, ``/x``, ``hdfs://``, ``s3://``)."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        from urllib.parse import unquote, urlparse

        return pafs.LocalFileSystem(), unquote(urlparse(uri).path)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    if uri.startswith(("s3a://", "s3n://")):  # Hadoop's names for the same store
        uri = "s3://" + uri.split("://", 1)[1]
    return pafs.FileSystem.from_uri(uri)


def qualified(spark, path: str) -> tuple[str, str]:
    """(full path, its URI-encoded path part) of a path as its file system names it.

    Relative paths, ``./``, a missing scheme or host and characters that need encoding all
    come out the way Spark reports the files below it.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p)
    return full.toString(), full.toUri().getRawPath()


def folders(spark, path: str) -> list[str]:
    """Names of the folders right below ``path``, sorted; none when it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
