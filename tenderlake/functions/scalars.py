"""Scalar column functions: identifiers, URLs, file names, periods, types and units.

All are compositions of built-in Spark SQL functions (JVM, code-generated where Spark can).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Procurement type aliases (matched trimmed and lower-cased).
MINOR_CONTRACTS_ALIASES = ["mc", "minor-contracts", "min"]
PUBLIC_TENDERS_ALIASES = ["pt", "pub", "public-tenders"]
MINOR_CONTRACTS = "minor-contracts"
PUBLIC_TENDERS = "public-tenders"
# Display names of the two procurement types.
DISPLAY_NAMES = {MINOR_CONTRACTS: "Minor Contracts", PUBLIC_TENDERS: "Public Tenders"}
# Feed file extensions (case-insensitive) and the archive extension.
FEED_EXTENSIONS = ["xml", "atom"]
ARCHIVE_SUFFIX = ".zip"
# Fixed value: pattern of the period inside an archive file name (last `_digits` before .zip).
PERIOD_IN_ARCHIVE = r"_(\d+)\.zip$"
BYTES_PER_MB = 1048576.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def id_from_url(x) -> Column:
    """Last non-empty ``/`` segment of an identifier URL; the text itself if it has none."""
    x = _c(x)
    segment = F.regexp_extract(x, r"([^/]+)/*$", 1)
    return F.when(segment != F.lit(""), segment).otherwise(x)


def local_name(x) -> Column:
    """Local part of a qualified XML name (``cbc:ID`` -> ``ID``)."""
    return F.regexp_extract(_c(x), r"([^:]*)$", 1)


def matches_local_name(qname, local: str) -> Column:
    """True when ``qname`` is ``local`` or ends with ``:local``."""
    q = _c(qname)
    return (q == F.lit(local)) | q.endswith(":" + local)


def url_path_last_segment(url) -> Column:
    """Last segment of the path of an absolute URL (query and fragment ignored)."""
    return F.regexp_extract(_c(url), r"^[^?#]*/([^/?#]*)", 1)


def period_from_archive_name(name) -> Column:
    """Period digits of ``..._<digits>.zip``; ``''`` when the name has none."""
    return F.regexp_extract(_c(name), PERIOD_IN_ARCHIVE, 1)


def is_archive_link(href) -> Column:
    """Whole href ends with ``.zip`` (case-sensitive)."""
    return _c(href).endswith(ARCHIVE_SUFFIX)


def archive_stem(path) -> Column:
    """``/a/b/202401.zip`` -> ``202401`` (the directory the archive extracts to)."""
    return F.regexp_extract(_c(path), r"([^/]+)\.zip$", 1)


def file_extension(path) -> Column:
    """Lower-cased extension of the last path segment, ``''`` if none."""
    return F.lower(F.regexp_extract(_c(path), r"\.([^./]+)$", 1))


def is_feed_file(path) -> Column:
    return file_extension(path).isin(*FEED_EXTENSIONS)


def is_safe_member(member) -> Column:
    """Archive member that is a file staying inside the extraction root.

    Not a directory (trailing ``/``), not absolute, no drive prefix, and no ``..`` that
    climbs above the root at any point of the path.
    """
    m = _c(member)
    parts = F.filter(F.split(m, "/"), lambda p: (p != F.lit("")) & (p != F.lit(".")))
    depth = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")),
        lambda acc, p: F.struct(
            (acc["d"] + F.when(p == F.lit(".."), -1).otherwise(1)).alias("d"),
            F.least(acc["low"], acc["d"] + F.when(p == F.lit(".."), -1).otherwise(1)).alias("low"),
        ),
    )
    return (
        m.isNotNull() & (m != F.lit("")) & ~m.endswith("/") & ~m.startswith("/")
        & ~m.contains("\\") & ~m.rlike(r"^[A-Za-z]:") & (depth["low"] >= 0) & (depth["d"] > 0)
    )


def strip_ws(x) -> Column:
    """Remove leading and trailing white space (spaces, tabs, line breaks)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def procurement_type(x) -> Column:
    """Normalise a type alias; unknown values fall back to public tenders."""
    v = F.lower(strip_ws(x))
    return F.when(v.isin(*MINOR_CONTRACTS_ALIASES), F.lit(MINOR_CONTRACTS)).otherwise(F.lit(PUBLIC_TENDERS))


def is_known_type(x) -> Column:
    v = F.lower(strip_ws(x))
    return F.coalesce(v.isin(*(MINOR_CONTRACTS_ALIASES + PUBLIC_TENDERS_ALIASES)), F.lit(False))


def display_name(type_col) -> Column:
    t = _c(type_col)
    return (F.when(t == F.lit(MINOR_CONTRACTS), F.lit(DISPLAY_NAMES[MINOR_CONTRACTS]))
             .when(t == F.lit(PUBLIC_TENDERS), F.lit(DISPLAY_NAMES[PUBLIC_TENDERS])))


def format_duration(seconds) -> Column:
    """Whole seconds -> ``HH:MM:SS``; hours are not wrapped at 24."""
    s = _c(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def mb_from_bytes(b) -> Column:
    return _c(b).cast("double") / F.lit(BYTES_PER_MB)


def round_two(x) -> Column:
    """Round to 2 decimals, half away from zero, as ``round(x * 100) / 100``."""
    return F.round(_c(x) * F.lit(100.0)) / F.lit(100.0)


def throughput(mb, seconds) -> Column:
    """MB per second, or the size itself when no time has elapsed."""
    mb, seconds = _c(mb), _c(seconds)
    return F.when(seconds > 0, mb / seconds).otherwise(mb)
