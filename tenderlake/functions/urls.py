"""Relative -> absolute URL (H2) in SQL functions only.

Reference resolution as in RFC 3986 section 5.2, with what web pages need on top: white space
around the href and line breaks inside it are dropped, scheme and host are lower-cased, an href with the
base's own scheme and no host counts as relative, backslashes in web addresses are slashes, encoded dots are
dots, a scheme's own port is left out, and characters that a path or query may not
hold (blanks, quotes, angle brackets, braces, back quotes, controls, non-ASCII) are
percent-encoded. An href that gives no host for http(s), or no scheme at all, gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"
_PARTS = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)"
_TO_ENCODE = "[^\\x21\\x23-\\x3B\\x3D\\x3F-\\x5F\\x61-\\x7A\\x7C\\x7E]"


# Segments "." and "..", also with encoded dots.
_DOT, _DOTS = "^(?:\\.|%2[eE])$", "^(?:\\.|%2[eE]){2}$"
_FRAGMENT_ENCODE = "[^\\x21\\x23-\\x3B\\x3D\\x3F-\\x5F\\x61-\\x7E]"


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 section 5.2.4."""
    def step(acc: Column, s: Column) -> Column:
        up = F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
        return F.when(s.rlike(_DOT), acc).when(s.rlike(_DOTS), up).otherwise(F.array_append(acc, s))

    def clean(segments: Column) -> Column:
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        ends_in_dots = F.element_at(segments, -1).rlike(f"{_DOT}|{_DOTS}")
        return F.array_join(F.when(ends_in_dots, F.array_append(kept, F.lit(""))).otherwise(kept), "/")

    return F.when(path.rlike("(^|/)(?:\\.|%2[eE]){1,2}(/|$)"), _let(F.split(path, "/"), clean)).otherwise(path)


def percent_encode(text: Column, unsafe: str = _TO_ENCODE) -> Column:
    """Encodes what a path or a query may not hold; existing percent signs stay."""
    one = lambda c: F.when(c.rlike(unsafe), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c)
    return F.when(text.rlike(unsafe), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def _parsed(url: Column) -> Column:
    """(scheme, has_host, host, path, query with its mark, fragment with its mark) of a URL or reference."""
    return F.struct(
        F.lower(F.regexp_extract(url, _SCHEME, 1)).alias("scheme"),
        url.rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//").alias("has_host"),
        F.lower(F.regexp_extract(url, _PARTS, 1)).alias("host"),
        F.regexp_extract(url, _PARTS, 2).alias("path"),
        F.regexp_extract(url, "^[^?#]*(\\?[^#]*)", 1).alias("query"),
        F.regexp_extract(url, "(#.*)$", 1).alias("fragment"),
    )


def _joined(b: Column, r: Column) -> Column:
    absolute = (r["scheme"] != "") & ((r["scheme"] != b["scheme"]) | r["has_host"])
    directory = F.regexp_extract(b["path"], "^(.*/)", 1)
    merged = F.concat(F.when(b["has_host"] & (directory == ""), F.lit("/")).otherwise(directory), r["path"])
    path = (F.when(absolute | r["has_host"], F.when(r["path"].startswith("/"), remove_dot_segments(r["path"])).otherwise(r["path"]))
             .when(r["path"] == "", b["path"])
             .when(r["path"].startswith("/"), remove_dot_segments(r["path"]))
             .otherwise(remove_dot_segments(merged)))
    query = F.when(~absolute & ~r["has_host"] & (r["path"] == "") & (r["query"] == ""), b["query"]).otherwise(r["query"])
    scheme = F.when(absolute, r["scheme"]).otherwise(b["scheme"])
    own_host = absolute | r["has_host"]
    web = scheme.isin("http", "https")
    has_host = F.when(own_host, r["has_host"]).otherwise(b["has_host"])
    host = F.when(own_host, r["host"]).otherwise(b["host"])
    # the port that the scheme has anyway, or none behind the colon
    host = F.when(scheme == "http", F.regexp_replace(host, ":0*(?:80)?$", "")).when(scheme == "https", F.regexp_replace(host, ":0*(?:443)?$", "")).otherwise(host)
    url = F.concat(scheme, F.lit(":"), F.when(has_host, F.concat(F.lit("//"), host)).otherwise(F.lit("")),
                   percent_encode(path), percent_encode(query), percent_encode(r["fragment"], _FRAGMENT_ENCODE))
    good = (scheme != "") & (~web | (has_host & (host != "")))
    return F.when(good, url)


# What needs no more than being put together: a lower-case http(s) base and a path of plain characters,
# neither with a segment that begins with a dot.
_PLAIN_BASE = "^https?://[a-z0-9.-]+(?::[0-9]+)?(?:/(?:[A-Za-z0-9_~-][A-Za-z0-9._~-]*/?)*)?(?:[?#].*)?$"
_PLAIN_HREF = "^/?[A-Za-z0-9_~-][A-Za-z0-9._~-]*(?:/[A-Za-z0-9_~-][A-Za-z0-9._~-]*)*/?$"


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base``; null when either is null or no URL comes out."""
    clean = F.regexp_replace(F.regexp_replace(href, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", ""), "[\\t\\n\\r]", "")
    # in web addresses a backslash before the query is a slash
    web = base.rlike("^[hH][tT][tT][pP][sS]?:") & (~clean.rlike(_SCHEME) | clean.rlike("^[hH][tT][tT][pP][sS]?:"))
    slashed = F.concat(F.replace(F.regexp_extract(clean, "^[^?#]*", 0), F.lit("\\"), F.lit("/")), F.regexp_extract(clean, "[?#].*$", 0))
    clean = F.when(web & clean.contains("\\"), slashed).otherwise(clean)
    pair = F.struct(_parsed(base).alias("b"), _parsed(clean).alias("r"))
    general = F.when(base.isNotNull() & href.isNotNull(), _let(pair, lambda p: _joined(p["b"], p["r"])))
    origin = F.regexp_extract(base, "^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(base, "^https?://[^/?#]+([^?#]*/)", 1)
    start = F.when(href.startswith("/"), origin).when(folder == "", F.concat(origin, F.lit("/"))).otherwise(F.concat(origin, folder))
    return F.when(base.rlike(_PLAIN_BASE) & href.rlike(_PLAIN_HREF), F.concat(start, href)).otherwise(general)
