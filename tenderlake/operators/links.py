"""Archive links on listing pages (S5 = G3 + P13 + F7 + H2-H4 + A1).

``pages(page_id, url, html)`` -> anchors in document order -> href resolved against the page
URL -> archive links (href ends with ``.zip``) -> period from the file name -> one URL per
period, the last one winning (by page, then position on the page).
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.scalars import is_archive_link, period_from_archive_name, url_path_last_segment
from tenderlake.functions.urls import resolve_url

# A page's tokens: comments, elements whose content is plain text to its end tag (or the end of the page), and tags, in which
# quoted values are stepped over whole, so that a ">", an "<a" or an "href=" inside one is no markup.
_RAW_TEXT = "script|style|textarea|title|xmp|iframe|noembed|noframes"
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(" + _RAW_TEXT + r")(?=[\s/>])" + _ATTRIBUTES + r">.*?(?:</\1(?=[\s/>])|\z)|</?[a-z]" + _ATTRIBUTES + ">")
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
_HREF = r"""(?is)^<a(?:\s+(?!href\s*=)[^\s=>"']+(?:\s*=\s*""" + _VALUE + r""")?)*+\s+href\s*=\s*(""" + _VALUE + ")"
# In an attribute, a name without ";" is a reference only if neither a letter, a digit nor "=" follows.
_REFERENCE = "&(?:#[xX][0-9a-fA-F]{1,6}(?:;|(?![0-9a-fA-F]))|#[0-9]{1,7}(?:;|(?![0-9]))|[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=])))"
# Numbers 128 to 159 mean the characters of windows-1252, where it has one.
_CONTROLS = [(chr(c), bytes([c]).decode("cp1252", "ignore")) for c in range(128, 160)]
_CONTROLS_FROM = "".join(a for a, b in _CONTROLS if b)
_CONTROLS_TO = "".join(b for _, b in _CONTROLS if b)


def _numbered(ref: Column) -> Column:
    """The character of a numeric reference; the reference itself if there is none."""
    hexed = F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+);?$", 1)
    code = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(ref, "^&#([0-9]+);?$", 1)).cast("int")
    there = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.translate(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"), _CONTROLS_FROM, _CONTROLS_TO)
    return F.when(there, char).otherwise(ref)


def _named() -> Column:
    """The named references of HTML: name (with its ";" where it needs one) -> characters; a constant of the plan."""
    return F.from_json(F.lit(json.dumps(html5)), "map<string,string>")


def _decode_entities(c: Column) -> Column:
    """All references decoded in one pass, so that what one of them gives is not read as another."""
    def one(ref: Column) -> Column:
        return F.when(ref.startswith("&#"), _numbered(ref)).otherwise(
            F.coalesce(F.try_element_at(_named(), F.substring(ref, F.lit(2), F.length(ref) - 1)), ref))

    refs = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    between = F.split(c, _REFERENCE)
    return F.array_join(F.zip_with(between, F.array_append(F.transform(refs, one), F.lit("")), lambda text, char: F.concat(text, F.coalesce(char, F.lit("")))), "")


def anchor_hrefs(html: Column) -> Column:
    """``href`` of every ``<a>`` tag with one, in document order (references decoded)."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda t: F.lower(F.substring(t, 1, 2)) == "<a")
    raw = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, _HREF, 1)), lambda v: v != "")
    bare = lambda v: F.when(v.rlike("^[\"']"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return F.transform(raw, lambda v: F.when(v.contains("&"), _decode_entities(bare(v))).otherwise(bare(v)))


def page_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """``(page_id, pos, href, url)``: every anchor href, resolved against the page URL."""
    a = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("base"),
                     F.posexplode(anchor_hrefs(F.col(html_col))).alias("pos", "href"))
    # through a generator, so that the filter below does not resolve every URL a second time
    a = a.select("page_id", "pos", "href", F.explode(F.array(resolve_url(F.col("base"), F.col("href")))).alias("url"))
    return a.where(F.col("url").isNotNull()).select("page_id", "pos", "href", "url")


def archive_links(pages: DataFrame, **cols: str) -> DataFrame:
    """``(page_id, pos, url, file_name, period)`` for links to ``*.zip`` with a period in the name."""
    links = page_links(pages, **cols).where(is_archive_link(F.col("href")))
    links = links.withColumn("file_name", url_path_last_segment(F.col("url")))
    links = links.withColumn("period", period_from_archive_name(F.col("file_name")))
    return links.where(F.col("period") != F.lit("")).select("page_id", "pos", "url", "file_name", "period")


def link_map(links: DataFrame) -> DataFrame:
    """A1: ``(period, url)``, one row per period; the last link (page, then position) wins.

    ``max_by`` is aggregated partially before the shuffle, so only one row per period and
    task moves, however many links a period has.
    """
    return links.groupBy("period").agg(F.max_by("url", F.struct("page_id", "pos")).alias("url"))
