"""Secrets in texts: an Aho-Corasick prefilter, anchored patterns at its hits, embedded checksums.

One Aho-Corasick automaton reads each text once. It does not read the text itself but its *folded* form, in which
letters lose their case and every character that may stand in a lower-case hexadecimal number becomes one and the same
letter. A keyword of any case, and any run of ``HEX_LEAST`` hexadecimal digits, is then a plain keyword, so no secret can
start at a place that the automaton does not report. Only there the kind's pattern is tried, anchored at the hit; all
other places of a text are never looked at by a regular expression.

Base kinds (``assign``, ``access``, ``hex``) are what their patterns match, leftmost and non-overlapping; a match
that is too short is dropped and nothing is tried again inside it. The other kinds are tokens that carry a checksum of
their own, and count only if it holds: ``github`` and ``npm`` (CRC-32 of the random part, in base 62), ``age`` and
``nostr`` (the BCH code of bech32 keys).

Texts are read as UTF-8 bytes: all patterns are ASCII, so they match the same places as on characters. Offsets are
given in code points. A text is scanned whole, whatever its length, in memory of a few times its size.

Edge cases: null and empty texts have no spans; equal texts have equal spans; rows are read one by one, so repeated
rows, null ids and other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import by_value, fresh, per_worker

BASE = ("assign", "access", "hex")
CHECKED = ("github", "npm", "age", "nostr")
KINDS = BASE + CHECKED
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

# The token formats.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "age": ("AGE-SECRET-KEY-1",),
    "nostr": ("nsec1",),
}
PATTERNS = {
    "assign": re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"(?<![0-9a-f])[0-9a-f]+"),
    "github": re.compile(rb"(?<![A-Za-z0-9_])gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9_])"),
    "npm": re.compile(rb"(?<![A-Za-z0-9_])npm_([A-Za-z0-9]{36})(?![A-Za-z0-9_])"),
    "age": re.compile(rb"(?<![A-Za-z0-9])AGE-SECRET-KEY-1([02-9AC-HJ-NP-Z]{58})(?![A-Za-z0-9])"),
    "nostr": re.compile(rb"(?<![A-Za-z0-9])nsec1([02-9ac-hj-np-z]{58})(?![A-Za-z0-9])"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
PREFIXES = {"age": "age-secret-key-", "nostr": "nsec"}

#: Lower-cases ASCII letters and writes every hexadecimal digit of either case as "h".
_FOLD = bytes(104 if chr(c) in "0123456789abcdefABCDEF" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def folded(data: bytes) -> str:
    """The text that the automaton reads, one character for each byte."""
    return data.translate(_FOLD).decode("latin-1")


def automaton() -> ahocorasick.Automaton:
    """All keywords, folded; a keyword's value is its length and the kinds it may start."""
    entries: dict[str, list[str]] = {"h" * HEX_LEAST: ["hex"]}
    for kind, keywords in KEYWORDS.items():
        for keyword in keywords:
            entries.setdefault(folded(keyword.encode()), []).append(kind)
    built = ahocorasick.Automaton()
    for keyword, kinds in entries.items():
        built.add_word(keyword, (len(keyword), tuple(kinds)))
    built.make_automaton()
    return built


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` in six base-62 digits."""
    n, digits = zlib.crc32(body), []
    for _ in range(6):
        n, d = divmod(n, 62)
        digits.append(BASE62[d])
    return "".join(reversed(digits)).encode()


def bech32_residue(prefix: str, data: str) -> int:
    """The BCH residue of a bech32 string; 1 for a valid one."""
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [BECH32.index(c) for c in data]
    state = 1
    for value in values:
        top = state >> 25
        state = (state & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            if top >> bit & 1:
                state ^= step
    return state


def valid(kind: str, match: re.Match) -> bool:
    """Whether a match of the kind's pattern is a secret: long enough, and its checksum holds."""
    if kind == "assign":
        return len(match[1]) >= ASSIGN_LEAST
    if kind == "access":
        return match.end() - match.start() >= ACCESS_LEAST
    if kind == "hex":
        return match.end() - match.start() >= HEX_LEAST
    if kind in PREFIXES:
        return bech32_residue(PREFIXES[kind], match[1].decode().lower()) == 1
    return base62_crc(match[1][:30]) == match[1][30:]


def byte_spans(data: bytes, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all secrets in a text's bytes, in this order."""
    found, done = [], dict.fromkeys(KINDS, 0)
    for last, (length, kinds) in keywords.iter(folded(data)):
        start = last + 1 - length
        for kind in kinds:
            # a hit inside the match before starts none of its own, as matches do not overlap
            if start < done[kind]:
                continue
            match = PATTERNS[kind].match(data, start)
            if match:
                done[kind] = match.end()
                if valid(kind, match):
                    found.append((start, KINDS.index(kind), match.end()))
    return sorted(found)


def secret_spans(text: str | None, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all secrets in a text, in code points."""
    data = (text or "").encode("utf-8", "replace")
    spans = byte_spans(data, keywords)
    if not spans or len(data) == len(text):
        return spans
    # offsets in bytes -> in characters, counted once from one offset to the next
    places, at, characters = {}, 0, 0
    for offset in sorted({x for start, _, end in spans for x in (start, end)}):
        characters += len(data[at:offset].decode("utf-8"))
        places[offset], at = characters, offset
    return [(places[start], kind, places[end]) for start, kind, end in spans]


SPANS = "array<struct<kind:string,start:int,stop:int>>"


def spans_column(text: Column) -> Column:
    """Secrets of each text: kind, start and stop (exclusive) in code points, by start and kind."""

    @F.pandas_udf(SPANS)
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keywords = per_worker("secret-keywords", "", automaton)
        for batch in texts:
            yield pd.Series([[{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in secret_spans(t, keywords)] for t in batch], dtype=object)

    return of(text)


def find(docs: DataFrame, spans: str = "spans") -> DataFrame:
    """``docs`` (with a column text) with its secrets in the column ``spans``."""
    return docs.withColumn(spans, spans_column(F.col("text")))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:stop``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret replaced by its kind in square brackets; of overlapping ones the first is named."""
    spans = fresh(docs, "secret_spans")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, rows in zip(texts, found):
            if rows is None or not len(rows):
                out.append(text)
                continue
            kept, at = [], 0
            for row in rows:
                if row["start"] >= at:
                    kept += [text[at : row["start"]], f"[{row['kind'].upper()}]"]
                at = max(at, row["stop"])
            out.append("".join([*kept, text[at:]]))
        return pd.Series(out, dtype=object)

    with_spans = find(docs, spans)
    return with_spans.withColumn("text", masked(F.col("text"), F.col(spans))).drop(spans)


by_value(__name__)
