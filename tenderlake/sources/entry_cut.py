"""Cutting the bytes of feed files into entries, aware of comments, CDATA sections and processing instructions.

Used by the text scan, the archive scan and the stream alike, so that all cut the same entries. An entry runs from
``<entry`` or ``<prefix:entry`` to the end tag with the same prefix; such tags inside a comment, a CDATA section or an
instruction are text. An entry tag of another prefix inside an entry is part of its content. An entry that is followed by
the next one, or by the end of the file, without its end tag is given as it stands, and an end tag without an
entry by itself, so that the parse takes both for malformed.

A file may be cut in parts, each by another task: a part's *mode* is what its first byte lies in (``TEXT`` or
one of the sections), and an entry that reaches over a part's border comes out as pieces: ``open`` (from its start tag to
the part's end), ``through`` (a whole part without an entry tag) and ``lead`` (up to the end tag).

Encodings: the byte order mark or the XML declaration of a file names it, UTF-8 by default. Bytes that the encoding does
not have become U+0000, which no XML text may hold, so that the parse takes that entry for malformed too.
"""

from __future__ import annotations

import codecs
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle

# Runs in Python workers: shipped by value so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT, COMMENT, CDATA, INSTRUCTION = range(4)
OPENERS = {b"<!--": COMMENT, b"<![CDATA[": CDATA, b"<?": INSTRUCTION}
CLOSERS = {COMMENT: b"-->", CDATA: b"]]>", INSTRUCTION: b"?>"}
ENTRY, OPEN, THROUGH, LEAD = "entry", "open", "through", "lead"
UTF8 = "utf-8"

_NAME = rb"""[^\s<>/:=!?"']+:"""
_SECTION = re.compile(rb"<!--|<!\[CDATA\[|<\?")
_TOKEN = re.compile(rb"<!--|<!\[CDATA\[|<\?|<(/?)((?:" + _NAME + rb")?)entry(?=[\s/>])")
_BEFORE = re.compile(rb"<(/?)((?:" + _NAME + rb")?)\Z")
_TAG_END = re.compile(rb"""[^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>""")
_DECLARED = re.compile(rb"""^(?:\xef\xbb\xbf)?\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)["']""")
#: A start tag or an opener is looked for in so many bytes before the end of what has been read.
_HOLD = 4096


def _not_decoded(error: UnicodeError):
    return "\x00", error.end


codecs.register_error("no-xml", _not_decoded)


def declared_encoding(head: bytes) -> str:
    """The encoding named by the first bytes of a file; raises for one that Python does not know."""
    if head[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        return "utf-16"
    named = _DECLARED.match(head[:1024])
    if not named or head[:3] == codecs.BOM_UTF8:
        return UTF8
    try:
        return codecs.lookup(named[1].decode("ascii")).name
    except LookupError:
        raise ValueError(f"feed file in an unknown encoding: {named[1].decode('ascii')}") from None


def decoded(data: bytes, encoding: str) -> str:
    codecs.register_error("no-xml", _not_decoded)
    return data.decode(encoding, "no-xml")


def mode_after(mode: int, data: bytes) -> int:
    """The mode behind ``data`` if it begins in ``mode``."""
    at = 0
    while True:
        if mode != TEXT:
            closer = CLOSERS[mode]
            at = data.find(closer, at)
            if at < 0:
                return mode
            at, mode = at + len(closer), TEXT
        opener = _SECTION.search(data, at)
        if opener is None:
            return TEXT
        at, mode = opener.end(), OPENERS[opener[0]]


class EntryCutter:
    """Cuts one file, or one part of it, given in chunks of any size."""

    def __init__(self, mode: int = TEXT, leading: bool = False):
        self.mode = mode
        self.leading = leading       # no entry tag seen yet, in a part that is not the file's first
        self.prefix: bytes | None = None
        self.parts: list[bytes] = []  # text of the open entry (or of the lead) before the buffer
        self.rest = b""

    def _token(self, buffer: bytes, at: int, sections: bool) -> tuple[int, int, bytes, bytes] | None:
        """(start, end, '/' of an end tag, prefix) of the next entry tag, or (start, end, opener, None) of a section."""
        if sections:
            m = _TOKEN.search(buffer, at)
            return m and (m.start(), m.end(), m[0] if m[2] is None else m[1], m[2])
        # without sections, look for the name first: it is rare, and found faster than every "<"
        while (name := buffer.find(b"entry", at)) >= 0:
            at = name + 5
            opened = buffer.rfind(b"<", max(0, name - 256), name)
            m = _BEFORE.match(buffer, opened, name) if opened >= 0 else None
            if m and buffer[at : at + 1] in (b" ", b"\t", b"\r", b"\n", b"/", b">"):
                return m.start(), at, m[1], m[2]
        return None

    def feed(self, data: bytes, final: bool = False) -> Iterator[tuple[str, bytes]]:
        """(kind, text) of all that ends in ``data``; ``final`` tells that nothing follows."""
        buffer, self.rest = self.rest + data, b""
        sections = max(buffer.rfind(b"<!"), buffer.rfind(b"<?"))   # none opens behind this
        held = self.prefix is not None or self.leading
        keep, at = 0, 0   # where the text to keep starts; how far the buffer is read
        while True:
            if self.mode != TEXT:
                closer = CLOSERS[self.mode]
                found = buffer.find(closer, at)
                if found < 0:
                    safe = len(buffer) if final else max(at, len(buffer) - 2)
                    break
                at, self.mode = found + len(closer), TEXT
                continue
            token = self._token(buffer, at, at <= sections)
            if token is None:
                cut = buffer.rfind(b"<", max(at, len(buffer) - _HOLD))
                safe = len(buffer) if final or cut < 0 or buffer.find(b">", cut) >= 0 else cut
                break
            start, end, slash, prefix = token
            if prefix is None:
                at, self.mode = end, OPENERS[slash]
                continue
            tag = _TAG_END.match(buffer, end)
            if tag is None:
                if final:
                    safe = len(buffer)
                    if not slash and self.prefix is None:   # cut off inside its start tag
                        self.prefix, keep, held = prefix, start, True
                else:
                    safe = start
                break
            at = tag.end()
            if self.prefix is not None and prefix != self.prefix:
                continue
            if slash:
                kind = LEAD if self.leading else ENTRY
                yield kind, b"".join([*self.parts, buffer[keep if held else start : at]])
                self.prefix, held = None, False
            else:
                if self.prefix is not None:
                    yield ENTRY, b"".join([*self.parts, buffer[keep:start]])
                if buffer[at - 2 : at] == b"/>":
                    yield ENTRY, buffer[start:at]
                    self.prefix, held = None, False
                else:
                    self.prefix, keep, held = prefix, start, True
            self.parts, self.leading = [], False
        if held:
            self.parts.append(buffer[keep:safe])
        self.rest = buffer[safe:]
        if final:
            if self.prefix is not None:
                yield OPEN, b"".join(self.parts)
            elif self.leading:
                yield THROUGH, b"".join(self.parts)


def cut_file(chunks: Iterator[bytes]) -> Iterator[str]:
    """The entries of a whole file, as text."""
    cutter, encoding, utf16 = EntryCutter(), None, None
    for data in chunks:
        if encoding is None:
            encoding = declared_encoding(data)
            if encoding == "utf-16":
                utf16, encoding = codecs.getincrementaldecoder("utf-16")("no-xml"), UTF8
        if utf16:
            data = utf16.decode(data).encode()
        for _, text in cutter.feed(data):
            yield decoded(text, encoding)
    for _, text in cutter.feed(utf16.decode(b"", True).encode() if utf16 else b"", True):
        yield decoded(text, encoding or UTF8)
