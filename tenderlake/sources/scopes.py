"""Leaves at any depth: entries whose contract block departs from the fixed paths are rewritten onto them.

The read schema lists the places where an output leaf usually stands. The rules below say where it *counts*: inside its
scopes, at any depth. ``canonical`` walks the tags of a contract block with the stack of open elements; if every leaf
that counts stands at a listed place, and those of one column come in the order in which the projection reads the places,
the entry is regular and stays as it is. Otherwise the block is written anew with all leaves that count at the first of
their places, in document order, so that the same parse and projection read them.

Regular entries, nearly all, cost one pass of a regular expression: the tags of a lot, a result or the rest of the block
are looked up among those walked before, together with the elements open before them. How a block is rewritten depends on its
tags alone, so blocks with the same tags are rewritten alike.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

# Runs in Python workers: shipped by value so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, LOT, RESULT, PROJECT = "ContractFolderStatus", "ProcurementProjectLot", "TenderResult", "ProcurementProject"
_PARTY, _PROCESS, _TERMS = "LocatedContractingParty", "TenderingProcess", "TenderingTerms"


def _inner(*paths: str) -> list[str]:
    """Places right under the lot and under a project inside it, in the projection's order."""
    return [p for path in paths for p in (path, f"{PROJECT}/{path}")]


# Fixed values: (container, leaf, scopes it must be in, scopes it must not be in, its places below the container).
RULES = [
    ("", "ContractFolderStatusCode", (), (), ["ContractFolderStatusCode"]),
    ("", "ContractFolderID", (), (), ["ContractFolderID"]),
    (LOT, "ID", (), (), ["ID"]),
    (LOT, "Name", (), ("Country",), _inner("Name")),
    (LOT, "TotalAmount", ("BudgetAmount",), (), _inner("BudgetAmount/TotalAmount")),
    (LOT, "TaxExclusiveAmount", ("BudgetAmount",), (), _inner("BudgetAmount/TaxExclusiveAmount")),
    (LOT, "ItemClassificationCode", ("RequiredCommodityClassification",), (), _inner("RequiredCommodityClassification/ItemClassificationCode")),
    (LOT, "IdentificationCode", ("Country",), (), _inner("RealizedLocation/Country/IdentificationCode", "RealizedLocation/Address/Country/IdentificationCode")),
    ("", "Name", (PROJECT,), (LOT, "Country"), [f"{PROJECT}/Name"]),
    ("", "TypeCode", (PROJECT,), (LOT,), [f"{PROJECT}/TypeCode"]),
    ("", "SubTypeCode", (PROJECT,), (LOT,), [f"{PROJECT}/SubTypeCode"]),
    ("", "TotalAmount", (PROJECT, "BudgetAmount"), (LOT,), [f"{PROJECT}/BudgetAmount/TotalAmount"]),
    ("", "TaxExclusiveAmount", (PROJECT, "BudgetAmount"), (LOT,), [f"{PROJECT}/BudgetAmount/TaxExclusiveAmount"]),
    ("", "ItemClassificationCode", (PROJECT, "RequiredCommodityClassification"), (LOT,), [f"{PROJECT}/RequiredCommodityClassification/ItemClassificationCode"]),
    ("", "IdentificationCode", (PROJECT, "Country"), (LOT, "PostalAddress"),
     [f"{PROJECT}/RealizedLocation/Country/IdentificationCode", f"{PROJECT}/RealizedLocation/Address/Country/IdentificationCode"]),
    ("", "ContractingPartyTypeCode", (_PARTY,), (), [f"{_PARTY}/ContractingPartyTypeCode"]),
    ("", "ActivityCode", (_PARTY,), (), [f"{_PARTY}/ActivityCode"]),
    ("", "WebsiteURI", (_PARTY, "Party"), (), [f"{_PARTY}/Party/WebsiteURI"]),
    ("", "Name", (_PARTY, "Party", "PartyName"), (), [f"{_PARTY}/Party/PartyName/Name"]),
    ("", "CityName", (_PARTY, "Party", "PostalAddress"), (), [f"{_PARTY}/Party/PostalAddress/CityName"]),
    ("", "PostalZone", (_PARTY, "Party", "PostalAddress"), (), [f"{_PARTY}/Party/PostalAddress/PostalZone"]),
    ("", "IdentificationCode", (_PARTY, "Party", "PostalAddress", "Country"), (), [f"{_PARTY}/Party/PostalAddress/Country/IdentificationCode"]),
    (RESULT, "ProcurementProjectLotID", (), (), ["ProcurementProjectLotID", "AwardedTenderedProject/ProcurementProjectLotID"]),
    (RESULT, "ResultCode", (), (), ["ResultCode"]),
    (RESULT, "Description", (), (), ["Description"]),
    (RESULT, "Name", ("WinningParty", "PartyName"), (), ["WinningParty/PartyName/Name"]),
    (RESULT, "SMEAwardedIndicator", (), (), ["SMEAwardedIndicator"]),
    (RESULT, "AwardDate", (), (), ["AwardDate"]),
    (RESULT, "TaxExclusiveAmount", ("AwardedTenderedProject", "LegalMonetaryTotal"), (), ["AwardedTenderedProject/LegalMonetaryTotal/TaxExclusiveAmount"]),
    (RESULT, "PayableAmount", ("AwardedTenderedProject", "LegalMonetaryTotal"), (), ["AwardedTenderedProject/LegalMonetaryTotal/PayableAmount"]),
    ("", "EndDate", (_PROCESS, "TenderSubmissionDeadlinePeriod"), (), [f"{_PROCESS}/TenderSubmissionDeadlinePeriod/EndDate"]),
    ("", "ProcedureCode", (_PROCESS,), (), [f"{_PROCESS}/ProcedureCode"]),
    ("", "UrgencyCode", (_PROCESS,), (), [f"{_PROCESS}/UrgencyCode"]),
    ("", "FundingProgramCode", (_TERMS,), (), [f"{_TERMS}/FundingProgramCode"]),
]
LOT_ID = re.compile(r"""\sschemeName\s*=\s*(["'])\s*ID_LOTE\s*\1""")
_PLACES = [[tuple(p.split("/")) for p in rule[4]] for rule in RULES]
_BY_LEAF: dict[str, list[int]] = {}
for _k, _rule in enumerate(RULES):
    _BY_LEAF.setdefault(_rule[1], []).append(_k)

_START = re.compile(r"<((?:[^\s<>/:!?]+:)?)\Z")
_TEXT = re.compile(r">[^<]+")
_TAGS = re.compile(r"<([^>]*)>")
_TOKENS = re.compile(r"""<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<(/?)(?:[^\s<>/:!?]+:)?([^\s<>/:!?]+)((?:[^<>"']+|"[^"]*"|'[^']*')*?)(/?)>""", re.S)


def rule_of(leaf: str, open_: tuple[str, ...]) -> int | None:
    """The rule of an element below the open elements, the first one whose scopes hold."""
    for k in _BY_LEAF.get(leaf, ()):
        container, _, inside, outside, _ = RULES[k]
        if (not container or container in open_) and all(s in open_ for s in inside) and not any(s in open_ for s in outside):
            return k
    return None


class _Walk:
    """Where the walk stands: open elements below the block, and how far each rule's places have been read."""

    def __init__(self, open_: tuple[str, ...] = (), read: tuple[tuple[int, int], ...] = ()):
        self.open, self.read, self.regular = list(open_), dict(read), True

    def start(self, name: str, empty: bool) -> int | None:
        """The rule of a starting element; notes whether it stands at a place of its rule."""
        open_ = tuple(self.open)
        k = rule_of(name, open_)
        if name in (LOT, RESULT):
            self.regular &= not open_
            for r, rule in enumerate(RULES):
                if rule[0] == name:
                    self.read.pop(r, None)
        if k is not None:
            container = RULES[k][0]
            below = open_[open_.index(container) + 1 :] if container else open_
            place = (*below, name)
            if container and open_[0] != container or place not in _PLACES[k]:
                self.regular = False
            else:
                at = _PLACES[k].index(place)
                self.regular &= at >= self.read.get(k, 0)
                self.read[k] = at
        if not empty:
            self.open.append(name)
        return k

    def end(self, name: str) -> bool:
        return bool(self.open) and self.open.pop() == name


#: Runs of tags walked before, by what was open and read before them.
_KNOWN: dict[tuple, tuple | None] = {}
_MOST_KNOWN = 20_000


def _after(open_: tuple[str, ...], read: tuple[tuple[int, int], ...], chunk: str) -> tuple[tuple, tuple, bool] | None:
    """(open elements, places read, whether regular) behind a run of tags; null for tags that do not match."""
    key = open_, read, chunk
    if key not in _KNOWN:
        if len(_KNOWN) >= _MOST_KNOWN:
            _KNOWN.clear()
        _KNOWN[key] = _walked(*key)
    return _KNOWN[key]


def _walked(open_: tuple[str, ...], read: tuple[tuple[int, int], ...], chunk: str) -> tuple[tuple, tuple, bool] | None:
    walk = _Walk(open_, read)
    for tag in _TAGS.findall(chunk):
        name = tag.split(None, 1)[0].rstrip("/") if tag.strip() else ""
        if name.startswith("/"):
            if not walk.end(name[1:].rpartition(":")[2]):
                return None
        elif not name:
            return None
        else:
            walk.start(name.rpartition(":")[2], tag.endswith("/"))
    return tuple(walk.open), tuple(sorted((k, at) for k, at in walk.read.items() if at)), walk.regular


def _chunks(tags: str) -> list[str]:
    """The tags' runs, each up to the next lot or result."""
    joined = [tags]
    for name in (LOT, RESULT):
        end = joined[-1].find(name)
        if end >= 0:
            # the start tag as it is first written; another way of writing it only makes longer runs
            tag = joined[-1][joined[-1].rfind("<", 0, end) : end] + name + ">"
            first, *rest = joined.pop().split(tag)
            joined += [first, *(tag + r for r in rest)]
    return joined


def is_regular(inner: str) -> bool:
    """Whether the text inside a block needs no rewriting (or is no XML, which the parse will tell)."""
    state: tuple[tuple, tuple] = ((), ())
    if "<!" not in inner and "<?" not in inner:
        for chunk in _chunks(_TEXT.sub(">", inner)):
            after = _after(*state, chunk)
            if after is None:
                break
            if not after[2]:
                return False
            state = after[:2]
        else:
            if not state[0]:
                return True
    # sections, or ">" in an attribute: tag by tag
    walk = _Walk()
    for m in _TOKENS.finditer(inner):
        slash, name, _, empty = m.groups()
        if name is not None:
            if not slash:
                walk.start(name, bool(empty))
            elif not walk.end(name):
                return True
    return walk.regular


def _blocks(entry: str) -> list[tuple[int, int]]:
    """Where the insides of an entry's contract blocks start and end."""
    out, at = [], 0
    while (found := entry.find(BLOCK, at)) >= 0:
        at = found + len(BLOCK)
        m = _START.search(entry, max(0, found - 64), found)
        if m is None or entry[at : at + 1] not in (">", " ", "\n", "\t", "\r"):
            continue
        close = f"</{m[1]}{BLOCK}"
        end = entry.find(close, at)
        while end >= 0 and entry[end + len(close) : end + len(close) + 1] not in (">", " ", "\n", "\t", "\r"):
            end = entry.find(close, end + 1)
        start = entry.find(">", at) + 1
        if end >= start > 0 and entry[start - 2] != "/":
            out.append((start, end))
            at = end + len(close)
    return out


def _wrapped(leaves: dict[int, list[str]], container: str) -> str:
    """Leaves by rule -> elements below their container, each column's at the first of its places."""
    out = []
    for k, texts in leaves.items():
        path = _PLACES[k][0][:-1]
        out.append("".join(f"<{p}>" for p in path) + "".join(texts) + "".join(f"</{p}>" for p in reversed(path)))
    text = "".join(out)
    return f"<{container}>{text}</{container}>" if container else text


def rewritten(inner: str) -> str | None:
    """The text inside a block with all leaves that count at their first places; null if its tags do not match."""
    walk = _Walk()
    groups: list[tuple[str, dict[int, list[str]]]] = [("", {})]   # the block's own leaves, then lots and results in order
    current = {LOT: None, RESULT: None}
    leaf = None    # (rule, name, attributes, end of the start tag, depth) of the leaf being read
    for m in _TOKENS.finditer(inner):
        slash, name, attributes, empty = m.groups()
        if name is None:
            continue
        if slash:
            if not walk.end(name):
                return None
            if leaf and len(walk.open) == leaf[4]:
                k, own, attributes, at, _ = leaf
                _add(groups, current, k, f"<{own}{attributes}>{inner[at : m.start()]}</{own}>")
                leaf = None
            continue
        if name in (LOT, RESULT):
            current[name] = len(groups)
            groups.append((name, {}))
        k = walk.start(name, bool(empty))
        if k is None or leaf or (RULES[k][:2] == (LOT, "ID") and not LOT_ID.search(attributes)):
            continue
        if empty:
            _add(groups, current, k, f"<{name}{attributes}/>")
        else:
            leaf = (k, name, attributes, m.end(), len(walk.open) - 1)
    return None if walk.open else "".join(_wrapped(leaves, container) for container, leaves in groups)


_TAG = re.compile(r"(<[^>]*>)")
#: Stands for the k-th text between tags; no XML holds these characters.
_MARK, _MARKED = "\x01{}\x02", re.compile("\x01([0-9]+)\x02")
#: By the tags inside a block, what its rewriting is made of: constant texts and, between them, numbers of texts.
_PLANS: dict[str, tuple[list[str], list[int]] | None] = {}
_MOST_PLANS = 2_000


def _plan(tags: list[str]) -> tuple[list[str], list[int]] | None:
    """The rewriting of a block with these tags, which no text between them changes; null if texts are needed to tell them."""
    if any("\x01" in tag or "\x02" in tag or not _TOKENS.fullmatch(tag) for tag in tags):
        return None
    marked = [_MARK.format(0)]
    for k, tag in enumerate(tags, 1):
        marked += [tag, _MARK.format(k)]
    text = rewritten("".join(marked))
    if text is None:
        return None
    parts = _MARKED.split(text)
    return parts[0::2], [int(k) for k in parts[1::2]]


def rewritten_alike(inner: str) -> str | None:
    """``rewritten``, looked up for blocks whose tags were met before."""
    if "<!" in inner or "<?" in inner:
        return rewritten(inner)
    parts = _TAG.split(inner)
    tags = parts[1::2]
    key = "".join(tags)
    if key not in _PLANS:
        if len(_PLANS) >= _MOST_PLANS:
            _PLANS.clear()
        _PLANS[key] = _plan(tags)
    plan = _PLANS[key]
    if plan is None:
        return rewritten(inner)
    constants, texts = plan
    out = [constants[0]]
    for k, constant in zip(texts, constants[1:]):
        out += [parts[2 * k], constant]
    return "".join(out)


def _add(groups: list, current: dict, k: int, text: str) -> None:
    at = current[RULES[k][0]] if RULES[k][0] else 0
    groups[at][1].setdefault(k, []).append(text)


def canonical(entry: str) -> str | None:
    """The entry with its irregular blocks rewritten; null if there are none."""
    out, at = [], 0
    for start, end in _blocks(entry):
        inner = entry[start:end]
        if not is_regular(inner) and (new := rewritten_alike(inner)) is not None:
            out += [entry[at:start], new]
            at = end
    return "".join([*out, entry[at:]]) if out else None
