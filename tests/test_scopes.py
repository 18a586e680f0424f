"""Leaves at any depth and in document order: the rewriting against a reading by event stream."""

import random
import xml.sax
from io import StringIO

from helpers import entries_of, one

from tenderlake.sources import scopes

FEED = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:p="urn:p" xmlns:c="urn:c">{}</feed>'


class Stream(xml.sax.ContentHandler):
    """(container and its number, rule, text) of every leaf that counts, as a parser meets them."""

    def __init__(self):
        super().__init__()
        self.open, self.found, self.leaf, self.numbers = [], [], None, {scopes.LOT: 0, scopes.RESULT: 0}

    def startElement(self, name, attrs):
        name = name.split(":")[-1]
        inside = tuple(self.open[1:])
        if name in self.numbers and self.open:
            self.numbers[name] += 1
        k = scopes.rule_of(name, inside) if self.open else None
        if k is not None and self.leaf is None and not (scopes.RULES[k][:2] == (scopes.LOT, "ID") and attrs.get("schemeName") != "ID_LOTE"):
            self.leaf = [k, len(self.open), ""]
        self.open.append(name)

    def characters(self, text):
        if self.leaf:
            self.leaf[2] += text

    def endElement(self, name):
        self.open.pop()
        if self.leaf and len(self.open) == self.leaf[1]:
            k, _, text = self.leaf
            container = scopes.RULES[k][0]
            self.found.append((container, self.numbers.get(container, 0), k, text))
            self.leaf = None


def leaves(inner):
    stream = Stream()
    xml.sax.parse(StringIO(f"<B>{inner}</B>"), stream)
    return sorted(stream.found, key=lambda x: x[:3])   # stable: document order within a column


def random_block(rnd):
    names = sorted({r[1] for r in scopes.RULES} | {s for r in scopes.RULES for s in (*r[2], *r[3], r[0]) if s})
    wrappers = ["Wrap", "Address", "RealizedLocation", "AwardedTenderedProject", *[n for n in names if n not in scopes._BY_LEAF]]

    def element(depth):
        if depth > 5 or rnd.random() < 0.3:
            leaf = rnd.choice(list(scopes._BY_LEAF))
            scheme = rnd.choice(["", " schemeName='ID_LOTE'", ' schemeName="X"']) if leaf == "ID" else ""
            return f"<c:{leaf}{scheme}>{rnd.randrange(99)}</c:{leaf}>" if rnd.random() < 0.9 else f"<c:{leaf}{scheme}/>"
        wrapper = rnd.choice(wrappers)
        return f"<p:{wrapper}>" + "".join(element(depth + 1) for _ in range(rnd.randrange(4))) + f"</p:{wrapper}>"

    return "".join(element(0) for _ in range(rnd.randrange(8)))


def test_rewriting_keeps_every_leaf_that_counts_in_order():
    rnd = random.Random(3)
    changed = 0
    for _ in range(3000):
        inner = random_block(rnd)
        # a lot inside a lot has no defined owner of what follows it
        if f"p:{scopes.LOT}" in inner and any(inner.count(f"<p:{c}>") > 1 and _nested(inner, c) for c in (scopes.LOT, scopes.RESULT)):
            continue
        if scopes.is_regular(inner):
            continue
        new = scopes.rewritten(inner)
        assert scopes.is_regular(new) and scopes.rewritten(new) == new
        assert leaves(new) == leaves(inner)
        changed += 1
    assert changed > 500


def _nested(inner, name):
    depth = most = 0
    for part in inner.split("<")[1:]:
        depth += part.startswith(f"p:{name}>") - part.startswith(f"/p:{name}>")
        most = max(most, depth)
    return most > 1


def test_regular_blocks_stay():
    assert scopes.is_regular("<c:ContractFolderID>1</c:ContractFolderID><p:ProcurementProject><c:Name>x</c:Name><p:Unknown><c:Note/></p:Unknown></p:ProcurementProject>")
    assert scopes.is_regular("<!-- <p:W><c:TypeCode>1</c:TypeCode></p:W> --><p:ProcurementProject><c:TypeCode>2</c:TypeCode></p:ProcurementProject>")
    assert scopes.is_regular("<a><b></a>") and scopes.rewritten("<a><b></a>") is None
    assert scopes.canonical("<entry><id>1</id></entry>") is None


def test_any_depth_through_the_parse(spark):
    block = ("<p:ContractFolderStatus><p:X><c:ContractFolderID>7</c:ContractFolderID></p:X><p:ProcurementProject><p:W><c:TypeCode listURI='u'>7</c:TypeCode></p:W>"
             "<c:TypeCode>8</c:TypeCode><p:Country><c:IdentificationCode>ES</c:IdentificationCode><c:Name>no</c:Name></p:Country></p:ProcurementProject>"
             "<p:ProcurementProjectLot><p:ProcurementProject><p:RequiredCommodityClassification><c:ItemClassificationCode>IN</c:ItemClassificationCode>"
             "</p:RequiredCommodityClassification></p:ProcurementProject><p:RequiredCommodityClassification><c:ItemClassificationCode>OUT</c:ItemClassificationCode>"
             "</p:RequiredCommodityClassification><p:Q><c:ID schemeName='ID_LOTE'>4</c:ID></p:Q></p:ProcurementProjectLot>"
             "<p:TenderResult><p:AwardedTenderedProject><p:Deep><c:ProcurementProjectLotID>IN</c:ProcurementProjectLotID></p:Deep></p:AwardedTenderedProject>"
             "<c:ProcurementProjectLotID>OUT</c:ProcurementProjectLotID></p:TenderResult></p:ContractFolderStatus>")
    row = one(spark, FEED.format(f"<entry><id>1</id>{block}</entry>"), keep_raw_xml=True)
    assert (row.contract_id, row.project.type_code, row.project.type_code_list_uri, row.project.country_code, row.project.name) == ("7", "7_8", "u", "ES", None)
    assert [(lot.id, lot.cpv_code) for lot in row.project_lots] == [("4", "IN_OUT")]
    assert [t.result_lot_id for t in row.tender_results] == ["IN", "OUT"]
    assert row.cfs_raw_xml == block
    two = FEED.format(f"<entry><id>1</id>{block}<p:ContractFolderStatus><c:ContractFolderID>last</c:ContractFolderID></p:ContractFolderStatus></entry>")
    assert [r.contract_id for r in entries_of(spark, two).collect()] == ["last"]


def test_blocks_with_the_same_tags_are_rewritten_alike():
    from tenderlake.sources import scopes

    block = "<a><c:ContractFolderID>{}</c:ContractFolderID></a><p:ProcurementProject><x><c:Name>{}</c:Name></x></p:ProcurementProject>{}"
    texts = [("1", "a", ""), ("2", "", " "), ("3", "x > y &amp; \n", ""), ("<i/>4", "b", ""), ("5", '<b t="1>2">c</b>', ""), ("6", "<![CDATA[<c>]]>", ""),
             ("7", "open <", ""), ("8", "\x01", "\x02"), ("9", "<b t='\x010\x02'>c</b>", "")]
    scopes._PLANS.clear()
    for text in texts * 2:
        inner = block.format(*text)
        assert scopes.rewritten_alike(inner) == scopes.rewritten(inner)
    walked = []
    own, scopes.rewritten = scopes.rewritten, lambda inner: walked.append(inner) or own(inner)
    try:
        for k in range(20):
            inner = block.format(k, "name", "")
            entry = f"<entry><p:ContractFolderStatus>{inner}</p:ContractFolderStatus></entry>"
            assert scopes.canonical(entry) == f"<entry><p:ContractFolderStatus>{own(inner)}</p:ContractFolderStatus></entry>"
    finally:
        scopes.rewritten = own
    assert len(walked) <= 1
