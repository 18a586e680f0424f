"""One answer from all scans: prefixes, sections, encodings, and entries that reach over the borders of splits."""

import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.entries import to_entries
from tenderlake.sources import entry_cut
from tenderlake.sources.archives import read_archive_entries
from tenderlake.sources.xml_feed import malformed, parse_entries, read_entries_strict, read_entry_texts

HEAD = '<?xml version="1.0" encoding="{}"?>\n<feed xmlns="http://www.w3.org/2005/Atom" xmlns:b="urn:b"><title>f</title>'


def plain_cut(text):
    """Entries by reading a document one character at a time."""
    out, at, start, prefix = [], 0, None, None
    while at < len(text):
        for opener, closer in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>")):
            if text.startswith(opener, at):
                end = text.find(closer, at + len(opener))
                at = len(text) if end < 0 else end + len(closer)
                break
        else:
            if text[at] == "<":
                name = text[at + 1 :].split(">")[0].split(" ")[0]
                slash, name = name.startswith("/"), name.strip("/")
                own = name.rpartition(":")
                if own[2] == "entry" and ">" in text[at:] and (start is None or own[0] == prefix):
                    end = text.index(">", at) + 1
                    if slash:
                        out.append(text[at if start is None else start : end])
                        start = None
                    else:
                        if start is not None:
                            out.append(text[start:at])
                        start, prefix = at, own[0]
                        if text[end - 2] == "/":
                            out.append(text[at:end])
                            start = None
                    at = end
                    continue
            at += 1
    return out + ([text[start:]] if start is not None else [])


BITS = ["<entry>", "</entry>", '<entry a="1">', "<b:entry>", "</b:entry>", "<entry/>", "</entry >", "<id>1</id>", "<!-- ", " -->", "<!--<entry>-->", "<![CDATA[", "]]>",
        "<?p ", "?>", "text entry>", "é", "<entryx>", "</noentry>", " ", "\n", "<my:other>entry</my:other>"]


def test_cutter_equals_reading_one_character_at_a_time():
    rnd = random.Random(1)
    for _ in range(4000):
        text = "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 25)))
        data = text.encode()
        for size in (1, 7, 1000):
            got = list(entry_cut.cut_file(iter([data[i : i + size] for i in range(0, len(data), size)])))
            assert got == plain_cut(text), (size, text)


def test_modes_compose():
    rnd = random.Random(2)
    for _ in range(500):
        parts = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 6))).encode() for _ in range(4)]
        for mode in range(4):
            at = mode
            for part in parts:
                at = entry_cut.mode_after(at, part + b"entry>")
            assert at == entry_cut.mode_after(mode, b"".join(p + b"entry>" for p in parts))


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def scans(spark, root, name, data, mode="FAILFAST"):
    """The parsed entries of one file by the text, the strict and the archive scan."""
    write(f"{root}/in/202301/{name}.xml", data)
    os.makedirs(f"{root}/zip", exist_ok=True)
    with zipfile.ZipFile(f"{root}/zip/202301.zip", "w") as zf:
        zf.writestr("a.xml", data)
    return [parse_entries(read_entry_texts(spark, f"{root}/in"), mode=mode), read_entries_strict(spark, f"{root}/in", mode=mode),
            parse_entries(read_archive_entries(spark, f"{root}/zip"), mode=mode)]


def ids(parsed):
    return sorted((r.id or "", r.title or "") for r in to_entries(parsed).select("id", "title").collect())


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1", "windows-1252", "ISO-8859-15", "UTF-16", "utf-8-sig"])
def test_encodings(spark, tmp_root, encoding):
    title = "año" if encoding == "ISO-8859-1" else "año €"
    declared = "UTF-8" if encoding == "utf-8-sig" else encoding
    data = (HEAD.format(declared) + f"<entry><id>1</id><title>{title}</title></entry><b:entry><b:id>2</b:id></b:entry></feed>").encode(encoding)
    for parsed in scans(spark, tmp_root, "a", data):
        assert ids(parsed) == [("1", title), ("2", "")]


def test_tags_in_sections_are_text(spark, tmp_root):
    body = ("<!-- <entry><id>no</id></entry> --><entry><id>1</id><!-- </entry> --><title><![CDATA[</entry><entry>]]></title></entry>"
            "<?x <entry> ?><entry><id>2</id><b:entry><b:id>no</b:id></b:entry></entry >")
    for parsed in scans(spark, tmp_root, "a", (HEAD.format("UTF-8") + body + "</feed>").encode()):
        assert ids(parsed) == [("1", "</entry><entry>"), ("2", "")]


def test_wrong_bytes_are_malformed_and_unknown_encodings_raise(spark, tmp_root):
    data = HEAD.format("UTF-8").encode() + b"<entry><id>1</id></entry><entry><id>2</id><title>a\xf1o</title></entry></feed>"
    text, _, archive = scans(spark, tmp_root, "a", data, "PERMISSIVE")
    for parsed in (text, archive):
        assert parsed.where(malformed(F.col("e"))).count() == 1 and parsed.where(~malformed(F.col("e"))).count() == 1
    for parsed in scans(spark, tmp_root, "a", data):
        with pytest.raises(Exception):
            parsed.collect()
    for k in (0, 2):
        with pytest.raises(Exception, match="unknown encoding"):
            scans(spark, f"{tmp_root}/x", "a", HEAD.format("no-such").encode() + b"<entry><id>1</id></entry></feed>")[k].collect()


def test_strict_permissive_counts_malformed(spark, tmp_root):
    data = (HEAD.format("UTF-8") + "<entry><id>1</id></entry><entry><id>2</title></entry></feed>").encode()
    strict = scans(spark, tmp_root, "a", data, "PERMISSIVE")[1]
    assert strict.where(malformed(F.col("e"))).count() == 1


@pytest.mark.parametrize("encoding", ["ISO-8859-1"])
def test_entries_over_the_borders_of_splits(spark, tmp_root, encoding):
    rnd = random.Random(5)
    want, parts = [], []
    for k in range(60):
        form = rnd.randrange(6)
        body = f"<id>{k}</id><title>ñ{'x' * rnd.randrange(120)}</title>"
        if form == 0:
            parts.append(f"<entry>{body}</entry>")
        elif form == 1:
            parts.append(f'<b:entry q="1">{body}</b:entry>')
        elif form == 2:
            parts.append(f"<entry>{body}<!-- {'<entry>no</entry> ' * rnd.randrange(40)}--></entry>")
        elif form == 3:
            parts.append(f"<!-- {'<entry><id>no</id></entry> ' * rnd.randrange(40)} --><entry>{body}</entry>\n")
        elif form == 4:
            parts.append(f"<entry>{body}<summary><![CDATA[{'</entry><entry>' * rnd.randrange(60)}]]></summary></entry>")
        else:
            parts.append(f"<entry>{body}<summary>{'long ' * 300}</summary></entry>")
        if k == 30:
            parts.append("<!-- " + "no entry here " * 1200 + "-->")   # several splits without a tag
        want.append(str(k))
    data = (HEAD.format(encoding) + "".join(parts) + "</feed>").encode(encoding)
    write(f"{tmp_root}/in/202301/a.xml", data)
    write(f"{tmp_root}/in/202301/b.xml", (HEAD.format("UTF-8") + "<entry><id>small</id></entry></feed>").encode())
    # a file cut off in its last entry
    write(f"{tmp_root}/cut/202301/a.xml", data[: data.rindex(b"</entry>") - 3])
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        # the last: splits of a size that follows from all files and the number of cores
        for size in ("900", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            texts = read_entry_texts(spark, f"{tmp_root}/in")
            assert texts.rdd.getNumPartitions() > 8
            rows = to_entries(parse_entries(texts)).collect()
            assert sorted(r.id for r in rows) == sorted([*want, "small"])
            assert all(r.title.startswith("ñ") for r in rows if r.id != "small")
            cut = parse_entries(read_entry_texts(spark, f"{tmp_root}/cut"), mode="PERMISSIVE")
            assert cut.where(malformed(F.col("e"))).count() == 1 and cut.count() == 60
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_section_ahead_of_the_entries_does_not_slow_the_cut():
    from tenderlake.sources import entry_cut

    head, entry, tail = b'<?xml version="1.0"?><feed><!-- <entry> -->', b"<p:entry>" + b"<a>b</a>" * 20 + b"</p:entry>", b"<!-- <p:entry> --></feed>"
    data = head + entry * 50
    looks = []

    class Counted(entry_cut.EntryCutter):
        def _token(self, buffer, at, sections):
            looks.append(bool(sections))
            return super()._token(buffer, at, sections)

    cutter = Counted()
    found = [text for part in (data, b"", tail) for _, text in cutter.feed(part)]
    assert found == [entry] * 50 and sum(looks[:90]) <= 4   # tag by tag up to the head's comment only
    assert [t for _, t in entry_cut.EntryCutter().feed(data + tail + entry, True)] == [entry] * 51


def test_strict_scan_of_some_columns(spark, tmp_root):
    import os

    from pyspark.sql import functions as F

    from tenderlake.operators.entries import to_entries
    from tenderlake.sources.xml_feed import read_entries_strict

    os.makedirs(f"{tmp_root}/cols/202301")
    with open(f"{tmp_root}/cols/202301/a.xml", "w") as f:
        f.write("<feed><entry><id>1</id><p:ContractFolderStatus xmlns:p='p'><p:ContractFolderID>7</p:ContractFolderID><p:ProcurementProjectLot/></p:ContractFolderStatus></entry></feed>")
    for mode in ("FAILFAST", "PERMISSIVE"):
        parsed = read_entries_strict(spark, f"{tmp_root}/cols", mode=mode, columns=["project_lots"])
        e = to_entries(parsed, columns=["project_lots"])
        assert e.columns[5:] == ["project_lots"] and [(r.id, r.n) for r in e.select("id", F.size("project_lots").alias("n")).collect()] == [("1", 1)]
