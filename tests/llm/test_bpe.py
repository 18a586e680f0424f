import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tenderlake.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts():
    rnd = random.Random(7)
    bits = ["the ", "don't ", "  ", "\n\n", "\t", "é", "ß", "日本語", "🙂", "123", "'s", "<|endoftext|>", "<|", " ", " ", "!!", "x", "Word", "\x0b", "　"]
    out = [None, "", " ", "a", "\n", "<|endoftext|>", "a<|endoftext|> b", "a" * 9000, " " * 9000, "ab " * 6000, "é" * 5000, "'" * 300]
    out += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 1500))) for _ in range(60)]
    shared = "".join(rnd.choice(bits[:9]) for _ in range(3000))
    return out + [shared, "q" + shared, shared[5:], shared + shared, shared]


def test_ids_equal_the_reference(reference, monkeypatch):
    encode = bpe.plain_encoder(RANKS)
    for bits in (9, 4):  # many joins as well
        monkeypatch.setattr(bpe, "AVERAGE_BITS", bits)
        recent = {}
        for text in texts():
            got = bpe.encode_text(text, encode, {}, recent).tolist()
            assert got == reference.encode(text or "", add_special_tokens=False).ids


def prose(kind, n, seed=11):
    """Invented prose without ASCII punctuation, or without blanks."""
    rnd = random.Random(seed)
    if kind == "russian":
        return " ".join("".join(rnd.choice("абвгдежзиклмнопрст") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    return "".join("".join(chr(rnd.randrange(0x5000, 0x8FFF)) for _ in range(rnd.randint(4, 20))) + rnd.choice("。，！") for _ in range(n))


@pytest.mark.parametrize("kind", ["russian", "chinese"])
def test_chunks_are_shared_in_any_script(reference, kind):
    encode, body = bpe.plain_encoder(RANKS), prose(kind, 4000)
    cores = list(bpe._cores(body))
    again = set(bpe._cores("other start " + body))
    assert sum(map(len, cores)) > 0.8 * len(body.encode()) and len(set(cores) & again) > 0.9 * len(set(cores))
    for text in (body, " " + body[3:], body[::-1], "\u3000".join(body[i : i + 40] for i in range(0, 8000, 40)), "\u00a0 ".join(body[:3000].split(" "))):
        assert bpe.encode_text(text, encode, {}, {}).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_text_without_sync_points_takes_time_by_its_length():
    import time

    encode = lambda data: [len(data)]
    took = []
    for n in (500_000, 2_000_000):
        start = time.process_time()
        assert bpe.encode_text("語" * n, encode, {}, {}).tolist() == [3 * n]
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0]


def test_chunks_follow_the_content():
    rnd = random.Random(1)
    body = "".join(rnd.choice("abcdefgh \n") for _ in range(30_000)).encode()
    a, b = bpe.chunks(body), bpe.chunks(b"some other start " + body)
    assert b"".join(a) == body and max(map(len, a)) <= bpe.LONGEST
    assert len(set(a) & set(b)) >= len(a) - 2


def test_query(spark, reference):
    from tenderlake.llm.queries import queries

    query = next(f for n, f in queries().items() if n.startswith("op7_"))
    rows = query(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode(docs[r.doc_id], add_special_tokens=False).ids
        back = reference.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
        )


def test_shared_chunks_and_odd_rows(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "the same passage " * 400, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    assert bpe.shared_chunks(spark, docs, RANKS).count() > 0
    got = bpe.encode(spark, docs, RANKS, "got", "back", most=10).collect()
    for r in got:
        assert r.got == reference.encode(r.text or "", add_special_tokens=False).ids
        assert r.back == (r.text or "")
    empty = docs.limit(0)
    assert bpe.encode(spark, empty, RANKS, "got").count() == 0
