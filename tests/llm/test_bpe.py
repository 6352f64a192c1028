import base64
import hashlib
import random

import pytest
import tiktoken

import public_tokenizers
from telvault.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))


@pytest.fixture(scope="module")
def theirs(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.bpe.ranks, special_tokens={})


PARTS = ["a", "b", "the", " ", "  ", "\n", "é", "ñ", "漢", "😀", "'s", "'", "0", "12", ".", "...", "\x1c", "\xa0", "　", "ing", "é", "aaa", "࢏", "<|endoftext|>"]


def test_encodes_as_tiktoken_does(codec, theirs, texts):
    rng = random.Random(1)
    cases = [t for t in texts if t is not None] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    cases += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0xD7FF), rng.randint(0x10000, 0x3FFFF)])) for _ in range(40)) for _ in range(500)]
    cases += ["".join(rng.choice("aeinrst") for _ in range(rng.randint(50, 400))) for _ in range(50)]
    for text in cases:
        ids = codec.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_another_vocabulary(texts):
    content = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Codec(content)
    assert all(own.encode(t) == theirs.encode_ordinary(t) for t in texts if t)


def test_appended_bytes_only_add_entries(codec):
    data, last = b"unbelievabilitiesandsoon" * 3, [-1]
    for cut in (5, 17, len(data)):
        before = list(last)
        codec.bpe.extend(data[:cut], last)
        assert last[:len(before)] == before
    assert codec.bpe.walk(last) == codec.bpe.encode(data)


def test_edits(codec, theirs):
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        a = rng.randint(0, len(text))
        b = rng.randint(a, len(text))
        changed, ids = codec.edit(text, codec.encode(text), a, b, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4))))
        assert ids == theirs.encode_ordinary(changed)


def test_a_text_through_many_edits(codec, theirs):
    rng = random.Random(6)
    held = bpe.Encoded(codec, "")
    for k in range(2500):
        n = len(held.text)
        a = rng.choice([n, 0, rng.randint(0, n)])
        b = min(n, a + rng.choice([0, 0, 1, 3, n // 2 if k % 50 == 0 else 0]))
        new = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 6))) + rng.choice(["", "", "x" * 100, "\u088f", " \n "])
        text = held.text[:a] + new + held.text[b:]
        held.edit(a, b, new)
        assert held.text == text and held.ids == theirs.encode_ordinary(text)
        assert held.offsets[-1] == len(held.ids) and len(held.offsets) == len(held.starts) + 1


def test_an_edit_does_not_encode_what_is_before_or_after(codec, theirs, monkeypatch):
    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(20_000))
    held, asked = bpe.Encoded(codec, text), []
    real = held.ids_of
    monkeypatch.setattr(held, "ids_of", lambda match: asked.append(match) or real(match))
    for at in (0, len(text) // 2, len(text)):
        asked.clear()
        held.edit(at, at, "new word")
        assert held.ids == theirs.encode_ordinary(held.text) and len(asked) <= 5
    one = bpe.Encoded(codec, "z" + "".join(rng.choice("abcdefg") for _ in range(20_000)))
    entries = []
    extend = codec.bpe.extend
    monkeypatch.setattr(codec.bpe, "extend", lambda data, last: entries.append(len(data) + 1 - len(last)) or extend(data, last))
    for at in (20_001, 20_002, 19_990):
        one.edit(at, at, "h")
        assert one.ids == theirs.encode_ordinary(one.text)
    assert entries == [1, 1, 14]


def test_caches_that_overflow(theirs, codec, monkeypatch, texts):
    monkeypatch.setattr(bpe, "CACHED", 50)
    monkeypatch.setattr(bpe, "SEAMS", 50)
    small = bpe.Codec(bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))
    for _ in range(2):
        for k in range(0, len(texts), 9):
            found = small.entries_of(texts[k:k + 9])
            assert [[i for e in x for i in e[0]] for x in found] == [theirs.encode_ordinary(t or "") for t in texts[k:k + 9]]


def want(theirs, text):
    ids = theirs.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_messy_rows(spark, messy, empty, theirs):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(messy, "doc_id", "text").collect())
    assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, *want(theirs, r["text"])) for r in messy.collect())
    back = bpe.decode(bpe.encode(messy, "doc_id", "text"), "doc_id")
    assert sorted(bytes(r["data"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in messy.collect())
    full = bpe.tokens(messy, "doc_id", "text").collect()
    assert sorted(map(tuple, (r["ids"] for r in full))) == sorted(tuple(theirs.encode_ordinary(r["text"] or "")) for r in messy.collect())
    assert bpe.digests(empty, "doc_id", "text").count() == 0


def test_query_against_tiktoken(spark, theirs):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op2_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(tuple(r)[1:] == want(theirs, docs[r["doc_id"]]) for r in rows)
