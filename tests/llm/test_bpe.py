import hashlib
import random
import struct
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tonality.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return B.load(PATH)


def samples():
    r = random.Random(3)
    out = ["", " ", "\n\n  x", "Hello world, it's 2024!", "a<|endoftext|>b <|endoftext|>", "  <|endoftext|>  ", "don't 'RE 's",
           "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキスト 🎉🎉", "\x00\x1c\x1f\x85  　x", "�", "a\r\n\tb   c"]
    for _ in range(300):
        out.append("".join(r.choice(["a", "b", "the", "ing", " ", "  ", "\n", "é", "ß", "1", "23", ".", "!!", "'s", "🎉", "http", "=", "-", "日"]) for _ in range(r.randint(1, 40))))
    return out


def test_encodes_and_decodes_like_the_library(lib, own):
    for t in samples():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids, t
        out = B.ByteText(own.bytes)
        assert "".join(out.feed([i]) for i in ids) + out.end() == lib.decode(ids, skip_special_tokens=False)


def test_stretches_give_the_same_tokens(lib, own, monkeypatch):
    monkeypatch.setattr(B, "STRETCH", 3)
    for t in samples():
        assert own.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_every_character_splits_like_the_library(lib, own):
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    step = 500
    bad = []
    for i in range(0, len(chars), step * 40):  # one block of 500 in each 20,000, and all of the first plane's low part
        t = "a" .join(chars[i:i + step]) + " 1"
        if own.encode(t).tolist() != lib.encode(t, add_special_tokens=False).ids:
            bad.append(hex(i))
    t = " x".join(chars[:9000])
    assert own.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids
    assert not bad


@pytest.mark.parametrize("unit", ["a", "ab", "xyzzy", "=", "the", "ssss", "lo"])
def test_long_words_stream(lib, own, unit):
    r = random.Random(unit)
    t = "".join(r.choice([unit, unit, "q", "e"]) if unit.isalpha() else unit for _ in range(2500))
    assert own.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids
    first = next(own.word(t.encode()))
    assert first == lib.encode(t, add_special_tokens=False).ids[0]
    assert 0 < own.lookahead < 10_000_000


def test_broken_bytes_decode_like_the_library(lib, own):
    r = random.Random(9)
    for _ in range(300):
        ids = [r.randrange(256) if r.random() < 0.7 else r.randrange(50257) for _ in range(r.randint(1, 30))]
        out = B.ByteText(own.bytes)
        assert "".join(out.feed([i]) for i in ids) + out.end() == lib.decode(ids, skip_special_tokens=False)


def test_query_columns_and_defined_cases(spark, lib, monkeypatch):
    monkeypatch.setattr(B, "CACHE", 3)
    texts = [None, "", "Hello  world", "Hello  world", "x" * 3000, "<|endoftext|>"]
    df = spark.createDataFrame([(i if i else None, t, "ids", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")
    got = {r.doc_id: r for r in B.digests(df, PATH).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        r = got[i if i else None]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in B.decode(B.encode(df, PATH), PATH).collect()}
    assert all(back[i if i else None] == (t or "") for i, t in enumerate(texts))
    assert B.digests(df.limit(0), PATH).collect() == []


def test_short_words_walk_to_the_same_tokens(lib, own):
    r = random.Random(5)
    some = [b for b in own.ids if len(b) < 12]
    for _ in range(4000):
        w = b"".join(r.choice(some) for _ in range(r.randint(1, 9))) if r.random() < 0.6 else r.randbytes(r.randint(1, B.SHORT)) if r.random() < 0.5 else bytes(r.choice(b"aeinrst") for _ in range(r.randint(1, B.SHORT)))
        assert own.short(w) == list(own.word(w)), w
    for _ in range(2000):
        t = " " + "".join(r.choice(["a", "b", "th", "ing", "s", "é", "ß", "er", "qu", "日", "ci", "ón"]) for _ in range(r.randint(1, 16)))
        assert own.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_caches_stay_small_over_many_words(own):
    own.forget()
    r = random.Random(6)
    for _ in range(450_000):
        own._packed(" " + "".join(r.choices("aeinrstéoucdlm", k=9)))
    held = 0
    for cache in (own._young, own._old, own._stable, own._tails, own._heads):
        held += sys.getsizeof(cache) + sum(sys.getsizeof(k) + (0 if isinstance(v, bool) else sys.getsizeof(v)) for k, v in cache.items())
    own.forget()
    assert held < 60e6, held
    assert not (own._young or own._old or own._stable or own._tails or own._heads)


def test_what_pairs_and_edges_remember_is_bounded(lib, own, monkeypatch):
    monkeypatch.setattr(B, "PAIRS", 50)
    monkeypatch.setattr(B, "EDGES", 20)
    own.forget()
    for t in samples():
        assert own.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, t
        assert len(own._stable) <= 50 and len(own._tails) <= 20 and len(own._heads) <= 20
    own.forget()
