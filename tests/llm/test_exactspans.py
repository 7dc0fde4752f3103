import hashlib
import random

import numpy as np
import pytest

from tonality.llm import exactspans as E
from tonality.llm.suffixarray import suffix_array


def test_linear_grouping_orders_suffixes():
    r = random.Random(1)
    for _ in range(3000):
        s = [r.randint(1, r.choice([1, 2, 3, 6])) for _ in range(r.randint(0, 14))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    for s in ([1] * 3000, [1, 2] * 1500, list(range(2000, 0, -1))):
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_anchor_is_the_first_smallest_hash_of_its_window(monkeypatch):
    r = random.Random(2)
    monkeypatch.setattr(E, "PIECE", 37)
    for _ in range(60):
        raw = bytes(r.choice(b"ab") if r.random() < 0.8 else r.randrange(256) for _ in range(r.randint(0, 300)))
        h = E.position_hashes(raw).tolist()
        want = {min(range(i, i + 12), key=lambda p: (h[p], p)) for i in range(len(raw) - 40 + 1)}
        assert E.anchors(raw, 40, 12).tolist() == sorted(want)


def brute(texts, size):
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - size + 1):
            w = raw[i:i + size]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if seen[raw[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(raw)))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def texts(r):
    base = ["".join(r.choice("abcdé 日\x00") for _ in range(r.randint(0, 400))) for _ in range(14)]
    out = [None, "", "short", "a" * 700, "ab" * 300, "a" * 120, "x" + "ab" * 60] + base
    for _ in range(40):
        a, b = r.choice(base), r.choice(base)
        t = a[r.randint(0, 60):r.randint(60, 400)] + b[r.randint(0, 200):] + r.choice(["", "q", a[:50]])
        if r.random() < 0.5 and t:
            k = r.randrange(len(t))
            t = t[:k] + "#" + t[k + 1:]
        out.append(t)
    return out + base[:4]


@pytest.mark.parametrize("size,reach,hot,batch", [(40, 12, 20_000, 20_000), (40, 20, 20_000, 5), (64, 9, 2, 50)])
def test_matches_brute_force(spark, size, reach, hot, batch, monkeypatch):
    monkeypatch.setattr(E, "BATCH", batch)
    ts = texts(random.Random(size + reach))
    rows = [(i if i != 9 else None, t, 1, "k") for i, t in enumerate(ts)]
    rows += [rows[20], (21, "another text with the same id " * 3, 1, "k"), (None, ts[9], 1, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, d int, key string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in E.repeated_spans(df, size, reach, hot).collect())
    want = sorted((r[0] is None, r[0], *x) for r, x in zip(rows, brute([r[1] for r in rows], size)))
    assert got == want


def test_repeated_offsets_with_padding():
    keys = np.array([1, 1, 1, 2])
    left = np.array([[5, 0, 0], [5, 0, 0], [5, 0, 7], [5, 0, 0]], dtype=np.uint8)
    right = np.array([[9, 9, 9], [9, 9, 8], [9, 9, 9], [9, 9, 9]], dtype=np.uint8)
    low, high = E.repeated_offsets(keys, left, np.array([3, 1, 3, 3]), right, np.array([3, 3, 3, 3]))
    assert low.tolist() == [0, 1, 0, -1] and high.tolist() == [2, 1, 2, -1]


def test_empty_table(spark):
    assert E.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []
