import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tonality.llm import periodic as P


def brute(w, least=6):
    """Runs by definition: every maximal stretch of every period, the smallest period of each."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def codes(w):
    number = {}
    return [number.setdefault(x, len(number)) for x in w]


def sequences():
    r = random.Random(11)
    out = [[], [1], [1] * 5, [1] * 6, [1] * 7, [1, 2] * 4, [1, 2] * 4 + [1], [1, 2, 3] * 4, [1, 2, 3] * 3 + [1, 2]]
    out += [[1] * n for n in (63, 64, 65, 200)]
    for _ in range(250):
        n, k = r.randint(1, 150), r.choice([1, 2, 3, 8, 60])
        w = [r.randrange(k) for _ in range(n)]
        for _ in range(r.randint(0, 3)):
            q = r.randint(1, 25)
            unit = [r.randrange(k + 3) for _ in range(q)]
            at = r.randrange(len(w) + 1)
            w[at:at] = (unit * r.randint(2, 9))[:-r.randint(1, q) or None]
        out.append(w)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    return out + [fib[-1], fib[-1][::-1]]


def test_runs_equal_brute_force():
    seqs = sequences()
    assert P.find_runs([codes(w) for w in seqs]) == [brute(w) for w in seqs]


def test_long_periods_and_small_transform_calls(monkeypatch):
    r = random.Random(3)
    unit = [r.randrange(10**6) for _ in range(997)]
    w = [r.randrange(10**6) for _ in range(501)] + (unit * 5)[:4 * 997 + 13] + [-1] * 9 + [r.randrange(4) for _ in range(700)]
    want = brute(w)
    assert (501, 4 * 997 + 13, 997) in want
    for cells in (P.CELLS, 16):
        monkeypatch.setattr(P, "CELLS", cells)
        assert P.find_runs([codes(w)]) == [want]


@pytest.mark.parametrize("q", [1, 2, 3, 4, 5, 10, 11, 20, 21, 42, 43])
def test_every_period_at_the_limit(q):
    unit = list(range(q))
    for extra in (-1, 0, 1):
        w = [-5, -6, -7] + (unit * 7)[:max(6, 4 * q) + extra] + [-8]
        assert P.find_runs([codes(w)]) == [brute(w)]


def test_transform_is_a_cyclic_convolution():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, P.PRIME, (16, 3), dtype=np.uint64) for _ in range(2))
    got = P.transform(P.transform(a) * P.transform(b) % np.uint64(P.PRIME), inverse=True)
    for c in range(3):
        for s in range(16):
            assert int(got[s, c]) == sum(int(a[i, c]) * int(b[(s - i) % 16, c]) for i in range(16)) % P.PRIME


def test_same_word_a_hundred_thousand_times_is_one_run():
    assert P.find_runs([np.zeros(100_000, dtype=np.int64), np.arange(50) % 2]) == [[(0, 100_000, 1)], [(0, 50, 2)]]


def row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force_with_odd_rows(spark):
    r = random.Random(4)
    texts = [None, "", " \t\n\x0b\x0c\r", "eins", "a " * 40, "x y\u0085z " * 8, "日本 é " * 9, "a b\na\tb a\x0bb a b"]
    texts += [" ".join(r.choice("abcdefg") for _ in range(r.randint(1, 90))) for _ in range(150)]
    rows = [(i if i % 23 else None, t, "s", 1, 2) for i, t in enumerate(texts)]
    rows += rows[8:12]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, g int, best int")
    got = sorted(map(tuple, P.summary(P.with_planted_period(df)).collect()), key=str)
    assert got == sorted((row(x[0], x[1]) for x in rows), key=str)
    assert P.summary(P.with_planted_period(df.limit(0))).collect() == []


def test_long_text_and_groups(spark, monkeypatch):
    r = random.Random(6)
    unit = " ".join(str(r.random()) for _ in range(3000))
    df = spark.createDataFrame([(1, " ".join([unit] * 5)), (2, "w " * 60_000), (3, None)], "doc_id long, text string").coalesce(1)
    got = {x["doc_id"]: x for x in P.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 15000, 3000)] and got[1]["collapsed"] == unit
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 60000, 1)] and got[2]["collapsed"] == "w"
    assert got[3]["n_words"] == 0 and got[3]["runs"] == []
