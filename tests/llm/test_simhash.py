import random

import pytest
import xxhash

from tonality.llm import simhash as S


def brute_fp(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    """rows: (doc_id, fp) -> smallest id of the component, per row."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
                parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [(d, f"{f:016x}", best.get(find(i))) for i, (d, f) in enumerate(rows)]


def texts():
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["Été", "ÜBER", "x\x00y", "日本"]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(1, 60))) for _ in range(25)]
    out = [None, "", " \t\n", "one", "One two", "a b c"] + base + base[:6]
    for t in base[:10]:
        w = (t + " ") .split() * 6
        w[r.randrange(len(w))] = "zz"
        out += [" ".join(w), " ".join(w).upper()]
    return out


def test_matches_brute_force(spark):
    rows = [(i if i % 17 else None, t, "en", i) for i, t in enumerate(texts())]
    rows += rows[3:6]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted(map(tuple, S.near_duplicates(df).collect()), key=str)
    assert got == sorted(brute_components([(r[0], brute_fp(r[1])) for r in rows]), key=str)


@pytest.mark.parametrize("bits,blocks,hot", [(2, 5, 2), (1, 4, 64)])
def test_links_are_complete(spark, bits, blocks, hot):
    r = random.Random(bits)
    fps = {r.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(15):
            g = f
            for _ in range(r.randint(1, 4)):
                g ^= 1 << r.randrange(64)
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}
    got = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, blocks, hot).collect()
    assert {(min(x), max(x)) for x in got} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == []


def test_long_text_counts_in_pieces(monkeypatch):
    t = " ".join(f"w{i % 97}" for i in range(1000))
    whole = S.fingerprint(t)
    monkeypatch.setattr(S, "PIECE", 7)
    assert S.fingerprint(t) == whole == brute_fp(t)
