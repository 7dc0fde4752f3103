"""Weighted samples, near-copy groups and group-aware splits against plain versions."""

import hashlib
import math
import random
from collections import Counter

import pytest

from tonality.operators import weighted as W
from tonality.operators import weighted_similarity as WS


def key(i, w, seed=42):
    h = hashlib.md5(f"{seed}:{i}".encode()).hexdigest()
    return -math.log((int(h[:13], 16) + 0.5) / (1 << 52)) / w


def test_weighted_sample_is_the_smallest_keys(spark):
    r = random.Random(1)
    rows = [(i, r.choice("aab") if i % 50 else None, r.choice([0.0, -1.0, 0.1, 1.0, 50.0]) if i % 33 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s string, w double").repartition(5)
    want = {"a": 100, "b": 7, None: 500}
    asked = spark.createDataFrame(list(want.items()) + [("zz", 3)], "s string, want long")
    got = W.weighted_sample(df, "id", "w", asked, "s").collect()
    for s, n in want.items():
        own = sorted((key(i, w), i) for i, t, w in rows if t == s and w is not None and w > 0)
        assert sorted(x["id"] for x in got if x["s"] == s) == sorted(i for _, i in own[:n])
    again = W.weighted_sample(df.repartition(2), "id", "w", asked, "s").collect()
    assert sorted(got) == sorted(again)
    assert W.weighted_sample(df, "id", "w", 10, seed=1).count() == 10


def test_heavier_rows_are_drawn_more_often(spark):
    df = spark.createDataFrame([(i, 10.0 if i < 200 else 1.0) for i in range(2200)], "id long, w double")
    got = [x["id"] < 200 for x in W.weighted_sample(df, "id", "w", 200).collect()]
    assert 60 <= sum(got) <= 140  # half of the weight lies on them


def test_proportional_places(spark):
    df = spark.createDataFrame([("a",)] * 7 + [("b",)] * 2 + [("c",)] * 2 + [(None,)], "s string")
    got = {x["s"]: x["want"] for x in W.proportional(df, "s", 5).collect()}
    assert got == {"a": 3, "b": 1, "c": 1, None: 0} or sum(got.values()) == 5
    assert sum({x["s"]: x["want"] for x in W.proportional(df, "s", 12).collect()}.values()) == 12


def texts(seed, n=120):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        if out and r.random() < .5:
            words = r.choice(out)[1].split()
            for _ in range(r.randint(0, 3)):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocab)
        else:
            words = [r.choice(vocab) for _ in range(r.randint(0, 25))]
        out.append((i, " ".join(words)))
    return out + [(n, None), (n + 1, out[0][1].upper()), (n + 2, out[0][1])]


def jaccard_pairs(rows, t):
    sets = {i: frozenset(x.lower().split()) for i, x in rows if x is not None}
    return {(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9)}


def plain_components(ids, pairs):
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(group[a], group[b])
            if group[a] != m or group[b] != m:
                group[a] = group[b] = m
                changed = True
    return group


@pytest.mark.parametrize("t", [0.5, 0.8])
def test_near_copies_and_components(spark, t):
    rows = texts(7)
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    pairs = W.near_copy_pairs(df, "id", "text", t)
    want = plain_components([i for i, _ in rows], jaccard_pairs(rows, t))
    got = {x["id"]: x["group"] for x in W.components(pairs).collect()}
    assert {i: got.get(i, i) for i, _ in rows} == want
    assert len(set(want.values())) < len(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    got = {x["id"]: x["group"] for x in W.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}
    assert W.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("ratio", [0.0, 0.5, 0.8, 1.0])
def test_split_keeps_groups_whole_near_the_ratio(spark, ratio):
    r = random.Random(5)
    rows = [(i, r.choice([0, 0, 0, 1000, 2000, 3000 + i // 4, 5000 + i // 11])) for i in range(600)]
    groups = spark.createDataFrame(rows, "id long, group long").repartition(4)
    df = groups.select("id").unionByName(spark.createDataFrame([(i,) for i in range(600, 650)], "id long"))
    got = W.split_groups(df, "id", groups, ratio).collect()
    sides = {}
    for x in got:
        sides.setdefault(x["group"], set()).add(x["split"])
    assert len(got) == 650 and all(len(s) == 1 for s in sides.values())
    largest = max(Counter(x["group"] for x in got).values())
    train = sum(x["split"] == "train" for x in got)
    assert 0 <= 650 * ratio - train <= largest
    again = W.split_groups(df.repartition(2), "id", groups, ratio).collect()
    assert sorted(got) == sorted(again)


def plain_weighted(qs, cs, t):
    n = len(cs)
    sets = lambda rows: {i: set((x or "").lower().split()) for i, x in rows}
    q, c = sets(qs), sets(cs)
    df = Counter(w for s in c.values() for w in s)
    weigh = lambda w: round(WS.SCALE * math.log(1 + n / df[w])) if w in df else round(WS.SCALE * math.log(1 + n))
    out = {}
    for i, a in q.items():
        for j, b in c.items():
            s, m = sum(map(weigh, a & b)), min(sum(map(weigh, a)), sum(map(weigh, b)))
            if m and s / m > t:
                out[i, j] = s
    return out


@pytest.mark.parametrize("t", [0.3, 0.6, 0.8])
def test_weighted_join_equals_brute_force(spark, t):
    cs, qs = texts(11), [(1000 + i, x) for i, x in texts(12, 30)] + [(2000 + i, x) for i, x in texts(11, 20)]
    q = spark.createDataFrame(qs, "q long, text string").repartition(2)
    c = spark.createDataFrame(cs, "c long, text string").repartition(3)
    want = plain_weighted(qs, cs, t)
    got = {(x["q"], x["c"]): x["shared_weight"] for x in WS.weighted_overlap_join(q, c, "q", "c", threshold=t).collect()}
    assert got == want and len(want) > 20
    weights, n = WS.token_weights(c, "c", "text")
    a = WS.materialize(WS.weighted_rows(q, "q", "text", weights, n))
    pairs = WS.candidates(a, WS.weighted_rows(c, "c", "text", weights, n), t)
    assert {tuple(x) for x in pairs.collect()} >= set(want)  # the bounds are proven: nothing is lost
    if t >= 0.6:
        assert pairs.count() <= 3 * len(want)


def test_weights_of_whole_tables_are_added_up_without_a_window(spark, monkeypatch):
    """Only contexts lighter than the heaviest query are sorted by weight; the long ones are added up where they are read."""
    long = " ".join(f"w{i}" for i in range(400))
    cs = [(1, "a b c"), (2, "a b c d"), (3, long + " a b c"), (4, ""), (5, None), (6, long)]
    c, q = spark.createDataFrame(cs, "c long, text string"), spark.createDataFrame([(9, "a b c x"), (8, "w1 w2 w3")], "q long, text string")
    seen, rows = [], WS.weighted_rows
    monkeypatch.setattr(WS, "weighted_rows", lambda df, id_col, *a: seen.append({r[id_col] for r in df.collect()}) or rows(df, id_col, *a))
    got = {(x["q"], x["c"]): x["shared_weight"] for x in WS.weighted_overlap_join(q, c, "q", "c", threshold=0.6).collect()}
    assert got == plain_weighted([(9, "a b c x"), (8, "w1 w2 w3")], cs, 0.6) and (9, 1) in got and (8, 6) in got
    assert seen[0] == {8, 9} and len(seen) == 2 and {1} <= seen[1] <= {1, 2}
    weights, n = WS.token_weights(c, "c", "text")
    totals = {r["sid"]: r["total"] for r in WS.total_weights(c, "c", "text", WS.materialize(weights), n).collect()}
    windowed = {r["sid"]: r["total"] for r in rows(c, "c", "text", WS.materialize(weights), n).collect()}
    assert totals == windowed and set(totals) == {1, 2, 3, 6}


def test_near_copies_are_written_without_token_sets(spark, monkeypatch):
    seen, write = [], W.materialize
    monkeypatch.setattr(W, "materialize", lambda df: seen.append(dict(df.dtypes)) or write(df))
    rows = [(1, "a b c d e"), (2, "e d c b a"), (3, "a b c d f"), (4, "x y"), (5, ""), (6, None), (7, "a b c d e g")]
    got = {tuple(r) for r in W.near_copy_pairs(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.8).collect()}
    assert got == {(1, 2), (1, 7)}
    assert seen and not [t for d in seen for t in d.values() if t == "array<string>"]
