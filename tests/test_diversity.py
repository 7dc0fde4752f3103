"""Greedy marginal relevance against a plain greedy on every query."""

import math
import random

from pyspark.sql import functions as F

from tonality.operators import diversity as D


def cos(a, b):
    n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / n if n else 0.0


def greedy(matches, vec, k, share):
    """matches: {query: {context: relevance}}"""
    out = []
    for q, rel in matches.items():
        chosen = []
        left = {c for c, r in rel.items() if r is not None and vec.get(c) is not None}
        while left and len(chosen) < k:
            def score(c):
                return round(share * rel[c] - (1 - share) * max((cos(vec[c], vec[x]) for x in chosen), default=0.0), 9)
            best = max(left, key=lambda c: (score(c), -c))
            out.append((q, best, len(chosen) + 1, score(best)))
            chosen.append(best)
            left.remove(best)
    return sorted(out)


def test_equals_plain_greedy_on_every_query(spark):
    r = random.Random(3)
    vec = {c: [float(r.randrange(-3, 4)) for _ in range(4)] for c in range(40)}
    vec[5] = [0.0] * 4
    vec[6] = vec[7] = vec[8]  # copies
    vec[9] = None
    matches = {q: {c: None if r.random() < .05 else round(r.random(), 2) for c in r.sample(range(40), r.randint(1, 25))} for q in range(30)}
    m = spark.createDataFrame([(q, c, v) for q, d in matches.items() for c, v in d.items()], "q_id long, c_id long, relevance double").repartition(4)
    v = spark.createDataFrame(list(vec.items()), "id long, v array<double>")
    for k, share in ((1, 0.7), (4, 0.7), (6, 0.0), (3, 1.0)):
        got = sorted(tuple(x) for x in D.diverse_contexts(m, v, "id", "v", k, share).collect())
        want = greedy(matches, vec, k, share)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert all(abs(g[3] - w[3]) < 1e-8 for g, w in zip(got, want))


def test_copies_of_a_better_match_go(spark):
    texts = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None)], "id long, text string")
    m = spark.createDataFrame([(7, 2, 1), (7, 1, 2), (7, 3, 3), (7, 4, 4), (7, 5, 5), (8, 1, 1)], "q_id long, c_id long, rank int")
    got = sorted((x["q_id"], x["c_id"]) for x in D.first_of_copies(m, texts, "id", "text").collect())
    assert got == [(7, 2), (7, 3), (7, 4), (7, 5), (8, 1)]


def test_empty_matches(spark):
    m = spark.createDataFrame([], "q_id long, c_id long, relevance double")
    v = spark.createDataFrame([], "id long, v array<double>")
    assert D.diverse_contexts(m, v, "id", "v", 2).collect() == []
    assert m.select(F.lit(1)).count() == 0
