"""Prefix-filtered overlap join and blocked k-NN against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonality.operators import similarity as SIM
from tonality.plans import fixtures as FX

from conftest import SF_SMALL


def brute(qs, cs, t, eps=0.0):
    out = set()
    for qi, qt in qs:
        a = set(qt.lower().split())
        for ci, ct in cs:
            b = set(ct.lower().split())
            m = min(len(a), len(b))
            if eps == 0.0:
                s = len(a & b) / m if m > 0 else 0.0
            else:
                s = len(a & b) / (m + eps)
            if s > t:
                out.add((qi, ci, len(a & b)))
    return out


@pytest.mark.parametrize("t", [0.2, 0.5, 0.8])
def test_overlap_join_equals_brute_force_on_fixture(spark, t):
    q = FX.table(spark, SF_SMALL, "benchmark").select(F.col("item_id").alias("q"), "text")
    c = FX.table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("c"), "text")
    got = {(r["q"], r["c"], r["n_shared"]) for r in SIM.overlap_join(q, c, "q", "c", threshold=t).collect()}
    want = brute([(r["q"], r["text"]) for r in q.collect()], [(r["c"], r["text"]) for r in c.collect()], t)
    assert got == want


WORDS = st.lists(st.sampled_from("a b c d e f g h the of".split()), max_size=8).map(" ".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6), st.lists(WORDS, min_size=1, max_size=8),
       st.sampled_from([0.2, 0.5, 0.8]), st.booleans())
def test_overlap_join_random(spark, qs, cs, t, eps):
    qrows = list(enumerate(qs))
    crows = list(enumerate(cs))
    q = spark.createDataFrame(qrows, "q long, text string")
    c = spark.createDataFrame(crows, "c long, text string")
    got = {(r["q"], r["c"], r["n_shared"]) for r in
           SIM.overlap_join(q, c, "q", "c", threshold=t, score="similarity" if eps else "overlap").collect()}
    assert got == brute(qrows, crows, t, 1e-6 if eps else 0.0)


def test_overlap_join_symmetric(spark):
    q = FX.table(spark, SF_SMALL, "benchmark").select(F.col("item_id").alias("a"), "text")
    c = FX.table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("b"), "text")
    ab = {(r["a"], r["b"], r["score"]) for r in SIM.overlap_join(q, c, "a", "b").collect()}
    ba = {(r["a"], r["b"], r["score"]) for r in SIM.overlap_join(c, q, "b", "a").collect()}
    assert ab == ba and all(0 <= s <= 1 for _, _, s in ab)


@pytest.mark.parametrize("k,block", [(5, 2048), (900, 2048), (7, 64)])
def test_knn_exact_equals_numpy(spark, k, block):
    v = FX.table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding")
    rows = v.collect()
    ids = np.array([r["vec_id"] for r in rows])
    m = np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = SIM.knn_exact(v, v, "vec_id", "vec_id", "embedding", "embedding", k, exclude_self=True,
                        block_rows=block).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["q_id"], []).append((r["rank"], r["c_id"], r["distance"]))
    assert len(by_q) == len(ids)
    for qi in ids[:40]:
        d = ((m - m[ids == qi][0]) ** 2).sum(axis=1)
        order = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != qi][:k]
        mine = sorted(by_q[int(qi)])
        assert [c for _, c, _ in mine] == order
        assert [rk for rk, _, _ in mine] == list(range(1, len(order) + 1))


def test_knn_ties_go_to_the_smallest_ids(spark):
    c = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(300, 0, -1)], "c long, v array<float>").repartition(5)
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 2.0])], "q long, w array<float>")
    for block in (2048, 16):
        got = SIM.knn_exact(q, c, "q", "c", "w", "v", 3, block_rows=block).collect()
        assert sorted((r.q_id, r.rank, r.c_id) for r in got) == [(i, k, k) for i in (1, 2) for k in (1, 2, 3)]
    assert SIM.knn_exact(q, c.limit(0), "q", "c", "w", "v", 3).count() == 0
    assert SIM.knn_exact(q, c.limit(2), "q", "c", "w", "v", 3).count() == 4


def test_nearest_rows_leave_out_none_and_few_others():
    r = np.random.default_rng(3)
    c, q = r.standard_normal((6000, 16)).astype(np.float32) * 50, r.standard_normal((40, 16)).astype(np.float32) * 50
    c[7], c[8, 2] = c[9], np.nan
    got = [(int(a), int(b)) for rows, cols in SIM.nearest_rows(q, c, 5) for a, b in zip(rows, cols)]
    d = ((q[:, None, :].astype(np.float64) - c[None]) ** 2).sum(axis=2)
    want = {(i, int(j)) for i in range(len(q)) for j in np.argsort(d[i])[:5]}
    assert want <= set(got) and len(got) < 3 * len(want) and 8 not in {b for _, b in got}


def test_a_query_row_is_not_sent_to_every_cell(spark):
    """Queries go to blocks of near cells: about SIDES rows a query where nothing can be skipped, not one a cell."""
    r = np.random.default_rng(4)
    pivots = r.standard_normal((900, 32))
    count = np.full(900, 100)
    block_of = SIM._blocks_of(pivots, count, 90_000 // SIM.SIDES)
    assert sorted(np.unique(block_of)) == list(range(block_of.max() + 1)) and block_of.max() + 1 <= 2 * SIM.SIDES
    assert (np.bincount(block_of, weights=count) <= 90_000 // SIM.SIDES).all()
    alone = SIM._blocks_of(pivots[:4], np.array([5, 50, 5, 5]), 20)
    assert (np.bincount(alone, weights=[5, 50, 5, 5]) <= 50).all() and block_of.max() >= 1


def test_two_stage_cut(spark):
    from tonality.operators.retrieval import retrieve_two_stage
    qv = spark.createDataFrame([(1, "a b c", [0.0, 0.0])], "q long, text string, v array<float>")
    cv = spark.createDataFrame([(i, "a b c", [float(i), 0.0]) for i in range(9)] + [(9, "x", [0.5, 0.0])], "c long, text string, v array<float>")
    ids = lambda **o: [r.c_id for r in retrieve_two_stage(qv, cv, "q", "text", "v", "c", "text", "v", **o).orderBy("rank").collect()]
    assert ids() == list(range(9)) and ids(k=4) == [0, 1, 2] and ids(top_k=2) == [0, 1]


def test_joins_on_empty_sides(spark):
    from tonality.operators.retrieval import retrieve_two_stage
    q = spark.createDataFrame([(1, "a b c")], "q long, text string")
    c = spark.createDataFrame([(7, "a b c d")], "c long, text string")
    none_q = q.limit(0)
    none_c = c.limit(0)
    assert SIM.overlap_join(none_q, c, "q", "c").count() == 0
    assert SIM.overlap_join(q, none_c, "q", "c").count() == 0
    assert [(r["q"], r["c"], r["n_shared"]) for r in SIM.overlap_join(q, c, "q", "c").collect()] == [(1, 7, 3)]
    qv = spark.createDataFrame([(1, "a b c", [0.0, 1.0])], "q long, text string, v array<float>")
    cv = spark.createDataFrame([(7, "a b c d", [1.0, 1.0]), (8, "x y", [0.0, 0.0])], "c long, text string, v array<float>")
    m = retrieve_two_stage(qv, cv, "q", "text", "v", "c", "text", "v", k=1).collect()
    assert [(r["q_id"], r["c_id"], r["rank"]) for r in m] == [(1, 7, 1)]
    assert retrieve_two_stage(qv.limit(0), cv, "q", "text", "v", "c", "text", "v", k=1).count() == 0


def _frames(monkeypatch, module):
    """Column types of every frame that ``module`` writes."""
    seen, write = [], module.materialize

    def spy(df):
        seen.append(dict(df.dtypes))
        return write(df)

    monkeypatch.setattr(module, "materialize", spy)
    return seen


def test_pairs_are_counted_once_a_set_and_written_without_token_sets(spark, monkeypatch):
    words = "alpha beta gamma delta epsilon".split()
    q = spark.createDataFrame([(i, "alpha beta gamma delta") for i in range(20)] + [(20, "alpha zeta eta theta iota")], "q int, text string")
    c = spark.createDataFrame([(i, " ".join(words)) for i in range(30)] + [(30, "kappa alpha")], "c int, text string")
    counted, count = [], SIM.count_shared
    seen = _frames(monkeypatch, SIM)
    monkeypatch.setattr(SIM, "count_shared", lambda *a: counted.append(count(*a)) or counted[-1])
    got = {(r["q"], r["c"], r["n_shared"]) for r in SIM.overlap_join(q, c, "q", "c", threshold=0.8).collect()}
    assert got == {(i, j, 4) for i in range(20) for j in range(30)}
    assert counted[0].count() == 1
    assert seen and not [t for d in seen for t in d.values() if t == "array<string>"]


@pytest.mark.parametrize("t", [0.5, 0.8])
def test_sketches_lose_no_pair_of_large_sets(spark, t):
    import random
    r = random.Random(3)
    pool = [f"w{i}" for i in range(3000)]
    cs = [(i, " ".join(r.sample(pool, r.choice([5, 40, 600, 2500])))) for i in range(40)]
    qs = [(i, " ".join(r.sample(cs[i][1].split(), max(3, len(cs[i][1].split()) // 2)) + r.sample(pool, 3))) for i in range(30)]
    q, c = spark.createDataFrame(qs, "q int, text string"), spark.createDataFrame(cs, "c int, text string")
    assert {(x["q"], x["c"], x["n_shared"]) for x in SIM.overlap_join(q, c, "q", "c", threshold=t).collect()} == brute(qs, cs, t)
