"""Time joins and ordered features against plain Python, with tiny buckets, nulls, ties and a hot source."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tonality.operators import ordered as O
from tonality.plans import catalog

from conftest import SF_SMALL


def stream(seed, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source = "hot" if r.random() < .4 else r.choice(["a", "b", None, "lone"])
        t = None if r.random() < .03 else r.choice([r.randrange(50), r.randrange(5000)])
        out.append((i, source, t, r.choice(["negative", "neutral", "positive", None])))
    return out


@pytest.mark.parametrize("per_bucket", [3, 40, 10**6])
def test_label_stream_features(spark, per_bucket):
    rows = stream(1)
    df = spark.createDataFrame(rows, "id long, source string, t long, label string").repartition(5)
    got = {r["id"]: r for r in O.label_stream_features(df, ["source"], "t", "id", "label", ["negative", "positive"], 100, per_bucket).collect()}
    assert len(got) == len(rows)
    for s in {x[1] for x in rows}:
        own = sorted((x for x in rows if x[1] == s), key=lambda x: (x[2] is not None, x[2] or 0, x[0]))
        neg = pos = session = 0
        for k, x in enumerate(own):
            prev = own[k - 1] if k else None
            gap = x[2] - prev[2] if prev and x[2] is not None and prev[2] is not None else None
            session += prev is None or (gap is not None and gap > 100)
            neg, pos = neg + (x[3] == "negative"), pos + (x[3] == "positive")
            g = got[x[0]]
            assert (g["position"], g["prev_label"], g["gap"], g["n_negative"], g["n_positive"]) == (k + 1, prev and prev[3], gap, neg, pos)
            assert g["next_label"] == (own[k + 1][3] if k + 1 < len(own) else None)
            assert g["session"] == session


@pytest.mark.parametrize("inclusive,max_age,per_bucket", [(True, None, 5), (False, None, 5), (True, 60, 30), (True, None, 10**6)])
def test_asof_join(spark, inclusive, max_age, per_bucket):
    left, right = stream(2, 250), stream(3, 300)
    a = spark.createDataFrame(left, "id long, source string, t long, label string").repartition(3)
    b = spark.createDataFrame(right, "cid long, source string, at long, val string").repartition(4)
    b = b.select("cid", "source", F.col("at").alias("t"), "val")
    got = {r["id"]: (r["asof_cid"], r["asof_val"]) for r in O.asof_join(a, b, ["source"], "t", "t", "cid", ["cid", "val"], inclusive=inclusive, max_age=max_age, per_bucket=per_bucket).collect()}
    assert len(got) == len(left)
    for i, s, t, _ in left:
        fit = [(c[2], c[0], c[3]) for c in right if s is not None and t is not None and c[1] == s and c[2] is not None and (c[2] <= t if inclusive else c[2] < t)]
        best = max(fit, key=lambda x: x[:2], default=None)
        if best and max_age is not None and t - best[0] > max_age:
            best = None
        assert got[i] == ((best[1], best[2]) if best else (None, None))


def test_asof_join_of_empty_sides(spark):
    a = spark.createDataFrame([(1, "s", 5)], "id long, source string, t long")
    none = a.limit(0)
    assert [tuple(r) for r in O.asof_join(a, none, ["source"], "t", "t", "id", ["id"]).collect()] == [(1, "s", 5, None)]
    assert O.asof_join(none, a, ["source"], "t", "t", "id", ["id"]).collect() == []


def windows(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.randrange(3000)
        length = r.choice([-2, 0, 1, 2, 3, 17, 64, 900, 100_000])
        out.append((i, r.choice(["a", "b", None]), None if r.random() < .02 else s, s + length))
    return out


def test_interval_join(spark):
    left, right = windows(4, 300), windows(5, 300)
    a = spark.createDataFrame(left, "id long, k string, s long, e long").repartition(3)
    b = spark.createDataFrame(right, "id long, k string, s long, e long").repartition(2)
    got = sorted((r["id"], r["r_id"]) for r in O.interval_join(a, b, ["k"], ("s", "e"), ("s", "e")).collect())
    ok = lambda x: x[1] is not None and x[2] is not None and x[3] > x[2]
    want = sorted((x[0], y[0]) for x in left for y in right if ok(x) and ok(y) and x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert got == want and len(want) > 1000


def test_long_windows_do_not_fill_short_buckets(spark):
    """A window of any length is in at most two buckets a level, and visitors don't meet visitors."""
    short = [(i, "a", 10 * i, 10 * i + 5) for i in range(2000)]
    long = [(10**6, "a", 0, 10**9)]
    df = spark.createDataFrame(short + long, "id long, k string, s long, e long")
    plan = O.interval_join(df, df, ["k"], ("s", "e"), ("s", "e"))
    assert plan.count() == 2000 + 2 * 2000 + 1
    text = plan._jdf.queryExecution().toString()
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


@pytest.mark.parametrize("name", ["label_stream", "asof_context"])
def test_no_window_over_a_whole_source(spark, name):
    """Windows over rows are cut by bucket; only the table of buckets has one a source."""
    plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Window")]
    assert over
    for line in over:
        keys = line[line.rindex("], [", 0, line.rindex("], [")) if line.count("], [") > 1 else line.index("], ["):]
        assert "_bucket" in keys.split("]")[1] or "_bucket" in keys


def test_timestamps_and_dates_as_numbers(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 1, 0, 0, 1), dt.date(1970, 1, 3), 7)], "a timestamp, b date, c int")
    assert df.select(O.as_number(df, "a"), O.as_number(df, "b"), O.as_number(df, "c")).first()[:] == (1_000_000, 2, 7)
