"""Sketch tables: merging equals sketching the whole, and the stated errors hold against exact figures."""

import datetime as dt
import random

from tonality.operators import sketches as SK

T0, D0 = dt.datetime(2024, 1, 1), (dt.date(2024, 1, 1) - dt.date(1970, 1, 1)).days


def events(seed=1, n=6000, days=40):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        v = r.choice([r.lognormvariate(0, 3), r.lognormvariate(5, 1), 0.0, -3.0, None])
        out.append((r.choice(["a", "a", "b", None]), T0 + dt.timedelta(days=r.uniform(0, days)), v, f"u{r.randrange(4000)}" if r.random() < .98 else None))
    return out


def test_blocks_make_up_the_range():
    for first in range(0, 40, 3):
        for last in range(first, first + 70):
            days = [d for level, b in SK.blocks_of(first, last, 5) for d in range(b << level, (b + 1) << level)]
            assert days == list(range(first, last + 1))
    assert len(SK.blocks_of(1, 1022, 9)) <= 18


def test_range_reads_are_within_the_stated_errors(spark):
    rows = events()
    df = spark.createDataFrame(rows, "source string, ts timestamp, v double, u string").repartition(4)
    table = SK.with_levels(SK.daily_sketches(df, "source", "ts", "v", "u"), 4)
    for lo, hi in ((0, 39), (3, 18), (7, 7)):
        got = {x["source"]: x for x in SK.read_range(table, D0 + lo, D0 + hi, 4).collect()}
        for s in ("a", "b"):
            own = [x for x in rows if x[0] == s and lo <= (x[1].date() - T0.date()).days <= hi]
            vals = sorted(x[2] for x in own if x[2] is not None)
            assert got[s]["n"] == len(vals)
            for q, name in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99")):
                exact = vals[int(q * (len(vals) - 1))]
                assert (got[s][name] == 0.0) if exact <= 0 else abs(got[s][name] - exact) <= SK.ERROR * exact * (1 + 1e-9)
            true = len({x[3] for x in own if x[3] is not None})
            assert abs(got[s]["n_distinct"] - true) <= max(2, 4 * 1.04 / 32 * true)


def test_levels_equal_the_merge_of_days(spark):
    df = spark.createDataFrame(events(2, 1500, 16), "source string, ts timestamp, v double, u string")
    table = SK.with_levels(SK.daily_sketches(df, "source", "ts", "v", "u"), 3)
    up = SK.merged(table.where("level = 0").selectExpr("shiftright(block, 3) as block", "source", "kind", "slot", "n"), "block", "source")
    pick = lambda d: sorted(tuple(x) for x in d.select("block", "source", "kind", "slot", "n").collect())
    assert pick(table.where("level = 3")) == pick(up)


def test_empty_history(spark):
    df = spark.createDataFrame([], "source string, ts timestamp, v double, u string")
    assert SK.read_range(SK.with_levels(SK.daily_sketches(df, "source", "ts", "v", "u"), 2), 0, 10, 2).collect() == []
