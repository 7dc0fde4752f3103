"""Exact distributed ranks, splits, balancing, sampling and batches."""

import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tonality.operators import sampling as S
from tonality.plans import fixtures as FX

from conftest import SF_CHECK


def h(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_seeded_hash_matches_python(spark):
    df = spark.range(5).select(S.seeded_hash(F.col("id")).alias("h"), "id")
    assert [r["h"] for r in df.orderBy("id").collect()] == [h(i) for i in range(5)]


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_hash_rank_equals_global_window(spark, digits):
    df = spark.range(3000).withColumn("g", F.col("id") % 3)
    got = S.hash_rank(df, "id", ["g"], bucket_digits=digits).select("id", "rank")
    w = Window.partitionBy("g").orderBy(S.seeded_hash(F.col("id")), F.col("id"))
    want = df.select("id", F.row_number().over(w).alias("rank"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_range_rank_and_batches(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    got = S.batch_ids(df, "k", 32).select("k", "position", "batch_id").collect()
    for r in got:
        assert r["position"] == r["k"] // 7 + 1 and r["batch_id"] == (r["position"] - 1) // 32


def test_split_exact_is_a_partition_with_exact_sizes(spark):
    df = spark.range(1001).withColumn("dataset", F.when(F.col("id") < 400, "a").otherwise("b"))
    s = S.split_exact(df, "id", "dataset", 0.8)
    sizes = {(r["dataset"], r["split"]): r["count"] for r in s.groupBy("dataset", "split").count().collect()}
    assert sizes == {("a", "train"): 320, ("a", "test"): 80, ("b", "train"): 480, ("b", "test"): 121}
    assert s.select("id").distinct().count() == 1001
    # the train set is exactly the first floor(n*0.8) of the seeded order
    a_train = {r["id"] for r in s.where("dataset = 'a' AND split = 'train'").collect()}
    assert a_train == set(sorted(range(400), key=lambda i: (h(i), i))[:320])


def test_split_stable_across_partitioning(spark):
    df = FX.fx_text(spark, SF_CHECK).withColumn("dataset", F.lit("x"))
    a = S.split_exact(df.repartition(1), "id", "dataset", 0.8).select("id", "split")
    b = S.split_exact(df.repartition(7), "id", "dataset", 0.8).select("id", "split")
    assert a.exceptAll(b).count() == 0


def test_split_hash_ratio(spark):
    s = S.split_hash(spark.range(20000), "id", 0.8)
    frac = s.where("split = 'train'").count() / 20000
    assert 0.78 < frac < 0.82
    assert S.hash_threshold(0.8) == "cccccccc"


def test_split_hash_ends(spark):
    for ratio, side in ((0.0, "test"), (1.0, "train")):
        assert {r["split"] for r in S.split_hash(spark.range(1000), "id", ratio).select("split").distinct().collect()} == {side}


def test_range_bounds_on_skewed_ids(spark):
    # half of the ids in a millionth of the range
    df = spark.range(40_000).select(F.when(F.col("id") < 20_000, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("k")).repartition(4)
    bounds = S.range_bounds(df, "k", per_bucket=500)
    ks = sorted(r["k"] for r in df.collect())
    import bisect
    sizes = {}
    for k in ks:
        b = bisect.bisect_right(bounds, k)
        sizes[b] = sizes.get(b, 0) + 1
    assert max(sizes.values()) <= 500 and len(bounds) < 1000
    ranks = S.range_rank(df, "k", per_bucket=500).select("k", "rank").collect()
    assert [r["k"] for r in sorted(ranks, key=lambda r: r["rank"])] == ks
    assert S.range_bounds(df.limit(0), "k") == [] and S.range_bounds(df.where("k = 7"), "k") == []


def test_split_and_balance_shuffle_no_row(spark):
    df = spark.createDataFrame([(i, "a", "neutral" if i % 3 else "negative", "text") for i in range(200)], "id long, dataset string, sentiment string, body string")
    for out in (S.split_exact(df, "id", "dataset", 0.5), S.balance_undersample(df, "id", "sentiment")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # the text joins the cuts; it is in no ranking, aggregation or window
        assert all("body" not in line for line in plan.splitlines() if "Window" in line or "Aggregate" in line)


def test_balance_undersample(spark):
    rows = [(i, "negative") for i in range(10)] + [(100 + i, "positive") for i in range(50)] + \
           [(200 + i, "neutral") for i in range(4)] + [(300, "other")]
    df = spark.createDataFrame(rows, "id long, sentiment string")
    b = S.balance_undersample(df, "id", "sentiment")
    counts = {r["sentiment"]: r["count"] for r in b.groupBy("sentiment").count().collect()}
    assert counts == {"negative": 10, "positive": 10, "neutral": 4}
    pos = {r["id"] for r in b.where("sentiment = 'positive'").collect()}
    assert pos == set(sorted(range(100, 150), key=lambda i: (h(i), i))[:10])


def test_shuffle_and_sample(spark):
    df = spark.range(50)
    pos = {r["id"]: r["pos"] for r in S.shuffle_rows(df, "id").collect()}
    order = sorted(range(50), key=lambda i: (h(i), i))
    assert [pos[i] for i in order] == list(range(1, 51))
    assert [r["id"] for r in S.sample_n(df, "id", 10).collect()] == order[:10]


def test_ranks_on_empty_and_tiny_inputs(spark):
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert S.batch_ids(empty, "k", 32).count() == 0
    assert S.shuffle_rows(spark.range(0), "id").count() == 0
    one = spark.range(1).withColumnRenamed("id", "k")
    assert [(r["position"], r["batch_id"]) for r in S.batch_ids(one, "k", 32).collect()] == [(1, 0)]


def test_rows_of_a_group_do_not_meet_in_one_task(spark):
    """The cuts, a row a group, travel to the rows: no shuffle of the rows by their group."""
    df = spark.range(4000).repartition(7).select("id", F.when(F.col("id") % 40 == 0, "negative").otherwise("neutral").alias("sentiment"))
    for out in (S.split_exact(df, "id", "sentiment", 0.8), S.balance_undersample(df, "id")):
        rows = out.withColumn("at", F.spark_partition_id()).groupBy("sentiment").agg(F.countDistinct("at").alias("n")).collect()
        assert rows and all(r["n"] == 7 for r in rows if r["sentiment"] == "neutral")
        assert "hashpartitioning(sentiment" not in out._jdf.queryExecution().executedPlan().toString()
