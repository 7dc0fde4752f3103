"""Event-time windows with expiring state, and retrieval against a growing knowledge base."""

import datetime as dt
import random

from tonality.streaming import stateful as ST
from tonality.streaming import stream as S

SCHEMA = "source string, ts timestamp, label string"
T0 = dt.datetime(2024, 1, 1)


def rows_of(part, n, lo, hi, seed):
    r = random.Random(seed)
    labels = ["negative", "neutral", "positive", "odd", None]
    return [(f"s{r.randrange(3)}" if r.random() < .97 else None, T0 + dt.timedelta(minutes=r.uniform(lo, hi)), r.choice(labels)) for _ in range(n)]


def add_file(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, src, sink, ckpt):
    stream = S.read_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    out = ST.sentiment_windows(stream, "source", "ts", "label", "1 hour", "10 minutes")
    S.write_available_now(out, sink, checkpoint=ckpt).awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(sink).collect())


def test_windows_late_rows_expiry_and_restart(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("src", "sink", "ckpt"))
    first, second = rows_of(0, 300, 0, 200, 1), rows_of(1, 300, 195, 400, 2)
    add_file(spark, src, first, "a")
    one = run(spark, src, sink, ckpt)
    assert one and max(r[2] for r in one) <= max(x[1] for x in first) - dt.timedelta(minutes=10)
    # a restart from the checkpoint goes on with the open windows; rows of closed ones are late
    late = [("s0", T0 + dt.timedelta(minutes=5), "negative")] * 50
    add_file(spark, src, second + late, "b")
    add_file(spark, src, [("s9", T0 + dt.timedelta(days=2), "neutral")], "c")  # brings the watermark past every window
    two = run(spark, src, sink, ckpt)
    assert [r for r in two if r in one] == one and len({r[:2] for r in two}) == len(two)  # each window once
    whole = spark.createDataFrame(first + second, SCHEMA)
    want = sorted(tuple(r) for r in ST.sentiment_windows_batch(whole, "source", "ts", "label", "1 hour").collect())
    assert [r for r in two if r[0] != "s9"] == want


def test_additions_reach_later_batches_and_epochs_do_not_repeat(spark, tmp_path):
    kb_src, kb, q_src, out = (str(tmp_path / x) for x in ("kbsrc", "kb", "q", "out"))
    kb_shape, q_shape = "c_id long, text string", "q_id long, text string"
    schema = spark.createDataFrame([], kb_shape).schema

    def grow(rows):
        spark.createDataFrame(rows, kb_shape).coalesce(1).write.mode("append").parquet(kb_src)
        ST.grow_knowledge_base(S.read_stream(spark, kb_src, schema), kb, str(tmp_path / "ck1")).awaitTermination()

    def ask(rows):
        spark.createDataFrame(rows, q_shape).coalesce(1).write.mode("append").parquet(q_src)
        stream = S.read_stream(spark, q_src, spark.createDataFrame([], q_shape).schema)
        ST.retrieve_growing(stream, kb, schema, "q_id", "text", "c_id", "text", out, checkpoint=str(tmp_path / "ck2")).awaitTermination()
        return sorted((r["q_id"], r["c_id"]) for r in spark.read.parquet(out).collect())

    grow([(1, "shares rose sharply today"), (2, "profit fell")])
    assert ask([(10, "shares rose sharply today")]) == [(10, 1)]
    grow([(3, "shares rose sharply today again")])
    assert ask([(11, "shares rose sharply today")]) == [(10, 1), (11, 1), (11, 3)]
    assert spark.read.schema(schema).parquet(kb).count() == 3
    # an epoch that runs again replaces its rows
    spark.createDataFrame([(3, "shares rose sharply today again")], kb_shape).write.mode("overwrite").parquet(f"{kb}/epoch=1")
    assert spark.read.schema(schema).parquet(kb).count() == 3
