"""Stateless operators give the same rows on a stream as in batch; the
per-micro-batch retrieval equals the batch join."""

from pyspark.sql import functions as F

from tonality.functions import labels as L
from tonality.functions import text as TX
from tonality.operators.similarity import overlap_join
from tonality.plans import fixtures as FX
from tonality.streaming import stream as S

from conftest import SF_SMALL


def test_clean_and_parse_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    t = FX.fx_time(spark, SF_SMALL).select("event_id", F.col("phrase").alias("query"),
                                           F.lit("Sentiment: Positive").alias("model_output"))
    t.repartition(3).write.parquet(src)
    stream = S.read_stream(spark, src, t.schema, max_files_per_trigger=1)
    out = S.parse_predictions(S.clean_queries(stream, "query"), "model_output")
    q = S.write_available_now(out, str(tmp_path / "sink"), checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "sink"))
    cq = TX.clean_query("query")
    want = t.select("event_id", "query", "model_output", cq["cleaned"].alias("cleaned_query"),
                    cq["window_days"].alias("window_days"), L.parse_prediction("model_output").alias("predicted_label"))
    cols = want.columns
    assert got.select(cols).exceptAll(want).count() == 0 and want.exceptAll(got.select(cols)).count() == 0


def test_running_confusion_counts(spark, tmp_path):
    src = str(tmp_path / "pred")
    p = FX.fx_predictions(spark, SF_SMALL).select("id", "expected_output", "predicted_label")
    p.repartition(2).write.parquet(src)
    stream = S.read_stream(spark, src, p.schema, max_files_per_trigger=1)
    agg = S.running_confusion_counts(stream)
    q = (agg.writeStream.format("memory").queryName("cm_test").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["true_label"], r["pred_label"]): r["n"] for r in spark.sql("SELECT * FROM cm_test").collect()}
    want = {(r["expected_output"], r["predicted_label"]): r["count"]
            for r in p.groupBy("expected_output", "predicted_label").count().collect()}
    assert got == want


def test_retrieve_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "q")
    qs = FX.table(spark, SF_SMALL, "benchmark").select(F.col("item_id").alias("q_id"), "text")
    qs.repartition(2).write.parquet(src)
    kb = FX.table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("c_id"), "text")
    stream = S.read_stream(spark, src, qs.schema, max_files_per_trigger=1)
    q = S.retrieve_stream(stream, kb, "q_id", "text", "c_id", "text", str(tmp_path / "m"),
                          checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "m")).select("q_id", "c_id", "n_shared")
    want = overlap_join(qs, kb, "q_id", "c_id").select("q_id", "c_id", "n_shared")
    assert sorted(got.collect()) == sorted(want.collect())
    assert want.count() > 0
