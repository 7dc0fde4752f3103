"""Structured Streaming entry points.

The original reads everything before it starts, so nothing here adds event
time, watermarks or custom state. What streams naturally:

* every column function (cleaning, labels, prompts, HTML) — stateless, the
  same expressions on a streaming frame;
* retrieval against a static knowledge base — each micro-batch of queries is
  joined with the overlap join inside ``foreachBatch`` (its candidate step
  materialises intermediates, which a streaming plan cannot do itself);
* running confusion counts — a streaming ``groupBy(true, pred).count()``
  whose state is bounded by (#labels)².

Checkpoints go to the shared checkpoint folder, so a restarted query resumes
where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tonality.functions import labels as L
from tonality.functions import text as TX
from tonality.operators import evaluation as E
from tonality.operators.similarity import overlap_join
from tonality.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream (new files in ``path`` are new rows)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def clean_queries(stream: DataFrame, text_col: str = "query") -> DataFrame:
    """C5 on a stream: adds ``cleaned_query`` and ``window_days``."""
    cq = TX.clean_query(text_col)
    return stream.withColumn("cleaned_query", cq["cleaned"]).withColumn("window_days", cq["window_days"])


def parse_predictions(stream: DataFrame, output_col: str = "model_output") -> DataFrame:
    """P14 on a stream: adds ``predicted_label``."""
    return stream.withColumn("predicted_label", L.parse_prediction(output_col))


def running_confusion_counts(predictions: DataFrame, true_col: str = "expected_output",
                             pred_col: str = "predicted_label") -> DataFrame:
    """Streaming confusion counts (use output mode ``complete`` or ``update``)."""
    return E.confusion_counts(predictions, true_col, pred_col, materialized=False)


def write_available_now(stream: DataFrame, path: str, fmt: str = "parquet",
                        checkpoint: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """Process everything available now, then stop (incremental batch)."""
    ckpt = checkpoint or scratch_path(stream.sparkSession, "stream-ckpt")
    return (stream.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start(path))


def retrieve_stream(queries: DataFrame, kb: DataFrame, q_id: str, q_text: str, c_id: str, c_text: str,
                    out_path: str, threshold: float = 0.8, checkpoint: str | None = None) -> StreamingQuery:
    """Overlap retrieval for every micro-batch of queries against a static
    knowledge base; matches are appended as Parquet to ``out_path``."""
    ckpt = checkpoint or scratch_path(queries.sparkSession, "retrieve-ckpt")

    def batch(df: DataFrame, epoch: int) -> None:
        m = overlap_join(df, kb, q_id, c_id, q_text, c_text, threshold)
        m.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out_path)

    return (queries.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
