"""Event-time streaming with bounded state.

``SentimentWindows`` keeps, for each source, label counts of its open event-time windows in
a map state (``transformWithState``; the state store is RocksDB). A window's timer is set to its end: when the watermark passes it, the
window is emitted once and its state removed, so a source holds only the windows that are still open (the allowed
lateness divided by the width, plus one), however long the stream runs. Rows of windows that have already closed are late
and dropped.

``grow_knowledge_base`` and ``retrieve_growing`` stream both sides of retrieval: additions are
written once an epoch (rewritten, not repeated, when an epoch is run again after a failure), and each micro-batch of queries reads
the knowledge base as it stands then.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tonality import registry as R
from tonality.operators.similarity import overlap_join
from tonality.session import scratch_path

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = [*R.LABELS, "other"]
WINDOW_SCHEMA = "source string, window_start timestamp, window_end timestamp, n long, " + ", ".join(f"{c} long" for c in COUNTS)


class SentimentWindows(StatefulProcessor):
    """Counts labels by window; see the module."""

    def __init__(self, width_ms: int) -> None:
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "start long", ", ".join(f"{c} long" for c in COUNTS))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        for f in rows:
            ms = f["ts"].astype("datetime64[ms]").astype("int64")
            label = f["label"].where(f["label"].isin(R.LABELS), "other")
            for start, group in label.groupby(ms // self.width * self.width):
                if start + self.width <= closed:  # late
                    continue
                was = self.counts.getValue((int(start),)) if self.counts.containsKey((int(start),)) else (0,) * len(COUNTS)
                n = group.value_counts()
                self.counts.updateValue((int(start),), tuple(int(w) + int(n.get(c, 0)) for w, c in zip(was, COUNTS)))
                self.handle.registerTimer(int(start) + self.width)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        start = end - self.width
        if not self.counts.containsKey((start,)):
            return
        n = self.counts.getValue((start,))
        self.counts.removeKey((start,))
        at = lambda ms: [pd.Timestamp(ms, unit="ms")]
        yield pd.DataFrame({"source": [key[0]], "window_start": at(start), "window_end": at(end), "n": [sum(n)]} | {c: [int(v)] for c, v in zip(COUNTS, n)})

    def close(self) -> None:
        pass


def sentiment_windows(stream: DataFrame, source: str, time: str, label: str, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Label counts a source and window, each emitted once when the watermark passes its end (append mode).

    Rows with a null source or time are left out; a label outside the domain counts as ``other``.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    ms = int(pd.Timedelta(width).total_seconds() * 1000)
    rows = stream.select(F.col(source).cast("string").alias("source"), F.col(time).cast("timestamp").alias("ts"), F.col(label).cast("string").alias("label"))
    rows = rows.where("source is not null and ts is not null").withWatermark("ts", lateness)
    return rows.groupBy("source").transformWithStateInPandas(SentimentWindows(ms), WINDOW_SCHEMA, "Append", "EventTime")


def sentiment_windows_batch(df: DataFrame, source: str, time: str, label: str, width: str = "1 hour") -> DataFrame:
    """The same windows of a finished table."""
    ms = int(pd.Timedelta(width).total_seconds() * 1000)
    lab = F.when(F.col(label).isin(*R.LABELS), F.col(label)).otherwise("other")
    start = F.floor(F.unix_millis(F.col(time).cast("timestamp")) / ms).cast("long") * ms
    rows = df.where(F.col(source).isNotNull() & F.col(time).isNotNull()).select(F.col(source).cast("string").alias("source"), start.alias("s"), lab.alias("l"))
    counts = rows.groupBy("source", "s").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("l") == c).cast("long")).alias(c) for c in COUNTS])
    return counts.select("source", F.timestamp_millis("s").alias("window_start"), F.timestamp_millis(F.col("s") + ms).alias("window_end"), "n", *COUNTS)


# --------------------------------------------------------------------------
# a knowledge base that grows while queries arrive
# --------------------------------------------------------------------------

def grow_knowledge_base(additions: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Adds the stream's rows to the knowledge base at ``path``, one folder an epoch: a repeated epoch replaces its own rows."""
    ckpt = checkpoint or scratch_path(additions.sparkSession, "kb-ckpt")

    def batch(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return additions.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def retrieve_growing(queries: DataFrame, kb_path: str, kb_schema: T.StructType, q_id: str, q_text: str, c_id: str, c_text: str,
                     out_path: str, threshold: float = R.OVERLAP_THRESHOLD, checkpoint: str | None = None) -> StreamingQuery:
    """Overlap retrieval of every micro-batch against what the knowledge base holds when it starts; one folder of matches an epoch."""
    ckpt = checkpoint or scratch_path(queries.sparkSession, "retrieve-ckpt")

    def batch(df: DataFrame, epoch: int) -> None:
        kb = df.sparkSession.read.schema(kb_schema).parquet(kb_path)
        overlap_join(df, kb, q_id, c_id, q_text, c_text, threshold).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    return queries.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
