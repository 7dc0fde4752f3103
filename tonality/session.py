"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this engine should carry. AQE re-plans joins and
# shuffle partition counts at run time and splits skewed join partitions. A
# join side is broadcast only when its size is known: either AQE measured it
# after a shuffle stage ran, or the operator counted it (explicit hints on
# bounded tables). The time zone is pinned so timestamp_ntz columns compare
# identically everywhere.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no broadcast from a size *estimate*; AQE broadcasts only what it measured
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # what a Python worker holds at once: rows may be whole documents or prompts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the frames that read them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for the cluster target (about 100 TB of input, ~1000 executors).
# Scans: 256 MB splits keep each task's input, and the rows decoded from it,
# inside an executor core's memory share. Shuffles: 16k initial partitions at
# ~256 MB each cover about 4 TB of shuffled data; the shuffles here move
# pruned columns, token rows or partial aggregates and stay below that, and
# AQE coalesces smaller ones at run time. A shuffle of whole texts (joining
# the raw documents) would need more partitions; store such tables bucketed by
# their key instead, so the join needs no shuffle. Skewed join partitions
# above 1 GB (and 5x the median) are split by AQE.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}


def session_conf(master: str | None) -> dict:
    """Engine defaults, plus the cluster sizing unless running in local mode."""
    conf = dict(ENGINE_CONF)
    if not master or not master.startswith("local"):
        conf.update(CLUSTER_CONF)  # deployed on a cluster: size for the big input
    return conf


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tonality", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster leave them unset and let the deployment decide.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in session_conf(master).items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (no context there)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001 - conf lookups fail on some connect servers
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when none is set.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is (and must be set). Only local-mode runs without that setting (tests,
    bench) get a fresh folder under the system temp directory.
    """
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared folder for checkpoints "
                               "(a machine-local temporary folder would not survive executor loss)")
        d = tempfile.mkdtemp(prefix="tonality-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
