"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps column pruning and survives
    the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict = {}


def hold(owner: str, forget) -> None:
    """In a Python worker: caches of ``owner`` stay from task to task, those of other operators are emptied.

    Spark's Python workers outlive a stage, so each operator that keeps a cache calls this when a task begins.
    """
    for name in [n for n in _HELD if n != owner]:
        _HELD.pop(name)()
    _HELD[owner] = forget


def held_out(doc_id: str = "doc_id"):
    """True on the quarter of ids whose crc32(text of id) mod 4 is 2 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _unfinished(e: DataFrame) -> bool:
    """Whether a node points to two others, or one that is pointed to points on."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return not ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1 and out > 0").isEmpty()


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Components of an undirected graph: (a, b) long pairs -> (node, component).

    Alternating large-star and small-star steps. Every step is one grouped minimum
    and one join, so a node of any degree is partially aggregated before the
    shuffle and its join partition can be split. ``component`` is the smallest
    node reachable. Nodes without an edge do not appear. The steps end when the
    edges are stars, which is what they leave as it is: every node points to one
    other, and no node that is pointed to points on.
    """
    both = edges.select("a", "b").where("a <> b")
    e = materialise(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while _unfinished(e):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (sym.join(low, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = materialise(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(small.select("u", F.col("m").alias("v")))
                        .where("u <> v").distinct(), name)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, <label>): about ``rows`` labelled ids of each label value, chosen by hash; all where there are fewer.

    Bounded by rows x label values, so it may be broadcast. Null ids and null labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label)).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).distinct()
    n = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    if not n:
        return known
    share = F.create_map(*[x for k, c in n.items() for x in (F.lit(k), F.lit(rows / c))])
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col(label)] * (1 << 20))
