"""Deterministic shuffles, exact splits, balancing, sampling and batching.

The seeded Python shuffles of the original are replaced by an order on
``md5('<seed>:' || id)`` (tie-break ``id``), which Spark and SQL engines
compute identically. Exact positions in that order are computed without a
single-partition window (see :func:`exact_rank`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.session import ensure_checkpoint_dir

HASH_COL = "_h"
BUCKET_COL = "_b"


def seeded_hash(id_col, seed: int = R.SEED) -> Column:
    """Hex md5 of ``'<seed>:' || id`` — the deterministic shuffle key."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def exact_rank(df: DataFrame, order_cols: list, bucket: Column, partition_cols: list | tuple = (),
               name: str = "rank") -> DataFrame:
    """1-based position of each row in ``order_cols`` order within
    ``partition_cols``, without putting a whole partition group in one task.

    ``bucket`` must be monotone in the order (e.g. a hash prefix when
    ordering by that hash). Rows are counted per (group, bucket) — at most
    groups × buckets rows — a running sum over those counts gives each
    bucket's offset, and ``row_number()`` only runs inside one bucket. The
    count table is small and is joined back by AQE as a broadcast once its
    measured size is under the broadcast threshold.
    """
    parts = list(partition_cols)
    d = df.withColumn(BUCKET_COL, bucket)
    counts = d.groupBy(*parts, BUCKET_COL).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*parts).orderBy(BUCKET_COL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, BUCKET_COL,
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy(*parts)).alias("_group_n"))
    w_in = Window.partitionBy(*parts, BUCKET_COL).orderBy(*order_cols)
    return (d.join(offsets, on=[*parts, BUCKET_COL], how="inner")
             .withColumn(name, (F.col("_off") + F.row_number().over(w_in)).cast("long"))
             .drop(BUCKET_COL, "_off"))


ROWS_PER_BUCKET = 1_000_000


def auto_bucket_digits(n_rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Hex digits of hash prefix so that a bucket holds about ``per_bucket``
    rows: at least 3 (4096 buckets), at most 6 (16.7M buckets)."""
    digits = 3
    while digits < 6 and n_rows / 16 ** digits > per_bucket:
        digits += 1
    return digits


def hash_rank(df: DataFrame, id_col: str, partition_cols=(), seed: int = R.SEED,
              bucket_digits: int | None = None, name: str = "rank") -> DataFrame:
    """Exact rank by the seeded hash (then id) within ``partition_cols``.

    ``bucket_digits`` hex digits give 16**digits buckets (3 -> 4096). By default
    it is sized from a count of ``df`` so a bucket stays near a million rows
    however large the input grows (a row in its bucket is sorted by one task).
    """
    if bucket_digits is None:
        bucket_digits = auto_bucket_digits(df.count())
    d = df.withColumn(HASH_COL, seeded_hash(id_col, seed))
    out = exact_rank(d, [F.col(HASH_COL), F.col(id_col)], F.substring(HASH_COL, 1, bucket_digits),
                     partition_cols, name)
    return out.drop(HASH_COL)


def range_bounds(df: DataFrame, order_col: str, per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Split points of a numeric column that leave at most ``per_bucket`` rows
    between neighbours (equal values cannot be parted).

    An even histogram over the range is refined where it is dense: each round
    counts rows per bucket and cuts the span of values in every bucket above the target into twice
    as many parts as its count asks for; a bucket of one value is left. The driver holds one number a bucket.
    """
    from pyspark.ml.feature import Bucketizer

    c = F.col(order_col).cast("double").alias("_ord_d")
    low, high, n = df.agg(F.min(c), F.max(c), F.count(c)).first()
    if not n or low == high:
        return []
    parts = max(2, min(1 << 16, 2 * (n // per_bucket + 1)))
    splits = sorted({low + (high - low) * i / parts for i in range(1, parts)})
    while True:
        cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_ord_d", outputCol="_ord_b", handleInvalid="skip")
        dense = (cut.transform(df.select(c)).groupBy("_ord_b").agg(F.count(F.lit(1)).alias("n"), F.min("_ord_d").alias("a"), F.max("_ord_d").alias("b"))
                 .where((F.col("n") > per_bucket) & (F.col("a") < F.col("b"))).collect())  # one value alone cannot be parted
        more = set()
        for r in dense:
            m = 2 * (r["n"] // per_bucket + 1)
            more |= {x for i in range(1, m + 1) if r["a"] < (x := r["a"] + (r["b"] - r["a"]) * i / m)}
        if not more - set(splits):
            return splits
        splits = sorted(set(splits) | more)


def range_rank(df: DataFrame, order_col: str, partition_cols=(), per_bucket: int = ROWS_PER_BUCKET,
               name: str = "rank") -> DataFrame:
    """Exact rank by a numeric column (unique within a group) in its natural
    order. Buckets come from :func:`range_bounds`, so each (one sort task) holds
    at most about ``per_bucket`` rows whatever the distribution of the ids."""
    from pyspark.ml.feature import Bucketizer

    splits = range_bounds(df, order_col, per_bucket)
    c = F.col(order_col)
    d = df.withColumn("_ord_d", c.cast("double"))
    if splits:
        # binary search over the split points, JVM-side; bucket is monotone in the value
        d = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_ord_d",
                       outputCol="_ord_b", handleInvalid="keep").transform(d)
    else:  # one bucket: empty or constant input
        d = d.withColumn("_ord_b", F.lit(0.0))
    return exact_rank(d, [c], F.col("_ord_b"), partition_cols, name).drop("_ord_d", "_ord_b")


# --------------------------------------------------------------------------
# W1 / W2 splits
# --------------------------------------------------------------------------

CUT_DIGITS = 4  # hex digits of the hash that are counted; only the rows of one of 65,536 buckets are ranked


def hash_cuts(df: DataFrame, id_col: str, group_col: str, want: Column, seed: int = R.SEED) -> DataFrame:
    """Per group, the last (hash, id) that belongs to the first ``want`` rows
    of the seeded order: ``group_col, _cut_h, _cut_id`` (null: no row does).

    The input is read once: id, group and hash of its rows go to the checkpoint folder. Rows are counted per hash bucket (partial counts, ids and groups only),
    a running sum finds the bucket that holds the cut, and only that bucket's
    rows are ranked. ``want`` may use ``_n``, the group's row count, and
    ``_all``, an array of (group, count) of all groups.
    """
    d = df.select(F.col(group_col).alias("_g"), F.col(id_col).alias("_id"), seeded_hash(id_col, seed).alias("_hash"))
    ensure_checkpoint_dir(df.sparkSession)
    d = d.withColumn("_bucket", F.substring("_hash", 1, CUT_DIGITS)).checkpoint(eager=True)
    counts = d.groupBy("_g", "_bucket").agg(F.count(F.lit(1)).alias("_k"))
    total = counts.groupBy("_g").agg(F.sum("_k").alias("_n"))
    total = total.crossJoin(total.agg(F.collect_list(F.struct(F.col("_g").alias("g"), F.col("_n").alias("n"))).alias("_all")))  # one row a group
    total = total.select("_g", want.cast("long").alias("_want"))
    before = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = (counts.withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0))).join(total, "_g")
            .where("_before < _want and _before + _k >= _want"))
    inside = d.join(held.select("_g", "_bucket", (F.col("_want") - F.col("_before")).alias("_place")), ["_g", "_bucket"])
    ranked = inside.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_bucket").orderBy("_hash", "_id")))
    at_cut = ranked.where("_r = _place").select("_g", F.col("_hash").alias("_cut_h"), F.col("_id").alias("_cut_id"))
    # groups whose cut lies beyond their last row keep all of it
    rest = total.join(at_cut, "_g", "left").join(counts.groupBy("_g").agg(F.sum("_k").alias("_n")), "_g")
    return rest.select(F.col("_g").alias(group_col), "_cut_h", "_cut_id", (F.col("_want") >= F.col("_n")).alias("_every"))


def _sent(cuts: DataFrame) -> DataFrame:
    """One row a group, written and sent to every task: joined by a shuffle, the rows of a group would meet in one task."""
    from tonality.operators.similarity import checked_broadcast, materialize

    return checked_broadcast(materialize(cuts))


def _before_cut(df: DataFrame, id_col: str, seed: int) -> Column:
    h = seeded_hash(id_col, seed)
    return F.coalesce(F.col("_every"), F.lit(False)) | F.coalesce((h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(id_col) <= F.col("_cut_id"))), F.lit(False))


def split_exact(df: DataFrame, id_col: str = "id", group_col: str = "dataset", ratio=0.8,
                seed: int = R.SEED, split_col: str = "split") -> DataFrame:
    """Per group, the first ``floor(n * ratio)`` rows of the seeded order
    are ``train``, the rest ``test``. ``ratio`` may be a column or a dict
    (per-dataset ratios; groups that a dict lacks go to ``test``). The split is assigned before any label filtering, as in the
    original, so the ratio holds on the unfiltered rows.

    Rows with the same id go to the same side. The rows themselves are not shuffled: each is compared with its group's
    cut (see :func:`hash_cuts`; one row a group, measured and broadcast, so no task gets the rows of a whole group).
    """
    if isinstance(ratio, str):
        ratios = df.groupBy(F.col(group_col).alias("_rg")).agg(F.max(F.col(ratio).cast("double")).alias("r"))
        ratio = ratios.agg(F.map_from_entries(F.collect_list(F.struct("_rg", "r")))).first()[0] or {}  # one entry a dataset
    if isinstance(ratio, dict):
        ratios = {k: float(v) for k, v in ratio.items()}
        r = F.create_map(*[x for k, v in ratios.items() for x in (F.lit(k), F.lit(v))])[F.col("_g")] if ratios else F.lit(0.0)
        r = F.coalesce(r, F.lit(0.0))
    else:
        r = F.lit(float(ratio))
    cuts = hash_cuts(df, id_col, group_col, F.floor(F.col("_n").cast("double") * r), seed)
    return (df.join(_sent(cuts), group_col, "left").withColumn(split_col, F.when(_before_cut(df, id_col, seed), F.lit("train")).otherwise(F.lit("test")))
              .select(*df.columns, split_col))


def hash_threshold(ratio: float, digits: int = 8) -> str:
    """The hex prefix below which a row goes to train (W2), for 0 <= ratio < 1."""
    return format(int(ratio * 16 ** digits), f"0{digits}x")


def split_hash(df: DataFrame, id_col: str = "id", ratio: float = 0.8, seed: int = R.SEED,
               split_col: str = "split") -> DataFrame:
    """Stable per-row assignment without any shuffle: train when the
    first 8 hex digits of the seeded hash are below ``ratio * 16**8``."""
    if not 0 <= ratio < 1:  # no prefix of eight digits lies above every hash
        return df.withColumn(split_col, F.lit("train" if ratio >= 1 else "test"))
    h = F.substring(seeded_hash(id_col, seed), 1, 8)
    return df.withColumn(split_col, F.when(h < F.lit(hash_threshold(ratio)), F.lit("train")).otherwise(F.lit("test")))


# --------------------------------------------------------------------------
# W3 / W4 / W5 / W7
# --------------------------------------------------------------------------

def balance_undersample(df: DataFrame, id_col: str, label_col: str = "sentiment",
                        anchor: str = "negative", seed: int = R.SEED) -> DataFrame:
    """Keep every ``anchor`` row; keep the first ``n_anchor`` rows of the
    seeded order of every other class (all rows of a class that is smaller).

    Rows whose label is outside the label domain are not kept (they belong to
    the quarantine, see :func:`tonality.operators.retrieval.quarantine`).
    """
    d = df.where(F.col(label_col).isin(*R.LABELS))
    anchor_rows = F.coalesce(F.expr(f"get(filter(_all, x -> x.g = '{anchor}'), 0).n"), F.lit(0))
    cuts = hash_cuts(d, id_col, label_col, F.when(F.col("_g") == anchor, F.col("_n")).otherwise(anchor_rows), seed)
    return d.join(_sent(cuts), label_col).where(_before_cut(d, id_col, seed)).select(*d.columns)


def shuffle_rows(df: DataFrame, id_col: str, seed: int = R.SEED, pos_col: str = "pos") -> DataFrame:
    """Position of each row in the seeded random order (1-based)."""
    return hash_rank(df, id_col, (), seed, name=pos_col).drop("_group_n")


def sample_n(df: DataFrame, id_col: str, n: int = R.QUERY_SAMPLE_SIZE, seed: int = R.SEED) -> DataFrame:
    """The first ``n`` rows of the seeded order (a top-n: each partition
    keeps n rows, then one merge)."""
    h = seeded_hash(id_col, seed)
    return df.orderBy(h, F.col(id_col)).limit(n)


def batch_ids(df: DataFrame, order_col: str, batch_size: int = R.INFER_BATCH,
              partition_cols=(), batch_col: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``batch_size`` in ``order_col`` order."""
    ranked = range_rank(df, order_col, partition_cols, name="_pos")
    return (ranked.withColumn(batch_col, F.floor((F.col("_pos") - 1) / batch_size).cast("long"))
                  .withColumnRenamed("_pos", "position").drop("_group_n"))
