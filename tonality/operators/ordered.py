"""Ordered-frame features and time joins without a window over a whole source.

A source (any key) may hold a third of all rows, so nothing here sorts a source
in one task. Rows are cut into buckets of the order column that hold about
``per_bucket`` rows over all sources (:func:`tonality.operators.sampling.range_bounds`).
Windows run inside one (source, bucket); what a bucket needs from its
neighbours (sums so far, the last row before it, the first row after it) is
carried over a table of one row a (source, bucket) and joined back. That join has
the keys of the window, so the rows are shuffled once.

Null keys form a source of their own in features; in joins they match nothing,
as in SQL. Null order values stand before all others in features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.operators.sampling import ROWS_PER_BUCKET, range_bounds

KEY, BUCKET = "_key", "_bucket"


def as_number(df: DataFrame, name: str) -> Column:
    """An order column as a long: timestamps in microseconds, dates in days, integers as they are."""
    kind = dict(df.dtypes)[name]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return F.unix_date(name).cast("long")
    return F.col(name).cast("long")


def bucketed(df: DataFrame, order: str, per_bucket: int) -> DataFrame:
    """``df`` with ``_bucket``, monotone in the long column ``order``; nulls are in bucket -1."""
    from pyspark.ml.feature import Bucketizer

    splits = range_bounds(df, order, per_bucket)
    if not splits:
        return df.withColumn(BUCKET, F.when(F.col(order).isNull(), F.lit(-1)).otherwise(F.lit(0)))
    cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_ord_d", outputCol="_ord_b", handleInvalid="keep")
    out = cut.transform(df.withColumn("_ord_d", F.col(order).cast("double")))
    return out.withColumn(BUCKET, F.when(F.col(order).isNull(), F.lit(-1)).otherwise(F.col("_ord_b").cast("int"))).drop("_ord_d", "_ord_b")


def _inside(*order) -> Window:
    return Window.partitionBy(KEY, BUCKET).orderBy(*order)


def _so_far() -> Window:
    """All earlier buckets of a source, over the table of buckets."""
    return Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def label_stream_features(df: DataFrame, by: list[str], order: str, tie: str, label: str, labels: list[str],
                          session_gap: int, per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per row, in (``order``, ``tie``) order within its source: what a window over the whole source would give.

    Adds ``position`` (1-based), ``prev_label`` and ``next_label`` (lag and lead), ``gap`` (to the
    previous row, in the unit of :func:`as_number`), ``session`` (1-based; a gap above ``session_gap`` opens a new
    one) and ``n_<label>`` (running count, this row included) of each of ``labels``. ``tie`` is unique within a source.
    """
    d = bucketed(df.withColumn(KEY, F.struct(*by)).withColumn("_t", as_number(df, order)), "_t", per_bucket)
    w = _inside("_t", tie)
    rows = Window.unboundedPreceding, Window.currentRow
    here = F.struct(F.col("_t").alias("t"), F.col(tie).alias("tie"), F.col(label).alias("label"))
    d = d.withColumn("_prev", F.lag(here).over(w)).withColumn("_next", F.lead(here).over(w)).withColumn("_place", F.row_number().over(w))
    opens = F.col("_prev").isNotNull() & F.coalesce(F.col("_t") - F.col("_prev.t") > session_gap, F.lit(False))
    d = d.withColumn("_opens", opens.cast("long")).withColumn("_session", F.sum("_opens").over(w.rowsBetween(*rows)))
    for i, lab in enumerate(labels):
        d = d.withColumn(f"_n{i}", F.sum((F.col(label).eqNullSafe(F.lit(lab))).cast("long")).over(w.rowsBetween(*rows)))
    # one row a (source, bucket); the partitioning of the windows serves the aggregation too
    s = d.groupBy(KEY, BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("first"), F.max(here).alias("last"), F.sum("_opens").alias("opened"),
                                   *[F.max(f"_n{i}").alias(f"k{i}") for i in range(len(labels))])
    order_b = Window.partitionBy(KEY).orderBy(BUCKET)
    s = s.withColumn("before", F.lag("last").over(order_b)).withColumn("after", F.lead("first").over(order_b))
    s = s.withColumn("starts", (F.col("before").isNull() | F.coalesce(F.col("first.t") - F.col("before.t") > session_gap, F.lit(False))).cast("long"))
    s = s.select(KEY, BUCKET, "before", "after", "starts", F.coalesce(F.sum("n").over(_so_far()), F.lit(0)).alias("off"),
                 F.coalesce(F.sum(F.col("opened") + F.col("starts")).over(_so_far()), F.lit(0)).alias("sessions"),
                 *[F.coalesce(F.sum(f"k{i}").over(_so_far()), F.lit(0)).alias(f"k{i}") for i in range(len(labels))])
    out = d.join(s, [KEY, BUCKET])
    prev, nxt = F.coalesce("_prev", "before"), F.coalesce("_next", "after")
    return out.select(
        *[d[c] for c in df.columns], (F.col("off") + F.col("_place")).alias("position"), prev["label"].alias("prev_label"), nxt["label"].alias("next_label"),
        (F.col("_t") - prev["t"]).alias("gap"), (F.col("sessions") + F.col("starts") + F.col("_session")).alias("session"),
        *[(F.col(f"k{i}") + F.col(f"_n{i}")).alias(f"n_{lab}") for i, lab in enumerate(labels)])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, tie: str, take: list[str],
              prefix: str = "asof_", inclusive: bool = True, max_age: int | None = None, per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` of the same source at or before its time.

    ``take`` names the columns of ``right`` to add, as ``prefix + name`` (null where there is no row). Rows of equal
    time are ordered by ``tie``, a column of ``right`` unique within a source. ``inclusive=False`` asks for an
    earlier time; ``max_age`` (unit of :func:`as_number`) drops older matches. A null time or key has no match.

    Both sides are cut into common buckets; a bucket's last row of ``right`` is carried to the next ones.
    """
    some = F.struct(*[F.lit(None).cast(dict(right.dtypes)[c]).alias(c) for c in take])
    known = F.lit(True)
    for c in by:
        known = known & F.col(c).isNotNull()
    kinds = dict(right.dtypes)
    a = left.select(F.struct(*by).alias(KEY), as_number(left, left_time).alias("_t"), F.lit(1 if inclusive else 0).alias("_kind"), F.lit(None).cast(kinds[tie]).alias("_tie"),
                    F.lit(None).cast(f"struct<t:bigint,row:{some_type(right, take)}>").alias("_right"), F.struct(*left.columns).alias("_left"), known.alias("_known"))
    b = right.where(F.col(right_time).isNotNull() & known).select(
        F.struct(*by).alias(KEY), as_number(right, right_time).alias("_t"), F.lit(0 if inclusive else 1).alias("_kind"), F.col(tie).alias("_tie"),
        F.struct(as_number(right, right_time).alias("t"), F.struct(*take).alias("row")).alias("_right"),
        F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), F.lit(True).alias("_known"))
    # keys of both sides share one type, whatever the columns are called
    b = b.withColumn(KEY, F.col(KEY).cast(a.schema[KEY].dataType))
    d = bucketed(a.unionByName(b), "_t", per_bucket)
    w = _inside("_t", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_here", F.last("_right", ignorenulls=True).over(w))
    s = d.groupBy(KEY, BUCKET).agg(F.max_by("_right", F.when(F.col("_right").isNotNull(), F.struct("_t", "_tie"))).alias("_last"))
    s = s.select(KEY, BUCKET, F.last("_last", ignorenulls=True).over(_so_far()).alias("_carried"))
    out = d.where(F.col("_left").isNotNull()).join(s, [KEY, BUCKET])
    match = F.when(F.col("_known") & F.col("_t").isNotNull(), F.coalesce("_here", "_carried"))
    if max_age is not None:
        match = F.when(F.col("_t") - match["t"] <= max_age, match)
    out = out.select("_left", match.alias("_m"))
    return out.select("_left.*", *[F.col(f"_m.row.{c}").alias(prefix + c) for c in take])


def some_type(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return "struct<" + ",".join(f"{c}:{kinds[c]}" for c in names) + ">"


# --------------------------------------------------------------------------
# interval join
# --------------------------------------------------------------------------

def _level(start: Column, end: Column) -> Column:
    """Least j with 2^j >= end - start, for windows of length 1 or more."""
    n = end - start
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def interval_join(left: DataFrame, right: DataFrame, by: list[str], left_window: tuple[str, str], right_window: tuple[str, str],
                  prefix: str = "r_") -> DataFrame:
    """Pairs of rows of the same source whose windows [start, end) overlap; columns of ``right`` get ``prefix``.

    A window's home is the level j whose buckets, 2^j wide, are the narrowest not shorter than the window: it
    touches two of them at most, however long it is. At each wider level that is home to some window of the
    other side it is a visitor, again in two buckets at most. A pair meets at the wider of its two home levels, and
    only the bucket that holds its later start reports it. Visitors never meet visitors (the meeting is part of
    the join key), so a bucket's candidates are windows beside one about as wide as the bucket, and long windows don't fill
    the short ones' buckets. Rows with a null bound or key and windows without length have no pair.
    """
    def side(df, window, who):
        s, e = as_number(df, window[0]), as_number(df, window[1])
        d = df.select(F.struct(*by).alias(KEY), s.alias("_s"), e.alias("_e"), F.struct(*df.columns).alias(who))
        for c in by:
            d = d.where(F.col(f"{KEY}.{c}").isNotNull())
        return d.where("_e > _s").withColumn("_home", _level(F.col("_s"), F.col("_e")))

    a, b = side(left, left_window, "_l"), side(right, right_window, "_r")
    b = b.withColumn(KEY, F.col(KEY).cast(a.schema[KEY].dataType))
    levels = {x: sorted(r["_home"] for r in d.select("_home").distinct().collect()) for x, d in (("a", a), ("b", b))}  # at most 64 numbers

    def placed(d, others, meets_home, meets_visit):
        """A row for each (level, bucket, meeting): 1 home with home, 2 left at home, 3 right at home."""
        at = lambda lvl, meet: F.struct(lvl.cast("int").alias("level"), F.lit(meet).alias("meet"))
        visits = F.transform(F.filter(F.array(*[F.lit(x) for x in others]), lambda x: x > F.col("_home")), lambda x: at(x, meets_visit)) if others else F.array().cast("array<struct<level:int,meet:int>>")
        d = d.select("*", F.inline(F.concat(F.array(at(F.col("_home"), 1), at(F.col("_home"), meets_home)), visits)))
        first, last = F.expr("shiftright(_s, level)"), F.expr("shiftright(_e - 1, level)")
        return d.select("*", F.explode(F.sequence(first, last)).alias(BUCKET))

    a = placed(a, levels["b"], 2, 3)
    b = placed(b, levels["a"], 3, 2).select(KEY, "level", "meet", BUCKET, F.col("_s").alias("_s2"), F.col("_e").alias("_e2"), "_r")
    pairs = a.join(b, [KEY, "level", "meet", BUCKET]).where(
        (F.col("_s") < F.col("_e2")) & (F.col("_s2") < F.col("_e")) & (F.col(BUCKET) == F.expr("shiftright(greatest(_s, _s2), level)")))
    return pairs.select("_l.*", *[F.col(f"_r.{c}").alias(prefix + c) for c in right.columns])
