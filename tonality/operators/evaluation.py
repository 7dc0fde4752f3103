"""Prediction evaluation: distributions, confusion matrix and P/R/F1 metrics.

Every metric derives from one ``groupBy(true, pred).count()`` — a hash
aggregate with map-side partial counts, so the input is read once and only
(#labels)² rows leave the scan stage. Everything after that works on those
few rows. Labels are matched by name (never by position), and the label set
is the sorted union of true and predicted labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality import registry as R


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def pct_half_up(n: Column, total: Column, decimals: int) -> Column:
    """``round(100*n/total, decimals)`` rounded half-up on the exact ratio
    (integer arithmetic, so every engine gives the same digits); null when
    the total is 0."""
    scale = 10 ** decimals
    q = ((n.cast("long") * (200 * scale) + total.cast("long")) / (F.lit(2) * total.cast("long")))
    return F.when(total > 0, F.floor(q).cast("double") / F.lit(float(scale)))


# --------------------------------------------------------------------------
# A1-A4: distributions
# --------------------------------------------------------------------------

def distribution(df: DataFrame, col: str, decimals: int = 1, label_alias: str = "label") -> DataFrame:
    """A1/A2: count and percentage per observed value."""
    counts = df.groupBy(F.col(col).alias(label_alias)).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over the few aggregated rows only
    return counts.select(label_alias, "n", total.alias("total")).withColumn(
        "pct", pct_half_up(F.col("n"), F.col("total"), decimals))


def fixed_distribution(df: DataFrame, col: str, domain=R.LABELS, decimals: int = 2,
                       label_alias: str = "label") -> DataFrame:
    """Zero-filled counts over a fixed domain, percentage and total.
    Values outside the domain are not counted (see the quarantine)."""
    spark = df.sparkSession
    dom = spark.createDataFrame([(i, v) for i, v in enumerate(domain)], f"ord int, {label_alias} string")
    counts = df.groupBy(F.col(col).alias(label_alias)).agg(F.count(F.lit(1)).alias("_n"))
    out = (F.broadcast(dom).join(counts, label_alias, "left")
           .select("ord", label_alias, F.coalesce("_n", F.lit(0)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return out.withColumn("total", total).withColumn("pct", pct_half_up(F.col("n"), F.col("total"), decimals))


def balance_report(before: DataFrame, after: DataFrame, col: str = "sentiment") -> DataFrame:
    """A4: class counts before and after balancing, one table."""
    b = before.select(F.lit("before").alias("stage"), F.col(col).alias("sentiment"))
    a = after.select(F.lit("after").alias("stage"), F.col(col).alias("sentiment"))
    return b.unionByName(a).groupBy("stage", "sentiment").agg(F.count(F.lit(1)).alias("n"))


def split_report(df: DataFrame, dataset_col: str = "dataset", split_col: str = "split") -> DataFrame:
    """Rows per dataset × split with subtotals and the grand total."""
    return (df.rollup(dataset_col, split_col).agg(F.count(F.lit(1)).alias("n"))
              .select(F.coalesce(F.col(dataset_col), F.lit("ALL")).alias("dataset"),
                      F.coalesce(F.col(split_col), F.lit("ALL")).alias("split"), "n"))


# --------------------------------------------------------------------------
# Metrics from the confusion counts
# --------------------------------------------------------------------------

def confusion_counts(df: DataFrame, true_col: str = "expected_output",
                     pred_col: str = "predicted_label", materialized: bool = True) -> DataFrame:
    """The one aggregation everything else uses: (true, pred, n).

    The result has at most (#labels)² rows. It is materialised into the
    checkpoint folder (one pass over the predictions) so that every metric,
    matrix and chart built from it reads those few rows instead of
    re-running the aggregation over the input; ``materialized=False`` keeps
    it lazy (streaming).
    """
    counts = (df.groupBy(F.col(true_col).alias("true_label"), F.col(pred_col).alias("pred_label"))
                .agg(F.count(F.lit(1)).alias("n")))
    if not materialized:
        return counts
    from tonality.operators.similarity import materialize
    return materialize(counts)


def label_domain(counts: DataFrame) -> DataFrame:
    """K1/U4: sorted union of true and predicted labels."""
    return (counts.select(F.col("true_label").alias("label"))
                  .union(counts.select(F.col("pred_label").alias("label")))
                  .distinct().orderBy("label"))


def per_class_metrics(counts: DataFrame) -> DataFrame:
    """Per label precision, recall, F1, support and error rate.

    Undefined ratios are 0 (``zero_division=0``); the error rate exists only
    for labels that occur as true labels.
    """
    t = counts.groupBy(F.col("true_label").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)).alias("tp"))
    p = counts.groupBy(F.col("pred_label").alias("label")).agg(F.sum("n").alias("predicted"))
    dom = label_domain(counts).withColumnRenamed("label", "_l")
    j = (dom.join(t, F.col("_l").eqNullSafe(t["label"]), "left").drop("label").join(p, F.col("_l").eqNullSafe(p["label"]), "left")
            .select(F.col("_l").alias("label"), F.coalesce("tp", F.lit(0)).cast("long").alias("tp"),
                    F.coalesce("support", F.lit(0)).cast("long").alias("support"),
                    F.coalesce("predicted", F.lit(0)).cast("long").alias("predicted")))
    prec = _safe_div(F.col("tp"), F.col("predicted"))
    rec = _safe_div(F.col("tp"), F.col("support"))
    j = j.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    err = F.when(F.col("support") > 0, (F.col("support") - F.col("tp")) / F.col("support"))
    return j.withColumn("f1", f1).withColumn("error_rate", err)


def accuracy(counts: DataFrame) -> DataFrame:
    """A5: total rows, correct rows, accuracy and error rate (one row)."""
    a = counts.agg(F.sum("n").cast("long").alias("total"),
                   F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)).cast("long")
                   .alias("correct"))
    acc = F.when(F.col("total") > 0, F.col("correct") / F.col("total"))
    return a.withColumn("accuracy", acc).withColumn("error_rate", 1 - F.col("accuracy"))


def macro_metrics(per_class: DataFrame, scope: str = "union") -> DataFrame:
    """Unweighted mean over the label union (``scope='union'``, which
    reproduces the published figures — a predicted-only label counts with
    recall 0) or over true labels only (``'true_only'``)."""
    pc = per_class if scope == "union" else per_class.where(F.col("support") > 0)
    return pc.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))


def micro_metrics(counts: DataFrame) -> DataFrame:
    """Global TP / FP / FN; equals accuracy for single-label data."""
    a = counts.agg(F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)).alias("tp"),
                   F.sum("n").alias("total"))
    p = _safe_div(F.col("tp"), F.col("total"))
    return a.select(p.alias("precision"), p.alias("recall"), p.alias("f1"))


def weighted_metrics(per_class: DataFrame) -> DataFrame:
    """A10: support-weighted means of precision, recall and F1."""
    s = F.sum("support")
    return per_class.agg(*[_safe_div(F.sum(F.col(m) * F.col("support")), s).alias(m)
                           for m in ("precision", "recall", "f1")])


def confusion_matrix(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """A11 (long form): every (true, pred) of the sorted label union with its
    count, 0 where absent. The label union (a null label is one of them) is
    paired with itself inside the plan unless ``labels`` are given."""
    if labels is None:
        dom = label_domain(counts)
    else:
        dom = counts.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    grid = dom.select(F.col("label").alias("_t")).crossJoin(dom.select(F.col("label").alias("_p")))  # labels x labels
    found = F.col("_t").eqNullSafe(counts["true_label"]) & F.col("_p").eqNullSafe(counts["pred_label"])
    return (grid.join(counts, found, "left")
            .select(F.col("_t").alias("true_label"), F.col("_p").alias("pred_label"), F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def metrics_document(counts: DataFrame) -> DataFrame:
    """The nested metrics document as one row (accuracy, error rate,
    per-class map, macro, micro, dense confusion matrix)."""
    pc = per_class_metrics(counts)
    per_class = pc.where(F.col("label").isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(
        "label", F.struct("precision", "recall", "f1", "support", "error_rate")))).alias("per_class_metrics"))
    cm = confusion_matrix(counts)
    rows = (cm.groupBy("true_label")
              .agg(F.array_sort(F.collect_list(F.struct("pred_label", "n"))).alias("r"))
              .select("true_label", F.transform("r", lambda s: s["n"]).alias("row")))
    matrix = rows.agg(F.array_sort(F.collect_list(F.struct("true_label", "row"))).alias("m")).select(
        F.transform("m", lambda s: s["row"]).alias("confusion_matrix"))
    macro = macro_metrics(pc).select(F.struct("precision", "recall", "f1").alias("macro_metrics"))
    micro = micro_metrics(counts).select(F.struct("precision", "recall", "f1").alias("micro_metrics"))
    acc = accuracy(counts).select("accuracy", "error_rate")
    parts = [acc, per_class, macro, micro, matrix]
    # every part is one aggregated row: stack them (missing columns null) and
    # keep the one non-null value of each column — no join needed
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = [c for p in parts for c in p.columns]
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def chart_data(counts: DataFrame) -> DataFrame:
    """The numbers behind the report charts in long form
    (chart, series, label, value)."""
    pc = per_class_metrics(counts)
    bars = pc.select(F.lit("per_class").alias("chart"),
                     F.explode(F.array(*[F.struct(F.lit(m).alias("series"), F.col(m).cast("double").alias("value"))
                                         for m in ("precision", "recall", "f1")])).alias("s"), "label") \
             .select("chart", F.col("s.series").alias("series"), "label", F.col("s.value").alias("value"))
    mm = (macro_metrics(pc).select(F.lit("macro").alias("series"), "precision", "recall", "f1")
          .unionByName(micro_metrics(counts).select(F.lit("micro").alias("series"), "precision", "recall", "f1")))
    mm = mm.select(F.lit("macro_vs_micro").alias("chart"), "series",
                   F.explode(F.array(*[F.struct(F.lit(m).alias("label"), F.col(m).alias("value"))
                                       for m in ("precision", "recall", "f1")])).alias("s")) \
           .select("chart", "series", F.col("s.label").alias("label"), F.col("s.value").alias("value"))
    err = pc.where(F.col("support") > 0).select(F.lit("error_rate").alias("chart"), F.lit("error_rate").alias("series"),
                                               "label", F.col("error_rate").alias("value"))
    cm = confusion_matrix(counts).select(F.lit("confusion").alias("chart"), F.col("pred_label").alias("series"),
                                         F.col("true_label").alias("label"), F.col("n").cast("double").alias("value"))
    acc = accuracy(counts).select(F.lit("accuracy").alias("chart"), F.lit("accuracy").alias("series"),
                                  F.lit("all").alias("label"), F.col("accuracy").alias("value"))
    pie = counts.groupBy("pred_label").agg(F.sum("n").alias("n")).select(
        F.lit("prediction_pie").alias("chart"), F.lit("count").alias("series"), F.col("pred_label").alias("label"),
        F.col("n").cast("double").alias("value"))
    return reduce(DataFrame.unionByName, [bars, mm, err, cm, acc, pie])
