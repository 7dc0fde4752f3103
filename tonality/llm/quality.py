"""Quality rules: text statistics in DataFrame functions and a learned decision list.

Sequential covering grows one conjunction of thresholds after another for the
unwanted class on labelled statistics, prunes it on rows kept apart, and stops
when no rule is precise enough. The list is applied as one ordered conditional
expression. No Python runs on rows.

Defined results
  null or empty text: zero words, so the base rule fails; rows without a label are
  judged but teach nothing; without labels the list is empty and only the base
  rule decides; equal gains: the first statistic and the lowest threshold win;
  repeated rows and null ids keep their own rows; an empty table gives no rows.
  Only named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import materialise

WS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share", "line_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts of COUNTS, the ratios of RATIOS) of every whole text; no shuffle."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    a = t.select(
        "doc_id",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(WS)) != "").alias("lines"),
        F.length(_without(F.col("text"), WS)).cast("long").alias("word_chars"),
        *[(F.length("text") - F.length(_without(F.col("text"), chars))).cast("long").alias(name) for name, chars in (
            ("n_symbols", SYMBOLS), ("n_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("n_digits", "0123456789"), ("n_marks", "!?.,;:\"'()"))])
    b = a.select(
        "doc_id", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks",
        F.size("words").cast("long").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("h"))
    # hashes of windows of 2, 4 and 8 words, each from two of half the length
    for k in (1, 2, 4):
        pair = f"zip_with(slice(h, 1, size(h) - {k}), slice(h, {k + 1}, size(h) - {k}), (x, y) -> xxhash64(x, y))"
        b = b.withColumn("h", F.expr(f"if(size(h) > {k}, {pair}, array())"))
    c = b.withColumn("again", F.expr("size(array_distinct(h)) < size(h)"))
    # a window's whole hash beside its place: sorting brings equal windows together
    c = c.withColumn("h", F.expr("if(again, sort_array(transform(h, (x, i) -> struct(x as x, cast(i as bigint) as i))), array())"))
    c = c.withColumn("at", F.expr("sort_array(transform(filter(h, (w, k) -> (k > 0 and get(h, k - 1).x = w.x) or coalesce(get(h, k + 1).x = w.x, false)), w -> w.i))"))
    c = c.withColumn("n_repeat_words", F.expr(
        f"aggregate(transform(at, (x, i) -> if(i = 0, {WINDOW}L, least({WINDOW}L, x - get(at, i - 1)))), 0L, (s, x) -> s + x)"))
    n = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    return c.select(
        "doc_id", *COUNTS, (F.col("word_chars") / n).alias("mean_word"), (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"), (F.col("n_repeat_words") / n).alias("repeat_share"),
        (F.col("n_distinct") / n).alias("distinct_share"), (F.col("n_upper") / chars).alias("upper_share"), (F.col("n_digits") / chars).alias("digit_share"),
        (F.col("n_marks") / chars).alias("mark_share"), (F.col("n_words") / F.greatest("n_lines", F.lit(1))).alias("line_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


class Rule:
    """A conjunction of (statistic, is_upper_bound, threshold)."""

    def __init__(self, conditions=()):
        self.conditions = list(conditions)

    def column(self) -> Column:
        out = F.lit(True)
        for name, upper, at in self.conditions:
            out = out & (F.col(name) <= F.lit(at) if upper else F.col(name) > F.lit(at))
        return out

    def __str__(self):
        return " and ".join(f"{name} {'<=' if upper else '>'} {at:g}" for name, upper, at in self.conditions)


def _bin(name: str, edges: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < F.col(name))) if edges else F.lit(0)


def learn(labelled: DataFrame, features=RATIOS, bins: int = 40, max_rules: int = 8, max_conditions: int = 3,
          min_precision: float = 0.9, min_cover: int = 20) -> list[Rule]:
    """Ordered rules for ``bad`` = true, from a frame with ``features`` and the boolean ``bad``.

    Thresholds are the quantiles of each statistic in either class. The rows
    are reduced to bin numbers once; each growing step is one grouped count, of which
    at most features x bins rows reach the driver. A third of the rows (by hash)
    is kept for pruning.
    """
    names = list(features)
    grid = [F.percentile_approx(f, [(i + 0.5) / bins for i in range(bins)], 10_000).alias(f) for f in names]
    cuts: dict[str, set] = {f: set() for f in names}
    for r in labelled.groupBy("bad").agg(*grid).collect():
        for f in names:
            cuts[f] |= set(r[f] or ())
    edges = {f: sorted(cuts[f]) for f in names}
    # bin b of a statistic: the number of thresholds below the value, so value > edges[k] is b > k
    binned = labelled.select("bad", (F.pmod(F.xxhash64(*names), F.lit(3)) > 0).alias("grow"), *[
        _bin(f, edges[f]).alias(f) for f in names])
    rows = materialise(binned.groupBy("bad", "grow", *names).agg(F.count("*").alias("n")), "rules-bins")

    def holds(conditions) -> Column:
        out = F.lit(True)
        for f, upper, k in conditions:
            out = out & (F.col(f) <= k if upper else F.col(f) > k)
        return out

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        conditions: list[tuple[str, bool, int]] = []
        while len(conditions) < max_conditions:
            counts = (rows.where(left & holds(conditions) & F.col("grow"))
                      .select("bad", "n", F.posexplode(F.array(*names)).alias("f", "b"))
                      .groupBy("f", "b").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"),
                                             F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("good")).collect())
            best = _best_condition(counts, names, edges, min_cover)
            if best is None:
                break
            conditions.append(best)
        if not conditions:
            break
        kept = _prune(rows.where(left & ~F.col("grow")), conditions, holds)
        seen = rows.where(left & holds(kept)).agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n")).first()
        if not seen["n"] or seen["bad"] < min_cover or seen["bad"] < min_precision * seen["n"]:
            break
        rules.append(Rule((f, upper, edges[f][k]) for f, upper, k in kept))
        left = left & ~holds(kept)
    return rules


def _best_condition(counts, names, edges, min_cover):
    """The threshold of the highest FOIL gain over the rows counted, or None without a gain."""
    from math import log2

    by: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counts:
        by.setdefault(r["f"], {})[r["b"]] = (r["bad"], r["good"])
    total = [sum(x[i] for x in by.get(0, {}).values()) for i in (0, 1)]
    if total[0] < min_cover or not total[1]:
        return None
    start, best, gain = log2(total[0] / sum(total)), None, 1e-9
    for f in sorted(by):
        low = [0, 0]
        for k in range(len(edges[names[f]])):
            at = by[f].get(k, (0, 0))
            low = [low[0] + at[0], low[1] + at[1]]
            for upper, (bad, good) in ((True, low), (False, [total[0] - low[0], total[1] - low[1]])):
                if bad >= min_cover and (g := bad * (log2(bad / (bad + good)) - start)) > gain * (1 + 1e-9):
                    best, gain = (names[f], upper, k), g
    return best


def _prune(rows: DataFrame, conditions: list, holds) -> list:
    """Drop final conditions while that does not lower (bad - good) / (bad + good) on the rows kept apart."""
    sums = []
    for i in range(1, len(conditions) + 1):
        sums += [F.sum(F.when(holds(conditions[:i]) & (F.col("bad") if bad else ~F.col("bad")), F.col("n")).otherwise(0)).alias(f"{i}{bad}") for bad in (True, False)]
    r = rows.agg(*sums).first()
    value = lambda i: ((r[f"{i}True"] or 0) - (r[f"{i}False"] or 0)) / max(1, (r[f"{i}True"] or 0) + (r[f"{i}False"] or 0))
    return conditions[:max(range(1, len(conditions) + 1), key=lambda i: (round(value(i), 9), -i))]


def apply(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds base_failed, rule (the first that holds, else null) and kept."""
    rule = F.lit(None).cast("string")
    for r in reversed(rules):
        rule = F.when(r.column(), F.lit(str(r))).otherwise(rule)
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rule)
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics and verdict of every document; ``labels`` has doc_id and quality (0: unwanted)."""
    stats = materialise(text_counts(docs), "quality-stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias("bad")).where("doc_id is not null and bad is not null").distinct()
    rules = learn(stats.join(known, "doc_id"), **options)
    return apply(stats, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule")
