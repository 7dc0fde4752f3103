"""Weighted set-similarity join (J4 with token weights).

A token weighs ``round(1000 ln(1 + N / df))``, so shared rare words count more than
shared common ones; weights are integers and their sums exact. The overlap of two sets is the weight
of shared tokens over the weight of the lighter set.

Tokens of a set are ordered heaviest first (one order for all sets). For a
pair to pass at ``t`` it must share more than ``t * total`` of the lighter set, so:

* weighted prefix: a shared token must lie where the lighter set's remaining weight is still above ``t * total``;
* size bound: the prefix side is the lighter one, which is checked on the sets' total weights;
* position bound: from the first shared token on, no more can be shared than either set has left there.

Pairs that survive are verified on their whole sets. Totals are added up where the tokens are read; only sets
lighter than the heaviest query are sorted by weight. What is written are weights, totals, the queries' rows and pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.operators.similarity import _frequencies, checked_broadcast, materialize, token_rows

SCALE = 1000
def token_weights(contexts: DataFrame, c_id: str, c_text: str) -> tuple[DataFrame, int]:
    """((token, w), weight of an unseen token) from the document frequencies of ``contexts``."""
    n = contexts.count()
    often = _frequencies(token_rows(contexts, c_id, c_text))
    return often.select("token", F.round(SCALE * F.ln(1 + F.lit(n) / F.col("df"))).cast("long").alias("w")), n


def weighted_rows(df: DataFrame, id_col: str, text_col: str, weights: DataFrame, n: int) -> DataFrame:
    """(sid, token, w, total, left): a row a distinct token, with its set's weight and the weight from this token on."""
    unseen = F.round(SCALE * F.ln(F.lit(1.0 + n))).cast("long")
    rows = token_rows(df, id_col, text_col).join(checked_broadcast(weights), "token", "left").select("sid", "token", F.coalesce("w", unseen).alias("w"))
    own = Window.partitionBy("sid")
    rows = rows.withColumn("total", F.sum("w").over(own))
    before = F.sum("w").over(own.orderBy(F.col("w").desc(), "token").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("left", F.col("total") - F.coalesce(before, F.lit(0)))


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(F.col("sid").alias(name), "token", F.col("total").alias(f"total_{name}"), F.col("left").alias(f"left_{name}"))


def total_weights(df: DataFrame, id_col: str, text_col: str, weights: DataFrame, n: int) -> DataFrame:
    """(sid, total): the weight of each set that has a token. The rows of a set are added up where they are read."""
    unseen = F.round(SCALE * F.ln(F.lit(1.0 + n))).cast("long")
    return token_rows(df, id_col, text_col).join(checked_broadcast(weights), "token", "left").groupBy("sid").agg(F.sum(F.coalesce("w", unseen)).alias("total"))


def candidates(q_rows: DataFrame, c_rows: DataFrame, threshold: float) -> DataFrame:
    """Distinct (q, c) that pass prefix, size and position bounds. ``q_rows`` is materialised."""
    most = q_rows.agg(F.max("total")).first()[0] or 0
    prefix = F.col("left") > F.lit(threshold) * F.col("total")

    def one(light: DataFrame, heavy: DataFrame, a: str, b: str, lighter: Column) -> DataFrame:
        shared = light.join(heavy, "token").where(lighter)
        # the first shared token has the largest weight left, on either side
        first = shared.groupBy("q", "c").agg(F.max(f"left_{a}").alias("x"), F.max(f"left_{b}").alias("y"), F.first(f"total_{a}").alias("t"))
        return first.where(F.least("x", "y") > F.lit(threshold) * F.col("t")).select("q", "c")

    return one(checked_broadcast(_side(q_rows.where(prefix), "q")), _side(c_rows, "c"), "q", "c", F.col("total_q") <= F.col("total_c")).unionByName(
        one(_side(c_rows.where(prefix & (F.col("total") < most)), "c"), checked_broadcast(_side(q_rows, "q")), "c", "q", F.col("total_c") < F.col("total_q")))


def prefix_hits(q_rows: DataFrame, contexts: DataFrame, c_id: str, c_text: str, heavy: DataFrame, threshold: float) -> DataFrame:
    """Distinct (q, c) of the sets in ``heavy`` (no query is heavier) that hold a token of a query's prefix. The prefixes probe the contexts' tokens where they are read."""
    q_pre = q_rows.where(F.col("left") > F.lit(threshold) * F.col("total")).select(F.col("sid").alias("q"), "token")
    hits = token_rows(contexts, c_id, c_text).select(F.col("sid").alias("c"), "token").join(checked_broadcast(q_pre), "token").select("q", "c").distinct()
    return hits.join(heavy.select(F.col("sid").alias("c")), "c", "left_semi")


def weighted_overlap_join(queries: DataFrame, contexts: DataFrame, q_id: str, c_id: str, q_text: str = "text", c_text: str = "text",
                          threshold: float = 0.8) -> DataFrame:
    """All pairs whose weighted overlap is above ``threshold``: ``q_id, c_id, shared_weight, score``.

    Texts without a token have no pair. Ids are unique. Hot tokens (common words, light ones) are last in every order,
    beyond the prefixes. A pair is counted on the queries' tokens alone: a shared token has the weight it has in the query.
    """
    weights, n = token_weights(contexts, c_id, c_text)
    weights = materialize(weights)
    q_rows = materialize(weighted_rows(queries, q_id, q_text, weights, n))
    totals = materialize(total_weights(contexts, c_id, c_text, weights, n))
    # only contexts lighter than the heaviest query can be the lighter set of a pair; the others need no order of their own
    most = q_rows.agg(F.max("total")).first()[0] or 0
    light = contexts.join(checked_broadcast(totals.where(F.col("total") < most).select(F.col("sid").alias(c_id))), c_id, "left_semi")
    pairs = candidates(q_rows, weighted_rows(light, c_id, c_text, weights, n), threshold)
    pairs = materialize(pairs.unionByName(prefix_hits(q_rows, contexts, c_id, c_text, totals.where(F.col("total") >= most), threshold)))
    held = contexts.join(checked_broadcast(pairs.select(F.col("c").alias(c_id)).distinct()), c_id, "left_semi")
    asked = checked_broadcast(q_rows.select("token").distinct())
    c = token_rows(held, c_id, c_text).join(asked, "token", "left_semi").select(F.col("sid").alias("c"), "token")
    q = q_rows.select(F.col("sid").alias("q"), "token", "w", F.col("total").alias("tq"))
    both = c.join(checked_broadcast(pairs), "c").join(checked_broadcast(q), ["q", "token"])
    sums = both.groupBy("q", "c").agg(F.sum("w").alias("shared_weight"), F.first("tq").alias("tq"))
    out = sums.join(totals.select(F.col("sid").alias("c"), F.col("total").alias("tc")), "c").withColumn("_m", F.least("tq", "tc"))
    out = out.withColumn("score", F.col("shared_weight") / F.col("_m")).where(F.col("score") > threshold)
    return out.select(F.col("q").alias(q_id), F.col("c").alias(c_id), "shared_weight", "score")
