"""De-duplicated, diverse context lists: greedy maximal marginal relevance.

The original keeps every duplicate it retrieves. Here a query's list is chosen
greedily: next comes the match with the largest
``share * relevance - (1 - share) * (largest cosine to what is chosen)``.

Greedy choice needs a query's best match of the moment, not its list, so the
rounds run over all queries at once: each is one partial aggregate (best match a
query) and one join that brings the choice to the query's other matches, which
keep their largest cosine so far. No group of a query's matches is ever
collected, however many it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.operators.similarity import checked_broadcast, materialize

DIGITS = 9  # scores are rounded to so many digits before they are compared, so that engines agree on ties


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a, b) -> Column:
    """Cosine of two vectors; 0 where one of them has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def first_of_copies(matches: DataFrame, content: DataFrame, c_id: str, text: str) -> DataFrame:
    """Matches without those whose context has the text of a better match of the same query.

    Better is a smaller ``rank``. Texts are compared by their 256-bit digest; null texts are copies of nothing.
    """
    marks = content.select(F.col(c_id).alias("c_id"), F.coalesce(F.sha2(F.col(text).cast("binary"), 256), F.concat(F.lit("#"), F.col(c_id).cast("string"))).alias("_mark"))
    marked = matches.join(marks, "c_id")
    best = marked.groupBy("q_id", "_mark").agg(F.min(F.struct("rank", "c_id")).alias("_b")).select("q_id", F.col("_b.c_id").alias("c_id"))
    return matches.join(best, ["q_id", "c_id"], "left_semi")


def diverse_contexts(matches: DataFrame, vectors: DataFrame, c_id: str, c_vec: str, k: int, share: float = 0.7) -> DataFrame:
    """``q_id, c_id, pick, marginal``: the first ``k`` of each query's matches by greedy marginal relevance.

    ``matches`` has ``q_id``, ``c_id`` and ``relevance``; equal scores go to the smaller ``c_id``. A match without
    a vector, or with a null relevance, is left out; queries with fewer matches give fewer rows.
    """
    v = vectors.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("_v")).where("_v is not null")
    rest = matches.where("relevance is not null").select("q_id", "c_id", F.col("relevance").cast("double").alias("_rel")).join(v, "c_id")
    rest = materialize(rest.withColumn("_near", F.lit(0.0)))
    chosen = None
    for pick in range(1, k + 1):
        score = F.round(F.lit(share) * F.col("_rel") - F.lit(1 - share) * F.col("_near"), DIGITS)
        best = (rest.withColumn("_score", score).groupBy("q_id").agg(F.max_by(F.struct("c_id", "_v", "_score"), F.struct("_score", -F.col("c_id"))).alias("_b")))
        best = materialize(best.select("q_id", F.col("_b.c_id").alias("_c"), F.col("_b._v").alias("_pv"), F.lit(pick).alias("pick"), F.col("_b._score").alias("marginal")))
        chosen = best if chosen is None else chosen.unionByName(best)
        if pick == k:
            break
        joined = rest.join(checked_broadcast(best.select("q_id", "_c", "_pv")), "q_id").where(F.col("c_id") != F.col("_c"))
        near = cosine(F.col("_v"), F.col("_pv"))
        near = near if pick == 1 else F.greatest("_near", near)
        rest = materialize(joined.select("q_id", "c_id", "_rel", "_v", near.alias("_near")))
    return chosen.select("q_id", F.col("_c").alias("c_id"), "pick", "marginal")
