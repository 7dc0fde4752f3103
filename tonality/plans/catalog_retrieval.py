"""Registered queries, part 3: approximate retrieval, diverse contexts, time joins and ordered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonality import registry as R
from tonality.operators import ann as ANN
from tonality.operators import diversity as DV
from tonality.operators import ordered as OD
from tonality.operators import similarity as SIM
from tonality.plans import fixtures as FX
from tonality.plans import flows
from tonality.plans import sql as Q
from tonality.plans.catalog import r6, register
from tonality.plans.catalog_more import _RANK_SQL, KNN_K

# ==========================================================================
# approximate k-NN
# ==========================================================================

ANN_CELLS, ANN_REFINE = 32, 150


def _approximate(spark, sf):
    v = FX.fx_vec(spark, sf)
    index = ANN.build(v, "vec_id", "embedding", cells=ANN_CELLS)
    probes = ANN.calibrate(index, v, "vec_id", "embedding", KNN_K, target=0.95, exclude_self=True)
    return v, ANN.search(index, v, "vec_id", "embedding", KNN_K, probes=probes, refine=ANN_REFINE, exclude_self=True)


@register("knn_approximate")
def knn_approximate(spark, sf):
    return _approximate(spark, sf)[1].select("q_id", "c_id", "rank", r6(F.col("distance")).alias("distance"))


@register("knn_approximate_recall", "SELECT count(*) AS n_queries, true AS recall_at_least_090, true AS distances_equal FROM embeddings")
def knn_approximate_recall(spark, sf):
    v, found = _approximate(spark, sf)
    exact = SIM.knn_exact(v, v, "vec_id", "vec_id", "embedding", "embedding", KNN_K, exclude_self=True)
    return ANN.recall(found, exact).select("n_queries", (F.col("recall") >= 0.9).alias("recall_at_least_090"), "distances_equal")


# ==========================================================================
# diverse contexts
# ==========================================================================

MMR_MATCHES, MMR_K, MMR_SHARE = 20, 3, 0.7


def _cos(a, b, dims=64):
    dot = lambda x, y: f"list_sum(list_transform(range(1, {dims} + 1), lambda i: CAST({x}[i] AS DOUBLE) * CAST({y}[i] AS DOUBLE)))"
    return f"({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"


def _mmr_sql() -> str:
    """Greedy rounds unrolled: each picks a query's best match, given the picks before."""
    steps = [f"m AS (SELECT * FROM (SELECT q_id, c_id, row_number() OVER (PARTITION BY q_id, txt ORDER BY knn_rank) AS copy, 1 - distance / 2 AS rel, e FROM "
             f"(SELECT r.q_id, r.c_id, r.knn_rank, r.distance, c.text AS txt, c.embedding AS e FROM ({_RANK_SQL}) r JOIN fx_rag c ON c.id = r.c_id "
             f"WHERE r.knn_rank <= {MMR_MATCHES})) WHERE copy = 1)"]
    near = "0.0"
    for p in range(1, MMR_K + 1):
        joins = " ".join(f"JOIN p{i} ON p{i}.q_id = m.q_id AND p{i}.c_id <> m.c_id" for i in range(1, p))
        if p > 1:
            cosines = [_cos("m.e", f"p{i}.e") for i in range(1, p)]
            near = cosines[0] if p == 2 else f"greatest({', '.join(cosines)})"
        steps.append(f"p{p} AS (SELECT q_id, c_id, marginal, e FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY marginal DESC, c_id) AS place FROM "
                     f"(SELECT m.q_id, m.c_id, m.e, round({MMR_SHARE} * m.rel - {1 - MMR_SHARE} * {near}, {DV.DIGITS}) AS marginal FROM m {joins})) WHERE place = 1)")
    picks = " UNION ALL ".join(f"SELECT q_id, c_id, CAST({p} AS INTEGER) AS pick, round(marginal, 6) AS marginal FROM p{p}" for p in range(1, MMR_K + 1))
    return Q.with_("fx_rag").rstrip() + ", " + ", ".join(steps) + " " + picks


@register("diverse_contexts", _mmr_sql())
def diverse_contexts(spark, sf):
    qs, kb = flows.rag_sides(spark, sf)
    near = SIM.materialize(SIM.knn_exact(qs, kb, "id", "id", "embedding", "embedding", MMR_MATCHES))
    kept = DV.first_of_copies(near, kb, "id", "text").withColumn("relevance", 1 - F.col("distance") / 2)
    return DV.diverse_contexts(kept, kb, "id", "embedding", MMR_K, MMR_SHARE).select("q_id", "c_id", "pick", r6(F.col("marginal")).alias("marginal"))


# ==========================================================================
# time joins and ordered features over the event stream
# ==========================================================================

# source 0 holds a third of the events, the rest go to eight others
_SOURCE_SQL = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 8 + 1 END"
QUERY_TYPES, CONTEXT_TYPES = ("click", "view"), ("purchase", "signup", "error")
PER_BUCKET = 4096


def _events(spark, sf):
    e = FX.table(spark, sf, "events")
    return e.withColumn("source", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % 8 + 1).cast("long"))


def _in(types):
    return ", ".join(Q.q(t) for t in types)


@register("asof_context", f"SELECT q.event_id, q.source, c.event_id AS context_id, c.event_type AS context_type, round(c.value, 6) AS context_value FROM "
          f"(SELECT event_id, ts, CAST({_SOURCE_SQL} AS BIGINT) AS source FROM events WHERE event_type IN ({_in(QUERY_TYPES)})) q ASOF LEFT JOIN "
          f"(SELECT event_id, ts, event_type, value, CAST({_SOURCE_SQL} AS BIGINT) AS source FROM events WHERE event_type IN ({_in(CONTEXT_TYPES)})) c "
          "ON q.source = c.source AND q.ts >= c.ts")
def asof_context(spark, sf):
    e = _events(spark, sf)
    q = e.where(F.col("event_type").isin(*QUERY_TYPES)).select("event_id", "ts", "source")
    c = e.where(F.col("event_type").isin(*CONTEXT_TYPES)).select("event_id", "ts", "event_type", "value", "source")
    j = OD.asof_join(q, c, ["source"], "ts", "ts", "event_id", ["event_id", "event_type", "value"], per_bucket=PER_BUCKET)
    return j.select("event_id", "source", F.col("asof_event_id").alias("context_id"), F.col("asof_event_type").alias("context_type"), r6(F.col("asof_value")).alias("context_value"))


# a query looks back over its time window (up to decades); a context is valid for some hours
_BACK_SQL = "(user_id % 40 + 1) * CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 7 WHEN 2 THEN 30 ELSE 365 END"


@register("interval_contexts", f"SELECT q.event_id AS event_id, c.event_id AS context_id FROM "
          f"(SELECT event_id, user_id, ts - to_days(CAST({_BACK_SQL} AS INTEGER)) AS q_from, ts AS q_to FROM events WHERE event_type = 'click') q JOIN "
          "(SELECT event_id, user_id, ts AS v_from, ts + to_hours(CAST(event_id % 50 + 1 AS INTEGER)) AS v_to FROM events WHERE event_type = 'error') c "
          "ON q.user_id = c.user_id AND q.q_from < c.v_to AND c.v_from < q.q_to")
def interval_contexts(spark, sf):
    e = FX.table(spark, sf, "events")
    unit = F.element_at(F.array(*[F.lit(x) for x in (1, 7, 30, 365)]), (F.col("event_id") % 4 + 1).cast("int"))
    back = ((F.col("user_id") % 40 + 1) * unit).cast("int")
    q = e.where("event_type = 'click'").select("event_id", "user_id", (F.col("ts") - F.make_dt_interval(days=back)).alias("q_from"), F.col("ts").alias("q_to"))
    c = e.where("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("v_from"), (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 50 + 1).cast("int"))).alias("v_to"))
    return OD.interval_join(q, c, ["user_id"], ("q_from", "q_to"), ("v_from", "v_to")).select("event_id", F.col("r_event_id").alias("context_id"))


SESSION_GAP_S = 1800
_LABEL_SQL = "CASE user_id % 7 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'neutral' ELSE 'positive' END"


@register("label_stream", "SELECT event_id, source, CAST(position AS BIGINT) AS position, prev_label, next_label, gap, CAST(sum(opens) OVER w AS BIGINT) AS session, "
          + ", ".join(f"CAST(count(*) FILTER (sentiment = '{x}') OVER w AS BIGINT) AS n_{x}" for x in R.LABELS) + " FROM (SELECT *, CASE WHEN gap IS NULL OR gap > "
          f"{SESSION_GAP_S * 10**6} THEN 1 ELSE 0 END AS opens FROM (SELECT event_id, source, ts, sentiment, row_number() OVER v AS position, lag(sentiment) OVER v AS prev_label, "
          "lead(sentiment) OVER v AS next_label, epoch_us(ts) - lag(epoch_us(ts)) OVER v AS gap FROM "
          f"(SELECT event_id, ts, CAST({_SOURCE_SQL} AS BIGINT) AS source, {_LABEL_SQL} AS sentiment FROM events) WINDOW v AS (PARTITION BY source ORDER BY ts, event_id))) "
          "WINDOW w AS (PARTITION BY source ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def label_stream(spark, sf):
    m = F.col("user_id") % 7
    e = _events(spark, sf).select("event_id", "ts", "source", F.when(m == 0, "negative").when(m <= 2, "neutral").otherwise("positive").alias("sentiment"))
    f = OD.label_stream_features(e, ["source"], "ts", "event_id", "sentiment", list(R.LABELS), SESSION_GAP_S * 10**6, per_bucket=PER_BUCKET)
    return f.drop("ts", "sentiment")
