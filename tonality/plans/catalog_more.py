"""Registered queries, part 2: sampling, joins, retrieval, evaluation,
sources and the end-to-end flows (registered into ``catalog.QUERIES``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions import labels as L
from tonality.functions import text as T
from tonality.operators import evaluation as E
from tonality.operators import retrieval as RT
from tonality.operators import sampling as S
from tonality.operators import similarity as SIM
from tonality.plans import fixtures as FX
from tonality.plans import flows
from tonality.plans import sql as Q
from tonality.plans.catalog import _RECORDS_SQL, r6, records, register

# ==========================================================================
# 2.6 sampling / splitting
# ==========================================================================

_DATASETS_SQL = (
    f"SELECT 'fx_text' AS dataset, id, {Q.normalize_label('label')} AS output FROM fx_text UNION ALL "
    f"SELECT 'fx_num' AS dataset, id, coalesce({Q.map_numeric('label')}, 'unmapped') AS output FROM fx_num")
_SPLIT_SQL = (
    f"SELECT dataset, id, output, CASE WHEN row_number() OVER (PARTITION BY dataset ORDER BY {Q.md5key('id')}, id) "
    f"<= floor(count(*) OVER (PARTITION BY dataset) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split "
    f"FROM ({_DATASETS_SQL})")


@register("split_exact", Q.with_("fx_text", "fx_num") + f"SELECT dataset, id, split FROM ({_SPLIT_SQL})")
def split_exact(spark, sf):
    return flows.split_datasets(spark, sf).select("dataset", "id", "split")


@register("split_hash", Q.with_("fx_text") +
          f"SELECT id, CASE WHEN substring({Q.md5key('id')}, 1, 8) < '{S.hash_threshold(0.8)}' THEN 'train' "
          f"ELSE 'test' END AS split FROM fx_text")
def split_hash(spark, sf):
    return S.split_hash(FX.fx_text(spark, sf), "id", 0.8).select("id", "split")


@register("drop_unknown", Q.with_("fx_text", "fx_num") +
          f"SELECT dataset, id, split, output FROM ({_SPLIT_SQL}) WHERE output NOT IN ('unknown', 'unmapped')")
def drop_unknown(spark, sf):
    return flows.instruction_splits(spark, sf).select("dataset", "id", "split", "output")


@register("union_datasets", Q.with_("fx_text", "fx_num") +
          f"SELECT dataset, id, split, output FROM ({_SPLIT_SQL}) WHERE output NOT IN ('unknown', 'unmapped')")
def union_datasets(spark, sf):
    return flows.instruction_splits(spark, sf).select("dataset", "id", "split", "output")


@register("split_report", Q.with_("fx_text", "fx_num") +
          f"SELECT coalesce(dataset, 'ALL') AS dataset, coalesce(split, 'ALL') AS split, count(*) AS n FROM "
          f"({_SPLIT_SQL}) WHERE output NOT IN ('unknown', 'unmapped') GROUP BY ROLLUP (dataset, split)")
def split_report(spark, sf):
    return E.split_report(flows.instruction_splits(spark, sf))


_BALANCED_SQL = (
    "SELECT ctx_id, text, sentiment FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY "
    f"{Q.md5key('ctx_id')}, ctx_id) AS rk, sum(CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END) OVER () AS n_neg "
    "FROM fx_kb WHERE sentiment IN ('negative', 'neutral', 'positive')) WHERE sentiment = 'negative' OR rk <= n_neg")


@register("balance_undersample", Q.with_("fx_kb") + f"SELECT ctx_id, sentiment FROM ({_BALANCED_SQL})")
def balance_undersample(spark, sf):
    return S.balance_undersample(FX.fx_kb(spark, sf), "ctx_id", "sentiment").select("ctx_id", "sentiment")


@register("balance_report", Q.with_("fx_kb") +
          "SELECT 'before' AS stage, sentiment, count(*) AS n FROM fx_kb GROUP BY sentiment UNION ALL "
          f"SELECT 'after' AS stage, sentiment, count(*) AS n FROM ({_BALANCED_SQL}) GROUP BY sentiment")
def balance_report(spark, sf):
    kb = FX.fx_kb(spark, sf)
    return E.balance_report(kb, S.balance_undersample(kb, "ctx_id", "sentiment"))


@register("shuffle_rows", Q.with_("fx_kb") +
          f"SELECT ctx_id, row_number() OVER (ORDER BY {Q.md5key('ctx_id')}, ctx_id) AS pos FROM ({_BALANCED_SQL})")
def shuffle_rows(spark, sf):
    kb = S.balance_undersample(FX.fx_kb(spark, sf), "ctx_id", "sentiment")
    return S.shuffle_rows(kb, "ctx_id").select("ctx_id", "pos")


@register("sample_n", Q.with_("fx_query") + f"SELECT qid, text FROM fx_query ORDER BY {Q.md5key('qid')}, qid LIMIT 10")
def sample_n(spark, sf):
    return S.sample_n(FX.fx_query(spark, sf), "qid", R.QUERY_SAMPLE_SIZE).select("qid", "text")


@register("batch_ids", Q.with_("fx_text") +
          f"SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 32) AS BIGINT) AS batch_id FROM "
          f"({_RECORDS_SQL}) WHERE output <> 'unknown'")
def batch_ids(spark, sf):
    return S.batch_ids(records(spark, sf), "id", R.INFER_BATCH).select("id", "batch_id")


# ==========================================================================
# 2.4 joins and retrieval
# ==========================================================================

KNN_K = 10  # neighbours asked for by the k-NN queries

_KNN_SQL = ("SELECT q_id, c_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM (SELECT q.vec_id AS q_id, c.vec_id AS c_id, "
            f"{Q.sq_l2('q.embedding', 'c.embedding')} AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY "
            f"{Q.sq_l2('q.embedding', 'c.embedding')}, c.vec_id) AS rank FROM fx_vec q JOIN fx_vec c "
            f"ON q.vec_id <> c.vec_id) WHERE rank <= {KNN_K}")


@register("knn_exact", Q.with_("fx_vec") + _KNN_SQL)
def knn_exact(spark, sf):
    v = FX.fx_vec(spark, sf)
    k = SIM.knn_exact(v, v, "vec_id", "vec_id", "embedding", "embedding", KNN_K, exclude_self=True)
    return k.select("q_id", "c_id", "rank", r6(F.col("distance")).alias("distance"))


_RANK_SQL = ("SELECT q.id AS q_id, c.id AS c_id, "
             f"{Q.sq_l2('q.embedding', 'c.embedding')} AS distance, {Q.overlap(Q.token_set('q.instruction'), Q.token_set('c.text'))} AS score, "
             f"row_number() OVER (PARTITION BY q.id ORDER BY {Q.sq_l2('q.embedding', 'c.embedding')}, c.id) AS knn_rank "
             "FROM fx_rag q JOIN fx_rag c ON q.split = 'test' AND c.split = 'train'")


@register("retrieval_rank", Q.with_("fx_rag") +
          f"SELECT q_id, c_id, CAST(knn_rank AS INTEGER) AS rank FROM ({_RANK_SQL}) WHERE knn_rank <= {KNN_K}")
def retrieval_rank(spark, sf):
    qs, kb = flows.rag_sides(spark, sf)
    k = SIM.knn_exact(qs, kb, "id", "id", "embedding", "embedding", KNN_K)
    return k.select("q_id", "c_id", "rank")


_MATCH_SQL = (f"SELECT q_id, c_id, distance, score, row_number() OVER (PARTITION BY q_id ORDER BY distance, c_id) "
              f"AS rank FROM ({_RANK_SQL}) WHERE score > 0.8")


@register("retrieve_two_stage", Q.with_("fx_rag") +
          f"SELECT q_id, c_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, round(distance, 6) AS distance "
          f"FROM ({_MATCH_SQL})")
def retrieve_two_stage(spark, sf):
    m = flows.rag_matches(*flows.rag_sides(spark, sf))
    return m.select("q_id", "c_id", "rank", r6(F.col("score")).alias("score"), r6(F.col("distance")).alias("distance"))


_CUT_K = 150  # of a knowledge base of 400 at sf0.01 and 1,600 at sf0.1: the cut acts


@register("retrieve_two_stage_k", Q.with_("fx_rag") +
          f"SELECT q_id, c_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY distance, c_id) AS INTEGER) AS rank, "
          f"round(score, 6) AS score, round(distance, 6) AS distance FROM ({_RANK_SQL}) WHERE knn_rank <= {_CUT_K} AND score > 0.8")
def retrieve_two_stage_k(spark, sf):
    m = flows.rag_matches(*flows.rag_sides(spark, sf), k=_CUT_K)
    return m.select("q_id", "c_id", "rank", r6(F.col("score")).alias("score"), r6(F.col("distance")).alias("distance"))


@register("topk_contexts", Q.with_("fx_rag") + f"SELECT q_id, c_id, CAST(rank AS INTEGER) AS rank FROM ({_MATCH_SQL}) WHERE rank <= 3")
def topk_contexts(spark, sf):
    return RT.topk_contexts(flows.rag_matches(*flows.rag_sides(spark, sf)), 3).select("q_id", "c_id", "rank")


_CTX_SQL = (f"SELECT m.q_id, string_agg({Q.context_entry('c.text', 'c.sentiment')}, {Q.q(chr(10) * 2)} ORDER BY m.rank) "
            f"AS context, CAST(count(*) AS INTEGER) AS n_contexts FROM ({_MATCH_SQL}) m JOIN fx_rag c ON c.id = m.c_id GROUP BY m.q_id")


@register("assemble_context", Q.with_("fx_rag") + _CTX_SQL)
def assemble_context(spark, sf):
    qs, kb = flows.rag_sides(spark, sf)
    return RT.assemble_context(flows.rag_matches(qs, kb), kb, "id", "text", "sentiment")


_PROMPT_SQL = (f"SELECT q.id AS q_id, {Q.rag_prompt('coalesce(x.context, ' + chr(39) * 2 + ')', 'q.instruction')} AS prompt, "
               f"CAST(coalesce(x.n_contexts, 0) AS INTEGER) AS n_contexts FROM fx_rag q LEFT JOIN ({_CTX_SQL}) x ON x.q_id = q.id "
               f"WHERE q.split = 'test'")


@register("rag_prompt", Q.with_("fx_rag") + _PROMPT_SQL)
def rag_prompt(spark, sf):
    qs, kb = flows.rag_sides(spark, sf)
    return flows.rag_prompt_table(qs, kb, flows.rag_matches(qs, kb))


_VOTE_SQL = ("SELECT q.id AS q_id, coalesce(v.sentiment, 'unknown') AS vote, coalesce(v.votes, 0) AS votes "
             "FROM fx_rag q LEFT JOIN (SELECT q_id, sentiment, votes FROM (SELECT q_id, sentiment, votes, "
             "row_number() OVER (PARTITION BY q_id ORDER BY votes DESC, sentiment) AS r FROM (SELECT m.q_id, "
             f"c.sentiment, count(*) AS votes FROM ({_MATCH_SQL}) m JOIN fx_rag c ON c.id = m.c_id GROUP BY m.q_id, "
             "c.sentiment)) WHERE r = 1) v ON v.q_id = q.id WHERE q.split = 'test'")


@register("context_vote", Q.with_("fx_rag") + _VOTE_SQL)
def context_vote(spark, sf):
    qs, kb = flows.rag_sides(spark, sf)
    return flows.rag_votes(qs, kb, flows.rag_matches(qs, kb))


@register("overlap_join", f"SELECT q_id, c_id, n_shared, round(score, 6) AS score FROM (SELECT b.item_id AS q_id, "
                          f"d.doc_id AS c_id, CAST({Q.n_shared('qs', 'cs')} AS INTEGER) AS n_shared, {Q.overlap('qs', 'cs')} AS score "
                          f"FROM (SELECT item_id, {Q.token_set('text')} AS qs FROM benchmark) b, (SELECT doc_id, "
                          f"{Q.token_set('text')} AS cs FROM documents) d) WHERE score > 0.8")
def overlap_join(spark, sf):
    b = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("q_id"), "text")
    d = FX.table(spark, sf, "documents").select(F.col("doc_id").alias("c_id"), "text")
    j = SIM.overlap_join(b, d, "q_id", "c_id", "text", "text", 0.8)
    return j.select("q_id", "c_id", "n_shared", r6(F.col("score")).alias("score"))


_TITLE_SQL = (f"SELECT qid, page_id, url, source, source_order, title, query, cleaned_query, score FROM "
              f"(SELECT q.qid, q.query, q.cleaned_query, p.page_id, p.url, p.source, p.source_order, p.title, "
              f"{Q.similarity(Q.token_set('q.cleaned_query'), Q.token_set('p.title'))} AS score, p.threshold "
              f"FROM cleaned_queries q, page_titles p) WHERE score > threshold")


@register("title_similarity_join", Q.with_("cleaned_queries", "page_titles") +
          f"SELECT qid, page_id, source, round(score, 6) AS score FROM ({_TITLE_SQL})")
def title_similarity_join(spark, sf):
    return flows.title_matches(spark, sf).select("qid", "page_id", "source", r6(F.col("score")).alias("score"))


_ENRICHED_SQL = ("SELECT t.qid, t.query, t.cleaned_query, t.source, t.source_order, "
                 "CASE WHEN t.source = 'Twitter' THEN substring(t.title, 1, 100) || '...' ELSE t.title END AS title, t.url, "
                 f"CASE WHEN t.source = 'Twitter' THEN t.title ELSE p.context END AS context FROM ({_TITLE_SQL}) t JOIN "
                 f"(SELECT page_id, {Q.fx_article_text()} AS context FROM fx_pages) p "
                 f"ON p.page_id = t.page_id WHERE NOT (t.source = 'MarketWatch' AND contains(t.url, 'barrons.com'))")
_ENRICHED_NE = f"SELECT * FROM ({_ENRICHED_SQL}) WHERE context <> ''"


@register("enrich_articles", Q.with_("cleaned_queries", "page_titles", "fx_pages") +
          f"SELECT qid, source, url, context FROM ({_ENRICHED_NE})")
def enrich_articles(spark, sf):
    return flows.enriched(spark, sf).select("qid", "source", "url", "context")


@register("union_sources", Q.with_("cleaned_queries", "page_titles") +
          f"SELECT source_order, source, qid, url FROM ({_ENRICHED_NE})")
def union_sources(spark, sf):
    return flows.enriched(spark, sf).select("source_order", "source", "qid", "url")


@register("retrieved_records", Q.with_("cleaned_queries", "page_titles") +
          f"SELECT query, cleaned_query, source, title, url, context FROM ({_ENRICHED_NE})")
def retrieved_records(spark, sf):
    r = RT.retrieved_records(flows.enriched(spark, sf))
    return r.select("query", "cleaned_query", "retrieved.source", "retrieved.title", "retrieved.url",
                    "retrieved.context")


@register("source_stats", Q.with_("cleaned_queries", "page_titles") +
          f"SELECT s.source, coalesce(c.n, 0) AS n, CAST(sum(coalesce(c.n, 0)) OVER () AS BIGINT) AS total, "
          f"{Q.pct('coalesce(c.n, 0)', 'sum(coalesce(c.n, 0)) OVER ()', 2)} AS pct FROM {Q.sources_values()} s "
          f"LEFT JOIN (SELECT source, count(*) AS n FROM ({_ENRICHED_NE}) GROUP BY source) c ON c.source = s.source")
def source_stats(spark, sf):
    return RT.source_stats(flows.enriched(spark, sf)).select("source", "n", "total", "pct")


_FAN_SQL = (f"SELECT f.event_id, s.source, CASE WHEN f.w > 0 AND s.date_op IS NOT NULL THEN f.c || ' ' || s.date_op "
            f"|| ':' || strftime(DATE '{FX.AS_OF}' - f.w, '%Y-%m-%d') ELSE f.c END AS search_string, s.url_template "
            f"FROM (SELECT event_id, c, {Q.time_window('c', lower=False)} AS w FROM (SELECT event_id, "
            f"{Q.clean_query_text('phrase')} AS c FROM fx_time)) f, {Q.sources_values()} s")


@register("source_fanout", Q.with_("fx_time") + f"SELECT event_id, source, search_string FROM ({_FAN_SQL})")
def source_fanout(spark, sf):
    return flows.fanout(spark, sf).select("event_id", "source", "search_string")


@register("search_string", Q.with_("fx_time") + f"SELECT event_id, source, search_string FROM ({_FAN_SQL})")
def search_string(spark, sf):
    return flows.fanout(spark, sf).select("event_id", "source", "search_string")


@register("search_url", Q.with_("fx_time") +
          f"SELECT event_id, source, replace(url_template, '{{q}}', {Q.percent_encode('search_string')}) AS search_url "
          f"FROM ({_FAN_SQL})")
def search_url(spark, sf):
    return flows.fanout(spark, sf).select("event_id", "source", "search_url")


@register("pair_predictions", Q.with_("fx_pred", "fx_text") +
          f"SELECT r.id, r.output AS expected_output, p.predicted_label FROM ({_RECORDS_SQL}) r JOIN fx_pred p "
          f"ON p.id = r.id WHERE r.output <> 'unknown'")
def pair_predictions(spark, sf):
    p = FX.fx_predictions(spark, sf).select("id", "predicted_label")
    return records(spark, sf).select("id", F.col("output").alias("expected_output")).join(p, "id")


@register("quarantine", Q.with_("fx_num") +
          f"SELECT id, label, 'unmapped label' AS reject_reason FROM fx_num WHERE {Q.map_numeric('label')} IS NULL")
def quarantine(spark, sf):
    n = FX.fx_num(spark, sf)
    _, bad = RT.quarantine(n, L.map_numeric_label("label").isNotNull(), "unmapped label")
    return bad.select("id", "label", "reject_reason")


@register("time_window_filter", f"SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'")
def time_window_filter(spark, sf):
    e = FX.table(spark, sf, "events")
    return RT.time_window_filter(e, "ts", FX.AS_OF, 7).select("event_id", "user_id")


# ==========================================================================
# 2.5 evaluation (over fx_pred)
# ==========================================================================

_COUNTS_SQL = "SELECT expected_output AS true_label, predicted_label AS pred_label, count(*) AS n FROM fx_pred GROUP BY 1, 2"


def _domain_sql(counts: str) -> str:
    return f"SELECT DISTINCT label FROM (SELECT true_label AS label FROM ({counts}) UNION ALL SELECT pred_label FROM ({counts}))"


def _pc_sql(counts: str) -> str:
    return (
        "SELECT label, tp, support, predicted, precision, recall, CASE WHEN precision + recall > 0 THEN "
        "2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, CASE WHEN support > 0 THEN "
        "(support - tp) / support END AS error_rate FROM (SELECT label, tp, support, predicted, CASE WHEN predicted <> 0 "
        "THEN tp / predicted ELSE 0.0 END AS precision, CASE WHEN support <> 0 THEN tp / support ELSE 0.0 END AS recall "
        "FROM (SELECT d.label, CAST(coalesce(t.tp, 0) AS BIGINT) AS tp, CAST(coalesce(t.support, 0) AS BIGINT) AS support, "
        f"CAST(coalesce(p.predicted, 0) AS BIGINT) AS predicted FROM ({_domain_sql(counts)}) d LEFT JOIN (SELECT true_label, "
        f"sum(n) AS support, sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) AS tp FROM ({counts}) "
        f"GROUP BY true_label) t ON t.true_label = d.label LEFT JOIN (SELECT pred_label, sum(n) AS predicted FROM "
        f"({counts}) GROUP BY pred_label) p ON p.pred_label = d.label))")


_DOMAIN_SQL = _domain_sql(_COUNTS_SQL)
_PC_SQL = _pc_sql(_COUNTS_SQL)


def _counts(spark, sf):
    return E.confusion_counts(FX.fx_predictions(spark, sf))


@register("label_distribution", Q.with_("fx_text") +
          f"SELECT output AS label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total, "
          f"{Q.pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct FROM ({_RECORDS_SQL}) WHERE output <> 'unknown' "
          f"GROUP BY output")
def label_distribution(spark, sf):
    return E.distribution(records(spark, sf), "output", 1)


@register("prediction_distribution", Q.with_("fx_pred") +
          f"SELECT predicted_label AS label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total, "
          f"{Q.pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct FROM fx_pred GROUP BY predicted_label")
def prediction_distribution(spark, sf):
    return E.distribution(FX.fx_predictions(spark, sf), "predicted_label", 1)


@register("sentiment_distribution", Q.with_("fx_kb", "fx_lines") +
          "SELECT d.label, coalesce(c.n, 0) AS n, CAST(sum(coalesce(c.n, 0)) OVER () AS BIGINT) AS total, "
          f"{Q.pct('coalesce(c.n, 0)', 'sum(coalesce(c.n, 0)) OVER ()', 2)} AS pct FROM "
          "(SELECT * FROM (VALUES ('negative'), ('neutral'), ('positive')) t(label)) d LEFT JOIN "
          f"(SELECT {Q.rsplit_label('line')} AS s, count(*) AS n FROM fx_lines WHERE length({Q.ustrip('line')}) > 0 "
          "GROUP BY 1) c ON c.s = d.label")
def sentiment_distribution(spark, sf):
    ln = FX.fx_lines(spark, sf).where(F.length(T.ustrip("line")) > 0).select(T.rsplit_label("line").alias("s"))
    return E.fixed_distribution(ln, "s", R.LABELS, 2).select("label", "n", "total", "pct")


@register("accuracy", Q.with_("fx_pred") +
          "SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) AS BIGINT) "
          "AS correct, round(sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n), 6) AS accuracy, "
          "round(1 - sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n), 6) AS error_rate "
          f"FROM ({_COUNTS_SQL})")
def accuracy(spark, sf):
    a = E.accuracy(_counts(spark, sf))
    return a.select("total", "correct", r6(F.col("accuracy")).alias("accuracy"), r6(F.col("error_rate")).alias("error_rate"))


@register("per_class_metrics", Q.with_("fx_pred") +
          f"SELECT label, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, "
          f"round(f1, 6) AS f1 FROM ({_PC_SQL})")
def per_class_metrics(spark, sf):
    pc = E.per_class_metrics(_counts(spark, sf))
    return pc.select("label", "tp", "support", "predicted", *[r6(F.col(m)).alias(m) for m in ("precision", "recall", "f1")])


@register("class_error_rates", Q.with_("fx_pred") +
          f"SELECT label, round(error_rate, 6) AS error_rate FROM ({_PC_SQL}) WHERE support > 0")
def class_error_rates(spark, sf):
    pc = E.per_class_metrics(_counts(spark, sf))
    return pc.where("support > 0").select("label", r6(F.col("error_rate")).alias("error_rate"))


@register("macro_metrics", Q.with_("fx_pred") +
          f"SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM ({_PC_SQL})")
def macro_metrics(spark, sf):
    m = E.macro_metrics(E.per_class_metrics(_counts(spark, sf)))
    return m.select(*[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@register("micro_metrics", Q.with_("fx_pred") +
          "SELECT round(a, 6) AS precision, round(a, 6) AS recall, round(a, 6) AS f1 FROM (SELECT "
          f"sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n) AS a FROM ({_COUNTS_SQL}))")
def micro_metrics(spark, sf):
    m = E.micro_metrics(_counts(spark, sf))
    return m.select(*[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@register("weighted_metrics", Q.with_("fx_pred") +
          "SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / "
          f"sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM ({_PC_SQL})")
def weighted_metrics(spark, sf):
    m = E.weighted_metrics(E.per_class_metrics(_counts(spark, sf)))
    return m.select(*[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@register("confusion_matrix", Q.with_("fx_pred") +
          f"SELECT t.label AS true_label, p.label AS pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM ({_DOMAIN_SQL}) t "
          f"CROSS JOIN ({_DOMAIN_SQL}) p LEFT JOIN ({_COUNTS_SQL}) c ON c.true_label = t.label AND c.pred_label = p.label")
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_counts(spark, sf))


@register("label_domain", Q.with_("fx_pred") + _DOMAIN_SQL)
def label_domain(spark, sf):
    return E.label_domain(_counts(spark, sf))


@register("domain_union", Q.with_("fx_pred") +
          "SELECT label FROM (SELECT expected_output AS label FROM fx_pred UNION SELECT predicted_label FROM fx_pred)")
def domain_union(spark, sf):
    p = FX.fx_predictions(spark, sf)
    return p.select(F.col("expected_output").alias("label")).union(p.select("predicted_label")).distinct()


@register("chart_data", Q.with_("fx_pred") + f"""
SELECT 'per_class' AS chart, m.series, label, round(m.value, 6) AS value FROM ({_PC_SQL}) pc,
  LATERAL (SELECT * FROM (VALUES ('precision', pc.precision), ('recall', pc.recall), ('f1', pc.f1)) v(series, value)) m
UNION ALL SELECT 'macro_vs_micro', 'macro', v.label, round(v.value, 6) FROM
  (SELECT avg(precision) AS p, avg(recall) AS r, avg(f1) AS f FROM ({_PC_SQL})) a,
  LATERAL (SELECT * FROM (VALUES ('precision', a.p), ('recall', a.r), ('f1', a.f)) x(label, value)) v
UNION ALL SELECT 'macro_vs_micro', 'micro', v.label, round(v.value, 6) FROM
  (SELECT sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n) AS acc FROM ({_COUNTS_SQL})) a,
  LATERAL (SELECT * FROM (VALUES ('precision', a.acc), ('recall', a.acc), ('f1', a.acc)) x(label, value)) v
UNION ALL SELECT 'error_rate', 'error_rate', label, round(error_rate, 6) FROM ({_PC_SQL}) WHERE support > 0
UNION ALL SELECT 'confusion', p.label, t.label, CAST(coalesce(c.n, 0) AS DOUBLE) FROM ({_DOMAIN_SQL}) t
  CROSS JOIN ({_DOMAIN_SQL}) p LEFT JOIN ({_COUNTS_SQL}) c ON c.true_label = t.label AND c.pred_label = p.label
UNION ALL SELECT 'accuracy', 'accuracy', 'all', round(sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n), 6)
  FROM ({_COUNTS_SQL})
UNION ALL SELECT 'prediction_pie', 'count', pred_label, CAST(sum(n) AS DOUBLE) FROM ({_COUNTS_SQL}) GROUP BY pred_label""")
def chart_data(spark, sf):
    c = E.chart_data(_counts(spark, sf))
    return c.select("chart", "series", "label", r6(F.col("value")).alias("value"))


_ACC_SQL = f"(SELECT sum(CASE WHEN true_label = pred_label THEN n ELSE 0 END) / sum(n) AS a FROM ({_COUNTS_SQL}))"


@register("metrics_document", Q.with_("fx_pred") + f"""
SELECT 'accuracy' AS path, round(a, 6) AS value FROM {_ACC_SQL} UNION ALL SELECT 'error_rate', round(1 - a, 6) FROM {_ACC_SQL}
UNION ALL SELECT 'micro_metrics.' || v.m, round(a, 6) FROM {_ACC_SQL}, (VALUES ('precision'), ('recall'), ('f1')) v(m)
UNION ALL SELECT 'macro_metrics.' || v.m, round(v.x, 6) FROM (SELECT avg(precision) AS p, avg(recall) AS r, avg(f1) AS f FROM ({_PC_SQL})) t,
  LATERAL (SELECT * FROM (VALUES ('precision', t.p), ('recall', t.r), ('f1', t.f)) y(m, x)) v
UNION ALL SELECT 'per_class_metrics.' || label || '.' || v.m, round(v.x, 6) FROM ({_PC_SQL}) t, LATERAL (SELECT * FROM
  (VALUES ('precision', t.precision), ('recall', t.recall), ('f1', t.f1), ('support', CAST(t.support AS DOUBLE)), ('error_rate', t.error_rate)) y(m, x)) v
UNION ALL SELECT 'confusion_matrix.' || t.i || '.' || p.i, CAST(coalesce(c.n, 0) AS DOUBLE) FROM
  (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM ({_DOMAIN_SQL})) t CROSS JOIN
  (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM ({_DOMAIN_SQL})) p
  LEFT JOIN ({_COUNTS_SQL}) c ON c.true_label = t.label AND c.pred_label = p.label""")
def metrics_document(spark, sf):
    """The document written by the sink, read back and flattened to (path, value)."""
    d = flows.metrics_roundtrip(spark, E.metrics_document(_counts(spark, sf)))
    path = lambda *parts: F.concat_ws(".", *[p if not isinstance(p, str) else F.lit(p) for p in parts]).alias("path")
    value = lambda c: c.cast("double").alias("value")
    three = ("precision", "recall", "f1")
    flat = [F.struct(path(m), value(F.col(m))) for m in ("accuracy", "error_rate")]
    flat += [F.struct(path(g, m), value(F.col(f"{g}.{m}"))) for g in ("macro_metrics", "micro_metrics") for m in three]
    one = d.select(F.inline(F.array(*flat)))
    per = d.select(F.explode("per_class_metrics").alias("label", "s")).select(F.inline(F.array(*[
        F.struct(path("per_class_metrics", F.col("label"), m), value(F.col(f"s.{m}"))) for m in (*three, "support", "error_rate")])))
    cells = (d.select(F.posexplode("confusion_matrix").alias("i", "row")).select("i", F.posexplode("row").alias("j", "n"))
             .select(path("confusion_matrix", F.col("i").cast("string"), F.col("j").cast("string")), value(F.col("n"))))
    return one.unionByName(per).unionByName(cells).select("path", r6(F.col("value")).alias("value"))


# ==========================================================================
# 2.1 sources and sinks
# ==========================================================================

@register("scan_dataset", Q.with_("fx_text") + "SELECT id, text, label, 'fx_text' AS dataset FROM fx_text")
def scan_dataset(spark, sf):
    from tonality.sources.io import read_dataset
    return read_dataset(spark, flows.dataset_specs(spark, sf)[0]).select("id", "text", "label", "dataset")


@register("map_fields", "SELECT doc_id AS id, text, source AS label FROM documents")
def map_fields(spark, sf):
    from tonality.sources.io import read_dataset
    spec = R.DatasetSpec(name="documents", path=f"{sf}/documents.parquet", id_field="doc_id", input_field="text",
                         output_field="source")
    return read_dataset(spark, spec).select("id", "text", "label")


@register("scan_multi", Q.with_("fx_text", "fx_num") +
          f"SELECT 'fx_text' AS dataset, id, {Q.normalize_label('label')} AS label FROM fx_text UNION ALL "
          f"SELECT 'fx_num' AS dataset, id, {Q.map_numeric('label')} AS label FROM fx_num")
def scan_multi(spark, sf):
    from tonality.sources.io import read_multi
    return read_multi(spark, flows.dataset_specs(spark, sf)).select("dataset", "id", "label")


@register("scan_jsonl", Q.with_("fx_text") + f"SELECT id, instruction, output FROM ({_RECORDS_SQL}) WHERE output <> 'unknown'")
def scan_jsonl(spark, sf):
    return flows.jsonl_roundtrip(spark, records(spark, sf))


@register("sink_jsonl", Q.with_("fx_pred") +
          "SELECT id, instruction, expected_output, model_output, predicted_label FROM fx_pred")
def sink_jsonl(spark, sf):
    p = FX.fx_predictions(spark, sf).select("id", "instruction", "expected_output", "model_output", "predicted_label")
    return flows.jsonl_roundtrip(spark, p)


@register("scan_phrasebank", Q.with_("fx_kb", "fx_lines") +
          f"SELECT {Q.rsplit_text('line')} AS text, {Q.rsplit_label('line')} AS sentiment FROM fx_lines "
          f"WHERE length({Q.ustrip('line')}) > 0")
def scan_phrasebank(spark, sf):
    return flows.phrasebank_roundtrip(spark, FX.fx_lines(spark, sf))


@register("scan_json_array", Q.with_("fx_kb") +
          f"SELECT text, sentiment, {Q.q(R.KB_METADATA_SOURCE)} AS meta_source, {Q.q(R.KB_METADATA_TYPE)} AS meta_type FROM fx_kb")
def scan_json_array(spark, sf):
    kb = RT.kb_records(FX.fx_kb(spark, sf)).select("text", "sentiment", "metadata")
    back = flows.json_array_roundtrip(spark, kb)
    return back.select("text", "sentiment", F.col("metadata.source").alias("meta_source"),
                       F.col("metadata.type").alias("meta_type"))


@register("sink_kb", Q.with_("fx_kb") +
          f"SELECT text, sentiment, {Q.q(R.KB_METADATA_SOURCE)} AS meta_source, {Q.q(R.KB_METADATA_TYPE)} AS meta_type "
          f"FROM ({_BALANCED_SQL})")
def sink_kb(spark, sf):
    kb = RT.kb_records(S.balance_undersample(FX.fx_kb(spark, sf), "ctx_id", "sentiment"))
    back = flows.kb_roundtrip(spark, kb)
    return back.select("text", "sentiment", F.col("metadata.source").alias("meta_source"),
                       F.col("metadata.type").alias("meta_type"))


# ==========================================================================
# 2.10 model-shaped steps and the flagship
# ==========================================================================

_FLAG_COUNTS = ("SELECT q.sentiment AS true_label, v.vote AS pred_label, count(*) AS n FROM "
                f"({_VOTE_SQL}) v JOIN fx_rag q ON q.id = v.q_id GROUP BY 1, 2")


@register("flagship", Q.with_("fx_rag") +
          f"SELECT label, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, "
          f"round(f1, 6) AS f1 FROM ({_pc_sql(_FLAG_COUNTS)})")
def flagship(spark, sf):
    return flows.flagship(spark, sf)


@register("batch_score", Q.with_("fx_rag") +
          f"SELECT q_id, CASE WHEN votes > 0 THEN 'Sentiment: ' || vote ELSE '' END AS model_output, "
          f"CASE WHEN votes > 0 THEN vote ELSE 'unknown' END AS predicted_label FROM ({_VOTE_SQL})")
def batch_score(spark, sf):
    return flows.scored_prompts(spark, sf).select("q_id", "model_output", "predicted_label")


EMBED_DIMS = 256

# Every stage of the featuriser from its definition: buckets, document frequencies, weights, norm.
_EMBED_SQL = (
    f"tok AS (SELECT ctx_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {EMBED_DIMS} AS dim, count(*) AS tf FROM "
    f"(SELECT ctx_id, unnest({Q.tokens('text')}) AS t FROM fx_kb) GROUP BY ALL), "
    f"idf AS (SELECT dim, ln(((SELECT count(*) FROM fx_kb) + 1.0) / (count(*) + 1.0)) AS w FROM tok GROUP BY dim), "
    f"raw AS (SELECT ctx_id, dim, tf * w AS x FROM tok JOIN idf USING (dim)), "
    f"unit AS (SELECT ctx_id, dim, CAST(CAST(CASE WHEN len > 0 THEN x / len ELSE 0 END AS FLOAT) AS DOUBLE) AS x FROM "
    f"(SELECT *, sqrt(sum(x * x) OVER (PARTITION BY ctx_id)) AS len FROM raw)) ")


@register("embed_text", Q.with_("fx_kb") + ", " + _EMBED_SQL +
          f"SELECT k.ctx_id, {EMBED_DIMS} AS dims, CAST(count(x) FILTER (x > 0) AS INTEGER) AS n_nonzero, {Q.r6('sqrt(coalesce(sum(x * x), 0))')} AS norm, "
          f"round(coalesce(sum(x * (dim + 1)), 0), 4) AS moment FROM fx_kb k LEFT JOIN unit u ON k.ctx_id = u.ctx_id GROUP BY k.ctx_id")
def embed_text(spark, sf):
    """The whole vector of every context, condensed: its length, entries, norm and first moment."""
    from tonality.operators.scoring import embed_text as emb
    kb = FX.fx_kb(spark, sf)
    (e,) = emb(kb, "text", dims=EMBED_DIMS)
    e = e.withColumn("x", F.col("embedding").cast("array<double>"))
    return e.select("ctx_id", F.size("x").alias("dims"), F.size(F.filter("x", lambda v: v > 0)).alias("n_nonzero"),
                    r6(F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))).alias("norm"),
                    F.round(F.aggregate(F.transform("x", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v), 4).alias("moment"))


@register("retrieve_embedded")
def retrieve_embedded(spark, sf):
    return flows.retrieve_with_embedder(spark, sf).select("q_id", "c_id", "rank", r6(F.col("score")).alias("score"))


@register("train_classifier")
def train_classifier(spark, sf):
    return flows.classifier_predictions(spark, sf).select("id", "expected_output", "predicted_label")


_COUNTS_SQL = (
    f"recs AS (SELECT s.dataset, s.id, s.split, s.output, {Q.instruction('t.text')} AS instruction FROM ({_SPLIT_SQL}) s JOIN "
    f"(SELECT 'fx_text' AS dataset, id, text FROM fx_text UNION ALL SELECT 'fx_num' AS dataset, id, text FROM fx_num) t "
    f"ON s.dataset = t.dataset AND s.id = t.id WHERE s.output NOT IN ('unknown', 'unmapped')), "
    f"tok AS (SELECT dataset, id, split, output, unnest({Q.tokens('instruction')}) AS token FROM recs), "
    f"tr AS (SELECT output AS label, token, count(*) AS n FROM tok WHERE split = 'train' GROUP BY ALL), "
    f"sz AS (SELECT output AS label, count(*) AS n_rows, ln(count(*) / (sum(count(*)) OVER ())) AS prior FROM recs WHERE split = 'train' GROUP BY output), "
    f"wd AS (SELECT label, sum(n) + (SELECT count(DISTINCT token) FROM tr) AS room FROM tr GROUP BY label), "
    f"bag AS (SELECT dataset, id, token, count(*) AS tf FROM tok WHERE split = 'test' AND token IN (SELECT token FROM tr) GROUP BY ALL), "
    f"gain AS (SELECT r.dataset, r.id, z.label, round(coalesce(sum(b.tf * ln((coalesce(tr.n, 0) + 1.0) / w.room)), 0) + any_value(z.prior), 6) AS score "
    f"FROM recs r CROSS JOIN sz z JOIN wd w ON w.label = z.label LEFT JOIN bag b ON b.dataset = r.dataset AND b.id = r.id "
    f"LEFT JOIN tr ON tr.token = b.token AND tr.label = z.label WHERE r.split = 'test' GROUP BY r.dataset, r.id, z.label) ")


@register("class_counts", Q.with_("fx_text", "fx_num") + ", " + _COUNTS_SQL +
          "SELECT dataset, id, label AS predicted_label, score FROM gain "
          "QUALIFY row_number() OVER (PARTITION BY dataset, id ORDER BY score DESC, label) = 1")
def class_counts(spark, sf):
    """X3 beside the regression: smoothed class counts of the train split predict the test split."""
    return flows.counted_predictions(spark, sf)
