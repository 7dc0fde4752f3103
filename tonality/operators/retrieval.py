"""Retrieval of supporting context and the news-source flow (J3, J5, J7, F3-F7,
U2, A14, A15, K2, X4).

Two-stage retrieval returns every context whose token overlap with the query is
> 0.8, in order of vector distance. It runs the prefix-filtered overlap join
first and computes distances only for its matches. The original restricts the
matches to the nearest contexts, a number that covers its whole knowledge
base; here ``k`` does that when given, by exact pruned k-NN, and is off by default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions import prompts as P
from tonality.functions import text as T
from tonality.operators import evaluation as E
from tonality.operators.similarity import checked_broadcast, knn_exact, materialize, overlap_join


def sq_l2(a, b) -> Column:
    """Squared L2 distance of two array<float> columns, in double."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) *
                                  (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda acc, v: acc + v)


def restrict_to(df: DataFrame, key: str, keys_from: DataFrame, key_in: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``keys_from`` — a semi-join, with
    the distinct keys broadcast when their measured size is small, so a large
    ``df`` is filtered in place before any expensive per-row work (Catalyst
    never moves a projection below a join by itself). ``keys_from`` should be
    materialised, or the count recomputes it."""
    keys = keys_from.select(F.col(key_in or key).alias(key)).distinct()
    return df.join(checked_broadcast(keys), key, "left_semi")


# --------------------------------------------------------------------------
# J3 / J4 / K2 / A15 / P10 / X4
# --------------------------------------------------------------------------

def retrieve_two_stage(queries: DataFrame, kb: DataFrame, q_id: str, q_text: str, q_vec: str,
                       c_id: str, c_text: str, c_vec: str, k: int | None = None,
                       threshold: float = R.OVERLAP_THRESHOLD, top_k: int | None = None) -> DataFrame:
    """``q_id, c_id, distance, rank, score`` for every context whose
    overlap with the query is > ``threshold``. With ``k``, only those among the
    query's ``k`` nearest contexts (ties by id). ``rank`` is the position among
    the query's matches in distance order; ``top_k`` optionally keeps only the
    first ``top_k`` (K2; off by default, as in the original code).
    """
    qt = queries.select(F.col(q_id).alias("q_id"), F.col(q_text).alias("qt"))
    ct = kb.select(F.col(c_id).alias("c_id"), F.col(c_text).alias("ct"))
    m = materialize(overlap_join(qt, ct, "q_id", "c_id", "qt", "ct", threshold).select("q_id", "c_id", "score"))
    # written once: vectors may be computed where they are read, and are measured before they are sent
    qv = materialize(restrict_to(queries.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("qv")), "q_id", m))
    cv = materialize(restrict_to(kb.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("cv")), "c_id", m))
    if k is not None:  # exact k-NN, only for queries that have an overlap match
        near = knn_exact(qv, kb, "q_id", c_id, "qv", c_vec, k).select("q_id", "c_id")
        m = materialize(m.join(near, ["q_id", "c_id"], "left_semi"))
    m = m.join(checked_broadcast(qv), "q_id").join(checked_broadcast(cv), "c_id").select("q_id", "c_id", sq_l2("qv", "cv").alias("distance"), "score")
    w = Window.partitionBy("q_id").orderBy("distance", "c_id")
    m = m.withColumn("rank", F.row_number().over(w))
    if top_k is not None:
        m = m.where(F.col("rank") <= top_k)
    # materialised for the consumers (assembly, votes)
    return materialize(m)


def topk_contexts(matches: DataFrame, k: int = 3) -> DataFrame:
    """K2: the first ``k`` matches of every query in retrieval order."""
    return matches.where(F.col("rank") <= k)


def assemble_context(matches: DataFrame, kb: DataFrame, c_id: str, c_text: str, c_sentiment: str) -> DataFrame:
    """Per query, the retrieved contexts rendered as
    ``Text: ..\\nSentiment: ..`` and joined by a blank line, in rank order.
    A group holds a query's overlap matches."""
    ctx = restrict_to(kb.select(F.col(c_id).alias("c_id"), F.col(c_text).alias("_t"), F.col(c_sentiment).alias("_s")),
                      "c_id", matches)
    rendered = matches.join(ctx, "c_id").select("q_id", "rank", P.context_entry("_t", "_s").alias("entry"))
    return (rendered.groupBy("q_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "entry"))).alias("_e"))
            .select("q_id", F.array_join(F.transform("_e", lambda s: s["entry"]), "\n\n").alias("context"),
                    F.size("_e").alias("n_contexts")))


def rag_prompts(queries: DataFrame, contexts: DataFrame, q_id: str, instruction_col: str) -> DataFrame:
    """P10: ``q_id, prompt`` for every query; a query without matches keeps
    its row with an empty context."""
    j = queries.select(F.col(q_id).alias("q_id"), F.col(instruction_col).alias("_i")).join(contexts, "q_id", "left")
    return j.select("q_id", P.rag_prompt(F.coalesce("context", F.lit("")), "_i").alias("prompt"),
                    F.coalesce("n_contexts", F.lit(0)).alias("n_contexts"))


def context_vote(queries: DataFrame, matches: DataFrame, kb: DataFrame, q_id: str, c_id: str,
                 c_sentiment: str) -> DataFrame:
    """Majority sentiment of a query's retrieved contexts (ties by label
    order); ``unknown`` when nothing was retrieved."""
    s = matches.join(restrict_to(kb.select(F.col(c_id).alias("c_id"), F.col(c_sentiment).alias("sentiment")),
                                 "c_id", matches), "c_id")
    votes = s.groupBy("q_id", "sentiment").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("q_id").orderBy(F.col("votes").desc(), F.col("sentiment"))
    best = votes.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return (queries.select(F.col(q_id).alias("q_id")).join(best, "q_id", "left")
            .select("q_id", F.coalesce("sentiment", F.lit(R.UNKNOWN)).alias("vote"),
                    F.coalesce("votes", F.lit(0)).cast("long").alias("votes")))


# --------------------------------------------------------------------------
# news sources: J5, C10, C11, J1, F3-F5, J7, U2, A14, P17
# --------------------------------------------------------------------------

def _source_structs() -> Column:
    return F.array(*[F.struct(F.lit(s.order).alias("source_order"), F.lit(s.name).alias("source"),
                              F.lit(s.threshold).alias("threshold"), F.lit(s.date_op).cast("string").alias("date_op"),
                              F.lit(s.base_url).alias("base_url"), F.lit(s.search_url).alias("url_template"))
                     for s in R.SOURCES])


def source_by_order(order_col) -> Column:
    """Struct of the source whose 1-based order is ``order_col``."""
    return F.element_at(_source_structs(), order_col.cast("int"))


def source_fanout(queries: DataFrame, cleaned_col: str, window_col: str, as_of: str) -> DataFrame:
    """J5 + C10 + C11: every query once per source, with its search string
    (date clause only for dated sources and positive windows) and URL. The
    9 sources are generated per row (no join)."""
    f = queries.withColumn("_s", F.explode(_source_structs())).select("*", "_s.*").drop("_s")
    f = f.withColumn("search_string", T.search_string(cleaned_col, window_col, "date_op", as_of))
    return f.withColumn("search_url", T.search_url("url_template", "search_string"))


def title_similarity_join(queries: DataFrame, candidates: DataFrame, q_id: str, q_text: str,
                          c_id: str, c_title: str, threshold_col: str = "threshold") -> DataFrame:
    """J1 + F3: (query, candidate) pairs whose similarity score (C6) is
    strictly above the candidate's own source threshold — one
    prefix-filtered join with a per-candidate threshold."""
    return overlap_join(queries, candidates, q_id, c_id, q_text, c_title, score="similarity",
                        threshold_col=threshold_col)


def url_blocklist(df: DataFrame, link_col: str = "url", source_col: str = "source",
                  source: str = "MarketWatch") -> DataFrame:
    """drop links of ``source`` that contain a blocked fragment."""
    blocked = F.lit(False)
    for frag in R.URL_BLOCKLIST:
        blocked = blocked | F.col(link_col).contains(frag)
    return df.where(~((F.col(source_col) == source) & blocked))


def nonempty_context(df: DataFrame, col: str = "context") -> DataFrame:
    """drop rows whose context is empty."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def time_window_filter(df: DataFrame, ts_col: str, as_of: str, window_days: int) -> DataFrame:
    """rows at or after ``as_of - window_days`` — a literal bound, so the
    predicate reaches the Parquet scan."""
    cutoff = F.to_timestamp(F.date_sub(F.to_date(F.lit(as_of)), window_days))
    return df.where(F.col(ts_col) >= cutoff.cast("timestamp_ntz"))


def quarantine(df: DataFrame, ok: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """split rows into (good, rejected-with-reason) by a predicate; bad
    rows never stop the run."""
    good = df.where(F.coalesce(ok, F.lit(False)))
    bad = df.where(~F.coalesce(ok, F.lit(False))).withColumn("reject_reason", F.lit(reason))
    return good, bad


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Bag union of per-source results; ``source_order`` keeps the fixed
    source order for readers that sort."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def source_stats(results: DataFrame, source_col: str = "source") -> DataFrame:
    """Articles per source over the fixed 9-source domain, zero-filled."""
    return E.fixed_distribution(results, source_col, domain=[s.name for s in R.SOURCES], decimals=2,
                                label_alias="source")


def kb_records(df: DataFrame) -> DataFrame:
    """Knowledge-base entries with the constant metadata struct."""
    meta = F.struct(F.lit(R.KB_METADATA_SOURCE).alias("source"), F.lit(R.KB_METADATA_TYPE).alias("type"))
    return df.withColumn("metadata", meta)


def retrieved_records(df: DataFrame, query_col: str = "query", cleaned_col: str = "cleaned_query") -> DataFrame:
    """``{query, cleaned_query, retrieved: {source, title, url, context}}``."""
    return df.select(F.col(query_col).alias("query"), F.col(cleaned_col).alias("cleaned_query"),
                     F.struct("source", "title", "url", "context").alias("retrieved"))
