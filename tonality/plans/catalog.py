"""Registered queries: one per operator, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Every query reads the driver's tables (or what Spark derives from them) in
full; floating results are rounded to 6 digits and every computed column is
aliased the same way in both languages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions import html as H
from tonality.functions import labels as L
from tonality.functions import prompts as P
from tonality.functions import text as T
from tonality.plans import fixtures as FX
from tonality.plans import sql as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ==========================================================================
# 2.2 projections over labelled text
# ==========================================================================

@register("normalize_label", Q.with_("fx_text") + f"SELECT id, label, {Q.normalize_label('label')} AS normalized FROM fx_text")
def normalize_label(spark, sf):
    return FX.fx_text(spark, sf).select("id", "label", L.normalize_label("label").alias("normalized"))


@register("map_numeric_label", Q.with_("fx_num") + f"SELECT id, label, {Q.map_numeric('label')} AS mapped FROM fx_num")
def map_numeric_label(spark, sf):
    return FX.fx_num(spark, sf).select("id", "label", L.map_numeric_label("label").alias("mapped"))


@register("label_dispatch", Q.with_("fx_text", "fx_num") +
          f"SELECT 'text' AS dataset, id, label, {Q.normalize_label('label')} AS normalized FROM fx_text "
          f"UNION ALL SELECT 'numeric' AS dataset, id, CAST(label AS VARCHAR) AS label, {Q.map_numeric('label')} "
          f"AS normalized FROM fx_num")
def label_dispatch(spark, sf):
    t = FX.fx_text(spark, sf).select(F.lit("text").alias("dataset"), "id", "label", F.lit("text").alias("lt"))
    n = FX.fx_num(spark, sf).select(F.lit("numeric").alias("dataset"), "id", F.col("label").cast("string").alias("label"),
                                    F.lit("numeric").alias("lt"))
    u = t.unionByName(n)
    return u.select("dataset", "id", "label", L.label_dispatch("label", "lt").alias("normalized"))


@register("instruction_template", Q.with_("fx_text") + f"SELECT id, {Q.instruction('text')} AS instruction FROM fx_text")
def instruction_template(spark, sf):
    return FX.fx_text(spark, sf).select("id", P.instruction("text").alias("instruction"))


_RECORDS_SQL = (f"SELECT id, {Q.instruction('text')} AS instruction, {Q.normalize_label('label')} AS output "
                f"FROM fx_text")


def records(spark, sf) -> DataFrame:
    """Instruction records of the text-labelled set (unknown labels dropped)."""
    t = FX.fx_text(spark, sf)
    r = t.select("id", P.instruction("text").alias("instruction"), L.normalize_label("label").alias("output"))
    return r.where(F.col("output") != R.UNKNOWN)


@register("instruction_records", Q.with_("fx_text") + f"SELECT * FROM ({_RECORDS_SQL}) WHERE output <> 'unknown'")
def instruction_records(spark, sf):
    return records(spark, sf)


@register("chat_template", Q.with_("fx_chat") +
          f"SELECT conv_id, turn, {Q.chat_template(Q.q(R.INSTRUCTION_PREFIX.strip()), 'user_text', 'assistant_text')} "
          f"AS chat FROM fx_chat")
def chat_template(spark, sf):
    c = FX.fx_chat(spark, sf)
    return c.select("conv_id", "turn", P.chat_template(F.lit(R.INSTRUCTION_PREFIX.strip()), "user_text",
                                                       "assistant_text").alias("chat"))


@register("train_prompt", Q.with_("fx_text") +
          f"SELECT id, {Q.train_prompt('instruction', 'output')} AS prompt FROM ({_RECORDS_SQL}) WHERE output <> 'unknown'")
def train_prompt(spark, sf):
    return records(spark, sf).select("id", P.train_prompt("instruction", "output").alias("prompt"))


@register("infer_prompt", Q.with_("fx_text") +
          f"SELECT id, {Q.infer_prompt('instruction')} AS prompt FROM ({_RECORDS_SQL}) WHERE output <> 'unknown'")
def infer_prompt(spark, sf):
    return records(spark, sf).select("id", P.infer_prompt("instruction").alias("prompt"))


@register("strip_template", Q.with_("fx_text") +
          f"SELECT id, replace(instruction, {Q.q(R.INSTRUCTION_PREFIX)}, '') AS query FROM ({_RECORDS_SQL}) "
          f"WHERE output <> 'unknown'")
def strip_template(spark, sf):
    return records(spark, sf).select("id", P.strip_template("instruction").alias("query"))


_ECHO_SQL = Q.ustrip(f"replace(raw_output, {Q.infer_prompt('instruction')}, '')")


@register("strip_prompt_echo", Q.with_("fx_pred") + f"SELECT id, {_ECHO_SQL} AS response FROM fx_pred")
def strip_prompt_echo(spark, sf):
    p = FX.fx_pred(spark, sf)
    return p.select("id", L.strip_prompt_echo("raw_output", P.infer_prompt("instruction")).alias("response"))


_SEGMENT_SQL = Q.ustrip(f"string_split(raw_output, {Q.q('Assistant:')})[-1]")


@register("last_segment", Q.with_("fx_pred") + f"SELECT id, {_SEGMENT_SQL} AS segment FROM fx_pred")
def last_segment(spark, sf):
    return FX.fx_pred(spark, sf).select("id", L.last_segment("raw_output").alias("segment"))


@register("parse_prediction", Q.with_("fx_pred") + "SELECT id, model_output, predicted_label FROM fx_pred")
def parse_prediction(spark, sf):
    return FX.fx_predictions(spark, sf).select("id", "model_output", "predicted_label")


@register("prediction_records", Q.with_("fx_pred") +
          "SELECT id, instruction, expected_output, model_output, predicted_label FROM fx_pred")
def prediction_records(spark, sf):
    return FX.fx_predictions(spark, sf).select("id", "instruction", "expected_output", "model_output",
                                               "predicted_label")


@register("kb_records", Q.with_("fx_kb") +
          f"SELECT ctx_id, text, sentiment, {Q.q(R.KB_METADATA_SOURCE)} AS meta_source, "
          f"{Q.q(R.KB_METADATA_TYPE)} AS meta_type FROM fx_kb")
def kb_records(spark, sf):
    from tonality.operators.retrieval import kb_records as build
    kb = build(FX.fx_kb(spark, sf))
    return kb.select("ctx_id", "text", "sentiment", F.col("metadata.source").alias("meta_source"),
                     F.col("metadata.type").alias("meta_type"))


@register("pad_truncate", Q.with_("fx_text") +
          "SELECT id, CAST(least(len(tk), 512) AS INTEGER) AS n_tokens, array_to_string(list_concat(tk[1:512], "
          "list_transform(range(greatest(512 - len(tk), 0)), lambda i: '<pad>')), ' ') AS tokens, "
          "array_to_string(list_concat(list_transform(range(least(len(tk), 512)), lambda i: '1'), "
          "list_transform(range(greatest(512 - len(tk), 0)), lambda i: '0')), '') AS attention_mask FROM "
          f"(SELECT id, list_filter(string_split_regex({Q.train_prompt('instruction', 'output')}, {Q.q(T.WS_RUN_RE)}), "
          f"lambda t: t <> '') AS tk FROM ({_RECORDS_SQL}) WHERE output <> 'unknown')")
def pad_truncate(spark, sf):
    r = records(spark, sf).select("id", P.pad_truncate(P.train_prompt("instruction", "output")).alias("s"))
    return r.select("id", F.col("s.n_tokens").alias("n_tokens"), F.array_join("s.tokens", " ").alias("tokens"),
                    F.array_join(F.transform("s.attention_mask", lambda x: x.cast("string")), "").alias("attention_mask"))


@register("pad_multiple", Q.with_("fx_text") +
          "SELECT batch_id, CAST(max(n) AS INTEGER) AS max_tokens, CAST(ceil(max(n) / 8) * 8 AS INTEGER) AS padded_length, "
          "count(*) AS batch_rows FROM (SELECT CAST(floor((row_number() OVER (ORDER BY id) - 1) / 4) AS BIGINT) "
          "AS batch_id, len(list_filter(string_split_regex(" + Q.train_prompt('instruction', 'output') +
          f", {Q.q(T.WS_RUN_RE)}), lambda t: t <> '')) AS n FROM ({_RECORDS_SQL}) WHERE output <> 'unknown') "
          "GROUP BY batch_id")
def pad_multiple(spark, sf):
    from tonality.operators.sampling import batch_ids
    r = records(spark, sf).select("id", F.size(T.tokens(P.train_prompt("instruction", "output"), lower=False)).alias("n"))
    b = batch_ids(r, "id", R.TRAIN_BATCH)
    return b.groupBy("batch_id").agg(F.max("n").alias("max_tokens"), P.round_up(F.max("n")).alias("padded_length"),
                                     F.count(F.lit(1)).alias("batch_rows"))


# ==========================================================================
# 2.8 scalar text functions
# ==========================================================================

@register("clean_tickers", Q.with_("fx_ticker") +
          f"SELECT 'region' AS src, id, {Q.clean_tickers('phrase')} AS cleaned FROM fx_ticker UNION ALL "
          f"SELECT 'documents' AS src, doc_id AS id, {Q.clean_tickers('text')} AS cleaned FROM documents")
def clean_tickers(spark, sf):
    t = FX.fx_ticker(spark, sf).select(F.lit("region").alias("src"), "id", T.clean_tickers("phrase").alias("cleaned"))
    d = FX.table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
                                                 T.clean_tickers("text").alias("cleaned"))
    return t.unionByName(d)


@register("clean_special", f"SELECT doc_id, {Q.clean_special('text')} AS cleaned FROM documents")
def clean_special(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", T.clean_special("text").alias("cleaned"))


@register("collapse_ws", f"SELECT doc_id, {Q.collapse_ws('text')} AS collapsed FROM documents")
def collapse_ws(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", T.collapse_ws("text").alias("collapsed"))


# Registered outputs write "no time phrase" as window_days = -1 (the column
# functions return null) so the column is a plain non-null int everywhere.
NO_WINDOW = -1


@register("time_window", Q.with_("fx_time") +
          f"SELECT event_id, phrase, coalesce({Q.time_window('phrase')}, {NO_WINDOW}) AS window_days FROM fx_time")
def time_window(spark, sf):
    return FX.fx_time(spark, sf).select("event_id", "phrase",
                                        F.coalesce(T.time_window("phrase"), F.lit(NO_WINDOW)).alias("window_days"))


_CQ_SQL = (f"SELECT src, id, cleaned_query, coalesce({Q.time_window('cleaned_query', lower=False)}, {NO_WINDOW}) "
           f"AS window_days FROM "
           f"(SELECT 'events' AS src, event_id AS id, {Q.clean_query_text('phrase')} AS cleaned_query FROM fx_time "
           f"UNION ALL SELECT 'region' AS src, id, {Q.clean_query_text('phrase')} AS cleaned_query FROM fx_ticker "
           f"UNION ALL SELECT 'benchmark' AS src, item_id AS id, {Q.clean_query_text('text')} AS cleaned_query "
           f"FROM benchmark)")


@register("clean_query", Q.with_("fx_time", "fx_ticker") + _CQ_SQL)
def clean_query(spark, sf):
    parts = [FX.fx_time(spark, sf).select(F.lit("events").alias("src"), F.col("event_id").alias("id"),
                                           F.col("phrase").alias("q")),
             FX.fx_ticker(spark, sf).select(F.lit("region").alias("src"), "id", F.col("phrase").alias("q")),
             FX.table(spark, sf, "benchmark").select(F.lit("benchmark").alias("src"), F.col("item_id").alias("id"),
                                                     F.col("text").alias("q"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    cq = T.clean_query("q")
    return u.select("src", "id", cq["cleaned"].alias("cleaned_query"),
                    F.coalesce(cq["window_days"], F.lit(NO_WINDOW)).alias("window_days"))


_CHAT_SETS = (f"SELECT conv_id, turn, {Q.token_set('user_text')} AS a, {Q.token_set('assistant_text')} AS b "
              f"FROM fx_chat")


def _chat_sets(spark, sf):
    c = FX.fx_chat(spark, sf)
    return c.select("conv_id", "turn", T.token_set("user_text").alias("a"), T.token_set("assistant_text").alias("b"))


@register("similarity_score", Q.with_("fx_chat") + f"SELECT conv_id, turn, {Q.r6(Q.similarity('a', 'b'))} AS score FROM ({_CHAT_SETS})")
def similarity_score(spark, sf):
    return _chat_sets(spark, sf).select("conv_id", "turn", r6(T.similarity_score("a", "b")).alias("score"))


@register("overlap_coefficient", Q.with_("fx_chat") + f"SELECT conv_id, turn, {Q.r6(Q.overlap('a', 'b'))} AS score FROM ({_CHAT_SETS})")
def overlap_coefficient(spark, sf):
    return _chat_sets(spark, sf).select("conv_id", "turn", r6(T.overlap_coefficient("a", "b")).alias("score"))


@register("token_intersection", Q.with_("fx_chat") +
          f"SELECT conv_id, turn, CAST(len(a) AS INTEGER) AS n_a, CAST(len(b) AS INTEGER) AS n_b, "
          f"CAST({Q.n_shared('a', 'b')} AS INTEGER) AS n_shared FROM ({_CHAT_SETS})")
def token_intersection(spark, sf):
    return _chat_sets(spark, sf).select("conv_id", "turn", F.size("a").alias("n_a"), F.size("b").alias("n_b"),
                                        T.token_intersection("a", "b").alias("n_shared"))


@register("similarity_filter", Q.with_("fx_chat") +
          f"SELECT conv_id, turn, {Q.r6(Q.similarity('a', 'b'))} AS score FROM ({_CHAT_SETS}) "
          f"WHERE {Q.similarity('a', 'b')} > 0.2")
def similarity_filter(spark, sf):
    s = _chat_sets(spark, sf).withColumn("s", T.similarity_score("a", "b"))
    return s.where(F.col("s") > F.lit(0.2)).select("conv_id", "turn", r6(F.col("s")).alias("score"))


@register("token_set", f"SELECT doc_id, CAST(len(ts) AS INTEGER) AS n_tokens, array_to_string(list_sort(ts), ' ') AS tokens "
                       f"FROM (SELECT doc_id, {Q.token_set('text')} AS ts FROM documents)")
def token_set(spark, sf):
    d = FX.table(spark, sf, "documents").select("doc_id", T.token_set("text").alias("ts"))
    return d.select("doc_id", F.size("ts").alias("n_tokens"), F.array_join(F.array_sort("ts"), " ").alias("tokens"))


@register("cutoff_date", Q.with_("fx_time") +
          f"SELECT event_id, coalesce(w, {NO_WINDOW}) AS window_days, strftime(DATE '{FX.AS_OF}' - w, '%Y-%m-%d') AS cutoff FROM "
          f"(SELECT event_id, {Q.time_window('phrase')} AS w FROM fx_time)")
def cutoff_date(spark, sf):
    t = FX.fx_time(spark, sf).select("event_id", T.time_window("phrase").alias("w"))
    return t.select("event_id", F.coalesce("w", F.lit(NO_WINDOW)).alias("window_days"),
                    T.cutoff_date("w", FX.AS_OF).alias("cutoff"))


@register("rsplit_label", Q.with_("fx_kb", "fx_lines") +
          f"SELECT line_id, {Q.rsplit_text('line')} AS text, {Q.rsplit_label('line')} AS sentiment FROM fx_lines "
          f"WHERE length({Q.ustrip('line')}) > 0")
def rsplit_label(spark, sf):
    ln = FX.fx_lines(spark, sf).where(F.length(T.ustrip("line")) > 0)
    return ln.select("line_id", T.rsplit_text("line").alias("text"), T.rsplit_label("line").alias("sentiment"))


@register("drop_blank", Q.with_("fx_kb", "fx_lines") + f"SELECT line_id FROM fx_lines WHERE length({Q.ustrip('line')}) > 0")
def drop_blank(spark, sf):
    return FX.fx_lines(spark, sf).where(F.length(T.ustrip("line")) > 0).select("line_id")


@register("truncate_text", "SELECT doc_id, coalesce(substring(text, 1, 1000), '') AS context FROM documents")
def truncate_text(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", T.truncate_text("text").alias("context"))


@register("post_title", "SELECT doc_id, substring(text, 1, 100) || '...' AS title FROM documents")
def post_title(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", T.post_title("text").alias("title"))


# ==========================================================================
# 2.8 HTML
# ==========================================================================

@register("article_text", Q.with_("fx_pages") + f"SELECT page_id, {Q.fx_article_text()} AS context FROM fx_pages")
def article_text(spark, sf):
    return FX.fx_pages(spark, sf).select("page_id", H.article_text("html", "url").alias("context"))


_LINKS_SQL = (f"SELECT page_id, source, base_url, pos, link, {Q.inner_text('title')} AS title FROM "
              f"(SELECT page_id, source, base_url, CAST(unnest(range(1, len(links) + 1)) AS INTEGER) AS pos, unnest(links) AS link, "
              f"unnest(titles) AS title FROM (SELECT page_id, source, base_url, "
              f"{Q.fx_links(1)} AS links, {Q.fx_links(2)} AS titles FROM fx_pages))")


def links(spark, sf) -> DataFrame:
    p = FX.fx_pages(spark, sf)
    x = p.select("page_id", "source", "base_url", F.explode(H.anchors("html")).alias("a"))
    return x.select("page_id", "source", "base_url", F.col("a.pos").alias("pos"), F.col("a.link").alias("link"),
                    F.col("a.title").alias("title"))


@register("extract_links", Q.with_("fx_pages") + f"SELECT page_id, pos, title, link FROM ({_LINKS_SQL})")
def extract_links(spark, sf):
    return links(spark, sf).select("page_id", "pos", "title", "link")


_ABS_SQL = ("SELECT page_id, pos, source, CASE WHEN starts_with(link, 'http') THEN link ELSE base_url || link END AS url "
            f"FROM ({_LINKS_SQL})")


@register("absolutize_links", Q.with_("fx_pages") + _ABS_SQL)
def absolutize_links(spark, sf):
    return links(spark, sf).select("page_id", "pos", "source", T.absolutize("link", "base_url").alias("url"))


@register("url_blocklist", Q.with_("fx_pages") +
          f"SELECT page_id, pos, source, url FROM ({_ABS_SQL}) WHERE NOT (source = 'MarketWatch' AND contains(url, 'barrons.com'))")
def url_blocklist(spark, sf):
    from tonality.operators.retrieval import url_blocklist as block
    a = links(spark, sf).select("page_id", "pos", "source", T.absolutize("link", "base_url").alias("url"))
    return block(a, "url", "source")


@register("nonempty_context", Q.with_("fx_pages") +
          f"SELECT page_id FROM (SELECT page_id, {Q.fx_article_text()} AS context FROM fx_pages) WHERE context <> ''")
def nonempty_context(spark, sf):
    from tonality.operators.retrieval import nonempty_context as ne
    return ne(FX.fx_pages(spark, sf).select("page_id", H.article_text("html", "url").alias("context"))).select("page_id")


@register("scan_pages", Q.with_("fx_pages") + "SELECT page_id, url, source_order, source, CAST(length(html) AS INTEGER) AS html_chars FROM fx_pages")
def scan_pages(spark, sf):
    return FX.fx_pages(spark, sf).select("page_id", "url", "source_order", "source",
                                         F.length("html").alias("html_chars"))


# the rest of the catalog (sampling, joins, retrieval, evaluation, sources)
from tonality.plans import catalog_more  # noqa: E402,F401

from tonality.plans import catalog_retrieval, catalog_samples  # noqa: E402,F401
