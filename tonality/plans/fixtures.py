"""Derived inputs over the driver tables (the ``fx_*`` views of FIXTURES.md).

Each function reads the Parquet tables of one scale-factor directory and
derives the records the operators work on (labelled texts, predictions,
knowledge base, queries, time phrases, pages with their source...). The same
definitions are written in SQL in :mod:`tonality.plans.sql` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions import html as H
from tonality.functions import prompts as P
from tonality.functions import text as T
from tonality.functions.labels import parse_prediction
from tonality.operators import retrieval as RT
from tonality.operators import sampling as S
from tonality.sources import io

AS_OF = "2024-01-31"
TIME_UNITS = ("days", "d", "weeks", "w", "months", "m", "years", "y")
FIXED_PHRASES = ("today", "yesterday", "last week", "last month", "last year")


# Tables with regex-heavy row work: rebalanced after the scan when it yields
# too few partitions (see ``io.balanced``); filters still reach the scan.
# (value: the unique key the rows are hashed on)
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": ["conv_id", "turn"],
               "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return io.balanced(df, key=TEXT_TABLES[name]) if name in TEXT_TABLES else df


def _sentiment(toxic, quality):
    return (F.when(toxic == 1, F.lit("negative")).when(quality == 1, F.lit("positive"))
            .otherwise(F.lit("neutral")))


def fx_text(spark, sf_dir) -> DataFrame:
    """Text-labelled dataset: ``id, text, label`` with free-form labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    label = (F.when(F.col("doc_id") % 11 == 0, F.lit("n/a"))
             .when(F.col("toxic") == 1, F.lit("Moderately Negative"))
             .when(F.col("quality") == 1, F.lit("strong POSITIVE"))
             .otherwise(F.lit("neutral")))
    return j.select(F.col("doc_id").alias("id"), "text", label.alias("label"))


def fx_num(spark, sf_dir) -> DataFrame:
    """Number-labelled dataset: ``id, text, label int`` (9 is unmapped)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels")
    label = (F.when(F.col("doc_id") % 13 == 0, F.lit(9)).when(F.col("toxic") == 1, F.lit(0))
             .when(F.col("quality") == 1, F.lit(2)).otherwise(F.lit(1)))
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("id"), "text", label.alias("label"))


def fx_pred(spark, sf_dir) -> DataFrame:
    """Predictions: ``id, instruction, expected_output, model_output,
    raw_output`` (the decoded text with the prompt echoed in front)."""
    lab = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    exp = _sentiment(F.col("toxic"), F.col("quality"))
    m = F.col("doc_id") % 7
    out = (F.when(m <= 3, F.concat(F.lit("Sentiment: "), exp)).when(m == 4, F.lit("negative or POSITIVE"))
           .when(m == 5, F.lit("Neutral.")).otherwise(F.lit("n/a")))
    j = lab.join(d, "doc_id").select(F.col("doc_id").alias("id"), P.instruction("text").alias("instruction"),
                                     exp.alias("expected_output"), out.alias("model_output"))
    return j.withColumn("raw_output", F.concat(P.infer_prompt("instruction"), F.lit(" "), F.col("model_output")))


def fx_predictions(spark, sf_dir) -> DataFrame:
    """fx_pred with the parsed label."""
    return fx_pred(spark, sf_dir).withColumn("predicted_label", parse_prediction("model_output"))


def fx_kb(spark, sf_dir) -> DataFrame:
    """Knowledge base: ``ctx_id, text, sentiment``."""
    lab = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("ctx_id"), "text",
                                        _sentiment(F.col("toxic"), F.col("quality")).alias("sentiment"))


def fx_query(spark, sf_dir) -> DataFrame:
    """Queries: ``qid, text, instruction``."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("qid"), "text", P.instruction("text").alias("instruction"))


def fx_vec(spark, sf_dir) -> DataFrame:
    """Vectors: ``vec_id, embedding, sentiment`` (label % 3 -> label word)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding",
                    F.element_at(F.array(*[F.lit(x) for x in R.LABELS]), (F.col("label") % 3 + 1).cast("int"))
                    .alias("sentiment"))


def fx_rag(spark, sf_dir) -> DataFrame:
    """Vectors with texts: ``id, text, instruction, embedding, sentiment,
    split`` — embeddings joined to documents on ``vec_id = doc_id``, split
    80/20 by the seeded order (train = knowledge base, test = queries)."""
    v = fx_vec(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    d = RT.restrict_to(d, "vec_id", v)  # of the documents only those with a vector are shuffled
    j = v.join(d, "vec_id").select(F.col("vec_id").alias("id"), "text", P.instruction("text").alias("instruction"),
                                   "embedding", "sentiment", F.lit("fx_rag").alias("dataset"))
    return S.split_exact(j, "id", "dataset", 0.8).drop("rank")


def fx_time(spark, sf_dir) -> DataFrame:
    """Time phrases: ``event_id, phrase``."""
    e = table(spark, sf_dir, "events")
    unit = F.element_at(F.array(*[F.lit(u) for u in TIME_UNITS]), (F.col("event_id") % 8 + 1).cast("int"))
    gen = F.concat(F.col("event_type"), F.lit(" "), (F.col("user_id") % 40).cast("string"), F.lit(" "), unit,
                   F.lit(" ago"))
    fixed = F.element_at(F.array(*[F.lit(p) for p in FIXED_PHRASES], F.concat(F.col("event_type"), F.lit(" flat"))),
                         (F.floor(F.col("event_id") / 5) % 6 + 1).cast("int"))
    return e.select("event_id", F.when(F.col("event_id") % 5 == 0, fixed).otherwise(gen).alias("phrase"))


def fx_ticker(spark, sf_dir) -> DataFrame:
    """Ticker phrases from region names: ``id, phrase``."""
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("long").alias("id"),
                    F.concat(F.lit("$"), F.substring("r_name", 1, 4), F.lit(" "), F.col("r_name"),
                             F.lit(" rose #1 (x)")).alias("phrase"))


# What fx_pages adds to the pages of two sources, so that every branch of the
# article and link rules acts: a nested container, class tokens in three
# notations, references, blocked, absolute and bare links.
CONTAINER_OPEN = '<div class="wide article-content x"><div class="ad"><p>promo</p></div>'
CONTAINER_END = '</div><div class="article-content-related"><p>related</p></div><p>footer</p>'
SCOPED_PARAS = ('<p class="lead article__body">one &mdash; &#8217;x&#8217; &euro;5 &#x2713;</p><p class=\'article__body big\'>two</p>'
                '<p class=article__body>three</p><p class="article__body-related">junk</p>'
                '<a href=\'https://www.barrons.com/a\'>Barrons</a><a class=b href=/bare>Bare</a><a href="http://abs.example/x">Abs</a>')
SCOPED_TEXT = "one \u2014 \u2019x\u2019 \u20ac5 \u2713 two three"
ADDED_LINKS = (("Barrons", "https://www.barrons.com/a"), ("Bare", "/bare"), ("Abs", "http://abs.example/x"))


def fx_pages(spark, sf_dir) -> DataFrame:
    """Pages with their news source: ``page_id, url, html, source_order,
    source, threshold, base_url``. Pages of Seeking Alpha and MarketWatch get
    an address and markup of those sites (see the constants above)."""
    p = table(spark, sf_dir, "pages")
    s = RT.source_by_order(F.col("page_id") % 9 + 1)
    name, page = s["source"], F.col("page_id").cast("string")
    url = (F.when(name == "Seeking Alpha", F.concat(F.lit("https://seekingalpha.com/article/"), page))
           .when(name == "MarketWatch", F.concat(F.lit("https://www.marketwatch.com/story/"), page)).otherwise(F.col("url")))
    html = (F.when(name == "Seeking Alpha", F.concat(F.lit(CONTAINER_OPEN), F.col("html"), F.lit(CONTAINER_END)))
            .when(name == "MarketWatch", F.concat(F.col("html"), F.lit(SCOPED_PARAS))).otherwise(F.col("html")))
    return p.select("page_id", url.alias("url"), html.alias("html"), s["source_order"].alias("source_order"), name.alias("source"),
                    s["threshold"].alias("threshold"), s["base_url"].alias("base_url"))


def fx_lines(spark, sf_dir) -> DataFrame:
    """Phrase-file lines: ``line_id, line`` (``text@sentiment``, each followed
    by a whitespace-only line)."""
    kb = fx_kb(spark, sf_dir)
    lines = kb.select((F.col("ctx_id") * 2).alias("line_id"),
                      F.concat(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("@"), F.col("sentiment")).alias("line"))
    blanks = kb.select((F.col("ctx_id") * 2 + 1).alias("line_id"), F.lit(" \t ").alias("line"))
    return lines.unionByName(blanks)


def fx_chat(spark, sf_dir) -> DataFrame:
    """User turns paired with the assistant turn that follows:
    ``conv_id, turn, user_text, assistant_text``."""
    c = table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("user_text"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                     F.col("text").alias("assistant_text"))
    return u.join(a, ["conv_id", "turn"])


def page_titles(spark, sf_dir) -> DataFrame:
    """Candidate titles for the title-similarity join: one per page."""
    return fx_pages(spark, sf_dir).select("page_id", "url", "source_order", "source", "threshold", "base_url",
                                          H.page_title("html").alias("title"))


def cleaned_queries(spark, sf_dir) -> DataFrame:
    """Benchmark queries through ``clean_query``: ``qid, query, cleaned_query, window_days``."""
    q = fx_query(spark, sf_dir)
    cq = T.clean_query("text")
    return q.select("qid", F.col("text").alias("query"), cq["cleaned"].alias("cleaned_query"),
                    cq["window_days"].alias("window_days"))
