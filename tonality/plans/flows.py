"""The three end-to-end flows, as lazy DataFrame plans.

* data preparation: datasets -> labels -> seeded split -> instruction records
* retrieval-augmented evaluation: queries + knowledge base -> two-stage
  retrieval -> prompts -> scoring -> metrics (the flagship)
* context collection: queries -> cleaning -> per-source search strings ->
  title matches over fetched pages -> article text -> per-source counts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions import html as H
from tonality.functions import labels as L
from tonality.functions import prompts as P
from tonality.functions import text as T
from tonality.operators import evaluation as E
from tonality.operators import retrieval as RT
from tonality.operators import sampling as S
from tonality.operators import scoring as SC
from tonality.plans import fixtures as FX
from tonality.schemas import KB_SCHEMA
from tonality.operators.similarity import materialize
from tonality.session import scratch_path
from tonality.sources import io

# --------------------------------------------------------------------------
# data preparation
# --------------------------------------------------------------------------


def dataset_specs(spark: SparkSession, sf_dir: str) -> list[R.DatasetSpec]:
    """The two labelled inputs: free-text labels and numeric labels."""
    return [
        R.DatasetSpec(name="fx_text", label_type="text", reader=lambda s: FX.fx_text(s, sf_dir)),
        R.DatasetSpec(name="fx_num", label_type="numeric", reader=lambda s: FX.fx_num(s, sf_dir)),
    ]


def split_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset read, labels normalised per label type (unmapped numeric
    codes become ``unmapped``), seeded exact split per dataset."""
    specs = dataset_specs(spark, sf_dir)
    d = io.read_multi(spark, specs)
    d = d.withColumn("output", F.coalesce(F.col("label"), F.lit("unmapped")))
    return S.split_exact(d, "id", "dataset", {s.name: s.train_ratio for s in specs})


def instruction_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction records with their split; unknown/unmapped labels dropped
    after the split was assigned (so the ratio holds before filtering)."""
    s = split_datasets(spark, sf_dir)
    s = s.where(~F.col("output").isin(R.UNKNOWN, "unmapped"))
    return s.select("dataset", "id", "split", P.instruction("text").alias("instruction"), "output")


# --------------------------------------------------------------------------
# retrieval-augmented evaluation
# --------------------------------------------------------------------------


def rag_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(queries = test split, knowledge base = train split) of fx_rag, each
    materialised once: both are read many times by the retrieval plan. The
    instruction is the text behind a fixed prefix, rendered where it is read."""
    r = materialize(FX.fx_rag(spark, sf_dir).drop("instruction")).withColumn("instruction", P.instruction("text"))
    return r.where(F.col("split") == "test"), r.where(F.col("split") == "train")


def rag_matches(qs: DataFrame, kb: DataFrame, top_k: int | None = None, k: int | None = None) -> DataFrame:
    """Two-stage retrieval; the retrieval query is the whole instruction,
    template included."""
    return RT.retrieve_two_stage(qs, kb, "id", "instruction", "embedding", "id", "text", "embedding",
                                 k=k, threshold=R.OVERLAP_THRESHOLD, top_k=top_k)


def rag_prompt_table(qs: DataFrame, kb: DataFrame, matches: DataFrame) -> DataFrame:
    ctx = RT.assemble_context(matches, kb, "id", "text", "sentiment")
    return RT.rag_prompts(qs, ctx, "id", "instruction")


def rag_votes(qs: DataFrame, kb: DataFrame, matches: DataFrame) -> DataFrame:
    return RT.context_vote(qs, matches, kb, "id", "id", "sentiment")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieve -> vote -> metrics: per-class precision/recall/F1 of the
    context vote against each query's own label."""
    qs, kb = rag_sides(spark, sf_dir)
    votes = rag_votes(qs, kb, rag_matches(qs, kb))
    pairs = votes.join(qs.select(F.col("id").alias("q_id"), F.col("sentiment").alias("expected_output")), "q_id")
    pc = E.per_class_metrics(E.confusion_counts(pairs, "expected_output", "vote"))
    return pc.select("label", "tp", "support", "predicted",
                     *[F.round(F.col(m), 6).alias(m) for m in ("precision", "recall", "f1")])


def scored_prompts(spark: SparkSession, sf_dir: str, scorer=SC.context_vote_scorer) -> DataFrame:
    """RAG prompts through the batch-scoring hook, output parsed to a label."""
    qs, kb = rag_sides(spark, sf_dir)
    prompts = rag_prompt_table(qs, kb, rag_matches(qs, kb))
    scored = SC.batch_score(prompts, "prompt", scorer, R.INFER_BATCH)
    return scored.withColumn("predicted_label", L.parse_prediction("model_output"))


def retrieve_with_embedder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-stage retrieval with the built-in featuriser: benchmark queries
    (whole instruction) against the labelled knowledge base."""
    kb = FX.fx_kb(spark, sf_dir)
    qs = FX.fx_query(spark, sf_dir)
    model = SC.fit_embedder(kb, "text")
    kb_e = SC.embed(model, kb, "text")
    qs_e = SC.embed(model, qs.select("qid", F.col("instruction").alias("text")), "text")
    qs_e = qs_e.withColumnRenamed("text", "instruction")
    return RT.retrieve_two_stage(qs_e, kb_e, "qid", "instruction", "embedding", "ctx_id", "text", "embedding")


def counted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed class counts of the train split predict the test split."""
    recs = instruction_splits(spark, sf_dir)
    model = SC.fit_class_counts(recs.where(F.col("split") == "train"))
    return SC.predict_by_counts(model, recs.where(F.col("split") == "test"), ["dataset", "id"])


def classifier_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the text classifier on the train split, predict the test split."""
    recs = instruction_splits(spark, sf_dir)
    model = SC.train_classifier(recs.where(F.col("split") == "train"))
    test = recs.where(F.col("split") == "test").select("id", "instruction", F.col("output").alias("expected_output"))
    return SC.predict_labels(model, test)


# --------------------------------------------------------------------------
# context collection
# --------------------------------------------------------------------------


def fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time phrases as queries, cleaned, fanned out to every source."""
    t = FX.fx_time(spark, sf_dir)
    cq = T.clean_query("phrase")
    q = t.select("event_id", cq["cleaned"].alias("cleaned_query"), cq["window_days"].alias("window_days"))
    return RT.source_fanout(q, "cleaned_query", "window_days", FX.AS_OF)


def title_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned benchmark queries against page titles, per-source threshold."""
    # written once: behind a broadcast join Spark would clean a query again for each of its matches
    q = materialize(FX.cleaned_queries(spark, sf_dir))
    c = FX.page_titles(spark, sf_dir)
    j = materialize(RT.title_similarity_join(q, c, "qid", "cleaned_query", "page_id", "title"))
    # attach query and page columns for matched ids only (titles are not
    # re-extracted for every page)
    pages = materialize(RT.restrict_to(c.select("page_id", "url", "source", "source_order", "title"), "page_id", j))
    return j.join(RT.restrict_to(q.select("qid", "query", "cleaned_query"), "qid", j), "qid").join(pages, "page_id")


SHORT_POSTS = "Twitter"  # the source whose results are the posts themselves


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches -> blocklist -> article text -> non-empty, as retrieved rows;
    short posts keep their own text as context and its start as title."""
    m = materialize(RT.url_blocklist(title_matches(spark, sf_dir), "url", "source"))
    posts = m.where(F.col("source") == SHORT_POSTS).select(*[c for c in m.columns if c != "title"], T.post_title("title").alias("title"), F.col("title").alias("context"))
    articles = m.where(F.col("source") != SHORT_POSTS)
    # article text only for matched pages: filter the pages first, then parse
    pages = RT.restrict_to(FX.fx_pages(spark, sf_dir).select("page_id", "url", "html"), "page_id", articles)
    pages = materialize(pages.select("page_id", H.article_text("html", "url").alias("context")))  # a text a page, not one a match
    return RT.nonempty_context(RT.union_sources([articles.join(pages, "page_id"), posts]), "context")


# --------------------------------------------------------------------------
# round trips through storage (the checkpoint folder, never a local path)
# --------------------------------------------------------------------------


def jsonl_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    io.write_jsonl(df, path)
    schema = df.schema
    return io.read_jsonl(spark, path, schema)


def phrasebank_roundtrip(spark: SparkSession, lines: DataFrame, col: str = "line") -> DataFrame:
    path = scratch_path(spark, "phrases-latin1")
    io.write_lines(lines, col, path, "ISO-8859-1")
    return io.read_phrasebank(spark, path, "ISO-8859-1")


def json_array_roundtrip(spark: SparkSession, kb: DataFrame) -> DataFrame:
    path = scratch_path(spark, "json-array")
    io.write_json_arrays(kb, path, rows_per_file=1000)
    return io.read_json_array(spark, path, KB_SCHEMA)


def kb_roundtrip(spark: SparkSession, kb: DataFrame) -> DataFrame:
    path = scratch_path(spark, "kb")
    io.write_kb(kb, path)
    return io.read_jsonl(spark, path, KB_SCHEMA)


def metrics_roundtrip(spark: SparkSession, document: DataFrame) -> DataFrame:
    """The metrics document through its sink and back."""
    path = scratch_path(spark, "metrics")
    io.write_metrics_document(document, path)
    return spark.read.text(path, wholetext=True).select(F.from_json("value", document.schema).alias("m")).select("m.*")
