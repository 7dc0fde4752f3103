"""Plan shape: pushdown and pruning reach the scan, no Python on the hot
path, no estimate-based broadcasts."""

from tonality.plans import catalog
from tonality.plans import fixtures as FX

from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapCoGroupsInPandas", "MapInPandas")
# the queries that may run Python code on rows, each with its reason
KNN = {"knn_exact", "retrieval_rank", "retrieve_two_stage", "retrieve_two_stage_k", "topk_contexts", "assemble_context",
       "rag_prompt", "context_vote", "flagship", "retrieve_embedded", "diverse_contexts"}  # block scorer, matrix products
ANN = {"knn_approximate", "knn_approximate_recall"}  # k-means sums, codes and distance tables are matrix products
PYTHON_OK = KNN | ANN | {"batch_score"}  # the hook for a caller's model


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_pushed_to_parquet(spark):
    df = catalog.QUERIES["time_window_filter"](spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p


def test_projection_pruned(spark):
    p = plan(catalog.QUERIES["post_title"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_no_python_outside_hooks(spark):
    for name, fn in catalog.QUERIES.items():
        if name in PYTHON_OK or name in ("train_classifier", "embed_text", "scan_jsonl", "sink_jsonl",
                                         "scan_json_array", "sink_kb", "overlap_join", "title_similarity_join",
                                         "enrich_articles", "union_sources", "retrieved_records", "source_stats"):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert not any(n in p for n in PYTHON_NODES), name


def test_no_estimated_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    p = plan(FX.fx_text(spark, SF_SMALL))
    assert "BroadcastHashJoin" not in p


def test_aggregates_are_partial(spark):
    from tonality.operators import evaluation as E
    preds = FX.fx_predictions(spark, SF_SMALL)
    assert "partial_count" in plan(E.confusion_counts(preds, materialized=False))


def test_metrics_read_the_materialised_counts(spark):
    # every metric after the one aggregation reads the checkpointed counts,
    # never the predictions' Parquet files again
    for name in ("confusion_matrix", "chart_data", "per_class_metrics"):
        p = plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "Scan ExistingRDD" in p and "FileScan parquet" not in p, name


def test_cluster_sizing_only_outside_local_mode():
    from tonality.session import CLUSTER_CONF, session_conf
    assert "spark.sql.files.maxPartitionBytes" not in session_conf("local[8]")
    for master in (None, "yarn", "spark://host:7077"):
        conf = session_conf(master)
        assert all(conf[k] == v for k, v in CLUSTER_CONF.items())
        assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
