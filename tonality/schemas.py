"""Explicit schemas of the records the engine reads and writes."""

from pyspark.sql import types as T

S = T.StringType()

INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("instruction", S),
    T.StructField("output", S),
])

METADATA = T.StructType([T.StructField("source", S), T.StructField("type", S)])

KB_SCHEMA = T.StructType([
    T.StructField("text", S),
    T.StructField("sentiment", S),
    T.StructField("metadata", METADATA),
])

RETRIEVED = T.StructType([
    T.StructField("source", S), T.StructField("title", S),
    T.StructField("url", S), T.StructField("context", S),
])

CRAWLED_CONTEXT_SCHEMA = T.StructType([
    T.StructField("query", S),
    T.StructField("cleaned_query", S),  # absent in older files -> null
    T.StructField("retrieved", RETRIEVED),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("instruction", S),
    T.StructField("expected_output", S),
    T.StructField("model_output", S),
    T.StructField("predicted_label", S),
])

_PRF = T.StructType([T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
                     T.StructField("f1", T.DoubleType())])

METRICS_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("per_class_metrics", T.MapType(S, T.StructType([
        T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()), T.StructField("support", T.LongType()),
        T.StructField("error_rate", T.DoubleType())]))),
    T.StructField("macro_metrics", _PRF),
    T.StructField("micro_metrics", _PRF),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
])
