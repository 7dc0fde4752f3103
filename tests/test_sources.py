"""Readers and writers: Latin-1 phrase files, JSON lines, JSON arrays,
the metrics document."""

import json
import os

import pytest

from tonality.operators import evaluation as E
from tonality.operators.retrieval import kb_records
from tonality.schemas import CRAWLED_CONTEXT_SCHEMA, INSTRUCTION_SCHEMA, KB_SCHEMA
from tonality.sources import io


def test_phrasebank_latin1(spark, tmp_path):
    p = tmp_path / "phrases.txt"
    lines = ["Café profits rose @positive", "", "   ", "a@b@negative", "Plain line@neutral  "]
    p.write_bytes("\n".join(lines).encode("latin-1"))
    got = [(r["text"], r["sentiment"]) for r in io.read_phrasebank(spark, str(p)).collect()]
    assert got == [("Café profits rose", "positive"), ("a@b", "negative"), ("Plain line", "neutral")]


def test_jsonl_roundtrip_keeps_unicode(spark, tmp_out):
    df = spark.createDataFrame([("Qué tal €", "positive"), ("x", None)], INSTRUCTION_SCHEMA)
    io.write_jsonl(df, tmp_out)
    raw = "".join(open(os.path.join(tmp_out, f), encoding="utf-8").read()
                  for f in os.listdir(tmp_out) if f.endswith(".json"))
    assert "Qué tal €" in raw
    back = io.read_jsonl(spark, tmp_out, INSTRUCTION_SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())


def test_jsonl_failfast_and_permissive(spark, tmp_path):
    p = tmp_path / "bad.jsonl"
    p.write_text('{"instruction": "a", "output": "b"}\n{broken\n')
    with pytest.raises(Exception):
        io.read_jsonl(spark, str(p), INSTRUCTION_SCHEMA).collect()
    rows = io.read_jsonl(spark, str(p), INSTRUCTION_SCHEMA, mode="PERMISSIVE").collect()
    assert [r["_corrupt_record"] for r in rows] == [None, "{broken"]


def test_crawled_sample_without_cleaned_query(spark, tmp_path):
    p = tmp_path / "ctx.jsonl"
    rec = {"query": "$ACAD under $2 today?", "retrieved": {"source": "MarketWatch", "title": "t", "url": "u",
                                                         "context": "c"}}
    p.write_text(json.dumps(rec) + "\n")
    r = io.read_jsonl(spark, str(p), CRAWLED_CONTEXT_SCHEMA).first()
    assert r["cleaned_query"] is None and r["retrieved"]["source"] == "MarketWatch"


def test_json_array_roundtrip(spark, tmp_out):
    kb = kb_records(spark.createDataFrame([(i, f"text {i}", "neutral") for i in range(25)],
                                          "ctx_id long, text string, sentiment string"))
    io.write_json_arrays(kb.select("text", "sentiment", "metadata"), tmp_out, rows_per_file=7)
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_out) for f in fs if f.endswith(".txt")]
    assert all(json.load(open(f))[0]["metadata"]["source"] == "Phrasebank" for f in files)
    assert all(len(json.load(open(f))) <= 7 for f in files)
    back = io.read_json_array(spark, tmp_out, KB_SCHEMA)
    assert sorted(r["text"] for r in back.collect()) == sorted(f"text {i}" for i in range(25))


def test_metrics_document_sink(spark, tmp_out):
    rows = [("negative", "negative"), ("positive", "neutral"), ("neutral", "neutral")]
    counts = E.confusion_counts(spark.createDataFrame(rows, "expected_output string, predicted_label string"))
    io.write_metrics_document(E.metrics_document(counts), tmp_out)
    f = [x for x in os.listdir(tmp_out) if x.endswith(".txt")][0]
    doc = json.loads(open(os.path.join(tmp_out, f)).read())
    assert doc["accuracy"] == pytest.approx(2 / 3)
    assert doc["confusion_matrix"] == [[1, 0, 0], [0, 1, 0], [0, 1, 0]]
    assert set(doc["per_class_metrics"]) == {"negative", "neutral", "positive"}


def test_read_multi_dispatches_label_types(spark, tmp_path):
    from tonality.registry import DatasetSpec
    a = tmp_path / "a"
    b = tmp_path / "b"
    spark.createDataFrame([(1, "x", "Strong positive")], "i long, body string, lab string").write.parquet(str(a))
    spark.createDataFrame([(2, "y", 0), (3, "z", 7)], "i long, body string, lab int").write.parquet(str(b))
    specs = [DatasetSpec("a", str(a), id_field="i", input_field="body", output_field="lab"),
             DatasetSpec("b", str(b), id_field="i", input_field="body", output_field="lab", label_type="numeric")]
    got = sorted((r["dataset"], r["id"], r["label"]) for r in io.read_multi(spark, specs).collect())
    assert got == [("a", 1, "positive"), ("b", 2, "negative"), ("b", 3, None)]


def test_balanced_only_when_needed(spark):
    df = spark.range(100).repartition(1)
    assert io.balanced(df, 4, key="id").rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(8)
    assert io.balanced(many, 4) is many


def test_write_lines_is_really_latin1(spark, tmp_out):
    df = spark.createDataFrame([("Café gains@positive",), ("Straße@neutral",)], "line string")
    io.write_lines(df, "line", tmp_out, "ISO-8859-1")
    raw = b"".join(open(os.path.join(tmp_out, f), "rb").read() for f in os.listdir(tmp_out) if f.startswith("part-"))
    assert b"Caf\xe9 gains@positive" in raw and b"Stra\xdfe@neutral" in raw
    back = sorted((r["text"], r["sentiment"]) for r in io.read_phrasebank(spark, tmp_out).collect())
    assert back == [("Café gains", "positive"), ("Straße", "neutral")]
