import numpy as np

from tonality.llm import ordinal as O
from tonality.llm.common import held_out

from conftest import SF_CHECK


def test_likelihood_beats_constant_and_thresholds_are_ordered():
    r = np.random.default_rng(1)
    rows, truth = [], r.normal(size=50)
    for _ in range(3000):
        i = r.choice(50, size=6, replace=False)
        x = np.ones(6) / np.sqrt(6)
        s = (truth[i] * x).sum() * 3 + r.logistic()
        rows.append((i, x, float(sum(s > c for c in (-1, 0.5, 2)))))
    m = O.train(rows, dim=50, rounds=300)
    assert m.grades == [0, 1, 2, 3] and (np.diff(m.thresholds) > 0).all()
    score = np.array([(m.weights[i] * x).sum() for i, x, _ in rows])
    want = np.array([(truth[i] * x).sum() for i, x, _ in rows])
    assert np.corrcoef(score, want)[0, 1] > 0.97
    below = np.array([g for _, _, g in rows]) <= 1
    p = 1 / (1 + np.exp(score - m.thresholds[1]))
    assert abs(p.mean() - below.mean()) < 0.03


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = O.classify(docs, labels)
    rows = out.where(held_out()).join(labels, "doc_id").collect()
    assert out.count() == docs.count() and len(rows) > 50
    assert sum(r.selected == (r.quality == 1) for r in rows) / len(rows) > 0.9
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_defined_cases(spark):
    rows = [(1, None, 1.0), (2, "", 2.0), (None, "some text", None), (4, "some text", 3.0), (4, "some text", 3.0), (5, "w " * 30_000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tail double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bare = O.classify(df, none).collect()
    assert len(bare) == len(rows) and all(r.selected and r.tail is None for r in bare)
    one = O.classify(df, spark.createDataFrame([(4, 1, 0), (5, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")).collect()
    assert {r.expected_grade for r in one} == {2.0} and all(r.selected for r in one)
    assert O.classify(df.limit(0), none).collect() == []
