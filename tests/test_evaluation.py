"""Golden tests: the three published confusion matrices, expanded into
(true, pred) rows, must give back every published figure; plus edge cases."""

import pytest
from pyspark.sql import functions as F

from tonality.operators import evaluation as E

# Published confusion matrices (rows = true, columns = predicted,
# label order negative, neutral, positive[, unknown]) and published figures.
ORDER4 = ["negative", "neutral", "positive", "unknown"]
RUNS = {
    "untuned": {
        "matrix": [[1357, 85, 244, 2010], [1281, 365, 1384, 3164], [1432, 248, 1906, 3788], [0, 0, 0, 0]],
        "accuracy": 0.21014828544949027,
        "per_class": {
            "negative": (0.33341523341523344, 0.3671536796536797, 0.3494720576873551, 3696, 0.6328463203463204),
            "neutral": (0.5229226361031518, 0.05892799483371004, 0.10591990713871155, 6194, 0.94107200516629),
            "positive": (0.5393322014714205, 0.2584757255221047, 0.34946828016134945, 7374, 0.7415242744778953),
        },
        "macro": (0.3489175177474514, 0.1711393500023736, 0.20121506124685404),
        "weighted": (0.489361, 0.210148, 0.262088),
    },
    "tuned": {
        "matrix": [[2595, 483, 618], [386, 4037, 1771], [424, 1817, 5133]],
        "accuracy": 0.6814759036144579,
        "per_class": {
            "negative": (0.762114537444934, 0.7021103896103896, 0.7308829742289819, 3696, 0.29788961038961037),
            "neutral": (0.6370522329177845, 0.6517597675169519, 0.6443220812385284, 6194, 0.3482402324830481),
            "positive": (0.6823982983249136, 0.6960943856794142, 0.6891783029001074, 7374, 0.3039056143205858),
        },
        "macro": (0.6938550228958773, 0.6833215142689185, 0.6881277861225392),
        "weighted": (0.683195, 0.681476, 0.682013),
    },
    "retrieval": {
        "matrix": [[1565, 1646, 482, 3], [228, 4592, 1372, 2], [268, 4177, 2927, 2], [0, 0, 0, 0]],
        "accuracy": 0.5261816496756255,
        "per_class": {
            "negative": (0.7593401261523532, 0.42343073593073594, 0.5436859475421226, 3696, 0.5765692640692641),
            "neutral": (0.44090254440710513, 0.7413626089764288, 0.5529532181347462, 6194, 0.2586373910235712),
            "positive": (0.6122150177787073, 0.39693517765120695, 0.4816125051419169, 7374, 0.6030648223487931),
        },
        "macro": (0.45311442208454145, 0.3904321306395929, 0.3945629177046964),
        "weighted": (0.582249, 0.526182, 0.520497),
    },
}


def expand(spark, matrix):
    """(true, pred) rows: each matrix cell repeated n times, built in Spark."""
    cells = [(ORDER4[i], ORDER4[j], n) for i, row in enumerate(matrix) for j, n in enumerate(row) if n]
    df = spark.createDataFrame(cells, "expected_output string, predicted_label string, n int")
    return df.select("expected_output", "predicted_label", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_"))


@pytest.mark.parametrize("run", sorted(RUNS))
def test_published_figures(spark, run):
    g = RUNS[run]
    rows = expand(spark, g["matrix"])
    assert rows.count() == 17264
    counts = E.confusion_counts(rows)
    acc = E.accuracy(counts).first()
    assert acc["total"] == 17264
    assert acc["accuracy"] == pytest.approx(g["accuracy"], abs=1e-12)
    assert acc["error_rate"] == pytest.approx(1 - g["accuracy"], abs=1e-12)
    pc = {r["label"]: r for r in E.per_class_metrics(counts).collect()}
    for label, (p, r, f1, sup, err) in g["per_class"].items():
        assert pc[label]["precision"] == pytest.approx(p, abs=1e-12)
        assert pc[label]["recall"] == pytest.approx(r, abs=1e-12)
        assert pc[label]["f1"] == pytest.approx(f1, abs=1e-12)
        assert pc[label]["support"] == sup
        assert pc[label]["error_rate"] == pytest.approx(err, abs=1e-12)
    m = E.macro_metrics(E.per_class_metrics(counts)).first()
    assert (m["precision"], m["recall"], m["f1"]) == pytest.approx(g["macro"], abs=1e-12)
    mi = E.micro_metrics(counts).first()
    assert mi["precision"] == mi["recall"] == mi["f1"] == pytest.approx(g["accuracy"], abs=1e-12)
    w = E.weighted_metrics(E.per_class_metrics(counts)).first()
    assert (w["precision"], w["recall"], w["f1"]) == pytest.approx(g["weighted"], abs=1e-6)


@pytest.mark.parametrize("run", sorted(RUNS))
def test_confusion_matrix_roundtrip(spark, run):
    g = RUNS[run]
    counts = E.confusion_counts(expand(spark, g["matrix"]))
    labels = [r["label"] for r in E.label_domain(counts).collect()]
    n = len(g["matrix"]) if any(g["matrix"][-1]) or len(g["matrix"]) == 3 else len(g["matrix"])
    assert labels == ORDER4[:n]
    doc = E.metrics_document(counts).first()
    assert [list(r) for r in doc["confusion_matrix"]] == g["matrix"]
    assert doc["accuracy"] == pytest.approx(g["accuracy"], abs=1e-12)


def test_label_only_in_predictions_sorting_first(spark):
    # "aaa" is predicted but never true, and sorts before every true label
    rows = [("negative", "aaa"), ("negative", "negative"), ("positive", "positive"), ("positive", "negative")]
    counts = E.confusion_counts(spark.createDataFrame(rows, "expected_output string, predicted_label string"))
    pc = {r["label"]: r for r in E.per_class_metrics(counts).collect()}
    assert pc["aaa"]["support"] == 0 and pc["aaa"]["recall"] == 0.0 and pc["aaa"]["error_rate"] is None
    assert pc["negative"]["precision"] == pytest.approx(0.5) and pc["negative"]["recall"] == pytest.approx(0.5)
    assert pc["positive"]["precision"] == 1.0 and pc["positive"]["recall"] == 0.5
    macro = E.macro_metrics(E.per_class_metrics(counts)).first()
    true_only = E.macro_metrics(E.per_class_metrics(counts), scope="true_only").first()
    assert macro["recall"] == pytest.approx((0 + 0.5 + 0.5) / 3)
    assert true_only["recall"] == pytest.approx(0.5)


def test_zero_rows_and_one_class(spark):
    empty = spark.createDataFrame([], "expected_output string, predicted_label string")
    acc = E.accuracy(E.confusion_counts(empty)).first()
    assert acc["accuracy"] is None
    one = spark.createDataFrame([("neutral", "neutral")] * 3, "expected_output string, predicted_label string")
    c = E.confusion_counts(one)
    assert E.accuracy(c).first()["accuracy"] == 1.0
    pc = E.per_class_metrics(c).collect()
    assert len(pc) == 1 and pc[0]["f1"] == 1.0


def test_distributions(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)], "label string")
    d = {r["label"]: r for r in E.distribution(df, "label", 1).collect()}
    assert d["a"]["n"] == 2 and d["a"]["pct"] == 66.7 and d["b"]["pct"] == 33.3
    z = {r["label"]: r for r in E.fixed_distribution(df.where("label = 'zz'"), "label").collect()}
    assert set(z) == {"negative", "neutral", "positive"}
    assert all(r["n"] == 0 and r["pct"] is None for r in z.values())


def test_half_up_percentage(spark):
    # 1/8 = 12.5 % -> 12.5 (1 decimal); 1/16 = 6.25 % -> 6.3 half-up
    df = spark.createDataFrame([(1, 8), (1, 16), (2, 3)], "n long, t long")
    got = [r[0] for r in df.select(E.pct_half_up(F.col("n"), F.col("t"), 1)).collect()]
    assert got == [12.5, 6.3, 66.7]


def test_null_labels_are_a_class_of_their_own(spark):
    rows = [("a", "a")] * 3 + [(None, "a")] * 2 + [("b", None)]
    counts = E.confusion_counts(spark.createDataFrame(rows, "expected_output string, predicted_label string"))
    cm = {(r.true_label, r.pred_label): r.n for r in E.confusion_matrix(counts).collect()}
    assert sum(cm.values()) == 6 and cm[None, "a"] == 2 and cm["b", None] == 1 and len(cm) == 9
    pc = {r.label: (r.support, r.predicted) for r in E.per_class_metrics(counts).collect()}
    assert pc == {"a": (3, 5), "b": (1, 0), None: (2, 1)}
    assert set(E.metrics_document(counts).first().per_class_metrics) == {"a", "b"}
