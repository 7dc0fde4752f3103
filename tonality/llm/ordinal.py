"""Quality classifier: ordinal cumulative-link regression on hashed text.

One weight vector is shared by all grades and K - 1 ordered thresholds cut its
score: P(grade <= k) = sigmoid(threshold_k - score). A text's features are its
words, their shapes, and a few statistics written as words, hashed to ``dim``
buckets; the values are log(1 + count) scaled to unit length. The expected grade
and the tail probability P(grade >= cut) select documents.

Defined results
  null or empty text: the feature of an empty text alone; rows without a grade
  teach nothing; no graded row: every score is null and nothing is selected
  away (selected is true); one grade only: that grade with certainty; repeated
  rows and null ids keep their own rows; an empty table gives no rows. Only
  named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import held_out, hold, labelled_sample

UPPER = "A"
DIM = 1 << 15


def shape(word: str) -> str:
    """Letters as A or a, digits as 0, each run once; other characters stay."""
    out = []
    for c in word:
        k = "0" if c.isdigit() else c if not c.isalpha() else "a" if c.islower() or not c.isupper() else UPPER
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:12])


@lru_cache(maxsize=1 << 17)
def _word(word: str, dim: int) -> tuple[int, int]:
    return crc32(b"w" + word.lower().encode("utf-8", "replace")) % dim, crc32(b"s" + shape(word).encode("utf-8", "replace")) % dim


def features(text: str | None, dim: int = DIM):
    """(indices, values) of a whole text."""
    import numpy as np

    words = (text or "").split()
    count = Counter(words)
    n = len(words)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    notes = [f"n{n.bit_length()}", f"r{(4 * n // max(1, len(count))).bit_length()}", f"d{10 * (len(lines) - len(set(lines))) // max(1, len(lines))}",
             f"q{10 * same // max(1, n)}", f"l{(n // max(1, len(lines))).bit_length()}"]
    sums: dict[int, float] = {}
    for w, c in count.items():
        a, b = _word(w, dim)
        sums[a] = sums.get(a, 0) + c
        sums[b] = sums.get(b, 0) + c
    idx = np.fromiter(sums, dtype=np.int32, count=len(sums))
    val = np.log1p(np.fromiter(sums.values(), dtype=np.float32, count=len(sums)))
    val /= max(1e-6, float(np.sqrt((val * val).sum())))
    extra = np.array([crc32(b"n" + x.encode()) % dim for x in notes], dtype=np.int32)
    return np.concatenate([idx, extra]), np.concatenate([val, np.full(len(notes), 0.5, dtype=np.float32)])


class CumulativeLink:
    """Shared weights and ordered thresholds; ``grades`` are the labels in order."""

    def __init__(self, grades, weights, thresholds):
        self.grades, self.weights, self.thresholds = list(grades), weights, thresholds

    def tail(self, text: str | None):
        """P(grade >= g) for every grade g, as an array that starts with 1."""
        import numpy as np

        idx, val = features(text, len(self.weights))
        s = float((self.weights[idx] * val).sum())
        return np.concatenate([[1.0], 1 / (1 + np.exp(np.clip(self.thresholds - s, -60, 60)))])


def train(rows, dim: int = DIM, rounds: int = 120, rate: float = 0.25, ridge: float = 2e-5) -> CumulativeLink | None:
    """Maximum likelihood by Adam over (indices, values, grade) rows held in memory."""
    import numpy as np

    if not rows:
        return None
    grades = sorted({r[2] for r in rows})
    y = np.array([grades.index(r[2]) for r in rows])
    k = len(grades)
    if k == 1:
        return CumulativeLink(grades, np.zeros(dim, dtype=np.float32), np.zeros(0))
    idx = np.concatenate([r[0] for r in rows]).astype(np.int64)
    val = np.concatenate([r[1] for r in rows]).astype(np.float64)
    size = np.array([len(r[0]) for r in rows])
    start, of = np.concatenate([[0], np.cumsum(size)[:-1]]), np.repeat(np.arange(len(rows)), size)
    share = np.bincount(y, minlength=k) / len(y)
    weight = 1 / len(y)
    cum = np.clip(np.cumsum(share)[:-1], 1e-3, 1 - 1e-3)
    cut = np.log(cum / (1 - cum))
    p = np.concatenate([np.zeros(dim), cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))])  # thresholds: first, then log gaps
    m, v = np.zeros_like(p), np.zeros_like(p)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for t in range(1, rounds + 1):
        w, gaps = p[:dim], np.exp(p[dim + 1:])
        th = p[dim] + np.concatenate([[0], np.cumsum(gaps)])
        s = np.add.reduceat(w[idx] * val, start)
        hi = np.where(y < k - 1, sig(th[np.minimum(y, k - 2)] - s), 1.0)
        lo = np.where(y > 0, sig(th[np.maximum(y - 1, 0)] - s), 0.0)
        prob = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / prob * weight, lo * (1 - lo) / prob * weight
        g = np.zeros_like(p)
        g[:dim] = np.bincount(idx, weights=(dhi - dlo)[of] * val, minlength=dim) + ridge * w
        gt = np.zeros(k - 1)
        np.add.at(gt, np.minimum(y, k - 2)[y < k - 1], -dhi[y < k - 1])
        np.add.at(gt, (y - 1)[y > 0], dlo[y > 0])
        g[dim] = gt.sum()
        g[dim + 1:] = [gt[i + 1:].sum() * gaps[i] for i in range(k - 2)]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    th = p[dim] + np.concatenate([[0], np.cumsum(np.exp(p[dim + 1:]))])
    return CumulativeLink(grades, p[:dim].astype(np.float32), th)


def fit(docs: DataFrame, graded: DataFrame, fit_rows: int = 4000, dim: int = DIM) -> CumulativeLink | None:
    """Fit on a bounded sample: about ``fit_rows`` graded documents of each grade (column ``grade``)."""
    sample = F.broadcast(labelled_sample(graded, "grade", fit_rows).withColumn("grade", F.col("grade").cast("double")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(sample, "doc_id").select("text", "grade")

    def run(batches):
        import pyarrow as pa

        hold("ordinal", _word.cache_clear)
        for b in batches:
            got = [features(t.as_py(), dim) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32())), b.column(1)],
                                             names=["i", "x", "grade"])

    import numpy as np

    got = texts.mapInArrow(run, "i array<int>, x array<float>, grade double").toArrow()

    def arrays(name):  # one numpy array a row, without a Python object a value
        rows = got.column(name).combine_chunks()
        return np.split(rows.flatten().to_numpy(), np.cumsum(rows.value_lengths().to_numpy())[:-1]) if len(rows) else []

    return train(list(zip(arrays("i"), arrays("x"), got.column("grade").to_pylist())), dim)


def score(docs: DataFrame, model: CumulativeLink | None, cut: float) -> DataFrame:
    """(doc_id, expected_grade, tail): the expected grade and P(grade >= ``cut``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text):
        import numpy as np

        m = shared.value
        if m is None:
            return None, None
        tail, g = m.tail(text), np.array(m.grades)
        above = [t for t, x in zip(tail, m.grades) if x >= cut]
        return float(g[0] + (np.diff(g) * tail[1:]).sum()), float(above[0]) if above else 0.0

    def run(batches):
        import pyarrow as pa

        hold("ordinal", _word.cache_clear)
        for b in batches:
            got = [one(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([g[k] for g in got], pa.float64()) for k in (0, 1)]], names=["doc_id", "expected_grade", "tail"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, expected_grade double, tail double")


def select(docs: DataFrame, model: CumulativeLink | None, cut: float, least: float) -> DataFrame:
    """The rows of ``docs`` whose P(grade >= ``cut``) is ``least`` or more, with every column; no shuffle.

    The score of a text depends on the text alone, so each batch is filtered where it is.
    """
    if model is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        hold("ordinal", _word.cache_clear)
        above = [k for k, g in enumerate(shared.value.grades) if g >= cut]
        for b in batches:
            keep = [bool(above) and shared.value.tail(t.as_py())[above[0]] >= least for t in b.column(at)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 unwanted, 1 well written but toxic, 2 well written."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2).alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, cut: float = 1, least: float = 0.5, fit_rows: int = 4000) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail, selected) of every document; learns from rows not held out."""
    model = fit(docs, ratings(labels).where(~held_out()), fit_rows)
    return score(docs, model, cut).select("doc_id", held_out().alias("held_out"), "expected_grade", "tail", F.coalesce(F.col("tail") >= least, F.lit(True)).alias("selected"))
