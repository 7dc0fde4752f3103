"""Toxicity: misspelling-tolerant lexicon matches weighed by their context.

The lexicon holds the words that mark toxic labelled texts. Levenshtein automata
of its terms are intersected with a trie of all of them and determinised lazily,
so one walk along a word finds the closest term within the distance that the
term's length allows. Every match looks at a window of words around it: marks
and words of quotation or report beside it speak for a quotation, other matches
and words of address for abuse. What such context words are worth is learned
from the labels too, over a small prior list. The lexicon is counted over all
labelled texts; the weights of misspellings and context words and the logistic
score over the matches' sums are fitted on a bounded labelled sample.

Defined results
  null or empty text: no match, the score of a text without matches; no labels to
  learn from, labels of one class, or no term that marks toxic texts: every score
  is 0; texts that share their least word-triple hash (copies) count a word once;
  repeated rows and null ids keep their own rows; an empty table
  gives no rows. Only named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import held_out, labelled_sample, materialise

WORD = re.compile(r"[^\W_]+(?:['’@$*\-][^\W_]+)*")
WINDOW = 6  # words on either side of a match
QUOTES = "\"“”„«»‘’'"
# Prior context words; labels add to them and outweigh them.
REPORT = frozenset("said says say quote quoted quotes called word words term wrote writes meaning means insult sagte sagt wort zitat dit mot cite dijo dice palabra cita".split())
ADDRESS = frozenset("you your youre u he she they are is such du ihr dein bist sie tu vous es votre ton eres usted tus such".split())


def allowed(term: str) -> int:
    """Edits allowed for a term: short ones must be exact."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class TrieAutomaton:
    """Levenshtein automata of all terms, run together over their trie.

    A state is a set of (trie node, edits so far); states and steps are made when
    first met and remembered, up to ``limit`` steps.
    """

    def __init__(self, terms, limit: int = 1 << 18):
        self.limit = limit
        self.kids: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most: list[int] = [0]  # edits that some term below the node allows
        for t in sorted(set(terms)):
            at = 0
            for c in t:
                if c not in self.kids[at]:
                    self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                    self.term.append(None)
                    self.most.append(0)
                self.most[at] = max(self.most[at], allowed(t))
                at = self.kids[at][c]
            self.term[at] = t
            self.most[at] = max(self.most[at], allowed(t))
        self._forget()

    def _forget(self):
        self.steps: dict[tuple[int, str], int] = {}
        self.states: list[tuple] = [()]          # 0: dead
        self.number: dict[tuple, int] = {(): 0}
        self.ends: list[tuple[str, int] | None] = [None]
        self.start = self._state({0: 0})

    def _state(self, best: dict[int, int]) -> int:
        """Close under deletions from the word (skipped letters of a term), then number the set."""
        todo = list(best)
        while todo:
            node = todo.pop()
            e = best[node] + 1
            for kid in self.kids[node].values():
                if e <= self.most[kid] and e < best.get(kid, 99):
                    best[kid] = e
                    todo.append(kid)
        key = tuple(sorted(best.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            found = sorted((e, self.term[n]) for n, e in key if self.term[n] is not None and e <= allowed(self.term[n]))
            self.ends.append((found[0][1], found[0][0]) if found else None)
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        best: dict[int, int] = {}
        for node, e in self.states[state]:
            if e < self.most[node] and e + 1 < best.get(node, 99):  # a letter too many in the word
                best[node] = e + 1
            for k, kid in self.kids[node].items():
                cost = e + (k != c)
                if cost <= self.most[kid] and cost < best.get(kid, 99):
                    best[kid] = cost
        self.steps[state, c] = to = self._state(best) if best else 0
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(closest term, edits) or None."""
        if len(self.steps) > self.limit:
            self._forget()
        state, steps = self.start, self.steps.get
        for c in word:
            to = steps((state, c))
            state = self._step(state, c) if to is None else to
            if not state:
                return None
        return self.ends[state]


class Scorer:
    """Lexicon weights, term -> (log odds of exact matches, of misspelt ones), context words' weights and the logistic layer.

    ``context``: word -> -1 (speaks for a quotation) to 1 (for abuse), beside the prior words.
    """

    def __init__(self, lexicon: dict[str, tuple[float, float]], layer=None, context: dict[str, float] | None = None):
        self.lexicon, self.layer = lexicon, layer
        self.context = {**dict.fromkeys(REPORT, -1.0), **dict.fromkeys(ADDRESS, 1.0), **(context or {})}

    def __getstate__(self):
        return {"lexicon": self.lexicon, "layer": self.layer, "context": self.context}

    @property
    def automaton(self) -> TrieAutomaton:
        if "_auto" not in self.__dict__:
            self._auto = TrieAutomaton(self.lexicon)
        return self._auto

    def matches(self, text: str | None) -> list[tuple[str, int, str, float, float]]:
        """(term, edits, word, quotation share, abuse share) of every match in a whole text."""
        text = text or ""
        low = text.lower()
        if len(low) != len(text):  # lower-casing that changes lengths would move the quotes
            text = low
        match, known, spots = self.automaton.match, {}, []
        words = [(m.start(), m.end(), m.group()) for m in WORD.finditer(low)]
        for i, (_, _, w) in enumerate(words):
            if w not in known:
                known[w] = match(w)
            if known[w]:
                spots.append(i)
        out, at = [], set(spots)
        for i in spots:
            a, b = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
            left, right = text[words[a][0]:words[i][0]], text[words[i][1]:words[b - 1][1] + 1]
            around = [self.context.get(words[j][2], 0.0) for j in range(a, b) if j != i]
            quoted = (any(q in left for q in QUOTES) and any(q in right for q in QUOTES)) + 0.5 * -min([0.0, *around])
            abuse = sum(j in at for j in range(a, b) if j != i) / (2 * WINDOW) + 0.25 * max([0.0, *around])
            out.append((*known[words[i][2]], words[i][2], min(1.0, quoted), min(1.0, abuse)))
        return out

    def beside(self, text: str | None) -> set[str]:
        """Words other than matches in the windows of a text's matches."""
        words = WORD.findall((text or "").lower())
        kinds = {w: self.automaton.match(w) for w in set(words)}
        spots = [i for i, w in enumerate(words) if kinds[w]]
        return {words[j] for i in spots for j in range(max(0, i - WINDOW), min(len(words), i + WINDOW + 1)) if not kinds[words[j]]}

    def sums(self, text: str | None) -> list[float]:
        """Features of the logistic layer."""
        total = strongest = quoted = abuse = plain = 0.0
        for term, edits, _, q, a in self.matches(text):
            w = max(0.0, self.lexicon[term][edits > 0]) / max(1, edits)
            total += w
            strongest = max(strongest, w)
            quoted += q * w
            abuse += a * w
            plain += (1 - q) * w
        return [math.log1p(total), strongest, math.log1p(quoted), math.log1p(abuse), math.log1p(plain)]

    def score(self, text: str | None) -> float:
        if self.layer is None:
            return 0.0
        w, b, mean, scale = self.layer
        z = b + sum(k * (x - m) / s for k, x, m, s in zip(w, self.sums(text), mean, scale))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def logistic(x, y, rounds: int = 25, ridge: float = 1e-3):
    """Weights, bias and the scaling of a logistic regression, by Newton steps."""
    import numpy as np

    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, keep = np.zeros(z.shape[1]), ridge * len(x) * np.eye(z.shape[1])
    keep[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + keep + 1e-9 * np.eye(len(w)), z.T @ (y - p) - keep @ w)
    return w[:-1].tolist(), float(w[-1]), mean.tolist(), scale.tolist()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _labelled(docs: DataFrame, labels: DataFrame, small: int) -> DataFrame:
    """(doc_id, toxic, text, h) of the texts with a toxic label; copies share h, the least hash of their word triples.

    Labels of at most ``small`` rows are broadcast, more are joined by a shuffle.
    """
    marks = materialise(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                        .where("doc_id is not null and toxic in (0, 1)").distinct(), "toxic-labels")
    rows = marks.count()
    texts = _texts(docs).where("text is not null").join(F.broadcast(marks) if rows <= small else marks, "doc_id").select(
        "doc_id", "toxic", "text", F.expr("transform(split(lower(text), '\\\\s+'), w -> xxhash64(w))").alias("h"))
    for k in (1, 1):
        texts = texts.withColumn("h", F.expr(f"zip_with(slice(h, 1, greatest(size(h) - {k}, 1)), slice(h, {k + 1}, size(h)), (x, y) -> xxhash64(x, y))"))
    return texts.withColumn("h", F.array_min("h"))


def _rows(batch, emit, kinds):
    """One Arrow batch of the rows that ``emit`` makes of each row of ``batch``."""
    import pyarrow as pa

    made = [r for row in zip(*(c.to_pylist() for c in batch.columns)) for r in emit(*row)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*made)) or [()] * len(kinds), kinds.values())], names=list(kinds))


def _by_class(texts: DataFrame, words_of) -> DataFrame:
    """(word, bad, good): texts of each class that hold each word of ``words_of(text)``, texts of one h once a word."""
    def run(batches):
        import pyarrow as pa

        kinds = {"word": pa.string(), "toxic": pa.int32(), "h": pa.int64()}
        for b in batches:
            for at in range(0, b.num_rows, 100):
                yield _rows(b.slice(at, 100), lambda toxic, h, text: ((w, toxic, h) for w in words_of(text)), kinds)

    n = lambda c: F.sum(F.when(F.col("toxic") == c, 1).otherwise(0))
    return (texts.select("toxic", "h", "text").mapInArrow(run, "word string, toxic int, h long")
            .distinct().groupBy("word").agg(n(1).alias("bad"), n(0).alias("good")))


def _surprise(bad, good, sizes):
    """G squared of a word's two counts against one common rate."""
    rate = (bad + good) / (sizes[0] + sizes[1])
    part = lambda n, of: F.when(n > 0, n * F.log(n / (rate * of))).otherwise(0.0)
    return 2 * (part(bad, sizes[1]) + part(good, sizes[0]))


def _odds(bad, good, sizes) -> float:
    return math.log((bad + 0.5) / (sizes[1] + 1)) - math.log((good + 0.5) / (sizes[0] + 1))


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = 10_000, evidence: float = 25.0, small: int = 2_000_000) -> Scorer:
    """Lexicon from all labelled texts; context words and layer from about ``fit_rows`` labelled documents of each class.

    A term must be at least 20 times as frequent in toxic texts as in others, with a
    log-likelihood ratio (G squared) of ``evidence`` or more; that alone bounds the lexicon.
    ``small`` is the number of labels up to which they are broadcast.
    """
    import numpy as np

    texts = materialise(_labelled(docs, labels, small), "toxic-texts")
    sizes = {r["toxic"]: r["n"] for r in texts.select("toxic", "h").distinct().groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Scorer({})
    bad, good = F.col("bad"), F.col("good")
    marked = (_by_class(texts, lambda text: set(WORD.findall(text.lower())))
              .where((bad > 0) & (_surprise(bad, good, sizes) >= evidence) & (bad * sizes[0] >= 20.0 * (good + 0.5) * sizes[1]) & (F.length("word") >= 3)).collect())
    lexicon = {r["word"]: _odds(r["bad"], r["good"], sizes) for r in marked}
    if not lexicon:
        return Scorer({})

    sample = labelled_sample(labels.withColumn("toxic", F.col("toxic").cast("int")).where("toxic in (0, 1)"), "toxic", fit_rows)
    some = materialise(texts.join(F.broadcast(sample), ["doc_id", "toxic"], "left_semi").dropDuplicates(["toxic", "h"]).select("toxic", "h", "text"), "toxic-sample")
    n = {0: 1, 1: 1, **{r["toxic"]: r["count"] for r in some.groupBy("toxic").count().collect()}}
    first = docs.sparkSession.sparkContext.broadcast(Scorer({t: (w, 0.0) for t, w in lexicon.items()}))

    # Misspelt matches of each term, by class: how far a near match is to be believed.
    near = _by_class(some, lambda text: {m[0] for m in first.value.matches(text) if m[1]})
    seen = {r["word"]: _odds(r["bad"], r["good"], n) for r in near.collect()}
    # A term never met misspelt is believed at three quarters of its own weight.
    lexicon = {t: (w, min(w, seen[t]) if t in seen else 0.75 * w) for t, w in lexicon.items()}
    # Words beside matches: toxic texts against others, among the texts with a match.
    beside = materialise(_by_class(some, lambda text: first.value.beside(text) | {""}), "toxic-context")
    met = {1: 0, 0: 0}
    for r in beside.where("word = ''").collect():
        met = {1: r["bad"], 0: r["good"]}
    found = [] if not met[0] or not met[1] else beside.where((F.col("word") != "") & (_surprise(bad, good, met) >= evidence)).collect()
    context = {r["word"]: max(-1.0, min(1.0, _odds(r["bad"], r["good"], met) / 3)) for r in found}
    model = Scorer(lexicon, context=context)
    second = docs.sparkSession.sparkContext.broadcast(model)

    def sums(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([second.value.sums(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = some.select("toxic", "text").mapInArrow(sums, "toxic int, x array<double>").toArrow()
    model.layer = logistic(np.array(rows.column("x").to_pylist()), rows.column("toxic").to_pylist())
    for held in (first, second):
        held.destroy()
    return Scorer(model.lexicon, model.layer, context)


def score(docs: DataFrame, model: Scorer, cut: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            s = [m.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= cut) for x in s], pa.int32())], names=["doc_id", "score", "predicted"])

    return _texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def detect(docs: DataFrame, labels: DataFrame, cut: float = 0.3, **options) -> DataFrame:
    """Learn from labelled rows that are not held out and score every document."""
    model = learn(docs, labels.where(~held_out()), **options)
    return score(docs, model, cut).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def matches(docs: DataFrame, model: Scorer) -> DataFrame:
    """One row a match: the term, the edits, the word as written, quotation and abuse shares of its window."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.float64())
        for b in batches:
            rows = [(i, *m) for i, t in zip(b.column(0).to_pylist(), b.column(1)) for m in shared.value.matches(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], names=["doc_id", "term", "edits", "word", "quoted", "abuse"])

    return _texts(docs).mapInArrow(run, "doc_id long, term string, edits int, word string, quoted double, abuse double")
