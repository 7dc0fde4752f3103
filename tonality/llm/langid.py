"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of order 3 is counted once and then frozen.
A byte after a context costs -log2 of its frozen probability: its count over
(total + distinct) where the context has seen it (method C), else the escape
probability times its probability in the next shorter context, with the bytes
that the longer context would have coded excluded, down to the uniform order -1
over all 256 bytes. A text's cost in a language is the exact sum; the cheapest
language wins. Only contexts that were seen are stored, so a language takes memory
by its own strings and no byte shares a class with another. Letters A-Z count as a-z.

Defined results
  null text, or text without a letter: ``und`` with score 0; no labelled text to
  learn from: every text is ``und``; null lang rows are scored, never learned from;
  equal costs: the smallest language name; copies of a text in the fit sample teach
  once; repeated rows and null ids keep their own rows; an empty table gives no
  rows. Only named columns are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import held_out, hold, materialise

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ORDER = 3
START = b" " * ORDER  # what stands before a text
CHUNK = 1 << 20  # bytes counted or scored at a time
FINE = 1 << 40   # steps of a sampling share


def grams(folded: bytes):
    """The 4-byte strings of ``folded`` as integers, one for each byte after the first three."""
    import numpy as np

    c = np.frombuffer(folded, dtype=np.uint8).astype(np.uint32)
    return (c[:-3] << 24) | (c[1:-2] << 16) | (c[2:-1] << 8) | c[3:]


def merged(keys, counts):
    """Sorted distinct keys with the sums of their counts."""
    import numpy as np

    at, back = np.unique(keys, return_inverse=True)
    return at, np.bincount(back, weights=counts, minlength=len(at)).astype(np.int64)


class Tree:
    """Frozen code lengths of one language: per order the seen strings and the seen contexts' escapes."""

    def __init__(self, keys, counts):
        import numpy as np

        self.orders, below = [], None
        for k in range(ORDER + 1):
            seen, n = merged(keys & np.uint32((1 << 8 * (k + 1)) - 1), counts)
            if not len(seen):
                break
            contexts, start = np.unique(seen >> 8, return_index=True)
            total, kinds = np.add.reduceat(n, start), np.diff(np.append(start, len(seen)))
            # probability of each string's last byte in the shorter context, which has seen it too
            low = np.full(len(seen), 1 / 256) if below is None else below[1][np.searchsorted(below[0], seen & np.uint32((1 << 8 * k) - 1))]
            rest = 1 - np.add.reduceat(low, start)
            closed = (kinds == 256) | (rest <= 1e-12)  # nothing left to escape to
            room = np.where(closed, total, total + kinds)
            p = n / np.repeat(room, kinds)
            escape = np.where(closed, 1e-12, kinds / room / np.maximum(rest, 1e-12))
            self.orders.append((seen, (-np.log2(p)).astype(np.float32), contexts.astype(np.uint32), (-np.log2(escape)).astype(np.float32)))
            below = seen, p

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for order in self.orders for a in order)

    def bits(self, strings):
        """Code length of the last byte of each 4-byte string after the three before it."""
        import numpy as np

        out, open_ = np.zeros(len(strings)), np.arange(len(strings))
        for k in range(len(self.orders) - 1, -1, -1):
            seen, cost, contexts, escape = self.orders[k]
            key = strings[open_] & np.uint32((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(seen, key), len(seen) - 1)
            hit = seen[at] == key
            out[open_[hit]] += cost[at[hit]]
            open_, context = open_[~hit], key[~hit] >> 8
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            met = contexts[at] == context
            out[open_[met]] += escape[at[met]]
        out[open_] += 8.0
        return out


class Model:
    """Frozen counts of 4-byte strings, language -> (sorted strings, counts)."""

    def __init__(self, counts: dict):
        self.key, self.langs, self.counts = uuid.uuid4().hex, sorted(counts), counts

    def trees(self) -> list[Tree]:
        return [Tree(*self.counts[lang]) for lang in self.langs]


_TREES: dict[str, list[Tree]] = {}


def _trees(model: Model) -> list[Tree]:
    if model.key not in _TREES:
        _TREES.clear()
        _TREES[model.key] = model.trees()
    return _TREES[model.key]


def code_lengths(model: Model, texts: list[bytes]):
    """[text, language] bits of each text in each language (order of ``model.langs``)."""
    import numpy as np

    trees, out = _trees(model), np.zeros((len(texts), len(model.langs)))

    def settle(parts):
        """Pieces of texts with the three bytes before each: equal strings are looked up once."""
        size = np.array([len(p) for _, p in parts])
        whole = grams(b"".join(p for _, p in parts))
        inside = np.ones(size.sum(), dtype=bool)
        for back in range(1, ORDER + 1):  # strings that would run into the next piece
            inside[np.cumsum(size) - back] = False
        strings, where = np.unique(whole[inside[:-ORDER]], return_inverse=True)
        first = np.concatenate([[0], np.cumsum(size - ORDER)[:-1]])
        rows = [row for row, _ in parts]
        for k, tree in enumerate(trees):
            np.add.at(out[:, k], rows, np.add.reduceat(tree.bits(strings)[where], first))

    parts, held = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), CHUNK):
            before = text[max(0, at - ORDER):at].rjust(ORDER)
            parts.append((row, (before + text[at:at + CHUNK]).translate(FOLD)))
            held += len(parts[-1][1])
            if held >= CHUNK:
                settle(parts)
                parts, held = [], 0
    if parts:
        settle(parts)
    return out


def fit(docs: DataFrame, fit_rows: int = 3000) -> Model:
    """Learn from the rows of ``docs`` that have a lang.

    The fit uses a bounded sample: about ``fit_rows`` different texts of each
    language, chosen by their hash, all of them where a language has fewer. What
    reaches the driver is one row for each different 4-byte string of a language's
    sample.
    """
    import numpy as np

    known = (docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
             .where("lang is not null and text is not null").withColumn("h", F.xxhash64("text")))
    kinds = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    langs = sorted(kinds)
    if not langs:
        return Model({})
    of = F.create_map(*[x for i, name in enumerate(langs) for x in (F.lit(name), F.struct(F.lit(i).alias("i"), F.lit(int(FINE * fit_rows / max(1, kinds[name]))).alias("share")))])
    sample = materialise(known.withColumn("of", of[F.col("lang")]).where(F.pmod("h", F.lit(FINE)) < F.col("of.share"))
                         .groupBy(F.col("of.i").alias("lang"), "h").agg(F.first("text").alias("text")).select("lang", "text"), "langid-sample")

    def count(batches):
        import numpy as np
        import pyarrow as pa

        held: dict[int, list] = {}   # strings as they come
        total: dict[int, tuple] = {}  # lang -> (strings, counts)
        waiting = 0

        def fold():
            for lang in list(held):
                keys = np.concatenate(held.pop(lang))
                keys, n = merged(np.concatenate([keys, total[lang][0]]), np.concatenate([np.ones(len(keys)), total[lang][1]])) if lang in total else np.unique(keys, return_counts=True)
                total[lang] = keys, n

        def rows():
            for lang, (keys, n) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), lang, dtype=np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "g", "n"])
            total.clear()

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = t.as_py().encode()
                for at in range(0, len(raw), CHUNK):
                    held.setdefault(lang, []).append(grams((raw[max(0, at - ORDER):at].rjust(ORDER) + raw[at:at + CHUNK]).translate(FOLD)))
                    waiting += len(held[lang][-1])
                    if waiting > 4 * CHUNK:
                        fold()
                        waiting = 0
                        if sum(len(keys) for keys, _ in total.values()) > 2 * CHUNK:
                            yield from rows()
        fold()
        yield from rows()

    found = sample.mapInArrow(count, "lang int, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toArrow()
    lang, g, n = (found.column(c).to_numpy() for c in ("lang", "g", "n"))
    return Model({name: merged(g[lang == i].astype(np.uint32), n[lang == i]) for i, name in enumerate(langs) if (lang == i).any()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the cheapest language and its share 2^-bits of all languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hold("langid", _TREES.clear)
        m = shared.value
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            told = [i for i, t in enumerate(texts) if m.langs and any(map(str.isalpha, t))]
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            bits = code_lengths(m, [texts[i].encode() for i in told])
            for i, row in zip(told, bits):
                k = int(np.argmin(row))
                lang[i], score[i] = m.langs[k], 1 / np.exp2(np.maximum(row[k] - row, -1000)).sum()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, fit_rows: int = 3000) -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    model = fit(docs.where(~held_out()), fit_rows)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
