"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are identical) and at least ``max(least, 4 * q)`` words. Where a stretch of
4q words has period q, the first 3q positions each equal the word q further on,
so some aligned block of L words, L the power of two with 2L - 1 <= 3q < 4L - 1,
lies wholly among them. At the scale of L every block is compared with the window
that holds its copies at all distances of that scale: the sum of squared
differences of the word codes is |block|^2 + |copy|^2 - 2 block*copy, and the
products of all distances come from one number-theoretic transform of length 2L.
It is integer arithmetic modulo a prime: a true copy always gives zero, and a
zero that is none is thrown out by the extension, which compares the words. Each
zero's distance seeds an extension to the left and right; a stretch that reaches
four periods is a run.

Two rules leave out blocks that have nothing to give: a block with a word that
does not come again within the largest distance has no copy there, and a block
whose whole window lies in a run of a period of at most L, found at a smaller
scale, matches at that period's multiples only, which give the same run again.

A text is worked on by itself, so documents stay where they are: no shuffle. A
group of texts of about ``GROUP`` words is held at a time, or one longer text.

Defined results
  null or empty text, or text without a word: no runs, collapsed text '';
  invalid UTF-8 is compared and returned byte by byte;
  ties, repeated rows, null and equal ids: each row is its own;
  empty table: no rows. Only the id and text columns are read, so other columns
  may have any name. Texts of up to 2^29 words (all that a string can hold, but for
  one-letter words) are covered by the transform's length.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = 3 * 2**30 + 1  # transforms of up to 2^30 numbers; products of two residues fit 64 bits
ROOT = 5
GROUP = 1 << 18  # words held at a time
CELLS = 1 << 19  # numbers of one transform call

RUNS = "array<struct<start:long,length:long,period:long>>"


def distances(size: int) -> tuple[int, int]:
    """The smallest and largest period whose runs hold an aligned block of ``size`` words (a power of two)."""
    return (2 * size + 1) // 3, (4 * size + 1) // 3 - 1


@lru_cache(maxsize=48)
def _powers(n: int, inverse: bool):
    """Powers 0 .. n/2 - 1 of an n-th root of unity, by doubling; one table a size, 4 bytes a number."""
    import numpy as np

    w = pow(ROOT, (PRIME - 1) // n, PRIME)
    w = pow(w, -1, PRIME) if inverse else w
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n // 2:
        out = np.concatenate([out, out * np.uint64(pow(w, len(out), PRIME)) % np.uint64(PRIME)])
    return out.astype(np.uint32)


def _mod(x):
    """Residues of unsigned 64-bit numbers."""
    import numpy as np

    p = np.uint64(PRIME)
    return x - x // p * p


def transform(a, inverse: bool = False):
    """Number-theoretic transform along the first axis of an (n, columns) array of residues.

    Forward leaves the result in bit-reversed order and inverse takes that order,
    so a product of two transforms needs no reordering.
    """
    import numpy as np

    n, columns = a.shape
    p = np.uint64(PRIME)
    halves = [1 << i for i in range(n.bit_length() - 1)]
    for h in halves if inverse else reversed(halves):
        w = _powers(2 * h, inverse).astype(np.uint64)[:, None]
        a = a.reshape(-1, 2, h, columns)
        u, v = a[:, 0], a[:, 1]
        if inverse:
            v = _mod(v * w)
        plus, minus = u + v, u + (p - v)
        out = np.empty_like(a)
        np.minimum(plus, plus - p, out=out[:, 0])  # below p the difference wraps round to a huge number
        minus = np.minimum(minus, minus - p)
        out[:, 1] = minus if inverse else _mod(minus * w)
        a = out
    a = a.reshape(n, columns)
    return _mod(a * np.uint64(pow(n, -1, PRIME))) if inverse else a


def copies(x, starts, size: int):
    """(block start, distance) of every zero of the squared differences, for blocks of ``size`` codes at ``starts``.

    ``x`` must reach ``3 * size`` codes beyond the last start.
    """
    import numpy as np

    lo, hi = distances(size)
    n, m = 2 * size, hi - lo + 1
    step = max(1, CELLS // n)
    found = []
    for at in range(0, len(starts), step):
        b = starts[at:at + step]
        block = x[b[None, :] + np.arange(size)[:, None]].astype(np.uint64)
        window = np.zeros((n, len(b)), dtype=np.uint64)
        window[:m + size - 1] = x[b[None, :] + np.arange(lo, hi + size)[:, None]]
        turned = np.zeros((n, len(b)), dtype=np.uint64)
        turned[0], turned[n - size + 1:] = block[0], block[:0:-1]
        product = transform(_mod(transform(window) * transform(turned)), inverse=True)[:m]
        sums = np.zeros((n + 1, len(b)), dtype=np.uint64)
        np.cumsum(_mod(window * window), axis=0, out=sums[1:])
        square = _mod(sums[size:size + m] - sums[:m] + _mod(block * block).sum(axis=0, dtype=np.uint64))
        d, k = np.nonzero(square == _mod(product * np.uint64(2)))
        found.append((b[k], d + lo))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _gaps(x):
    """Distance of each code to its next occurrence; a huge number where there is none."""
    import numpy as np

    gap = np.full(len(x), 1 << 40, dtype=np.int64)
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def find_runs(codes: list, least: int = 6) -> list[list[tuple[int, int, int]]]:
    """For each sequence of codes its runs (start, length, period), by start, then period.

    Codes of one sequence are integers from 0 to its length - 1, equal where the words are.
    """
    import numpy as np

    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    total = int(ends[-1]) if len(ends) else 0
    runs: list[dict] = [{} for _ in codes]  # a sequence's (start, end) -> period, in places of the whole group
    if not total:
        return [[] for _ in codes]
    # codes of different sequences differ, and 0 stands for no word
    x = np.concatenate([np.asarray(c, dtype=np.int64) + (a + 1) for c, a in zip(codes, begins)])
    longest, size = int(lengths.max()), 2
    far = _gaps(x)
    pad = 4 * (1 << longest.bit_length())
    x = np.concatenate([x, np.zeros(pad, dtype=np.int64)])
    while distances(size)[0] * 4 <= longest or size == 2:
        lo, hi = distances(size)
        far = np.concatenate([far, np.full(len(far) % 2, 1 << 40)]).reshape(-1, 2).max(axis=1)
        b = np.flatnonzero(far <= hi) * size
        b = b[lengths[np.searchsorted(ends, b, side="right")] >= max(least, 4 * lo)]
        known = [(s, e, q) for r in runs for (s, e), q in r.items() if q <= size and e - s >= lo + size]
        live = np.ones(len(b), dtype=bool)
        for s, e, _ in known:
            live[slice(*np.searchsorted(b, [s, max(s, e - hi - size + 1)]))] = False
        at, d = copies(x, b[live], size)
        order = np.argsort(at, kind="stable")
        at, d = at[order], d[order]
        stay = np.ones(len(at), dtype=bool)
        for s, e, q in known:
            i, j = np.searchsorted(at, [s, e])
            stay[i:j] &= (at[i:j] + d[i:j] + size > e) | (d[i:j] % q != 0)
        at, d = at[stay], d[stay]
        doc = np.searchsorted(ends, at, side="right")
        order = np.lexsort((at, d, doc))
        at, d, doc = at[order], d[order], doc[order]
        cut = np.flatnonzero(np.diff(doc) | np.diff(d)) + 1
        for i, j in zip([0, *cut], [*cut, len(at)]) if len(at) else ():
            q, k, first = int(d[i]), int(doc[i]), int(begins[doc[i]])
            words = x[first:int(ends[k])]
            off = np.flatnonzero(words[:-q] != words[q:])
            seeds = at[i:j] - first
            place = np.searchsorted(off, seeds)
            left = np.where(place > 0, off[np.maximum(place - 1, 0)] + 1, 0) if len(off) else np.zeros(len(seeds), dtype=np.int64)
            right = np.where(place < len(off), off[np.minimum(place, len(off) - 1)], len(words) - q) if len(off) else np.full(len(seeds), len(words) - q)
            true = (right >= seeds + size) & (right + q - left >= max(least, 4 * q))
            for s, e in set(zip(left[true].tolist(), (right[true] + q).tolist())):
                key = (s + first, e + first)
                runs[k][key] = min(q, runs[k].get(key, q))
        size *= 2
    return [sorted((s - int(a), e - s, q) for (s, e), q in r.items()) for r, a in zip(runs, begins)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, length, q in runs:
        keep[start + q:start + length] = bytes(length - q)
    return b" ".join(w for w, k in zip(words, keep) if k)


def _codes(words: list[bytes]):
    import numpy as np

    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def periodic_runs(docs: DataFrame, least: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every run of each text, and the text with each run cut to its first period."""
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

        def flush(ids, texts):
            found = find_runs([_codes(w) for w in texts], least)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, kind),
                 pa.array([collapse(w, r) for w, r in zip(texts, found)], pa.binary())], names=["doc_id", "n_words", "runs", "bytes"])

        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                words = (t.as_py() or b"").split()  # splits at space and \x09-\x0D
                if ids and held + len(words) > GROUP:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i.as_py())
                texts.append(words)
                held += len(words)
        if ids:
            yield flush(ids, texts)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")) \
                .mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, bytes binary")
    return found.select("doc_id", "n_words", "runs", F.col("bytes").cast("string").alias("collapsed"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's input, in which one text in ten goes periodic from some word on.

    h = crc32(doc_id as text); where h % 10 = 0, words from a = (h / 10) % n on repeat the first
    1 + (n - a) / (3 + (h / 10) % 8) of them. Rows with a null id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    white = "[\\x20\\x09-\\x0D]+"
    words = F.filter(F.split(F.col("text").cast("string"), white), lambda w: w != "")
    g = F.floor(h / 10).cast("long")

    def plant(w):
        n = F.size(w)
        a = F.pmod(F.col("g"), F.greatest(n, F.lit(1))).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
        unit = F.slice(w, a + 1, p)
        tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise("")

    text = F.when(h % 10 == 0, F.transform(F.array(words), plant)[0]).otherwise(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("g", g).select("doc_id", text.alias("text"))


def summary(docs: DataFrame) -> DataFrame:
    """One row a document: number of runs, the longest run, digests of all runs and of the collapsed text."""
    rows = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(F.col("best.length") * 1000 / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
