"""Benchmark decontamination by latent semantic retrieval.

Passages (overlapping word windows) and benchmark items are TF-IDF vectors
over the words of the benchmark; the document frequencies cover every passage.
A randomised SVD of those vectors, computed by Spark over every passage of every
document with the items joined in at equal weight, gives a latent space. Every
passage of every document is projected, and the items whose cosine reaches
``cosine`` are candidates. An item no longer than a passage shares it with other
words, which lower the cosine: it is also a candidate where the passage holds
``HOLDS`` of it, by the projection of the passage on the item, whatever else the
passage has. Exact copies of items of every length are candidates by look-up of
the item's rarest word. A candidate is a leak if the longest common
subsequence of words covers enough of the item, or, for paraphrases, a smaller
share together with the item's answer, its last words.

Texts are split once a pass: each becomes the numbers of its words in the
vocabulary of the pass, in whole blocks of words, and every later step reads those
numbers, many texts at a time.

Defined results
  null or empty text: no passage, no leak; items without a word never match, and
  items of fewer than ``short`` words match only as they stand; items under
  ``least_words`` words are reported, but ``clean`` removes nothing for them, since
  a word or two stand in any text; items with a null id are searched and reported
  as one item without id; equal items are each reported; of a document and an item, the strongest passage is reported
  (ties: the first); repeated rows and null ids: each document row is searched,
  and rows with equal ids give one result; ``clean`` judges each row by its own
  text, whatever its id; an empty table gives no rows. Only named columns are
  read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import materialise
from tonality.llm.licenses import WORDS

BLOCK = 16             # words; a passage is SPAN blocks long, and one starts at every block
SPAN = 2
HOLDS = 0.5            # share of an item's weight in a passage that makes it a candidate, for items within a passage
ITEMS = 2000           # items searched in one pass over the documents
VOCABULARY = 1 << 16   # words that the items of one pass have together (an item with more has a pass of its own)
ROUNDING = 1e-4        # more than single precision changes a cosine
AT_ONCE = 1 << 11      # blocks of words that a task works on at once (a longer text is worked on whole)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: letters, digits and all non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(WORDS).split()


def lcs(masks: dict[bytes, int], size: int, other: list[bytes]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of the item's words as bits."""
    full = (1 << size) - 1
    v = full
    for w in other:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


class Item:
    def __init__(self, item_id: int, ws: list[bytes], answer_words: int):
        self.id, self.words = item_id, ws
        self.masks = places(ws)
        self.different, self.repeats = frozenset(self.masks), len(ws) - len(self.masks)
        # an item that lies half in the passage is seen whole; whole blocks, so that items share regions
        self.pad = -(-max(len(ws) - SPAN * BLOCK // 2, 2 * BLOCK) // BLOCK) * BLOCK
        # the answer is the end of the item: at most ``answer_words`` words, a third of a short item
        self.answer_words = answer_words
        self.answer = ws[-max(1, min(answer_words, len(ws) // 3)):] if ws else []
        self.answer_masks = places(self.answer)

    def coded(self, vocab: dict[bytes, int]) -> Item:
        """The same item with the numbers of its words for words."""
        return Item(self.id, [vocab[w] for w in self.words], self.answer_words)


def places(ws: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(ws):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Space:
    """Vocabulary of the benchmark, term weights, latent basis and the items in it."""

    def __init__(self, items: list[Item]):
        import numpy as np

        self.items = items
        self.vocab = {w: i for i, w in enumerate(sorted({w for it in items for w in it.words}))}
        self.weight = np.ones(len(self.vocab), dtype=np.float32)
        self.basis = None  # words x rank
        self.coded = [it.coded(self.vocab) for it in items]
        self.bytes = [np.array(it.words, dtype=self.dtype).tobytes() for it in self.coded]
        self.anchored: dict[int, list[tuple[int, int]]] = {}  # word -> (item index, place) of the items whose rarest it is

    @property
    def dtype(self) -> str:
        """Of word numbers: those of the vocabulary, then one for all other words and one that fills the last block."""
        return "<u2" if len(self.vocab) + 2 <= 1 << 16 else "<u4"

    def set_frequencies(self, df, n: int) -> None:
        """IDF; words in more than about one passage in seven weigh nothing unless an item has no other."""
        import numpy as np

        idf = np.log((n + 1) / (np.asarray(df) + 1))
        for k, it in enumerate(self.items):
            if it.words:
                own = [self.vocab[w] for w in it.words]
                place = int(np.argmax(idf[own]))
                self.anchored.setdefault(own[place], []).append((k, place))
        self.weight = np.maximum(idf - 2, 0).astype(np.float32)
        for it in self.items:
            own = [self.vocab[w] for w in it.words]
            if own and not self.weight[own].any():
                self.weight[own] = np.maximum(idf[own], 1e-3)

    def item_vectors(self) -> list:
        """(vocabulary ids, weighted counts) of every item: as many numbers as the items have different words."""
        import numpy as np

        out = []
        for it in self.items:
            ids, n = np.unique(np.fromiter((self.vocab[w] for w in it.words), dtype=np.int64, count=len(it.words)), return_counts=True)
            out.append((ids, (n * self.weight[ids]).astype(np.float32)))
        return out

    def project(self, q):
        """Every item on the columns of ``q``."""
        import numpy as np

        return np.array([x @ q[ids] for ids, x in self.item_vectors()], dtype=np.float32).reshape(len(self.items), q.shape[1])

    def set_basis(self, basis) -> None:
        import numpy as np

        self.basis = np.ascontiguousarray(basis, dtype=np.float32)
        self.rows = np.ascontiguousarray(self.weight[:, None] * self.basis, dtype=np.float32)
        z = self.project(self.basis)
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        self.latent = (z / np.maximum(norm, 1e-9)).astype(np.float32)
        within = np.array([0 < len(it.words) <= SPAN * BLOCK for it in self.items], dtype=bool)
        # the product with a passage at which the passage holds enough of the item
        self.holds = np.where(within & (norm[:, 0] > 1e-6), HOLDS * norm[:, 0], np.inf).astype(np.float32)

    def code(self, texts: list[str | None], vocab):
        """(numbers of all words, each text in whole blocks; blocks of each text); ``vocab``: the words as an Arrow array."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = [(t or "").lower().encode("utf-8", "replace").translate(WORDS).strip() or None for t in texts]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.string()))
        n = pc.fill_null(pc.list_value_length(split), 0).to_numpy().astype(np.int64)
        sizes = -(-n // BLOCK)
        flat = np.full(sizes.sum() * BLOCK, len(vocab) + 1, dtype=self.dtype)
        at = np.arange(n.sum()) + np.repeat((np.cumsum(sizes) - sizes) * BLOCK - (np.cumsum(n) - n), n)
        flat[at] = pc.fill_null(pc.index_in(split.flatten(), value_set=vocab), len(vocab)).to_numpy()
        return flat, sizes

    def words(self):
        import pyarrow as pa

        return pa.array([w.decode() for w in self.vocab], pa.string())

    def copies(self, flat, sizes) -> list[tuple[int, int, int]]:
        """(text, item index, first word) of the first exact copy of every item."""
        import numpy as np

        anchor = np.zeros(len(self.vocab) + 2, dtype=bool)
        anchor[list(self.anchored)] = True
        at, end = np.flatnonzero(anchor[flat]), np.cumsum(sizes) * BLOCK
        text = np.searchsorted(end, at, side="right")
        out, size, whole = {}, flat.itemsize, flat.tobytes()
        for d, p, w, lo in zip(text.tolist(), at.tolist(), flat[at].tolist(), (end - sizes * BLOCK)[text].tolist()):
            for k, place in self.anchored[w]:
                # a copy cannot run into the next text: a text's last block is filled up, or ends where the next begins
                first, own = p - place, self.bytes[k]
                if (d, k) not in out and first >= lo and first * size + len(own) <= end[d] * size and whole.startswith(own, first * size):
                    out[d, k] = first - lo
        return [(d, k, first) for (d, k), first in out.items()]


def windows(n, span: int):
    """Passages of ``span`` blocks in ``n`` blocks: one at every block, one where the text is shorter."""
    import numpy as np

    return np.where(n > 0, np.maximum(1, n - span + 1), 0)


def within(sizes):
    """Place of every block in its text, for texts of ``sizes`` blocks."""
    import numpy as np

    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def sums(rows, at, counts):
    """Sum of ``rows[at]`` over consecutive groups of ``counts`` entries; the k-th rows of all groups are added at once."""
    import numpy as np

    most = int(counts.max(initial=0))
    if most > BLOCK:  # long groups in pieces, then the pieces
        pieces = -(-counts // BLOCK)
        size = np.full(pieces.sum(), BLOCK)
        some = counts > 0
        size[np.cumsum(pieces)[some] - 1] = (counts - (pieces - 1) * BLOCK)[some]
        part = sums(rows, at, size)
        return sums(part, np.arange(len(part)), pieces)
    order = np.argsort(-counts, kind="stable")
    first, left = (np.cumsum(counts) - counts)[order], counts[order]
    total = np.zeros((len(counts), rows.shape[1]), dtype=np.float32)
    for k in range(most):
        n = np.searchsorted(-left, -k)
        total[:n] += rows.take(at[first[:n] + k], axis=0)
    out = np.empty_like(total)
    out[order] = total
    return out


def block_sums(at, ids, n_words: int, rows):
    """Sum of ``rows[id]`` over each block of words; ``at``: places of the ids, ascending."""
    import numpy as np

    return sums(rows, ids, np.bincount(at // BLOCK, minlength=-(-n_words // BLOCK)))


def passages(blocks, span: int, sizes=None):
    """Rows of ``span`` consecutive blocks, summed, of texts of ``sizes`` blocks (one text if not given)."""
    import numpy as np

    sizes = np.array([len(blocks)]) if sizes is None else sizes
    place, left = within(sizes), np.repeat(sizes, sizes)
    at = np.flatnonzero(place < windows(left, span))
    out, left = blocks[at], (left - place)[at]
    for k in range(1, span):
        more = np.flatnonzero(left > k)
        out[more] += blocks[at[more] + k]
    return out


def spread(z, span: int, sizes):
    """Sum of the rows ``z`` of the passages that hold each block: ``passages`` transposed."""
    import numpy as np

    place, left = within(sizes), np.repeat(sizes, sizes)
    at = np.flatnonzero(place < windows(left, span))
    out, left = np.zeros((len(place), z.shape[1]), dtype=z.dtype), (left - place)[at]
    for k in range(span):
        more = np.flatnonzero(left > k)
        out[at[more] + k] += z[more]
    return out


def _runs(sizes: list[int], most: int):
    """(first, end) of consecutive texts that have ``most`` together, or of one longer text."""
    a = total = 0
    for b, n in enumerate(sizes):
        if b > a and total + n > most:
            yield a, b
            a = b
            total = 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")


def encoded(docs: DataFrame, space: Space) -> DataFrame:
    """(doc_id, codes): the word numbers of every text that is not null, in whole blocks, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        s = shared.value
        vocab = s.words()
        for b in batches:
            for (flat, sizes), a, e in _code(s, b.column(1), vocab):
                ends = np.concatenate([[0], np.cumsum(sizes) * BLOCK * flat.itemsize]).astype(np.int32)
                codes = pa.Array.from_buffers(pa.binary(), e - a, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([b.column(0)[a:e], codes], names=["doc_id", "codes"])

    return _texts(docs).mapInArrow(run, "doc_id long, codes binary")


def _code(space: Space, column, vocab):
    """(numbers and blocks of texts, first and end of them) for parts of a column of texts that are small enough to split together."""
    import pyarrow.compute as pc

    for a, e in _runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), 1 << 24):
        yield space.code(column[a:e].to_pylist(), vocab), a, e


def _decoded(column, dtype: str):
    """(numbers of all words, blocks of each text, first and end of the texts) of about ``AT_ONCE`` blocks each."""
    import numpy as np

    codes = column.to_pylist()
    sizes = np.array([len(c) for c in codes], dtype=np.int64) // (BLOCK * np.dtype(dtype).itemsize)
    for a, e in _runs(sizes.tolist(), AT_ONCE):
        yield np.frombuffer(b"".join(codes[a:e]), dtype=dtype), sizes[a:e], a, e


def frequencies(docs: DataFrame, space: Space):
    """(document frequency of each vocabulary word, count) over all blocks of all documents."""
    return _frequencies(encoded(docs, space), space)


def _frequencies(codes: DataFrame, space: Space):
    import numpy as np

    size, dtype = len(space.vocab), space.dtype

    def run(batches):
        import numpy as np
        import pyarrow as pa

        df, n = np.zeros(size + 1, dtype=np.int64), 0
        for b in batches:
            for flat, sizes, _, _ in _decoded(b.column(0), dtype):
                blocks = np.sort(flat.reshape(-1, BLOCK), axis=1)
                first = np.ones(blocks.shape, dtype=bool)
                np.not_equal(blocks[:, 1:], blocks[:, :-1], out=first[:, 1:])
                df[:-1] += np.bincount(blocks[first], minlength=size + 2)[:size]
                n += len(blocks)
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["w", "n"])

    got = codes.select("codes").mapInArrow(run, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 1, dtype=np.int64)
    df[got["w"].to_numpy()] = got["n"].to_numpy()
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, space: Space, rank: int, fit_docs: int | None = None, rounds: int = 2, seed: int = 7) -> None:
    """Randomised SVD: the range of A'A from random starts, by ``rounds`` distributed products.

    A has the passages of all documents and the items, scaled to the same total
    weight; only a caller that gives ``fit_docs`` has about so many documents (by
    hash of the text). Each task adds its passages into one matrix of vocabulary x
    rank, which Spark sums row by row; that matrix, not the passages, reaches the driver.
    """
    if fit_docs is not None:
        texts = _texts(docs)
        part = min(1.0, fit_docs / max(1, texts.count()))
        docs = materialise(texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < part * (1 << 20)), "decontam-sample")
    codes = encoded(docs, space).persist(StorageLevel.DISK_ONLY)
    _fit(codes, space, rank, rounds, seed)
    codes.unpersist()


def _fit(codes: DataFrame, space: Space, rank: int, rounds: int = 2, seed: int = 7) -> None:
    import numpy as np

    size, own, dtype = len(space.vocab), space.item_vectors(), space.dtype
    width = min(rank + 16, size)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0].astype(np.float32)
    for _ in range(rounds):
        shared = codes.sparkSession.sparkContext.broadcast((space.weight, q))

        def run(batches, shared=shared):
            import numpy as np
            import pyarrow as pa

            weight, q = shared.value
            rows, weight = weight[:, None] * q, np.append(weight, [0, 0]).astype(np.float32)
            weighs = weight > 0
            out, mass = np.zeros(q.shape, dtype=np.float64), 0.0
            for batch in batches:
                for flat, sizes, _, _ in _decoded(batch.column(0), dtype):
                    at = np.flatnonzero(weighs[flat])
                    ids, block = flat[at], at // BLOCK
                    # A' z: every word adds the sum of z over the passages that hold it
                    z = spread(passages(block_sums(at, ids, len(flat), rows), SPAN, sizes), SPAN, sizes)
                    order, n = np.argsort(ids, kind="stable"), np.bincount(ids, minlength=size)
                    some = np.flatnonzero(n)
                    out[some] += sums(z, block[order], n[some])
                    held = spread(np.ones((windows(sizes, SPAN).sum(), 1)), SPAN, sizes)[:, 0]
                    mass += float((weight[ids] ** 2 * held[block]).sum())
            out *= weight[:-2, None]
            keep = np.flatnonzero(np.abs(out).sum(axis=1))
            ends = np.concatenate([[0], 1 + out.shape[1] * np.arange(len(keep) + 1)])
            values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([[mass], out[keep].ravel()])))
            yield pa.RecordBatch.from_arrays([pa.array([-1, *keep], pa.int32()), values], names=["w", "y"])

        got = codes.select("codes").mapInArrow(run, "w int, y array<double>").groupBy("w").agg(*[F.sum(F.get("y", F.lit(k))).alias(f"y{k}") for k in range(width)]).toArrow()
        w, part = got.column("w").to_numpy(), np.nan_to_num(np.array([got.column(f"y{k}").to_numpy() for k in range(width)], dtype=np.float64).T)
        y = np.zeros((size, width))
        y[w[w >= 0]] = part[w >= 0]
        mass = float(part[w < 0, 0].sum())
        scale = mass / max(1e-9, sum(float((x ** 2).sum()) for _, x in own)) if mass else 1.0
        for ids, x in own:
            y[ids] += scale * np.outer(x, x @ q[ids])
        q = np.linalg.qr(y)[0].astype(np.float32)
    # the first ``rank`` directions of the range, by their weight in the last product
    u, _, _ = np.linalg.svd(q.T @ y, full_matrices=False)
    space.set_basis((q @ u)[:, :rank])


class Limits:
    def __init__(self, cosine: float, verbatim: float, paraphrase: float, answer: float, short: int):
        self.cosine, self.verbatim, self.paraphrase, self.answer, self.short = cosine, verbatim, paraphrase, answer, short


def verify(item: Item, region: list[bytes], here: set[bytes], limits: Limits) -> tuple[str, float, float] | None:
    """(kind, share of the item in common, share of its answer) of a leak, else None; ``here``: the region's words."""
    n = len(item.words)
    if not n:
        return None
    if n < limits.short:
        same = any(region[i:i + n] == item.words for i in range(len(region) - n + 1))
        return ("verbatim", 1.0, 1.0) if same else None
    if len(item.different & here) + item.repeats < limits.paraphrase * n:
        return None  # too few even if every repeat of its words occurs
    if sum(m.bit_count() for w, m in item.masks.items() if w in here) < limits.paraphrase * n:
        return None  # too few of the item's words occur at all
    share = lcs(item.masks, n, region) / n
    if share < limits.paraphrase:
        return None
    answer = lcs(item.answer_masks, len(item.answer), region) / len(item.answer)
    if share >= limits.verbatim:
        return "verbatim", share, answer
    return ("paraphrase", share, answer) if answer >= limits.answer else None


def candidates(space: Space, flat, sizes, cosine: float) -> dict[int, list[tuple[int, int, int, float]]]:
    """text -> (item index, first word, end word, cosine) of every passage and item that are close enough, and of exact copies."""
    import numpy as np

    at = np.flatnonzero(np.append(space.weight > 0, [False, False])[flat])
    if not len(at):
        return {}
    z, n = passages(block_sums(at, flat[at], len(flat), space.rows), SPAN, sizes), windows(sizes, SPAN)
    text, place, end = np.repeat(np.arange(len(sizes)), n), within(n), np.cumsum(sizes)
    n_words = BLOCK * sizes - np.where(sizes > 0, (flat.reshape(-1, BLOCK)[end - 1] == len(space.vocab) + 1).sum(axis=1), 0)
    some = np.zeros(len(sizes), dtype=bool)  # texts with a word that weighs
    some[np.searchsorted(end, at // BLOCK, side="right")] = True
    size = np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-9)
    out: dict[int, list[tuple[int, int, int, float]]] = {}
    # one product for all texts finds those that come near a limit; the product of a text alone decides, so its
    # results are the same whatever texts are worked on with it
    close = np.zeros(len(z), dtype=bool)
    for a in range(0, len(z), 8192):
        by = size[a:a + 8192, None]
        close[a:a + 8192] = (z[a:a + 8192] @ space.latent.T >= np.minimum(cosine * by, space.holds) - ROUNDING * by).any(axis=1)
    start = np.cumsum(n) - n
    for d in np.unique(text[close]).tolist():
        for a in range(start[d], start[d] + n[d], 8192) if some[d] else ():
            b = min(a + 8192, start[d] + n[d])
            near, by = z[a:b] @ space.latent.T, size[a:b]
            # of the two limits the lower decides
            hit, item = np.nonzero(near >= np.minimum(cosine * by[:, None], space.holds))
            first = place[hit + a] * BLOCK
            out.setdefault(d, []).extend(zip(item.tolist(), first.tolist(), np.minimum(first + SPAN * BLOCK, n_words[d]).tolist(), (near[hit, item] / by[hit]).tolist()))
    for d, k, first in space.copies(flat, sizes):
        if some[d]:
            i = min(first // BLOCK, int(n[d]) - 1)
            row = start[d] + i
            out.setdefault(d, []).append((k, i * BLOCK, min(int(n_words[d]), (i + SPAN) * BLOCK), float(z[row] @ space.latent[k] / size[row])))
    return out


def search(space: Space, flat, sizes, limits: Limits):
    """(text, item id, kind, cosine, share, answer share, first word) of the strongest leak of every item in every text."""
    import numpy as np

    end = np.cumsum(sizes) * BLOCK
    for d, found in sorted(candidates(space, flat, sizes, limits.cosine).items()):
        ws = flat[end[d] - sizes[d] * BLOCK:end[d]]
        for x in _strongest(space, ws[ws <= len(space.vocab)].tolist(), found, limits):
            yield (d, *x)


def _strongest(space: Space, ws: list[int], found: list[tuple[int, int, int, float]], limits: Limits) -> list[tuple]:
    best: dict[int, tuple] = {}
    seen: dict[int, int] = {}
    regions: dict[tuple[int, int], tuple[list[int], set[int]]] = {}
    for k, a, b, cos in sorted(found):
        item = space.coded[k]
        to = b + item.pad
        known = seen.get(k, -1)
        if known >= to or known >= len(ws):  # the last region of this item reached as far
            continue
        seen[k] = to
        lo = max(0, a - item.pad)
        part = regions.get((lo, to))
        if part is None:
            region = ws[lo:to]
            part = regions[lo, to] = region, set(region)
        leak = verify(item, *part, limits)
        if leak and (k not in best or leak[1] > best[k][3]):
            best[k] = (item.id, leak[0], cos, leak[1], leak[2], lo)
    return list(best.values())


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.65, verbatim: float = 0.8, paraphrase: float = 0.6, answer: float = 0.8,
          short: int = 8, answer_words: int = 8, rank: int = 128, fit_docs: int | None = None) -> DataFrame:
    """(doc_id, item_id, kind, cosine, lcs_share, answer_share, first_word): one row a document and item that leaks.

    The benchmark is the stated query set. It is searched in passes of bounded items
    and words, so what is broadcast is bounded; every pass reads all documents. Their
    word numbers are on the executors' disks until the pass is over.
    """
    kinds = "doc_id long, item_id long, kind string, cosine double, lcs_share double, answer_share double, first_word long"
    out = docs.sparkSession.createDataFrame([], kinds)
    limits = Limits(cosine, verbatim, paraphrase, answer, short)
    for space, codes in _coded_spaces(docs, benchmark, answer_words, rank, fit_docs):
        out = out.unionByName(materialise(_search(codes, space, limits, kinds), "decontam-leaks"))
    strongest = F.max_by(F.struct("kind", "cosine", "lcs_share", "answer_share", "first_word"), F.struct("lcs_share", -F.col("first_word"))).alias("s")
    return out.groupBy("doc_id", "item_id").agg(strongest).select("doc_id", "item_id", "s.*")


def _spaces(docs: DataFrame, benchmark: DataFrame, answer_words: int, rank: int, fit_docs: int | None, least_words: int = 1):
    """The fitted space of every pass over the items."""
    for space, _ in _coded_spaces(docs, benchmark, answer_words, rank, fit_docs, least_words):
        yield space


def _coded_spaces(docs: DataFrame, benchmark: DataFrame, answer_words: int, rank: int, fit_docs: int | None, least_words: int = 1):
    """The fitted space of every pass over the items and the documents' word numbers in it.

    Items are dealt out so that a pass has ``ITEMS`` items and ``VOCABULARY`` words at most.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    items = materialise(rows.withColumn("name", F.xxhash64("item_id", "text")).withColumn("size", F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))), "decontam-items")
    for names in _passes(items.select("name", "size").toArrow()):
        own = items.where(F.col("name").isin(names)).select("item_id", "text").collect()
        found = (Item(r["item_id"], words(r["text"]), answer_words) for r in sorted(own, key=str))
        space = Space([it for it in found if len(it.words) >= least_words])
        if not space.vocab:
            continue
        codes = encoded(docs, space).persist(StorageLevel.DISK_ONLY)
        space.set_frequencies(*_frequencies(codes, space))
        if fit_docs is None:
            _fit(codes, space, rank)
        else:
            fit(docs, space, rank, fit_docs)
        try:
            yield space, codes
        finally:
            codes.unpersist()


def _passes(sizes) -> list[list[int]]:
    """Names of the items of each pass; two numbers an item of the query set are all that it takes."""
    out, n = [], 0
    for name, size in sorted(zip(sizes["name"].to_pylist(), sizes["size"].to_pylist())):
        if not out or n + size > VOCABULARY or len(out[-1]) >= ITEMS:
            out.append([])
            n = 0
        out[-1].append(name)
        n += size
    return out


def _search(codes: DataFrame, space: Space, limits: Limits, kinds: str) -> DataFrame:
    shared = codes.sparkSession.sparkContext.broadcast((space, limits))

    def run(batches):
        import pyarrow as pa

        space, limits = shared.value
        types = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [(ids[a + d], *x) for flat, sizes, a, _ in _decoded(b.column(1), space.dtype) for d, *x in search(space, flat, sizes, limits)]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "kind", "cosine", "lcs_share", "answer_share", "first_word"])

    return codes.mapInArrow(run, kinds)


def clean(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.65, verbatim: float = 0.8, paraphrase: float = 0.6, answer: float = 0.8,
          short: int = 8, answer_words: int = 8, rank: int = 128, fit_docs: int | None = None, least_words: int = 4) -> DataFrame:
    """The rows of ``docs`` in whose text no item of ``least_words`` words or more leaks; every column stays, and there is no shuffle.

    A leak depends on the text alone, so each batch is filtered where it is: ids are not looked at.
    """
    out, at = docs, docs.columns.index("text")
    limits = Limits(cosine, verbatim, paraphrase, answer, short)
    for space in _spaces(docs, benchmark, answer_words, rank, fit_docs, least_words):
        shared = docs.sparkSession.sparkContext.broadcast((space, limits))

        def run(batches, shared=shared):
            import numpy as np
            import pyarrow as pa

            space, limits = shared.value
            vocab = space.words()
            for b in batches:
                kept = np.ones(b.num_rows, dtype=bool)
                for (flat, sizes), a, _ in _code(space, b.column(at), vocab):
                    first = np.cumsum(sizes) - sizes
                    for lo, hi in _runs(sizes.tolist(), AT_ONCE):
                        part = flat[first[lo] * BLOCK:(first[lo] + sizes[lo:hi].sum()) * BLOCK]
                        kept[[a + lo + d for d, *_ in search(space, part, sizes[lo:hi], limits)]] = False
                yield b.filter(pa.array(kept))

        out = out.mapInArrow(run, out.schema)
    return out
