"""Suffix-array dedup: bytes covered by a string of ``size`` bytes that starts elsewhere too.

Every window of ``size`` bytes has an anchor, the place of the smallest 8-byte
hash among its first ``reach`` positions, which depends on the window's bytes only.
So equal windows have their anchors at equal offsets, and it is enough to compare
the contexts of anchors: the bytes that windows with this anchor can cover.

1. Each task lists the anchors of its texts with two hashes: of the bytes that
   all windows of the anchor share (key), and of the whole context.
2. Grouped counts: a key met once is done. A context met again is repeated as a
   whole.
3. Contexts met once whose key is shared are ordered by linear grouping
   (``suffixarray``): once by what follows the key, once by what precedes it,
   backwards. Common prefixes of neighbours give, for every offset, the classes of
   equal left and equal right parts; an offset repeats if another context is in
   both classes. Contexts of very frequent keys are instead spread over all
   tasks, one row an offset, and counted.
4. The repeated windows are merged per text, and their bytes removed.

Defined results
  null text: as the empty text; texts shorter than ``size`` keep everything; of
  equal texts, each is another place, so all their windows repeat; repeated rows
  and null ids keep their own rows and count as places; an empty table gives no
  rows. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import materialise
from tonality.llm.suffixarray import suffix_array

REACH = 192        # first positions of a window in which its anchor lies
PIECE = 1 << 20    # positions hashed at a time
BATCH = 20_000     # contexts in one suffix array
HOT = 20_000       # contexts of a key beyond which they are counted offset by offset
BLOCK = 32         # bytes of a symbol: a row is a handful of symbols, so the grouping has few to order


def position_hashes(raw: bytes):
    """A 32-bit hash of the 8 bytes at every position (0 bytes beyond the end)."""
    import numpy as np

    b = np.frombuffer(raw + bytes(7), dtype=np.uint8).astype(np.uint64)
    n = len(raw)
    x = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        x |= b[k:k + n] << np.uint64(8 * k)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(32)


def anchors(raw: bytes, size: int, reach: int):
    """Ascending places of the anchors of all windows of a text."""
    import numpy as np

    n = len(raw) - size + 1      # windows
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = []
    for at in range(0, n, PIECE):
        m = min(PIECE, n - at)
        # hash in the high half, place in the low half: the smallest is the first of the smallest hashes
        x = (position_hashes(raw[at:at + m + reach + 6])[:m + reach - 1] << np.uint64(32)) | np.arange(m + reach - 1, dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            x = np.minimum(x[:-span], x[span:])
            span *= 2
        if span < reach:
            x = np.minimum(x[:m], x[reach - span:reach - span + m])
        a = (x[:m] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out.append(at + a[np.flatnonzero(np.diff(a, prepend=-1))])
    return np.unique(np.concatenate(out))


def repeated_offsets(keys, left, left_n, right, right_n):
    """Smallest and largest repeated offset of every context (-1: none).

    ``left`` holds the bytes before the anchor, nearest first, and ``right`` those
    after the key, one row a context, padded; ``left_n`` and ``right_n`` say how many
    are real. At offset d a window has d bytes on the left and width - d on the right.
    """
    import numpy as np

    n, width = left.shape
    low, high = np.full(n, -1), np.full(n, -1)
    left_class, right_class = _classes(keys, left, left_n), _classes(keys, right, right_n)
    for d in range(width + 1):
        real = np.flatnonzero((left_n >= d) & (right_n >= width - d))
        if len(real) < 2:
            continue
        both = left_class(d)[real].astype(np.int64) * n + right_class(width - d)[real]
        _, inverse, count = np.unique(both, return_inverse=True, return_counts=True)
        hit = real[count[inverse] > 1]
        low[hit] = np.where(low[hit] < 0, d, low[hit])
        high[hit] = d
    return low, high


def _classes(keys, rows, real):
    """Function d -> class of every row: equal key and first d bytes, from the order of a suffix array."""
    import numpy as np

    n, width = rows.shape
    blocks = -(-width // BLOCK)
    padded = np.zeros((n, blocks * BLOCK), dtype=np.uint8)
    padded[:, :width] = rows
    # symbols of a row: its key, its blocks (byte strings, which order as the bytes do), its real length
    values = padded.view(f"S{BLOCK}").reshape(n, blocks)
    _, symbol = np.unique(values, return_inverse=True)
    _, key = np.unique(keys, return_inverse=True)
    text = np.hstack([key.reshape(n, 1), symbol.reshape(n, blocks), real.reshape(n, 1)]).astype(np.int64) + 1
    step = blocks + 2
    order = np.array([i // step for i in suffix_array(text.ravel().tolist()) if i % step == 0], dtype=np.int64)
    a, b = order[:-1], order[1:]
    differ = padded[a] != padded[b]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.where(key[a] == key[b], np.minimum(common, np.minimum(real[a], real[b])), -1)

    def of(d: int):
        out = np.empty(n, dtype=np.int64)
        out[order] = np.concatenate([[0], np.cumsum(common < d)])
        return out

    return of


def _stored(docs: DataFrame) -> DataFrame:
    """(d, th, doc_id, z): texts, compressed; (d, th) names a text, d is the id or, for null, the smallest long."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        from xxhash import xxh3_64_intdigest

        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            raw = [(t.as_py() or "").encode() for t in b.column(1)]
            th = pa.array([(h := xxh3_64_intdigest(x)) - (h >> 63 << 64) for x in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), th, pa.array([press.compress(x) for x in raw], pa.binary())], names=["doc_id", "th", "z"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, th long, z binary").withColumn("d", F.coalesce("doc_id", F.lit(-(1 << 63))))


def _anchor_rows(stored: DataFrame, size: int, reach: int) -> DataFrame:
    """(d, th, at, key, ctx) of every anchor."""
    share = size - reach + 1

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard
        from xxhash import xxh3_64_intdigest as h

        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            for d, th, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = open_.decompress(z.as_py())
                at = anchors(raw, size, reach)
                for k in range(0, len(at), 1 << 16):
                    part = at[k:k + (1 << 16)].tolist()
                    key = np.array([h(raw[a:a + share]) for a in part], dtype=np.uint64)
                    ctx = np.array([h(raw[max(0, a - reach + 1):a + size], min(a, reach - 1)) for a in part], dtype=np.uint64)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, d)), pa.array(np.full(n, th)), pa.array(part, pa.int32()), pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64))],
                                                     names=["d", "th", "at", "key", "ctx"])

    return stored.select("d", "th", "z").mapInArrow(run, "d long, th long, at int, key long, ctx long")


def _contexts(stored: DataFrame, reps: DataFrame, size: int, reach: int) -> DataFrame:
    """(key, ctx, n_ctx, l, r): the bytes on either side of the shared ones, for one place of every context."""
    share = size - reach + 1
    at = reps.groupBy("d", "th").agg(F.collect_list(F.struct("at", "key", "ctx", "n_ctx")).alias("a"))

    def run(batches):
        import pyarrow as pa
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        for b in batches:
            for z, a in zip(b.column(0), b.column(1)):
                raw = open_.decompress(z.as_py())
                rows = [(x["key"], x["ctx"], x["n_ctx"], raw[max(0, x["at"] - reach + 1):x["at"]][::-1], raw[x["at"] + share:x["at"] + size]) for x in a.as_py()]
                for k in range(0, len(rows), 1 << 14):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[k:k + (1 << 14)]), types)], names=["key", "ctx", "n_ctx", "l", "r"])

    return stored.join(at, ["d", "th"]).select("z", "a").mapInArrow(run, "key long, ctx long, n_ctx long, l binary, r binary")


def _offsets(contexts: DataFrame, width: int, hot: int) -> DataFrame:
    """(key, ctx, low, high): the smallest and largest offset at which a context repeats; contexts without one are left out."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows_of(column):
            raw = [x.as_py() for x in column]
            return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raw), dtype=np.uint8).reshape(len(raw), width), np.array([len(x) for x in raw])

        def solve(t):
            keys, ctx = t.column("key").to_numpy(), t.column("ctx").to_numpy()
            _, one = np.unique(np.stack([keys, ctx]), axis=1, return_index=True)  # rows of equal id and text give a context twice
            t, keys, ctx = t.take(one), keys[one], ctx[one]
            low, high = repeated_offsets(keys, *rows_of(t.column("l")), *rows_of(t.column("r")))
            hit = np.flatnonzero(low >= 0)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[hit], ctx[hit], low[hit], high[hit])], names=["key", "ctx", "low", "high"])

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows >= BATCH:  # whole keys only; the last may go on
                keys = held.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1], side="left"))
                if cut:
                    yield solve(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held.combine_chunks())

    usual = contexts.where(F.col("n_ctx") <= hot).select("key", "ctx", "l", "r").repartition("key").sortWithinPartitions("key")
    found = usual.mapInArrow(run, "key long, ctx long, low long, high long")
    many = contexts.where(F.col("n_ctx") > hot).dropDuplicates(["key", "ctx"])
    one = many.select("key", "ctx", "l", "r", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("o")).where(f"length(l) >= o and length(r) >= {width} - o")
    one = one.select("key", "ctx", "o", F.expr(f"xxhash64(substring(l, 1, o), substring(r, 1, {width} - o))").alias("h"))
    again = one.groupBy("key", "o", "h").agg(F.count("*").alias("n")).where("n > 1").select("key", "o", "h")
    counted = one.join(again, ["key", "o", "h"]).groupBy("key", "ctx").agg(F.min("o").cast("long").alias("low"), F.max("o").cast("long").alias("high"))
    return found.unionByName(counted)


def _finish(stored: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, spans, n_bytes, n_removed, n_spans, kept_sha256)."""
    lists = ranges.groupBy("d", "th").agg(F.collect_list(F.struct("a", "b")).alias("s"))

    def run(batches):
        import pyarrow as pa
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for z, s in zip(b.column(1), b.column(2)):
                raw = open_.decompress(z.as_py())
                spans: list[list[int]] = []
                for x in sorted((max(0, y["a"]), min(len(raw), y["b"])) for y in s.as_py() or ()):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x[1])
                    else:
                        spans.append(list(x))
                kept, at = hashlib.sha256(), 0
                for a, e in [*spans, (len(raw), len(raw))]:
                    kept.update(raw[at:a])
                    at = e
                rows.append((spans, len(raw), sum(e - a for a, e in spans), len(spans), kept.hexdigest()))
            types = (pa.list_(pa.list_(pa.int64())), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(list(c), t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)]],
                                             names=["doc_id", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return stored.join(lists, ["d", "th"], "left").select("doc_id", "z", "s").mapInArrow(
        run, "doc_id long, spans array<array<long>>, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_spans(docs: DataFrame, size: int = 400, reach: int | None = None, hot: int = HOT) -> DataFrame:
    """(doc_id, spans, n_bytes, n_removed, n_spans, kept_sha256): maximal removed runs [start, end) of every text."""
    reach = reach or min(REACH, size // 2)
    width = reach - 1
    stored = _stored(docs)
    rows = materialise(_anchor_rows(stored, size, reach), "spans-anchors")
    each = rows.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("d", "th", "at")).alias("p"))
    keyed = each.groupBy("key").agg(F.sum("n").alias("tot"), F.count("*").alias("n_ctx")).where("tot > 1").select("key", "n_ctx")
    met = materialise(each.join(keyed, "key").select("key", "ctx", "n", "n_ctx", "p.d", "p.th", "p.at"), "spans-met")
    contexts = _contexts(stored, met.where("n_ctx > 1").select("d", "th", "at", "key", "ctx", "n_ctx"), size, reach)
    some = _offsets(materialise(contexts, "spans-contexts"), width, hot)
    part = (met.where("n = 1").join(some, ["key", "ctx"])
            .select("d", "th", (F.col("at") - F.col("high")).alias("a"), (F.col("at") - F.col("low") + size).alias("b")))
    whole = rows.join(met.where("n > 1").select("key", "ctx"), ["key", "ctx"]).select(
        "d", "th", (F.col("at") - width).cast("long").alias("a"), (F.col("at") + size).cast("long").alias("b"))
    return _finish(stored, materialise(part.unionByName(whole), "spans-ranges"))
