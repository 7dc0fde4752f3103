"""Set-similarity and vector nearest-neighbour joins.

Overlap join (token-set overlap coefficient > t)
    Prefix filtering instead of all pairs. A pair can only pass when the
    smaller set's first ``m - floor(t*m)`` tokens (its *prefix*, under any
    fixed token order) hit the other set, and ``x`` tokens more hit it ``x`` times
    more. Prefixes are ordered by frequency on the other side, so hot tokens ("the")
    almost never enter one. Distinct sets are written once, as ids of the queries' tokens;
    ``setjoin`` finds and counts the pairs of sets where the larger one is read, and
    writes those that pass: candidate pairs are never written or sent.

Exact k-NN (squared L2)
    Pivot cells with the triangle inequality: neighbouring cells make a block,
    and a query visits only the blocks with a cell that can hold one of its
    ``k`` nearest. Each (block, part) group is scored by single-precision matrix
    products whose rounding is bounded, inside ``cogroup().applyInArrow``; the rows
    that may be among the nearest get exact distances, and at most ``k`` a query leave the
    group. A ``row_number() <= k`` per query merges them. Large cells are
    split on both sides, so no group grows with the data. Where vectors have no
    clusters, nothing can be skipped and every query meets every context: the products grow with the square.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.functions.text import token_set
from tonality.operators.setjoin import encoded, ranked_ids, shared_pairs

_EPS = 1e-9


def token_rows(df: DataFrame, id_col: str, text_col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(sid, set_size, token, *extra) — one row per distinct lower-cased token;
    ``extra`` names columns of ``df`` carried along."""
    sets = df.select(F.col(id_col).alias("sid"), token_set(F.col(text_col)).alias("toks"), *extra)
    # explode_outer and a non-nullable size: with an inner explode, or a
    # nullable size used in a join condition, the optimizer infers filters on
    # the token expression and evaluates it again (even inside the scan)
    return (sets.select("sid", F.coalesce(F.size("toks"), F.lit(0)).alias("set_size"),
                        F.explode_outer("toks").alias("token"), *extra)
                .where(F.col("token").isNotNull()))


def _frequencies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage (a lost executor does not recompute the inputs) and lets later
    steps count and reuse a small intermediate without recomputing it."""
    from tonality.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_BYTES = 64 << 20


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows are measured to hold at most
    ``max_bytes`` (strings by their bytes, arrays of numbers by 8 bytes an entry, other columns as 16 bytes), else
    ``df`` unchanged (the join then shuffles). Measure a materialised frame, or
    the measurement recomputes its plan."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        own = F.octet_length(name) if kind == "string" else 8 * F.size(name) if kind.startswith("array") else F.lit(16)
        size = size + F.coalesce(own, F.lit(0)).cast("long")
    return F.broadcast(df) if (df.agg(F.sum(size + 16)).first()[0] or 0) <= max_bytes else df


ORDER_SAMPLE = 50_000  # corpus rows whose tokens set the order of query prefixes; any order gives the same pairs


def query_frequencies(contexts: DataFrame, c_id: str, c_text: str, vocab: DataFrame) -> DataFrame:
    """(token, df): how many of about ``ORDER_SAMPLE`` corpus rows (by hash) hold each token of the query vocabulary.

    The order of prefixes decides how many candidates are checked, never which pairs are found.
    """
    n = contexts.count()
    some = contexts if n <= ORDER_SAMPLE else contexts.where(F.pmod(F.xxhash64(c_id), F.lit(1 << 30)) < int(ORDER_SAMPLE / n * (1 << 30)))
    return _frequencies(token_rows(some, c_id, c_text).join(checked_broadcast(vocab), "token", "left_semi"))


def overlap_join(queries: DataFrame, contexts: DataFrame, q_id: str, c_id: str,
                 q_text: str = "text", c_text: str = "text", threshold: float = 0.8,
                 score: str = "overlap", threshold_col: str | None = None) -> DataFrame:
    """All (query, context) pairs whose token-set score is > threshold.

    ``score='overlap'`` is |A∩B|/min(|A|,|B|) (0 for an empty side);
    ``score='similarity'`` adds 1e-6 to the denominator. Output columns:
    ``q_id, c_id, n_shared, score``. With ``threshold_col`` every context row
    brings its own threshold (strict ``>`` against it).

    What is written: the queries' tokens, a row of token ids a distinct set on either side (of a context only ids that some query
    has), the pairs of sets that pass, and ids with the names of their sets. Copies of a text cost one comparison.
    """
    thr = F.col(threshold_col).cast("double") if threshold_col else F.lit(float(threshold))
    q_named, q_rows = named_sets(queries, q_id, q_text, "q")
    c_named, c_rows = named_sets(contexts, c_id, c_text, "c", thr)
    q_rows = materialize(q_rows)
    by_query = ranked_ids(_frequencies(q_rows)).select("token", "token_id")
    order = query_frequencies(contexts, c_id, c_text, by_query.select("token"))
    q_sets = encoded(q_rows, materialize(by_query.join(order, "token", "left").select("token", "token_id", F.coalesce("df", F.lit(0)).alias("df"))), "mark")
    if threshold_col:  # copies of a text may have different thresholds: the least one decides which pairs are counted
        threshold = c_named.agg(F.min("_thr")).first()[0]
        least = c_named.where("_thr is not null").groupBy(F.col("c_mark").alias("mark")).agg(F.min("_thr").alias("_thr"))
        c_sets = encoded(c_rows, by_query, "mark", least)
    else:
        c_sets = encoded(c_rows, by_query, "mark").withColumn("_thr", thr)
    counted = count_shared(q_sets.withColumn("_thr", F.lit(threshold).cast("double")), c_sets)
    m = F.least("q_n", "c_n")
    value = F.when(m > 0, F.col("n_shared") / m).otherwise(F.lit(0.0)) if score == "overlap" else F.col("n_shared") / (m + F.lit(1e-6))
    out = counted.join(checked_broadcast(q_named), "q_mark").join(checked_broadcast(c_named), "c_mark").withColumn("score", value).where(F.col("score") > F.col("_thr"))
    return out.select(F.col("q_sid").alias(q_id), F.col("c_sid").alias(c_id), "n_shared", "score")


def named_sets(df: DataFrame, id_col: str, text_col: str, side: str, thr: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """((``{side}_sid, {side}_mark, {side}_n``, and with ``thr`` ``_thr``) of the rows that have an id and a token, materialised; (mark, n, token) of their distinct sets)."""
    sets = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("sid"), token_set(F.col(text_col)).alias("toks"), *([thr.alias("_thr")] if thr is not None else []))
    sets = sets.select(F.col("sid").alias(f"{side}_sid"), set_mark(F.col("toks")).alias(f"{side}_mark"), F.coalesce(F.size("toks"), F.lit(0)).alias(f"{side}_n"), "toks", *(["_thr"] if thr is not None else []))
    named = materialize(sets.drop("toks")).where(F.col(f"{side}_n") > 0)
    one = sets.select(F.col(f"{side}_mark").alias("mark"), F.col(f"{side}_n").alias("n"), "toks").dropDuplicates(["mark"])
    return named, one.select("mark", "n", F.explode_outer("toks").alias("token")).where(F.col("token").isNotNull())


def count_shared(q_sets: DataFrame, c_sets: DataFrame) -> DataFrame:
    """(q_mark, c_mark, n_shared) of the pairs of sets (mark, n, ids, _thr) that share more than the smaller one's ``_thr`` of its tokens.

    A pair is counted once: the query is its smaller set or as large, else the context is.
    """
    def small(sets: DataFrame) -> DataFrame:
        # the -eps keeps it on the safe, lower side; that many may be exactly the threshold, which is not enough
        k = F.greatest(F.floor(F.col("n") * F.col("_thr") - F.lit(_EPS)) + 1, F.lit(1))
        return sets.withColumn("least", F.when(k / F.col("n") > F.col("_thr"), k).otherwise(k + 1))

    # no context as large as the largest query is the smaller set
    q_most = q_sets.agg(F.max("n")).first()[0] or 0
    a = shared_pairs(small(q_sets), c_sets, "mark", ("q_mark", "c_mark"), lambda n, m, *_: n <= m)
    b = shared_pairs(small(c_sets).where(F.col("n") < q_most), q_sets, "mark", ("c_mark", "q_mark"), lambda n, m, *_: n < m)
    return a.unionByName(b)


def set_mark(toks: Column) -> Column:
    """16 bytes that name a token set (tokens have no space); a null set is named as the empty one."""
    return F.coalesce(F.unhex(F.md5(F.concat_ws(" ", F.array_sort(toks)).cast("binary"))), F.lit(b""))


# --------------------------------------------------------------------------
# exact k-NN
# --------------------------------------------------------------------------

KNN_SCHEMA = "q_id long, c_id long, distance double"
MAX_CELLS = 1024
LEAST_ROWS, MOST_ROWS, SIDES = 2048, 32768, 16  # rows of a block: about a ``SIDES``-th of the contexts, within these bounds
AT_ONCE = 1 << 18  # distances held at a time in a task: they stay in a core's cache


def matrix(column, kind=np.float64) -> np.ndarray:
    """Arrow list column (all rows of one length) -> matrix; null entries become NaN."""
    import pyarrow as pa

    parts = [c for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]) if len(c)]
    if not parts:
        return np.zeros((0, 0), dtype=kind)
    out = []
    for c in parts:
        flat = c.flatten().to_numpy(zero_copy_only=False)
        if not (np.diff(c.offsets.to_numpy()) == len(flat) // len(c)).all():
            raise ValueError("vectors of different lengths")
        out.append(flat.astype(kind).reshape(len(c), -1))
    return np.concatenate(out)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b`` by one matrix product; see ``_slack`` for its error."""
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0.0, out=d)


def _slack(a: np.ndarray, b: np.ndarray, eps: float = np.finfo(float).eps) -> np.ndarray:
    """Bound, a row of ``a``, on the rounding error of ``_squares``."""
    most = float((b * b).sum(axis=1).max(initial=0.0))
    return 8 * eps * (a.shape[1] + 4) * ((a * a).sum(axis=1) + most)


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row to every pivot (rounding is covered by the margin of ``_reached``)."""
    return np.sqrt(_squares(v, pivots) + _slack(v, pivots)[:, None])


def _assign_cells(contexts: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Every context with its nearest pivot and the distance to it."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                d = _to_pivots(matrix(b.column(1)), pivots)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))], names=["c_id", "cv", "cell", "to_pivot"])

    return contexts.mapInArrow(run, "c_id long, cv array<float>, cell int, to_pivot double")


def _blocks_of(pivots: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """Block of each cell: cells in the order of a walk to the nearest pivot not yet visited, packed to about ``rows`` contexts."""
    left, at, held, block = np.ones(len(pivots), dtype=bool), 0, 0, 0
    found = np.zeros(len(pivots), dtype=np.int64)
    for _ in range(len(pivots)):
        if held and held + count[at] > rows:
            held, block = 0, block + 1
        found[at], held, left[at] = block, held + count[at], False
        if left.any():
            far = ((pivots - pivots[at]) ** 2).sum(axis=1)
            at = int(np.where(left, far, np.inf).argmin()) if np.isfinite(far[left]).any() else int(left.argmax())
    return found


def _reached(v: np.ndarray, pivots: np.ndarray, radius: np.ndarray, count: np.ndarray, block_of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries x blocks: may the block hold one of a query's ``k`` nearest, bound on the k-th distance).

    The cells taken in order of (distance to pivot + radius) hold ``k`` contexts
    within the last one's sum, which bounds the k-th distance. A cell whose
    contexts are all farther, by the triangle inequality, is skipped (pivot distances are rounded
    by up to 1e-6 of a unit vector's length, hence the margin).
    """
    d = _to_pivots(v, pivots)
    far = d + radius
    order = np.argsort(far, axis=1)
    held = np.cumsum(count[order], axis=1)
    enough, reached = (held >= k).argmax(axis=1), held[:, -1] >= k
    margin = 2 * np.sqrt(_slack(v, pivots))
    bound = np.where(reached, np.take_along_axis(far, order, axis=1)[np.arange(len(v)), enough], np.inf) * (1 + 1e-9) + 1e-12 + margin
    cells = (d - radius <= bound[:, None] + margin[:, None]) & (count > 0)
    blocks = np.zeros((len(v), int(block_of.max()) + 1), dtype=bool)
    for cell in range(len(pivots)):
        blocks[:, block_of[cell]] |= cells[:, cell]
    return blocks, bound


def _reach_blocks(queries: DataFrame, reached, counts: bool) -> DataFrame:
    """(q_id, qv, block, bound): a row a query and block that it visits; with ``counts`` only (block, n) of each batch."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                blocks, bound = reached(matrix(part.column(1)))
                if counts:
                    n = blocks.sum(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n.astype(np.int64))], names=["block", "n"])
                else:
                    q, block = np.nonzero(blocks)
                    rows = pa.array(q)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(block.astype(np.int32)), pa.array(bound[q])], names=["q_id", "qv", "block", "bound"])

    return queries.mapInArrow(run, "block int, n long" if counts else "q_id long, qv array<float>, block int, bound double")


def nearest_rows(qv: np.ndarray, cv: np.ndarray, k: int, most: np.ndarray | None = None, skip=None):
    """Yields (query rows, context rows) of a slice of queries: all contexts that may be among a query's ``k`` nearest.

    Products are of single precision where the squares fit (their rounding error is allowed for), the k-th distance is bounded by the
    k-th of the least distances of disjoint sets of contexts. ``most``: a bound on the squared distance, ``skip(s, d)`` rules out
    contexts of the queries from ``s`` on. Rows with an entry that is no number are near to none.
    """
    squares = [np.square(m, dtype=np.float64).sum(axis=1) for m in (qv, cv)]
    kind = np.float32 if all((x < 1e36).all() for x in squares) else np.float64
    error = 8 * float(np.finfo(kind).eps) * (cv.shape[1] + 6) * (squares[0] + np.nan_to_num(squares[1], nan=0.0, posinf=0.0).max(initial=0.0)) + 1e-36
    # (q, 1, |q|^2) . (-2c, |c|^2, 1) is the squared distance: one product
    q = np.hstack([qv.astype(kind), np.ones((len(qv), 1), kind), squares[0].astype(kind)[:, None]])
    c = np.hstack([-2 * cv.astype(kind), squares[1].astype(kind)[:, None], np.ones((len(cv), 1), kind)])
    odd, n = not all(np.isfinite(x).all() for x in squares), len(c)
    ways = max(1, n // max(8 * k, 512))  # a set of contexts has ``ways`` rows
    sets, top = n // ways, float(np.finfo(kind).max) / 4
    step = max(1, AT_ONCE // max(1, n))
    for s in range(0, len(q), step):
        d = q[s:s + step] @ c.T
        if odd:
            d[np.isnan(d)] = np.inf
        if skip is not None:
            skip(s, d)
        slack = error[s:s + step]
        bound = np.full(len(d), top) if most is None else np.minimum(most[s:s + step] + slack, top)
        if k < n:
            least = d[:, :sets * ways].reshape(len(d), ways, sets).min(axis=1) if ways > 1 else d
            bound = np.fmin(bound, np.partition(least, k - 1, axis=1)[:, k - 1] + 2 * slack)
        near = np.flatnonzero(d <= np.nextafter(bound.astype(kind), kind(np.inf))[:, None])
        rows, cols = np.divmod(near, n)
        yield s + rows, cols


def exact_squares(qv: np.ndarray, cv: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Squared distance of each pair, in double precision."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 15):
        diff = qv[rows[at:at + (1 << 15)]].astype(np.float64) - cv[cols[at:at + (1 << 15)]]
        out[at:at + (1 << 15)] = np.einsum("ij,ij->i", diff, diff)
    return out


def first_k(rows: np.ndarray, cols: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` least of each row, in order of (row, distance, column)."""
    order = np.lexsort((cols, distance, rows))
    sorted_rows = rows[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows, side="left") < k]


def _own(qids: np.ndarray, cids: np.ndarray):
    """Rules out, in the distances of queries from ``s`` on, the contexts (sorted by id) that have the query's id."""
    low, high = np.searchsorted(cids, qids, side="left"), np.searchsorted(cids, qids, side="right")

    def skip(s: int, d: np.ndarray) -> None:
        for i in np.flatnonzero(high[s:s + len(d)] > low[s:s + len(d)]):
            d[i, low[s + i]:high[s + i]] = np.inf

    return skip


def _block_topk(k: int, exclude_self: bool):
    """Per group of queries and contexts: exact squared L2, at most the best ``k`` per query, ties by context id."""

    def fn(qs, cs):
        import pyarrow as pa

        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if qs.num_rows and cs.num_rows:
            cids, qids = cs.column("c_id").to_numpy(), qs.column("q_id").to_numpy()
            by_id = np.argsort(cids, kind="stable")
            cids, cv, qv = cids[by_id], matrix(cs.column("cv"), np.float32)[by_id], matrix(qs.column("qv"), np.float32)
            for rows, cols in nearest_rows(qv, cv, k, qs.column("bound").to_numpy() ** 2, _own(qids, cids) if exclude_self else None):
                dist = exact_squares(qv, cv, rows, cols)
                keep = first_k(rows, cols, dist, k)
                out.append((qids[rows[keep]], cids[cols[keep]], dist[keep]))
        return pa.table({name: np.concatenate(x) for name, x in zip(("q_id", "c_id", "distance"), zip(*out))})

    return fn


def knn_exact(queries: DataFrame, contexts: DataFrame, q_id: str, c_id: str, q_vec: str, c_vec: str,
              k: int, exclude_self: bool = False, block_rows: int | None = None) -> DataFrame:
    """The ``k`` nearest contexts of every query by squared L2 distance
    (ascending, ties by context id): columns ``q_id, c_id, distance, rank``.

    Exact, with pruning: contexts go to the cell of their nearest pivot (about
    sqrt(n) of them, at most ``MAX_CELLS``, taken by hash), near cells to one block, a query only to blocks that can hold
    one of its ``k`` nearest. A block has about ``block_rows`` contexts (default: a ``SIDES``-th of them, from ``LEAST_ROWS`` to
    ``MOST_ROWS``); larger cells and the queries of a block are split by as many, so a group is bounded
    whatever the skew. Fewer than ``k`` contexts give fewer rows (no padding).
    Rows with a null id or vector are left out.
    """
    q = queries.select(F.col(q_id).cast("long").alias("q_id"), F.col(q_vec).cast("array<float>").alias("qv")).where("q_id is not null and qv is not null")
    c = contexts.select(F.col(c_id).cast("long").alias("c_id"), F.col(c_vec).cast("array<float>").alias("cv")).where("c_id is not null and cv is not null")
    n = c.count()
    picked = c.orderBy(F.xxhash64("c_id"), "c_id").limit(max(1, min(MAX_CELLS, math.isqrt(n)))).collect()
    if not picked:
        return q.sparkSession.createDataFrame([], KNN_SCHEMA + ", rank int")
    block_rows = block_rows or min(MOST_ROWS, max(LEAST_ROWS, n // SIDES))
    pivots = np.array([r["cv"] for r in picked], dtype=np.float64)
    cells = materialize(_assign_cells(c, pivots))
    radius, count = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for r in cells.groupBy("cell").agg(F.max("to_pivot").alias("r"), F.count("*").alias("n")).collect():  # at most MAX_CELLS rows
        radius[r["cell"]], count[r["cell"]] = r["r"], r["n"]
    block_of = _blocks_of(pivots, count, block_rows)
    rows = np.bincount(block_of, weights=count).astype(np.int64)
    reached = lambda v: _reached(v, pivots, radius, count, block_of, k + bool(exclude_self))
    asked = {r["block"]: r["n"] for r in _reach_blocks(q, reached, True).groupBy("block").agg(F.sum("n").alias("n")).collect()}
    parts = F.array(*[F.struct(F.lit(max(1, math.ceil(int(x) / block_rows))).alias("c"), F.lit(max(1, math.ceil(asked.get(i, 0) / block_rows))).alias("q"))
                      for i, x in enumerate(rows)])
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    at = F.get(parts, F.col("block"))
    left = _reach_blocks(q, reached, False).select("*", F.pmod(F.xxhash64("q_id"), at["q"]).cast("int").alias("qb"), spread(at["c"]).alias("cb"))
    right = cells.withColumn("block", F.get(F.lit([int(x) for x in block_of]), F.col("cell"))).select(
        "c_id", "cv", "block", F.pmod(F.xxhash64("c_id"), at["c"]).cast("int").alias("cb"), spread(at["q"]).alias("qb"))
    keys = ["block", "qb", "cb"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block_topk(k, exclude_self), KNN_SCHEMA)
    w = Window.partitionBy("q_id").orderBy("distance", "c_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
