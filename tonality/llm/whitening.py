"""Embedding whitening by spectrum slicing.

Entries become integers x = floor(scale * c). The fit list holds each distinct x
vector once. Its size, its exact sums and its centred covariance V come from one
partial sum a task, added up by dimension in Spark; what reaches the driver is one
row a dimension, whatever the number of vectors.

The leading eigenpairs of V are found one at a time on the driver. The number of
positive pivots of the LDL^T factors of V - s*I is the number of eigenvalues above s
(Sylvester), so bisection on such counts isolates the j-th largest eigenvalue in an
interval of its own. Inverse iteration at its middle, then Rayleigh quotient
iteration (cubic convergence) give the pair to double precision; a quotient that
leaves the interval sends the bisection on. Two counts just above and below the
result certify that it is number j.

Defined results
  null vectors and vectors with a null or non-finite entry: no row; vectors whose
  length is not the commonest among distinct vectors (ties: the longest): no row;
  entries beyond a long once scaled: the nearest long (about 2^63);
  deviation beyond a long: null;
  a component whose eigenvalue is zero to double precision has no rows: none for a
  single distinct vector, an empty table or empty vectors;
  equal eigenvalues: any orthonormal basis of their space, the same for all rows;
  null ids, repeated ids and repeated rows: each row has its own output rows.
  Only the id and vector columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import materialise

OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
       "eigenvalue double")
PIVOT = (1 + 17 ** 0.5) / 8  # bound of element growth in the symmetric factorisation


# -- spectrum slicing (driver; sized by the dimension only) -----------------

def positive_pivots(a) -> int:
    """Number of positive eigenvalues of a symmetric matrix: LDL^T with 1 x 1 and 2 x 2 pivots, each 2 x 2 block of mixed sign."""
    import numpy as np

    a = np.array(a, dtype=np.float64)
    n, at, positive = len(a), 0, 0
    while at < n:
        s = a[at:, at:]
        down = np.abs(s[1:, 0])
        top = down.max(initial=0.0)
        if top == 0:
            positive += int(s[0, 0] > 0)
            at += 1
            continue
        r = int(down.argmax()) + 1
        row = np.abs(s[r])
        row[r] = 0
        other = row.max()
        if abs(s[0, 0]) * other >= PIVOT * top * top:
            swap, size = 0, 1
        elif abs(s[r, r]) >= PIVOT * other:
            swap, size = 0, 1
            s[[0, r]] = s[[r, 0]]
            s[:, [0, r]] = s[:, [r, 0]]
        else:
            swap, size = r, 2
        if size == 1:
            positive += int(s[0, 0] > 0)
            s[1:, 1:] -= np.outer(s[1:, 0] / s[0, 0], s[0, 1:])
        else:
            s[[1, swap]] = s[[swap, 1]]
            s[:, [1, swap]] = s[:, [swap, 1]]
            positive += 1
            s[2:, 2:] -= s[2:, :2] @ np.linalg.solve(s[:2, :2], s[:2, 2:])
        at += size
    return positive


def _pair(v, middle: float, found):
    """Rayleigh quotient iteration from two steps of inverse iteration at ``middle``, orthogonal to the pairs found."""
    import numpy as np

    size = float(np.abs(v).sum(axis=1).max())
    eye = np.eye(len(v))
    against = np.array(found).reshape(-1, len(v))

    def step(shift, y):
        try:
            y = np.linalg.solve(v - shift * eye, y)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + np.finfo(float).eps * size) * eye, y)
        y = y / np.abs(y).max()
        y -= against.T @ (against @ y)
        return y / np.linalg.norm(y)

    y = step(middle, step(middle, np.random.default_rng(len(found)).standard_normal(len(v))))
    best = (np.inf, 0.0, y)
    for _ in range(12):
        t = float(y @ v @ y)
        off = float(np.linalg.norm(v @ y - t * y))
        if off >= best[0]:
            break
        best = (off, t, y)
        y = step(t, y)
    return best


def leading_pairs(v, k: int) -> tuple[list[float], list]:
    """The ``k`` largest eigenvalues above zero of a positive semidefinite matrix, falling, and their unit vectors.

    Raises if the counts at both sides of a value do not certify its number.
    """
    import numpy as np

    v = np.asarray(v, dtype=np.float64)
    d = len(v)
    size = float(np.abs(v).sum(axis=1).max(initial=0.0))  # bounds every eigenvalue
    if not size:
        return [], []
    v = v / size
    eye, tiny = np.eye(d), 8 * np.finfo(float).eps * d
    counts: dict[float, int] = {1.0 + tiny: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = positive_pivots(v - s * eye)
        return counts[s]

    values, vectors = [], []
    for j in range(1, min(k, above(tiny)) + 1):
        low = max(s for s, c in counts.items() if c >= j)
        high = min(s for s, c in counts.items() if c < j)
        while True:
            while (above(low) != j or above(high) != j - 1) and high - low > tiny:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= j else (low, middle)
            off, value, vector = _pair(v, (low + high) / 2, vectors)
            near = max(tiny, 4 * off)
            if off <= tiny and above(value - near) >= j > above(value + near):  # certified as number j
                break
            if high - low <= tiny:
                raise ArithmeticError(f"eigenvalue {j} is not certified: residual {off}, {above(value - near)} above {value - near}, {above(value + near)} above {value + near}")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= j else (low, middle)
        values.append(value * size)
        vectors.append(vector)
    return values, vectors


# -- vectors in tasks -------------------------------------------------------

def _integers(column, scale: float):
    """(row numbers, lists of x) of a batch's usable vectors: for each length an int64 matrix."""
    import numpy as np

    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
    c = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    here = np.ones(len(column), dtype=bool) if column.null_count == 0 else column.is_valid().to_numpy(zero_copy_only=False)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
    here = here & (bad[begin[1:]] == bad[begin[:-1]])
    for d in np.unique(lengths[here]):
        rows = np.flatnonzero(here & (lengths == d))
        with np.errstate(over="ignore"):
            x = np.floor(scale * c[begin[rows][:, None] + np.arange(d)])
        yield rows, int(d), np.clip(x, -2.0**63, 2.0**63 - 1024).astype(np.int64)


def _pack(x) -> list[bytes]:
    """Each row's bytes at the least width that holds it, so equal vectors give equal bytes."""
    import numpy as np

    most = np.maximum(x.max(axis=1, initial=0), -(x.min(axis=1, initial=0) + 1))
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    out: list = [b""] * len(x)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        raw, size = x[rows].astype(f"<i{w}").tobytes(), int(w) * x.shape[1]
        for k, i in enumerate(rows.tolist()):
            out[i] = raw[k * size:(k + 1) * size]
    return out


def _unpack(column, d: int):
    """int64 matrices of the packed rows, one for each width."""
    import numpy as np

    raw = column.to_pylist()
    for w in (1, 2, 4, 8):
        rows = [r for r in raw if len(r) == w * d]
        if rows:
            yield np.frombuffer(b"".join(rows), dtype=f"<i{w}").reshape(-1, d).astype(np.int64)


def _most(x) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def distinct_vectors(vectors: DataFrame, scale: int = 256, column: str = "embedding") -> DataFrame:
    """(dim, packed): every distinct integer vector once. Copies are folded in the tasks before the shuffle."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for _, d, x in _integers(b.column(0), scale):
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(x), pa.int32()), pa.array(_pack(x), pa.binary())], names=["dim", "packed"])

    return vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(run, "dim int, packed binary").distinct()


def _exact_sums(fit: DataFrame, d: int) -> list[int]:
    """Sum of each dimension, exact: integers in tasks, decimals between them."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = [0] * d
        for b in batches:
            for x in _unpack(b.column(0), d):
                part = x.sum(axis=0) if _most(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
                total = [t + int(p) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array([str(t) for t in total], pa.string())], names=["i", "s"])

    rows = fit.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows)]


def _products(fit: DataFrame, d: int, centre, project=None):
    """Sum of the centred vectors' (or their projections') outer products, and their sum, over the fit list.

    A task gives one row a dimension; a group adds the tasks' rows of one dimension.
    """
    import numpy as np

    wide = d if project is None else project.shape[1]

    def run(batches):
        import pyarrow as pa

        total = np.zeros((wide, wide + 1))
        for b in batches:
            for x in _unpack(b.column(0), d):
                z = x - centre
                z = z if project is None else z @ project
                total[:, :wide] += z.T @ z
                total[:, wide] += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])

    def add(table):
        import pyarrow as pa

        total = np.zeros(wide + 1)
        for r in table.column("row"):
            total += np.frombuffer(r.as_py())
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([total.tobytes()], pa.binary())})

    rows = fit.mapInArrow(run, "i int, row binary").groupBy("i").applyInArrow(add, "i int, row binary").collect()
    out = np.array([np.frombuffer(bytes(r["row"])) for r in sorted(rows, key=lambda r: r["i"])]).reshape(-1, wide + 1)
    return out[:, :wide], out[:, wide]


class Whitener:
    """Frozen statistics of a fit list: ``n``, exact ``sums``, eigenpairs, share of the trace, error of the identity."""

    def __init__(self, n, sums, values, vectors, trace, error, scale):
        self.n, self.sums, self.values, self.vectors, self.trace, self.error, self.scale = n, sums, values, vectors, trace, error, scale

    def _deviation(self, x):
        """Sum over dimensions of (n * x - sum)^2, exact; None beyond a long."""
        import numpy as np

        n, s = self.n, self.sums
        most = n * _most(x) + max(map(abs, s))
        if most * most * len(s) < 1 << 62:
            return (np.square(n * x - np.array(s, dtype=np.int64))).sum(axis=1).tolist()
        out = [sum((n * int(e) - t) ** 2 for e, t in zip(row, s)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in out]

    def transform(self, vectors: DataFrame, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
        """One row for each usable vector and component."""
        me, k = self, len(self.values)

        def run(batches):
            import numpy as np
            import pyarrow as pa

            names = [f.split(" ")[0] for f in OUT.split(", ")]
            centre = np.array([s / me.n for s in me.sums])
            project = np.array(me.vectors).T / np.sqrt(me.values)
            for b in batches:
                for rows, d, x in _integers(b.column(1), me.scale):
                    if d != len(me.sums):
                        continue
                    white = (x - centre) @ project
                    ids = np.repeat(rows, k)
                    same = lambda v, kind: pa.array(np.tile(np.asarray(v), len(rows)), kind)
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array(ids)), same(np.arange(1, k + 1), pa.int32()), same([me.n] * k, pa.int64()),
                        pa.array(me._deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))), pa.array(white.ravel()),
                        same(np.array(me.values) / me.trace, pa.float64()), same([me.error] * k, pa.float64()), same(me.values, pa.float64())], names=names)

        rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
        return (rows if k else rows.limit(0)).mapInArrow(run, OUT)


def fit(vectors: DataFrame, components: int = 4, scale: int = 256, column: str = "embedding") -> Whitener:
    """Statistics of all distinct vectors. Three passes over the fit list, which is written once."""
    import numpy as np

    every = materialise(distinct_vectors(vectors, scale, column), "whitening-fit")
    sizes = sorted(((r["count"], r["dim"]) for r in every.groupBy("dim").count().collect()), reverse=True)  # one row a vector length
    if not sizes or not sizes[0][1]:
        return Whitener(0, [], [], [], 0.0, 0.0, scale)
    n, d = sizes[0]
    listed = every.where(F.col("dim") == d).select("packed")
    sums = _exact_sums(listed, d)
    centre = np.array([s / n for s in sums])
    v = _products(listed, d, centre)[0] / n
    v = (v + v.T) / 2
    values, pairs = leading_pairs(v, components)
    error = 0.0
    if values:
        second, first = _products(listed, d, centre, np.array(pairs).T / np.sqrt(values))
        error = float(np.abs(second / n - np.outer(first / n, first / n) - np.eye(len(values))).max())
    return Whitener(n, sums, values, pairs, float(np.trace(v)), error, scale)


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue) of every usable row of ``vectors``."""
    return fit(vectors, components, scale).transform(vectors)
