"""Embedding whitening by incremental eigendecomposition (operator 13).

Entries become integers, so the number of vectors and the sums of each dimension
are exact, and every vector is centred exactly before anything is multiplied. Each
partition then keeps the eigendecomposition of the vectors it has seen: a centred
vector is a rank-one update, whose eigenvalues are the roots of a secular equation
between the old ones, after the parts that need no change are deflated. Spectra of
partitions are combined in a tree, by a rank-one update for each eigenpair. The
leading directions are last refined over all rows: a Rayleigh-Ritz step on the
directions and their residuals, until the residuals vanish.

A task holds one dims x dims matrix and a batch of rows; the driver holds sums and
a few directions. A block of more vectors than dimensions is first replaced by the
triangular factor of its QR decomposition, which has the same products and no more
rows than dimensions; that bounds the updates of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import clear, mark, written

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components returned, and further directions that are refined with them.
COMPONENTS, EXTRA = 8, 8
#: Spectra combined in one task, rows of a block, and passes of the refinement at most.
FAN_IN, BLOCK_ROWS, PASSES = 16, 8192, 8
#: Entries must be smaller, so that sums of a block fit 64 bits.
LIMIT = float(1 << 38)
#: Share of the first eigenvalue up to which a component has no variance.
NOTHING = 1e-12

_EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + w w' for rising d and w without zeros, and [i, j]: d[i] less the j-th of them, without cancellation.

    The j-th root lies between d[j] and the next entry. It is sought as an offset
    from the nearer of the two, by steps of a rational model of the secular
    function, or by halving where a step would leave the bracket.
    """
    n, w2 = len(d), w * w
    right = np.append(d[1:], d[-1] + w2.sum())
    half = (right - d) / 2
    last = np.arange(n) == n - 1
    middle = 1 + (w2[:, None] / (d[:, None] - (d + half)[None, :])).sum(0)
    upper = (middle < 0) & ~last
    origin = np.arange(n) + upper
    delta = d[:, None] - d[origin][None, :]
    low, high = np.where(upper, -half, 0.0), np.where(upper, 0.0, np.where(last, 2 * half, half))
    below = np.arange(n)[:, None] <= np.arange(n)[None, :]
    at = np.arange(n)
    after = np.minimum(at + 1, n - 1)
    mu = (low + high) / 2
    for _ in range(100):
        gap = delta - mu
        terms = w2[:, None] / gap
        value = 1 + terms.sum(0)
        low, high = np.where(value < 0, mu, low), np.where(value > 0, mu, high)
        if (np.abs(value) <= n * _EPS * (1 + np.abs(terms).sum(0))).all():
            break
        slopes = terms / gap
        left, other = np.where(below, slopes, 0).sum(0), np.where(below, 0, slopes).sum(0)
        near, far = gap[at, at], gap[after, at]
        c = value - near * left - far * other
        a = (near + far) * value - near * far * (left + other)
        b = near * far * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, near + near * near * left / (value - near * left), step)
        new = mu + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        mu = np.where(value == 0, mu, np.where(inside, new, (low + high) / 2))
    return d[origin] + mu, delta - mu


def rank_one(d: np.ndarray, q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of q diag(d) q' + z z'.

    Deflation: of equal eigenvalues, a reflection leaves one that z touches; what z
    does not touch stays as it is. The vectors come from weights recomputed from
    the roots, which keeps them orthogonal to working precision.
    """
    w = q.T @ z
    size = np.linalg.norm(w)
    tol = 8 * _EPS * max(float(np.abs(d).max()), float(size * size))
    if size == 0 or tol == 0:
        return d, q
    ends = np.append(np.flatnonzero(np.diff(d) > tol) + 1, len(d))
    begin = 0
    for end in ends:
        if end - begin > 1:
            own = w[begin:end].copy()
            norm = np.linalg.norm(own)
            if norm > 0:
                target = -norm if own[-1] > 0 else norm
                own[-1] -= target
                block = q[:, begin:end]
                q[:, begin:end] = block - np.outer(block @ own, own * (2 / (own @ own)))
                w[begin:end] = 0
                w[end - 1] = target
        begin = end
    live = np.abs(w) * size > tol
    if not live.any():
        return d, q
    old = d[live]
    roots, gaps = secular_roots(old, w[live])
    between = old[None, :] - old[:, None]
    np.fill_diagonal(between, 1)
    weights = np.sqrt(np.abs(np.prod(gaps / between, axis=1))) * np.sign(w[live])
    vectors = weights[:, None] / gaps
    vectors /= np.linalg.norm(vectors, axis=0)
    d, q = d.copy(), q.copy()
    d[live], q[:, live] = roots, q[:, live] @ vectors
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


def nothing(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(dims), np.eye(dims)


def with_rows(spectrum: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum after a rank-one update for each row, or for each row of the rows' triangular factor if these are fewer."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    for z in rows:
        spectrum = rank_one(*spectrum, z)
    return spectrum


class Centred:
    """What a task needs to centre vectors exactly: their number, and the sums by dimension as whole part and rest of the mean."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.whole, self.rest = (np.array(x, np.int64) for x in zip(*(divmod(s, n) for s in sums)))

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        """n * x - S of each entry, exactly: int64, or Python's integers where those are too small."""
        from_whole = whole(vectors) - self.whole
        most = int(np.abs(from_whole).max(initial=0)) + 1
        if most * self.n >= 1 << 62:
            from_whole = from_whole.astype(object)
        return from_whole * self.n - self.rest

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        return (self.scaled(vectors) / self.n).astype(np.float64)

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """Sum of the squares of n * x - S of each vector; None where that is more than 64 bits hold."""
        scaled = self.scaled(vectors)
        most = int(np.abs(scaled).max(initial=0))
        if most * most * max(vectors.shape[1], 1) >= 1 << 63:
            scaled = scaled.astype(object)
        return [int(s) if s < 1 << 63 else None for s in (scaled * scaled).sum(1)]


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches(vector, ...) of equal dimensions, in blocks of rows, with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _totals(rows: DataFrame, total: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of total(vectors), an array of one size, over all rows: by block, by partition, and by entry in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for _, vectors in _blocks(batches):
            out = total(vectors) if out is None else out + total(vectors)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out])], ["sums"])

    entries = rows.select("vector").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "entry"))
    found = entries.groupBy("place").agg(F.sum("entry").alias("entry")).orderBy("place").collect()
    return np.array([r.entry for r in found])


def _usable(table: DataFrame, vector: str, key: str) -> DataFrame:
    """vector (as doubles), vec_id of the rows whose vector is not null or empty, and has no null, non-finite or too large entry."""
    v = F.col("vector")
    rows = table.select(table[vector].cast("array<double>").alias("vector"), table[key].alias("vec_id"))
    return rows.where(v.isNotNull() & (F.size(v) > 0)).where(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)))


def _fit_list(rows: DataFrame) -> tuple[DataFrame, Centred] | None:
    """The rows of the commonest number of dimensions (of several, the greatest), and their exact mean; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                lists = batch.column(0).slice(at, BLOCK_ROWS)
                sizes, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
                of = np.repeat(sizes, sizes)
                kinds = np.unique(sizes)
                sums = [whole(values[of == dims].reshape(-1, dims)).sum(0) for dims in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array([int((sizes == dims).sum()) for dims in kinds], pa.int64()), pa.array(sums, pa.list_(pa.int64()))], ["dims", "n", "sums"])

    since = mark()
    partial = written(rows.select("vector").mapInArrow(run, "dims int, n long, sums array<long>"))
    most = partial.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    out = None
    if most is not None:
        places = partial.where(F.col("dims") == most.dims).select(F.posexplode("sums").alias("place", "s"))
        sums = places.groupBy("place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("place").collect()
        out = rows.where(F.size("vector") == most.dims), Centred(most.n, [int(r.s) for r in sums])
    clear(rows.sparkSession, since)
    return out


_SPECTRUM = "id long, d binary, q binary"


def _row(number: int, spectrum: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    d, q = spectrum
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([d.tobytes()], pa.binary()), pa.array([q.tobytes()], pa.binary())], ["id", "d", "q"])


def _spectra(d, q) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for values, vectors in zip(d, q):
        values = np.frombuffer(values.as_buffer(), np.float64)
        yield values, np.frombuffer(vectors.as_buffer(), np.float64).reshape(len(values), -1)


def combine(group: pa.Table) -> pa.Table:
    """One spectrum of several: each eigenpair of the others is a rank-one update of the first."""
    group = group.sort_by("id")
    total = None
    for d, q in _spectra(group.column("d"), group.column("q")):
        if total is None:
            total = d.copy(), q.copy()
            continue
        for value, vector in zip(d, q.T):
            if value > 0:
                total = rank_one(*total, vector * np.sqrt(value))
    return pa.Table.from_batches([_row(group.column("id")[0].as_py(), total)])


def leading(rows: DataFrame, centred: Centred, count: int) -> np.ndarray:
    """The `count` leading eigenvectors of the scatter of rows(vector), as columns, largest first, from spectra of all partitions."""
    dims, since = len(centred.whole), mark()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum = nothing(dims)
        for _, vectors in _blocks(batches):
            spectrum = with_rows(spectrum, centred(vectors))
        yield _row(TaskContext.get().partitionId(), spectrum)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, q in _spectra(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([q[:, ::-1][:, :count].tobytes()], pa.binary())], ["top"])

    spectra = written(rows.select("vector").mapInArrow(run, _SPECTRUM))
    left = spectra.count()
    while left > 1:
        left = -(-left // FAN_IN)
        numbered = spectra.withColumn("id", F.pmod("id", F.lit(left)))
        spectra = written(numbered.groupBy("id").applyInArrow(combine, _SPECTRUM))
    top = spectra.select("d", "q").mapInArrow(cut, "top binary").first().top
    clear(rows.sparkSession, since)
    return np.frombuffer(top, np.float64).reshape(dims, -1)


def refine(rows: DataFrame, centred: Centred, start: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and eigenvectors of the covariance near the start, and its trace.

    A pass over the rows multiplies the covariance with the basis. Rayleigh-Ritz
    gives the best directions of the basis and how far each is from an eigenvector;
    while that is not nothing and still falls, directions and residuals are the next basis.
    """
    dims, keep = start.shape
    basis, before, best = np.linalg.qr(start)[0], np.inf, None
    for _ in range(PASSES):

        def product(vectors: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
            z = centred(vectors)
            return np.append((z.T @ (z @ basis)).reshape(-1), (z * z).sum())

        sums = _totals(rows, product) / centred.n
        image, trace = sums[:-1].reshape(dims, -1), float(sums[-1])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:keep], turn[:, ::-1][:, :keep]
        ritz, residual = basis @ turn, image @ turn - basis @ turn * values
        off = float(np.linalg.norm(residual[:, :count], axis=0).max())
        if off < before:
            best = values, ritz, trace
        if off <= 8 * _EPS * max(values[0], 0) or off > before / 2 or basis.shape[1] == dims:
            break
        before = off
        size = np.linalg.norm(residual, axis=0)
        more = residual[:, size > 0] / size[size > 0]
        basis = np.linalg.qr(np.hstack((ritz, more))[:, :dims])[0]
    values, vectors, trace = best
    return np.maximum(values[:count], 0), vectors[:, :count], trace


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component up to `components` or the dimensions.

    Rows whose vector is null, empty, or holds a null or non-finite entry are left
    out, as are entries of 2**38 or more. Vectors of another length than the
    commonest (of several, the longest) are left out too. Repeated rows, ids and
    vectors count each; a null id is kept. deviation is exact, null where 64 bits
    can't hold it. A component without variance (up to 1e-12 of the first's) is
    whitened to 0 and takes no part in identity_error; explained is 0 if nothing
    varies. Equal eigenvalues share their directions in any way. A table without
    usable rows gives none. Other columns are not read.
    """
    rows = _usable(table, vector, key)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = _fit_list(rows)
    if fit is None:
        return table.sparkSession.createDataFrame([], schema)
    rows, centred = fit
    dims = len(centred.whole)
    count = min(components, dims)
    values, vectors, trace = refine(rows, centred, leading(rows, centred, min(dims, count + EXTRA)), count)
    real = values > NOTHING * values[0]
    turn = vectors * np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0)

    def product(vectors: np.ndarray) -> np.ndarray:
        w = centred(vectors) @ turn
        return np.append((w.T @ w).reshape(-1), w.sum(0))

    sums = _totals(rows, product) / centred.n
    covariance = sums[: count * count].reshape(count, count) - np.outer(sums[count * count :], sums[count * count :])
    error = float(np.abs(covariance - np.eye(count))[np.ix_(real, real)].max(initial=0))
    explained = values / trace if trace > 0 else np.zeros(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches):
            rows = len(x)
            of = pa.array(np.repeat(np.arange(rows), count))
            columns = [
                part.column(1).take(of), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)), pa.array(np.full(rows * count, centred.n, np.int64)), pa.array(centred.deviations(x), pa.int64()).take(of),
                pa.array((centred(x) @ turn).reshape(-1)), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return rows.select("vector", "vec_id").mapInArrow(run, schema)
