"""Whitening of embeddings by shifted CholeskyQR.

Each vector's entries become whole numbers, floor(scale * entry).  The fit list holds every distinct one of these vectors once.
Its rows are centred (n * x - S is a whole number, divided once) and orthogonalised in passes: tasks solve the rows of their
partition by the triangular factors found so far and add up their Gram matrices, Spark sums these by entry, and the driver
factors the d x d result.  The first pass shifts the Gram matrix, so that it has a Cholesky factor whatever the condition; further
passes repair what the shift leaves, until the rows' Gram matrix is a projection.  The product of the factors is R, with
X = Q R; the singular value decomposition of R alone gives components and eigenvalues, without ever squaring the condition.

The driver holds d x d numbers and S; a task a batch of rows.  Neither grows with the rows.

Defined results: vectors that are null or hold null or non-finite entries (or entries too large for 64-bit whole numbers) give no
rows; so do vectors not of the commonest length among the distinct ones (ties: the longest).  Repeated rows and null keys each
get their rows.  Components with an eigenvalue of zero are none; one distinct vector or an empty table gives no rows.  A
``deviation`` that is too large for a long is null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.session import discard, materialize

#: Passes over the rows at most, and the distance from a projection at which they end.
PASSES, CLOSE = 8, 1e-13
#: Singular values below this share of the largest are zero.
RANK = 1e-9
#: Rows that a task orthogonalises at once.
CHUNK = 8192


def whole_rows(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: (row numbers, their vectors as int64), valid rows only."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values
    entries = scale * values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(entries) < 2.0**62)
    seen = np.concatenate(([0], np.cumsum(bad)))
    valid = np.asarray(column.is_valid()) & (seen[offsets[1:]] == seen[offsets[:-1]])
    sizes = np.diff(offsets)
    for d in np.unique(sizes[valid]).tolist():
        rows = np.flatnonzero(valid & (sizes == d))
        if d:
            yield rows, np.floor(entries[offsets[rows][:, None] + np.arange(d)]).astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row's numbers in the fewest bytes a number that hold them all; equal rows give equal bytes."""
    out: list[bytes] = [b""] * len(x)
    need = np.maximum(x.max(axis=1), -1 - x.min(axis=1))
    width = 1 << np.searchsorted(np.array([1 << 7, 1 << 15, 1 << 31]), need, "right")
    for w in (1, 2, 4, 8):
        rows = np.flatnonzero(width == w)
        data, step = x[rows].astype(f"<i{w}").tobytes(), w * x.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = data[k * step : (k + 1) * step]
    return out


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    rows = [np.frombuffer(b, f"<i{len(b) // d}") for b in column.to_pylist()]
    return np.array(rows, np.int64).reshape(len(rows), d)


def distinct_vectors(vectors: DataFrame, vector: str, scale: float) -> DataFrame:
    """``(d, x)``: the length and the packed numbers of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in whole_rows(batch.column(0), scale):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(packed(x), pa.binary())], ["d", "x"])

    return vectors.select(F.col(vector)).mapInArrow(run, "d int, x binary").distinct()


class Centre:
    """n, the sums S as exact whole numbers, and what is made of them."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.d = n, sums, len(sums)
        self.largest = max(map(abs, sums))

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: int64 where it fits, else Python numbers."""
        if self.n * int(np.abs(x).max(initial=0)) + self.largest < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.differences(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S by row, exact; None beyond 64 bits."""
        y = self.differences(x)
        if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * self.d < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1)]


def sums_of(fit: DataFrame, d: int) -> Centre:
    """n and S of the fit list; sums of high and low halves cannot overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(0), d)
            parts = [np.arange(d, dtype=np.int32), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), np.full(d, len(x))]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["i", "high", "low", "n"])

    parts = fit.select("x").mapInArrow(run, "i int, high bigint, low bigint, n bigint")
    rows = sorted(parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")]).collect())
    return Centre(rows[0]["n"], [(r["high"] << 32) + r["low"] for r in rows])


def gram(fit: DataFrame, centre: Centre, change: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over the fit list of y'y, y = ``change`` of the centred rows: partial sums in tasks, then by entry in Spark."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                y = change(centre.centred(unpacked(batch.column(0).slice(at, CHUNK), centre.d)))
                total += y.T @ y
        parts = [upper[0].astype(np.int32), upper[1].astype(np.int32), total[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["i", "j", "v"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, v double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor in turn."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def cholesky_qr(fit: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred fit list, from shifted Cholesky factors of repeated Gram passes."""
    factors: list[np.ndarray] = []
    whole = np.eye(centre.d)
    for turn in range(PASSES):
        made = list(factors)
        g = gram(fit, centre, lambda rows: solved(rows, made), centre.d)
        if turn and np.abs(g @ g - g).max() <= CLOSE * centre.d:
            break
        trace = float(np.trace(g))
        if trace == 0:
            return np.zeros((centre.d, centre.d))
        shift = 100 * centre.d * np.finfo(float).eps * trace if not turn else 0.0
        while True:
            try:
                r = np.linalg.cholesky(g + shift * np.eye(centre.d)).T
                break
            except np.linalg.LinAlgError:
                shift = max(10 * shift, centre.d * np.finfo(float).eps * trace)
        factors.append(r)
        whole = r @ whole
    return whole


def whiten(
    vectors: DataFrame,
    components: int = 4,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)`` for every valid row and component.

    ``n``: rows of the fit list; ``deviation``: sum over dimensions of (n * x - S)^2; ``whitened``: the centred vector on the
    component, over the root of its eigenvalue; ``explained``: the eigenvalue's share of the trace; ``identity_error``: the
    largest entry of |covariance of ``whitened`` over the fit list - identity|, measured in a pass of its own."""
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fit = materialize(distinct_vectors(vectors, vector, scale), "vectors")
    common = fit.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        discard(fit)
        return vectors.sparkSession.createDataFrame([], schema)
    d = common["d"]
    mine = fit.filter(F.col("d") == d)
    centre = sums_of(mine, d)
    r = cholesky_qr(mine, centre)
    _, singular, axes = np.linalg.svd(r)
    count = min(components, int((singular > RANK * singular[0]).sum()))
    axes = axes[:count] * np.sign(axes[np.arange(count), np.abs(axes[:count]).argmax(axis=1)])[:, None]
    eigen = singular**2 / centre.n
    explained = eigen[:count] / eigen.sum() if count else eigen[:0]
    project = (axes / np.sqrt(eigen[:count])[:, None]).T
    error = 0.0
    if count:
        error = float(np.abs(gram(mine, centre, lambda rows: rows @ project, count) / centre.n - np.eye(count)).max())
    discard(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if count else 0, CHUNK):
                part = batch.slice(at, CHUNK)
                for rows, x in whole_rows(part.column(1), scale):
                    if x.shape[1] != d:
                        continue
                    m = len(x) * count
                    columns = [
                        part.column(0).take(pa.array(np.repeat(rows, count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(m, centre.n)),
                        pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), count))),
                        pa.array((centre.centred(x) @ project).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(m, error)),
                    ]
                    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return vectors.select(F.col(key), F.col(vector)).mapInArrow(run, schema)
