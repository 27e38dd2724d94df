"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V are found without forming it: each
step is one pass over the rows that sums ``X'(XQ)`` of the centred rows X for a
block Q of a few columns. A Chebyshev polynomial of V, evaluated by its
three-term recurrence, damps the part of the spectrum below the block's smallest
Ritz value; QR and Rayleigh-Ritz follow, until the residuals ``|Vu - eu|`` of the
wanted pairs are below ``TOLERANCE`` of the largest eigenvalue. The lower end of
the spectrum comes from a few Lanczos steps. Only blocks, sums and counts reach
the driver, whose size is that of the vectors, not of the table.

Entries c become whole numbers ``floor(scale * c) + shift``. Rows are centred
before they are multiplied, as ``(n*x - S) / n`` with the exact sums S, so a large
common shift costs no precision.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped; of vectors of several lengths those of the commonest are kept
(of the longest at a tie); repeated rows and rows with a null id count as often as
they occur; components whose eigenvalue is nothing but rounding (below
``LEAST_EIGENVALUE`` of the largest) are left out, so a table of equal rows or an
empty one has none; a deviation beyond a long is null, and numbers for which
``n*x`` leaves a long are computed in unbounded ones. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.gather import summed
from claimweave.llm.vectors import finite, matrix
from claimweave.sources.sinks import stage

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Columns of the block beyond the wanted ones.
GUARD = 16
DEGREE, LANCZOS, SEED = 10, 12, 13
TOLERANCE, MOST_ROUNDS = 1e-13, 200
#: Residuals that stop falling are rounding below this.
ROUNDING = 1e-11
LEAST_EIGENVALUE = 1e-12
_SAFE = 1 << 62


@dataclass
class Centre:
    """Whole numbers of a row, and how they are centred."""

    size: int
    scale: float
    shift: int
    n: int = 0
    total: list[int] | None = None

    def whole(self, lists: pa.Array) -> np.ndarray:
        x = np.floor(self.scale * matrix(lists, self.size))
        if np.abs(x).max(initial=0) < 2 ** 52:
            return x.astype(np.int64) + self.shift
        return np.array([[int(v) + self.shift for v in row] for row in x], object)

    def apart(self, lists: pa.Array) -> np.ndarray:
        """n*x - S, exact."""
        x = self.whole(lists)
        most = max(int(abs(x).max()) if x.size else 0, 1) * self.n + max(map(abs, self.total))
        if most >= _SAFE:
            x = x.astype(object)
            return x * self.n - np.array(self.total, object)
        return x * self.n - np.array(self.total, np.int64)

    def centred(self, lists: pa.Array) -> np.ndarray:
        return (self.apart(lists) / self.n).astype(np.float64)

    def squares(self, lists: pa.Array) -> list[int]:
        """The sum of (n*x - S)^2 of each row, exact."""
        y = self.apart(lists)
        if y.dtype == object or int(abs(y).max(initial=0)) ** 2 * self.size >= _SAFE:
            y = y.astype(object)
        return [int(v) for v in (y * y).sum(axis=1)]


def _sums(rows: DataFrame, centre: Centre) -> tuple[int, list[int]]:
    """(n, S), exact: sums travel in pieces of 24 bits, which doubles hold exactly."""
    size, pieces = centre.size, 8

    def task(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        n, total = 0, [0] * size
        for batch in batches:
            if batch.num_rows:
                x = centre.whole(batch.column("vector"))
                x = x.astype(object) if x.dtype != object and int(abs(x).max()) * len(x) >= _SAFE else x
                n, total = n + len(x), [t + int(s) for t, s in zip(total, x.sum(axis=0), strict=True)]
        if not n:
            return None
        # The last piece keeps the sign.
        return np.array([float(n), *(float(v >> 24 * k & 0xFFFFFF if k < pieces - 1 else v >> 24 * k)
                                     for v in total for k in range(pieces))])

    got = summed(rows, task)
    if got is None:
        return 0, [0] * size
    parts = got[1:].reshape(size, pieces)
    return int(got[0]), [sum(int(p) << 24 * k for k, p in enumerate(row)) for row in parts]


def _times(rows: DataFrame, centre: Centre, q: np.ndarray) -> np.ndarray:
    """V q: one pass over the rows."""

    def task(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = centre.centred(batch.column("vector"))
                total = x.T @ (x @ q) + (0 if total is None else total)
        return total

    return summed(rows, task).reshape(q.shape) / centre.n


def _lower_end(times, size: int, rng: np.random.Generator) -> float:
    """A value below which the covariance has little or no spectrum, by Lanczos steps."""
    q, before, beta = rng.normal(size=size), np.zeros(size), 0.0
    q /= np.linalg.norm(q)
    basis, diag, off = [], [], []
    for _ in range(min(LANCZOS, size)):
        w = times(q[:, None])[:, 0] - beta * before
        diag.append(float(q @ w))
        basis.append(q)
        w -= diag[-1] * q
        w -= np.stack(basis, axis=1) @ (np.stack(basis) @ w)
        beta = float(np.linalg.norm(w))
        off.append(beta)
        if beta <= 1e-12 * abs(diag[0]):
            break
        before, q = q, w / beta
    values, vectors = np.linalg.eigh(np.diag(diag) + np.diag(off[:-1], 1) + np.diag(off[:-1], -1))
    return max(0.0, float(values[0] - off[-1] * abs(vectors[-1, 0])))


def chebyshev(times, x: np.ndarray, vx: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V that is small on [low, high] and 1 at
    ``top``, times x; ``vx`` is V x."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - middle)
    y = (vx - middle * x) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        x, y = y, (times(y) - middle * y) * (2 * new / half) - sigma * new * x
        sigma = new
    return y


def leading(times, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(eigenvalues, eigenvectors, rounds) of the ``wanted`` largest, certified by
    their residuals; ``times`` multiplies the matrix with a block."""
    wanted = min(wanted, size)
    block = min(size, wanted + GUARD)
    rng = np.random.default_rng(SEED)
    full = block == size
    low = 0.0 if full else _lower_end(times, size, rng)
    q = np.eye(size) if full else np.linalg.qr(rng.normal(size=(size, block)))[0]
    last = np.inf
    for rounds in range(1, MOST_ROUNDS + 1):
        w = times(q)
        g = q.T @ w
        value, u = np.linalg.eigh((g + g.T) / 2)
        value, u = value[::-1], u[:, ::-1]
        q, w = q @ u, w @ u
        top = max(abs(value[0]), np.finfo(float).tiny)
        residual = np.linalg.norm(w[:, :wanted] - q[:, :wanted] * value[:wanted], axis=0).max() / top
        if full or residual <= TOLERANCE or residual <= ROUNDING and residual > last / 2:
            return value[:wanted], q[:, :wanted], rounds
        last = residual
        high = value[-1]
        bottom = min(low, high / 2) if high - low < 1e-6 * top else low
        if high <= 0 or top - high <= 1e-14 * top:
            # The block's values are one: nothing to damp, but new directions are to be met.
            q = np.linalg.qr(w)[0]
        else:
            q = np.linalg.qr(chebyshev(times, q, w, bottom, high, value[0], DEGREE))[0]
    raise RuntimeError(f"eigenvectors not certified after {MOST_ROUNDS} rounds: residual {residual:.1e} of the largest eigenvalue")


@dataclass
class Whitener:
    """``components`` are unit eigenvectors (columns) by falling ``values``;
    ``trace`` is that of the covariance, ``identity_error`` the largest absolute
    entry of the whitened rows' covariance minus the identity."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float
    rounds: int

    def apply(self, rows: DataFrame) -> DataFrame:
        """(id, deviation, whitened) of rows (id, vector) of the fitted length."""
        centre, project = self.centre, self.components / np.sqrt(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    lists = batch.column("vector")
                    z = centre.centred(lists) @ project
                    own = [v if v < 1 << 63 else None for v in centre.squares(lists)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(own, pa.int64()),
                         pa.array(list(z), pa.list_(pa.float64()))], ["id", "deviation", "whitened"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, vector) of the rows that are kept, written once, and their length."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).filter(finite(F.col("vector")))
    rows = stage(rows, "finite_vectors")
    commonest = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = commonest["size"] if commonest else 0
    return rows.filter(F.size("vector") == size), size


def fit(rows: DataFrame, size: int, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT) -> Whitener:
    """Whitener of rows (id, vector), all of length ``size``."""
    centre = Centre(size, scale, shift)
    none = Whitener(centre, np.zeros(0), np.zeros((size, 0)), 0.0, 0.0, 0)
    if not size:
        return none
    centre.n, centre.total = _sums(rows, centre)

    def squared(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = centre.centred(batch.column("vector"))
                total = (x * x).sum() + (0.0 if total is None else total)
        return None if total is None else np.array([total])

    trace = float(summed(rows, squared)[0]) / centre.n
    none.trace = trace
    if not trace > 0:
        return none
    # Scaled to a trace of 1, so that tiny spectra don't underflow.
    values, vectors, rounds = leading(lambda q: _times(rows, centre, q) / trace, size, components)
    keep = values > LEAST_EIGENVALUE * values[0]
    values, vectors = values[keep] * trace, vectors[:, keep]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
    project = vectors / np.sqrt(values)

    def moments(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = centre.centred(batch.column("vector")) @ project
                z = np.concatenate([np.ones((len(z), 1)), z], axis=1)
                total = z.T @ z + (0 if total is None else total)
        return total

    m = summed(rows, moments).reshape(len(values) + 1, -1) / centre.n
    error = float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(len(values))).max())
    return Whitener(centre, values, vectors, trace, error, rounds)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE, shift: int = SHIFT) -> tuple[Whitener, DataFrame]:
    """The whitener of all kept rows, and (id, deviation, whitened) of each."""
    rows, size = usable(vectors, id_col, vector_col)
    model = fit(rows, size, components, scale, shift)
    return model, model.apply(rows)
