"""Whitening of embeddings by shifted CholeskyQR.

Entries ``c`` become whole numbers ``x = floor(scale * c)``, whose sums and means are exact; a constant added to
all ``x`` changes no result, since only ``x`` less its mean is ever used.
The rows less their mean are orthogonalised without being kept: a pass over the table adds up the Gram
matrix of the rows as they are after the triangular solves so far, and the driver factors it. The first
factor has a shift that makes it exist however ill-conditioned the rows are, later ones only if they
need it. Passes end when the Gram matrix is the identity. The composed triangular factor ``R`` has the
singular values and right singular vectors of the centred rows, so its SVD gives eigenvalues and
components of the covariance without ever squaring small singular values into rounding error.

A task returns one triangle of sums, so a pass shuffles ``d * d / 2`` numbers a task and brings as many to
the driver, whatever the number of rows. One more pass measures the covariance of the whitened rows.

Defined results: rows whose vector is null, empty, or has a null, infinite or NaN entry, are dropped; so
are entries of ``LIMIT / scale`` or more with their rows, and vectors that have not the commonest length
(the longest on ties). Repeated rows count each; rows with a null id keep it. Components without variance
(beyond the numerical rank) cannot be whitened and are left out, so one vector, or equal ones, give no
rows. A deviation beyond 64 bits is null. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.tokens import row_slices
from presspulse.sources.storage import cut_lineage

COMPONENTS, SCALE = 32, 64
LIMIT = 1 << 50
BATCH = 4096
PASSES = 8
ORTHOGONAL = 1e-12  # largest entry of the Gram matrix less the identity at which passes end
RANK = 1e-11  # least singular value, as a share of the largest
UNIT = np.finfo(float).eps / 2


class Centre(NamedTuple):
    """Exact mean of ``n`` rows: ``floor`` and ``rest / n`` of each dimension."""

    n: int
    floor: np.ndarray
    rest: np.ndarray

    def rows(self, batch: pa.RecordBatch, scale: int) -> np.ndarray:
        """The rows of a batch less ``floor``, as whole numbers."""
        flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return np.floor(flat * scale).astype(np.int64).reshape(-1, len(self.floor)) - self.floor

    def centred(self, batch: pa.RecordBatch, scale: int) -> np.ndarray:
        return self.rows(batch, scale) - (self.rest / self.n).astype(np.float64)


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``r``, column by column."""
    out = rows.T.copy()
    for j in range(len(r)):
        out[j] = (out[j] - r[:j, j] @ out[:j]) / r[j, j]
    return out.T


def factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper triangular ``r`` with ``r.T @ r`` the Gram matrix, shifted if asked for or needed."""
    d = len(gram)
    shift = 11 * (BATCH * d + d * (d + 1)) * UNIT * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            r = np.linalg.cholesky(gram).T
            if r.diagonal().min() ** 2 > shift:
                return r
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def _moments(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in row_slices(batches, BATCH):
            sizes = batch["vector"].value_lengths().to_numpy()
            flat = np.floor(batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
            for d in np.unique(sizes).tolist():
                x = flat[np.repeat(sizes == d, sizes)].reshape(-1, d)
                n, total, low, high = found.get(d, [0, 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min])
                total = total + x.sum(axis=0).astype(object)
                found[d] = [n + len(x), total, np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))]
        for d, (n, total, low, high) in found.items():
            whole = pa.array(total, pa.decimal128(38, 0))
            columns = [[d] * d, [n] * d, range(d), whole, low, high]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=["d", "n", "dim", "total", "low", "high"])

    return add


def _gram(centre, live: np.ndarray, factors: list[np.ndarray], scale: int, last: np.ndarray | None = None):
    """Sums of products of the rows after all solves, or of their projections ``last``, by cell."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(live) if last is None else last.shape[1]
        gram = np.zeros((d, d))
        for batch in row_slices(batches, BATCH):
            rows = centre.centred(batch, scale)
            rows = rows[:, live] if last is None else rows @ last
            for r in factors:
                rows = solve(rows, r)
            gram += rows.T @ rows
        upper = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(gram[upper])], names=["cell", "part"])

    return add


def _summed(kept: DataFrame, d: int, add) -> np.ndarray:
    cells = kept.select("vector").mapInArrow(add, "cell long, part double").groupBy("cell").agg(F.sum("part").alias("s"))
    upper = np.zeros(d * (d + 1) // 2)
    for r in cells.collect():  # d * (d + 1) / 2 rows
        upper[r["cell"]] = r["s"]
    gram = np.zeros((d, d))
    gram[np.triu_indices(d)] = upper
    return gram + np.triu(gram, 1).T


class Whitening(NamedTuple):
    centre: Centre
    directions: np.ndarray  # unit eigenvectors, a column each
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def fit(kept: DataFrame, components: int, scale: int) -> Whitening | None:
    """Mean and components of the vectors; None if there are none or they don't vary."""
    moments = cut_lineage(kept.select("vector").mapInArrow(_moments(scale), "d long, n long, dim long, total decimal(38,0), low long, high long"))
    sizes = moments.where("dim = 0").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return None
    d, n = sizes[0]["d"], int(sizes[0]["n"])
    by_dim = moments.where(F.col("d") == d).groupBy("dim").agg(F.sum("total").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = sorted(by_dim.collect(), key=lambda r: r["dim"])  # d rows
    total = [int(r["s"]) for r in found]
    centre = Centre(n, np.array([s // n for s in total], np.int64), np.array([s % n for s in total], object))
    live = np.array([i for i, r in enumerate(found) if r["low"] < r["high"]], np.int64)
    if not len(live):
        return None
    kept = kept.where(F.size("vector") == d)
    factors: list[np.ndarray] = []
    whole = np.eye(len(live))
    for i in range(PASSES):
        gram = _summed(kept, len(live), _gram(centre, live, factors, scale))
        trace = float(np.trace(gram)) if not i else trace
        if i and np.abs(gram - np.eye(len(live))).max() < ORTHOGONAL:
            break
        factors.append(factor(gram, shifted=not i))
        whole = factors[-1] @ whole
    else:  # dimensions depend on each other: the last Gram matrix has no triangular factor
        value, vector = np.linalg.eigh(_summed(kept, len(live), _gram(centre, live, factors, scale)))
        whole = np.sqrt(np.maximum(value, 0))[:, None] * (vector.T @ whole)
    _, sigma, right = np.linalg.svd(whole)
    held = min(components, int((sigma > RANK * sigma[0]).sum()))
    directions = np.zeros((d, held))
    directions[live] = right[:held].T
    directions *= np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(held)])
    eigenvalues = sigma[:held] ** 2 / n
    of_whitened = _summed(kept, held, _gram(centre, live, [], scale, directions / np.sqrt(eigenvalues))) / n
    return Whitening(centre, directions, eigenvalues, trace / n, float(np.abs(of_whitened - np.eye(held)).max()))


def deviations(rows: np.ndarray, centre: Centre) -> pa.Array:
    """Sums over the dimensions of ``(n * x - S)²``; ``rows`` are less the mean's floor."""
    n, rest = centre.n, centre.rest
    rough = ((rows * float(n) - rest.astype(np.float64)) ** 2).sum(axis=1)
    safe = rough < 2.0**62
    gap = rows[safe] * n - rest.astype(np.int64)
    out = np.full(len(rows), None, object)
    out[safe] = np.einsum("ij,ij->i", gap, gap)
    for i in np.flatnonzero(~safe & (rough < 2.0**64)):
        exact = sum((n * int(x) - int(r)) ** 2 for x, r in zip(rows[i], rest, strict=True))
        out[i] = exact if exact < 1 << 63 else None
    return pa.array(out, pa.int64())


def _project(centre: Centre, directions: np.ndarray, eigenvalues: np.ndarray, scale: int):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = len(eigenvalues)
        weights = directions / np.sqrt(eigenvalues)
        for batch in row_slices(batches, BATCH):
            each = pa.array(np.repeat(np.arange(batch.num_rows), held))
            whitened = centre.centred(batch, scale) @ weights
            columns = [
                batch["vec_id"].take(each),
                pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), batch.num_rows)),
                deviations(centre.rows(batch, scale), centre).take(each),
                pa.array(whitened.reshape(-1)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "deviation", "whitened"])

    return project


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row for each usable vector of ``embeddings(vec_id, embedding)`` and component: the whitened
    coordinate and the vector's deviation, with the component's share of the variance and the largest
    error of the whitened covariance."""
    small = lambda x: x.isNotNull() & (F.abs(x) < LIMIT / scale)  # noqa: E731  NaN is larger than all numbers
    read = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    kept = read.where(F.coalesce((F.size("vector") > 0) & F.forall("vector", small), F.lit(False)))
    model = fit(kept, components, scale)
    rows = "vec_id long, component int, deviation long, whitened double"
    if model is None:
        model = Whitening(Centre(0, np.zeros(0), np.zeros(0)), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
        out = embeddings.sparkSession.createDataFrame([], rows)
    else:
        kept = kept.where(F.size("vector") == len(model.directions))
        out = kept.mapInArrow(_project(model.centre, model.directions, model.eigenvalues, scale), rows)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    return out.select(
        "vec_id",
        "component",
        F.lit(model.centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
