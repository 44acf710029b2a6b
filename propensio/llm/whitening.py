"""Embedding whitening: spectral divide and conquer by QDWH polar decompositions, then a broadcast projection.

* Entries c become whole numbers x = floor(scale * c) + offset. Row count n and per-dimension sums S are exact integers.
* The covariance V is summed from x - S/n, centred before multiplying, one dim x dim partial matrix a task.
* Components: a symmetric block less a shift has a polar factor with eigenvalues -1 and 1, so (factor + I) / 2 projects on the
  invariant subspace above the shift. QDWH (dynamically weighted Halley steps by QR, then Cholesky) finds the factor in
  about six steps; a basis of the two subspaces splits the block in two, and each is split again
  until single components are left. Only the dim x dim matrix, whose size doesn't depend on the rows, is on the driver.
* Projection of every row on the broadcast components, over sqrt(e). The identity error is measured on the written result.

Null vectors, vectors with null or non-finite entries, with entries that no long holds (|c| of 2^62 / scale and
more) or of another length than the commonest (the shorter of equally common ones) are dropped. Null ids and repeated rows stay rows of
their own. A component without variance (a constant dimension, one row only) can't be whitened: its value is 0 and it is left
out of the identity error. ``deviation`` is null where no long holds it; ``deviation_exact`` is decimal(38,0) and null beyond that only. An empty
table gives an empty result. Further columns of the table are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Rows of a batch that are turned into a matrix at once.
SLICE = 4096
_EPS = float(np.finfo(np.float64).eps)


def polar_sign(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """Polar factor of a symmetric matrix by QDWH."""
    m = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    low = max(float(np.linalg.svd(x, compute_uv=False)[-1]) * 0.9, _EPS)  # lower bound of the singular values
    eye = np.eye(m)
    for _ in range(steps):
        l2 = low * low
        d = (4 * (1 - l2) / l2**2) ** (1 / 3)
        w = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * np.sqrt(1 + d))))
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, eye]))
            new = (b / c) * x + (w - b / c) / np.sqrt(c) * q[:m] @ q[m:].T
        else:
            new = (b / c) * x + (w - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (w + b * l2) / (1 + c * l2))
        moved, x = np.linalg.norm(new - x), new
        if moved < 1e-13 * np.sqrt(m) or (1 - low < 10 * _EPS and moved < 1e-5):
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if the shift doesn't part them cleanly."""
    m = len(a)
    projector = (polar_sign(a - shift * np.eye(m)) + np.eye(m)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return None
    g = rng.normal(size=(m, m))
    q, _ = np.linalg.qr(np.concatenate([projector @ g[:, :k], g[:, k:] - projector @ g[:, k:]], axis=1))
    up, down = q[:, :k], q[:, k:]
    return (up, down) if np.linalg.norm(down.T @ a @ up) <= 1e-12 * np.linalg.norm(a) else None


def spectral_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix by spectral divide and conquer."""
    v = (v + v.T) / 2
    size, rng, leaves = np.linalg.norm(v), np.random.default_rng(11), []
    todo = [np.eye(len(v))]
    while todo:
        basis = todo.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        if len(a) == 1 or np.linalg.norm(a - np.diag(np.diag(a))) <= 4 * _EPS * size:
            leaves.append(basis)
            continue
        middle, spread = np.trace(a) / len(a), np.linalg.norm(a - np.trace(a) / len(a) * np.eye(len(a))) / np.sqrt(len(a))
        # the mean of the eigenvalues lies between them, unless all are equal; an eigenvalue close to it moves the shift a little
        found = next((s for f in (0.0, 0.1, -0.1, 0.3, -0.3, 0.6, -0.6, 0.01, -0.01) if (s := _split(a, middle + f * spread, rng))), None)
        if found is None:  # equal to rounding
            leaves.append(basis)
        else:
            todo += [basis @ found[0], basis @ found[1]]
    x = np.concatenate(leaves, axis=1)
    for _ in range(2):  # one step doubles the correct digits of well separated directions
        r, s = np.eye(len(v)) - x.T @ x, x.T @ v @ x
        e = np.diag(s) / (1 - np.diag(r))
        gap = e[None, :] - e[:, None]
        wide = np.abs(gap) > 2 * (np.linalg.norm(s - np.diag(e)) + size * np.linalg.norm(r)) + 1e-14 * size
        x = x + x @ np.where(wide, (s + e[None, :] * r) / np.where(wide, gap, 1.0), r / 2)
    e = np.diag(x.T @ v @ x)
    order = np.argsort(-e, kind="stable")
    x = x[:, order]
    return e[order], x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(v))] < 0, -1.0, 1.0)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, rows x dim whole numbers) in slices of at most ``SLICE`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs if they hold it, else in Python integers."""
    if n * int(np.abs(x).max(initial=0)) < 2**61 and max(map(abs, sums)) < 2**61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for _, x in _matrices(batches):
        part = x.sum(axis=0).tolist() if len(x) * int(np.abs(x).max()) < 2**62 else x.astype(object).sum(axis=0).tolist()
        total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        n += len(x)
    if total:
        yield pa.RecordBatch.from_pydict({"place": list(range(len(total))), "n": [n] * len(total), "s": [str(t) for t in total]}, schema=pa.schema([("place", pa.int32()), ("n", pa.int64()), ("s", pa.string())]))


def _matrix_rows(m: np.ndarray) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_pydict({"place": np.arange(m.size, dtype=np.int32), "s": m.ravel()})


def _partial_scatter(n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(sums)))
        for _, x in _matrices(batches):
            d = (_deviations(x, n, sums) / n).astype(np.float64)
            total += d.T @ d
        yield from _matrix_rows(total)

    return run


def _project(n: int, sums: list[int], basis):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches):
            d = _deviations(x, n, sums)
            if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2**63:
                squares = (d * d).sum(axis=1).tolist()
            else:
                squares = (d.astype(object) ** 2).sum(axis=1).tolist()
            white = (d / n).astype(np.float64) @ basis.value
            columns = [
                ids,
                pa.array([q if q < 2**63 else None for q in squares], pa.int64()),
                pa.array([Decimal(q) if q < 10**38 else None for q in squares], pa.decimal128(38, 0)),
                pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "deviation_exact", "white"])

    return run


def _white_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for _, w in _matrices(batches):
        total = total + w.sum(axis=0)
    if not np.isscalar(total):
        yield from _matrix_rows(total)


def _white_scatter(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for _, w in _matrices(batches):
            total += (w - mean).T @ (w - mean)
        yield from _matrix_rows(total)

    return run


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Entries of partial matrices summed over the tasks; ``size`` numbers reach the driver."""
    out = np.zeros(size)
    for r in rows.groupBy("place").agg(F.sum("s").alias("s")).collect():
        out[r["place"]] = r["s"]
    return out


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``, ``deviation_exact``."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where(f"v is not null and size(v) > 0 and forall(v, c -> c is not null and not isnan(c) and abs(c) < {2.0**62 / scale!r}D)")
    lengths = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    rows = v.where(F.size("v") == dim).select("id", F.expr(f"transform(v, c -> cast(floor({scale} * c) as long) + {offset}L)").alias("x"))
    if not lengths:
        return rows.selectExpr(f"id as `{id_col}`", "0 as component", "0L as n", "0L as deviation", "0D as whitened", "0D as explained", "0D as identity_error", "cast(0 as decimal(38,0)) as deviation_exact")
    found = rows.mapInArrow(_partial_sums, "place int, n long, s string").groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    n, sums = int(found[0]["n"]), [int(r["s"]) for r in sorted(found, key=lambda r: r["place"])]
    v_matrix = _summed(rows.mapInArrow(_partial_scatter(n, sums), "place int, s double"), dim * dim).reshape(dim, dim) / n
    e, axes = spectral_components(v_matrix)
    k = min(components, dim)
    trace = float(np.trace(v_matrix))
    live = e[:k] > dim * _EPS * max(e[0], 0.0)
    basis = spark.sparkContext.broadcast(np.where(live, axes[:, :k] / np.sqrt(np.where(live, e[:k], 1.0)), 0.0))
    schema = "id long, deviation long, deviation_exact decimal(38,0), white array<double>"
    white = materialize(rows.mapInArrow(_project(n, sums, basis), schema), "whitened")
    mean = _summed(white.select("id", "white").mapInArrow(_white_sums, "place int, s double"), k) / n
    spread = _summed(white.select("id", "white").mapInArrow(_white_scatter(mean), "place int, s double"), k * k).reshape(k, k) / n
    error = float(np.abs(spread - np.eye(k))[np.ix_(live, live)].max(initial=0.0))
    share = F.element_at(F.lit([float(x / trace) if trace > 0 else 0.0 for x in e[:k]]), F.col("component"))
    out = white.select("id", "deviation", "deviation_exact", F.posexplode("white").alias("pos", "whitened")).withColumn("component", F.col("pos") + 1)
    return out.select(
        F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact"
    )
