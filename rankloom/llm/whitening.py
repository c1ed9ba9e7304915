"""Embedding whitening by a two-pass covariance.

The first pass sums the whole-number vectors, exactly. The second centres each vector at the whole number next to the
mean and sums outer products, a GEMM for each block, exactly too: partial sums are whole numbers, so neither the number
of tasks nor the order in which treeAggregate merges them changes a bit. What the centre lacks of the mean is taken
out in integers at the end, and each entry of the covariance is rounded once. LAPACK's symmetric eigh gives the
components; the projection, components by dimensions in size however many rows there are, is broadcast. A third pass
takes the covariance of what comes out.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out. A null id stays null.
Copies of a row count each and are all returned. Shorter vectors are filled up with 0 before they are made whole
numbers. Components whose eigenvalue isn't above rounding (constant or dependent dimensions, fewer rows than
dimensions) cannot be whitened and are not returned; vectors that are all alike give no rows, nor does an empty table.
A deviation beyond 64 bits is null, deviation_exact has it. Of either direction of a component the one whose largest
entry is positive is taken. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..scratch import Scratch
from ..shipping import map_arrow
from . import vectors

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def _summed(rows: DataFrame, of_block, dims: int):
    """(n, sums) of of_block(matrix), merged over all blocks as a tree; of_block gives an array for a block of rows."""

    def parts(batches):
        total = None
        for batch in batches:
            for r in batch.to_pylist():
                part = (r["n"], of_block(vectors.matrix(r)))
                total = part if total is None else _merged(total, part)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([pickle.dumps(total)], pa.binary())})

    made = map_arrow(rows, parts, "part binary").rdd.map(lambda r: pickle.loads(r["part"]))
    return made.treeAggregate(None, _merged, _merged) or (0, np.zeros(dims, np.int64))


def _merged(a, b):
    if a is None or b is None:
        return b if a is None else a
    whole = a[1].dtype == object or np.issubdtype(a[1].dtype, np.integer)
    return a[0] + b[0], vectors.exact_add(a[1], b[1]) if whole else a[1] + b[1]


@dataclass
class Projection:
    """n rows were fitted; their mean is centre + rest / n, entry by entry. One row of axes for each component."""

    n: int
    centre: np.ndarray
    rest: list[int]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def whitened(self, m: np.ndarray) -> np.ndarray:
        off = (m - self.centre).astype(np.float64) - np.array([r / self.n for r in self.rest])
        return off @ self.axes.T / np.sqrt(self.eigenvalues)

    def deviations(self, m: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2 for each row, exact."""
        d, n, rest = m - self.centre, self.n, np.array(self.rest, object)
        most = max(abs(int(d.min())), abs(int(d.max()))) if d.size else 0
        if (n * most + max(map(abs, self.rest), default=0)) ** 2 * max(d.shape[1], 1) < 1 << 63:
            return ((n * d - rest.astype(np.int64)) ** 2).sum(1).tolist()
        squares = (d * d).sum(1) if most**2 * d.shape[1] < 1 << 63 else (d.astype(object) ** 2).sum(1)
        crossed = d @ rest.astype(np.int64) if most * sum(map(abs, self.rest)) < 1 << 63 else d.astype(object) @ rest
        constant = sum(r * r for r in self.rest)
        return [n * n * int(q) - 2 * n * int(c) + constant for q, c in zip(squares, crossed)]


def fit(packed: DataFrame, dims: int, components: int) -> Projection | None:
    """The projection of a table of blocks; None if it has no rows."""
    n, sums = _summed(packed, _column_sums, dims)
    if not n or not dims:
        return None
    sums = [int(s) for s in sums]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    centre, rest = np.array(middle, np.int64), [s - n * c for s, c in zip(sums, middle)]
    _, outer = _summed(packed, lambda m: vectors.exact_gram(m - centre), dims)
    cells = [[int(x) for x in row] for row in outer]
    covariance = np.array([[(n * cells[i][j] - rest[i] * rest[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(float(values.max()), 0.0) * dims * np.finfo(float).eps]
    axes = axes[:, order].T
    if len(axes):
        axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])[:, None]
    return Projection(n, centre, rest, axes, values[order], values[order] / max(float(np.trace(covariance)), np.finfo(float).tiny))


def _column_sums(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.int64)
    most = max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
    return m.sum(0) if most * max(len(m), 1) < 1 << 62 else m.astype(object).sum(0)


def identity_error(packed: DataFrame, projection: Projection, dims: int) -> float:
    """The largest absolute entry of the covariance of what the fitted rows become, less the identity."""
    shared = packed.sparkSession.sparkContext.broadcast(projection)
    k = len(projection.axes)

    def moments(m: np.ndarray) -> np.ndarray:
        z = shared.value.whitened(m)
        return np.vstack([z.sum(0)[None, :], z.T @ z])

    n, total = _summed(packed, moments, dims)
    mean = total[0] / n
    return float(np.abs(total[1:] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """For each row and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact.
    rows: vec_id, embedding; each entry c counts as the whole number floor(scale * c) + offset."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "whitening")
    packed, dims = vectors.blocks(scratch, rows, scale, needs_label=False, offset=offset)
    projection = fit(packed, dims, components)
    if projection is None or not len(projection.axes):
        scratch.drop_all()
        return spark.createDataFrame([], RESULT)
    error = identity_error(packed, projection, dims)
    shared = spark.sparkContext.broadcast(projection)

    def project(batches):
        p = shared.value
        k = len(p.axes)
        for batch in batches:
            for r in batch.to_pylist():
                m, n = vectors.matrix(r), r["n"]
                no_id = np.frombuffer(r["no_id"], bool)
                exact = p.deviations(m)
                fits = [d if d < 1 << 63 else None for d in exact]
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["ids"], "<i8"), mask=no_id).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, p.n, np.int64)),
                        pa.array(fits, pa.int64()).take(each),
                        pa.array(p.whitened(m).ravel()),
                        pa.array(np.tile(p.explained, n)),
                        pa.array(np.full(n * k, error)),
                        pa.array([Decimal(d) if d < 10**38 else None for d in exact], pa.decimal128(38, 0)).take(each),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return map_arrow(packed, project, RESULT)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
