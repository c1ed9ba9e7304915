"""Vectors as blocks: rows of whole numbers, packed into matrices that tasks multiply."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..shipping import map_arrow
from .columns import pick

#: Rows of a block, and entries of its matrix.
BLOCK_ROWS, BLOCK_ENTRIES = 2048, 1 << 19
BLOCKS = "n int, dims int, width int, ids binary, no_id binary, labels binary, matrix binary, norm2 double"


def _rows(batch: pa.RecordBatch, needs_label: bool) -> tuple[np.ndarray, ...]:
    """ids, no_id, labels, offsets, lengths and entries of rows whose vector is there and finite throughout."""
    ids, labels, column = batch.column(0), batch.column(1), batch.column(2)
    n = len(column)
    offsets = np.asarray(column.offsets, np.int64)
    start, lengths = offsets[0], np.diff(offsets)
    entries = column.values.slice(start, offsets[-1] - start).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    at = offsets - start
    fine = np.asarray(column.is_valid()) & (bad[at[1:]] == bad[at[:-1]])
    if needs_label:
        fine &= np.asarray(labels.is_valid())
    no_id = np.asarray(ids.is_null())
    plain = lambda c: c.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    keep = np.flatnonzero(fine)
    return plain(ids)[keep], no_id[keep], plain(labels)[keep], at[:-1][keep], lengths[keep], entries if n else entries[:0]


def narrowest(m: np.ndarray) -> np.ndarray:
    most = max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
    return m.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _packed(scale: int, offset: int, needs_label: bool, dims: int):
    def run(batches):
        size = max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // max(dims, 1)))
        waiting: list[tuple] = []
        held = 0

        def block():
            nonlocal waiting, held
            ids, no_id, labels, m = (np.concatenate(x) for x in zip(*waiting))
            waiting, held = [], 0
            small = narrowest(m)
            norm2 = float((m.astype(np.float64) ** 2).sum(1).max()) if m.size else 0.0
            row = [len(ids), dims, small.itemsize, ids.tobytes(), no_id.tobytes(), labels.tobytes(), small.tobytes(), norm2]
            types = [pa.int32()] * 3 + [pa.binary()] * 4 + [pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=["n", "dims", "width", "ids", "no_id", "labels", "matrix", "norm2"])

        for batch in batches:
            ids, no_id, labels, starts, lengths, entries = _rows(batch, needs_label)
            floors = np.floor(entries[np.isfinite(entries)] * scale)
            if floors.size and np.abs(floors).max() >= 2.0**62:
                raise OverflowError("an entry of a vector is too large for a whole number of 64 bits")
            for i in range(0, len(ids), size):
                part = slice(i, min(i + size, len(ids)))
                m = np.full((part.stop - part.start, dims), offset, np.int64)
                inside = np.arange(dims)[None, :] < lengths[part, None]
                at = (starts[part, None] + np.arange(dims)[None, :])[inside]
                m[inside] += np.floor(entries[at] * scale).astype(np.int64)
                if held + len(m) > size:
                    yield block()
                waiting.append((ids[part], no_id[part], labels[part], m))
                held += len(m)
        if waiting and held:
            yield block()

    return run


def blocks(scratch: Scratch, rows: DataFrame, scale: int, needs_label: bool, offset: int = 0) -> tuple[DataFrame, int]:
    """A written table of blocks (BLOCKS and a number, block), and the greatest length of a vector. rows: vec_id, label,
    embedding. Each entry c becomes floor(scale * c) + offset. Rows whose vector is null or holds null or non-finite entries,
    or (if it is needed) whose label is null, are left out; shorter vectors are filled up with 0."""
    given = pick(rows, "vec_id", "label", "embedding") if needs_label else pick(rows, "vec_id", "embedding").withColumn("label", F.lit(0))
    taken = given.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    dims = max(taken.agg(F.max(F.size("embedding"))).first()[0] or 0, 0)
    made = map_arrow(taken, _packed(scale, offset, needs_label, dims), BLOCKS).withColumn("block", F.monotonically_increasing_id())
    return scratch.table(made, "blocks"), dims


def matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["matrix"], f"<i{row['width']}").reshape(row["n"], row["dims"])


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exact: by GEMM where every partial sum is exact in a double, else in integers."""
    top = lambda m: max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
    bound = top(a) * top(b) * max(a.shape[1], 1)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise OverflowError("an inner product may be too large for a whole number of 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def exact_gram(d: np.ndarray) -> np.ndarray:
    """d.T @ d of whole numbers, exact: one GEMM where sums are exact in doubles, else one for each pair of 20-bit limbs."""
    limbs, rest = [], d
    while rest.size and max(abs(int(rest.min())), abs(int(rest.max()))) ** 2 * len(d) >= 1 << 53:
        limbs.append((rest & 0xFFFFF).astype(np.float64))
        rest = rest >> 20
    limbs.append(rest.astype(np.float64))
    if len(limbs) == 1:
        return (limbs[0].T @ limbs[0]).astype(np.int64)
    total = np.zeros((d.shape[1], d.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (20 * (i + j))
    return total


def exact_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of arrays of whole numbers: in 64 bits where it fits, else in Python's integers."""
    top = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if a.dtype != object and b.dtype != object and top(a) + top(b) < 1 << 62:
        return a + b
    return a.astype(object) + b.astype(object)
