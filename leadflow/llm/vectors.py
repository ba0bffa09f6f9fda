"""Vectors in packed blocks, for operators that read embeddings several times."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Squared distances of whole vectors stay below this, so that every sum of them in a task is exact.
EXACT = 1 << 62


def finite_vectors(rows: DataFrame, vec_col: str, *, dims: int | None = None) -> DataFrame:
    """The rows whose vector has no null or non-finite component (and `dims` components, if given),
    with the vector as array<double>. Null vectors go; other columns stay."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    kept = rows.withColumn(vec_col, v.cast("array<double>")).filter(v.isNotNull() & fine)
    return kept if dims is None else kept.filter(F.size(vec_col) == dims)


def whole_numbers(lists: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * component) of a list array as an n x dims matrix; shorter vectors are padded by
    zeros. Components so large that a squared distance could leave 64 bits are refused."""
    n, values = len(lists), lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == dims).all():
        x = values.reshape(n, dims)
    else:
        x = np.zeros((n, dims))
        x[np.arange(dims)[None, :] < sizes[:, None]] = values
    x = np.floor(scale * x)
    top = float(np.abs(x).max(initial=0))
    if max(dims, 1) * (2 * top + 1) ** 2 >= EXACT:
        raise ValueError(f"component {top / scale:g} is too large for exact squared distances in 64 bits")
    return x.astype(np.int64)


def compact(m: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest signed type."""
    for kind in (np.int8, np.int16, np.int32):
        info = np.iinfo(kind)
        if not m.size or (m.min() >= info.min and m.max() <= info.max):
            return m.astype(kind)
    return m.astype(np.int64)


def blocks_of(batches, rows: int, columns: list[str]):
    """Regroup Arrow batches into lists of arrays of up to `rows` rows."""
    held: list[pa.RecordBatch] = []
    count = 0

    def out(part):
        table = pa.Table.from_batches(part).combine_chunks()
        return [table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0) for c in columns]

    for b in batches:
        start = 0
        while start < b.num_rows:
            step = min(rows - count, b.num_rows - start)
            held.append(b.slice(start, step))
            start, count = start + step, count + step
            if count == rows:
                yield out(held)
                held, count = [], 0
    if count:
        yield out(held)
