"""Leading singular vectors of wide matrices by a randomised range finder.

Nothing of the size features x features is made. A step multiplies the rows of each task with a thin
matrix (features x (k + extra)) and sums the products by feature; the thin matrix is all that reaches
the driver. The last step is a tall-skinny QR: every task folds its rows into one triangle, tasks'
triangles are folded again in fewer tasks, and the driver folds the few that are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

THIN_BYTES = 1 << 29  # of the thin matrix, which every task holds twice


def _block(batch, at: int, width: int) -> np.ndarray:
    """The vectors of an Arrow batch as a matrix; a missing vector or component, or another length, is an error."""
    import pyarrow.compute as pc

    vectors = batch.column(at)
    if len(vectors) == 0:
        return np.zeros((0, width))
    parts = vectors.flatten()
    if vectors.null_count or parts.null_count or pc.any(pc.not_equal(pc.list_value_length(vectors), width)).as_py():
        raise ValueError(f"vectors must have {width} components, none of them missing")
    block = parts.to_numpy(zero_copy_only=False).reshape(-1, width)
    if not np.isfinite(block).all():
        raise ValueError("vectors must be finite")
    return block


def _products(rows: DataFrame, thin: np.ndarray) -> np.ndarray:
    """A'(A W), summed by feature on the executors."""
    import pyarrow as pa

    width, columns = thin.shape
    names = [f"p{j}" for j in range(columns)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, columns))
        for batch in batches:
            block = _block(batch, 0, width)
            total += block.T @ (block @ thin)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), *[pa.array(total[:, j]) for j in range(columns)]], names=["feature", *names]
        )

    parts = rows.mapInArrow(multiply, ", ".join(["feature long", *[f"{n} double" for n in names]]))
    summed = parts.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # one thin matrix
    return summed.sort_values("feature")[names].to_numpy()


def _triangle(rows: DataFrame, thin: np.ndarray) -> np.ndarray:
    """R of A W = Q R."""
    import pyarrow as pa

    width, columns = thin.shape

    def fold(batches, block_of):
        found = np.zeros((0, columns))
        for batch in batches:
            found = np.linalg.qr(np.vstack([found, block_of(batch)]), mode="r")
        if len(found):
            flat = pa.array([found.ravel()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([flat], names=["r"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(batches, lambda b: _block(b, 0, width) @ thin)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold(batches, lambda b: b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, columns))

    triangles = rows.mapInArrow(first, "r array<double>")
    few = max(1, math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    last = triangles.repartition(few).mapInArrow(again, "r array<double>").collect()  # ``few`` triangles
    stacked = np.vstack([np.zeros((1, columns)), *[np.array(t.r).reshape(-1, columns) for t in last]])
    return np.linalg.qr(stacked, mode="r")


def leading_vectors(
    df: DataFrame, vector: str, k: int, extra: int = 10, tolerance: float = 1e-10, max_steps: int = 50, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(values, right vectors): the ``k`` largest singular values of the rows' matrix, uncentred.

    Power steps go on until the values change by less than the tolerance, relative to the first one,
    or ``max_steps`` are done. At any step U = A V / s has orthonormal columns and the squared
    distance from A to U S V' is the total of squares less the sum of squared values; values of rank
    below ``k`` are left out. The largest component of each right vector, the first among equals, is
    positive. An empty table has no values. ``df`` is read once for each step.
    """
    rows = df.select(F.col(vector).cast("array<double>").alias("v"))
    one = rows.where(F.col("v").isNotNull()).select(F.size("v").alias("n")).first()
    if one is None or not one.n:
        return np.zeros(0), np.zeros((one.n if one else 0, 0))
    width, columns = one.n, min(one.n, k + extra)
    if 8 * width * columns > THIN_BYTES:
        raise ValueError(f"{width} x {columns} numbers are more than {THIN_BYTES} bytes; take a smaller k")
    if columns == width:
        thin = np.eye(width)
    else:
        thin = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, columns)))[0]
        before = np.zeros(min(k, columns))
        for _ in range(max_steps):
            thin, r = np.linalg.qr(_products(rows, thin))
            now = np.sqrt(np.linalg.svd(r, compute_uv=False)[: len(before)])
            done = np.abs(now - before).max() <= tolerance * now[0]
            before = now
            if done:
                break
    _, values, turned = np.linalg.svd(_triangle(rows, thin))
    values = values[:k]
    rank = int((values > values[0] * 1e-12).sum()) if len(values) and values[0] > 0 else 0
    right = thin @ turned[:rank].T
    if rank:
        largest = np.abs(np.round(right, 12)).argmax(axis=0)
        right = right * np.where(right[largest, np.arange(rank)] < 0, -1.0, 1.0)
    return values[:rank], right


def left_vectors(df: DataFrame, vector: str, values: np.ndarray, right: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``u``, the row of U = A V / s, for every row."""
    import pyarrow as pa

    scaled = right / values
    rows = df.select(F.col(vector).cast("array<double>").alias("__v"), *keep)
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep], "u array<double>"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = _block(batch, 0, scaled.shape[0]) @ scaled
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1, dtype=np.int32) * u.shape[1], pa.int32()), pa.array(u.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], flat], names=[*keep, "u"])

    return rows.mapInArrow(place, schema)
