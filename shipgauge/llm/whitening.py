"""Embedding whitening: principal directions by blockwise QR and a bidiagonal solver.

Entries become whole numbers, so that counts, sums and deviations are exact.
Centred rows are never multiplied with each other: each task reduces its rows
to a triangular factor R, block by block, factors are merged over two shuffles,
and R's singular values and right singular vectors (``bidiagonal``) are the
square roots of the variances and the directions. What reaches the driver does
not grow with the number of rows: sums, and at most ``FACTORS`` factors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .bidiagonal import singular
from .common import unused
from .vectors import EXACT, dimension, exact, exact_column, floors, matrices, partial_rows

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FACTORS = 16   # merged blocks that the driver gets
NOISE = 1e-20  # variances below this share of the largest one can't be told from rounding

BLOCK = [T.StructField("block", T.ArrayType(T.DoubleType()))]


@dataclass(frozen=True)
class Whitening:
    """The fit list's figures. ``directions`` has one unit row for each component, ``variances`` fall, ``total`` is the trace."""

    size: int
    n: int
    sums: tuple[int, ...]
    largest: int
    directions: np.ndarray
    variances: np.ndarray
    total: float


def _numbers(entries: np.ndarray) -> np.ndarray:
    return floors(entries, SCALE) + OFFSET


def _moved(x: np.ndarray, n: int, sums: tuple[int, ...], largest: int) -> np.ndarray:
    """n * x - S, exact: longs, or Python's integers where longs don't suffice."""
    x = exact(x, 2 * n * (largest + 1))
    return n * x - np.array(sums, x.dtype)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...], largest: int) -> np.ndarray:
    return _moved(x, n, sums, largest).astype(float) / n


def _totals(df: DataFrame, vector: str, size: int) -> tuple[int, tuple[int, ...], int]:
    """(rows that take part, sums of x by dimension, largest absolute x)."""
    def make():
        n, largest, sums = 0, 0, np.zeros(size, object)

        def add(batch):
            nonlocal n, largest
            for _, entries in matrices(batch, vector, size):
                x = _numbers(entries)
                n += len(x)
                largest = max(largest, int(np.abs(x).max(initial=0)))
                high = x >> 24
                sums[:] += (high.sum(axis=0).astype(object) << 24) + (x - (high << 24)).sum(axis=0)

        def finish():
            yield [np.arange(size), [n] * size, [largest] * size, exact_column(sums)]
        return add, finish

    fields = [T.StructField("at", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("largest", T.LongType()),
              T.StructField("sum", EXACT)]
    rows = (partial_rows(df, [vector], fields, make).groupBy("at")
            .agg(F.sum("n").alias("n"), F.max("largest").alias("largest"), F.sum("sum").alias("sum")).orderBy("at").collect())
    return (rows[0]["n"], tuple(int(r["sum"]) for r in rows), rows[0]["largest"]) if rows else (0, (0,) * size, 0)


def _merged(blocks: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """All rows of ``block`` merged: in as many tasks as a shuffle has, then in ``FACTORS``, then here."""
    arrow = to_arrow_schema(T.StructType(BLOCK))

    def run(batches):
        found = None
        for batch in batches:
            for row in batch.column("block"):
                block = row.values.to_numpy(zero_copy_only=False)
                found = block if found is None else merge(found, block)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], arrow[0].type)], schema=arrow)

    for parts in (int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), FACTORS):
        blocks = blocks.repartition(parts).mapInArrow(run, T.StructType(BLOCK))
    rows = [np.array(r["block"]) for r in blocks.collect()]
    return reduce(merge, rows) if rows else None


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Directions of largest variance of all rows that take part (``vectors``).

    Entries c count as x = floor(64 c) + 1000000. Directions are numbered by
    falling variance; of equal variances any orthonormal ones are taken, each
    with its largest entry positive. Directions without variance beyond
    rounding are left out: a single row, equal rows and no rows have none.
    """
    size = dimension(df, vector)
    n, sums, largest = _totals(df, vector, size) if size else (0, (), 0)

    def triangle(rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(rows, mode="r")

    def make():
        factor = np.zeros((0, size))

        def add(batch):
            nonlocal factor
            for _, entries in matrices(batch, vector, size):
                factor = triangle(np.vstack([factor, _centred(_numbers(entries), n, sums, largest)]))

        def finish():
            if len(factor):
                yield [[factor.ravel()]]
        return add, finish

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return triangle(np.vstack([a.reshape(-1, size), b.reshape(-1, size)])).ravel()

    found = _merged(partial_rows(df, [vector], BLOCK, make), merge) if n else None
    if found is None:
        return Whitening(size, 0, sums, 0, np.zeros((0, size)), np.zeros(0), 0.0)
    factor = np.zeros((size, size))
    rows = found.reshape(-1, size)
    factor[:len(rows)] = rows
    values, vectors = singular(factor)
    kept = int(np.count_nonzero(values[:components] > NOISE * values[0]))
    directions = vectors[:, :kept].T
    signs = np.sign(directions[np.arange(kept), np.abs(directions).argmax(axis=1)])
    return Whitening(size, n, sums, largest, directions * signs[:, None], values[:kept] / n, float((factor ** 2).sum() / n))


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums, model.largest) @ (model.directions.T / np.sqrt(model.variances))


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Rows that take part, with ``whitened`` (one number a component) and ``deviation``.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact up to 38
    digits, null beyond. Output columns replace input columns of those names.
    """
    made = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", EXACT)]
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("whitened", "deviation")]
    hidden = unused("_vector", df)
    schema = T.StructType([df.schema[c] for c in keep] + made)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part, entries in matrices(batch, hidden, model.size):
                x = _numbers(entries)
                moved = _moved(x, model.n, model.sums, model.largest)
                moved = exact(moved, model.size * (1 + int(np.abs(moved).max(initial=0))) ** 2)
                yield pa.RecordBatch.from_arrays([*(part.column(c).cast(arrow.field(c).type) for c in keep),
                                                  pa.array(list(_projected(x, model)), arrow.field("whitened").type),
                                                  exact_column((moved ** 2).sum(axis=1))], schema=arrow)

    rows = df.select(*keep, F.col(vector).alias(hidden))
    return (rows if model.n else rows.limit(0)).mapInArrow(run, schema)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows.

    Each block of rows is centred on its own mean, and moments are merged with
    the difference of the means. 0 without components.
    """
    k = len(model.variances)

    def make():
        state = np.zeros(1 + k + k * k)

        def add(batch):
            nonlocal state
            for _, entries in matrices(batch, vector, model.size):
                if len(entries):
                    z = _projected(_numbers(entries), model)
                    mean = z.mean(axis=0)
                    state = merge(state, np.concatenate([[len(z)], mean, ((z - mean).T @ (z - mean)).ravel()]))

        def finish():
            if state[0]:
                yield [[state]]
        return add, finish

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = a[0] + b[0]
        apart = b[1:1 + k] - a[1:1 + k]
        products = a[1 + k:] + b[1 + k:] + np.outer(apart, apart).ravel() * (a[0] * b[0] / n)
        return np.concatenate([[n], a[1:1 + k] + apart * (b[0] / n), products])

    found = _merged(partial_rows(df, [vector], BLOCK, make), merge) if k else None
    if found is None:
        return 0.0
    return float(np.abs(found[1 + k:].reshape(k, k) / found[0] - np.eye(k)).max())
