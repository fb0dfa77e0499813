"""Reading a column of vectors in tasks: which rows take part, and their entries as a matrix.

A row takes part if its vector is not null, has as many entries as most vectors
(the longer of equally frequent lengths; an empty vector never), and all its
entries are finite numbers below ``LIMIT``, so that their scaled floors fit a long.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LIMIT = 2.0 ** 49
ROWS = 8192  # rows whose entries one step holds as numbers
EXACT = T.DecimalType(38, 0)


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of a non-empty vector; 0 if there is none."""
    sizes = df.select(F.size(vector).alias("size")).filter("size > 0").groupBy("size").count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).head()
    return top["size"] if top else 0


def matrices(batch: pa.RecordBatch, vector: str, size: int):
    """(rows of the batch that take part, their entries as doubles), ``ROWS`` rows at a time."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        column = part.column(vector)
        rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
        entries = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
        fine = (np.abs(entries) < LIMIT).all(axis=1)  # not so for NaN, which nulls become
        yield part.take(pa.array(rows[fine])), entries[fine]


def floors(entries: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * entry), exact: the scales used are powers of two."""
    return np.floor(entries * scale).astype(np.int64)


def exact(values: np.ndarray, largest: int) -> np.ndarray:
    """``values`` as they are if ``largest``, a bound on all results, fits a long; else as Python's integers."""
    return values if largest < 1 << 62 else values.astype(object)


def exact_column(values: np.ndarray) -> pa.Array:
    """Whole numbers as an Arrow column of decimals; one of more than 38 digits is null."""
    if values.dtype != object:
        return pa.array(values).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10 ** 38 else None for v in values], pa.decimal128(38, 0))


def partial_rows(df: DataFrame, columns: list[str], fields: list[T.StructField], make: Callable) -> DataFrame:
    """Rows that each task makes of all its batches: ``make`` returns (add, finish), as in ``common.summarise``.

    ``add`` takes whole Arrow batches, ``finish`` yields lists of columns.
    """
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches):
        add, finish = make()
        for batch in batches:
            add(batch)
        for made in finish():
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                              for c, f in zip(made, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, T.StructType(fields))
