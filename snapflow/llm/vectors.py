"""Vector columns: usable rows, their dimension, and rows as matrices inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column, limit: float) -> Column:
    """Whether a vector is there and all its entries are numbers of less than ``limit`` in size."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(limit), F.lit(False)))


def usable(table: DataFrame, id_col: str, vector_col: str, limit: float) -> DataFrame:
    """``vec_id, vector`` of the rows whose vector is finite and has the table's dimension: the most
    frequent length above zero, of equally frequent ones the greatest."""
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[vector_col].alias("vector"))
    rows = rows.filter(finite(F.col("vector"), limit) & (F.size("vector") > 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vector") == F.lit(top["d"] if top else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as the rows of a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def blocks(batches, rows: int = 4096):
    """(ids, matrix) of parts of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column("vec_id"), matrix(part.column("vector"))
