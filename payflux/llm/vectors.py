"""Preparation of embedding tables shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """Rows with an id and a usable vector, as (id, vec array<float or double>, *more).

    Null, empty and zero vectors, those with null or non-finite components, and
    those of another length than most take no part.
    """
    v = F.col(vector_col)
    good = (v.isNotNull() & F.col(id_col).isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("vec"), *more).where(
        F.coalesce(good, F.lit(False)))
    size = rows.groupBy(F.size("vec").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return rows.where(F.size("vec") == (size.s if size else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.empty((0, 0))
