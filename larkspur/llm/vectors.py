"""Reading vector columns: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null or empty, has a component other than zero, and only finite ones.

    The vector is returned as ``vec array<double>`` in place of ``column``.
    """
    v = F.col(column).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = rows.withColumn("vec", v).drop(column)
    return out.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(~bad & F.exists("vec", lambda x: x != 0.0))


def matrix(column) -> np.ndarray:
    """An Arrow list column without nulls, all of one length, as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64, copy=False)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest component first keeps extreme values finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
