"""Stable ascending sort before a write: nulls last, NaN after numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNSORTABLE = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


def sort_keys(df: DataFrame, keys: Sequence[str]) -> tuple[list[Column], str | None]:
    """(sort columns, None), or ([], reason) where the whole sort is skipped."""
    if any(k not in df.columns for k in keys):
        return [], "field_missing"
    if any(isinstance(df.schema[k].dataType, _UNSORTABLE) for k in keys):
        return [], "unsortable_type"
    return [F.col(k).asc_nulls_last() for k in keys], None


def presort(df: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """Sorts inside each write task; ``seq`` keeps arrival order among equals."""
    cols, reason = sort_keys(df, keys)
    return df if reason or not cols else df.sortWithinPartitions(*cols, *([F.col(seq)] if seq else []))
