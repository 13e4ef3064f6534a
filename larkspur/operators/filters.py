"""Allowlist (fails closed), denylist (fails open), and what they count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import UUID_CANONICAL, UUID_HEX

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_LIMITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _canonical(v: object) -> str | None:
    import re

    s = str(v)
    if not (re.match(UUID_HEX, s) or re.match(UUID_CANONICAL, s)):
        return None
    h = s.removeprefix("urn:uuid:").strip("{}").replace("-", "").lower()
    return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))


def member_of(df: DataFrame, field: str, values: Sequence[int | str]) -> tuple[Column | None, str | None]:
    """(condition, None), or (None, reason) where the filter cannot be decided.

    The values are converted to the column's type, never the column to theirs.
    """
    if field not in df.columns:
        return None, "filter_field_missing"
    f = df.schema[field]
    if f.metadata.get("logical") == "uuid":
        good = [c for c in map(_canonical, values) if c]
        return (F.col(field).isin(good), None) if good else (None, "filter_value_invalid")
    if isinstance(f.dataType, T.StringType):
        return F.col(field).isin([str(v) for v in values]), None
    if isinstance(f.dataType, _WHOLE):
        top = 1 << _LIMITS[type(f.dataType)]
        try:
            whole = [int(v) for v in values]
        except ValueError:
            return None, "filter_field_missing"
        if not all(-top <= v < top for v in whole):
            return None, "filter_field_missing"
        return F.col(field).isin([F.lit(v).cast(f.dataType) for v in whole]), None
    return None, "filter_field_missing"


def keep(df: DataFrame, field: str, values: Sequence[int | str]) -> DataFrame:
    """Rows whose ``field`` is one of ``values``; none at all where that cannot be decided."""
    cond, reason = member_of(df, field, values)
    return df.where(F.lit(False)) if reason else df.where(F.coalesce(cond, F.lit(False)))


def drop(df: DataFrame, field: str, values: Sequence[int | str]) -> DataFrame:
    """Rows whose ``field`` is none of ``values``; nulls stay, and everything where it cannot be decided."""
    cond, reason = member_of(df, field, values)
    return df if reason else df.where(~F.coalesce(cond, F.lit(False)))


KEEP_REASONS = ("filter_field_missing", "filter_excluded", "filter_value_invalid")


def keep_reasons(df: DataFrame, field: str, values: Sequence[int | str]) -> dict[str, Column]:
    """Aggregates that count, by reason, what :func:`keep` leaves out."""
    cond, reason = member_of(df, field, values)
    none = F.count_if(F.lit(False))
    if reason:
        return {r: F.count("*") if r == reason else none for r in KEEP_REASONS}
    return dict(zip(KEEP_REASONS, (F.count_if(F.col(field).isNull()), F.count_if(~cond), none)))


def keep_counts(df: DataFrame, field: str, values: Sequence[int | str]) -> DataFrame:
    """One row: ``total, kept, filter_field_missing, filter_excluded, filter_value_invalid``, in one pass."""
    cond, reason = member_of(df, field, values)
    kept = F.count_if(F.lit(False) if reason else cond)
    return df.agg(F.count("*").alias("total"), kept.alias("kept"), *[c.alias(r) for r, c in keep_reasons(df, field, values).items()])


def dropped(df: DataFrame, field: str, values: Sequence[int | str]) -> Column:
    """Aggregate that counts what :func:`drop` leaves out."""
    cond, reason = member_of(df, field, values)
    return F.count_if(F.lit(False) if reason else F.coalesce(cond, F.lit(False)))


def drop_count(df: DataFrame, field: str, values: Sequence[int | str]) -> DataFrame:
    return df.agg(dropped(df, field, values).alias("filter_dropped"))


def matched_counts(df: DataFrame, field: str, values: Sequence[int | str]) -> DataFrame:
    """Kept rows per value."""
    return keep(df, field, values).groupBy(field).agg(F.count("*").alias("matched"))
