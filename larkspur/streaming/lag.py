"""Offsets: assignment, recovery of stale positions, lag, and small pure rules."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assigned(df: DataFrame, ordinal: int, replicas: int, partition: str = "partition") -> DataFrame:
    """Partitions of one replica: number modulo replicas."""
    if not 0 <= ordinal < replicas:
        raise ValueError(f"ordinal {ordinal} is not below {replicas}")
    return df.where(F.col(partition) % replicas == ordinal)


def offset_ranges(df: DataFrame) -> DataFrame:
    """First and last offset of each topic partition."""
    return df.groupBy("topic", "partition").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def recovered_offset(reset: str) -> Column:
    """Where to start: a committed offset below ``low`` moves to low (earliest) or high (latest).

    Null (no commit) and errors stay as they are.
    """
    if reset not in ("earliest", "latest"):
        raise ValueError(f"offset reset is earliest or latest, not {reset!r}")
    stale = F.col("committed").isNotNull() & F.col("error").isNull() & (F.col("committed") < F.col("low"))
    return F.when(stale, F.col("low" if reset == "earliest" else "high")).otherwise(F.col("committed"))


def start_kind(reset: str) -> Column:
    """Where a start comes from: ``recovered`` (the commit was stale), ``committed``, or ``reset`` (none, or an error)."""
    known = F.col("committed").isNotNull() & F.col("error").isNull()
    return F.when(known & (F.col("committed") < F.col("low")), "recovered").when(known, "committed").otherwise("reset")


def start_at(reset: str) -> Column:
    """The position that a reader starts from, which lag is counted from at first."""
    target = F.col("low" if reset == "earliest" else "high")
    return F.when(start_kind(reset) == "committed", F.col("committed")).otherwise(target)


def lag(reset: str) -> Column:
    """High watermark less the furthest known position; never below 0."""
    start = F.col("low" if reset == "earliest" else "high")
    at = F.coalesce(F.col("delivered"), F.col("position"), F.col("committed"), start)
    return F.greatest(F.lit(0).cast("long"), F.col("high") - at)


def adaptive_batch(most: int, fullness: Column) -> Column:
    """``max(10, int(most * (1 - fullness)))``."""
    return F.greatest(F.lit(10), (F.lit(float(most)) * (1 - fullness)).cast("int"))


def adaptive_batch_size(most: int, pending: int, limit: int) -> int:
    fullness = min(1.0, max(0.0, pending / limit)) if limit > 0 else 1.0
    return max(10, int(most * (1 - fullness)))


def consume_timeout(remaining: float) -> float:
    return min(60.0, max(0.1, remaining))


def healthy(last_poll_age: float, limit: float = 480.0) -> bool:
    return last_poll_age < limit


def flush_trigger(pending_bytes: int, records: int, elapsed: float, size: int, interval: float) -> str | None:
    """``size``, ``time`` or None."""
    if not records:
        return None
    return "size" if pending_bytes >= size else "time" if elapsed >= interval else None


def flush_due(size: int, interval: float) -> Column:
    """:func:`flush_trigger` over ``pending_bytes, records, elapsed``."""
    due = F.when(F.col("pending_bytes") >= size, "size").when(F.col("elapsed") >= interval, "time")
    return F.when(F.col("records") > 0, due)


def timeout_of(remaining: Column) -> Column:
    return F.least(F.lit(60.0), F.greatest(F.lit(0.1), remaining))


def is_healthy(last_poll_age: Column, limit: float = 480.0) -> Column:
    return last_poll_age < limit


def backoff_of(attempt: Column, base: float = 0.5, cap: float = 30.0) -> Column:
    """:func:`backoff` without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt))


def final_flush(records: int, permanent_failure: bool) -> str:
    return "none" if not records else "skip" if permanent_failure else "flush"


def backoff(attempt: int, base: float = 0.5, cap: float = 30.0, retry_after: float = 0.0, jitter: float = 0.0) -> float:
    """Exponential delay with up to a quarter of jitter, at least what the server asked for."""
    delay = min(cap, base * 2**attempt) * (1 + 0.25 * min(1.0, max(0.0, jitter)))
    return max(retry_after, min(cap, delay))


def classify(error: BaseException) -> str:
    """Label of a failure."""
    text = f"{type(error).__name__}: {error}".lower()
    if label := getattr(error, "label", None):
        return str(label)
    if "conflict" in text or "serializ" in text:
        return "commit_contention"
    return "write_retry"


def lag_histogram_bucket(value: Column, bounds: list[float]) -> Column:
    """Least bound that the value does not pass; infinity beyond the last."""
    out = F.lit(math.inf)
    for b in reversed(bounds):
        out = F.when(value <= b, F.lit(float(b))).otherwise(out)
    return out
