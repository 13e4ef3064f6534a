"""Partition specs: grammar, transforms, fanout, and groups that cannot be placed."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import transforms

KINDS = ("identity", "year", "month", "day", "hour", "bucket")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Field:
    kind: str
    column: str
    buckets: int | None = None

    @property
    def name(self) -> str:
        return self.column if self.kind == "identity" else f"{self.column}_{self.kind}"

    def value(self, kind: str = "bigint") -> Column:
        c = F.col(self.column)
        if self.kind == "identity":
            return c
        if self.kind == "bucket":
            return transforms.bucket_text(c, self.buckets) if kind == "string" else transforms.bucket(c, self.buckets)
        return getattr(transforms, self.kind)(c)


def parse_spec(text: str) -> tuple[Field, ...]:
    """``col``, ``kind(col)`` and ``bucket(col, n)``, separated by commas outside parentheses."""
    parts = [p.strip() for p in re.findall(r"[^,(]+(?:\([^)]*\))?", text)]
    if not text.strip() or ",".join(parts).replace(" ", "") != text.replace(" ", ""):
        raise ValueError(f"malformed partition spec {text!r}")
    out = []
    for p in parts:
        m = re.fullmatch(r"(\w+)\s*\(\s*(\w+)\s*(?:,\s*(-?\d+)\s*)?\)|(\w+)", p)
        if not m:
            raise ValueError(f"malformed partition field {p!r}")
        kind, column, n = (m[1].lower(), m[2], m[3]) if m[1] else ("identity", m[4], None)
        if kind not in KINDS or not _NAME.fullmatch(column):
            raise ValueError(f"unknown partition field {p!r}")
        if (kind == "bucket") != (n is not None) or (n is not None and int(n) <= 0):
            raise ValueError(f"bucket takes a positive count, others none: {p!r}")
        out.append(Field(kind, column, int(n) if n else None))
    if len({f.name for f in out}) < len(out):
        raise ValueError(f"repeated partition field in {text!r}")
    return tuple(out)


def with_values(df: DataFrame, spec: tuple[Field, ...], prefix: str = "p_") -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({prefix + f.name: f.value(kinds[f.column]) for f in spec})


def fanout(df: DataFrame, spec: tuple[Field, ...], seq: str) -> DataFrame:
    """One row per partition tuple (null is a value of its own): ``p_*, rows, first_seen``."""
    names = ["p_" + f.name for f in spec]
    return with_values(df, spec).groupBy(*names).agg(F.count("*").alias("rows"), F.min(seq).alias("first_seen"))


def placeable(c: Column) -> Column:
    """Whether a text is a canonical non-negative 63-bit number, as an object prefix must be."""
    return F.coalesce(c.rlike("^(?:0|[1-9][0-9]{0,18})$") & c.try_cast("bigint").isNotNull(), F.lit(False))


def skipped_prefixes(df: DataFrame, prefix: str) -> DataFrame:
    """One row: ``groups, rows`` of the prefix values that cannot be placed."""
    groups = df.groupBy(F.col(prefix).cast("string").alias("v")).agg(F.count("*").alias("n")).where(~placeable(F.col("v")))
    return groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def folder_name(value: Column) -> Column:
    """A text that names a partition's folder: never empty, never too long, and another one for every value.

    Values that are empty or begin with ``_`` or ``~`` get a ``_`` in front; of those
    over 120 bytes the hash stands behind ``~``.  Null stays null.
    """
    v = value.cast("string")
    odd = (v == "") | v.startswith("_") | v.startswith("~")
    return F.when(F.octet_length(v) > 120, F.concat(F.lit("~"), F.sha2(v.cast("binary"), 256))).when(odd, F.concat(F.lit("_"), v)).otherwise(v)


def write_layout(df: DataFrame, spec: tuple[Field, ...], keys: list[Column] | None = None) -> DataFrame:
    """Deals rows by partition tuple, so a task's open files are its own partitions', sorted for the writer.

    ``rebalance`` lets adaptive execution split a tuple that holds much of the data.
    """
    names = ["p_" + f.name for f in spec]
    out = with_values(df, spec)
    if names:
        out = out.withColumns({n: folder_name(F.col(n)) for n in names})
        out = out.hint("rebalance", *[F.col(n) for n in names])
        out = out.sortWithinPartitions(*[F.col(n).asc_nulls_last() for n in names], *(keys or []))
    elif keys:
        out = out.sortWithinPartitions(*keys)
    return out
