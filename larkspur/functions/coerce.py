"""Type pinning: casts that never fail.  What cannot be converted becomes null.

Spark's own casts accept more than wanted (surrounding blanks, ``1d``, ``t``, zone
suffixes, bare times), so text goes through a pattern first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted texts.
INTEGER = r"^-?[0-9]+$"
HEX_INTEGER = r"^0[xX][0-9A-Fa-f]{1,16}$"
REAL = r"^[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))$"
BOOLEAN = r"^(?i:true|false|0|1)$"
NAIVE_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?)?$"
UUID_HEX = r"^(?:urn:uuid:)?[0-9A-Fa-f]{32}$|^\{[0-9A-Fa-f]{32}\}$"
UUID_CANONICAL = (
    r"^(?:urn:uuid:)?[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    r"|^\{[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\}$"
)
TYPES = ("timestamptz", "bigint", "double", "boolean", "varchar", "uuid")
UUID = {"logical": "uuid"}


def hyphenate(hex32: Column) -> Column:
    """Canonical spelling of 32 hexadecimal digits."""
    return F.regexp_replace(F.lower(hex32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def to_uuid(c: Column) -> Column:
    """Canonical lower-case uuid text, or null."""
    digits = F.regexp_replace(F.regexp_replace(c, "^urn:uuid:", ""), "[-{}]", "")
    return F.when(c.rlike(UUID_HEX) | c.rlike(UUID_CANONICAL), hyphenate(digits))


def uuid_text(c: Column) -> Column:
    """Canonical text of 16 bytes; null for any other length."""
    return F.when(F.octet_length(c) == 16, hyphenate(F.hex(c)))


def to_bigint(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        plain = F.when(c.rlike(INTEGER), c.try_cast("bigint"))
        hexed = F.when(c.rlike(HEX_INTEGER), F.conv(F.substring(c, 3, 16), 16, -10).try_cast("bigint"))
        return F.coalesce(plain, hexed)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = c == F.floor(c)
        if not isinstance(kind, T.DecimalType):
            whole = whole & ~F.isnan(c) & (F.abs(c) != float("inf"))
        return F.when(whole, c.try_cast("bigint"))
    return c.try_cast("bigint")


def to_double(c: Column, kind: T.DataType) -> Column:
    return F.when(c.rlike(REAL), c.try_cast("double")) if isinstance(kind, T.StringType) else c.try_cast("double")


def to_boolean(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.when(c.rlike(BOOLEAN), F.lower(c).isin("true", "1"))
    return c.try_cast("boolean")


def to_varchar(c: Column, kind: T.DataType) -> Column:
    """Text; whole doubles without a fraction, exponents as ``1e+20``."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        s = F.regexp_replace(c.cast("string"), r"\.0$", "")
        s = F.regexp_replace(s, r"^(-?[0-9]+)(?:\.0)?E([0-9]+)$", "$1e+$2")
        s = F.regexp_replace(s, r"^(-?[0-9.]+)E([0-9]+)$", "$1e+$2")
        s = F.regexp_replace(s, r"^(-?[0-9]+)(?:\.0)?E-([0-9]+)$", "$1e-$2")
        return F.when(F.isnan(c), "nan").when(F.abs(c) == float("inf"), F.when(c > 0, "inf").otherwise("-inf")).otherwise(s)
    return c.cast("string")


def to_timestamptz(c: Column, kind: T.DataType) -> Column:
    """Naive ISO text read as UTC; text with a zone is null; numbers are microseconds since 1970."""
    if isinstance(kind, T.StringType):
        full = F.when(c.rlike(r"[ T][0-9]{2}$"), F.concat(c, F.lit(":00"))).otherwise(c)
        return F.when(c.rlike(NAIVE_TIMESTAMP), full.try_cast("timestamp"))
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.timestamp_micros(c.cast("bigint"))
    return c.try_cast("timestamp")


def _pinned(c: Column, kind: T.DataType, target: str) -> Column:
    if target == "uuid":
        return uuid_text(c) if isinstance(kind, T.BinaryType) else to_uuid(c.cast("string"))
    make = {"timestamptz": to_timestamptz, "bigint": to_bigint, "double": to_double, "boolean": to_boolean, "varchar": to_varchar}
    return make[target](c, kind)


_ALREADY = {"timestamptz": T.TimestampType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "varchar": T.StringType}


def pin(df: DataFrame, pins: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with the named columns converted; absent and already typed columns stay as they are."""
    out = {}
    for name, target in pins:
        if target not in TYPES:
            raise ValueError(f"unknown type {target!r}")
        if name not in df.columns:
            continue
        f = df.schema[name]
        if target == "uuid":
            if f.metadata.get("logical") != "uuid":
                out[name] = _pinned(F.col(name), f.dataType, target)
        elif not isinstance(f.dataType, _ALREADY[target]):
            out[name] = _pinned(F.col(name), f.dataType, target)
    df = df.withColumns(out) if out else df
    for name in (n for n, t in pins if t == "uuid" and n in out):
        df = df.withMetadata(name, UUID)
    return df


def pin_failures(df: DataFrame, pins: Sequence[tuple[str, str]]) -> DataFrame:
    """One row: per pinned column, the values that were there and became null."""
    use = [(n, t) for n, t in pins if n in df.columns]
    return df.agg(*[F.count_if(F.col(n).isNotNull() & _pinned(F.col(n), df.schema[n].dataType, t).isNull()).alias(n) for n, t in use])
