"""Widening-only schema evolution, and lining batches up with a table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import to_uuid, uuid_text

SAFE = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")
STAMP = "_inserted_at"
RESERVED = {"calendar": {STAMP, "year", "month", "day", "hour"}, "transform": {STAMP}}
LONGEST = 128
SYSTEM_PREFIX = "_sys"
#: What a live column may become.
WIDER = {("integer", "long"), ("short", "long"), ("byte", "long"), ("long", "double"), ("integer", "double"), ("float", "double")}
PROMOTIONS = {("integer", "long"), ("float", "double")}


def check_reserved(columns: Sequence[str], layout: str) -> None:
    bad = sorted({c for c in columns if c.lower() in RESERVED[layout]})
    if bad:
        raise ValueError(f"reserved column names: {', '.join(bad)}")


def writable(name: str) -> bool:
    return bool(SAFE.fullmatch(name)) and len(name) <= LONGEST and not name.lower().startswith(SYSTEM_PREFIX)


def drop_unwritable(df: DataFrame) -> tuple[DataFrame, list[str]]:
    bad = [c for c in df.columns if not writable(c)]
    return df.drop(*bad), bad


def drop_live_variants(df: DataFrame, live: T.StructType) -> tuple[DataFrame, list[str]]:
    """``df`` without payload columns that are VARIANT in the table; companions, which are VARIANT themselves, stay."""
    kinds = {f.name.lower(): f.dataType for f in live}
    bad = [f.name for f in df.schema if isinstance(kinds.get(f.name.lower()), T.VariantType) and not isinstance(f.dataType, T.VariantType)]
    return df.drop(*bad), bad


def drop_companions(df: DataFrame, live: T.StructType) -> tuple[DataFrame, list[str]]:
    """``df`` without VARIANT columns that the table has as another type: their text alone is written."""
    kinds = {f.name.lower(): f.dataType for f in live}
    bad = [f.name for f in df.schema if isinstance(f.dataType, T.VariantType) and not isinstance(kinds.get(f.name.lower(), f.dataType), T.VariantType)]
    return df.drop(*bad), bad


def storable(kind: T.DataType) -> bool:
    """Whether a file can hold the type, at any depth."""
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(storable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return storable(kind.keyType) and storable(kind.valueType)
    return not isinstance(kind, (T.NullType, T.CalendarIntervalType))


def check_nullable_variants(schema: T.StructType) -> None:
    """A VARIANT column has to take nulls, as invalid texts become null."""
    bad = [f.name for f in schema if isinstance(f.dataType, T.VariantType) and not f.nullable]
    if bad:
        raise ValueError(f"VARIANT columns that refuse nulls: {', '.join(bad)}")


def plan(live: T.StructType, batch: T.StructType, allowed=WIDER) -> tuple[T.StructType, list[str], list[str], list[str]]:
    """(evolved schema, added, widened, skipped) names; a change that only narrows is skipped.

    New columns are judged one by one: unsafe names and types that no file can hold
    are skipped and leave the others alone.  Names are compared without case.
    """
    fields = {f.name.lower(): f for f in live}
    added, widened, skipped = [], [], []
    for f in batch:
        have = fields.get(f.name.lower())
        kind = f.dataType.typeName()
        if have is None:
            if not SAFE.fullmatch(f.name) or not storable(f.dataType):
                skipped.append(f.name)
                continue
            fields[f.name.lower()] = T.StructField(f.name, f.dataType, True, f.metadata)
            added.append(f.name)
        elif have.dataType != f.dataType:
            if (have.dataType.typeName(), kind) in allowed:
                fields[f.name.lower()] = T.StructField(have.name, f.dataType, True, have.metadata)
                widened.append(have.name)
            elif have.dataType.typeName() != "string" and have.metadata.get("logical") != "uuid" and (kind, have.dataType.typeName()) not in allowed:
                skipped.append(f.name)
    return T.StructType(list(fields.values())), added, widened, skipped


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` as ``target``: its columns in order, cast, with typed nulls for what is missing.

    A uuid column and a text column turn into each other, whichever is live.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in target:
        name = have.get(f.name.lower())
        if name is None:
            c = F.lit(None).cast(f.dataType)
        else:
            src = df.schema[name]
            c = F.col(f"`{name}`")
            if f.metadata.get("logical") == "uuid" and src.metadata.get("logical") != "uuid":
                c = uuid_text(c) if isinstance(src.dataType, T.BinaryType) else to_uuid(c.cast("string"))
            elif src.dataType != f.dataType:
                c = c.try_cast(f.dataType)
        out.append(c.alias(f.name, metadata=f.metadata) if f.metadata else c.alias(f.name))
    return df.select(*out)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Batches one below the other with nulls for missing columns; a type conflict raises."""
    seen: dict[str, tuple[str, T.DataType]] = {}
    for df in frames:
        for f in df.schema:
            name, kind = seen.setdefault(f.name, (f.name, f.dataType))
            if kind != f.dataType:
                raise TypeError(f"column {f.name!r} is {kind.simpleString()} in one batch and {f.dataType.simpleString()} in another")
    out = frames[0].select("*")
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def stamp(df: DataFrame) -> DataFrame:
    """``df`` with one time of insertion for all rows."""
    return df.withColumn(STAMP, F.current_timestamp())


