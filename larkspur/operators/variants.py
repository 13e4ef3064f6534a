"""JSON text columns with VARIANT companions."""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUFFIX = "_variant"
#: A number of 19 or 20 digits that may pass 2**63 - 1: a cheap superset of what the guard rewrites.
WIDE = r"(?:9[0-9]{18}|1[0-9]{19})"


def protected(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """Columns that collide with a companion's name, in any case."""
    taken = {(n + SUFFIX).lower() for n in names}
    return [c for c in columns if c.lower() in taken]


def companion(c: Column, guard: bool = False) -> Column:
    """The parsed value; null where the text is no JSON."""
    return F.try_parse_json(widen_guard(c) if guard else c)


def widen_guard(c: Column) -> Column:
    """Text with integers between 2**63 and 2**64 - 1 outside strings written as strings.

    Only rows that the pattern flags leave the JVM.
    """

    @F.pandas_udf("string")
    def rewrite(s: pd.Series) -> pd.Series:
        import json

        def walk(v):
            if isinstance(v, dict):
                return {k: walk(x) for k, x in v.items()}
            if isinstance(v, list):
                return [walk(x) for x in v]
            if isinstance(v, int) and not isinstance(v, bool) and (1 << 63) <= v < (1 << 64):
                return str(v)
            return v

        def one(t):
            if t is None:
                return None
            try:
                return json.dumps(walk(json.loads(t)), separators=(",", ":"), ensure_ascii=False)
            except ValueError:
                return t

        return s.map(one)

    flagged = F.coalesce(c.rlike(WIDE), F.lit(False))
    return F.when(flagged, rewrite(F.when(flagged, c))).otherwise(c)


def dual_write(df: DataFrame, names: Sequence[str], guard: bool = False) -> DataFrame:
    """``df`` with a companion per named text column; colliding payload columns go first."""
    df = df.drop(*protected(df.columns, names))
    return df.withColumns({n + SUFFIX: companion(F.col(n), guard) for n in names if n in df.columns})


def declared(c: Column, on_invalid: str = "null") -> Column:
    """A declared VARIANT column: the empty text is null, invalid text is null or fails."""
    text = F.when(c != "", c)
    if on_invalid not in ("null", "raise"):
        raise ValueError(f"on_invalid is null or raise, not {on_invalid!r}")
    return F.try_parse_json(text) if on_invalid == "null" else F.parse_json(text)


def outcomes(df: DataFrame, name: str) -> DataFrame:
    """One row: ``encoded, sql_null, variant_null, invalid`` of a text column."""
    c, v = F.col(name), F.try_parse_json(F.when(F.col(name) != "", F.col(name)))
    return df.agg(
        F.count_if(v.isNotNull()).alias("encoded"),
        F.count_if(c.isNull() | (c == "")).alias("sql_null"),
        F.count_if(F.coalesce(F.is_variant_null(v), F.lit(False))).alias("variant_null"),
        F.count_if(c.isNotNull() & (c != "") & v.isNull()).alias("invalid"),
    )


def path_outcomes(df: DataFrame, name: str, path: str, kind: str) -> DataFrame:
    """One row: rows whose leaf is ``typed``, of another type (``fallback``), variant null or absent."""
    leaf = F.try_variant_get(F.try_parse_json(name), path, "variant")
    null = F.coalesce(F.is_variant_null(leaf), F.lit(False))
    fits = F.try_variant_get(leaf, "$", kind).isNotNull() & (F.schema_of_variant(leaf) == kind.upper())
    return df.agg(
        F.count_if(fits).alias("typed"),
        F.count_if(leaf.isNotNull() & ~null & ~F.coalesce(fits, F.lit(False))).alias("fallback"),
        F.count_if(null).alias("variant_null"),
        F.count_if(leaf.isNull()).alias("absent"),
    )


def first_invalid(df: DataFrame, name: str, show: Sequence[str]) -> DataFrame:
    c = F.col(name)
    return df.where(c.isNotNull() & (c != "") & F.try_parse_json(c).isNull()).select(*show).limit(1)
