"""Schema inference over heterogeneous JSON records.

All keys of all records become columns.  A key's type is that of its first
non-null value in arrival order; objects and arrays become compact JSON text, and
a column with values of another type becomes text as a whole.  Two passes: one
aggregate finds keys and types, one projection builds the columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Key:
    name: str
    kind: str  # boolean, long, double or string
    mixed: bool


#: Stands before NaN, Infinity and -Infinity in the texts that they travel as; a private-use character.
MARK = "\ue000"
#: Such a literal with all before it, from where the last one ended: strings are passed over whole.
_LITERAL = r'\G((?:[^"NI\-]++|"(?:[^"\\]++|\\.)*+"|-(?!Infinity))*+)(NaN|-?Infinity)'


def quote_non_finite(text: Column) -> Column:
    """JSON text whose NaN, Infinity and -Infinity outside of strings have become marked strings."""
    some = text.contains("NaN") | text.contains("Infinity")
    return F.when(some, F.regexp_replace(text, _LITERAL, f'$1"{MARK}$2"')).otherwise(text)


def parse(rows: DataFrame, value: str = "value", non_finite: bool = False) -> DataFrame:
    """``rows`` with ``rec VARIANT``: the record, or null where the value is no JSON object.

    NaN, Infinity and -Infinity are no JSON; with ``non_finite`` they count as numbers.
    """
    text = F.col(value).cast("string")
    text = quote_non_finite(text) if non_finite else text
    # the parser stops at the end of the first value, so what follows an object must be blank
    v = F.when(text.rlike(r"^\s*\{(?s:.*)\}\s*$"), F.try_parse_json(text))
    # what parses and stands in braces is an object
    return rows.withColumn("rec", v)


def _kind(schema: Column) -> Column:
    return (
        F.when(schema == "VOID", None)
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "BIGINT", "long")
        .when(schema.rlike(r"^(?:DOUBLE|FLOAT|DECIMAL)"), "double")
        .otherwise("string")
    )


def key_stats(parsed: DataFrame, seq: str) -> DataFrame:
    """One row per key: ``key, first_seq, kind, mixed`` (kind null where every value is null)."""
    pairs = parsed.where(F.col("rec").isNotNull()).select(seq, "rec").lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("rec").outer())
    ).select(seq, "pos", "key", F.expr("schema_of_variant(value)").alias("s"), F.expr("to_json(value)").alias("j"))
    # integers beyond 64 bits come as decimals without a fraction; they are no floats
    kind = F.when(F.col("s").startswith("DECIMAL") & F.col("j").rlike("^-?[0-9]{19,}$"), "string").when(F.col("j").startswith(f'"{MARK}'), "double").otherwise(_kind(F.col("s")))
    typed = pairs.withColumn("kind", kind)
    return typed.groupBy("key").agg(
        F.min(F.struct(seq, "pos")).alias("first"),
        F.min(F.when(F.col("kind").isNotNull(), F.struct(seq, "kind"))).alias("k"),
        F.collect_set("kind").alias("kinds"),
    ).select("key", F.col("first").alias("first_seq"), F.col("k.kind").alias("kind"), "kinds")


def infer(parsed: DataFrame, seq: str) -> list[Key]:
    """Keys in first-seen order.  The driver holds one small row per column of the result."""
    rows = key_stats(parsed, seq).orderBy("first_seq", "key").collect()
    out = []
    for r in rows:
        kind = r["kind"] or "string"
        others = set(r["kinds"]) - {kind}
        if kind == "double":
            others -= {"long", "boolean"}  # whole numbers and flags in a float column become floats
        out.append(Key(r["key"], kind, bool(others)))
    return out


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _field(rec: Column, name: str) -> Column:
    path = '$["' + name.replace("\\", "\\\\").replace('"', '\\"') + '"]'
    return F.try_variant_get(rec, path, "variant")


def python_text(v: Column) -> Column:
    """Text of a variant value as ``str()`` spells it: True, 1.5; nested values as JSON."""
    kind = F.schema_of_variant(v)
    text = F.to_json(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), None)
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(is_marked(v), F.replace(F.lower(unmarked(v)), F.lit("infinity"), F.lit("inf")))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string"))
        .when(kind.rlike("^(?:DOUBLE|FLOAT|DECIMAL)"), float_text(F.try_variant_get(v, "$", "double")))
        .otherwise(nested_text(v))
    )


def is_marked(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "string").startswith(MARK), F.lit(False))


def unmarked(v: Column) -> Column:
    return F.substring(F.try_variant_get(v, "$", "string"), 2, 10)


def nested_text(v: Column) -> Column:
    """JSON text; what is not finite inside of it is null, as JSON has no other word for it."""
    return F.regexp_replace(F.to_json(v), f'"{MARK}(?:NaN|-?Infinity)"', "null")


def float_text(c: Column) -> Column:
    """Shortest decimal of a double: 2.0, 1e+20, 1e-05."""
    s = c.cast("string")
    exact = F.regexp_extract(s, r"^(-?[0-9.]+?)(?:\.0)?E(-?)([0-9]+)$", 1)
    sign = F.when(F.regexp_extract(s, r"E(-?)", 1) == "-", "-").otherwise("+")
    digits = F.lpad(F.regexp_extract(s, r"E-?([0-9]+)$", 1), 2, "0")
    plain = (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    fixed = F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"0+$", "")
    return F.when(~s.contains("E"), s).when(plain, F.regexp_replace(fixed, r"\.$", ".0")).otherwise(F.concat(exact, F.lit("e"), sign, digits))


def build(parsed: DataFrame, keys: Sequence[Key], json_text: Sequence[str] = ()) -> DataFrame:
    """The typed columns of the parsed records, after all columns but ``rec``.

    Columns in ``json_text`` hold every value as JSON text, strings as they are.
    A record is parsed once a row: it is the one element of an array that the
    columns are made from.
    """

    def typed(k: Key, v: Column) -> Column:
        if k.name in json_text or k.kind == "string" and not k.mixed:
            kind = F.schema_of_variant(v)
            return F.when(is_marked(v), unmarked(v)).when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind != "VOID", nested_text(v))
        if k.mixed:
            return python_text(v)
        if k.kind == "double":
            flag = F.schema_of_variant(v) == "BOOLEAN"
            return F.when(flag, F.try_variant_get(v, "$", "boolean").cast("double")).when(is_marked(v), unmarked(v).try_cast("double")).otherwise(F.try_variant_get(v, "$", "double"))
        return F.try_variant_get(v, "$", "bigint" if k.kind == "long" else k.kind)

    def record(rec: Column) -> Column:
        def column(k: Key) -> Column:
            return _once(_field(rec, k.name), lambda v: typed(k, v)).alias(k.name)

        return F.struct(*map(column, keys))

    kept = [F.col(c) for c in parsed.columns if c != "rec" and c not in {k.name for k in keys}]
    if not keys:
        return parsed.where(F.col("rec").isNotNull()).select(*kept)
    one = F.filter(F.array("rec"), lambda r: r.isNotNull())
    return parsed.select(*kept, F.inline(F.transform(one, record)))


def convert(rows: DataFrame, seq: str, value: str = "value", json_text: Sequence[str] = (), non_finite: bool = False) -> DataFrame:
    """Parses, infers and builds; rows that are no JSON object are left out."""
    parsed = parse(rows, value, non_finite)
    return build(parsed, infer(parsed, seq), json_text).drop(value)


def skipped(rows: DataFrame, value: str = "value") -> DataFrame:
    """One row: ``json_parse``, the values that are there but are no JSON object."""
    p = parse(rows, value)
    return p.agg(F.count_if(F.col(value).isNotNull() & F.col("rec").isNull()).alias("json_parse"))


def normalize(df: DataFrame) -> DataFrame:
    """Integers as long, floats as double; columns without a type go."""
    out = []
    for f in df.schema:
        t = f.dataType.typeName()
        if t == "void":
            continue
        c = F.col(f"`{f.name}`")
        out.append(c.cast("bigint").alias(f.name) if t in ("byte", "short", "integer") else c.cast("double").alias(f.name) if t == "float" else c)
    return df.select(*out)
