"""Every registered query of the ingest and lake operators, with its oracle SQL.

Messages, offsets and catalog tables are derived from the given tables by the
expressions below, which mean the same in Spark SQL and in the oracle's dialect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import coerce, transforms
from .operators import evolve, filters, infer, partition, presort, variants
from .plans import maintenance, metrics
from .plans.catalog import Catalog
from .streaming import lag

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        name = f.__name__
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf_dir, *cols) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*cols)


# Texts of many shapes, by event id: good and bad values for every cast.
TEXT_INT = "CASE event_id % 8 WHEN 0 THEN cast(user_id AS string) WHEN 1 THEN concat('-', cast(event_id AS string)) WHEN 2 THEN concat(' ', cast(user_id AS string)) WHEN 3 THEN '+5' WHEN 4 THEN '1.5' WHEN 5 THEN '99999999999999999999' WHEN 6 THEN NULL ELSE concat('00', cast(user_id AS string)) END"
TEXT_REAL = "CASE event_id % 7 WHEN 0 THEN '1.25' WHEN 1 THEN concat(cast(event_id AS string), '.5') WHEN 2 THEN ' 1' WHEN 3 THEN '1d' WHEN 4 THEN '-2e3' WHEN 5 THEN NULL ELSE cast(user_id AS string) END"
TEXT_BOOL = "CASE event_id % 8 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN 't' WHEN 3 THEN 'yes' WHEN 4 THEN '1' WHEN 5 THEN '0' WHEN 6 THEN NULL ELSE 'True' END"
TEXT_TIME = "CASE event_id % 8 WHEN 0 THEN '2024-01-02 03:04:05' WHEN 1 THEN '2024-01-02T03:04:05.123456' WHEN 2 THEN '2024-01-02T03:04:05Z' WHEN 3 THEN '2024' WHEN 4 THEN '10:00' WHEN 5 THEN '2024-02-31' WHEN 6 THEN NULL ELSE concat('2024-01-0', cast(1 + event_id % 9 AS string)) END"
TEXT_UUID = "CASE event_id % 7 WHEN 0 THEN md5(cast(event_id AS string)) WHEN 1 THEN upper(md5(cast(event_id AS string))) WHEN 2 THEN concat('{', md5(cast(event_id AS string)), '}') WHEN 3 THEN concat('urn:uuid:', md5(cast(event_id AS string))) WHEN 4 THEN concat('URN:UUID:', md5(cast(event_id AS string))) WHEN 5 THEN substring(md5(cast(event_id AS string)), 1, 30) ELSE NULL END"
MAYBE_TYPE = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END"
# Messages: one in eleven is no JSON object; keys and types differ.
MESSAGE = (
    "CASE event_id % 11 WHEN 0 THEN '[1]' WHEN 1 THEN '{bad' WHEN 2 THEN concat('{\"id\":', cast(event_id AS string), '} x') "
    "WHEN 3 THEN concat('{\"id\":', cast(event_id AS string), ',\"size\":\"51-200\",\"tags\":[1,{\"a\":true}]}') "
    "WHEN 4 THEN concat('{\"id\":', cast(event_id AS string), ',\"size\":true,\"note\":null}') "
    "ELSE concat('{\"id\":', cast(event_id AS string), ',\"size\":', cast(user_id AS string), ',\"kind\":\"', event_type, '\"}') END"
)
OFFSETS = ["'events' AS topic", "cast(event_id % 8 AS int) AS partition", "cast(floor(event_id / 8) AS bigint) AS offset", "event_type"]


# filters -------------------------------------------------------------------------------


@query("SELECT event_id, user_id FROM events WHERE user_id IN (1, 2, 3, 5, 8, 13, 21, 34)")
def keep_filter_int(spark, sf_dir):
    return filters.keep(_events(spark, sf_dir, "event_id", "user_id"), "user_id", ["1", 2, 3, 5, 8, 13, 21, "34"])


@query(f"SELECT event_id, kind FROM (SELECT event_id, {MAYBE_TYPE} AS kind FROM events) WHERE kind IN ('click', 'view')")
def keep_filter_str(spark, sf_dir):
    return filters.keep(_events(spark, sf_dir, "event_id", f"{MAYBE_TYPE} AS kind"), "kind", ["click", "view"])


@query(
    f"SELECT count(*) AS total, count(*) FILTER (kind IN ('click', 'view')) AS kept, count(*) FILTER (kind IS NULL) AS filter_field_missing, "
    f"count(*) FILTER (kind NOT IN ('click', 'view')) AS filter_excluded, 0::BIGINT AS filter_value_invalid FROM (SELECT {MAYBE_TYPE} AS kind FROM events)"
)
def keep_skip_counts(spark, sf_dir):
    return filters.keep_counts(_events(spark, sf_dir, f"{MAYBE_TYPE} AS kind"), "kind", ["click", "view"])


@query("SELECT event_id FROM events WHERE event_id IN (7) AND try_cast('x' AS BIGINT) IS NOT NULL")
def keep_filter_fails_closed(spark, sf_dir):
    """Values that no integer column can hold: nothing passes."""
    return filters.keep(_events(spark, sf_dir, "event_id"), "event_id", ["7", "x"])


@query(f"SELECT event_id, kind FROM (SELECT event_id, {MAYBE_TYPE} AS kind FROM events) WHERE kind IS NULL OR kind NOT IN ('error')")
def drop_filter(spark, sf_dir):
    return filters.drop(_events(spark, sf_dir, "event_id", f"{MAYBE_TYPE} AS kind"), "kind", ["error"])


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'error') AND user_id NOT IN (1, 2, 3)")
def keep_and_drop(spark, sf_dir):
    kept = filters.keep(_events(spark, sf_dir, "event_id", "user_id", "event_type"), "event_type", ["click", "error"])
    return filters.drop(kept, "user_id", [1, 2, 3])


@query("SELECT count(*) AS filter_dropped FROM events WHERE event_type = 'error'")
def drop_counts(spark, sf_dir):
    return filters.drop_count(_events(spark, sf_dir, "event_type"), "event_type", ["error"])


@query("SELECT event_type, count(*) AS matched FROM events WHERE event_type IN ('click', 'view', 'none') GROUP BY event_type")
def filter_matched_counts(spark, sf_dir):
    return filters.matched_counts(_events(spark, sf_dir, "event_type"), "event_type", ["click", "view", "none"])


@query("SELECT event_id, md5(cast(event_id AS string)) AS h FROM events WHERE event_id IN (1, 2)")
def uuid_membership(spark, sf_dir):
    df = coerce.pin(_events(spark, sf_dir, "event_id", "md5(cast(event_id AS string)) AS h"), [("h", "uuid")])
    kept = filters.keep(df, "h", ["c4ca4238a0b923820dcc509a6f75849b", "{C81E728D9D4C2F636F067F89CC14862C}", "none"])
    return kept.select("event_id", F.regexp_replace("h", "-", "").alias("h"))


# casts ---------------------------------------------------------------------------------


@query(f"SELECT event_id, CASE WHEN regexp_matches(x, '^-?[0-9]+$') THEN try_cast(x AS BIGINT) END AS v FROM (SELECT event_id, {TEXT_INT} AS x FROM events)")
def coerce_bigint(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", f"{TEXT_INT} AS v"), [("v", "bigint")])


@query("SELECT event_id, CASE WHEN value = floor(value) THEN cast(value AS BIGINT) END AS v FROM events")
def coerce_bigint_from_double(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", "value AS v"), [("v", "bigint")])


@query(f"SELECT event_id, CASE WHEN regexp_matches(x, '^[+-]?[0-9]+[.]?[0-9]*(e[0-9]+)?$') THEN try_cast(x AS DOUBLE) END AS v FROM (SELECT event_id, {TEXT_REAL} AS x FROM events)")
def coerce_double(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", f"{TEXT_REAL} AS v"), [("v", "double")])


@query(f"SELECT event_id, CASE WHEN lower(x) IN ('true', '1') THEN true WHEN lower(x) IN ('false', '0') THEN false END AS v FROM (SELECT event_id, {TEXT_BOOL} AS x FROM events)")
def coerce_boolean(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", f"{TEXT_BOOL} AS v"), [("v", "boolean")])


@query(f"SELECT event_id, epoch_us(CASE WHEN event_id % 8 IN (0, 1, 7) THEN try_cast(x AS TIMESTAMP) END) AS v FROM (SELECT event_id, {TEXT_TIME} AS x FROM events)")
def coerce_timestamptz(spark, sf_dir):
    df = coerce.pin(_events(spark, sf_dir, "event_id", f"{TEXT_TIME} AS v"), [("v", "timestamptz")])
    return df.select("event_id", F.unix_micros("v").alias("v"))


_HEX = "substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-' || substring(h, 13, 4) || '-' || substring(h, 17, 4) || '-' || substring(h, 21, 12)"


@query(f"SELECT event_id, CASE WHEN event_id % 7 < 4 THEN {_HEX} END AS v FROM (SELECT event_id, md5(cast(event_id AS string)) AS h FROM events)")
def coerce_uuid(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", f"{TEXT_UUID} AS v"), [("v", "uuid")])


@query(f"SELECT event_id, {_HEX} AS v FROM (SELECT event_id, md5(cast(event_id AS string)) AS h FROM events)")
def uuid_from_bytes(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", "unhex(md5(cast(event_id AS string))) AS v"), [("v", "uuid")])


@query("SELECT event_id, CASE WHEN x = floor(x) THEN cast(cast(x AS BIGINT) AS string) ELSE cast(x AS string) END AS v FROM (SELECT event_id, user_id / 4.0::DOUBLE AS x FROM events)")
def coerce_varchar(spark, sf_dir):
    return coerce.pin(_events(spark, sf_dir, "event_id", "cast(user_id AS double) / 4.0D AS v"), [("v", "varchar")])


@query(f"SELECT count(*) FILTER (x IS NOT NULL AND event_id % 8 IN (2, 3, 4, 5)) AS v FROM (SELECT event_id, {TEXT_INT} AS x FROM events)")
def coerce_failure_count(spark, sf_dir):
    return coerce.pin_failures(_events(spark, sf_dir, f"{TEXT_INT} AS v"), [("v", "bigint"), ("absent", "double")])


# inference -----------------------------------------------------------------------------


def _messages(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir, "event_id AS seq", f"{MESSAGE} AS value")


@query(
    "WITH m AS (SELECT event_id, event_id % 11 AS r, CASE event_id % 11 WHEN 3 THEN 'string' WHEN 4 THEN 'boolean' ELSE 'long' END AS t FROM events WHERE event_id % 11 > 2) "
    "SELECT 'id' AS name, 'long' AS kind, false AS mixed WHERE EXISTS (FROM m) UNION ALL SELECT 'size', arg_min(t, event_id), count(DISTINCT t) > 1 FROM m "
    "UNION ALL SELECT 'tags', 'string', false WHERE EXISTS (FROM m WHERE r = 3) UNION ALL SELECT 'note', 'string', false WHERE EXISTS (FROM m WHERE r = 4) UNION ALL SELECT 'kind', 'string', false WHERE EXISTS (FROM m WHERE r > 4)"
)
def infer_keys(spark, sf_dir):
    found = infer.infer(infer.parse(_messages(spark, sf_dir)), "seq")
    return spark.createDataFrame([(k.name, k.kind, k.mixed) for k in found], "name string, kind string, mixed boolean")


@query(
    "SELECT event_id AS seq, event_id AS id, CASE event_id % 11 WHEN 3 THEN '51-200' WHEN 4 THEN 'True' ELSE cast(user_id AS string) END AS size, "
    "CASE WHEN event_id % 11 = 3 THEN '[1,{\"a\":true}]' END AS tags, NULL::VARCHAR AS note, CASE WHEN event_id % 11 > 4 THEN event_type END AS kind FROM events WHERE event_id % 11 > 2"
)
def mixed_type_stringify(spark, sf_dir):
    return infer.convert(_messages(spark, sf_dir), "seq")


@query("SELECT count(*) AS json_parse FROM events WHERE event_id % 11 < 3")
def json_parse_skips(spark, sf_dir):
    return infer.skipped(_messages(spark, sf_dir))


@query("SELECT event_id AS seq, event_id AS a, '{\"b\":[' || user_id || ',2]}' AS n FROM events")
def flatten_nested_json(spark, sf_dir):
    rows = _events(spark, sf_dir, "event_id AS seq", """concat('{"a":', cast(event_id AS string), ', "n": {"b": [', cast(user_id AS string), ', 2]}}') AS value""")
    return infer.convert(rows, "seq")


@query("SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN event_id + 0.5::DOUBLE ELSE event_id::DOUBLE END AS f FROM events")
def floatify(spark, sf_dir):
    rows = _events(spark, sf_dir, "event_id AS seq", """concat('{"f":', cast(event_id AS string), CASE WHEN event_id % 2 = 0 THEN '.5' ELSE '' END, '}') AS value""")
    return infer.convert(rows, "seq")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem")
def normalize_numeric(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.lit(None).alias("nothing"))
    return infer.normalize(df)


# sort ----------------------------------------------------------------------------------


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type ASC NULLS LAST, event_id) AS pos FROM events")
def presort_rownum(spark, sf_dir):
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_id", "user_id", "event_type")
    keys, _ = presort.sort_keys(df, ["event_type"])
    return df.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*keys, "event_id")).cast("bigint").alias("pos"))


@query(f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY kind ASC NULLS LAST, event_id) AS pos FROM (SELECT event_id, user_id, {MAYBE_TYPE} AS kind FROM events)")
def presort_nulls_last(spark, sf_dir):
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_id", "user_id", f"{MAYBE_TYPE} AS kind")
    keys, _ = presort.sort_keys(df, ["kind"])
    return df.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*keys, "event_id")).cast("bigint").alias("pos"))


# partitions ----------------------------------------------------------------------------


@query(
    "SELECT event_id, (year(ts) - 1970)::BIGINT AS y, ((year(ts) - 1970) * 12 + month(ts) - 1)::BIGINT AS m, date_diff('day', DATE '1970-01-01', ts::DATE)::BIGINT AS d, "
    "floor(epoch_us(ts) / 3600000000)::BIGINT AS h FROM events"
)
def partition_transforms(spark, sf_dir):
    t = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", transforms.year(t).alias("y"), transforms.month(t).alias("m"), transforms.day(t).alias("d"), transforms.hour(t).alias("h"))


def _murmur_sql(value: str, source: str) -> str:
    """Murmur3 of the 8 bytes of a whole number, step by step in 128-bit arithmetic."""
    m, steps = "4294967296::HUGEINT", [f"s0 AS (SELECT *, 0::HUGEINT AS h, {value}::HUGEINT AS x FROM {source})"]

    def step(expr: str, name: str) -> None:
        steps.append(f"s{len(steps)} AS (SELECT * EXCLUDE ({name}), {expr} AS {name} FROM s{len(steps) - 1})")

    def rotl(c: str, r: int) -> str:
        return f"(({c} * {1 << r}) % {m} + {c} // {1 << 32 - r})"

    xor = lambda a, b: f"xor({a}, {b})"
    steps.append(f"s1 AS (SELECT *, x % {m} AS k, x // {m} AS k2 FROM s0)")
    for k in ("k", "k2"):
        step(f"({k} * {0xCC9E2D51}) % {m}", k)
        step(f"({rotl(k, 15)} * {0x1B873593}) % {m}", k)
        step(xor("h", k), "h")
        step(f"({rotl('h', 13)} * 5 + {0xE6546B64}) % {m}", "h")
    step(xor("h", "8::HUGEINT"), "h")
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        step(f"({xor('h', f'h // {1 << shift}')} * {by}) % {m}", "h")
    step(xor("h", f"h // {1 << 16}"), "h")
    return "WITH " + ", ".join(steps) + f" SELECT * FROM s{len(steps) - 1}"


@query(f"SELECT event_id, (h % 2147483648 % 16)::BIGINT AS bucket FROM ({_murmur_sql('user_id', 'events')})")
def partition_bucket(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", transforms.bucket(F.col("user_id"), 16).alias("bucket"))


@query(
    f"SELECT kind AS p_kind, date_diff('day', DATE '1970-01-01', ts::DATE)::BIGINT AS p_ts_day, count(*) AS rows, min(event_id) AS first_seen FROM (SELECT event_id, ts, {MAYBE_TYPE} AS kind FROM events) GROUP BY 1, 2"
)
def partition_fanout_first_seen(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr("event_id", "ts", f"{MAYBE_TYPE} AS kind")
    return partition.fanout(df, partition.parse_spec("kind, day(ts)"), "event_id")


_PREFIX = "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('0', cast(user_id AS string)) WHEN 2 THEN concat('-', cast(user_id AS string)) ELSE cast(user_id AS string) END"


@query(f"SELECT count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows FROM (SELECT v, count(*) AS n FROM (SELECT {_PREFIX} AS v FROM events) GROUP BY v) WHERE v IS NULL OR NOT regexp_matches(v, '^(0|[1-9][0-9]*)$')")
def unplaceable_prefix_skip(spark, sf_dir):
    return partition.skipped_prefixes(_events(spark, sf_dir, f"{_PREFIX} AS v"), "v")


# offsets -------------------------------------------------------------------------------

_OFF = "SELECT 'events' AS topic, (event_id % 8)::INT AS partition, floor(event_id / 8)::BIGINT AS \"offset\" FROM events"


@query(f'SELECT topic, partition, min("offset") AS first_offset, max("offset") AS last_offset FROM ({_OFF}) GROUP BY topic, partition')
def offset_ranges(spark, sf_dir):
    return lag.offset_ranges(_events(spark, sf_dir, *OFFSETS))


@query("SELECT (event_id % 8)::INT AS partition, count(*) AS n FROM events WHERE event_id % 8 % 3 = 1 GROUP BY 1")
def partition_assignment(spark, sf_dir):
    return lag.assigned(_events(spark, sf_dir, *OFFSETS), 1, 3).groupBy("partition").agg(F.count("*").alias("n"))


STATE = [
    "event_id", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id END AS committed", "user_id * 20 AS low", "user_id * 20 + 5000 AS high",
    "CASE WHEN event_id % 13 = 0 THEN 'err' END AS error", "CASE WHEN event_id % 3 = 0 THEN event_id + 2 END AS delivered", "CASE WHEN event_id % 4 = 0 THEN event_id + 1 END AS position",
]


@query(f"SELECT event_id, greatest(0, high - coalesce(delivered, position, committed, low))::BIGINT AS lag FROM (SELECT {', '.join(STATE)} FROM events)")
def lag_position(spark, sf_dir):
    return _events(spark, sf_dir, *STATE).select("event_id", lag.lag("earliest").alias("lag"))


@query(f"SELECT event_id, CASE WHEN committed IS NOT NULL AND error IS NULL AND committed < low THEN high ELSE committed END AS start FROM (SELECT {', '.join(STATE)} FROM events)")
def stale_offset_recovery(spark, sf_dir):
    return _events(spark, sf_dir, *STATE).select("event_id", lag.recovered_offset("latest").alias("start"))


@query("SELECT event_id, greatest(10, trunc(500 * (1 - (event_id % 101) / 100.0::DOUBLE)))::INT AS size FROM events")
def adaptive_batch_size(spark, sf_dir):
    return _events(spark, sf_dir, "event_id").select("event_id", lag.adaptive_batch(500, (F.col("event_id") % 101).cast("double") / 100.0).alias("size"))


@query("SELECT CASE WHEN n <= 100 THEN 100.0 WHEN n <= 1000 THEN 1000.0 WHEN n <= 10000 THEN 10000.0 ELSE 'inf'::DOUBLE END::DOUBLE AS le, count(*) AS flushes, sum(n)::BIGINT AS rows FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) GROUP BY 1")
def flush_size_histogram(spark, sf_dir):
    per = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return per.groupBy(lag.lag_histogram_bucket(F.col("n"), [100, 1000, 10000]).alias("le")).agg(F.count("*").alias("flushes"), F.sum("n").alias("rows"))


# variants ------------------------------------------------------------------------------

_PROPS = "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'null' WHEN 3 THEN '{bad' ELSE props END"


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def variant_extract(spark, sf_dir):
    df = variants.dual_write(_events(spark, sf_dir, "event_id", "props", "1 AS PROPS_VARIANT"), ["props"])
    return df.select("event_id", F.try_variant_get("props_variant", "$.k", "bigint").alias("k"))


@query("SELECT count(*) FILTER (event_id % 6 IN (2, 4, 5)) AS encoded, count(*) FILTER (event_id % 6 IN (0, 1)) AS sql_null, count(*) FILTER (event_id % 6 = 2) AS variant_null, count(*) FILTER (event_id % 6 = 3) AS invalid FROM events")
def variant_row_outcomes(spark, sf_dir):
    return variants.outcomes(_events(spark, sf_dir, "event_id", f"{_PROPS} AS props"), "props")


@query("SELECT count(*) FILTER (event_id % 6 = 5) AS typed, count(*) FILTER (event_id % 6 = 4) AS fallback, count(*) FILTER (event_id % 6 = 2) AS variant_null, count(*) FILTER (event_id % 6 IN (0, 1, 3)) AS absent FROM events")
def variant_path_outcomes(spark, sf_dir):
    leaves = """CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '{"k":null}' WHEN 3 THEN '{bad' WHEN 4 THEN '{"k":"text"}' ELSE props END AS props"""
    return variants.path_outcomes(_events(spark, sf_dir, leaves), "props", "$.k", "bigint")


@query("SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '{\"n\":\"' || '9223372036854775' || lpad((808 + event_id % 190)::VARCHAR, 3, '0') || '\"}' ELSE '{\"n\":' || event_id || '}' END AS t FROM events")
def unshreddable_window(spark, sf_dir):
    text = """CASE WHEN event_id % 50 = 0 THEN concat('{"n":9223372036854775', lpad(cast(808 + event_id % 190 AS string), 3, '0'), '}') ELSE concat('{"n":', cast(event_id AS string), '}') END AS t"""
    df = _events(spark, sf_dir, "event_id", text)
    return df.select("event_id", variants.widen_guard(F.col("t")).alias("t"))


# set operations and evolution ------------------------------------------------------------


@query("SELECT event_id, event_type, NULL::BIGINT AS team, NULL::VARCHAR AS extra FROM events")
def null_fill_union(spark, sf_dir):
    target = spark.createDataFrame([], "event_id long, event_type string, team long, extra string").schema
    return evolve.align(_events(spark, sf_dir, "event_id", "event_type"), target)


@query("SELECT event_id AS id, event_type, NULL::VARCHAR AS o_orderstatus FROM events UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders")
def concat_missing(spark, sf_dir):
    a = _events(spark, sf_dir, "event_id AS id", "event_type")
    return evolve.concat([a, table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderstatus")])


# catalog ---------------------------------------------------------------------------------

#: Order lines as files: order, line, part and supplier tell them apart.
FILE_ID = "(((l_orderkey * 8 + l_linenumber) * 2097152 + l_partkey) * 16384 + l_suppkey)"
CATALOG = {
    "snapshot": "SELECT o_orderkey * 2 AS snapshot_id, o_orderdate AS snapshot_time, o_orderkey % 5 AS schema_version FROM orders",
    "data_file": f"SELECT {FILE_ID} AS data_file_id, l_suppkey % 20 AS table_id, l_orderkey * 2 - l_partkey % 2 AS begin_snapshot, CASE WHEN l_returnflag = 'R' THEN l_orderkey * 2 + l_partkey % 7 END AS end_snapshot, "
    "concat('d/', cast(l_orderkey AS string), '/', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS path, true AS path_is_relative, l_partkey % 200 * 500000 AS file_size_bytes, l_orderkey % 900 + 1 AS record_count, l_partkey % 50 AS partition_id FROM lineitem",
    "delete_file": f"SELECT l_orderkey AS delete_file_id, {FILE_ID} AS data_file_id, l_suppkey % 20 AS table_id, l_orderkey * 2 AS begin_snapshot, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey * 2 + 10 END AS end_snapshot, l_partkey * 10 AS file_size_bytes FROM lineitem WHERE l_linenumber = 1 AND l_linestatus = 'F'",
    "file_partition_value": f"SELECT {FILE_ID} AS data_file_id, l_suppkey % 20 AS table_id, i AS partition_key_index, CASE WHEN i = 0 THEN cast(2020 + l_suppkey % 5 AS string) WHEN i = 1 THEN cast(1 + l_partkey % 13 AS string) "
    "WHEN i = 2 THEN cast(1 + l_orderkey % 31 AS string) WHEN l_orderkey % 97 = 0 THEN NULL ELSE cast(l_linenumber * 3 AS string) END AS partition_value FROM lineitem CROSS JOIN (SELECT cast(r_regionkey AS bigint) AS i FROM region WHERE r_regionkey < 4) k WHERE NOT (l_orderkey % 89 = 0 AND i = 2)",
    "file_column_stats": f"SELECT {FILE_ID} AS data_file_id, l_suppkey % 20 AS table_id, cast(l_linenumber AS bigint) AS column_id FROM lineitem",
    "scheduled": f"SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE {FILE_ID} END AS data_file_id, CASE WHEN l_linenumber % 2 = 0 THEN concat('s3://lake/d/', cast(l_orderkey % 1000 AS string)) ELSE concat('d/', cast(l_orderkey % 1000 AS string)) END AS path, "
    "l_linenumber % 2 <> 0 AS path_is_relative FROM lineitem",
    "lake_table": "SELECT s_suppkey % 20 + 20 * (s_suppkey % 3) AS table_id, cast(s_nationkey AS bigint) AS schema_id, s_name AS table_name, s_suppkey AS begin_snapshot, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey + 1 END AS end_snapshot FROM supplier",
    "lake_schema": "SELECT cast(n_nationkey AS bigint) AS schema_id, n_name AS schema_name, cast(NULL AS bigint) AS end_snapshot FROM nation",
    "table_stats": "SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 90 END AS table_id, c_custkey AS record_count FROM customer",
    "inlined": "SELECT p_partkey % 120 AS table_id, p_partkey AS schema_version, p_name AS table_name FROM part",
    "metadata": "SELECT CASE WHEN n_nationkey = 0 THEN 'version' ELSE concat('k', cast(n_nationkey AS string)) END AS key, CASE WHEN n_nationkey = 0 THEN '1.2-rc3' WHEN n_nationkey % 3 = 0 THEN 'TRUE' WHEN n_nationkey % 3 = 1 THEN cast(n_nationkey AS string) ELSE n_name END AS value, "
    "CASE WHEN n_nationkey > 10 THEN 'table' END AS scope, CASE WHEN n_nationkey > 10 THEN cast(n_nationkey AS bigint) END AS scope_id FROM nation",
}
_WITH = "WITH " + ", ".join(f"{n} AS ({s})" for n, s in CATALOG.items()) + "\n"
_BAND = "CASE WHEN file_size_bytes < 1048576 THEN 'lt_1mib' WHEN file_size_bytes < 10485760 THEN '1_10mib' WHEN file_size_bytes < 67108864 THEN '10_64mib' ELSE 'ge_64mib' END"
_PARTS = "SELECT data_file_id, table_id, string_agg(partition_value, '/' ORDER BY partition_key_index, partition_value) AS part FROM file_partition_value GROUP BY ALL"
_MERGEABLE = (
    f"SELECT f.table_id, part, {_BAND} AS band, count(*) AS n, sum(file_size_bytes) AS size FROM data_file f LEFT JOIN ({_PARTS}) p USING (data_file_id, table_id) "
    "WHERE f.end_snapshot IS NULL AND file_size_bytes < 67108864 AND NOT EXISTS (SELECT 1 FROM delete_file d WHERE d.data_file_id = f.data_file_id AND d.end_snapshot IS NULL) GROUP BY ALL HAVING count(*) >= 2"
)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    for name in ("orders", "lineitem", "region", "supplier", "nation", "customer", "part"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return Catalog(**{n: spark.sql(s) for n, s in CATALOG.items()})


def _catalog_query(name: str, f: Callable[[Catalog], DataFrame], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(catalog(spark, sf_dir))
    ORACLE[name] = _WITH + sql


_AS_OF = "TIMESTAMP '2025-01-01 00:00:00'"
for _n, _f, _s in (
    ("q_pending_deletes", metrics.pending_deletes, "SELECT count(*) AS total, count(DISTINCT path) AS unique_paths, count(*) - count(DISTINCT path) AS dup_rows FROM scheduled"),
    ("q_data_files", metrics.data_files, "SELECT count(*) AS files, coalesce(sum(file_size_bytes), 0)::BIGINT AS bytes, coalesce(sum(record_count), 0)::BIGINT AS rows FROM data_file WHERE end_snapshot IS NULL"),
    ("q_delete_files", metrics.delete_files, "SELECT count(*) AS files, coalesce(sum(file_size_bytes), 0)::BIGINT AS bytes FROM delete_file WHERE end_snapshot IS NULL"),
    ("q_files_per_band", metrics.files_per_band, f"SELECT {_BAND} AS band, count(*) AS count, sum(file_size_bytes)::BIGINT AS bytes FROM data_file WHERE end_snapshot IS NULL GROUP BY 1"),
    ("q_mergeable_files_per_band", metrics.mergeable_files_per_band, f"SELECT band, sum(n)::BIGINT AS count, sum(size)::BIGINT AS bytes, count(*) AS groups FROM ({_MERGEABLE}) GROUP BY band"),
    ("q_snapshots", lambda c: metrics.snapshots(c, F.lit("2025-01-01 00:00:00").cast("timestamp")), f"SELECT count(*) AS count, (epoch({_AS_OF}) - floor(epoch(min(snapshot_time))))::DOUBLE AS oldest_age, (epoch({_AS_OF}) - floor(epoch(max(snapshot_time))))::DOUBLE AS newest_age, min(snapshot_id) AS min_id, max(snapshot_id) AS max_id FROM snapshot"),
    ("q_inlined_data_tables", metrics.inlined_data_tables, "SELECT count(*) AS total FROM inlined"),
    ("q_unreachable_inline_tables", metrics.unreachable_inline_tables, "SELECT count(*) AS total FROM inlined i WHERE NOT EXISTS (SELECT 1 FROM lake_table t, (SELECT min(snapshot_id) AS lo, max(snapshot_id) AS hi FROM snapshot) WHERE t.table_id = i.table_id AND begin_snapshot <= hi AND (end_snapshot IS NULL OR end_snapshot > lo)) AND (SELECT count(*) FROM snapshot) > 0"),
    ("q_tables", metrics.tables, "SELECT CASE WHEN end_snapshot IS NULL THEN 'live' ELSE 'dropped' END AS state, count(*) AS count FROM lake_table GROUP BY 1"),
    ("q_files_per_partition_top20", metrics.files_per_partition_top20, f"SELECT f.table_id, part AS partition, count(*) AS count FROM data_file f JOIN ({_PARTS}) USING (data_file_id, table_id) WHERE f.end_snapshot IS NULL GROUP BY ALL ORDER BY count DESC, f.table_id, part NULLS FIRST LIMIT 20"),
    ("q_live_file_lookup", lambda c: metrics.live_file_lookup(c, 3), "SELECT count(*) AS count FROM data_file WHERE end_snapshot IS NULL AND table_id = 3"),
    ("q_partition_value_lookup", lambda c: metrics.partition_value_lookup(c, 3), "SELECT count(*) AS count FROM file_partition_value WHERE data_file_id IN (SELECT data_file_id FROM data_file WHERE end_snapshot IS NULL AND table_id = 3)"),
    ("q_file_column_stats_lookup", lambda c: metrics.file_column_stats_lookup(c, 3), "SELECT count(*) AS count FROM file_column_stats WHERE data_file_id IN (SELECT data_file_id FROM data_file WHERE end_snapshot IS NULL AND table_id = 3)"),
    ("q_catalog", metrics.catalog_version, "SELECT try_cast(regexp_extract(value, '^([0-9]+([.][0-9]+)*)', 1) AS DOUBLE) AS format_version, regexp_extract(value, '^[0-9.]+(.*)$', 1) AS suffix FROM metadata WHERE key = 'version'"),
    ("q_config", metrics.config, "SELECT key, coalesce(scope, 'global') AS scope, scope_id, CASE WHEN lower(value) = 'true' THEN 1 WHEN regexp_matches(value, '^[0-9]+$') THEN try_cast(value AS DOUBLE) END::DOUBLE AS value FROM metadata WHERE key <> 'version'"),
    ("dedup_queue", maintenance.dedup_queue, "SELECT path, min(data_file_id) AS data_file_id, count(*) - 1 AS dropped FROM scheduled GROUP BY path"),
    ("orphan_stats", maintenance.orphan_stats, "SELECT table_id, record_count FROM table_stats s WHERE NOT EXISTS (SELECT 1 FROM lake_table t WHERE t.end_snapshot IS NULL AND t.table_id = s.table_id)"),
    ("compaction_backlog", maintenance.compaction_backlog, f"SELECT *, row_number() OVER (ORDER BY files DESC, table_name, table_id) AS place FROM (SELECT m.table_id, sum(n)::BIGINT AS files, sum(size)::BIGINT AS bytes, count(*) AS groups, table_name FROM (SELECT * FROM ({_MERGEABLE})) m JOIN lake_table t ON t.table_id = m.table_id AND t.end_snapshot IS NULL GROUP BY m.table_id, table_name, t.begin_snapshot)"),
    ("partition_rot", maintenance.partition_rot, "SELECT data_file_id, v.table_id, bool_or(partition_value IS NULL) AS has_null, count(*) FILTER (partition_value IS NOT NULL) AS values FROM file_partition_value v JOIN (SELECT table_id, max(partition_key_index) + 1 AS w FROM file_partition_value GROUP BY 1) USING (table_id) GROUP BY data_file_id, v.table_id, w HAVING bool_or(partition_value IS NULL) OR count(*) <> w"),
    ("live_files_by_path", lambda c: maintenance.by_path(c, "d/1%", "^d/[0-9]+/[1-3]-").select("data_file_id", "path"), "SELECT data_file_id, path FROM data_file WHERE end_snapshot IS NULL AND path LIKE 'd/1%' AND regexp_matches(path, '^d/[0-9]+/[1-3]-')"),
    ("droppable_inlined", maintenance.droppable_inlined, "SELECT table_id, schema_version, table_name FROM inlined i WHERE NOT EXISTS (SELECT 1 FROM lake_table t, (SELECT min(snapshot_id) AS lo, max(snapshot_id) AS hi FROM snapshot) WHERE t.table_id = i.table_id AND begin_snapshot <= hi AND (end_snapshot IS NULL OR end_snapshot > lo))"),
    ("keyset_page", lambda c: maintenance.keyset_page(c.inlined, "table_id", "schema_version", (5, 100), 50), "SELECT * FROM inlined WHERE (table_id, schema_version) > (5, 100) ORDER BY table_id, schema_version LIMIT 50"),
):
    _catalog_query(_n, _f, _s)

_LISTING = "SELECT concat('s3://lake/d/', cast(l_orderkey % 700 AS string)) AS path FROM lineitem"


def _found(c: Catalog) -> DataFrame:
    return maintenance.orphans(c, c.snapshot.sparkSession.sql(_LISTING), "s3://lake")


_ORPHANS = f"SELECT data_file_id, full_path AS path FROM (SELECT data_file_id, CASE WHEN path_is_relative THEN 's3://lake/' || path ELSE path END AS full_path FROM scheduled) WHERE full_path NOT IN ({_LISTING})"
_catalog_query("catalog_orphans", _found, _ORPHANS)
_catalog_query(
    "heal_gates", lambda c: maintenance.heal_gates(c, _found(c)),
    f"SELECT *, live_files > 0 AND orphan_live = 0 AND orphan_deletes = 0 AS may_heal FROM (SELECT (SELECT count(*) FROM data_file WHERE end_snapshot IS NULL) AS live_files, "
    f"(SELECT count(DISTINCT data_file_id) FROM ({_ORPHANS}) WHERE data_file_id IN (SELECT data_file_id FROM data_file WHERE end_snapshot IS NULL)) AS orphan_live, "
    f"(SELECT count(DISTINCT data_file_id) FROM ({_ORPHANS}) WHERE data_file_id IN (SELECT data_file_id FROM delete_file WHERE end_snapshot IS NULL)) AS orphan_deletes)",
)
_BEFORE = "TIMESTAMP '2023-01-01 00:00:00'"
_EXPIRED = f"SELECT snapshot_id FROM snapshot WHERE snapshot_time < {_BEFORE} AND snapshot_id < (SELECT max(snapshot_id) FROM snapshot)"


def _expired(c: Catalog) -> DataFrame:
    return maintenance.expirable(c, F.lit("2023-01-01 00:00:00").cast("timestamp"))


_catalog_query("expirable_snapshots", _expired, _EXPIRED)
_catalog_query(
    "expire_dead_files", lambda c: maintenance.dead_files(c, _expired(c)),
    f"SELECT data_file_id, begin_snapshot, end_snapshot FROM data_file f WHERE end_snapshot IN ({_EXPIRED}) AND NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.snapshot_id NOT IN ({_EXPIRED}) AND s.snapshot_id >= f.begin_snapshot AND s.snapshot_id < f.end_snapshot)",
)
_TIER = "CASE WHEN file_size_bytes < 1048576 THEN 'tier0' WHEN file_size_bytes < 10485760 THEN 'tier1' WHEN file_size_bytes < 67108864 THEN 'tier2' END"
_catalog_query(
    "compaction_tiers", maintenance.compaction_bins,
    f"SELECT table_id, part AS partition, tier, bin, count(*) AS files, sum(file_size_bytes)::BIGINT AS bytes FROM (SELECT *, floor(coalesce(sum(file_size_bytes) OVER (PARTITION BY table_id, part, tier ORDER BY data_file_id, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 134217728)::BIGINT AS bin FROM "
    f"(SELECT f.table_id, part, data_file_id, path, file_size_bytes, {_TIER} AS tier FROM data_file f LEFT JOIN ({_PARTS}) USING (data_file_id, table_id) WHERE f.end_snapshot IS NULL AND data_file_id NOT IN (SELECT data_file_id FROM delete_file WHERE end_snapshot IS NULL)) WHERE tier IS NOT NULL) GROUP BY ALL HAVING count(*) >= 2",
)
_RUN = "files DESC, partition NULLS FIRST, tier, bin"
_BUDGETED = (
    "SELECT * EXCLUDE (own, upto, turn) FROM (SELECT *, sum(bytes) OVER (ORDER BY files DESC, table_id, partition NULLS FIRST, tier, bin ROWS UNBOUNDED PRECEDING) AS upto FROM "
    "(SELECT *, row_number() OVER (ORDER BY files DESC, table_id, partition NULLS FIRST, tier, bin) AS turn FROM "
    f"(SELECT *, sum(bytes) OVER (PARTITION BY table_id ORDER BY {_RUN} ROWS UNBOUNDED PRECEDING) AS own FROM ({{bins}})) WHERE own <= {{budget}} // 2) WHERE turn <= {{outputs}}) WHERE upto <= {{budget}}"
)
_BINS = ORACLE["compaction_tiers"].removeprefix(_WITH)
_catalog_query("compaction_budget", lambda c: maintenance.within_budget(maintenance.compaction_bins(c), 2 << 30, 40), _BUDGETED.format(bins=_BINS, budget=2 << 30, outputs=40))
_catalog_query("compaction_probe", lambda c: maintenance.within_budget(maintenance.compaction_bins(c), 1 << 40, 3), _BUDGETED.format(bins=_BINS, budget=1 << 40, outputs=3))
_catalog_query(
    "droppable_partitions",
    lambda c: maintenance.droppable(c, [0, 1, 2, 3], F.lit("2022-06-01 00:00:00").cast("timestamp")).withColumn("leaf", F.unix_micros("leaf")),
    "SELECT f.table_id, epoch_us(leaf) AS leaf, count(*) AS files, sum(file_size_bytes)::BIGINT AS bytes, sum(record_count)::BIGINT AS rows FROM data_file f JOIN (SELECT data_file_id, table_id, "
    "try_cast(max(partition_value) FILTER (partition_key_index = 0) || '-' || lpad(max(partition_value) FILTER (partition_key_index = 1), 2, '0') || '-' || lpad(max(partition_value) FILTER (partition_key_index = 2), 2, '0') || ' ' || lpad(max(partition_value) FILTER (partition_key_index = 3), 2, '0') || ':00:00' AS TIMESTAMP) AS leaf FROM file_partition_value GROUP BY 1, 2) USING (data_file_id, table_id) "
    "WHERE f.end_snapshot IS NULL AND leaf + INTERVAL 1 HOUR <= TIMESTAMP '2022-06-01 00:00:00' GROUP BY f.table_id, leaf",
)


# pipelines -------------------------------------------------------------------------------


@query(
    "SELECT strftime(ts, '%Y-%m-%d') AS day, kind, count(*) AS n, min(event_id) AS first_seen, sum(user_id)::BIGINT AS users FROM "
    "(SELECT event_id, ts, user_id, event_type AS kind FROM events WHERE event_id % 11 > 2) WHERE kind IN ('click', 'view', 'purchase') AND user_id NOT IN (1, 2, 3) GROUP BY ALL"
)
def flagship(spark, sf_dir):
    """Messages parsed, pinned, filtered and fanned out by day and type."""
    message = (
        "CASE event_id % 11 WHEN 0 THEN '[1]' WHEN 1 THEN '{bad' WHEN 2 THEN 'null' ELSE concat('{\"event_id\":', cast(event_id AS string), ',\"user_id\":\"', cast(user_id AS string), "
        "'\",\"kind\":\"', event_type, '\",\"ts\":\"', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '\"}') END AS value"
    )
    keys = [infer.Key("event_id", "long", False), infer.Key("user_id", "string", False), infer.Key("kind", "string", False), infer.Key("ts", "string", False)]
    rows = infer.build(infer.parse(_events(spark, sf_dir, message)), keys)
    rows = coerce.pin(rows, [("user_id", "bigint"), ("ts", "timestamptz")])
    rows = filters.drop(filters.keep(rows, "kind", ["click", "view", "purchase"]), "user_id", [1, 2, 3])
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "kind").agg(F.count("*").alias("n"), F.min("event_id").alias("first_seen"), F.sum("user_id").alias("users"))


def _scratch(spark) -> str:
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/lake-{uuid.uuid4().hex}"


@query("SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users FROM events GROUP BY event_type")
def table_append_roundtrip(spark, sf_dir):
    from .sources.lake import LakeTable

    t = LakeTable(spark, _scratch(spark))
    df = _events(spark, sf_dir, "event_id", "user_id", "event_type")
    t.create(df.schema, spec="event_type", sort=("user_id",))
    t.append(df.where("event_id % 2 = 0"), "a")
    t.append(df.where("event_id % 2 = 1"), "b")
    return t.read().groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query("SELECT count(*) AS n, sum(user_id)::BIGINT AS users, count(*) FILTER (event_id % 2 = 1) AS with_extra FROM events")
def idempotent_replay(spark, sf_dir):
    """A repeated key writes nothing; a new column is added on the way."""
    from .sources.lake import LakeTable

    t = LakeTable(spark, _scratch(spark))
    df = _events(spark, sf_dir, "event_id", "user_id")
    for _ in range(2):
        t.append(df.where("event_id % 2 = 0"), "a")
        t.append(df.where("event_id % 2 = 1").withColumn("extra", F.lit("x")), "b")
    return t.read().agg(F.count("*").alias("n"), F.sum("user_id").alias("users"), F.count("extra").alias("with_extra"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type")
def stream_ingest(spark, sf_dir):
    """The events table as a stream of messages, filtered and appended batch by batch."""
    from .sources.lake import LakeTable
    from .streaming.ingest import LakeSink, Steps, ingest

    root = _scratch(spark)
    src = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet*").parquet(sf_dir if not sf_dir.endswith(".parquet") else sf_dir)
    text = stream.selectExpr("event_id AS seq", "to_json(struct(event_id, user_id, event_type)) AS value")
    t = LakeTable(spark, f"{root}/table")
    ingest(spark, text, LakeSink(t), Steps(drop=("event_type", ["error"])), f"{root}/checkpoint", name=f"ingest_{root[-8:]}")
    return t.read().groupBy("event_type").agg(F.count("*").alias("n"))


#: Polls of five sets: each names a few of ten values, every ninth one none.
POLLS = ["user_id % 5 AS set", "cast(floor(event_id / 40) AS bigint) AS seq", "CASE WHEN cast(floor(event_id / 40) AS bigint) % 9 <> 8 THEN event_id % 10 - event_id % 3 END AS value"]


# rules and operators whose result a table shows ------------------------------------------


@query(f"SELECT event_id, CASE WHEN committed IS NOT NULL AND error IS NULL AND committed < low THEN low ELSE committed END AS start FROM (SELECT {', '.join(STATE)} FROM events)")
def stale_offset_recovery_earliest(spark, sf_dir):
    return _events(spark, sf_dir, *STATE).select("event_id", lag.recovered_offset("earliest").alias("start"))


@query(
    f"SELECT event_id, CASE WHEN committed IS NULL OR error IS NOT NULL THEN 'reset' WHEN committed < low THEN 'recovered' ELSE 'committed' END AS kind, "
    f"CASE WHEN committed >= low AND error IS NULL THEN committed ELSE high END AS start FROM (SELECT {', '.join(STATE)} FROM events)"
)
def startup_positions(spark, sf_dir):
    return _events(spark, sf_dir, *STATE).select("event_id", lag.start_kind("latest").alias("kind"), lag.start_at("latest").alias("start"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id ELSE event_id + 5000000000 END AS n FROM events")
def promotion_applied(spark, sf_dir):
    """An int column that long values arrive for is a long column from then on, older files included."""
    from .sources.lake import LakeTable

    t = LakeTable(spark, _scratch(spark))
    df = _events(spark, sf_dir, "event_id")
    t.append(df.where("event_id % 2 = 0").select("event_id", F.col("event_id").cast("int").alias("n")), "a")
    t.append(df.where("event_id % 2 = 1").select("event_id", (F.col("event_id") + 5_000_000_000).alias("n")), "b")
    return t.read().select("event_id", "n")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id END AS k FROM events")
def live_variant_strip(spark, sf_dir):
    """Texts that arrive under the name of a live VARIANT column are left out; their rows stay."""
    from .sources.lake import LakeTable

    t = LakeTable(spark, _scratch(spark))
    df = _events(spark, sf_dir, "event_id")
    t.append(df.where("event_id % 2 = 0").withColumn("v", F.parse_json(F.concat(F.lit('{"k":'), F.col("event_id").cast("string"), F.lit("}")))), "a")
    t.append(df.where("event_id % 2 = 1").withColumn("v", F.lit("text")), "b")
    return t.read().select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 1 THEN NULL ELSE event_type END AS value FROM events")
def frame_decode(spark, sf_dir):
    """Every other message in a frame of one stored block; of those, some are cut off and give null."""
    from .sources import frames

    stored = "concat(unhex('04224d18604082'), unhex(lpad(hex(octet_length(event_type)), 2, '0')), unhex('000080'), encode(event_type, 'UTF-8'), unhex('00000000'))"
    value = f"CASE WHEN event_id % 5 = 0 THEN encode(event_type, 'UTF-8') WHEN event_id % 5 = 1 THEN substring({stored}, 1, 12) ELSE {stored} END AS value"
    return frames.decode(_events(spark, sf_dir, "event_id", value)).select("event_id", F.decode("value", "UTF-8").alias("value"))


@query(f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY kind ASC NULLS LAST, event_id) AS pos FROM (SELECT event_id, user_id, {MAYBE_TYPE} AS kind FROM events)")
def presort_written_order(spark, sf_dir):
    """The order that ``presort`` leaves rows in, inside each write task."""
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_id", "user_id", f"{MAYBE_TYPE} AS kind").repartition("user_id")
    sorted_ = presort.presort(df, ["kind"], "event_id").withColumn("at", F.monotonically_increasing_id())
    return sorted_.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("at")).cast("bigint").alias("pos"))


_NAN = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN cast('NaN' AS double) ELSE value END"


@query(f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY v ASC NULLS LAST, event_id) AS pos FROM (SELECT event_id, user_id, {_NAN} AS v FROM events)")
def presort_nan_placement(spark, sf_dir):
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_id", "user_id", f"{_NAN} AS v")
    keys, _ = presort.sort_keys(df, ["v"])
    return df.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*keys, "event_id")).cast("bigint").alias("pos"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY md5(cast(event_id AS string))) AS pos FROM events")
def presort_uuid_order(spark, sf_dir):
    from pyspark.sql import Window

    df = coerce.pin(_events(spark, sf_dir, "event_id", "user_id", "upper(md5(cast(event_id AS string))) AS u"), [("u", "uuid")])
    keys, _ = presort.sort_keys(df, ["u"])
    return df.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*keys)).cast("bigint").alias("pos"))


@query(f"SELECT event_id, {_HEX} AS u, event_type AS t FROM (SELECT event_id, event_type, md5(cast(event_id AS string)) AS h FROM events)")
def uuid_text_rewrite(spark, sf_dir):
    """A table with a live uuid column takes texts, and one with a live text column takes uuids."""
    df = _events(spark, sf_dir, "event_id", "concat('{', md5(cast(event_id AS string)), '}') AS u", "event_type AS t")
    target = coerce.pin(df, [("u", "uuid")]).schema
    return evolve.align(df, target)


@query("SELECT event_id, event_type FROM events")
def unwritable_columns(spark, sf_dir):
    df = _events(spark, sf_dir, "event_id", "event_type", "user_id AS `bad name`", "1 AS `_sysrow`", f"2 AS `{'x' * 129}`")
    return evolve.drop_unwritable(df)[0]


@query("SELECT event_type, count(*) AS n, 1::BIGINT AS stamps FROM events GROUP BY event_type")
def insertion_stamp(spark, sf_dir):
    df = evolve.stamp(_events(spark, sf_dir, "event_type"))
    return df.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct(evolve.STAMP).alias("stamps"))


@query("SELECT event_id, least(60.0, greatest(0.1, 30.0 - event_id % 100))::DOUBLE AS timeout, event_id % 700 < 480 AS healthy, least(30.0, 0.5 * pow(2, event_id % 9))::DOUBLE AS backoff FROM events")
def consumer_rules(spark, sf_dir):
    n = F.col("event_id")
    return _events(spark, sf_dir, "event_id").select(
        n, lag.timeout_of(F.lit(30.0) - n % 100).alias("timeout"), lag.is_healthy((n % 700).cast("double")).alias("healthy"), lag.backoff_of(n % 9).alias("backoff")
    )


@query("SELECT event_id, json_extract(t, '$.k')::BIGINT AS k FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 3 THEN NULL ELSE props END AS t FROM events)")
def variant_declared(spark, sf_dir):
    """A declared VARIANT column: empty and invalid texts are null."""
    text = "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 3 THEN '{bad' ELSE props END AS t"
    return _events(spark, sf_dir, "event_id", text).select("event_id", F.try_variant_get(variants.declared(F.col("t")), "$.k", "bigint").alias("k"))


_MESSY = "concat('{\"id\":', cast(event_id AS string), CASE event_id % 3 WHEN 0 THEN ',\"v\":1' WHEN 1 THEN ',\"v\":null' ELSE '' END, '}') AS value"


@query("SELECT event_id AS seq, event_id AS id, CASE WHEN event_id % 3 = 0 THEN 1::BIGINT END AS v FROM events")
def first_non_null_type(spark, sf_dir):
    return infer.convert(_events(spark, sf_dir, "event_id AS seq", _MESSY), "seq")


@query("SELECT event_id, date_trunc('hour', ts - INTERVAL 30 DAY) AS cut, date_trunc('day', ts - INTERVAL 7 DAY) AS floor_cut FROM events")
def retention_cutoffs(spark, sf_dir):
    """A retention below a week counts as a week."""
    t = F.col("ts").cast("timestamp")
    cut = lambda days, grain: maintenance.retention_cutoff(t, days, grain).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", cut(30, "hour").alias("cut"), cut(2, "day").alias("floor_cut"))


@query(
    "SELECT event_id AS data_file_id, k AS partition_key_index, CASE WHEN k = 0 THEN '2024' WHEN event_id % 4 = 0 THEN NULL ELSE (event_id % 12 + 1)::VARCHAR END AS partition_value "
    "FROM events CROSS JOIN (VALUES (0::BIGINT), (1::BIGINT)) t(k)"
)
def repaired_partition_values(spark, sf_dir):
    path = "concat('data/year=2024/', CASE WHEN event_id % 4 = 0 THEN 'month=/' ELSE concat('month=', cast(event_id % 12 + 1 AS string), '/') END, 'f.parquet') AS path"
    return maintenance.repaired_values(_events(spark, sf_dir, "event_id AS data_file_id", path), ["year", "month"])


@query("SELECT o_orderkey AS table_id, o_orderdate AS leaf FROM orders JOIN (SELECT user_id, min(ts) AS p FROM events GROUP BY user_id) ON user_id = o_orderkey WHERE o_orderdate < p UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT user_id FROM events)")
def cursor_guarded_leaves(spark, sf_dir):
    leaves = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS table_id", "o_orderdate AS leaf")
    return maintenance.cursor_guard(leaves, table(spark, sf_dir, "events").selectExpr("user_id AS table_id", "ts AS position"))


# maintenance that is applied ---------------------------------------------------------------


def _lake(spark, rows: DataFrame, spec: str = "", parts: int = 3):
    """A table that ``rows(event_id, ...)`` went into by several appends."""
    from .sources.lake import LakeTable

    t = LakeTable(spark, _scratch(spark))
    t.create(rows.schema, spec=spec)
    for i in range(parts):
        t.append(rows.where(F.pmod("event_id", F.lit(parts)) == i), f"part-{i}")
    return t


@query("SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users, true AS fewer_files FROM events GROUP BY event_type")
def compaction_applied(spark, sf_dir):
    """Appended in parts, merged by partition: the rows stay, the files get fewer."""
    t = _lake(spark, _events(spark, sf_dir, "event_id", "user_id", "event_type"), "event_type")
    before = len(t.snapshot().files)
    maintenance.compact(t)
    fewer = len(t.snapshot().files) < before
    return t.read().groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users")).withColumn("fewer_files", F.lit(fewer))


def _log(spark, sf_dir) -> str:
    """The events as a log of eight partitions in segments of 50 messages."""
    from .sources import messages

    root = _scratch(spark)
    messages.append(_events(spark, sf_dir, *OFFSETS, "cast(event_id AS string) AS value"), root, "events", segment=50)
    return root


@query("SELECT 'events' AS topic, (event_id % 8)::INT AS partition, floor(event_id / 8)::BIGINT AS \"offset\", event_id::VARCHAR AS value FROM events WHERE event_id % 8 % 3 = 2")
def message_log_read(spark, sf_dir):
    """The messages of one of three replicas, with the offsets they were written at."""
    from .sources import messages

    return messages.read(spark, _log(spark, sf_dir), "events", replicas=3, ordinal=2)


@query(f'SELECT topic, partition, min("offset") AS low, max("offset") + 1 AS high FROM ({_OFF}) GROUP BY topic, partition')
def message_log_watermarks(spark, sf_dir):
    from .sources import messages

    return messages.watermarks(spark, _log(spark, sf_dir), "events")


@query("SELECT (event_id % 8)::INT AS partition, count(*) AS n FROM events WHERE floor(event_id / 8) >= CASE WHEN event_id % 8 < 5 THEN event_id % 8 * 20 ELSE 0 END GROUP BY 1")
def message_log_from_positions(spark, sf_dir):
    """Partitions 0 to 4 have committed positions, the others start at their first message."""
    from .sources import messages

    starts = spark.range(5).select(F.col("id").cast("int").alias("partition"), (F.col("id") * 20).alias("start"))
    log = messages.read(spark, _log(spark, sf_dir), "events")
    return messages.from_positions(log, starts).groupBy("partition").agg(F.count("*").alias("n"))


@query("SELECT (event_id % 8)::INT AS partition, count(*) AS n, sum(event_id)::BIGINT AS total FROM events GROUP BY 1")
def message_log_stream(spark, sf_dir):
    """The log as a stream into a lake table, every segment once."""
    from .sources import messages
    from .sources.lake import LakeTable
    from .streaming.ingest import LakeSink, Steps, ingest

    root = _log(spark, sf_dir)
    log = messages.read(spark, root, "events", stream=True)
    text = log.selectExpr("offset * 8 + partition AS seq", "to_json(struct(partition, cast(value AS bigint) AS id)) AS value")
    t = LakeTable(spark, f"{root}/table")
    ingest(spark, text, LakeSink(t), Steps(), f"{root}/checkpoint", name=f"log_{root[-8:]}")
    return t.read().groupBy(F.col("partition").cast("int").alias("partition")).agg(F.count("*").alias("n"), F.sum("id").alias("total"))


@query("SELECT count(*) AS n, sum(user_id)::BIGINT AS users, true AS gone FROM events")
def expiry_applied(spark, sf_dir):
    """After a merge, files that only older snapshots see are deleted; the newest snapshot reads as before."""
    t = _lake(spark, _events(spark, sf_dir, "event_id", "user_id", "event_type"), "event_type")
    maintenance.compact(t)
    dead = maintenance.expire(t)
    left = {r["path"].rpartition("/data/")[2] for r in maintenance.listing(spark, f"{t.root}/data").select("path").collect()}
    gone = bool(dead) and not any(p.removeprefix("data/") in left for p in dead)
    return t.read().agg(F.count("*").alias("n"), F.sum("user_id").alias("users")).withColumn("gone", F.lit(gone))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 10 DAY FROM events) GROUP BY 1")
def retention_applied(spark, sf_dir):
    """Whole day partitions up to the tenth day go in one commit."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", "cast(ts AS timestamp) AS ts")
    t = _lake(spark, events, "day(ts)", 2)
    cut = events.agg((F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 10 DAY")).alias("c")).first()["c"]
    maintenance.drop_partitions(t, "ts", cut)
    return t.read().groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT 1::BIGINT AS strays, count(*) AS n FROM events")
def cleanup_applied(spark, sf_dir):
    """A data file that no commit names is found by listing and deleted; committed ones stay."""
    t = _lake(spark, _events(spark, sf_dir, "event_id", "user_id"), parts=2)
    spark.range(5).coalesce(1).write.parquet(f"{t.root}/data/stray")
    found = maintenance.cleanup(t, F.current_timestamp() + F.expr("INTERVAL 1 HOUR"))
    again = maintenance.cleanup(t, F.current_timestamp() + F.expr("INTERVAL 1 HOUR"))
    return found.unionByName(again).agg(F.count("*").alias("strays")).crossJoin(t.read().agg(F.count("*").alias("n")))


from . import applied  # noqa: E402, F401 - registers the queries that write
