"""Registered queries that write lake tables, ingest streams or change a lake, with their oracle SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .catalogue import _LISTING, _WITH, MAYBE_TYPE, OFFSETS, POLLS, _events, _lake, _scratch, catalog, query, table
from .functions import macros
from .operators import infer
from .plans import maintenance, upkeep
from .sources import messages
from .sources.lake import LakeTable, SnapshotExpired
from .streaming import config, gauges, include, service
from .streaming.ingest import LakeSink, Steps, ingest

# a polled allowlist, in SQL by recursion over the polls -----------------------------------

_STEP = """
WITH RECURSIVE e AS (SELECT {polls} FROM events),
p AS (SELECT set, seq, row_number() OVER (PARTITION BY set ORDER BY seq) AS i, coalesce(list(DISTINCT value::BIGINT) FILTER (value IS NOT NULL), []) AS polled FROM e GROUP BY set, seq),
st AS (
  SELECT set, 0::BIGINT AS i, 0::BIGINT AS seq, [{{'v': 0::BIGINT, 'n': 0::BIGINT}}, {{'v': 1::BIGINT, 'n': 0::BIGINT}}, {{'v': 2::BIGINT, 'n': 0::BIGINT}}, {{'v': 3::BIGINT, 'n': 0::BIGINT}}] AS held,
    0::BIGINT AS added, 0::BIGINT AS removed, NULL::VARCHAR AS refused FROM (SELECT DISTINCT set FROM p)
  UNION ALL
  SELECT set, i, seq,
    CASE WHEN why = 'empty' THEN held WHEN why = 'bulk_removal' THEN list_concat(held, fresh) ELSE list_concat(list_filter(counted, lambda x: x.n < 3), fresh) END,
    CASE WHEN why = 'empty' THEN 0 ELSE len(fresh) END::BIGINT, CASE WHEN why IS NULL THEN gone ELSE 0 END::BIGINT, why
  FROM (
    SELECT *, CASE WHEN len(polled) = 0 AND len(list_filter(held, lambda x: x.v <> 0)) > 0 THEN 'empty' WHEN gone = len(held) AND len(fresh) = 0 THEN 'empty'
        WHEN governed > 1 AND gone > greatest(1, governed // 2) THEN 'bulk_removal' END AS why
    FROM (SELECT *, len(list_filter(counted, lambda x: x.n >= 3)) AS gone FROM (
      SELECT st.set, p.i, p.seq, st.held, p.polled,
        list_transform(list_filter(p.polled, lambda y: NOT list_contains(list_transform(st.held, lambda h: h.v), y)), lambda y: {{'v': y, 'n': 0::BIGINT}}) AS fresh,
        list_transform(st.held, lambda x: {{'v': x.v, 'n': CASE WHEN x.v = 0 OR list_contains(p.polled, x.v) THEN 0::BIGINT ELSE x.n + 1 END}}) AS counted,
        len(list_filter(st.held, lambda x: x.v <> 0 OR list_contains(p.polled, x.v))) AS governed
      FROM st JOIN p ON p.set = st.set AND p.i = st.i + 1))))
SELECT set, seq, len(held)::BIGINT AS served, added, removed, refused FROM st WHERE i > 0"""


@query(_STEP.format(polls=", ".join(POLLS)))
def include_replay(spark, sf_dir):
    return include.replay(_events(spark, sf_dir, *POLLS), [1, 2, 3], [0], 3)


# partition values of any kind --------------------------------------------------------------

_ODD = (
    "CASE event_id % 12 WHEN 0 THEN 'a b' WHEN 1 THEN 'a%b' WHEN 2 THEN 'x:y' WHEN 3 THEN 'p/q' WHEN 4 THEN 'a=b' WHEN 5 THEN 'ü+ß' WHEN 6 THEN '' WHEN 7 THEN NULL "
    "WHEN 8 THEN '_' WHEN 9 THEN '__HIVE_DEFAULT_PARTITION__' WHEN 10 THEN repeat('long ', 60) ELSE '[x]*?{y}' END"
)


@query(f"SELECT kind, count(*) AS n, sum(event_id)::BIGINT AS ids, true AS pruned FROM (SELECT event_id, {_ODD} AS kind FROM events) GROUP BY kind")
def odd_partition_values(spark, sf_dir):
    """Values with blanks, separators, escapes, no characters or too many: appended, merged, expired, read and pruned by."""
    t = _lake(spark, _events(spark, sf_dir, "event_id", f"{_ODD} AS kind"), "kind")
    maintenance.compact(t)
    maintenance.expire(t)
    files = t.snapshot().files.values()
    kinds = {r["kind"] for r in t.read().select("kind").distinct().collect()}  # twelve
    one = all({r["kind"] for r in t.read(keep_file=lambda f, k=k: f["values"] == [k]).select("kind").distinct().collect()} == {k} for k in kinds)
    pruned = one and {f["values"][0] for f in files} == kinds
    return t.read().groupBy("kind").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).withColumn("pruned", F.lit(pruned))


# commits -----------------------------------------------------------------------------------


def _between(t: LakeTable, act) -> None:
    """Has ``act`` run once between the staging of ``t``'s next append and its commit."""
    stage = t._stage

    def staged(*a):
        out = stage(*a)
        t._stage = stage
        act()
        return out

    t._stage = staged


@query("SELECT count(*) AS n, sum(user_id)::BIGINT AS users, 1::BIGINT AS rebased, 1::BIGINT AS rebuilt FROM events")
def crossed_appends(spark, sf_dir):
    """Crossed by an append, staged files are committed as they are; crossed by a new column, the batch is written anew."""
    df = _events(spark, sf_dir, "event_id", "user_id")
    part = lambda i: df.where(F.col("event_id") % 4 == i)
    t, other = (LakeTable(spark, root) for root in [_scratch(spark)] * 2)
    t.create(df.schema)
    _between(t, lambda: other.append(part(1), "b"))
    t.append(part(0), "a")
    _between(t, lambda: other.append(part(3).withColumn("extra", F.lit(1)), "d"))
    t.append(part(2), "c")
    out = t.read().agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
    return out.select("*", *[F.lit(t.counts[k]).cast("long").alias(k) for k in ("rebased", "rebuilt")])


@query("SELECT count(*) AS n, 3::BIGINT AS expired, true AS refused, count(*) FILTER (event_id % 4 < 3) AS kept, 0::BIGINT AS again FROM events")
def expired_versions(spark, sf_dir):
    """Expired versions refuse by name, kept ones read, and a second run has nothing to delete."""
    df = _events(spark, sf_dir, "event_id", "user_id")
    t = _lake(spark, df, parts=4)
    before = t.snapshot().version
    maintenance.compact(t)
    maintenance.expire(t, keep_last=3)
    oldest, refused = t.snapshot().oldest, False
    try:
        t.read(oldest - 1)
    except SnapshotExpired:
        refused = True
    kept = t.read(before - 1).count()
    again = len(maintenance.expire(t, keep_last=3))
    got = t.read().agg(F.count("*").alias("n"))
    return got.select("n", F.lit(oldest).cast("long").alias("expired"), F.lit(refused).alias("refused"), F.lit(kept).cast("long").alias("kept"), F.lit(again).cast("long").alias("again"))


@query(
    "SELECT * FROM (SELECT 'event_id' AS name, 'bigint' AS kind, count(*) AS n FROM events UNION ALL SELECT 'n', 'bigint', count(*) FILTER (event_id % 3 <> 2) FROM events "
    "UNION ALL SELECT 'extra', 'double', count(*) FILTER (event_id % 3 = 1) FROM events)"
)
def schema_evolution_plan(spark, sf_dir):
    """A table whose columns are added and widened as batches come; names that are unsafe and types that only narrow are left out."""
    df = _events(spark, sf_dir, "event_id", "cast(event_id % 100 AS int) AS n")
    t = LakeTable(spark, _scratch(spark))
    t.append(df.where("event_id % 3 = 0"), "a")
    t.append(df.where("event_id % 3 = 1").selectExpr("event_id", "cast(n AS bigint) AS n", "cast(n AS double) AS extra", "1 AS `bad-name`"), "b")
    t.append(df.where("event_id % 3 = 2").selectExpr("event_id", "n = 1 AS extra"), "c")
    rows = t.read().drop("_inserted_at")
    found = rows.agg(*[F.count(F.when(F.lit(c != "extra") | (F.col("event_id") % 3 == 1), F.col(c))).alias(c) for c in rows.columns])
    kinds = dict(rows.dtypes)
    return found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.lit(kinds[c]).alias("kind"), F.col(c).alias("n")) for c in rows.columns])))


# ingest ------------------------------------------------------------------------------------


def _quarter(spark, root: str) -> int:
    """A fourth of the log's bytes."""
    return maintenance.listing(spark, f"{root}/events").agg(F.sum("bytes")).first()[0] // 4


def _flow(spark, root: str, name: str, steps: Steps, flush_bytes: int, at: str):
    log = messages.read(spark, root, "events", stream=True, flush_bytes=flush_bytes)
    text = log.selectExpr("offset * 8 + partition AS seq", "value")
    return ingest(spark, text, LakeSink(LakeTable(spark, f"{root}/table")), steps, f"{root}/{at}", name=name, flush_bytes=flush_bytes)


_TYPED = f"CASE WHEN event_id % 13 = 0 THEN '{{bad' ELSE concat('{{\"id\":', cast(event_id AS string), CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(',\"kind\":\"', event_type, '\"') END, '}}') END"


def _typed_log(spark, sf_dir) -> str:
    root = _scratch(spark)
    messages.append(_events(spark, sf_dir, "cast(event_id % 8 AS int) AS partition", "cast(floor(event_id / 8) AS bigint) AS offset", f"{_TYPED} AS value"), root, "events", segment=50)
    return root


@query(
    f"SELECT count(*) AS consumed, sum(strlen(v))::BIGINT AS bytes, count(*) FILTER (event_id % 13 = 0) AS json_parse, count(*) FILTER (event_id % 13 <> 0 AND event_id % 7 = 0) AS filter_field_missing, "
    "count(*) FILTER (event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_type NOT IN ('click', 'view', 'error')) AS filter_excluded, count(*) FILTER (event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_type = 'error') AS filter_dropped, "
    f"count(*) FILTER (event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_type IN ('click', 'view')) AS written FROM (SELECT *, {_TYPED} AS v FROM events)"
)
def ingest_counters(spark, sf_dir):
    """What the writing pass of each batch counts: consumed, skipped by reason, written."""
    root = _typed_log(spark, sf_dir)
    c = _flow(spark, root, "counted", Steps(keep=("kind", ["click", "view", "error"]), drop=("kind", ["error"])), _quarter(spark, root), "checkpoint")
    got = {"consumed": c.consumed, "bytes": c.bytes, "written": c.written} | {k: c.skipped.get(k, 0) for k in ("json_parse", "filter_field_missing", "filter_excluded", "filter_dropped")}
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} long" for k in got))


def _id_log(spark, sf_dir) -> str:
    root = _scratch(spark)
    value = "concat('{\"p\":', cast(event_id % 8 AS string), ',\"id\":', cast(event_id AS string), '}') AS value"
    messages.append(_events(spark, sf_dir, *OFFSETS, value), root, "events", segment=50)
    return root


@query("SELECT count(*) AS written, 1::BIGINT AS final, true AS by_size, true AS each_counted FROM events")
def flush_triggers(spark, sf_dir):
    """A stream in batches that end by size, and one by the end of what there is; every batch has one reason."""
    root = _id_log(spark, sf_dir)
    c = _flow(spark, root, "sized", Steps(), _quarter(spark, root), "checkpoint")
    row = (c.written, c.flushes.get("final", 0), c.flushes.get("size", 0) > 1, sum(c.flushes.values()) == c.batches == sum(c.shape.values()))
    return spark.createDataFrame([row], "written long, final long, by_size boolean, each_counted boolean")


@query("SELECT (event_id % 8)::INT AS partition, 2 * count(*) AS n FROM events GROUP BY 1")
def ingest_of_two_checkpoints(spark, sf_dir):
    """Two streams of one name into one table: both arrive, and neither arrives again when it is run again."""
    root = _id_log(spark, sf_dir)
    for at in ("one", "two", "one", "two"):
        _flow(spark, root, "same", Steps(), 1 << 30, at)
    return LakeTable(spark, f"{root}/table").read().groupBy(F.col("p").cast("int").alias("partition")).agg(F.count("*").alias("n"))


_RATIO = "CASE event_id % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity' ELSE cast(event_id AS string) || '.5' END"


@query(f"SELECT event_id AS seq, CASE WHEN event_id % 5 > 0 THEN ({_RATIO})::DOUBLE END AS ratio, event_id % 5 = 0 AS is_nan, {_RATIO} AS text, 'is NaN, \"Infinity' AS note FROM events")
def non_finite_messages(spark, sf_dir):
    """NaN and the infinities outside of strings are numbers, inside of strings they stay text."""
    ratio = f"coalesce({_RATIO}, 'null')"
    value = f"""concat('{{"ratio":', {ratio}, ',"text": ', {ratio}, ',"note":"is NaN, \\\\"Infinity"}}') AS value"""
    rows = infer.convert(_events(spark, sf_dir, "event_id AS seq", value), "seq", json_text=["text"], non_finite=True)
    nan = F.when(F.col("ratio").isNotNull(), F.isnan("ratio"))
    # as in the SQL, ids below zero have their ratio in the text only
    return rows.select("seq", F.when(F.col("seq") % 5 > 0, F.col("ratio")).alias("ratio"), nan.alias("is_nan"), "text", "note")


# services by their settings ----------------------------------------------------------------

_SERVED = "concat('{\"id\":', cast(event_id AS string), ',\"u\":\"', cast(user_id AS string), '\",\"kind\":\"', event_type, '\",\"tags\":{\"k\":', cast(event_id % 3 AS string), '},\"note\":', CASE WHEN event_id % 4 = 0 THEN '\"{bad\"' ELSE concat('[', cast(event_id % 4 AS string), ']') END, '}') AS value"


def _served_log(spark, sf_dir, where: str = "true") -> str:
    root = _scratch(spark)
    messages.append(_events(spark, sf_dir, *OFFSETS, "event_id", _SERVED).where(where), root, "events", segment=50)
    return root


@query(
    "SELECT event_type AS kind, count(*) AS n, sum(user_id)::BIGINT AS users, sum(event_id % 3)::BIGINT AS tags, (sum(event_id % 4) FILTER (event_id % 4 > 0))::BIGINT AS notes, true AS laid_out "
    "FROM events WHERE event_type IN ('click', 'view', 'error') AND event_id % 8 <> 3 AND NOT (user_id = 7) GROUP BY 1"
)
def service_from_settings(spark, sf_dir):
    """Two replicas of a group, from settings alone: pinned, kept by static and polled values, filtered, with VARIANTs, partitioned and sorted.

    A partition that no replica has any more (its folder is gone) is missing in the table.
    """
    root = _served_log(spark, sf_dir, "event_id % 8 <> 3")
    spark.range(1).selectExpr("'[\"view\", \"error\"]' AS value").coalesce(1).write.text(f"{root}/polled")
    env = {
        "KEEP_FIELD": "kind", "KEEP_VALUES": "click", "INCLUDE_URL": f"{root}/polled", "DROP_FIELD": "u", "DROP_VALUES": "7", "TYPED_COLUMNS": "u:bigint", "VARIANT_COLUMNS": "tags",
        "DECLARED_VARIANTS": "note", "PARTITION_BY": "kind", "SORT_COLUMNS": "u", "GROUP_ID": "readers", "REPLICAS": "2",
    }
    for host in ("ingest-0", "ingest-1", "ingest-0"):
        service.run(spark, config.load(env | {"HOSTNAME": host}), root, "events", f"{root}/table", f"{root}/state")
    t = LakeTable(spark, f"{root}/table")
    s = t.snapshot()
    laid_out = s.spec == "kind" and s.sort == ("u",) and all(len(f["values"]) == 1 for f in s.files.values())
    note = F.try_variant_get("note", "$[0]", "bigint")
    out = t.read().groupBy("kind").agg(F.count("*").alias("n"), F.sum("u").alias("users"), F.sum(F.try_variant_get("tags_variant", "$.k", "bigint")).alias("tags"), F.sum(note).alias("notes"))
    return out.withColumn("laid_out", F.lit(laid_out))


@query("SELECT count(*) AS n, sum(event_id)::BIGINT AS ids, 0::BIGINT AS before FROM events WHERE event_id >= (SELECT (max(event_id) // 16) * 8 FROM events)")
def service_from_latest(spark, sf_dir):
    """A group that starts at the end of the log gets what comes after, and keeps its place whatever it is told later."""
    half = _events(spark, sf_dir, "event_id").agg(F.max("event_id")).first()[0] // 16 * 8
    root = _served_log(spark, sf_dir, f"event_id < {half}")
    go = lambda reset: service.run(spark, config.load({"OFFSET_RESET": reset}), root, "events", f"{root}/table", f"{root}/state")
    before = go("latest").written
    messages.append(_events(spark, sf_dir, *OFFSETS, "event_id", _SERVED).where(f"event_id >= {half}"), root, "events", segment=50)
    go("latest")
    go("earliest")
    return LakeTable(spark, f"{root}/table").read().agg(F.count("*").alias("n"), F.sum("id").alias("ids")).withColumn("before", F.lit(before).cast("long"))


@query("SELECT event_type AS kind, count(*) AS n, sum(event_id)::BIGINT AS ids, true AS whole FROM events WHERE event_type <> 'error' GROUP BY 1")
def service_to_log(spark, sf_dir):
    """From one log to another, filtered: a group that runs again adds nothing, and offsets have no gaps."""
    root = _served_log(spark, sf_dir)
    c = config.load({"DESTINATION": "log", "GROUP_ID": "relay", "DROP_FIELD": "kind", "DROP_VALUES": "error", "FLUSH_BYTES": str(_quarter(spark, root))})
    for _ in range(2):
        service.run(spark, c, root, "events", f"{root}/kept", f"{root}/state")
    kept = messages.read(spark, root, "kept")
    gaps = kept.groupBy("partition").agg((F.max("offset") + 1 - F.count("*")).alias("gap"), (F.count("*") - F.count_distinct("offset")).alias("twice"))
    whole = gaps.where("gap <> 0 OR twice <> 0").isEmpty()
    rows = kept.select(F.from_json("value", "kind string, id long").alias("r")).groupBy("r.kind").agg(F.count("*").alias("n"), F.sum("r.id").alias("ids"))
    return rows.withColumn("whole", F.lit(whole))


# maintenance -------------------------------------------------------------------------------


@query(_WITH + f"SELECT count(*) - count(DISTINCT path) AS duplicates, (SELECT count(*) FROM scheduled WHERE CASE WHEN path_is_relative THEN 's3://lake/' || path ELSE path END NOT IN ({_LISTING})) AS missing FROM scheduled")
def sql_macros(spark, sf_dir):
    """A scalar and a table function of the catalog, called from SQL text."""
    macros.register(catalog(spark, sf_dir), spark.sql(_LISTING))
    return spark.sql("SELECT pending_duplicates() AS duplicates, (SELECT count(*) FROM missing_files('s3://lake/')) AS missing")


@query(f"SELECT kind, count(*) AS n, true AS repaired, 'CorruptFile' AS other FROM (SELECT event_id, {MAYBE_TYPE} AS kind FROM events) GROUP BY kind")
def partition_repair_applied(spark, sf_dir):
    """Values that were lost from the log come back from the files' rows; a table that cannot be repaired leaves the other alone."""
    df = _events(spark, sf_dir, "event_id", f"{MAYBE_TYPE} AS kind")
    good, bad = _lake(spark, df, "kind", 2), _lake(spark, df, "kind", 2)
    right = {p: f["values"] for p, f in good.snapshot().files.items()}
    good.change(lambda s: {"values": {p: ([] if i % 2 else [None]) for i, p in enumerate(sorted(s.files))}})
    # one that has another number of rows than its file
    bad.change(lambda s: {"remove": [p := min(s.files)], "add": [s.files[p] | {"rows": 1 + s.files[p]["rows"], "values": []}]})
    changed, failed = maintenance.repair_all({"good": good, "bad": bad})
    repaired = {p: f["values"] for p, f in good.snapshot().files.items()} == right and changed["good"] > 1
    out = good.read().groupBy("kind").agg(F.count("*").alias("n"))
    return out.select("*", F.lit(repaired).alias("repaired"), F.lit(failed["bad"].split(":")[0]).alias("other"))


def _cuts(spark, sf_dir) -> tuple[datetime.datetime, datetime.datetime]:
    """Cutoff and floor: eight and six days after the first event's day."""
    first = table(spark, sf_dir, "events").agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("t")).first()["t"]
    return first + datetime.timedelta(days=8), first + datetime.timedelta(days=6)


_DAY0 = "(SELECT date_trunc('day', min(ts)) FROM events)"


@query(
    f"SELECT state, count(*) AS leaves, sum(n)::BIGINT AS rows FROM (SELECT leaf, CASE WHEN leaf IS NULL THEN 'rot' WHEN leaf + INTERVAL 1 HOUR > {_DAY0} + INTERVAL 8 DAY THEN 'floor' WHEN leaf + INTERVAL 1 HOUR > {_DAY0} + INTERVAL 6 DAY THEN 'young' ELSE 'droppable' END AS state, count(*) AS n "
    "FROM (SELECT CASE WHEN event_id % 10 <> 0 THEN date_trunc('hour', ts) END AS leaf FROM events) GROUP BY 1) GROUP BY 1"
)
def leaves_by_hour(spark, sf_dir):
    """Leaves of an hour spec by what retention may do with them."""
    floor, cut = _cuts(spark, sf_dir)
    t = _lake(spark, table(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 10 <> 0 THEN cast(ts AS timestamp) END AS ts"), "hour(ts)", 1)
    return maintenance.leaves(t, "ts", cut, floor).groupBy("state").agg(F.count("*").alias("leaves"), F.sum("rows").alias("rows"))


@query(
    f"SELECT state, count(*) AS leaves, sum(n)::BIGINT AS rows FROM (SELECT y, m, d, CASE WHEN d = 31 THEN 'rot' WHEN make_date(y, m, d) + INTERVAL 1 DAY > {_DAY0} + INTERVAL 8 DAY THEN 'young' ELSE 'droppable' END AS state, count(*) AS n "
    "FROM (SELECT 2024 AS y, 2 AS m, CASE WHEN event_id % 20 = 0 THEN 31 ELSE 1 + event_id % 28 END AS d FROM events) GROUP BY 1, 2, 3) GROUP BY 1"
)
def leaves_by_calendar(spark, sf_dir):
    """Leaves of identity columns year, month and day; one is no day."""
    cut, _ = _cuts(spark, sf_dir)
    rows = _events(spark, sf_dir, "event_id", "2024 AS year", "2 AS month", "CASE WHEN event_id % 20 = 0 THEN 31 ELSE cast(1 + event_id % 28 AS int) END AS day")
    t = _lake(spark, rows, "year, month, day", 1)
    return maintenance.leaves(t, "ts", cut).groupBy("state").agg(F.count("*").alias("leaves"), F.sum("rows").alias("rows"))


@query(
    f"SELECT count(*) FILTER (ts >= {_DAY0} + INTERVAL 8 DAY) AS left_over, count(*) FILTER (ts < {_DAY0} + INTERVAL 8 DAY) AS dropped, count(DISTINCT date_trunc('hour', ts)) FILTER (ts < {_DAY0} + INTERVAL 8 DAY) AS commits, 0::BIGINT AS dry FROM events"
)
def leaves_dropped(spark, sf_dir):
    """Leaf by leaf, a commit each that carries what it took away; a dry run before changes nothing."""
    cut, _ = _cuts(spark, sf_dir)
    t = _lake(spark, table(spark, sf_dir, "events").selectExpr("event_id", "cast(ts AS timestamp) AS ts"), "hour(ts)", 1)
    before = t.snapshot().version
    planned = maintenance.drop_leaves(t, "ts", cut)
    dry = t.snapshot().version - before
    went = maintenance.drop_leaves(t, "ts", cut, dry_run=False)
    carried = [c["dropped"] for c in t.commits() if "dropped" in c]
    same = planned == went == carried
    row = (sum(x["rows"] for x in went) if same else -1, len(carried), dry)
    extra = [F.lit(v).cast("long").alias(n) for v, n in zip(row, ("dropped", "commits", "dry"))]
    return t.read().agg(F.count("*").alias("left_over")).select("left_over", *extra)


@query(_WITH + "SELECT count(*) AS dropped, true AS halved, true AS grown FROM inlined i WHERE NOT EXISTS (SELECT 1 FROM lake_table t, (SELECT min(snapshot_id) AS lo, max(snapshot_id) AS hi FROM snapshot) WHERE t.table_id = i.table_id AND begin_snapshot <= hi AND (end_snapshot IS NULL OR end_snapshot > lo))")
def inlined_dropped(spark, sf_dir):
    """Inline tables dropped in pages; batches halve while the store is short of locks and grow again."""
    c = catalog(spark, sf_dir)
    c.inlined = c.inlined.withColumn("table_name", F.concat(F.lit("t_"), F.col("schema_version").cast("string")))
    calls = 0

    def drop(some: list[tuple]) -> None:
        nonlocal calls
        calls += 1
        if calls == 1:
            raise RuntimeError("out of locks")

    dropped, tried, first, most = 0, 0, [], 0
    for went, sizes in maintenance.inlined_drops(c, drop, page=400, batch=8):
        rest = sizes[2 - len(first) :]
        first += sizes[: 2 - len(first)]
        dropped, tried, most = dropped + len(went), tried + len(sizes), max([most, *rest])
    row = (dropped, first[1] == first[0] // 2 if tried > 1 else True, tried < 12 or most > first[1])
    return spark.createDataFrame([row], "dropped long, halved boolean, grown boolean")


@query("SELECT 'missing' AS finding, 1::BIGINT AS n, count(*) AS rows FROM events UNION ALL SELECT 'stray', 1, count(*) FROM events UNION ALL SELECT 'values', 1, count(*) FROM events UNION ALL SELECT 'queued_gone', 1, count(*) FROM events")
def fsck_findings(spark, sf_dir):
    """A table with one fault of each kind, checked, mended as far as a run can, and read where it is whole."""
    df = _events(spark, sf_dir, "event_id", "event_id % 2 AS half")
    t = _lake(spark, df, "half", 3)
    maintenance.compact(t)
    maintenance.expire(t, purge=False)
    t.delete_files([min(t.snapshot().queue)])
    spark.range(3).coalesce(1).write.parquet(f"{t.root}/data/stray")
    first = min(t.snapshot().files)
    t.change(lambda s: {"values": {first: []}})
    lost = {"path": "data/none.parquet", "bytes": 1, "rows": 0, "values": ["0"], "stats": {}}
    t.change(lambda s: {"add": [lost]})
    soon = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    found = upkeep.fsck(t, soon, dry_run=False)
    left = {r["finding"] for r in upkeep.findings(t).collect()}
    rows = t.read(keep_file=lambda f: f["path"] != lost["path"]).count() if left == {"missing"} and t.snapshot().files[first]["values"] else -1
    return spark.createDataFrame([(k, n, rows) for k, n in found.items()], "finding string, n long, rows long")


@query("SELECT count(*) AS n, 5::BIGINT AS steps, true AS whole FROM events")
def maintenance_run(spark, sf_dir):
    """All steps of upkeep in one run, after which nothing is found and all rows are there."""
    t = _lake(spark, _events(spark, sf_dir, "event_id", "user_id", "event_type"), "event_type", 4)
    done = upkeep.maintain(t, keep_last=2, older_than=F.current_timestamp() + F.expr("INTERVAL 1 HOUR"))
    whole = all(error is None for _, _, error in done) and upkeep.findings(t).isEmpty()
    return t.read().agg(F.count("*").alias("n")).select("n", F.lit(len(done)).cast("long").alias("steps"), F.lit(whole).alias("whole"))


_PARTS = "SELECT (event_id % 8)::INT AS p, floor(event_id / 8)::BIGINT AS o FROM events"


@query(
    f"SELECT 'consumer_lag' AS metric, p::VARCHAR AS partition, (max(o) + 1 - CASE WHEN p < 5 THEN p * 20 ELSE min(o) END)::DOUBLE AS value FROM ({_PARTS}) GROUP BY p "
    f"UNION ALL SELECT DISTINCT 'last_committed_offset', p::VARCHAR, (p * 20 - 1)::DOUBLE FROM ({_PARTS}) WHERE p < 5"
)
def position_gauges(spark, sf_dir):
    """Lag and committed offset of each partition of a message log; three partitions have no position yet."""
    marks = messages.watermarks(spark, _id_log(spark, sf_dir), "events")
    done = spark.range(5).select(F.col("id").cast("int").alias("partition"), (F.col("id") * 20).alias("position"))
    return gauges.positions(marks, done).select("metric", F.col("labels")["partition"].alias("partition"), "value")
