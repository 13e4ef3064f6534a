"""Maintenance plans: expiry, orphans, repair, compaction, retention, all as DataFrames.

The plans in the first part only read; the second part applies them to a lake table.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .catalog import MIB, Catalog
from .metrics import live, mergeable, unreachable_inlined, with_partition

TIERS = (("tier0", 0, MIB), ("tier1", MIB, 10 * MIB), ("tier2", 10 * MIB, 64 * MIB))
TARGET = 128 * MIB
FLOOR_DAYS = 7
#: Snapshot ids that share a row in the rank table.
RANK_WIDTH = 1024


def absolute(path: Column, relative: Column, root: str) -> Column:
    """A path with its root, so that orphans are found by equality instead of by alternatives."""
    base = root.rstrip("/")
    return F.when(relative, F.concat(F.lit(base + "/"), path)).otherwise(path)


def dedup_queue(c: Catalog) -> DataFrame:
    """One row per queued path, the one of the lowest id; a null id comes after all."""
    return c.scheduled.groupBy("path").agg(F.min("data_file_id").alias("data_file_id"), (F.count("*") - 1).alias("dropped"))


def orphans(c: Catalog, listing: DataFrame, root: str) -> DataFrame:
    """Queued files that the listing (``path``) lacks."""
    queued = c.scheduled.withColumn("full", absolute(F.col("path"), F.col("path_is_relative"), root))
    return queued.join(listing.select(F.col("path").alias("full")).distinct(), "full", "left_anti").select("data_file_id", F.col("full").alias("path"))


def heal_gates(c: Catalog, found: DataFrame) -> DataFrame:
    """One row: may the orphans be dropped from the queue?  Nothing live may be among them."""
    files = live(c.data_file).select("data_file_id")
    ids = found.select("data_file_id").where(F.col("data_file_id").isNotNull()).distinct()
    a = files.agg(F.count("*").alias("live_files"))
    b = ids.join(files, "data_file_id", "left_semi").agg(F.count("*").alias("orphan_live"))
    d = ids.join(live(c.delete_file).select("data_file_id"), "data_file_id", "left_semi").agg(F.count("*").alias("orphan_deletes"))
    one = a.crossJoin(b).crossJoin(d)
    return one.withColumn("may_heal", (F.col("live_files") > 0) & (F.col("orphan_live") == 0) & (F.col("orphan_deletes") == 0))


def orphan_stats(c: Catalog) -> DataFrame:
    """Statistics of tables that are not live; a null key is one of them."""
    return c.table_stats.join(live(c.lake_table).select("table_id").distinct(), "table_id", "left_anti")


def expirable(c: Catalog, before: Column) -> DataFrame:
    """Snapshots older than ``before``, but never the newest."""
    head = F.broadcast(c.snapshot.agg(F.max("snapshot_id").alias("head")))
    return c.snapshot.where(F.col("snapshot_time") < before).crossJoin(head).where(F.col("snapshot_id") < F.col("head")).select("snapshot_id")


def _ranked(values: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``values`` with ``rank``: how many of ``ids(id)`` are below ``column``.

    Ids are kept in rows of RANK_WIDTH, so the join is an equality on the row's number
    and a search in a short array.
    """
    slot = lambda x: F.floor(x / F.lit(RANK_WIDTH)).cast("long")
    rows = ids.groupBy(slot(F.col("id")).alias("slot")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = values.select(slot(F.col(column)).alias("slot")).distinct()
    both = rows.join(asked, "slot", "full_outer").withColumn("n", F.coalesce(F.size("ids"), F.lit(0)))
    # prefix sums in two steps: inside runs of RANK_WIDTH slots, and over the runs, of which there is one row a million ids
    both = both.withColumn("run", slot(F.col("slot")))
    runs = both.groupBy("run").agg(F.sum("n").alias("run_n"))
    upto = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("run", F.coalesce(F.sum("run_n").over(upto), F.lit(0)).alias("run_before"))
    before = Window.partitionBy("run").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    table = both.withColumn("inner_before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(runs, "run")
    table = table.select("slot", "ids", (F.col("run_before") + F.col("inner_before")).alias("before"))
    out = values.withColumn("slot", slot(F.col(column))).join(table, "slot", "left")
    inside = F.when(F.col("ids").isNotNull(), F.size(F.filter("ids", lambda x: x < F.col(column)))).otherwise(0)
    return out.withColumn("rank", F.col("before") + inside).drop("slot", "ids", "before")


def dead_files(c: Catalog, expired: DataFrame) -> DataFrame:
    """Files that no retained snapshot sees: their end is expired and none lies in [begin, end)."""
    gone = expired.select("snapshot_id").distinct()
    retained = c.snapshot.join(gone, "snapshot_id", "left_anti").select(F.col("snapshot_id").alias("id"))
    files = c.data_file.where(F.col("end_snapshot").isNotNull())
    files = files.join(gone.withColumnRenamed("snapshot_id", "end_snapshot"), "end_snapshot", "left_semi")
    # both ends of a file are ranked in one pass; it is dead if they have the same rank
    files = files.select("data_file_id", "begin_snapshot", "end_snapshot", F.explode(F.array("begin_snapshot", "end_snapshot")).alias("at"))
    ranked = _ranked(files, "at", retained).groupBy("data_file_id", "begin_snapshot", "end_snapshot").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    return ranked.where(F.col("lo") == F.col("hi")).select("data_file_id", "begin_snapshot", "end_snapshot")


def compaction_backlog(c: Catalog) -> DataFrame:
    """Tables with partitions of two or more small files, most files first."""
    per = mergeable(c).groupBy("table_id").agg(F.sum("n").cast("long").alias("files"), F.sum("size").cast("long").alias("bytes"), F.count("*").alias("groups"))
    named = per.join(live(c.lake_table).select("table_id", "table_name"), "table_id")
    # one row a table with something to merge: a short list, numbered as a run takes it on
    order = Window.orderBy(F.desc("files"), "table_name", "table_id")
    return named.withColumn("place", F.row_number().over(order).cast("long")).orderBy("place")


def tier(size: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, lo, hi in reversed(TIERS):
        out = F.when((size >= lo) & (size < hi), name).otherwise(out)
    return out


def binned(c: Catalog, target: int = TARGET) -> DataFrame:
    """Small live files without live deletes, with ``partition, tier, bin``."""
    deleted = live(c.delete_file).select("data_file_id").distinct()
    files = live(c.data_file).join(deleted, "data_file_id", "left_anti")
    files = files.withColumn("tier", tier(F.col("file_size_bytes"))).where(F.col("tier").isNotNull())
    files = with_partition(c, files)
    run = Window.partitionBy("table_id", "partition", "tier").orderBy("data_file_id", "path").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("bin", F.floor(F.coalesce(F.sum("file_size_bytes").over(run), F.lit(0)) / F.lit(target)).cast("long"))


def compaction_bins(c: Catalog, target: int = TARGET) -> DataFrame:
    """``table_id, partition, tier, bin, files, bytes``: runs of files that make one output of about ``target``."""
    out = binned(c, target).groupBy("table_id", "partition", "tier", "bin").agg(F.count("*").alias("files"), F.sum("file_size_bytes").cast("long").alias("bytes"))
    return out.where(F.col("files") >= 2)


def within_budget(bins: DataFrame, budget: int, outputs: int) -> DataFrame:
    """Bins that one run takes on: at most ``outputs``, inputs within ``budget``, half of it for one table."""
    own = Window.partitionBy("table_id").orderBy(F.desc("files"), "partition", "tier", "bin")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fair = bins.withColumn("own", F.sum("bytes").over(upto)).where(F.col("own") <= budget // 2)
    # what is left fits one run, so the order over all of it is short
    order = Window.orderBy(F.desc("files"), "table_id", "partition", "tier", "bin")
    fair = fair.orderBy(F.desc("files"), "table_id", "partition", "tier", "bin").limit(outputs)
    return fair.withColumn("all", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(F.col("all") <= budget).drop("own", "all")


def partition_rot(c: Catalog) -> DataFrame:
    """Files whose partition values are not exactly the indices 0..n-1, each with a value, of their spec.

    The spec's width is the largest index of the table plus one.
    """
    width = c.file_partition_value.groupBy("table_id").agg((F.max("partition_key_index") + 1).alias("width"))
    per = c.file_partition_value.groupBy("data_file_id", "table_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("partition_value").isNotNull(), F.col("partition_key_index")))).alias("have"),
        F.bool_or(F.col("partition_value").isNull()).alias("has_null"),
    ).join(width, "table_id")
    want = F.sequence(F.lit(0).cast("long"), F.col("width") - 1)
    return per.where(F.col("has_null") | ~F.col("have").eqNullSafe(want)).select("data_file_id", "table_id", "has_null", F.size("have").cast("long").alias("values"))


def by_path(c: Catalog, like: str | None = None, pattern: str | None = None) -> DataFrame:
    """Live data files whose path fits a LIKE and a regular expression, where given."""
    files = live(c.data_file)
    if like is not None:
        files = files.where(F.col("path").like(like))
    return files if pattern is None else files.where(F.col("path").rlike(pattern))


def repaired_values(paths: DataFrame, names: list[str]) -> DataFrame:
    """Partition values read from ``path`` folders ``name=value``, as ``data_file_id, partition_key_index, partition_value``."""
    found = [F.nullif(F.regexp_extract("path", f"(?:^|/){n}=([^/]*)/", 1), F.lit("")) for n in names]
    rows = paths.select("data_file_id", F.posexplode(F.array(*found)).alias("partition_key_index", "partition_value"))
    return rows.withColumn("partition_key_index", F.col("partition_key_index").cast("long"))


def leaf_time(y: Column, m: Column, d: Column, h: Column) -> Column:
    """Instant of a calendar leaf; null where there is no such hour."""
    n = [x.try_cast("int") for x in (y, m, d, h)]
    return F.try_make_timestamp(n[0], n[1], n[2], n[3], F.lit(0), F.lit(0).cast("decimal(16,6)"))


def retention_cutoff(now: Column, days: int, grain: str = "hour") -> Column:
    """Start of the grain that lies ``days`` back; never within the last week."""
    return F.date_trunc(grain, now - F.make_dt_interval(F.lit(max(days, FLOOR_DAYS))))


def droppable(c: Catalog, time_index: list[int], cutoff: Column) -> DataFrame:
    """``table_id, leaf, files, bytes, rows`` of partitions wholly before ``cutoff``, oldest first.

    ``time_index``: key indices of year, month, day and hour.  A leaf that is no
    instant stays, and so does one that ends after the cutoff.
    """
    wide = c.file_partition_value.groupBy("data_file_id", "table_id").pivot("partition_key_index", time_index).agg(F.max("partition_value"))
    at = leaf_time(*[F.col(f"`{i}`") for i in time_index])
    old = wide.withColumn("leaf", at).where(F.col("leaf").isNotNull() & (F.col("leaf") + F.expr("INTERVAL 1 HOUR") <= cutoff))
    files = live(c.data_file).join(old.select("data_file_id", "table_id", "leaf"), ["data_file_id", "table_id"])
    return files.groupBy("table_id", "leaf").agg(F.count("*").alias("files"), F.sum("file_size_bytes").cast("long").alias("bytes"), F.sum("record_count").cast("long").alias("rows")).orderBy("leaf", "table_id")


def cursor_guard(leaves: DataFrame, cursors: DataFrame) -> DataFrame:
    """Leaves that every reader has passed: ``cursors(table_id, position)``; a table without cursor may go."""
    least = cursors.groupBy("table_id").agg(F.min("position").alias("position"))
    return leaves.join(least, "table_id", "left").where(F.col("position").isNull() | (F.col("leaf") < F.col("position"))).drop("position")


def droppable_inlined(c: Catalog) -> DataFrame:
    return unreachable_inlined(c).select("table_id", "schema_version", "table_name")


def keyset_page(df: DataFrame, a: str, b: str, after: tuple, size: int) -> DataFrame:
    """The next rows in (a, b) order behind ``after``."""
    beyond = (F.col(a) > after[0]) | ((F.col(a) == after[0]) & (F.col(b) > after[1]))
    return df.where(beyond).orderBy(a, b).limit(size)


def halving(size: int, failed: bool, clean: int, most: int) -> tuple[int, int]:
    """Batch size and clean runs after one batch: halves on failure, doubles after ten clean ones."""
    if failed:
        return max(1, size // 2), 0
    return (min(most, size * 2), 0) if clean + 1 >= 10 else (size, clean + 1)


def write_manifest(path: str, leaves: list[dict]) -> None:
    """Replaces a JSON manifest in one step."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as f:
        json.dump({"leaves": leaves}, f, default=str)
    os.replace(draft, path)


class AdvisoryLock:
    """One maintenance session at a time, by exclusive create of a file."""

    def __init__(self, path: str):
        self.path = path

    def __enter__(self):
        os.close(os.open(self.path, os.O_CREAT | os.O_EXCL))
        return self

    def __exit__(self, *_):
        os.unlink(self.path)


# applied to a lake table ---------------------------------------------------------------


def in_batches(items: list, act, batch: int) -> tuple[list, list[int]]:
    """``act(some)`` over all items: batches halve when one fails and double after ten clean ones.

    An item that fails even alone is passed over.  Returns what was done, and the
    size of each batch that was tried.
    """
    done, sizes, at, size, clean = [], [], 0, batch, 0
    while at < len(items):
        some = items[at : at + size]
        sizes.append(len(some))
        try:
            act(some)
            failed = False
        except Exception:  # noqa: BLE001 - whatever the store says, smaller batches find the item
            failed = True
        if not failed or len(some) == 1:
            done += [] if failed else some
            at += len(some)
        size, clean = halving(size, failed, clean, batch)
    return done, sizes


def expire(table, keep_last: int = 1, before: float | None = None, batch: int = 256, purge: bool = True) -> list[str]:
    """Expires all versions before the last ``keep_last`` (and, if given, made before the instant ``before``); the files that went.

    Commits of expiry itself are no versions to keep, so a second run finds nothing.

    Versions expire oldest first, a batch a commit: the commit moves the oldest
    version that may be read and queues the files that no version from there on
    sees.  The newest version never expires.  Queued files are then deleted, and
    the log before the oldest version is folded away.
    """
    oldest = table.snapshot().oldest
    kept = [c for c in table.commits() if c["version"] >= oldest]
    content = [c["version"] for c in kept if not c.keys() & {"expire_to", "unqueue"}]
    target = content[max(0, len(content) - max(1, keep_last))]
    if before is not None:
        target = min([target, *(c["version"] for c in kept if c["time"] >= before)])
    steps = [c["version"] for c in kept if oldest < c["version"] <= target]
    for upto in steps[batch - 1 :: batch] + ([target] if len(steps) % batch else []):
        dead = [{"path": f[0], "end": f[2], "bytes": f[3], "rows": f[4]} for f in table.file_rows() if f[2] is not None and f[2] <= upto]

        def make(s, upto=upto, dead=dead):
            new = [f for f in dead if f["path"] not in s.queue and f["path"] not in s.files]
            return None if s.oldest >= upto else {"expire_to": upto, "queue": new}

        table.change(make)
        table.trim(upto)
    return purge_queue(table, batch) if purge else []


def purge_queue(table, batch: int = 256) -> list[str]:
    """Deletes the files that expiry has queued and takes them off the queue, a commit a batch; which went.

    A file that cannot be deleted stays in the queue for the next run.
    """

    def act(some: list[str]) -> None:
        table.delete_files(some)
        table.change(lambda s: {"unqueue": [p for p in some if p in s.queue]} if any(p in s.queue for p in some) else None)

    return in_batches(sorted(table.snapshot().queue), act, batch)[0]


def compact(table, target: int = TARGET, budget: int = 1 << 40, outputs: int = 1000) -> int:
    """Merges the small files of each partition as :func:`compaction_bins` deals them, within a budget; how many outputs."""
    from .catalog import from_table

    c = from_table(table)
    plan = within_budget(compaction_bins(c, target), budget, outputs).select("partition", "tier", "bin")
    plan = plan.withColumnsRenamed({"partition": "p", "tier": "t", "bin": "b"})
    same = F.col("partition").eqNullSafe(F.col("p")) & (F.col("tier") == F.col("t")) & (F.col("bin") == F.col("b"))
    files = binned(c, target).join(plan, same, "left_semi")
    groups = files.groupBy("partition", "tier", "bin").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()  # one row an output, within the budget
    return table.compact([r["paths"] for r in groups])


def listing(spark, root: str) -> DataFrame:
    """``path, bytes, modified`` of every Parquet file below ``root``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def cleanup(table, older_than: Column, batch: int = 1000) -> DataFrame:
    """Deletes data files that no commit names and that are older than ``older_than``; returns ``path, bytes``.

    Executors list and compare, the driver deletes a batch at a time.  The folder is
    listed and written down before the log is read, so a file that is committed in
    between is known.
    """
    import uuid as ids

    root = f"{table.root}/_strays/{ids.uuid4().hex}"
    inside = F.expr(f"substring(path, {len(table.files.base) + 2})")
    found = listing(table.spark, f"{table.root}/data").where(F.col("modified") < older_than)
    found.withColumn("path", inside).select("path", "bytes").write.parquet(f"{root}/listed")
    known = table.spark.createDataFrame([(f[0],) for f in table.file_rows()] + [(p,) for p in table.snapshot().queue], "path string")
    listed = table.spark.read.schema("path string, bytes long").parquet(f"{root}/listed")
    listed.join(known, "path", "left_anti").write.parquet(f"{root}/stray")
    stray = table.spark.read.schema("path string, bytes long").parquet(f"{root}/stray")
    some: list[str] = []
    for r in stray.select("path").toLocalIterator():
        some.append(r["path"])
        if len(some) >= batch:
            table.delete_files(some)
            some = []
    table.delete_files(some)
    return stray


# leaves ----------------------------------------------------------------------------------

#: Hours that a leaf of each transform spans; months and years are stepped over by the calendar.
_GRAINS = ("hour", "day", "month", "year")


def leaf_bounds(values: list[str | None], fields, column: str):
    """(start, end) of a file's partition values in time; None where they are no span of ``column``.

    Either one epoch-relative field (hours, days, months or years of the column), or
    calendar fields year, month, day and hour, each an identity column of that name.
    """
    from datetime import datetime, timedelta

    epoch = datetime(1970, 1, 1)
    by = {f.name: v for f, v in zip(fields, values)}
    try:
        for f in fields:
            if f.column == column and f.kind in _GRAINS:
                n = int(by[f.name])
                if f.kind in ("hour", "day"):
                    step = timedelta(hours=1) if f.kind == "hour" else timedelta(days=1)
                    return epoch + n * step, epoch + (n + 1) * step
                months = n * (12 if f.kind == "year" else 1)
                at = lambda m: datetime(1970 + m // 12, m % 12 + 1, 1)
                return at(months), at(months + (12 if f.kind == "year" else 1))
        given = [int(by[g]) for g in ("year", "month", "day", "hour") if g in by]
        if not given:
            return None
        start = datetime(*(given + [1, 1, 0][len(given) - 1 :])) if len(given) < 4 else datetime(*given)
        y, m, d, h = start.year, start.month, start.day, start.hour
        end = [lambda: datetime(y + 1, 1, 1), lambda: datetime(y + m // 12, m % 12 + 1, 1), lambda: datetime(y, m, d) + timedelta(days=1), lambda: datetime(y, m, d, h) + timedelta(hours=1)]
        return start, end[len(given) - 1]()
    except (TypeError, ValueError, OverflowError):
        return None


LEAVES = "leaf string, spec string, state string, starts timestamp, ends timestamp, files long, bytes long, rows long, oversized boolean"


def leaves(table, column: str, cutoff, floor=None, most_files: int = 10_000) -> DataFrame:
    """Every leaf of a lake table and whether retention may drop it, oldest first; nothing is changed.

    ``state``: ``old_spec`` (written under another spec than the live one), ``rot``
    (values missing, or no instant), ``floor`` (ends after ``floor``, which no cutoff
    may pass), ``young`` (ends after ``cutoff``), otherwise ``droppable``; the first
    that fits.  ``oversized`` leaves have more than ``most_files`` files and want a
    run of their own.  Times are UTC.
    """
    from ..operators.partition import parse_spec

    s = table.snapshot()
    fields = parse_spec(s.spec) if s.spec else ()
    rows = [("/".join("" if v is None else v for v in f["values"]), f.get("spec", s.spec), f["values"], f["bytes"], f["rows"]) for f in s.files.values()]
    files = table.spark.createDataFrame(rows, "leaf string, spec string, vals array<string>, bytes long, rows long")
    per = files.groupBy("leaf", "spec", "vals").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    spec, n = s.spec, len(fields)

    def classify(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for r in b.to_pylist():
                vals = r["vals"]
                span = leaf_bounds(vals, fields, column) if len(vals) == n and None not in vals else None
                state = "old_spec" if r["spec"] != spec else "rot" if span is None else "floor" if floor is not None and span[1] > floor else "young" if span[1] > cutoff else "droppable"
                start, end = span if span and state != "old_spec" else (None, None)
                out.append((r["leaf"], r["spec"], state, start, end, r["files"], r["bytes"], r["rows"], r["files"] > most_files))
            kinds = [pa.string(), pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.timestamp("us", "UTC"), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            names = ["leaf", "spec", "state", "starts", "ends", "files", "bytes", "rows", "oversized"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names=names)

    return per.mapInArrow(classify, LEAVES).orderBy(F.asc_nulls_last("ends"), "leaf")


def drop_leaves(table, column: str, cutoff, floor=None, cursors: DataFrame | None = None, dry_run: bool = True, oversized: bool = False) -> list[dict]:
    """Drops the leaves that :func:`leaves` calls droppable, oldest first, each in a commit of its own; what went or would go.

    A commit removes the leaf's files as they are live then and carries what it takes
    away (``dropped``: leaf, files, bytes, rows).  A run that ends early has dropped
    whole leaves, and the next one goes on with the rest.  ``cursors(position)``: no
    leaf goes that a reader has not passed.  Oversized leaves are left unless asked for.
    """
    last = cutoff if cursors is None else min([cutoff, *(r[0] for r in cursors.agg(F.min("position")).collect() if r[0] is not None)])
    found = leaves(table, column, last, floor).where(F.col("state") == "droppable")
    plan = (found if oversized else found.where(~F.col("oversized"))).collect()  # one row a leaf
    out = []
    for r in plan:
        took = {"leaf": r["leaf"], "files": r["files"], "bytes": r["bytes"], "rows": r["rows"]}
        if not dry_run:

            def make(s, r=r, took=took):
                gone = {p: f for p, f in s.files.items() if f.get("spec", s.spec) == r["spec"] and "/".join("" if v is None else v for v in f["values"]) == r["leaf"]}
                if not gone or r["spec"] != s.spec:
                    return None
                took |= {"files": len(gone), "bytes": sum(f["bytes"] for f in gone.values()), "rows": sum(f["rows"] for f in gone.values())}
                return {"remove": list(gone), "dropped": dict(took)}

            if table.change(make) is None:
                continue
        out.append(took)
    return out


def drop_partitions(table, column: str, cutoff, cursors: DataFrame | None = None) -> int:
    """Removes the files of all leaves of ``column`` that end by ``cutoff``; how many."""
    from ..operators.partition import parse_spec

    spec = table.snapshot().spec
    if not any(f.column == column and f.kind in _GRAINS for f in (parse_spec(spec) if spec else ())):
        raise ValueError(f"the table is not partitioned by a time of {column!r}")
    return sum(x["files"] for x in drop_leaves(table, column, cutoff, cursors=cursors, dry_run=False, oversized=True))


# repair ------------------------------------------------------------------------------------


class RepairFailed(Exception):
    """No table that needed it could be repaired."""


def broken_values(table) -> dict[str, list]:
    """Live files of the current spec whose partition values are missing, too many or too few."""
    from ..operators.partition import parse_spec

    s = table.snapshot()
    n = len(parse_spec(s.spec)) if s.spec else 0
    return {p: f["values"] for p, f in s.files.items() if f.get("spec", s.spec) == s.spec and (len(f["values"]) != n or None in f["values"])}


def repair_values(table) -> int:
    """Gives files with broken partition values those that their own rows have; how many were changed.

    Rows decide and not folder names, which cannot tell null from a hashed value.  A
    file is changed only if all its rows agree on every value and there are as many as
    the log says (the post-condition, checked for all files before anything is
    committed); a value that is null in every row stays null, which is right.
    """
    from ..operators.partition import parse_spec
    from ..sources.lake import file_uri

    s = table.snapshot()
    fields = parse_spec(s.spec) if s.spec else ()
    broken = broken_values(table)
    if not broken or not fields:
        return 0
    uris = {table.files.uri(p): p for p in broken}
    read = table.spark.read.schema(s.schema).parquet(*[f"{table.root}/{p}" for p in broken])
    kinds = dict(read.dtypes)
    text = [f.value(kinds[f.column]).cast("string") for f in fields]
    aggs = [F.count("*").alias("rows")]
    for i, v in enumerate(text):
        aggs += [F.min(v).alias(f"lo_{i}"), F.max(v).alias(f"hi_{i}"), F.count(v).alias(f"n_{i}")]
    found = read.groupBy(file_uri().alias("uri")).agg(*aggs).collect()  # one row a broken file
    fixed = {}
    for r in found:
        path = uris[r["uri"]]
        values = [r[f"lo_{i}"] for i in range(len(fields))]
        mixed = any(r[f"lo_{i}"] != r[f"hi_{i}"] or r[f"n_{i}"] not in (0, r["rows"]) for i in range(len(fields)))
        if mixed or r["rows"] != s.files[path]["rows"]:
            raise CorruptFile(f"{path} holds rows of several partitions or another number of rows than the log says")
        if values != broken[path]:
            fixed[path] = values
    if not fixed:
        return 0

    def make(now):
        if now.spec != s.spec:
            raise CorruptFile(f"the table is partitioned by {now.spec!r} now")
        live = {p: v for p, v in fixed.items() if p in now.files}
        return {"values": live} if live else None

    table.change(make)
    return len(fixed)


class CorruptFile(Exception):
    """A file's rows contradict the log."""


def repair_all(tables: dict) -> tuple[dict[str, int], dict[str, str]]:
    """``repair_values`` of each named table: how many files changed, and what failed; RepairFailed if everything did."""
    good, bad = {}, {}
    for name, table in tables.items():
        try:
            good[name] = repair_values(table)
        except Exception as e:  # noqa: BLE001 - one table's fault leaves the others alone
            bad[name] = f"{type(e).__name__}: {e}".splitlines()[0][:300]
    if bad and not good:
        raise RepairFailed("; ".join(f"{k}: {v}" for k, v in bad.items()))
    return good, bad


# inline tables -----------------------------------------------------------------------------

_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"


def drop_inlined(c: Catalog, drop, page: int = 1000, batch: int = 64, rows_of: DataFrame | None = None) -> tuple[list[tuple], list[int]]:
    """Drops the inline tables that no kept snapshot reaches, a page at a time; which went, and the batch sizes.

    See :func:`inlined_drops`, which keeps no more than a page.
    """
    done, sizes = [], []
    for went, tried in inlined_drops(c, drop, page, batch, rows_of):
        done += went
        sizes += tried
    return done, sizes


def inlined_drops(c: Catalog, drop, page: int = 1000, batch: int = 64, rows_of: DataFrame | None = None) -> Iterator[tuple[list[tuple], list[int]]]:
    """Drops the inline tables that no kept snapshot reaches; after each page, which of it went and the batch sizes.

    ``drop(some)`` takes ``(table_id, schema_version, table_name)`` rows and fails
    whole; batches halve and grow as in :func:`in_batches`.  Refuses a lake without
    snapshots, in which everything would look unreachable.  Tables with rows
    (``rows_of(table_name, n)``) and with names that are none are passed over.
    The tables are found and sorted once, by Spark; pages are cut from its partitions,
    of which the driver has one at a time.
    """
    if c.snapshot.isEmpty():
        raise ValueError("the lake has no snapshot: what is unreachable cannot be told")
    found = droppable_inlined(c).where(F.col("table_name").rlike(_NAME))
    if rows_of is not None:
        full = rows_of.where(F.col("n") > 0).select("table_name").distinct()
        found = found.join(full, "table_name", "left_anti").select("table_id", "schema_version", "table_name")
    rows = map(tuple, found.orderBy("table_id", "schema_version").toLocalIterator())
    while some := list(islice(rows, page)):
        yield in_batches(some, drop, batch)
