"""Upkeep of a lake table in whole runs: check, drain the deletion queue, maintain."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import maintenance


class Busy(Exception):
    """Another run holds the table."""


class NotDrained(Exception):
    """The deletion queue did not get empty."""


class TableLock:
    """One upkeep run at a time, on whatever driver: a file that is published only where there is none.

    A lock older than ``stale`` seconds is that of a run that died, and is taken over.
    The holder may enter again.
    """

    NAME = "_lock/upkeep"

    def __init__(self, table, stale: float = 6 * 3600):
        self.files, self.stale, self.depth, self.me = table.files, stale, 0, uuid.uuid4().hex

    def __enter__(self):
        self.depth += 1
        if self.depth > 1:
            return self
        for last in (False, True):
            if self.files.put_new(self.NAME, json.dumps({"holder": self.me, "time": time.time()})):
                return self
            held = json.loads(self.files.read(self.NAME))
            if last or time.time() - held["time"] < self.stale:
                break
            self.files.delete(self.NAME)
        self.depth -= 1
        raise Busy(f"held since {held['time']}")

    def __exit__(self, *_):
        self.depth -= 1
        if not self.depth:
            self.files.delete(self.NAME)


def findings(table, older_than: Column | None = None) -> DataFrame:
    """``finding, path`` of all that is wrong with a table; nothing is changed.

    ``missing``: a live file that is not there; ``size``: one of another size than the
    log says; ``queued_gone``: a queued file that is not there any more; ``stray``: a
    file (older than ``older_than``) that nothing names; ``values``: a live file with
    broken partition values.
    """
    spark, s = table.spark, table.snapshot()
    inside = F.expr(f"substring(path, {len(table.files.base) + 2})")
    listed = maintenance.listing(spark, f"{table.root}/data").withColumn("path", inside)
    rows = [(p, f["bytes"], "live") for p, f in s.files.items()] + [(p, None, "queued") for p in s.queue]
    rows += [(f[0], None, "past") for f in table.file_rows() if f[2] is not None and f[0] not in s.queue]
    known = spark.createDataFrame(rows, "path string, logged long, state string")
    both = known.join(listed.withColumnRenamed("path", "found"), F.col("path") == F.col("found"), "full_outer")
    old = F.lit(True) if older_than is None else F.col("modified") < older_than
    state, gone = F.col("state"), F.col("found").isNull()
    finding = (
        F.when((state == "live") & gone, "missing")
        .when((state == "live") & (F.col("bytes") != F.col("logged")), "size")
        .when((state == "queued") & gone, "queued_gone")
        .when(state.isNull() & old, "stray")
    )
    out = both.select(finding.alias("finding"), F.coalesce("path", "found").alias("path")).where(F.col("finding").isNotNull())
    broken = spark.createDataFrame([("values", p) for p in maintenance.broken_values(table)], "finding string, path string")
    return out.unionByName(broken)


def heal(table) -> list[str]:
    """Takes queued files that are not there off the queue; which.

    Refuses where no live file is there at all or one that is missing is live: then
    the listing and not the queue is what is wrong.
    """
    s = table.snapshot()
    gone = set(s.queue) - table.present(list(s.queue))
    if not gone:
        return []
    if s.files and not table.present(list(s.files)) or gone & set(s.files):
        raise NotDrained("queued files are gone, and so are live ones: the folder is not what it should be")
    table.change(lambda now: {"unqueue": [p for p in gone if p in now.queue]})
    return sorted(gone)


def drain(table, rounds: int = 3, lock: TableLock | None = None) -> dict[str, int]:
    """Heals and purges until the queue is empty; how many of each.  NotDrained after ``rounds``."""
    done = {"healed": 0, "purged": 0}
    with lock or TableLock(table):
        for _ in range(rounds):
            done["healed"] += len(heal(table))
            done["purged"] += len(maintenance.purge_queue(table))
            if not table.snapshot().queue:
                return done
    raise NotDrained(f"{len(table.snapshot().queue)} files are left after {rounds} rounds")


def fsck(table, older_than: Column, dry_run: bool = True) -> dict[str, int]:
    """Counts of :func:`findings`; without ``dry_run`` all but missing files and sizes, which no run can mend, are put right."""
    with TableLock(table) as lock:
        found = {r["finding"]: r["n"] for r in findings(table, older_than).groupBy("finding").agg(F.count("*").alias("n")).collect()}  # five at most
        if not dry_run:
            drain(table, lock=lock)
            maintenance.cleanup(table, older_than).count()
            maintenance.repair_values(table)
        return found


def maintain(table, keep_last: int = 100, before: float | None = None, older_than: Column | None = None, only: tuple[str, ...] = ()) -> list[tuple[str, object, str | None]]:
    """Expiry, purging, merging, strays and a fold of the log, in this order: ``(step, result, error)`` of each.

    A step that fails leaves the next ones alone; only one that holds the lock stops all.
    """
    old = older_than if older_than is not None else F.current_timestamp() - F.expr("INTERVAL 3 DAYS")
    steps: dict[str, Callable[[], object]] = {
        "expire": lambda: len(maintenance.expire(table, keep_last, before, purge=False) or []),
        "drain": lambda: drain(table, lock=lock),
        "compact": lambda: maintenance.compact(table),
        "strays": lambda: maintenance.cleanup(table, old).count(),
        "fold": lambda: table.files.put_new(f"_log/{(s := table.snapshot()).version:020d}.fold", s.to_json()),
    }
    out: list[tuple[str, object, str | None]] = []
    with TableLock(table) as lock:
        for name, step in steps.items():
            if only and name not in only:
                continue
            try:
                out.append((name, step(), None))
            except Exception as e:  # noqa: BLE001 - a step's failure is that step's own
                out.append((name, None, f"{type(e).__name__}: {e}".splitlines()[0][:300]))
    return out
