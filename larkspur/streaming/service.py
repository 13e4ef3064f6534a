"""An ingest as its settings describe it: from a message log to a lake table or another log."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import messages
from ..sources.lake import Files
from .config import Config, destination_of
from .include import Allowlist, fetcher
from .ingest import Steps, ingest, make_sink

#: Partitions of a log that a message's place among those of a batch has room for.
PARTITIONS = 1 << 16


def steps_of(c: Config, allowed: Allowlist | None) -> Steps:
    """What happens to a batch by the settings and the values that are allowed now."""
    keep = c.keep and (c.keep[0], allowed.values() if allowed else c.keep[1])
    return Steps(c.typed, keep, c.drop, c.variant, c.variant, non_finite=c.non_finite, declared=c.declared, on_invalid=c.on_invalid)


def _settled(home: Files, name: str, value: str) -> str:
    """What the group's file says; ``value`` if it is the first to say something."""
    home.put_new(name, value)
    return home.read(name)


def _starts(spark: SparkSession, home: Files, c: Config, log: str, topic: str) -> dict[int, int]:
    """First offsets by partition, settled when a replica of a group starts for the first time: none for ``earliest``."""
    name = f"starts-{c.ordinal}.json"
    if name not in home.names("") and c.offset_reset == "latest":
        found = {r["partition"]: r["high"] for r in messages.watermarks(spark, log, topic).collect()}  # a row a partition
    else:
        found = {}
    return {int(p): at for p, at in json.loads(_settled(home, name, json.dumps(found))).items()}


def run(spark: SparkSession, c: Config, log: str, topic: str, target: str, state: str, once: bool = True):
    """Runs one replica of a consumer group; counters (``once``) or the query, as :func:`ingest` gives them.

    ``state`` holds, by group, where each replica has got to, where it started, and
    what the group writes to: another destination or target is refused, since the
    positions of one say nothing about the other.
    """
    home = Files(spark, f"{state.rstrip('/')}/{c.group_id}")
    before = json.loads(_settled(home, "destination.json", json.dumps([c.destination, target])))
    destination_of(c.destination, c.group_id, before[0] if before[1] == target else f"{before[0]} {before[1]}", {})
    allowed = None
    if c.include_url:
        fetch = fetcher(spark, c.include_url, c.include_header, c.include_token, c.include_timeout)
        allowed = Allowlist(c.keep[1], fetch, c.include_polls, c.include_shadow, c.include_every, c.include_startup)
    rows = messages.read(spark, log, topic, True, c.replicas, c.ordinal, c.flush_bytes, _starts(spark, home, c, log, topic))
    source = rows.select((F.col("offset") * PARTITIONS + F.col("partition")).alias("seq"), "value")
    layout = {"spec": c.partition_by, "sort": c.sort} if c.destination == "lake" else {}
    sink = make_sink(c.destination, spark=spark, root=target, codec=c.codec, level=c.level, **layout)
    at, name = f"{home.root}/{c.ordinal}", f"{c.group_id}-{c.ordinal}"
    out = ingest(spark, source, sink, lambda: steps_of(c, allowed), at, name, once, c.flush_bytes, c.flush_seconds, c.retry_attempts, c.retry_seconds)
    if allowed:
        (out if once else out.larkspur_counters).include = allowed.counts
    return out
