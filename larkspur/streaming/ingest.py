"""Message ingest: decode, infer, pin, filter, and append per micro-batch, exactly once per range of offsets."""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import evolve, filters, infer, variants
from ..sources import frames, messages
from ..sources.lake import CommitConflict, Files, LakeTable, TableRecreated
from . import lag
from .config import FLUSH_DEADLINE, attempt_reserve


class Sink(Protocol):
    identity: str  # what is written to; part of a flush's key

    def write(self, batch: DataFrame, key: str, note: str = "") -> int: ...
    def reset_caches(self) -> None: ...
    def close(self) -> None: ...


class LakeSink:
    """Appends to a lake table; knows the table it started with.

    ``spec`` and ``sort`` are what the table is created with, or what one that is
    there gets before the first batch; another spec than the table's is refused.
    """

    def __init__(self, table: LakeTable, codec: str = "zstd", level: int = 3, spec: str = "", sort: Sequence[str] = ()):
        self.table, self.codec, self.level, self.spec, self.sort = table, codec, level, spec, tuple(sort)
        self.identity = table.root
        self._uuid: str | None = None
        self._laid_out = not (spec or sort)

    def _lay_out(self, batch: DataFrame) -> None:
        fit, _ = evolve.drop_unwritable(batch)
        fit = fit.drop(*[f.name for f in fit.schema if not evolve.storable(f.dataType)])
        if fit.columns:
            self.table.create(fit.schema, self.spec, self.sort)
            if self.sort:
                self.table.ensure_sort(self.sort)
            self._laid_out = True

    @property
    def counts(self) -> dict[str, int]:
        return dict(self.table.counts)

    def write(self, batch: DataFrame, key: str, note: str = "") -> int:
        if not self._laid_out:
            self._lay_out(batch)
        try:
            n = self.table.append(batch, key, self.codec, self.level, self._uuid, note=note)
        except Exception as e:  # noqa: BLE001 - what a VARIANT cannot hold is no reason to lose the batch
            companions = [f.name for f in batch.schema if f.dataType.typeName() == "variant" and f.name.endswith(variants.SUFFIX)]
            if not companions or "VARIANT" not in str(e):
                raise
            self.table.counts["variant_fallback"] += 1
            n = self.table.append(batch.drop(*companions), key, self.codec, self.level, self._uuid, note=note)
        if n and not self._uuid:
            self._uuid = self.table.snapshot().table_uuid
        return n

    def reset_caches(self) -> None:
        self._uuid = None
        self._laid_out = not (self.spec or self.sort)

    def close(self) -> None:
        pass


class LogSink:
    """Hands records on as JSON texts to a topic of a message log; columns that are null are left out."""

    def __init__(self, log: messages.Producer):
        self.log, self.identity, self.counts = log, log.home, {"already_published": 0}

    def write(self, batch: DataFrame, key: str, note: str = "") -> int:
        if not batch.columns:
            return 0
        n = self.log.append(batch.select(F.to_json(F.struct(*batch.columns)).alias("value")), key)
        self.counts["already_published"] += not n
        return n

    def reset_caches(self) -> None:
        pass

    def close(self) -> None:
        pass


def make_sink(destination: str, **settings) -> Sink:
    """The sink of a destination: ``lake`` writes to the table at ``root``, ``log`` to the topic of that name below its parent."""
    spark, root = settings["spark"], settings["root"].rstrip("/")
    if destination == "lake":
        return LakeSink(LakeTable(spark, root), **{k: settings[k] for k in ("codec", "level", "spec", "sort") if k in settings})
    if destination == "log":
        parent, _, topic = root.rpartition("/")
        return LogSink(messages.Producer(spark, parent, topic, settings.get("partitions", 8)))
    raise ValueError(f"unknown destination {destination!r}")


@dataclass(frozen=True)
class Steps:
    """What happens to a batch between decoding and writing, in this order."""

    pins: Sequence[tuple[str, str]] = ()
    keep: tuple[str, Sequence] | None = None
    drop: tuple[str, Sequence] | None = None
    variant: Sequence[str] = ()
    json_text: Sequence[str] = ()
    layout: str = "transform"
    non_finite: bool = False
    declared: Sequence[str] = ()
    on_invalid: str = "null"


class Watch:
    """Counters of one pass: what the write itself sees as rows go by."""

    #: Seconds that a pass's figures may take to arrive after it; a sink that wrote nothing never sends them.
    WAIT = 2.0

    def __init__(self):
        self._seen: list[Observation] = []

    def see(self, df: DataFrame, **counts: Column) -> DataFrame:
        o = Observation()
        self._seen.append(o)
        return df.observe(o, *[c.alias(n) for n, c in counts.items()])

    def totals(self) -> dict[str, int]:
        out: dict[str, int] = {}
        until = time.monotonic() + self.WAIT
        for o in self._seen:
            while not o._jo.future().isCompleted() and time.monotonic() < until:
                time.sleep(0.01)
            if o._jo.future().isCompleted():
                out |= {k: int(v or 0) for k, v in o.get.items()}
        return out


def transform(messages: DataFrame, steps: Steps, watch: Watch | None = None) -> DataFrame:
    """Typed, filtered records of ``messages(seq, value)``; ``seq`` orders arrival.

    With ``watch`` the pass that writes the records also counts: ``consumed``,
    ``bytes``, and what is left out by reason.
    """
    see = watch.see if watch else lambda df, **_: df
    parsed = infer.parse(frames.decode(messages) if dict(messages.dtypes)["value"] == "binary" else messages, non_finite=steps.non_finite)
    keys = infer.infer(parsed, "seq")
    bad = F.count_if(F.col("value").isNotNull() & F.col("rec").isNull())
    parsed = see(parsed, consumed=F.count("*"), bytes=F.sum(F.octet_length("value")), json_parse=bad)
    rows = infer.build(parsed, keys, [*steps.json_text, *steps.declared]).drop("value")
    rows = coerce.pin(infer.normalize(rows), steps.pins)
    if steps.keep:
        rows = filters.keep(see(rows, **filters.keep_reasons(rows, *steps.keep)), *steps.keep)
    if steps.drop:
        rows = filters.drop(see(rows, filter_dropped=filters.dropped(rows, *steps.drop)), *steps.drop)
    here = [n for n in steps.declared if n in rows.columns]
    if here:
        rows = rows.withColumns({n: variants.declared(F.col(n).cast("string"), steps.on_invalid) for n in here})
    if steps.variant:
        rows = variants.dual_write(rows, steps.variant)
    evolve.check_reserved(rows.columns, steps.layout)
    return rows


def flush_key(table: str, query: str, ranges: Sequence[tuple]) -> str:
    """Identity of a flush: a version 5 uuid of table, query and sorted ranges ``(topic, partition, first, last)``."""
    text = ",".join(f"{t}:{p}:{a}-{b}" for t, p, a, b in sorted(ranges))
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{table}/{query}/{text}"))


class SinkError(Exception):
    """A failure as a sink knows it: its label, whether repeating is no use, and how long the other side asks to wait."""

    def __init__(self, message: str, label: str = "write_retry", permanent: bool = False, retry_after: float = 0.0):
        super().__init__(message)
        self.label, self.permanent, self.retry_after = label, permanent, retry_after


def write_with_retry(write: Callable[[], int], reset: Callable[[], None], attempts: int = 5, deadline: float = FLUSH_DEADLINE, sleep=time.sleep, clock=time.monotonic, failed: dict[str, int] | None = None, timeout: float = 0.0) -> int:
    """Repeats a write that another writer crossed or that its sink says may be repeated.

    Permanent errors, all others, and a passed deadline fail; with the ``timeout`` of an
    attempt, so does a deadline that another one might pass, going by how long the
    last one took.  ``failed`` counts failures by label.  A repeated write carries its key, so one whose answer was
    lost after it was committed is recognised and writes nothing.
    """
    start = clock()
    for n in range(attempts):
        began = clock()
        try:
            return write()
        except TableRecreated:
            reset()
            raise
        except (CommitConflict, SinkError) as e:
            if failed is not None:
                label = lag.classify(e)
                failed[label] = failed.get(label, 0) + 1
            wait = lag.backoff(n, retry_after=getattr(e, "retry_after", 0.0), jitter=random.random())
            reserve = attempt_reserve(timeout, clock() - began) if timeout else 0.0
            if getattr(e, "permanent", False) or n + 1 == attempts or clock() - start + wait + reserve > deadline:
                raise
            sleep(wait)
    raise AssertionError("unreachable")


def batch_ranges(checkpoint: Files, batch_id: int) -> list[tuple[str, int, str, str]]:
    """Where a micro-batch begins and ends in each source, ``(topic, partition, first, end)``, from the checkpoint's offset log."""

    def at(n: int) -> list[str]:
        return checkpoint.read(f"offsets/{n}").splitlines()[2:] if n >= 0 and str(n) in names else []

    names = set(checkpoint.names("offsets"))
    before, now = at(batch_id - 1), at(batch_id)
    out = []
    for k, end in enumerate(now):
        first = before[k] if k < len(before) else "-"
        a, b = (json.loads(x) if x.startswith("{") else {} for x in (first, end))
        if b and all(isinstance(v, dict) for v in b.values()):  # positions by topic and partition
            out += [(t, int(p), str(a.get(t, {}).get(p, "-")), str(v)) for t, parts in b.items() for p, v in parts.items()]
        else:
            out.append((f"source-{k}", 0, first, end))
    return out


def ranges_text(ranges: Sequence[tuple], limit: int = 2000) -> str:
    """Offset ranges by topic, at most ``limit`` characters of them and how many more there are."""
    by_topic: dict[str, list[str]] = {}
    for topic, part, first, last in sorted(ranges, key=lambda r: (r[0], r[1])):
        by_topic.setdefault(topic, []).append(f"{part} from {first} to {last}")
    out = []
    for topic, texts in by_topic.items():
        kept = [t for k, t in enumerate(texts) if sum(map(len, texts[: k + 1])) + 2 * k <= limit]
        more = len(texts) - len(kept)
        out.append(f"{topic}: " + ", ".join(kept) + (f" and {more} more" if more else ""))
    return "; ".join(out)


#: Rows of a flush up to which it counts in a class of ``Counters.shape``.
SHAPE = (100, 1_000, 10_000, 100_000, 1_000_000)


@dataclass
class Counters:
    """What an ingest did.  ``flushes``: batches by what ended them, ``size``, ``time`` or ``final``; ``shape``: by rows."""

    written: int = 0
    batches: int = 0
    replays: int = 0
    consumed: int = 0
    bytes: int = 0
    skipped: dict[str, int] = field(default_factory=dict)
    flushes: dict[str, int] = field(default_factory=dict)
    shape: dict[float, int] = field(default_factory=dict)
    failed: dict[str, int] = field(default_factory=dict)
    sink: dict[str, int] = field(default_factory=dict)
    include: dict[str, int] = field(default_factory=dict)
    beat: float = field(default_factory=time.monotonic)

    def healthy(self, limit: float = 480.0) -> bool:
        """Whether a batch has ended within the limit."""
        return lag.healthy(time.monotonic() - self.beat, limit)

    def take(self, seen: dict[str, int], written: int) -> None:
        self.written += written
        self.batches += 1
        self.consumed += seen.pop("consumed", 0)
        self.bytes += seen.pop("bytes", 0)
        for reason, n in seen.items():
            self.skipped[reason] = self.skipped.get(reason, 0) + n
        le = next((b for b in SHAPE if written <= b), float("inf"))
        self.shape[le] = self.shape.get(le, 0) + 1

    def ended(self, why: str) -> None:
        self.flushes[why] = self.flushes.get(why, 0) + 1


def ingest(spark: SparkSession, source: DataFrame, sink: Sink, steps: Steps | Callable[[], Steps], checkpoint: str, name: str = "ingest", once: bool = True, flush_bytes: int = 128 << 20, flush_seconds: int = 60, attempts: int = 5, timeout: float = 0.0):
    """Runs a stream of ``(seq, value)`` into a sink; returns counters (``once``) or the query, whose ``larkspur_counters`` are kept up to date.

    A flush is known to the sink by :func:`flush_key` over the sink, the id that the
    checkpoint gives the query, and the offsets that the batch spans: a batch that is
    run again has the same key, and two checkpoints never share one, whatever their
    names.

    A batch ends by size (the source admits about ``flush_bytes`` at a time, see
    ``messages.read``), by time (every ``flush_seconds``) or at the end of what there
    is.  ``steps`` that are a function are asked for anew by every batch.  With ``once`` every batch but the last ends because the source admits no
    more; otherwise one that reached ``flush_bytes`` counts as ``size``.
    """
    counts, log, open_ = Counters(), Files(spark, checkpoint), []

    def flush(batch: DataFrame, batch_id: int) -> None:
        if open_:
            counts.ended(open_.pop())
        ranges = batch_ranges(log, batch_id)
        key = flush_key(sink.identity, json.loads(log.read("metadata"))["id"], ranges)
        batch.persist()  # inference reads it, then the write does
        try:
            watch = Watch()
            rows = transform(batch, steps() if callable(steps) else steps, watch)
            n = write_with_retry(lambda: sink.write(rows.drop("seq"), key, ranges_text(ranges)), sink.reset_caches, attempts, failed=counts.failed, timeout=timeout)
            seen = watch.totals()
            counts.replays += n == 0 and not seen
            full = seen.get("bytes", 0) >= flush_bytes
            counts.take(seen, n)
            counts.sink, counts.beat = getattr(sink, "counts", {}), time.monotonic()
            if once:
                open_.append("size")
            else:
                counts.ended("size" if full else "time")
        finally:
            batch.unpersist()

    w = source.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).queryName(name)
    q = (w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{flush_seconds} seconds")).start()
    if once:
        q.awaitTermination()
        if open_:
            counts.ended("final")
        return counts
    q.larkspur_counters = counts
    q.larkspur_rest = lambda: ingest(spark, source, sink, steps, checkpoint, name, True, flush_bytes, flush_seconds, attempts, timeout)
    return q


def finish(query, failed_for_good: bool = False) -> Counters | None:
    """Ends a running ingest; what its source still has is flushed by a last run, unless the sink has failed for good."""
    query.stop()
    return query.larkspur_rest() if lag.final_flush(1, failed_for_good) == "flush" else None
