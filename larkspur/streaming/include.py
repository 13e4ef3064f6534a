"""A polled allowlist as a stateful operator: one small state a set, folded over its polls in order.

Every value of a set has a number, the accepted polls in a row that lacked it; that
and the pins are the whole state.  A poll is answered in this order:

* values of another kind than those held: nothing happens (``type_flip``);
* it names nothing, though polls govern something or nothing is pinned: ``empty``;
* what is new comes in at once;
* numbers go up by one for values that are lacking and not pinned, and end for all
  others; a value whose number reaches ``need`` goes;
* unless nothing at all would be left (``empty``, and what is new stays out), or the
  values to go are over half of those that the poll governs, where it governs several
  (``bulk_removal``: numbers stay as they were, what is new stays in).  Governed are
  the values held but for pins that the poll does not name.
"""

from __future__ import annotations

import json
import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = "set long, seq long, served long, added long, removed long, refused string"


class State:
    """Numbers by value; ``None`` marks a pin, which no poll governs unless it names it."""

    __slots__ = ("numbers", "pins", "need")

    def __init__(self, initial: Iterable, pins: Iterable = (), need: int = 3, numbers: dict | None = None):
        if need < 1:
            raise ValueError("a removal takes one poll at least")
        self.pins, self.need = frozenset(pins), need
        self.numbers = dict.fromkeys([*initial, *self.pins], 0) if numbers is None else numbers

    def answer(self, polled: Sequence) -> tuple[int, int, str | None]:
        """(added, removed, refused) of one poll, whose values are distinct."""
        held, named = self.numbers, frozenset(polled)
        kinds = {type(v) for v in named}
        if len(kinds) > 1 or kinds and held and type(min(held, key=str)) not in kinds:
            return 0, 0, "type_flip"
        if not named and not (self.pins and self.pins.issuperset(held)):
            return 0, 0, "empty"
        fresh = [v for v in polled if v not in held]
        counted = {v: 0 if v in named or v in self.pins else n + 1 for v, n in held.items()}
        going = [v for v, n in counted.items() if n >= self.need]
        if held and len(going) == len(held) and not fresh:
            return 0, 0, "empty"
        governed = sum(v in named or v not in self.pins for v in held)
        refused = governed > 1 and len(going) > max(1, governed // 2)
        if not refused:
            self.numbers = {v: n for v, n in counted.items() if n < self.need}
        self.numbers.update(dict.fromkeys(fresh, 0))
        return len(fresh), 0 if refused else len(going), "bulk_removal" if refused else None


def difference(state: State, polled: Iterable) -> tuple[int, int]:
    """What a shadow run reports: (values polled but not held, values held but neither polled nor pinned)."""
    named = frozenset(polled) | state.pins
    return len(named.difference(state.numbers)), sum(v not in named for v in state.numbers)


def _polls(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list]]:
    """``set, seq, distinct values`` of sorted rows; what is held is one poll."""
    key, values = None, []
    for b in batches:
        for s, q, v in zip(*(b.column(i).to_pylist() for i in range(3))):
            if (s, q) != key:
                if key is not None:
                    yield (*key, values)
                key, values = (s, q), []
            if v is not None and (not values or values[-1] != v):
                values.append(v)
    if key is not None:
        yield (*key, values)


def replay(polls: DataFrame, initial: Iterable, pins: Iterable = (), need: int = 3) -> DataFrame:
    """``polls(set, seq, value)`` replayed in order: ``set, seq, served, added, removed, refused`` per poll.

    A poll that names nothing has one row with a null value.  A set's polls are sorted
    by Spark and pass through one task, which holds the set's values and one poll,
    never the log.
    """
    initial, pins = list(initial), list(pins)
    rows = polls.select(F.col("set").cast("long"), F.col("seq").cast("long"), "value").repartition("set").sortWithinPartitions("set", "seq", "value")
    schema = pa.schema([("set", pa.int64()), ("seq", pa.int64()), ("served", pa.int64()), ("added", pa.int64()), ("removed", pa.int64()), ("refused", pa.string())])

    def run(batches):
        at, state, out = None, None, []
        for key, seq, values in _polls(batches):
            if state is None or key != at:
                at, state = key, State(initial, pins, need)
            added, removed, refused = state.answer(values)
            out.append((key, seq, len(state.numbers), added, removed, refused))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, RESULT)


def follow(polls: DataFrame, initial: Iterable, pins: Iterable = (), need: int = 3) -> DataFrame:
    """:func:`replay` of a stream of polls: each set's numbers live in the state store between micro-batches.

    The polls of a set arrive in order and whole.
    """
    import pandas as pd

    initial, pins = list(initial), list(pins)

    def run(key, frames, state):
        have = dict(zip(*state.get)) if state.exists else None
        now = State(initial, pins, need, have)
        rows = pd.concat(list(frames)).sort_values(["seq", "value"])
        out = []
        for seq, g in rows.groupby("seq", sort=True):
            added, removed, refused = now.answer(g["value"].dropna().astype("int64").drop_duplicates().tolist())
            out.append((key[0], seq, len(now.numbers), added, removed, refused))
        state.update((list(now.numbers), list(now.numbers.values())))
        yield pd.DataFrame(out, columns=["set", "seq", "served", "added", "removed", "refused"])

    kept = T.StructType([T.StructField("v", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType()))])
    return polls.groupBy("set").applyInPandasWithState(run, RESULT, kept, "append", "NoTimeout")


# in a running ingest ---------------------------------------------------------------------

#: Longest answer that is taken: the values become a condition of every batch's plan.
MOST_BYTES = 4 << 20


class NoValues(Exception):
    """The endpoint named no usable values in the time that a start may take."""


def values_of(body: str) -> list:
    """The distinct values of a JSON array, all whole numbers or all texts; ValueError for anything else."""
    if len(body) > MOST_BYTES:
        raise ValueError(f"an answer of over {MOST_BYTES} bytes")
    got = json.loads(body)
    if not isinstance(got, list) or {type(v) for v in got} - {int} and {type(v) for v in got} - {str}:
        raise ValueError("not an array of whole numbers or of texts")
    return list(dict.fromkeys(got))


def fetcher(spark, url: str, header: str = "", token: str = "", timeout: float = 10.0) -> Callable[[], str]:
    """What reads the body behind a URL: over HTTP, or a text file wherever Spark reads."""

    def http() -> str:
        import urllib.request

        ask = urllib.request.Request(url, headers={header: token} if header else {})
        with urllib.request.urlopen(ask, timeout=timeout) as answer:
            return answer.read(MOST_BYTES + 1).decode()

    def file() -> str:
        row = spark.read.text(url, wholetext=True).where(F.octet_length("value") <= MOST_BYTES).first()
        if row is None:
            raise ValueError("no file, or one that is too long")
        return row["value"]

    return http if url.startswith(("http://", "https://")) else file


class Allowlist:
    """The values that a running ingest keeps: static ones, and those that an endpoint names.

    Static values are pins.  ``values`` is asked once a batch and polls when ``every``
    seconds have passed; what a poll may change is :class:`State`'s.  A poll that fails
    changes nothing and is counted.  The first one has to succeed within ``startup``
    seconds, or there is no start: without it, rows that only the endpoint names would
    be left out for good.  With ``shadow`` the static values are served, nothing waits
    for the endpoint, and ``gap`` says how far its answer is from them.
    """

    def __init__(self, static: Iterable, fetch: Callable[[], str] | None = None, need: int = 3, shadow: bool = False, every: float = 60.0, startup: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.static, self.fetch, self.shadow, self.every, self.clock = list(static), fetch, shadow, every, clock
        self.state, self.counts = State(self.static, self.static, need), Counter()
        self.gap: tuple[int, int] | None = None
        self._asked: float | None = None
        if fetch and not shadow:
            end, wait = clock() + startup, 0.5
            while not self._poll():
                if clock() + wait > end:
                    raise NoValues(f"no usable answer within {startup:g} s")
                sleep(wait)
                wait = min(10.0, 2 * wait)

    def _poll(self) -> bool:
        self._asked = self.clock()
        try:
            polled = values_of(self.fetch())
        except Exception:  # noqa: BLE001 - an endpoint that is down or talks nonsense is no reason to drop what is held
            self.counts["failed"] += 1
            return False
        if self.shadow:
            self.gap = difference(State(self.static, (), self.state.need), polled)
            self.counts["compared"] += 1
            return True
        added, removed, refused = self.state.answer(polled)
        self.counts.update(added=added, removed=removed)
        self.counts[refused or "accepted"] += 1
        return refused in (None, "bulk_removal") or bool(self.state.numbers) and refused == "empty"

    def values(self) -> list:
        if self.fetch and (self._asked is None or self.clock() - self._asked >= self.every):
            self._poll()
        return self.static if self.shadow else list(self.state.numbers)
