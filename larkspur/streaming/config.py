"""Settings of an ingest service, checked at start: refuse rather than degrade."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from ..functions.coerce import TYPES, UUID_CANONICAL, UUID_HEX
from ..operators.evolve import SAFE
from ..operators.partition import Field, parse_spec
from ..operators.variants import SUFFIX
from ..sources.lake import CODECS

LIVENESS = 480.0
FLUSH_DEADLINE = 450.0


class ConfigError(ValueError):
    pass


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigError(what)


def boolean(text: str) -> bool:
    known = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}
    _need(text.strip().lower() in known, f"not a boolean: {text!r}")
    return known[text.strip().lower()]


def value_list(text: str) -> tuple[int, ...] | tuple[str, ...]:
    """All whole numbers, or else all texts; repeated values count once, the first stays."""
    parts = tuple(dict.fromkeys(p.strip() for p in text.split(",") if p.strip()))
    return tuple(map(int, parts)) if parts and all(re.fullmatch(r"-?[0-9]+", p) for p in parts) else parts


def column_list(text: str) -> tuple[str, ...]:
    names = tuple(dict.fromkeys(p.strip() for p in text.split(",") if p.strip()))
    for n in names:
        _need(bool(SAFE.fullmatch(n)), f"unsafe column name {n!r}")
    return names


def word(text: str, known: tuple[str, ...], what: str) -> str:
    _need(text in known, f"{what} is one of {', '.join(known)}, not {text!r}")
    return text


def seconds(text: str, what: str) -> float:
    """A positive number of seconds."""
    try:
        got = float(text)
    except ValueError:
        got = 0.0
    _need(0 < got < float("inf"), f"{what} is a positive number of seconds, not {text!r}")
    return got


def typed_columns(text: str) -> tuple[tuple[str, str], ...]:
    """``col:type`` pairs; the same pair twice is one, two types of a column are refused."""
    out: dict[str, str] = {}
    for p in (x.strip() for x in text.split(",") if x.strip()):
        name, _, kind = p.partition(":")
        _need(bool(SAFE.fullmatch(name)) and kind in TYPES, f"malformed typed column {p!r}")
        _need(out.setdefault(name, kind) == kind, f"column {name!r} has two types")
    return tuple(out.items())


def filter_of(field: str, values: str, typed: tuple[tuple[str, str], ...]) -> tuple[str, tuple] | None:
    """(field, values), set together or not at all; values of a uuid column are uuids."""
    _need(bool(field) == bool(values), "a filter needs field and values")
    if not field:
        return None
    _need(bool(SAFE.fullmatch(field)), f"unsafe filter field {field!r}")
    got = value_list(values)
    _need(bool(got), "a filter needs values")
    if dict(typed).get(field) == "uuid":
        for v in got:
            _need(bool(re.match(UUID_HEX, str(v)) or re.match(UUID_CANONICAL, str(v))), f"not a uuid: {v!r}")
    return field, got


def ordinal_of(host: str, replicas: int) -> int:
    m = re.search(r"-([0-9]+)$", host)
    _need(bool(m), f"no ordinal in {host!r}")
    _need(int(m[1]) < replicas, f"ordinal {m[1]} is not below {replicas}")
    return int(m[1])


def retry_ladder(attempts: int, base: float, cap: float, timeout: float) -> float:
    """Longest time of all attempts with their delays; refused beyond the liveness limit."""
    worst = attempts * timeout + sum(min(cap, base * 2**n) * 1.25 for n in range(attempts - 1))
    _need(attempts >= 1 and worst <= LIVENESS, f"retries may take {worst:.0f} s, the limit is {LIVENESS:.0f}")
    return worst


def attempt_reserve(timeout: float, last_prepare: float) -> float:
    """Time that must be left before the flush deadline for another attempt."""
    return timeout + max(20.0, 1.5 * last_prepare)


@dataclass(frozen=True)
class Config:
    keep: tuple[str, tuple] | None
    drop: tuple[str, tuple] | None
    typed: tuple[tuple[str, str], ...]
    variant: tuple[str, ...]
    sort: tuple[str, ...]
    partition: tuple[Field, ...]
    offset_reset: str
    codec: str
    level: int
    flush_bytes: int
    flush_seconds: int
    include_url: str
    include_shadow: bool
    include_polls: int
    replicas: int
    ordinal: int
    group_id: str
    destination: str
    retry_attempts: int
    retry_seconds: float
    reserve_seconds: float
    include_every: float
    include_startup: float
    include_timeout: float
    include_header: str
    include_token: str
    declared: tuple[str, ...]
    on_invalid: str
    non_finite: bool
    partition_by: str


#: Destinations and the settings that only the other one knows: leaving one behind is refused, not ignored.
DESTINATIONS = {"lake": (), "log": ("PARTITION_BY", "SORT_COLUMNS", "VARIANT_COLUMNS", "DECLARED_VARIANTS")}
_GROUP = re.compile(r"[A-Za-z0-9._-]{1,249}")


def destination_of(name: str, group: str, last: str, env: Mapping[str, str]) -> str:
    """The destination, which a consumer group keeps: one that was another before needs a group of its own."""
    _need(name in DESTINATIONS, f"destination is one of {', '.join(DESTINATIONS)}, not {name!r}")
    left = [k for k in DESTINATIONS[name] if env.get(k, "").strip()]
    _need(not left, f"{', '.join(left)} mean nothing to the destination {name!r}")
    _need(not last or last == name, f"group {group!r} has written to {last!r}: positions of one destination are not those of another")
    return name


def load(env: Mapping[str, str]) -> Config:
    """A configuration of upper-case settings; every rule that is broken stops the start."""
    get = lambda k, d="": env.get(k, d).strip()
    typed = typed_columns(get("TYPED_COLUMNS"))
    url, shadow, polls = get("INCLUDE_URL"), boolean(get("INCLUDE_SHADOW", "false")), int(get("INCLUDE_POLLS", "3"))
    polled_only = bool(url and get("KEEP_FIELD")) and not (shadow or get("KEEP_VALUES"))  # all values come from the URL
    keep = (column_list(get("KEEP_FIELD"))[0], ()) if polled_only else filter_of(get("KEEP_FIELD"), get("KEEP_VALUES"), typed)
    variant, declared = column_list(get("VARIANT_COLUMNS")), column_list(get("DECLARED_VARIANTS"))
    _need(not set(variant) & set(declared), "a column is a declared VARIANT or has a companion, not both")
    _need(not any(v.lower().endswith(SUFFIX) for v in variant), f"variant columns must not end in {SUFFIX}")
    reset, codec = get("OFFSET_RESET", "earliest"), get("CODEC", "zstd")
    _need(reset in ("earliest", "latest"), f"offset reset is earliest or latest, not {reset!r}")
    _need(codec in CODECS, f"codec is one of {', '.join(CODECS)}")
    _need(codec == "zstd" or not get("CODEC_LEVEL"), "only zstd has levels")
    level = int(get("CODEC_LEVEL", "3") or 3)
    _need(1 <= level <= 9, "zstd levels are 1 to 9")
    _need(not url or keep is not None, "a polled include set needs the keep filter")
    _need(bool(url) or not (shadow or get("INCLUDE_HEADER") or get("INCLUDE_TOKEN")), "include settings need a URL")
    _need(bool(get("INCLUDE_HEADER")) == bool(get("INCLUDE_TOKEN")), "header and token go together")
    _need(polls >= 1, "include polls are at least 1")
    replicas = int(get("REPLICAS", "1"))
    try:
        spec = parse_spec(get("PARTITION_BY")) if get("PARTITION_BY") else ()
    except ValueError as e:
        raise ConfigError(str(e)) from e
    flush_bytes, flush_seconds = int(get("FLUSH_BYTES", str(128 << 20))), int(get("FLUSH_SECONDS", "60"))
    _need(flush_bytes > 0 and flush_seconds > 0, "flush limits are positive")
    group = get("GROUP_ID", "larkspur")
    _need(bool(_GROUP.fullmatch(group)), f"group id {group!r} is no name")
    destination = destination_of(get("DESTINATION", "lake"), group, get("LAST_DESTINATION"), env)
    attempts, timeout = int(get("RETRY_ATTEMPTS", "5")), float(get("RETRY_TIMEOUT", "30"))
    worst = retry_ladder(attempts, float(get("RETRY_BASE", "0.5")), float(get("RETRY_CAP", "30")), timeout)
    reserve = attempt_reserve(timeout, 0.0)
    _need(reserve < LIVENESS - worst / attempts, f"an attempt needs {reserve:.0f} s before the limit of {LIVENESS:.0f}")
    return Config(
        keep, filter_of(get("DROP_FIELD"), get("DROP_VALUES"), typed), typed, variant, column_list(get("SORT_COLUMNS")), spec, reset, codec, level,
        flush_bytes, flush_seconds, url, shadow, polls, replicas, ordinal_of(get("HOSTNAME", "ingest-0"), replicas),
        group, destination, attempts, timeout, reserve,
        seconds(get("INCLUDE_EVERY", "60"), "INCLUDE_EVERY"), seconds(get("INCLUDE_STARTUP", "60"), "INCLUDE_STARTUP"), seconds(get("INCLUDE_TIMEOUT", "10"), "INCLUDE_TIMEOUT"),
        get("INCLUDE_HEADER"), get("INCLUDE_TOKEN"), declared, word(get("ON_INVALID", "null"), ("null", "raise"), "ON_INVALID"), boolean(get("NON_FINITE", "false")), get("PARTITION_BY"),
    )
