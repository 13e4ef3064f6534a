"""Secret scans with multipart credential linking.

Base spans are single-pattern matches.  On top of them, weaker candidates
(bare secret-shaped strings and endpoints) are joined by position with access
identifiers and other parts inside a scope; a weak candidate is reported only
when a complementary part lies in the same scope.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .workspace import text_slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")

#: Weak parts.  A bare secret is a whole run of 32 or more base64-like characters of mixed
#: kinds and high entropy, also after "=" or "."; a weak identifier is an id-shaped assignment.
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3)://[^\s\"'<>]{4,}")
IDENT = re.compile(
    r"""\b(?:user(?:name|_id)?|client_?id|account(?:_?id)?|access_?key(?:_?id)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
#: User and password of an endpoint: whatever comes before its last "@", as passwords may hold "/", "?" and "#".
USERINFO = re.compile(r"(?<=://).+(?=@)")
WEAK_KINDS = ("bare", "endpoint", "ident")
KINDS = BASE_KINDS + WEAK_KINDS
_RANK = {k: i for i, k in enumerate(KINDS)}
#: What each part stands for in a credential.
ROLE = {"assign": "secret", "hex": "secret", "bare": "secret", "access": "id", "ident": "id", "endpoint": "place"}

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_IDWORDS = ("user", "client", "account", "access", "login")


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    out = []
    low = text.lower()
    if any(w in low for w in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[1], _RANK[s[0]]))
    return out


def _weak(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    ends = [0]
    for _, _, e in sorted(taken, key=lambda s: s[1]):
        ends.append(max(ends[-1], e))
    starts = sorted(s for _, s, _ in taken)

    def free(a: int, b: int) -> bool:  # overlaps no base span
        return ends[bisect.bisect_left(starts, b)] <= a

    out = []
    for m in BARE.finditer(text):
        s = m.group()
        if free(m.start(), m.end()) and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and _entropy(s) >= 3.5:
            out.append(("bare", m.start(), m.end()))
    if "://" in text:
        out += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text) if free(m.start(), m.end())]
    low = text.lower()
    if any(w in low for w in _IDWORDS):
        out += [("ident", m.start(), m.end()) for m in IDENT.finditer(text) if free(m.start(), m.end())]
    return out


def link_parts(text: str, base: list[tuple[str, int, int]], scope: int) -> list[tuple[str, int, int]]:
    """Weak parts that a complementary part accompanies within ``scope`` code points.

    Complementary: an identifier for a secret, a secret for an identifier, weak
    ones supporting each other; and for an endpoint an identifier or a secret that
    is reported itself.  Endpoints support nothing.  A scope ends at a blank line.
    """
    weak = _weak(text, base)
    if not weak:
        return []
    walls = [m.start() for m in re.finditer(r"\n[ \t]*\n", text)]
    found = _supported([w for w in weak if ROLE[w[0]] != "place"], base + weak, walls, len(text), scope)
    return found + _supported([w for w in weak if ROLE[w[0]] == "place"], base + found, walls, len(text), scope)


_WANTS = {"secret": ("id",), "id": ("secret",), "place": ("id", "secret")}


def _supported(asked: list[tuple[str, int, int]], parts: list[tuple[str, int, int]], walls: list[int], size: int, scope: int) -> list[tuple[str, int, int]]:
    """Interval join: the asked spans with a part of a wanted role inside the scope around them."""
    reach = {}
    for role in ("secret", "id"):
        spans = sorted((s, e) for k, s, e in parts if ROLE[k] == role)
        top: list[int] = []
        for _, e in spans:
            top.append(max(e, top[-1]) if top else e)
        reach[role] = ([s for s, _ in spans], spans, top)

    def near(role: str, s: int, e: int) -> bool:
        w = bisect.bisect_right(walls, s)
        lo = max(s - scope, walls[w - 1] if w else 0)
        hi = min(e + scope, walls[w] if w < len(walls) else size)
        starts, spans, top = reach[role]
        j = bisect.bisect_left(starts, hi) - 1  # spans that start before the scope ends
        while j >= 0 and top[j] > lo:
            a, b = spans[j]
            if b > lo and (b <= s or a >= e):
                return True
            j -= 1
        return False

    return [(k, s, e) for k, s, e in asked if any(near(r, s, e) for r in _WANTS[ROLE[k]])]


def all_spans(text: str, scope: int = 256) -> list[tuple[str, int, int]]:
    """Base spans and linked weak spans, by start, then kind."""
    base = base_spans(text)
    return sorted(base + link_parts(text, base, scope), key=lambda s: (s[1], _RANK[s[0]], s[2]))


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCAN_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, scope: int = 256) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with its secret spans.

    A null text counts as empty: no spans and the digest of the empty string.
    Repeated rows give repeated rows, a null doc_id stays null, an empty table
    gives no rows; columns other than ``doc_id`` and ``text`` are not read.
    """

    def run(batches):
        for b in text_slices(batches):
            rows = []
            for text in b.column(1).to_pylist():
                spans = all_spans(text or "", scope)
                base = [s for s in spans if s[0] in BASE_KINDS]
                n = [sum(s[0] == k for s in base) for k in BASE_KINDS]
                rows.append((*n, hashlib.sha256(spell(base).encode()).hexdigest(), spell(spans)))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCAN_SCHEMA)


def mask_text(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """``text`` with each maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def userinfo(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The user and password parts of the endpoints in ``spans``."""
    found = [(s, USERINFO.search(text[s:e])) for k, s, e in spans if k == "endpoint"]
    return [("userinfo", s + m.start(), s + m.end()) for s, m in found if m]


def mask(docs: DataFrame, scope: int = 256, kinds: tuple[str, ...] = ("assign", "access", "hex", "bare", "ident")) -> DataFrame:
    """``docs`` with secrets masked in ``text``; every other column and every row stays.

    Of reported endpoints the user and password are masked, whatever ``kinds``.
    ``n_chars``, if there, is set to the new length of changed texts.  Null texts stay null.
    """
    names = docs.columns
    ti = names.index("text")
    ci = names.index("n_chars") if "n_chars" in names else None

    def masked(t):
        spans = all_spans(t, scope)
        return mask_text(t, [s for s in spans if s[0] in kinds] + userinfo(t, spans))

    def run(batches):
        for b in text_slices(batches):
            before = b.column(ti).to_pylist()
            after = [t and masked(t) for t in before]
            cols = list(b.columns)
            cols[ti] = pa.array(after, b.schema.field(ti).type)
            if ci is not None:
                kept = cols[ci].to_pylist()
                cols[ci] = pa.array([len(y) if y is not x and y != x else k for x, y, k in zip(before, after, kept)], b.schema.field(ci).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
