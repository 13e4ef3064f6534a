"""Fill-in-the-middle arrangements of texts by piece tables.

A document is a list of descriptors ``(buffer, start, length)`` over two immutable
buffers, its text and the sentinels.  Cutting splits descriptors, an arrangement
permutes them and puts sentinels between, the inverse permutation restores them, and
a hash reads them in turn; no text is copied before it is written out.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import text_slices

UNIT = re.compile(r"[^\n]*\n|[^\n]+")
SENTINELS = ("<P>", "<S>", "<M>")
#: Order in which parts (0 prefix, 1 middle, 2 suffix) follow their sentinels.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: The sentinel of each part.
MARK = {0: 0, 1: 2, 2: 1}
TEXT, MARKS = 0, 1


class PieceTable:
    """Descriptors over immutable buffers."""

    __slots__ = ("buffers", "pieces")

    def __init__(self, buffers: tuple[str, ...], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: str) -> PieceTable:
        return cls((text, "".join(SENTINELS)), [(TEXT, 0, len(text))])

    def cut(self, places: list[int]) -> PieceTable:
        """Descriptors split at ascending places of the whole, one part each between two places (empty ones too)."""
        out, at, rest = [], 0, list(places)
        for buffer, start, length in self.pieces:
            end = at + length
            while rest and rest[0] <= end:
                take = rest.pop(0) - at
                out.append((buffer, start, take))
                start, at, length = start + take, at + take, length - take
            out.append((buffer, start, length))
            at = end
        return PieceTable(self.buffers, out)

    def permute(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def marked(self, parts: tuple[int, ...]) -> PieceTable:
        """A sentinel before each descriptor, the one of the part that it is."""
        size = len(SENTINELS[0])
        out = []
        for part, piece in zip(parts, self.pieces):
            out += [(MARKS, MARK[part] * size, size), piece]
        return PieceTable(self.buffers, out)

    def unmarked(self) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[1::2])

    def chunks(self):
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start : start + length]

    def text(self) -> str:
        return "".join(self.chunks())

    def sha256(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c.encode())
        return h.hexdigest()


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    out = [0] * len(order)
    for to, come in enumerate(order):
        out[come] = to
    return tuple(out)


@dataclass(frozen=True)
class Arranged:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: PieceTable


def numbers(doc_id: int | None, seed: str) -> list[int]:
    """h1 to h4: the first four groups of eight digits of the hash of ``seed:doc_id``."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]


def arrange(doc_id: int | None, text: str, seed: str = "7", rate: int = 100, spm: int = 50) -> Arranged:
    """A text cut into prefix, middle and suffix between lines, and arranged.

    Of a hundred documents ``rate`` are arranged, ``spm`` of a hundred of these suffix
    first.  Empty texts and those that contain a sentinel stay plain.
    """
    ends = [m.end() for m in UNIT.finditer(text)]
    n, (h1, h2, h3, h4), table = len(ends), numbers(doc_id, seed), PieceTable.of(text)
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= rate:
        return Arranged(n, "plain", None, None, table)
    form = "spm" if h4 % 100 < spm else "psm"
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (a, b))
    order = ORDERS[form]
    return Arranged(n, form, a, b - a, table.cut([a, b]).permute(order).marked(order))


def restore(output: str, form: str) -> PieceTable:
    """The original as descriptors over an output: cut at the sentinels of its form, permuted back."""
    table = PieceTable.of(output)
    if form == "plain":
        return table
    order = ORDERS[form]
    cuts = [0]
    for part in order:  # arranged texts contain no sentinel, so the first of each kind is the one put in
        s = SENTINELS[MARK[part]]
        at = output.index(s, cuts[-1])
        cuts += [at, at + len(s)]
    parts = table.cut(cuts[2:])  # sentinel, part, sentinel, part, sentinel, part
    return parts.unmarked().permute(inverse(order))


def fill_in_middle(docs: DataFrame, seed: str = "7", rate: int = 100, spm: int = 50, keep_text: bool = True) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` and, unless left out, ``output``.

    One row per row of ``docs(doc_id, text)``.  Null texts are empty and plain; a null
    doc_id stays null and is hashed as an empty number; rows with one id are cut by the
    same numbers; an empty table gives no rows; other columns are not read.  Lengths
    are code points, null where the text stays plain.
    """
    fields = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
    schema = pa.schema(fields + ([("output", pa.string())] if keep_text else []))
    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string" + (", output string" if keep_text else "")

    def run(batches):
        for b in text_slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = arrange(doc_id, text or "", seed, rate, spm)
                out = x.table.text()
                row = (doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.table.sha256(), restore(out, x.form).sha256())
                rows.append((*row, out) if keep_text else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select("doc_id", F.col("text")).mapInArrow(run, ddl)
