"""SentencePiece BPE encoding and decoding by a last-token table over prefixes.

Under a fixed merge order each prefix of a text has exactly one last token.  The
table is filled left to right: an automaton gives the pieces that end at a
position, and the one that is compatible with the last token of the prefix in
front of it is that position's last token.  Two tokens are compatible when
encoding their concatenation gives just these two.  Ids come from walking the
table backwards from the end.

Texts are first cut where no piece spans the cut, so the work is done once per
distinct segment a worker meets; the memo of segments is bounded.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .workspace import text_slices

SPACE = "▁"
#: Entries that a worker keeps of segments, and of token pairs, before it starts anew.
SEGMENTS = 125_000
PAIRS = 1_000_000


class PieceModel:
    """Encoder and decoder for a SentencePiece BPE model with byte fallback.

    The model must use the identity normaliser, a dummy prefix and no removal of
    extra white space; other settings are refused.
    """

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for probe, want in (("  a  b ", True), (" ﬁΩ", True)):
            if (sp.decode(sp.encode(probe)) == probe) is not want:
                raise ValueError("only models with the identity normaliser are supported")
        n = sp.vocab_size()
        self.text: list[str] = []  # what each id decodes to; bytes over 0x7F as lone surrogates
        self.score: dict[str, tuple[float, int]] = {}
        self.byte_id = [-1] * 256
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b] = i
                self.text.append(chr(b) if b < 0x80 else chr(0xDC00 + b))
            elif sp.is_control(i):
                self.text.append("")
            elif sp.is_unknown(i):
                self.text.append(" ⁇ ")
            else:
                self.text.append(piece.replace(SPACE, " "))
                self.score[piece] = (-sp.get_score(i), i)
        if min(self.byte_id) < 0:
            raise ValueError("only models with byte fallback are supported")
        self.singles = {p for p in self.score if len(p) == 1}
        #: Characters after which a piece can go on with a space mark; a cut in front of a mark must not follow one.
        self._cut_ok = not any(SPACE in p.lstrip(SPACE) for p in self.score)
        self.alone = {p: i for p, (_, i) in self.score.items() if self._merge(p) == [p]}
        self.length = {i: len(p) for p, i in self.alone.items()}
        self.auto = ahocorasick.Automaton()
        for p, i in self.alone.items():
            self.auto.add_word(p, (len(p), i))
        self.auto.make_automaton()
        self.piece = {i: p for p, i in self.alone.items()}
        self._pair: dict[tuple[int, int], bool] = {}
        self._seg: dict[str, tuple[int, ...]] = {}
        self._split = re.compile(f"{SPACE}*[^{SPACE}\\n]+|\\n|{SPACE}+")

    def _merge(self, s: str) -> list[str]:
        """The merge procedure itself; only for vocabulary checks and pair tests of short strings."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                got = self.score.get(parts[k] + parts[k + 1])
                if got is not None and (best is None or got[0] < best):
                    best, at = got[0], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether the concatenation of two tokens encodes to just these two."""
        key = (a, b)
        got = self._pair.get(key)
        if got is None:
            if len(self._pair) >= PAIRS:
                self._pair.clear()
            x, y = self.piece[a], self.piece[b]
            got = self._pair[key] = self._merge(x + y) == [x, y]
        return got

    def encode_run(self, s: str) -> list[int]:
        """Ids of a string of known characters (space marks in place, no dummy prefix)."""
        whole = self.alone.get(s)
        if whole is not None:
            return [whole]
        n = len(s)
        last = [-1] * (n + 1)  # last[e]: the last token of s[:e]
        length, pair, compatible = self.length, self._pair, self.compatible
        for end, (size, token) in self.auto.iter(s):
            e = end + 1
            if last[e] >= 0:
                continue
            start = e - size
            if start == 0:
                last[e] = token
            else:
                before = last[start]
                if before >= 0:
                    ok = pair.get((before, token))
                    if ok or (ok is None and compatible(before, token)):
                        last[e] = token
        out = []
        e = n
        while e:
            t = last[e]
            if t < 0:
                raise ValueError("the model's pieces have no last-token table")
            out.append(t)
            e -= length[t]
        out.reverse()
        return out

    def _segment(self, s: str) -> tuple[int, ...]:
        got = self._seg.get(s)
        if got is None:
            if len(self._seg) >= SEGMENTS:
                self._seg.clear()
            if self.singles.issuperset(s):
                ids = self.encode_run(s)
            else:  # characters without a piece become bytes, and nothing merges across them
                ids, run = [], []
                for c in s:
                    if c in self.singles:
                        run.append(c)
                    else:
                        ids += self.encode_run("".join(run)) if run else []
                        run = []
                        ids += [self.byte_id[b] for b in c.encode("utf-8", "surrogatepass")]
                ids += self.encode_run("".join(run)) if run else []
            got = self._seg[s] = tuple(ids)
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of a text, as the library gives them (dummy prefix, no begin or end ids)."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        parts = self._split.findall(marked) if self._cut_ok and "\n" not in self.singles else [marked]
        out: list[int] = []
        add, seg, new = out.extend, self._seg, self._segment
        for p in parts:
            add(seg.get(p) or new(p))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the dummy prefix goes, and bytes that are no UTF-8 become U+FFFD one by one."""
        table = self.text
        s = "".join([table[i] for i in ids])
        if s[:1] == " " and ids[0] != self.byte_id[0x20]:
            s = s[1:]
        try:
            s.encode()
        except UnicodeEncodeError:
            s = re.sub("[\udc80-\udcff]+", lambda m: _bytes_to_text(bytes(ord(c) - 0xDC00 for c in m.group())), s)
        return s


def _bytes_to_text(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for n in (2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_models: dict[str, PieceModel] = {}


def model_of(path: str) -> PieceModel:
    """The worker's model for a file; loaded once."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


ROUND_TRIP = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """Encodes each ``text``, decodes the ids, and returns digests per row of ``docs(doc_id, text)``.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the
    decoded text in UTF-8.  A null text counts as empty (no ids).  Repeated rows and
    a null doc_id pass through; an empty table gives no rows.
    """

    def run(batches):
        model = model_of(model_file)
        name: dict[int, str] = {}
        for b in text_slices(batches):
            rows = []
            for text in b.column(1).to_pylist():
                ids = model.encode(text or "")
                if not name:
                    name = [str(i) for i in range(len(model.text))]  # type: ignore[assignment]
                back = model.decode(ids)
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(",".join([name[i] for i in ids]).encode()).hexdigest(),
                        hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
                    )
                )
            n, a, d = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {ROUND_TRIP}")


def encode_ids(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs(doc_id, text)`` with the ids of each text as ``ids array<int>``."""

    def run(batches):
        model = model_of(model_file)
        for b in text_slices(batches):
            ids = [model.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, model_file: str) -> DataFrame:
    """``rows(doc_id, ids)`` with the decoded text as ``text``; null ids count as none."""

    def run(batches):
        model = model_of(model_file)
        for b in batches:
            texts = [model.decode(i or []) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
