"""Library tokenizers with a bounded memo of the parts of a text that tokens never span.

``.model`` files go to sentencepiece, ``.json`` files to tokenizers.  A text is cut
into parts only where the vocabulary rules out a token across the cut; each
distinct part a worker meets is encoded by the library once.  For vocabularies
without such cuts the whole text is one part and nothing is kept.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import os
import re
from array import array

#: Distinct parts in a generation of a worker's memo; the one before it stays readable.
PARTS = 300_000


@contextlib.contextmanager
def _no_gc():
    """Memos and parts are many objects without cycles; scanning them costs more than encoding."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Memo(dict):
    """Two generations of entries: what is still in use moves on when a generation is full."""

    def __init__(self):
        super().__init__()
        self.before: dict = {}

    def learn(self, wanted: set, make) -> None:
        """Sees to it that all of ``wanted`` are entries."""
        new = wanted.difference(self)
        if not new:
            return
        if len(self) + len(new) > PARTS and len(self) > 0:
            self.before = dict(self)
            self.clear()
            new = wanted
        old = self.before
        if old:
            known = [p for p in new if p in old]
            self.update(zip(known, map(old.__getitem__, known)))
            new = new.difference(known)
        todo = list(new)
        self.update(zip(todo, make(todo)))


class Tokenizing:
    def __init__(self, path: str):
        self.path = path
        if path.endswith(".model"):
            self._open_model()
        elif path.endswith(".json"):
            self._open_json()
        else:
            raise ValueError(f"no library for {path}")
        self._ids = Memo()
        self._n = Memo()

    # sentencepiece -----------------------------------------------------------------

    def _open_model(self) -> None:
        import sentencepiece

        sp = self._sp = sentencepiece.SentencePieceProcessor(model_file=self.path)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        mark = "▁"
        self._mark_id = sp.piece_to_id(mark)
        plain = all(sp.decode(sp.encode(s)) == s for s in ("  a  b ", " ﬁΩ  "))
        cuts = not any(mark in p.lstrip(mark) for p in pieces) and sp.encode(" a") != sp.encode("a")
        self._cut = self._cut_marks if plain and cuts and not sp.is_unknown(self._mark_id) else None
        self._batch = self._batch_model

    @staticmethod
    def _cut_marks(text: str) -> list[str]:
        """Parts whose ids, each with its own dummy prefix, are those of the text in order."""
        text = text.replace("▁", " ")  # the mark itself counts as a space
        if "  " not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ") if text else []
        parts = re.findall(r" *[^ ]+| +", text)
        return [parts[0], *[p[1:] for p in parts[1:]]]

    def _batch_model(self, parts: list[str]) -> list[list[int]]:
        got = self._sp.encode(parts, num_threads=1)
        if self._cut:  # an empty part stands for a lone space mark
            return [ids if p else [self._mark_id] for p, ids in zip(parts, got)]
        return got

    # tokenizers --------------------------------------------------------------------

    def _open_json(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self._tk = Tokenizer.from_file(self.path)
        self._tk.no_truncation()
        self._tk.no_padding()
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        self._cut = self._cut_white if self._drops_white_space(spec) else None
        self._special = [t["content"] for t in spec.get("added_tokens", [])]
        if self._cut and self.PATTERN == (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])[0]["pattern"]["Regex"]:
            self._cut = self._cut_stems
        self._fast = getattr(self._tk, "encode_batch_fast", self._tk.encode_batch)
        suffix = spec["model"].get("end_of_word_suffix")
        self._word_ends = {i for t, i in spec["model"].get("vocab", {}).items() if t.endswith(suffix)} if suffix and self._cut else set()
        self._batch = self._batch_json

    @staticmethod
    def _drops_white_space(spec: dict) -> bool:
        """Whether white space only separates: split away first, kept by no later step."""
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and " " not in pattern
        norms = (spec.get("normalizer") or {}).get("normalizers", [])
        known = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n.get("content") == " ") for n in norms)
        tokens = all(not t["single_word"] and not t["normalized"] and " " not in t["content"] for t in spec.get("added_tokens", []))
        return bool(drops and known and tokens and not spec.get("post_processor"))

    #: The one pattern for which letters may be told apart from what follows them without the library.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _chunks = re.compile(r"[^ \n]+").findall
    #: Beyond Latin letters, and letters whose lower case is not one letter.
    _far = re.compile("[İɐ-\U0010ffff]").search
    _stems = re.compile(r"[a-zªµºß-öø-ɏ]+|[^ \na-zªµºß-öø-ɏ]+").findall
    #: Words that go to the library in one string.
    TOGETHER = 256

    def _cut_white(self, text: str) -> list[str]:
        return self._chunks(text)

    def _cut_stems(self, text: str) -> list[str]:
        """Lower-cased runs of Latin letters, and runs of anything else but white space.

        Texts with apostrophes (which bind letters), special tokens or other letters
        are cut at white space only.
        """
        if "'" in text or self._far(text) or any(t in text for t in self._special):
            return self._chunks(text)
        return self._stems(text.lower())

    def _batch_json(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts; plain words go in strings of many, and tokens that end a word part them again."""
        if self._cut is None or not self._word_ends:
            return [e.ids for e in self._fast(parts, add_special_tokens=False)]
        ends = self._word_ends
        out: dict[str, list[int]] = {}
        words = [s for s in parts if s.isalpha()]
        groups = [words[i : i + self.TOGETHER] for i in range(0, len(words), self.TOGETHER)]
        for group, e in zip(groups, self._fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = e.ids
            at = [i + 1 for i, t in enumerate(ids) if t in ends]
            if len(at) == len(group):
                for w, a, b in zip(group, [0, *at], at):
                    out[w] = ids[a:b]
        left = [s for s in parts if s not in out]
        out.update(zip(left, (e.ids for e in self._fast(left, add_special_tokens=False))))
        return [out[s] for s in parts]

    # both --------------------------------------------------------------------------

    def count(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        if self._cut is None:
            return [len(x) for x in self._batch(texts)]
        with _no_gc():
            parts = [self._cut(t) for t in texts]
            n = self._n
            n.learn(set().union(*parts), lambda todo: map(len, self._batch(todo)))
            return [sum([n[p] for p in ps]) for ps in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self._cut is None:
            return [array("I", x).tobytes() for x in self._batch(texts)]
        with _no_gc():
            parts = [self._cut(t) for t in texts]
            ids = self._ids
            ids.learn(set().union(*parts), lambda todo: [array("I", x).tobytes() for x in self._batch(todo)])
            return [b"".join([ids[p] for p in ps]) for ps in parts]

    @staticmethod
    def version(path: str) -> str:
        """Digest of the vocabulary file and the library's version."""
        import importlib.metadata

        library = "sentencepiece" if path.endswith(".model") else "tokenizers"
        with open(path, "rb") as f:
            data = f.read()
        return hashlib.sha256(data + f"\0{library} {importlib.metadata.version(library)}".encode()).hexdigest()


_open: dict[str, Tokenizing] = {}


def tokenizing(path: str) -> Tokenizing:
    """The worker's tokenizer for a file; loaded once."""
    if path not in _open:
        _open[path] = Tokenizing(path)
    return _open[path]
