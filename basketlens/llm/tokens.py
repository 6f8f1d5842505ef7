"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once per task.

A byte-pair tokenizer splits a text before it merges, and never across the places used here: before
a run of white space, and between a run of Latin letters and a run of ASCII punctuation. The pieces
between such places can therefore be encoded alone. Texts with white space other than space and
newline, or with the string of a special token, are given to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = re.escape(".,;:!?|#*$%&()\"=+/@<>[]{}\\^_~-")
CORE = (
    rf"(?:[{LETTERS}]+(?=[ \n{PUNCTUATION}]|\Z)|[{PUNCTUATION}]+(?=[ \n{LETTERS}]|\Z)|[^ \n]+)"
)
WORDS = 10_000  # words that the library remembers by default
KEEP = 1_000_000
SLICE = 1 << 20  # bytes of text to encode at once, as their pieces are held until all have ids
# All white space but space and newline, one search each: faster than a pattern over every character.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, ``bytes`` per text.

    ``keep`` bounds how many pieces are remembered; beyond it only those of the texts at hand stay, which
    have the frequent ones among them. Results do not depend on it.
    """

    def __init__(self, path: str, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep = keep
        self.known: dict[str, bytes] = {}
        # What makes a text be given to the library whole.
        self.whole = OTHER_SPACES + [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Tokenizers that drop white space give one id list to " word" and "word".
        self.blank = not self.ids(" \n ")
        self.pieces = re.compile(CORE if self.blank else rf"[ \n]*{CORE}|[ \n]+").findall
        # A string that is always one id of its own, to join pieces that do not contain its core.
        self.mark, self.core, found = (" 7 ", "7", self.ids("7")) if self.blank else ("\n", "\n", self.ids("\n"))
        self.mark_id = found[0] if len(found) == 1 else None
        self.remember = getattr(self.tokenizer.model, "_resize_cache", lambda capacity: None)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _each(self, pieces: list[str]) -> None:
        for piece, e in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            self.known[piece] = array("I", e.ids).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Every piece is met here once, so the library's own memory of words would only cost time; texts
        given to it whole have that memory."""
        self.remember(0)
        self._learn_new(pieces)
        self.remember(WORDS)

    def _learn_new(self, pieces: list[str]) -> None:
        """Pieces joined by the mark take one call, not one each; a wrong count of marks falls back."""
        if self.mark_id is None:
            return self._each(pieces)
        plain = [p for p in pieces if self.core not in p]
        self._each([p for p in pieces if self.core in p])
        known = self.known
        for k in range(0, len(plain), 4000):
            part = plain[k : k + 4000]
            joined = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
            if len(cuts) != len(part) - 1:
                self._each(part)
                continue
            raw, start = ids.tobytes(), 0
            for piece, end in zip(part, [*cuts, len(raw)]):
                known[piece] = raw[start:end]
                start = end + 4

    def encode(self, texts: list[str | None]) -> list[bytes]:
        full = len(self.known) > self.keep
        look = self.known.get
        found: list[list[bytes | None]] = []
        seen: set[str] = set()
        missed: list[tuple[list, list[str], list[int]]] = []  # ids of a text, its pieces, places not known
        new: set[str] = set()
        for text in texts:
            if text and any(c in text for c in self.whole):
                found.append([array("I", self.ids(text)).tobytes()])
                continue
            pieces = self.pieces(text or "")
            ids = list(map(look, pieces))
            found.append(ids)
            if full:
                seen.update(pieces)
            if None in ids:
                places = [i for i, x in enumerate(ids) if x is None]
                new.update([pieces[i] for i in places])
                missed.append((ids, pieces, places))
        if new:
            self._learn(list(new))
            known = self.known
            for ids, pieces, places in missed:
                for i in places:
                    ids[i] = known[pieces[i]]
        if full:
            self.known = {piece: self.known[piece] for piece in seen}
        return [b"".join(ids) for ids in found]


_encoders: dict[str, Encoder] = {}


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """One encoder per tokenizer and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].keep = keep
    return _encoders[path]
