"""Token ids of whole texts by a public tokenizer file of the ``tokenizers`` library.

The library splits a text into words before it merges, so the ids of a text are those
of its pieces in turn, as long as the cuts fall where the library cuts too.  Texts repeat
their words, so each Python worker keeps the ids of the pieces it has met lately (a bounded
number, frequent ones stay) and asks the library only for new ones: a new piece of Latin
letters and closing punctuation is looked up without its punctuation and case, and goes
straight to the library's merge model if that is new too; any other goes through the
library's whole chain.  A text with an unusual white space sequence, or with the
string of an added token, which the library gives the token's id, goes to the library whole.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from quarry.llm.bpe import LITTLE, Kept

CACHE_PIECES = 500_000     # some 80 MB a worker
CLOSING = ".,;:!?"
MARKS = CLOSING + "#$%&*+-/=@^_~|()[]{}<>\""      # the byte-level pattern takes a run of them after letters for one word
LATIN_END = "\u0250"      # letters below it are single, composed and keep their case pairs


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


_LETTERS = byte_letters()


class _Unusual(Exception):
    """The text has white space at which the library may cut otherwise."""


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``cut``: ``words`` for tokenizers that drop white space, ``spaces`` for byte-level
    ones that join a single space to the word after it, ``whole`` to cut nothing.
    """

    def __init__(self, path: str, cut: str = "whole", cache: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added]
        if any(t.normalized for t in added):             # sought in the normalised text, which pieces do not show
            cut = "whole"
        self._cut = {"words": self._words, "spaces": self._spaces, "whole": self.whole}[cut]
        self.model = self.tokenizer.model
        self._lower = cut == "words"
        self._tails: dict[str, bytes] = {}
        self._cores = Kept(self._core, cache).__getitem__

        def new(piece: str) -> bytes:
            if cut != "spaces":
                return self._piece("", piece)
            # after the first word a piece stands for a space, or a line break of its own, and a word
            body = piece[1:] if piece[:1] == "\n" else piece
            if not body or body[0].isspace():
                raise _Unusual
            return self._piece("\n" if piece[0] == "\n" else " ", body)

        def spaced(piece: str) -> bytes:
            # letters behind a space, and a run of marks that the library cuts off as one word
            word = piece.rstrip(MARKS)
            if not word.isalpha() or not (word.isascii() or max(word) < LATIN_END):
                return new(piece)
            if len(word) == len(piece):
                return self._core(" " + word)
            return self._get(word) + self._cores(piece[len(word):])

        self._get = Kept(spaced if cut == "spaces" else new, cache).__getitem__

    def encode(self, text: str) -> bytes:
        for token in self._added:
            if token in text:
                return self.whole(text)
        return self._cut(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, lead: str, body: str) -> bytes:
        word = body.rstrip(CLOSING)
        tail = body[len(word):]
        if self._lower:
            word = word.lower()
        if not word.isalpha() or not (word.isascii() or max(word) < LATIN_END):
            return self.whole(lead + body)
        if lead == "\n":
            core = self._cores(lead) + self._cores(word)
        else:
            core = self._cores(lead + word)
        if not tail:
            return core
        if tail not in self._tails:
            self._tails[tail] = self._core(tail)
        return core + self._tails[tail]

    def _core(self, word: str) -> bytes:
        if word.isascii():                               # letters and marks, which stand for themselves, behind white space
            letters = word.replace(" ", _LETTERS[32]).replace("\n", _LETTERS[10])
        else:
            letters = word.encode().decode("latin-1").translate(_LETTERS)
        ids = [t.id for t in self.model.tokenize(letters)]
        return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()

    def _words(self, text: str) -> bytes:
        # str.split() also cuts at four control characters that the library takes for text
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self.whole(text)
        return b"".join(map(self._get, text.split()))

    def _spaces(self, text: str) -> bytes:
        first, *rest = text.replace("\n", " \n").split(" ")
        if not first:
            return self.whole(text)
        try:
            return self._piece("", first) + b"".join(map(self._get, rest))
        except _Unusual:
            return self.whole(text)


@lru_cache(maxsize=2)
def encoder(path: str, cut: str, cache: int = CACHE_PIECES) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path, cut, cache)
