"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is the encoding of its text exactly if the encoding of every two
neighbours together is these two.  So a word need not be merged step by step: an
Aho-Corasick automaton over the reversed tokens gives, in one pass, the longest token that
starts at every place; the encoder takes it, falls back to the next shorter token where it
is not compatible with the token before it, and gives the last token back where nothing
fits (each place is given up at most once, so a word takes linear time).  Compatibility of
two tokens is found by undoing their merges, latest first, and is kept in a table.

Symbols are bytes; a tokenizer with an end-of-word mark has a second form of each byte for
the last one of a word.  Which words a text has is the tokenizer's own business: its
normalizer and pre-tokenizer are asked, except that pieces of Latin letters and ASCII go
through the same pattern here, and that the ids of frequent pieces are kept (two
generations of a bounded number each).

Decoding copies the token strings out of one buffer by their offsets, with the joint that
the library puts between them.

Defined cases: a NULL or empty text has no ids and decodes to the empty text; NULL ids
decode to NULL; very long texts and very long words take linear time; the string of an
added token gives that token's id, as in the library; rows that repeat, tie or lack a
doc_id are rows like any other; an empty table gives an empty result; further columns of
any name are kept, except one that has the name of a result, which is replaced.
Truncation and padding of the file are not used.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_FILE = "word_bpe_49k.json"
KEPT_PIECES = 200_000        # of each generation of a worker's cache, some 30 MB
KEPT_PAIRS = 1_000_000       # of the pair table
NEVER = 1 << 60
LATIN_END = "\u0250"         # characters below it (but for the dotted capital I) are stable under NFC and have single lower-case forms
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
CLOSING = ".,;:!?"
FINAL = 256                  # the last byte b of a word is symbol FINAL + b where the tokenizer marks word ends


def tokenizer_file(name: str = WORD_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Kept(dict):
    """A memo of ``make`` that keeps what was asked for lately: two generations of ``most`` entries."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Merges:
    """The vocabulary of a byte-pair file as symbols, splits and ranks, and the encoder of one word."""

    def __init__(self, model: dict):
        odd = {k: model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")}
        if model.get("type") != "BPE" or any(odd.values()):
            raise ValueError(f"not a plain byte-pair model: {model.get('type')}, {odd}")
        import ahocorasick
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_of_letter()
        self.marks_end = bool(suffix)
        size = max(vocab.values()) + 1
        self.symbols = [""] * size
        self.split = [(-1, -1)] * size
        self.rank = [-1] * size                       # of the merge that makes a token; single symbols have none
        self.merged: dict[int, int] = {}              # the rank of two tokens that merge
        self.size = size
        for letter, byte in letters.items():
            for text, symbol in ((letter, chr(byte)), (letter + suffix, chr(byte + FINAL))):
                if text in vocab and (suffix or symbol < chr(FINAL)):
                    self.symbols[vocab[text]] = symbol
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.merged[a * size + b] = rank
            if self.rank[made] < 0 and not self.symbols[made]:
                self.symbols[made], self.split[made], self.rank[made] = self.symbols[a] + self.symbols[b], (a, b), rank
        self.length = [len(s) for s in self.symbols]
        self._fits: dict[int, bool] = {}
        alone = [False] * size                        # tokens that are the encoding of their own symbols
        ids = sorted((t for t in range(size) if self.symbols[t]), key=lambda t: (self.rank[t], t))
        for t in ids:
            a, b = self.split[t]
            alone[t] = a < 0 or (alone[a] and alone[b] and self._undo(a, b, self.rank[t]))
        self.single = {self.symbols[t]: t for t in ids if alone[t]}
        self.automaton = ahocorasick.Automaton()
        for s, t in self.single.items():
            self.automaton.add_word(s[::-1], t)
        self.automaton.make_automaton()
        self.shorter = [-1] * size                    # the longest token that a token begins with, itself aside
        for s, t in self.single.items():
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in self.single:
                    self.shorter[t] = self.single[s[:n]]
                    break

    def _undo(self, a: int, b: int, own: int = -1) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before those inside them.

        The merges inside are undone from the last to the first; while a state stands, a merge
        across the border would have to be of a lower rank than the one just undone, or of the
        same rank and further left.  ``own``: the rank of the pair's own merge, which may stand.
        """
        size, rank, split, merged = self.size, self.rank, self.split, self.merged
        before = NEVER if own < 0 else own
        while True:
            across = merged.get(a * size + b, NEVER)
            if across < before:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = ra, split[a][1]           # an equal merge in the left token comes first
            else:
                before, b = rb + 1, split[b][0]       # an equal merge across the border comes first

    def _judge(self, key: int) -> bool:
        if len(self._fits) >= KEPT_PAIRS:
            self._fits.clear()
        fit = self._fits[key] = self._undo(*divmod(key, self.size))
        return fit

    def encode(self, word: bytes) -> list[int]:
        """The ids of one word."""
        s = word.decode("latin-1")
        if not s:
            return []
        if self.marks_end:
            s = s[:-1] + chr(FINAL + word[-1])
        whole = self.single.get(s)
        if whole is not None:
            return [whole]
        n = len(s)
        longest = [-1] * n
        for end, token in self.automaton.iter(s[::-1]):
            if longest[~end] < 0:                     # the longest comes first
                longest[~end] = token
        length, shorter, size, fits = self.length, self.shorter, self.size, self._fits
        out: list[int] = []
        given_up = set()
        at, token = 0, longest[0]
        while token >= 0 or out:
            if token < 0:                             # nothing that starts here fits: no token may end here
                given_up.add(at)
                token = out.pop()
                at -= length[token]
            end = at + length[token]
            if end not in given_up:
                if out:
                    key = out[-1] * size + token
                    fit = fits.get(key)
                    if fit is None:
                        fit = self._judge(key)
                if not out or fit:
                    out.append(token)
                    if end == n:
                        return out
                    at, token = end, longest[end]
                    continue
            token = shorter[token]
        raise ValueError("the vocabulary lacks a byte of the text")


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(spec["model"])
        self._letters = {ord(c): chr(b) for c, b in byte_of_letter().items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        plain = all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens") or [])
        if not plain:
            raise ValueError("added tokens that take the text around them are not supported")
        self._added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        pattern = self._word_pattern(spec)
        self._pattern = regex.compile(pattern) if pattern else None
        self._words = Kept(lambda w: self._ids(self.merges.encode(w.encode())), kept)
        self._pieces = Kept(self._piece, kept)
        tokens = [""] * max([self.merges.size, *(i + 1 for i in self.added.values())])
        for text, i in [*spec["model"]["vocab"].items(), *self.added.items()]:
            tokens[i] = text
        joint = " " if self.library.decoder is None else None
        if joint is None:
            raise ValueError("only files without a decoder of their own are decoded")
        parts = [(joint + t).encode() for t in tokens]
        self.joint = len(joint)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)

    @staticmethod
    def _word_pattern(spec: dict) -> str | None:
        """The pattern of words, where white space parts them and the text is but composed and lower-cased before."""
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        simple = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": "\\s+"}
                  and steps[1]["content"] == " " and [p["type"] for p in pre] == ["Split", "ByteLevel"]
                  and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"])
        return pre[0]["pattern"]["Regex"] if simple and "Regex" in pre[0]["pattern"] else None

    def _library_words(self, text: str) -> bytes:
        """Words as the file's own normalizer and pre-tokenizer give them."""
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        words = [(text, None)] if self.library.pre_tokenizer is None else self.library.pre_tokenizer.pre_tokenize_str(text)
        return self._ids(i for w, _ in words for i in self.merges.encode(w.translate(self._letters).encode("latin-1")))

    @staticmethod
    def _ids(ids) -> bytes:
        return array("I", ids).tobytes() if LITTLE else np.fromiter(ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() and (max(piece) >= LATIN_END or "\u0130" in piece):
            return self._library_words(piece)
        word = piece.rstrip(CLOSING)
        if word.isalpha():
            word, close = self._words[word.lower()], piece[len(word):]
            return word + self._words[close] if close else word
        return b"".join(map(self._words.__getitem__, self._pattern.findall(piece.lower())))

    def _text(self, text: str) -> bytes:
        # str.split() also cuts at four control characters that the library takes for text
        if self._pattern is None or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self._library_words(text)
        return b"".join(map(self._pieces.__getitem__, text.split()))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._added is None or not self._added.search(text):
            return self._text(text)
        out, at = [], 0
        for m in self._added.finditer(text):
            out += [self._text(text[at:m.start()]), self._ids([self.added[m.group()]])]
            at = m.end()
        return b"".join([*out, self._text(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8."""
        i = np.frombuffer(ids, "<u4")
        if not len(i):
            return b""
        start, size = self.offsets[i], self.offsets[i + 1] - self.offsets[i]
        end = np.cumsum(size)
        at = np.repeat(start - end + size, size) + np.arange(end[-1])
        return self.buffer[at[self.joint:]].tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each Python worker and file."""
    return Codec(path)


def token_ids(text: Column, path: str) -> Column:
    """The ids of a text: BINARY, little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([c.encode(t) for t in texts], dtype=object)

    return encode(text)


def decoded_text(ids: Column, path: str) -> Column:
    """The text that ids stand for."""

    @F.pandas_udf("binary")
    def decode(rows: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([None if r is None else c.decode(r) for r in rows], dtype=object)

    return decode(ids).cast("string")


def encode_documents(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (see :func:`token_ids`)."""
    return docs.withColumn("token_ids", token_ids(F.col(text).cast("string"), path or tokenizer_file()))


def decode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``decoded_text``, decoded from its ``token_ids``."""
    return docs.withColumn("decoded_text", decoded_text(F.col("token_ids"), path or tokenizer_file()))
