"""Benchmark decontamination with one Aho-Corasick automaton over word sequences.

Test items are cut into windows of ``WINDOW`` consecutive normalised words (an item with
fewer words is one window).  The windows become one automaton whose alphabet is the
items' own vocabulary; a text is scanned once, each of its words being one symbol, and
every match marks its words as hit.  Word numbers map back to character offsets of the
original text, so hits are reported as spans of it.

Items are few beside the corpus, but nothing limits them: their windows are dealt into
blocks of at most ``BLOCK_WORDS`` window words, each block an automaton of bounded size;
one block (the usual case) is scanned in one pass, more blocks one after the other.

Defined cases: a NULL text has no words and is never contaminated; NULL or wordless items
have no windows; an item without an id marks words but is not listed; items that repeat
an id count once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
MIN_SHARE = 20            # contaminated from 1/20 of the words on
BLOCK_WORDS = 4_000_000

# Fixed by the contract: A-Z is lower-cased; digits, a-z and all beyond ASCII are word characters.
WORD_RE = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes(b if (48 <= b < 58 or 97 <= b < 123 or b >= 128) else b + 32 if 65 <= b < 91 else 32 for b in range(256))

RESULT = ("n_words bigint, n_hit bigint, n_items bigint, items array<bigint>, items_sha256 string, "
          "contaminated boolean, spans array<struct<start:bigint,end:bigint>>")
FIELDS = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "spans"]


def word_list(text: str | None) -> list[bytes]:
    # UTF-8 bytes beyond ASCII are word characters, so the cut can be made on bytes
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(text: str | None, size: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = word_list(text)
    return [tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def window_blocks(items: Iterator, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[list]:
    """Blocks of ``(window, item id)``, each of at most ``block_words`` words in all."""
    blocks, used = [[]], 0
    for item_id, text in items:
        for w in windows(text, size):
            if used + len(w) > block_words and blocks[-1]:
                blocks.append([])
                used = 0
            blocks[-1].append((w, item_id))
            used += len(w)
    return blocks


def automaton(block: list):
    """``(vocabulary, automaton)``; a match yields ``(length, ids of the items)``."""
    import ahocorasick
    vocab: dict[bytes, int] = {}
    owners: dict[tuple, set] = {}
    for w, item_id in block:
        owners.setdefault(tuple(vocab.setdefault(x, len(vocab) + 1) for x in w), set()).add(item_id)
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in owners.items():
        auto.add_word(key, (len(key), frozenset(i for i in ids if i is not None)))
    auto.make_automaton()
    return vocab, auto


def scan(words: list[bytes], vocab: dict, auto, depth: np.ndarray, found: set) -> None:
    """Add the matches in ``words``: window starts and ends to ``depth``, item ids to ``found``."""
    if not vocab:
        return
    get = vocab.get
    for end, (n, ids) in auto.iter(tuple([get(x, 0) for x in words])):
        depth[end - n + 1] += 1
        depth[end + 1] -= 1
        found |= ids


def hit_spans(text: str, hit: np.ndarray) -> list[dict]:
    """Character ranges ``[start, end)`` of the original text, one for each run of hit words."""
    if not hit.any():
        return []
    places = [(m.start(), m.end()) for m in WORD_RE.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edge[::2], edge[1::2])]


def judge_all(texts, n_blocks: int, built) -> list[tuple]:
    """Results in the order of ``RESULT``; ``built(i)`` gives the i-th automaton, used for all texts in turn."""
    words = [word_list(t) for t in texts]
    depth = [np.zeros(len(w) + 1, np.int64) for w in words]
    found: list[set] = [set() for _ in words]
    for i in range(n_blocks):
        vocab, auto = built(i)
        for w, d, f in zip(words, depth, found):
            scan(w, vocab, auto, d, f)
    out = []
    for text, w, d, ids in zip(texts, words, depth, found):
        hit = np.cumsum(d[:-1]) > 0
        n, n_hit = len(w), int(hit.sum())
        listed = ",".join(sorted(str(i) for i in ids))
        out.append((n, n_hit, len(ids), sorted(ids), hashlib.sha256(listed.encode()).hexdigest(),
                    n_hit > 0 and MIN_SHARE * n_hit >= n, hit_spans(text, hit) if n_hit else []))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", into: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``into`` (see ``RESULT``); ``items`` has item_id and text."""
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("bigint"), F.col("text")).distinct().toLocalIterator()
    shared = [spark.sparkContext.broadcast(b) for b in window_blocks(iter(rows))]

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=1)           # one automaton in memory at a time
        def built(i):
            return automaton(shared[i].value)
        for texts in batches:
            yield pd.DataFrame(judge_all(texts, len(shared), built), columns=FIELDS)

    return docs.withColumn(into, judged(F.col(text)))
