"""Recursive separator splitter with greedy overlapping frames.

This is the small per-row helper behind the chunk operator; Spark feeds it Arrow
batches.  Specification (our restatement of the chunking contract):

1. Separators are tried in order; the first one present in the text is used
   (the empty separator always is) and only the later ones on recursion.
2. The text is cut at the separator; every piece but the first keeps the
   separator at its front; empty pieces are dropped.
3. Pieces shorter than ``size`` are *good*.  Consecutive good pieces form a run
   that is packed into frames (4).  A long piece closes the run and is split
   recursively with the remaining separators.  Runs never share overlap.
4. Packing uses prefix sums ``c``: from start ``s`` the frame ends at the largest
   ``e`` with ``c[e]-c[s] <= size``.  The next start is the smallest ``s'`` with
   ``c[e]-c[s'] <= overlap`` and (``c[e+1]-c[s'] <= size`` or ``s' = e``).
5. Each frame is stripped (``str.strip``) and dropped when empty.

Implementation: pieces are never materialised.  Pieces partition the text, so a
run is just the array of its piece boundaries (absolute offsets, found with NumPy
over the code points), and frames are found by binary search on those offsets.
Python work is per chunk, not per word.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np

from quarry.config import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS


def _codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _occurrences(text: str, cp: np.ndarray, a: int, b: int, sep: str) -> np.ndarray:
    """Start offsets of the non-overlapping, leftmost matches of ``sep`` in [a, b)."""
    if len(sep) == 1:
        return np.flatnonzero(cp[a:b] == ord(sep)) + a
    out = []
    i = text.find(sep, a, b)
    while i != -1:
        out.append(i)
        i = text.find(sep, i + len(sep), b)
    return np.asarray(out, dtype=np.int64)


def frames(bounds: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy overlapping frames over a run given its piece boundaries.

    ``bounds`` holds ``n+1`` increasing offsets (piece ``i`` spans
    ``bounds[i]..bounds[i+1]``); returns frames as index pairs ``[s, e)``.
    """
    n = len(bounds) - 1
    out = []
    s = 0
    while True:
        e = bisect_right(bounds, bounds[s] + size) - 1
        out.append((s, e))
        if e >= n:
            return out
        # smallest start keeping <= overlap chars that still lets piece e join the frame
        keep_overlap = bisect_left(bounds, bounds[e] - overlap)
        fits_next = bisect_left(bounds, bounds[e + 1] - size)
        s = min(max(keep_overlap, fits_next), e)


def _emit(text: str, p0: int, p1: int, out: list[tuple[int, int]]) -> None:
    raw = text[p0:p1]
    stripped = raw.strip()
    if stripped:
        lead = p0 + len(raw) - len(raw.lstrip())
        out.append((lead, lead + len(stripped)))


def _pack(text: str, bounds: list[int], size: int, overlap: int, out: list[tuple[int, int]]) -> None:
    for s, e in frames(bounds, size, overlap):
        _emit(text, bounds[s], bounds[e], out)


def _split(text: str, cp: np.ndarray, a: int, b: int, seps: tuple[str, ...], size: int, overlap: int,
           out: list[tuple[int, int]]) -> None:
    sep, rest = seps[-1], ()
    for i, cand in enumerate(seps):
        if cand == "" or text.find(cand, a, b) != -1:
            sep, rest = cand, seps[i + 1:]
            break
    if sep == "" and overlap < size and size > 1:
        # single characters: frames of ``size`` every ``size - overlap``, nothing listed per character
        for s in range(a, b, size - overlap):
            _emit(text, s, min(s + size, b), out)
            if s + size >= b:
                break
        return
    if sep == "":
        starts_np = np.arange(a, b, dtype=np.int64)
    else:
        occ = _occurrences(text, cp, a, b, sep)
        starts_np = occ if (len(occ) and occ[0] == a) else np.concatenate(([a], occ))
    lengths = np.diff(np.append(starts_np, b))
    bad = np.flatnonzero(lengths >= size).tolist()
    starts = starts_np.tolist()
    starts.append(b)                      # starts[i+1] is the end of piece i
    prev = 0
    for j in bad:
        if j > prev:
            _pack(text, starts[prev:j + 1], size, overlap, out)
        if rest:
            _split(text, cp, starts[j], starts[j + 1], rest, size, overlap, out)
        else:
            _emit(text, starts[j], starts[j + 1], out)
        prev = j + 1
    if prev < len(starts) - 1:
        _pack(text, starts[prev:], size, overlap, out)


def chunk_spans(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                separators: tuple[str, ...] = SEPARATORS) -> list[tuple[int, int]]:
    """``(start, end)`` code-point offsets of every chunk, in text order."""
    if not text:
        return []
    out: list[tuple[int, int]] = []
    if len(text) <= size:
        # one frame holds the whole text whatever the separators
        _emit(text, 0, len(text), out)
        return out
    _split(text, _codepoints(text), 0, len(text), tuple(separators), size, overlap, out)
    return out


def split_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """All chunks of one section, in text order."""
    return [text[a:b] for a, b in chunk_spans(text, size, overlap, separators)]


def pieces(text: str, sep: str) -> list[str]:
    """Cut ``text`` at ``sep``; the separator stays at the front of each later piece."""
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [parts[0]] if parts[0] else []
    out.extend(sep + p for p in parts[1:])
    return out
