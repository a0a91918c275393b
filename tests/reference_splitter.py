"""Straightforward piece-list version of the splitter, kept as a test oracle for the
offset-based implementation in ``quarry.operators.splitter``.

Recursive separator splitter with greedy overlapping frames (pure Python).

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
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from quarry.config import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS


def pieces(text: str, sep: str) -> list[str]:
    """Cut ``text`` at ``sep``; the separator stays at the front of each later piece."""
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [parts[0]] if parts[0] else []
    out.extend(sep + p for p in parts[1:])
    return out


def frames(lengths: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy overlapping frames ``[s, e)`` over pieces with the given lengths."""
    n = len(lengths)
    if n == 0:
        return []
    c = [0, *accumulate(lengths)]
    out = []
    s = 0
    while True:
        e = bisect_right(c, c[s] + size) - 1
        out.append((s, e))
        if e >= n:
            return out
        # smallest start keeping <= overlap chars that still lets piece e join the frame
        keep_overlap = bisect_left(c, c[e] - overlap)
        fits_next = bisect_left(c, c[e + 1] - size)
        s = min(max(keep_overlap, fits_next), e)


def _split(text: str, base: int, seps: tuple[str, ...], size: int, overlap: int,
           out: list[tuple[int, int]]) -> None:
    """Append ``(start, end)`` spans (into the original text) of the stripped chunks."""
    sep, rest = seps[-1], ()
    for i, cand in enumerate(seps):
        if cand == "" or cand in text:
            sep, rest = cand, seps[i + 1:]
            break
    run: list[str] = []
    run_start = 0

    def emit(start: int, raw: str) -> None:
        stripped = raw.strip()
        if stripped:
            lead = len(raw) - len(raw.lstrip())
            out.append((start + lead, start + lead + len(stripped)))

    def flush() -> None:
        if run:
            lengths = [len(p) for p in run]
            offsets = [0, *accumulate(lengths)]
            for s, e in frames(lengths, size, overlap):
                emit(base + run_start + offsets[s], "".join(run[s:e]))
            run.clear()

    pos = 0
    for piece in pieces(text, sep):
        if len(piece) < size:
            if not run:
                run_start = pos
            run.append(piece)
        else:
            flush()
            if rest:
                _split(piece, base + pos, rest, size, overlap, out)
            else:
                emit(base + pos, piece)
        pos += len(piece)
    flush()


def chunk_spans(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                separators: tuple[str, ...] = SEPARATORS) -> list[tuple[int, int]]:
    """``(start, end)`` code-point offsets of every chunk, in text order."""
    if not text:
        return []
    out: list[tuple[int, int]] = []
    _split(text, 0, tuple(separators), size, overlap, out)
    return out


def split_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """All chunks of one section, in text order."""
    return [text[a:b] for a, b in chunk_spans(text, size, overlap, separators)]
