"""Substring dedup by content-defined chunking with a gear rolling hash.

A text is its words joined by single spaces.  A gear hash rolls over the bytes (its window
is ``GEAR_BYTES``); where the hash at the end of a word is the least among its neighbours
within ``RADIUS`` words, a chunk ends there.  Cuts depend on nearby bytes only, so the
same passage is cut alike wherever it stands, whatever was inserted before it.  A group
is consecutive chunks of at least ``MIN_WORDS`` words in all that would have fewer without
its first or without its last chunk.  Each group has a 128-bit digest of its words, so that chance
equality is out of the question at any number of groups; a group is a repeat if its digest's first document (the least doc_id) is another one: one earlier document
holds all its words in this order, side by side.  What repeated groups cover is removed.
A passage of n repeated words is covered but for a few words at either end, so with
``MIN_WORDS`` well below 50 passages of over 50 words are found, while the short lines
that many clean documents share (licences, greetings) stay, whatever they stand beside.

Every digest's first document comes from a grouping that combines before it shuffles, and
repeats are found by a join that splits a hot digest; nothing collects a digest's documents.

Defined cases: an empty table gives an empty result; texts of any length are read whole; columns
named as the two that are added are replaced, others stay; NULL and blank texts have no chunks and stay as they are; what repeats only
within one document stays; rows that repeat a doc_id never make each other repeats; rows
without a doc_id are last in the order and never repeats of each other.  White space between words
that stay is kept as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import materialise

GEAR_BYTES = 8
RADIUS = 2
MAX_WORDS = 32
MIN_WORDS = 28            # at most 255 - MAX_WORDS: a group's words are stored in 8 bits
NO_ID = (1 << 63) - 1
BROADCAST_ROWS = 200_000   # rows of at most some hundred bytes

_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)
_WORD = re.compile(r"\S+")


def cuts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends as word counts, and the byte at which each word ends (words are joined by spaces)."""
    b = np.frombuffer(data, np.uint8)
    ends = np.append(np.flatnonzero(b == 32), len(b))
    h = _GEAR[b]
    step = 1
    while step < GEAR_BYTES:                     # sums over windows of 2, 4, 8 ... bytes
        g = h.copy()
        g[step:] += h[:-step] << np.uint32(step)
        h = g
        step *= 2
    v = h[ends - 1].astype(np.int64)
    n = len(v)
    pad = np.full(RADIUS, 1 << 40, np.int64)
    w = np.concatenate((pad, v, pad))
    least = np.ones(n, bool)
    for r in range(1, RADIUS + 1):
        least &= (v < w[RADIUS - r:RADIUS - r + n]) & (v <= w[RADIUS + r:RADIUS + r + n])
    at = np.flatnonzero(least) + 1
    if not len(at) or at[-1] != n:
        at = np.append(at, n)
    gap = np.diff(at, prepend=0)
    if gap.max() > MAX_WORDS:                    # the same word over and over
        at = np.concatenate([np.append(np.arange(e - d + MAX_WORDS, e, MAX_WORDS), e) for e, d in zip(at, gap)])
    return at, ends


def _bounds(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined words; first word, number of words, first byte and end byte of each chunk."""
    words = text.split() if text else []
    if not words:
        return (b"", *[np.zeros(0, np.int64)] * 4)
    data = " ".join(words).encode("utf-8", "surrogatepass")
    at, ends = cuts(data)
    start, stop = np.concatenate(([0], at[:-1])), ends[at - 1]
    return data, start, at - start, np.concatenate(([0], stop[:-1] + 1)), stop


def chunks(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and digest of each chunk."""
    import xxhash
    data, start, size, begin, stop = _bounds(text)
    digest = [xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(begin.tolist(), stop.tolist())]
    return start, size, np.array(digest, np.uint64).view(np.int64)


def groups(text: str | None, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and digest (two numbers a row, of the words themselves) of each group of chunks."""
    import xxhash
    data, start, size, begin, stop = _bounds(text)
    m = len(start)
    at = np.append(start, size.sum())
    first = np.arange(m)
    last = np.searchsorted(at, start + min_words)                 # the shortest from each chunk on ...
    back = np.searchsorted(at, at[1:] - min_words, "right") - 1   # ... and up to each chunk
    more = (back >= 0) & (last[back] != first + 1)
    i = np.concatenate((first[last <= m], back[more]))
    j = np.concatenate((last[last <= m], first[more] + 1))
    whole = b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begin[i].tolist(), stop[j - 1].tolist())])
    return at[i], at[j] - at[i], np.frombuffer(whole, np.int64).reshape(-1, 2)


def mark(text: Column) -> Column:
    """Tells rows that repeat a doc_id apart."""
    return F.coalesce(F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFF)), F.lit(0)).cast("bigint")


def group_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """``(digest, more, doc, place)`` of every group; digest and more are the two halves of its digest, place holds first word, number of words and mark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [groups(t, min_words) for t in batch.column(1).to_pylist()]
            n = [len(f[0]) for f in found]
            doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n)
            tag = np.repeat(batch.column(2).to_numpy(zero_copy_only=False), n)
            start, size = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(2))
            digest = np.concatenate([f[2] for f in found] or [np.zeros((0, 2), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[:, 0], pa.int64()), pa.array(digest[:, 1], pa.int64()), pa.array(doc, pa.int64()),
                 pa.array((start << 32) | (size << 24) | tag, pa.int64())], ["digest", "more", "doc", "place"])

    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), text.alias("text"),
                       mark(text).alias("mark")).mapInArrow(run, "digest bigint, more bigint, doc bigint, place bigint")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc, mark, spans)``: word ranges [start, end) that an earlier document holds too."""
    if min_words > 255 - MAX_WORDS:
        raise ValueError(f"min_words is {min_words}, above {255 - MAX_WORDS}")
    rows = group_rows(docs, min_words)
    first = (rows.groupBy("digest", "more").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .filter("first < last").select("digest", "more", "first"))
    found = rows.join(first, ["digest", "more"]).filter("first < doc").select(
        "doc", F.col("place").bitwiseAND(F.lit(0xFFFFFF)).alias("mark"), F.shiftright("place", 32).alias("start"),
        F.shiftright("place", 24).bitwiseAND(F.lit(0xFF)).alias("n"))
    in_doc = Window.partitionBy("doc", "mark").orderBy("start", "n")
    reached = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = (found.withColumn("end", F.col("start") + F.col("n"))
            .withColumn("new", F.coalesce((reached < F.col("start")).cast("int"), F.lit(1)))
            .withColumn("run", F.sum("new").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc", "mark", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return runs.groupBy("doc", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def without(text: str, spans) -> str:
    """``text`` without the words of ``spans`` and the white space after them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at:places[s["start"]]])
        at = places[min(s["end"], len(places) - 1)]
    return ("".join(out) + text[at:]).rstrip() if at == len(text) else "".join(out) + text[at:]


@F.pandas_udf(T.StringType())
def cut_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if s is None else without(t, s) for t, s in zip(texts, spans)])


# Spark copies a deterministic expression into every filter and projection that reads it, each with a Python
# worker of its own in the same task: twice the work, and twice the workers for as long as the executor keeps them.
cut_text = cut_text.asNondeterministic()


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``removed_spans`` (word ranges, NULL if none) and ``deduped_text``."""
    docs = docs.drop("removed_spans", "deduped_text")
    spans = materialise(repeated_spans(docs, min_words), "spans")
    side = spans.select(F.col("doc").alias("_sd_doc"), F.col("mark").alias("_sd_mark"), F.col("spans").alias("removed_spans"))
    side = F.broadcast(side) if spans.count() <= BROADCAST_ROWS else side
    joined = docs.join(side, (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)) == side["_sd_doc"])
                       & (mark(F.col("text").cast("string")) == side["_sd_mark"]), "left").drop(side["_sd_doc"], side["_sd_mark"])
    return joined.withColumn("deduped_text", F.when(F.col("removed_spans").isNull(), F.col("text"))
                             .otherwise(cut_text("text", "removed_spans")))
