"""Best-fit packing of token sequences by length patterns and non-negative least squares.

Only the histogram of lengths (at most ``capacity`` numbers) reaches the driver.  Patterns
of up to three lengths that fill a sequence exactly are enumerated; how often to use
each is fitted to the histogram by non-negative least squares (block coordinate
descent: disjoint patterns are orthogonal columns, so a block is minimised exactly), rounded,
and cut to what is there.  What the rounded patterns leave is packed best-fit decreasing,
again by counts.  The result is a plan of ranges of ranks per length, of bounded size,
which every piece looks up with its rank among the pieces of its length.

Ranks come from groups of bounded size (length, hash of the piece), so a length that a
third of all pieces share is ranked in many tasks.

Defined cases: a NULL text is an empty document (its end id alone); a NULL doc_id is kept;
repeated rows are placed apart; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded_table, materialise
from quarry.llm.tokens import encoder, tokenizer_path

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 20_000
FIT_ROUNDS = 60
CACHE_PIECES = 150_000     # at most some 140 MB a worker, with both generations full: packing follows other stages in the same workers
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths (0 for none), ascending, that add up to ``capacity``."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    vals = np.flatnonzero(there)
    out = []
    for a in vals[vals * 3 <= capacity]:
        b = vals[(vals >= a) & (vals * 2 <= capacity - a)]
        c = capacity - a - b
        ok = there[c] & (c < capacity)
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit_counts(hist: np.ndarray, pats: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Non-negative repeat counts x that bring ``sum(x * pattern)`` near the histogram."""
    x = np.zeros(len(pats))
    if not len(pats):
        return x
    rest = hist.astype(float).copy()
    rest[0] = 0.0
    a, b, c = pats.T
    # |column|^2 of a pattern: 3 distinct lengths 3, a pair of equal ones 1 + 4, and so on; length 0 is no row
    norm = np.zeros(len(pats))
    for v, m in ((a, 1 + (a == b) + (a == c)), (b, 1 + (a == b) + (b == c)), (c, 1 + (a == c) + (b == c))):
        norm += np.where(v > 0, m, 0)          # equal lengths are met m times, m each: m * m
    for _ in range(rounds):
        grad = np.where(a > 0, rest[a], 0) + np.where(b > 0, rest[b], 0) + rest[c]
        step = np.maximum(grad / norm, -x)
        gain = np.abs(step) * np.abs(grad)
        best = np.argpartition(-gain, min(len(gain) - 1, 4000))[:4000]
        best = best[np.argsort(-gain[best], kind="stable")]
        used: set[int] = set()
        moved = 0.0
        for j in best:
            own = {int(v) for v in pats[j] if v}
            if abs(step[j]) < 1e-3 or own & used:
                continue
            used |= own
            x[j] += step[j]
            for v in pats[j]:
                if v:
                    rest[v] -= step[j]
            moved += abs(step[j])
        if moved < 0.5:
            break
    return x


def pack_histogram(hist: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """``([(length, copies), ...], repeats)``: sequences that hold every piece of the histogram once."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        out.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    pats = patterns(np.flatnonzero(left), capacity)
    x = fit_counts(left, pats)
    for j in np.argsort(-x, kind="stable"):
        n = int(round(x[j]))
        if n <= 0:
            break
        items: dict[int, int] = {}
        for v in pats[j]:
            if v:
                items[int(v)] = items.get(int(v), 0) + 1
        n = min([n, *(int(left[v]) // m for v, m in items.items())])
        if n > 0:
            out.append((sorted(items.items(), reverse=True), n))
            for v, m in items.items():
                left[v] -= n * m
    # best-fit decreasing on counts: open sequences by the space they have
    spaces: list[int] = []
    open_: dict[int, list[tuple[list, int]]] = {}

    def put(items, n, space):
        if space == 0:
            out.append((items, n))
        else:
            if space not in open_:
                insort(spaces, space)
                open_[space] = []
            open_[space].append((items, n))

    for v in range(capacity, 0, -1):
        n = int(left[v])
        while n:
            i = bisect_left(spaces, v)
            if i < len(spaces):
                space = spaces[i]
                items, there = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    spaces.pop(i)
            else:
                space, items, there = capacity, [], n      # as many new sequences as needed
            m = min(space // v, n)
            t = min(there, n // m)
            if items and t < there:
                put(items, there - t, space)
            put([*items, (v, m)], t, space - m * v)
            n -= t * m
    for classes in open_.values():
        out.extend(classes)
    return out


def rank_plan(packed: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, end rank, first sequence, copies, offset)``."""
    rows, used, base = [], {}, 0
    for items, n in packed:
        offset = 0
        for v, m in items:
            lo = used.get(v, 0)
            used[v] = lo + n * m
            rows.append((v, lo, lo + n * m, base, m, offset))
            offset += v * m
        base += n
    return rows


def pack(df: DataFrame, length: str, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``df`` (each row one piece of 1 to ``capacity`` tokens) with ``sequence_id`` and ``offset``.

    ``df`` is read several times: give a stored table.  ``order`` names the columns that rank
    pieces of one length; rows equal in all of them are interchangeable.
    """
    spark = df.sparkSession
    hist = np.zeros(capacity + 1, np.int64)
    for r in df.groupBy(F.col(length).cast("int").alias("v")).count().collect():   # at most `capacity` rows
        hist[r["v"]] = r["count"]
    plan = bounded_table(spark, rank_plan(pack_histogram(hist, capacity)),
                         "q_length bigint,q_lo bigint,q_hi bigint,q_base bigint,q_copies bigint,q_offset bigint")
    groups = max(1, -(-int(hist.sum()) // GROUP_ROWS))
    dealt = df.withColumn("_g", F.pmod(F.xxhash64(*order), F.lit(groups)))
    before = (dealt.groupBy(F.col(length).alias("_length"), F.col("_g").alias("_group")).count()
              .withColumn("_before", F.coalesce(F.sum("count").over(
                  Window.partitionBy("_length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("count"))
    n = F.row_number().over(Window.partitionBy(length, "_g").orderBy(*order)) - 1
    ranked = (dealt.withColumn("_n", n)
              .join(before, (F.col(length) == F.col("_length")) & (F.col("_g") == F.col("_group")))
              .withColumn("_rank", F.col("_before") + F.col("_n")))
    at = F.col("_rank") - F.col("q_lo")
    # bounded by the number of lengths and of patterns, whatever the input
    return (ranked.join(F.broadcast(plan), (F.col(length) == F.col("q_length")) & (F.col("_rank") >= F.col("q_lo"))
                        & (F.col("_rank") < F.col("q_hi")))
            .withColumn("sequence_id", F.col("q_base") + F.expr("(_rank - q_lo) div q_copies"))
            .withColumn("offset", F.col("q_offset") + F.pmod(at, F.col("q_copies")) * F.col(length))
            .drop("_g", "_n", "_length", "_group", "_before", "_rank",
                  "q_length", "q_lo", "q_hi", "q_base", "q_copies", "q_offset"))


def document_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                    with_ids: bool = False) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity``; ``with_ids`` adds the ids."""
    path = path or tokenizer_path("word_bpe_49k.json")
    tail = np.array([end_id], "<u4").tobytes()
    wide = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, "words", CACHE_PIECES)
        for batch in batches:
            ids, piece, crc, length, raw = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = enc.encode(text or "") + tail
                for k in range(0, len(data), wide):
                    part = data[k:k + wide]
                    ids.append(doc_id)
                    piece.append(k // wide)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(np.frombuffer(part, "<u4"))
            cols = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()),
                    pa.array([p * capacity for p in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(raw, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return src.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document: where its tokens come from and where they go."""
    pieces = materialise(document_pieces(docs, path, capacity, end_id), "pieces")
    return pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packed_sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and its ``ids``, at most ``capacity`` of them."""
    pieces = materialise(document_pieces(docs, path, capacity, end_id, with_ids=True), "pieces")
    placed = pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], capacity)
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])).alias("ids"))
