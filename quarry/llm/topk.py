"""Exact top-k inner-product search on an impact-ordered index, score at a time.

Vectors are quantised to integers and dealt by the hash of their id into blocks of about
``BLOCK`` vectors; queries into groups of about ``GROUP``.  A task gets one block and one
group.  It sorts each dimension into posting segments of equal quantised impact (the
distance from the dimension's lowest value, or from its highest for negative query
weights, so every impact is non-negative).  A query works through the segments by
descending impact times weight, adding each segment's lowest impact to its postings'
accumulators.  What a posting may still gain is bounded by the segments not yet read and
the widths of those read; a query stops only when this proves that everything outside a
small candidate set stays below its k-th best accumulator, or when all segments are
read.  The candidates are then rescored exactly, so results are exact, ties included.

Defined cases: vectors that are NULL or hold NULL or non-finite components, and rows
without an id, take no part; rows that repeat an id are rows of their own, as queries and as
candidates ("other rows" are all but the query's own row); components missing at the end of a shorter vector count as zero; a query with
fewer than k candidates returns them all.  Scores are exact while they fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise

SCALE = 256
BLOCK = 8192
GROUP = 4096
LEVELS = 64                # of 12, whole segments are so wide that most rows would need rescoring
FEW = 64                   # rescoring a 64th of a block costs less than reading on
ROUNDS = 6                 # proofs tried on the way through the segments
PARTIAL = "rid bigint, query_id bigint, vec_id bigint, score bigint"


def quantised(vec: Column, scale: int = SCALE) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")).cast("bigint"))


def usable(vec: Column) -> Column:
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                               & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))


class ImpactIndex:
    """Posting segments of one block of integer vectors."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.x = x
        n, dims = x.shape
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)      # a row of postings for each dimension
        self.flat = self.order.ravel()
        self.most_x = int(np.abs(x).max(initial=0))
        self.floats = x.astype(np.float64)                                             # for exact products below 2 ** 53
        self.low, self.high = x.min(0), x.max(0)
        dim, start, end, least, most = [], [], [], [], []
        for d in range(dims):
            v = x[self.order[d], d]
            span = int(self.high[d] - self.low[d]) + 1
            level = (v - self.low[d]) * min(levels, span) // span
            cut = np.concatenate(([0], np.flatnonzero(np.diff(level)) + 1, [n]))
            for a, b in zip(cut[:-1], cut[1:]):
                dim.append(d)
                start.append(a)
                end.append(b)
                least.append(v[a])
                most.append(v[b - 1])
        self.dim, self.start, self.end = np.array(dim), np.array(start), np.array(end)
        self.least, self.most = np.array(least), np.array(most)       # values at the ends of a segment

    def _accumulate(self, acc: np.ndarray, segments: np.ndarray, least: np.ndarray) -> None:
        """Add each segment's lowest impact to its postings' accumulators."""
        if not len(segments):
            return
        at, sizes = self.dim[segments] * len(acc) + self.start[segments], (self.end - self.start)[segments]
        if int(least[segments].sum()) < 1 << 53:              # sums are exact in float64
            postings = np.concatenate([self.flat[a:a + m] for a, m in zip(at.tolist(), sizes.tolist())])
            acc += np.bincount(postings, np.repeat(least[segments].astype(np.float64), sizes), minlength=len(acc)).astype(np.int64)
        else:
            for a, m, s in zip(at, sizes, segments):
                acc[self.flat[a:a + m]] += least[s]

    def search(self, q: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, exact scores)`` of all possible members of the top k; rows flagged in ``own`` take no part."""
        n, dims = self.x.shape
        w = np.abs(q)
        up = q[self.dim] >= 0
        weight = w[self.dim]
        least = weight * np.where(up, self.least - self.low[self.dim], self.high[self.dim] - self.most)
        most = weight * np.where(up, self.most - self.low[self.dim], self.high[self.dim] - self.least)
        use = np.flatnonzero(weight > 0)
        use = use[np.argsort(-most[use], kind="stable")]
        acc = np.zeros(n, np.int64)
        unread = np.zeros(dims, np.int64)                       # the best impact not yet read, by dimension
        np.maximum.at(unread, self.dim[use], most[use])
        width = np.zeros(dims, np.int64)                        # the widest segment read, by dimension
        small = max(8 * k, n // FEW)
        free = n - int(own.sum())
        cand = np.arange(n)
        done = 0
        for part in np.array_split(use, ROUNDS):
            self._accumulate(acc, part[least[part] > 0], least)
            np.maximum.at(width, self.dim[part], (most - least)[part])
            done += len(part)
            unread[:] = 0
            np.maximum.at(unread, self.dim[use[done:]], most[use[done:]])
            if free <= k:
                break
            bound = np.where(own, -1, acc)
            kth = np.partition(bound, n - k)[n - k]
            cand = np.flatnonzero(bound + np.maximum(unread, width).sum() >= kth)   # no one else can reach the k-th
            if len(cand) <= small:
                break
        cand = cand[~own[cand]]
        if self.most_x * int(w.sum()) < 1 << 53:
            return cand, (self.floats[cand] @ q.astype(np.float64)).astype(np.int64)
        return cand, self.x[cand] @ q


def matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def block_search(block: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    if not len(block) or not len(queries):
        return pd.DataFrame({"rid": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
    dims = max(map(len, [*block["v"], *queries["v"]]))
    ids, rids = block["vec_id"].to_numpy(np.int64), block["rid"].to_numpy(np.int64)
    index = ImpactIndex(matrix(block["v"], dims))
    out = []
    for rid, qid, q in zip(queries["rid"], queries["vec_id"], matrix(queries["v"], dims)):
        rows, scores = index.search(q, k, rids == rid)
        best = np.lexsort((ids[rows], -scores))[:k]
        out.append((np.full(len(best), rid, np.int64), np.full(len(best), qid, np.int64), ids[rows[best]], scores[best]))
    return pd.DataFrame({c: np.concatenate(p) for c, p in zip(("rid", "query_id", "vec_id", "score"), zip(*out))})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The ``k`` best other rows for every row where ``is_query``: query_id, rank, vec_id, score."""
    rows = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id", quantised(F.col("embedding")).alias("v")))
    rows = materialise(rows, "vectors")
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, groups = max(1, -(-total // block)), max(1, -(-asked // group))
    h = F.xxhash64("rid")

    def numbers(n):
        return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))

    index = rows.select(F.pmod(h, F.lit(blocks)).alias("b"),
                        F.explode(numbers(groups)).alias("g"), "rid", "vec_id", "v")
    queries = rows.filter(is_query).select(F.explode(numbers(blocks)).alias("b"),
                                           F.pmod(h, F.lit(groups)).alias("g"), "rid", "vec_id", "v")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return block_search(left, right, k)

    found = index.groupBy("b", "g").cogroup(queries.groupBy("b", "g")).applyInPandas(search, PARTIAL)
    order = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
