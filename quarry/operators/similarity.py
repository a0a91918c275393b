"""Cosine top-k similarity joins without a cross join.

Plan: the (bounded) query side is collected in blocks whose byte size is checked
and shipped to executors as a broadcast variable.  The point side is scanned in
place (no shuffle) by ``mapInArrow``: each Arrow batch becomes a NumPy matrix,
is scored against the query block, thresholded, and reduced to a *local* top-k
per query, kept exactly across all batches of the task (ties broken by point
key).  Only these candidates -- at most ``k x queries`` per partition -- are
shuffled, and a ``row_number`` window (planned as ``WindowGroupLimit``) picks the
exact global top-k ordered by ``(score DESC, point key ASC)``.

Two vector encodings share the scorer:

* ``dense``: ``array<float>`` of fixed width, L2-normalised in float64;
* ``bag``:   ``array<int>`` of hashed token buckets (a sparse count vector); points are
  ordered by ``dot^2 / |p|^2`` (exact integers and one correctly rounded division, so equal
  cosines give equal keys), and the cosine ``sqrt(dot^2 / |p|^2 / |q|^2)`` is reported.

With IVF, the rows of each list are scored only against the queries that probe
that list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.config import MAX_BROADCAST_QUERY_BYTES, TOP_K

# Cap on the score matrix held at once inside a task (rows x queries x 8 bytes).
_SCORE_BLOCK_BYTES = 32 * 1024 * 1024
# Cap on the dense point matrix built from one slice of an Arrow batch (rows x dim x 8).
_POINT_BLOCK_BYTES = 64 * 1024 * 1024
# The same for count vectors, whose dense form is copied a few times.
_BAG_BLOCK_BYTES = 8 * 1024 * 1024
# Dense tiles (their single-precision scores stay in a core's cache), and the first slice of a task:
# slices double, so that the bounds that later ones must reach are found on few rows.
_TILE_ROWS, _TILE_QUERIES, _FIRST_ROWS = 512, 1024, 64
_OUT_ROWS = 10_000


@dataclass(frozen=True)
class Encoding:
    kind: str          # "dense" (array<float>) or "bag" (array<int> of bucket ids)
    dim: int


def _dense_matrix(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, dim) float64 unit rows and a validity mask (NULL / wrong width -> invalid)."""
    n = len(col)
    mat = np.zeros((n, dim), dtype=np.float64)
    if n == 0:
        return mat, np.zeros(0, dtype=bool)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offsets = col.offsets.to_numpy()
    lengths = np.diff(offsets)
    valid = (lengths == dim) & col.is_valid().to_numpy(zero_copy_only=False)
    values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    if valid.all():
        # contiguous (also for a sliced batch, whose offsets do not start at 0)
        mat[:] = values[offsets[0]:offsets[0] + n * dim].reshape(n, dim)
    else:
        for i in np.nonzero(valid)[0]:
            mat[i] = values[offsets[i]:offsets[i] + dim]
    norms = np.sqrt((mat * mat).sum(axis=1))
    nz = norms > 0
    mat[nz] /= norms[nz, None]
    return mat, valid


def _bag_matrix(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, dim) count matrix from token-bucket lists; bucket ids outside [0, dim) are ignored."""
    n = len(col)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if n == 0:
        return np.zeros((0, dim)), np.zeros(0, dtype=bool)
    offsets = col.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = col.values.to_numpy(zero_copy_only=False).astype(np.int64)[offsets[0]:offsets[-1]]
    rows = np.repeat(np.arange(n, dtype=np.int64), lengths)
    ok = (values >= 0) & (values < dim)
    counts = np.bincount(rows[ok] * dim + values[ok], minlength=n * dim).reshape(n, dim)
    # float32 holds these counts and their dot products exactly (all far below 2**24)
    return counts.astype(np.float32), col.is_valid().to_numpy(zero_copy_only=False)


def _matrix(enc: Encoding, col) -> tuple[np.ndarray, np.ndarray]:
    return _dense_matrix(col, enc.dim) if enc.kind == "dense" else _bag_matrix(col, enc.dim)


def _keys(enc: Encoding, pm: np.ndarray, qm: np.ndarray) -> np.ndarray:
    """What points are ordered by within a query: cosines (dense), or ``dot^2 / |p|^2`` (bag)."""
    if enc.kind == "dense":
        return pm @ qm.T
    # integer counts: exact products in float32 (and their squares in float64), then one division
    dotp = (pm @ qm.T).astype(np.float64)
    pnorm2 = (pm.astype(np.float64) ** 2).sum(axis=1)
    return dotp * dotp / np.where(pnorm2 > 0, pnorm2, 1.0)[:, None]


def _cosines(enc: Encoding, keys: np.ndarray, qnorm2: np.ndarray) -> np.ndarray:
    if enc.kind == "dense":
        return keys
    return np.sqrt(keys / np.where(qnorm2 > 0, qnorm2, 1.0))


def _local_topk(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row/column indices of finite scores that reach the k-th best of their column."""
    n = scores.shape[0]
    ok = np.isfinite(scores)
    if n > k:
        kth = np.partition(scores, n - k, axis=0)[n - k]
        ok &= scores >= kth[None, :]
    return np.nonzero(ok)


def _key_order(col) -> np.ndarray:
    """Sortable NumPy view of a point-key column (integers; DECIMAL(20,0) as uint64)."""
    if pa.types.is_decimal(col.type):
        col = pc.cast(col, pa.uint64())
    return col.to_numpy(zero_copy_only=False)


def _exact_topk(qi: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` rows per query under (score DESC, key ASC)."""
    if len(qi) == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((key, -score, qi))
    sq = qi[order]
    starts = np.r_[0, np.nonzero(sq[1:] != sq[:-1])[0] + 1]
    group_start = np.repeat(starts, np.diff(np.r_[starts, len(sq)]))
    return order[(np.arange(len(sq)) - group_start) < k]


def _looseness(dim: int, decimals: int | None) -> float:
    """By how much a single-precision score of unit vectors may fall short of a bound on (rounded) exact scores."""
    return (dim + 4) * 2.0 ** -23 + (0.0 if decimals is None else 10.0 ** -decimals)


def near_pairs(x: np.ndarray, q: np.ndarray, x32: np.ndarray, q32: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, exact score)`` of the pairs whose single-precision score reaches ``least`` of its column.

    Exact scores are summed pair by pair, so equal vectors get equal scores in any tile.
    """
    r, c = np.nonzero(x32 @ q32.T >= least.astype(np.float32)[None, :])
    s = np.empty(len(r))
    for i in range(0, len(r), 1 << 16):
        at = slice(i, i + (1 << 16))
        s[at] = np.einsum("ij,ij->i", x[r[at]], q[c[at]])
    return r, c, s


class _Best:
    """The best ``k`` rows per query that a task has met, under (rank value DESC, key ASC), and what a row must reach."""

    def __init__(self, n_queries: int, k: int, least: float):
        self.k, self.n, self.least = k, n_queries, np.full(n_queries, least)
        self.q = self.at = np.zeros(0, np.int64)
        self.rank, self.score, self.order, self.rows = np.zeros(0), np.zeros(0), None, None

    def add(self, q, rank, score, order, rows: pa.RecordBatch, at) -> None:
        """Candidates of ``rows``: row ``at[i]`` with sort key ``order[i]`` for query ``q[i]``."""
        if not len(q):
            return
        old = len(self.q)
        q, rank, score = (np.concatenate(x) for x in ((self.q, q), (self.rank, rank), (self.score, score)))
        order = order if self.order is None else np.concatenate((self.order, order))
        keep = _exact_topk(q, rank, order, self.k)
        new = keep >= old
        used, place = np.unique(at[keep[new] - old], return_inverse=True)
        first = 0 if self.rows is None else self.rows.num_rows
        refs = np.empty(len(keep), np.int64)
        refs[~new], refs[new] = self.at[keep[~new]], first + place
        taken = pa.Table.from_batches([rows.take(pa.array(used, pa.int64()))])
        self.rows = taken if self.rows is None else pa.concat_tables([self.rows, taken])
        self.q, self.rank, self.score, self.order, self.at = q[keep], rank[keep], score[keep], order[keep], refs
        if self.rows.num_rows > 2 * len(keep) + 4096:
            used, self.at = np.unique(self.at, return_inverse=True)
            self.rows = self.rows.take(pa.array(used, pa.int64())).combine_chunks()
        n = np.bincount(self.q, minlength=self.n)
        full = n >= self.k
        self.least[full] = np.maximum(self.least[full], self.rank[(np.cumsum(n) - 1)[full]])


def _scorer(enc: Encoding, point_key: str, vec: str, payload: list[str], bc, k: int,
            threshold: float, decimals: int | None, exclude_self: bool, list_col: str | None):
    """Per partition: score every batch slice against the broadcast query block and
    keep the exact top-``k`` per query across all slices of the partition."""
    names = ["query_id", "_key", "score", point_key, *payload]
    dense = enc.kind == "dense"
    rows_per_block = max(1, _POINT_BLOCK_BYTES // (enc.dim * 8) if dense else _BAG_BLOCK_BYTES // (enc.dim * 8))
    loose = _looseness(enc.dim, decimals)

    def near_dense(pm, x32, raw_keys, order, q_ids, qm, q32, sel, best):
        """Candidates among some rows and queries: dense scores differ in the last bits from one engine to the
        next, so reports order them as rounded."""
        for q0 in range(0, len(sel), _TILE_QUERIES):
            cols = sel[q0:q0 + _TILE_QUERIES]
            least, qt, qt32 = best.least[cols] - loose, qm[cols], q32[cols]
            for r0 in range(0, len(pm), _TILE_ROWS):
                to = slice(r0, r0 + _TILE_ROWS)
                r, c, s = near_pairs(pm[to], qt, x32[to], qt32, least)
                ok = s >= threshold
                if exclude_self:
                    ok &= raw_keys[to][r] != q_ids[cols[c]]
                ranked = s if decimals is None else np.round(s, decimals)
                ok &= ranked >= best.least[cols[c]] if decimals is None else ranked >= np.round(best.least[cols[c]], decimals)
                r, c, ranked = r[ok], c[ok], ranked[ok]
                if len(r) > k * len(cols):              # many equal scores, or no bounds yet
                    keep = _exact_topk(c, ranked, order[to][r], k)
                    r, c, ranked = r[keep], c[keep], ranked[keep]
                yield r + r0, cols[c], ranked, ranked

    def near_bags(pm, valid, raw_keys, q_ids, qm, qnorm2):
        step = max(1, _SCORE_BLOCK_BYTES // max(1, len(pm) * 8))
        for q0 in range(0, len(q_ids), step):
            cols = np.arange(q0, min(q0 + step, len(q_ids)))
            ranked = _keys(enc, pm, qm[cols])
            s = _cosines(enc, ranked, qnorm2[cols][None, :])
            out = ~(s >= threshold)
            out[~valid, :] = True
            if exclude_self:
                out |= raw_keys[:, None] == q_ids[None, cols]
            ranked[out] = -np.inf
            r, c = _local_topk(ranked, k)
            yield r, cols[c], ranked[r, c], s[r, c] if decimals is None else np.round(s[r, c], decimals)

    def score_slice(batch: pa.RecordBatch, q_ids, qm, q32, qnorm2, probes, best: _Best) -> None:
        pm, valid = _matrix(enc, batch.column(vec))
        keys = batch.column(point_key)
        raw_keys = keys.to_numpy(zero_copy_only=False) if exclude_self else None
        order = _key_order(keys)
        found = []
        if not dense:
            found = [*near_bags(pm, valid, raw_keys, q_ids, qm, qnorm2)]
        else:
            x32 = pm.astype(np.float32)
            x32[~valid] = np.nan                        # reaches nothing
            if probes is None:
                found = [*near_dense(pm, x32, raw_keys, order, q_ids, qm, q32, np.arange(len(q_ids)), best)]
            else:
                # IVF: rows of one list only meet the queries that probe that list
                lists = pc.fill_null(batch.column(list_col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                for one in np.unique(lists):
                    rows, cols = np.flatnonzero(lists == one), np.flatnonzero(probes[:, one])
                    some = None if raw_keys is None else raw_keys[rows]
                    found += [(rows[r], *rest) for r, *rest in near_dense(pm[rows], x32[rows], some, order[rows], q_ids, qm, q32, cols, best)]
        if found:
            r, q, rank, score = (np.concatenate(x) for x in zip(*found))
            best.add(q, rank, score, order[r], batch.select([point_key, *payload]), r)

    def run(batches):
        block = bc.value
        q_ids, qm = block["ids"], block["matrix"]
        nq = len(q_ids)
        if nq == 0:
            return
        qnorm2 = None if dense else (qm.astype(np.float64) ** 2).sum(axis=1)
        q32 = qm.astype(np.float32) if dense else None
        best = _Best(nq, k, threshold)
        size = _FIRST_ROWS if dense else rows_per_block
        for whole in batches:
            off = 0
            while off < whole.num_rows:
                score_slice(whole.slice(off, size), q_ids, qm, q32, qnorm2, block.get("probes"), best)
                off, size = off + size, min(2 * size, rows_per_block)
        for i in range(0, len(best.q), _OUT_ROWS):
            at = slice(i, i + _OUT_ROWS)
            rows = best.rows.take(pa.array(best.at[at], pa.int64())).combine_chunks()
            yield from pa.Table.from_arrays([pa.array(q_ids[best.q[at]], pa.int64()), pa.array(best.rank[at]), pa.array(best.score[at]),
                                             *rows.columns], names=names).to_batches()

    return run


def _block_data(tbl: pa.Table, enc: Encoding, query_key: str, qvec: str,
                probe_col: str | None, n_lists: int | None) -> dict:
    ids = tbl.column(query_key).to_numpy(zero_copy_only=False).astype(np.int64)
    mat, valid = _matrix(enc, tbl.column(qvec))
    mat[~valid] = 0.0
    out = {"ids": ids, "matrix": mat}
    if probe_col:
        probes = np.zeros((len(ids), n_lists), dtype=bool)
        for i, lst in enumerate(tbl.column(probe_col).to_pylist()):
            if lst:
                probes[i, lst] = True
        out["probes"] = probes
    return out


def _query_tables(queries: DataFrame, enc: Encoding, query_key: str, max_bytes: int, split: bool) -> list[pa.Table] | None:
    """The query side in one table, if its dense form fits ``max_bytes`` (one bounded job).

    A larger side is counted and split by a hash of the query key, or (``split`` False) gives
    None: it is met in stored blocks on the executors.
    """
    max_rows = max(1, max_bytes // (enc.dim * 8))
    first = queries.limit(max_rows + 1).toArrow()
    if first.num_rows <= max_rows:
        return [first]
    if not split:
        return None
    n_blocks = 2 * math.ceil(queries.count() / max_rows)
    blk = F.pmod(F.xxhash64(F.col(query_key)), F.lit(n_blocks))
    return [queries.filter(blk == b).toArrow() for b in range(n_blocks)]


def topk(points: DataFrame, queries: DataFrame, *, encoding: Encoding, k: int = TOP_K,
         threshold: float = 0.0, point_key: str = "point_id", vec: str = "vector",
         query_key: str = "query_id", qvec: str = "vector", payload: list[str] | None = None,
         decimals: int | None = None, exclude_self: bool = False,
         list_col: str | None = None, probe_col: str | None = None, n_lists: int | None = None,
         max_query_bytes: int = MAX_BROADCAST_QUERY_BYTES) -> DataFrame:
    """Top-``k`` points per query with ``score >= threshold``.

    Returns ``(query_id, rank, score, <point_key>, *payload)``.  Points are ranked on full
    precision, equal scores by point key; ``decimals`` rounds the reported score, and dense
    scores before they are ranked (for reports that another engine must repeat).
    """
    payload = [c for c in (payload or []) if c != point_key]
    spark = points.sparkSession
    key_field = points.schema[point_key]
    out_schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("_key", T.DoubleType()),
         T.StructField("score", T.DoubleType()), key_field]
        + [points.schema[c] for c in payload])
    scan_cols = [point_key, vec, *payload] + ([list_col] if list_col else [])
    pts = points.select(*dict.fromkeys(scan_cols))
    parts = []
    q = queries.select(*[c for c in [query_key, qvec, probe_col] if c])
    tables = _query_tables(q, encoding, query_key, max_query_bytes, split=encoding.kind != "dense" or probe_col is not None)
    if tables is None:
        from quarry.operators.ivf import search_blocks
        return search_blocks(points, queries, encoding.dim, k, threshold, point_key, vec, query_key, qvec, payload,
                             exclude_self, decimals, rows=max(1, min(1024, max_query_bytes // (encoding.dim * 8))))
    for tbl in tables:
        if tbl.num_rows == 0 and parts:
            continue
        data = _block_data(tbl, encoding, query_key, qvec, probe_col, n_lists)
        bc = spark.sparkContext.broadcast(data)
        fn = _scorer(encoding, point_key, vec, payload, bc, k, threshold, decimals, exclude_self, list_col)
        parts.append(pts.mapInArrow(fn, out_schema))
    cands = parts[0]
    for p in parts[1:]:
        cands = cands.unionByName(p)
    # a task hands on k candidates per query at most, and the window's group limit cuts
    # them again before the shuffle
    order = [F.desc("_key"), F.asc(point_key)]
    w = Window.partitionBy("query_id").orderBy(*order)
    return (cands.withColumn("rank", F.row_number().over(w).cast("bigint"))
                 .filter(F.col("rank") <= k)
                 .select("query_id", "rank", "score", point_key, *payload))
