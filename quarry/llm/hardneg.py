"""Hard negatives by rotated one-bit codes with Cauchy-Schwarz intervals.

Every integer vector is written as a sum of ``LEVELS`` one-bit codes, each in a random
orthogonal rotation of its own (fixed by a seed): the signs of what the levels before leave
over, with the alignment (the inner product of code vector and remainder) and the norm of
the new remainder stored beside them.  An anchor's rotated vectors are cut into ``PLANES``
bit planes, so its inner product with a code is a sum of popcounts.  The sum over the
levels, times their alignments, estimates the inner product; by Cauchy and Schwarz the error
is at most |anchor| times the stored norm of the remainder, plus the alignments times the
norms of the anchor's own rounding.  One code leaves some 0.6 of a vector, twelve leave 0.002.  The interval holds for certain.  A row whose interval cannot
reach the k-th best score that is already certain (or leaves the band asked for) is dropped,
after ``COARSE`` levels if these suffice; the rest are scored exactly in integers.

Rows are stored in blocks with their codes; blocks of anchors meet all blocks of rows on the
executors (``quarry.operators.blocks``), once for the positives, and once for the negatives.
A task keeps the best rows of each anchor it meets, and only these are shuffled.

Defined cases: rows with a NULL id, label or vector, or with NULL or non-finite components,
take no part; rows that repeat an id are rows of their own (a copy of the anchor is one of
its "other rows"), and each anchor row gives its results; ties go to the smaller id;
components missing at the end of a shorter vector count as zero; anchors without a positive
or positives without a negative give no rows; a positive score below zero has an empty band;
an empty table gives no rows; further columns of any name are not read.  Scores are exact
while they fit 64 bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise
from quarry.llm.topk import quantised, usable
from quarry.llm.whitening import matrix_of
from quarry.operators import blocks as B

SCALE = 256
LEVELS = 12
COARSE = 5
PLANES = 12
ROWS = 2048               # of a block
TILE = 256
ANCHORS = 256             # of a block
SEED = 20
LEAST = np.iinfo(np.int64).min
POSITIVES, NEGATIVES = 5, 3
#: the band of negative scores, in hundredths of the positive score
LOWEST, HIGHEST = 50, 95


@lru_cache(maxsize=64)
def rotation(dims: int, level: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, level]).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def padded(width: int) -> int:
    return -(-max(1, width) // 64) * 64


def full_width(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    out = np.zeros((n, padded(width)))
    out[:, :width] = x
    return out


def bits(on: np.ndarray) -> np.ndarray:
    """Booleans (..., 64 * w) as (..., w) words."""
    return np.packbits(on, axis=-1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n, levels, words), alignments and norms of what is left (n, levels)."""
    left = full_width(x)
    unit = np.sqrt(left.shape[1])
    codes, align, rest = [], [], []
    for level in range(levels):
        turn = rotation(left.shape[1], level)
        turned = left @ turn
        on = turned >= 0
        a = (np.abs(turned).sum(1) / unit).astype(np.float32).astype(np.float64)       # as stored
        left = left - np.where(on, a[:, None], -a[:, None]) / unit @ turn.T
        codes.append(bits(on))
        align.append(a.astype(np.float32))
        rest.append(np.nextafter(np.linalg.norm(left, axis=1).astype(np.float32), np.float32(np.inf)))
    return np.stack(codes, 1), np.stack(align, 1), np.stack(rest, 1)


def lists(a: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(a.reshape(-1)), int(np.prod(a.shape[1:])))


def small(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    return x.astype(next((t for t in (np.int16, np.int32) if 0 <= most <= np.iinfo(t).max), np.int64))


def _with_codes(width: int):
    def enrich(table: pa.Table) -> pa.Table:
        x = matrix_of(table.column("x").combine_chunks(), width, np.int64)
        codes, align, rest = encode(x)
        out = table.drop_columns(["x"])
        for name, a in (("x", small(x)), ("codes", codes.view(np.int64)), ("align", align), ("rest", rest)):
            out = out.append_column(name, lists(a))
        return out
    return enrich


def _grid(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, -1)


class Rows:
    """A block of coded rows."""

    def __init__(self, rid, vec_id, label, x, codes, align, rest):
        self.rid, self.vec_id, self.label, self.x = rid, vec_id, label, x
        self.align, self.rest = align.astype(np.float64), rest.astype(np.float64)
        self.codes = codes.reshape(len(rid), align.shape[1], -1)
        self.ones = np.bitwise_count(self.codes).sum(2, dtype=np.int64)
        self.norm = np.linalg.norm(x.astype(np.float64), axis=1)
        self.sum_align = np.cumsum(self.align, axis=1)
        self.most = int(np.abs(x.astype(np.int64)).max(initial=0))

    @classmethod
    def read(cls, data) -> Rows:
        b = B.load(data)
        col = lambda c: b.column(c).to_numpy()
        return cls(col("rid"), col("vec_id"), col("label"), _grid(b, "x"), _grid(b, "codes").view(np.uint64), _grid(b, "align"), _grid(b, "rest"))

    @classmethod
    def of(cls, vec_id, label, x) -> Rows:
        codes, align, rest = encode(x)
        return cls(np.arange(len(x)), vec_id, label, x, codes, align, rest)


class Anchors:
    """A block of anchors: bit planes of their rotated vectors, and the best rows met so far."""

    def __init__(self, rid, vec_id, label, x, positives=None, keep=POSITIVES):
        self.rid, self.vec_id, self.label, self.x = rid, vec_id, label, x.astype(np.int64)
        y = full_width(self.x)
        self.norm = np.linalg.norm(y, axis=1)
        self.unit = np.sqrt(y.shape[1])
        self.half = half = 1 << (PLANES - 1)
        step, error, total, planes = [], [], [], []
        for level in range(LEVELS):
            turned = y @ rotation(y.shape[1], level)
            step.append(np.maximum(np.abs(turned).max(1, initial=0), 1e-300) / (half - 1))
            whole = np.rint(turned / step[-1][:, None]).astype(np.int64)
            error.append(np.linalg.norm(turned - whole * step[-1][:, None], axis=1))
            total.append(whole.sum(1))
            planes.append(np.stack([bits(((whole + half) >> j & 1).astype(bool)) for j in range(PLANES)], 1))
        self.step, self.total, self.planes = np.stack(step, 1), np.stack(total, 1), np.stack(planes, 1)   # by anchor, level (, plane, word)
        self.error = np.maximum.accumulate(np.stack(error, 1), axis=1)
        self.most = int(np.abs(self.x).sum(1).max(initial=0))
        lists_of = 1 if positives is None else positives.shape[1]
        if positives is None:
            self.low, self.high = np.full((len(rid), 1), LEAST), np.full((len(rid), 1), np.iinfo(np.int64).max)
        else:
            some = positives != LEAST
            p = np.where(some, positives, 0)
            self.low = np.where(some, -(-LOWEST * p // 100), 1)
            self.high = np.where(some, HIGHEST * p // 100, 0)         # an empty band where there is no positive
        self.keep = keep
        slots = len(rid) * lists_of
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))      # slot, score, id
        self.kth = np.full(slots, LEAST)

    @classmethod
    def read(cls, data, keep: int) -> Anchors:
        b = B.load(data)
        positives = _grid(b, "positives") if "positives" in b.schema.names else None
        col = lambda c: b.column(c).to_numpy()
        return cls(col("rid"), col("vec_id"), col("label"), _grid(b, "x"), positives, keep)

    def part(self, which: np.ndarray, rows: Rows, those: np.ndarray, level: int) -> np.ndarray:
        """The share of one level in the estimates, on the grid of ``which`` x ``those``."""
        acc = np.zeros((len(which), len(those)), np.int32)
        for at in range(0, len(those), TILE):                 # what a core's own cache holds
            part = acc[:, at:at + TILE]
            for w in range(self.planes.shape[3]):
                code = rows.codes[those[at:at + TILE], level, w][None, :]
                for j in range(PLANES):
                    part += np.left_shift(np.bitwise_count(self.planes[which, level, j, w][:, None] & code), j, dtype=np.int32)
        return self._value(acc, which[:, None], rows, those[None, :], level)

    def pair_part(self, i: np.ndarray, rows: Rows, j: np.ndarray, level: int) -> np.ndarray:
        """The same for pairs."""
        acc = np.zeros(len(i), np.int64)
        for w in range(self.planes.shape[3]):
            code = rows.codes[j, level, w]
            for p in range(PLANES):
                acc += np.bitwise_count(self.planes[i, level, p, w] & code).astype(np.int64) << p
        return self._value(acc, i, rows, j, level)

    def _value(self, acc, i, rows, j, level):
        inner = 2 * (acc - self.half * rows.ones[j, level]) - self.total[i, level]
        return inner * self.step[i, level] * (rows.align[j, level] / self.unit)

    def spread(self, i, rows: Rows, j, level: int) -> np.ndarray:
        """Half the interval after a level, with room for the rounding of doubles."""
        return (self.norm[i] * rows.rest[j, level] * (1 + 1e-9) + self.error[i, level] * rows.sum_align[j, level]
                + 1e-9 * self.norm[i] * rows.norm[j] + 1e-6)

    def exact(self, i: np.ndarray, rows: Rows, j: np.ndarray) -> np.ndarray:
        if self.most * rows.most < 1 << 53:
            return np.einsum("nd,nd->n", self.x[i].astype(np.float64), rows.x[j].astype(np.float64)).astype(np.int64)
        return (self.x[i] * rows.x[j].astype(np.int64)).sum(1)

    def _certain(self, slot: np.ndarray, low: np.ndarray) -> np.ndarray:
        """By slot, the k-th largest of certain lower bounds (or what is already known)."""
        least = self.kth.astype(np.float64)
        order = np.lexsort((-low, slot))
        s = slot[order]
        nth = np.arange(len(s)) - np.searchsorted(s, s)
        at = order[nth == self.keep - 1]
        least[slot[at]] = np.maximum(least[slot[at]], low[at])
        return least

    def meet(self, which: np.ndarray, rows: Rows, those: np.ndarray, wanted) -> int:
        """Search ``those`` rows for ``which`` anchors; ``wanted(i, j)`` says which pairs count.
        Returns how many pairs were scored exactly."""
        lists_of = self.low.shape[1]
        if not len(which) or not len(those):
            return 0
        est = sum(self.part(which, rows, those, level) for level in range(COARSE))
        half = self.spread(which[:, None], rows, those[None, :], COARSE - 1)
        floor = np.maximum(self.kth.reshape(-1, lists_of), self.low)[which].min(1)
        a, b = np.nonzero((est + half >= floor[:, None]) & (est - half <= self.high[which].max(1)[:, None]))
        i, j, est = which[a], those[b], est[a, b]
        ok = wanted(i, j)
        i, j, est = i[ok], j[ok], est[ok]
        for level in range(COARSE, LEVELS):
            est = est + self.pair_part(i, rows, j, level)
        half = self.spread(i, rows, j, LEVELS - 1)
        low, high = est - half, est + half
        scored = np.zeros(len(i), bool)
        slots, picks = [], []
        for p in range(lists_of):
            slot = i * lists_of + p
            sure = np.flatnonzero((high <= self.high[i, p]) & (low > self.kth[slot]))
            least = np.maximum(self._certain(slot[sure], low[sure]), self.low.reshape(-1))
            pick = np.flatnonzero((high >= least[slot]) & (low <= self.high[i, p]))
            scored[pick] = True
            slots.append(slot[pick])
            picks.append(pick)
        at = np.flatnonzero(scored)
        score = np.zeros(len(i), np.int64)
        score[at] = self.exact(i[at], rows, j[at])
        slot, pick = np.concatenate(slots), np.concatenate(picks)
        ok = (score[pick] >= self.low.reshape(-1)[slot]) & (score[pick] <= self.high.reshape(-1)[slot])
        self._add(slot[ok], score[pick[ok]], rows.vec_id[j[pick[ok]]])
        return len(at)

    def _add(self, slot, score, vec_id) -> None:
        slot, score, vec_id = (np.concatenate(p) for p in zip(self.best, (slot, score, vec_id)))
        order = np.lexsort((vec_id, -score, slot))
        s = slot[order]
        nth = np.arange(len(s)) - np.searchsorted(s, s)
        order, nth = order[nth < self.keep], nth[nth < self.keep]
        self.best = (slot[order], score[order], vec_id[order])
        full = order[nth == self.keep - 1]
        self.kth[slot[full]] = score[full]

    def same_label(self, rows: Rows) -> int:
        """Positives: rows of the anchor's label, group by group."""
        return sum(self.meet(np.flatnonzero(self.label == one), rows, np.flatnonzero(rows.label == one),
                             lambda i, j: self.rid[i] != rows.rid[j])
                   for one in np.intersect1d(self.label, rows.label))

    def other_labels(self, rows: Rows) -> int:
        return self.meet(np.arange(len(self.rid)), rows, np.arange(len(rows.rid)), lambda i, j: self.label[i] != rows.label[j])


FOUND = "rid bigint, anchor_id bigint, list int, score bigint, vec_id bigint"


def _search(step: str, keep: int):
    def run(batches):
        anchors: dict[int, Anchors] = {}             # of the blocks that this task meets, with their best rows
        rows = B.Last(Rows.read)
        for batch in batches:
            for n in range(batch.num_rows):
                q, qd, p, pd = (batch.column(c)[n] for c in range(4))
                if q.as_py() not in anchors:
                    anchors[q.as_py()] = Anchors.read(qd.as_buffer(), keep)
                getattr(anchors[q.as_py()], step)(rows.get_block(p.as_py(), pd.as_buffer()))
        for a in anchors.values():
            slot, score, vec_id = a.best
            i, which = np.divmod(slot, a.low.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(a.rid[i]), pa.array(a.vec_id[i]), pa.array(which.astype(np.int32)),
                                              pa.array(score), pa.array(vec_id)], names=["rid", "anchor_id", "list", "score", "vec_id"])
    return run


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("rid", "list").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _fixed(width: int, keep: int | None = None):
    """Anchors' vectors filled up to one width, and their positive scores to ``keep`` places."""
    def enrich(table: pa.Table) -> pa.Table:
        x = small(matrix_of(table.column("x").combine_chunks(), width, np.int64))
        out = table.drop_columns(["x"]).append_column("x", lists(x))
        if keep is not None:
            col = table.column("positives").combine_chunks()
            sizes = np.diff(col.offsets.to_numpy())
            p = np.full((len(sizes), keep), LEAST)
            p[np.arange(keep)[None, :] < sizes[:, None]] = col.flatten().to_numpy()
            out = out.drop_columns(["positives"]).append_column("positives", lists(p))
        return out
    return enrich


def hard_negatives(table: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vec: str = "embedding",
                   relabel: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` and ``relabel`` (the label to use, if not the stored one) are expressions over
    ``vec_id`` and ``label``.
    """
    rows = (table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vec).alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
            .select("vec_id", "label" if relabel is None else relabel.cast("bigint").alias("label"), quantised(F.col("v"), scale).alias("x"))
            .filter(F.col("label").isNotNull()))
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "hardneg-rows")
    total, asked, width = rows.agg(F.count("*"), F.count(F.when(is_anchor, 1)), F.max(F.size("x"))).first()
    width = width or 1
    coded = materialise(B.pack(rows.select("rid", "vec_id", "label", "x"), ROWS, total, _with_codes(width)), "hardneg-codes")
    chosen = rows.filter(is_anchor).select("rid", "vec_id", "label", "x")
    first = materialise(B.pack(chosen, ANCHORS, asked, _fixed(width)), "hardneg-anchors")
    found = B.pairs(first, coded).mapInArrow(_search("same_label", positives), FOUND)
    best = materialise(_ranked(found, positives), "hardneg-positives")
    by_anchor = best.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("positives"))
    second = materialise(B.pack(chosen.join(by_anchor, "rid"), ANCHORS, asked, _fixed(width, positives)), "hardneg-bands")
    found = B.pairs(second, coded).mapInArrow(_search("other_labels", negatives), FOUND)
    near = _ranked(found, negatives).select("rid", (F.col("list") + 1).alias("place"), F.col("rank"), F.col("vec_id").alias("negative_id"),
                                            F.col("score").alias("negative_score"))
    good = best.select("rid", "anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return good.join(near, ["rid", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
