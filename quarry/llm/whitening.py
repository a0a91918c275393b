"""PCA whitening of vectors by a covariance weighted with multiplicities.

1. Entries become integers ``floor(scale * entry)``; rows of equal integer vectors are one
   distinct vector with a count (a partial aggregate, so a vector that a third of all rows
   share is reduced before the shuffle).  The fit weighs each distinct vector by one, or by
   its count.
2. Sums by dimension are exact integers, added up per task and then over tasks.
3. Each task centres its vectors and multiplies them with themselves, one matrix product a
   batch; the products (width x width numbers a task) are added up on the cluster.  Only the
   final width x width matrix and the sums come to the driver, which finds the eigenvectors.
4. Each distinct vector is projected once, and the result is joined back to its rows.  Vectors
   with more than a ``1 / HOT`` share of the rows are fewer than ``HOT``, so these are
   broadcast; all others are joined by the hash and the vector itself.

Defined cases: rows whose vector is NULL or holds NULL or non-finite entries are dropped;
rows without an id, and rows that repeat one, are rows like any other; a vector shorter than
the widest counts as zero at its end (but is another vector than one that holds these zeros),
and very long ones only make the matrix wider; a component without variance (an eigenvalue below ``TINY`` times the
largest) has NULL as whitened value and takes no part in the identity error, which is NULL
where no component has variance; equal eigenvalues leave their components' directions open
but whitened values stay uncorrelated; ``deviation`` is NULL where it does not fit 64 bits;
an empty table gives no rows.  Only the id and the vector are read, so further columns of any
name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import materialise
from quarry.llm.topk import quantised, usable

SCALE = 256
HOT = 256              # vectors with more than this share of the rows are joined by broadcast
TINY = 1e-12
LOW = 32               # integer sums are kept as high and low parts of so many bits
EXACT = 1 << 62


@dataclass(frozen=True)
class Fit:
    """What a fit knows: the weight and the sums of its vectors, eigenvalues and unit eigenvectors (columns), falling."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def matrix_of(col: pa.Array, width: int, dtype) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    flat, offsets = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return flat.astype(dtype).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``(x, copies)``: each vector once."""
    return rows.groupBy("x").agg(F.count("*").alias("copies"))


def _weight(weighted: bool) -> Column:
    return F.col("copies") if weighted else F.lit(1).cast("bigint").alias("copies")


def exact_sums(vectors: DataFrame, width: int, weighted: bool) -> tuple[int, list[int]]:
    """The weight of all vectors and their weighted sum by dimension, as exact integers."""

    def add(batches):
        total, sums = 0, [0] * width
        for batch in batches:
            x, w = matrix_of(batch.column(0), width, np.int64), batch.column(1).to_numpy()
            total += int(w.sum())
            for weight in np.unique(w):                 # parts below 2 ** 32 do not overflow when so many are added
                part = x[w == weight]
                high, low = (part >> LOW).sum(0), (part & ((1 << LOW) - 1)).sum(0)
                sums = [s + int(weight) * ((int(h) << LOW) + int(v)) for s, h, v in zip(sums, high, low)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, width), pa.int32()),
                                          "s": pa.array([str(v) for v in [total, *sums]])})

    parts = vectors.select("x", _weight(weighted)).mapInArrow(add, "i int, s string")
    wide = F.sum(F.col("s").cast("decimal(38,0)"))
    found = {r.i: int(r.s) for r in parts.groupBy("i").agg(wide.alias("s")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def centred_product(vectors: DataFrame, col: str, mean: np.ndarray, weighted: bool) -> np.ndarray:
    """The weighted sum of (x - mean)(x - mean)' over all rows."""
    width = len(mean)

    def multiply(batches):
        total = np.zeros((width, width))
        for batch in batches:
            c = matrix_of(batch.column(0), width, np.float64) - mean
            total += (c * batch.column(1).to_numpy()[:, None]).T @ c
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "v": pa.array(list(total), pa.list_(pa.float64()))})

    parts = vectors.select(col, _weight(weighted)).mapInArrow(multiply, "i int, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in cells.collect():
        out[r.i, r.j] = r.v
    return out


def fit(vectors: DataFrame, width: int, weighted: bool = False) -> Fit:
    """Eigenvalues and eigenvectors of the covariance of ``(x, copies)``."""
    n, sums = exact_sums(vectors, width, weighted)
    if not n:
        return Fit(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    cov = centred_product(vectors, "x", np.array([s / n for s in sums]), weighted) / n
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    return Fit(n, sums, values[::-1], axes[:, ::-1], float(np.trace(cov)))


def project(vectors: DataFrame, found: Fit, components: int) -> DataFrame:
    """``vectors`` with ``whitened array<double>`` (NULL entries for components without variance) and ``deviation``."""
    width, n = len(found.sums), found.n
    mean = np.array([s / n for s in found.sums]) if n else np.zeros(width)
    values = found.values[:components]
    live = values > TINY * max(values, default=0.0)
    axes = found.vectors[:, :components][:, live] / np.sqrt(values[live])
    most_sum = max(map(abs, found.sums), default=0)

    def run(batches):
        sums = np.array(found.sums, object)
        for batch in batches:
            x = matrix_of(batch.column(0), width, np.int64)
            white = np.full((len(x), len(live)), np.nan)
            white[:, live] = (x.astype(np.float64) - mean) @ axes
            reach = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + most_sum
            if width * reach * reach < EXACT:
                dev = pa.array(((n * x - sums.astype(np.int64)) ** 2).sum(1), pa.int64())
            else:
                exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, found.sums)) for row in x]
                dev = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            cells = pa.array(white.ravel(), mask=np.tile(~live, len(x)))
            offsets = pa.array(np.arange(len(x) + 1) * len(live), pa.int32())
            out = batch.append_column("whitened", pa.ListArray.from_arrays(offsets, cells))
            yield out.append_column("deviation", dev)

    schema = T.StructType([*vectors.schema.fields, T.StructField("whitened", T.ArrayType(T.DoubleType())),
                           T.StructField("deviation", T.LongType())])
    return vectors.mapInArrow(run, schema)


def identity_error(projected: DataFrame, found: Fit, components: int, weighted: bool) -> float | None:
    """The largest entry of the measured covariance of whitened vectors, minus the identity."""
    values = found.values[:components]
    live = np.flatnonzero(values > TINY * max(values, default=0.0))
    if not len(live):
        return None
    w = F.col("copies") if weighted else F.lit(1)
    cells = [F.col("whitened")[int(i)].alias(f"c{i}") for i in live]
    white = projected.select(F.array(*cells).alias("whitened"), "copies", *cells)
    means = white.agg(*[(F.sum(F.col(f"c{i}") * w) / F.sum(w)).alias(f"c{i}") for i in live]).first()
    cov = centred_product(white, "whitened", np.array([means[f"c{i}"] for i in live]), weighted) / found.n
    return float(np.abs(cov - np.eye(len(live))).max())


def whiten(table: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = 4,
           weighted: bool = False, scale: int = SCALE) -> DataFrame:
    """``(key, n, deviation, whitened, explained, identity_error)`` for every row that remains.

    ``whitened`` and ``explained`` are arrays over the first ``components`` (all, if fewer);
    ``n`` is the weight of the fit; ``weighted`` takes counts as weights.
    """
    rows = (table.select(F.col(key).alias("key"), F.col(vec).alias("v")).filter(usable(F.col("v")))
            .select("key", quantised(F.col("v"), scale).alias("x")))
    rows = materialise(rows.withColumn("h", F.xxhash64("x")), "whitening-rows")
    vectors = materialise(distinct_vectors(rows), "whitening-distinct")
    total, width = vectors.agg(F.sum("copies"), F.max(F.size("x"))).first()
    width = width or 0
    found = fit(vectors, width, weighted)
    components = min(components, width)
    done = materialise(project(vectors, found, components).withColumn("h", F.xxhash64("x")), "whitening-projected")
    error = identity_error(done, found, components, weighted)
    hot = F.col("copies") * HOT > F.lit(total or 0).cast("bigint")
    few, others = done.filter(hot), done.filter(~hot)
    on = ["h", "x"]
    out = (rows.join(F.broadcast(few), on).select("key", "whitened", "deviation")
           .unionByName(rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(others, on)
                        .select("key", "whitened", "deviation")))
    shares = [float(v / found.trace) if found.trace > 0 else None for v in found.values[:components]]
    return out.select(F.col("key").alias(key), F.lit(found.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>").alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))
