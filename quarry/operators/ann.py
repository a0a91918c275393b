"""Approximate nearest neighbours as an inverted-file (IVF) plan.

1. Centroids: mean vector per group (e.g. a coarse label) -- a partial+final
   aggregate per (group, coordinate), then one bounded array per group.
2. Assignment: every point to its nearest centroid, every query to its
   ``nprobe`` nearest, by an Arrow pass against the centroid matrix, which is shipped
   in blocks of bounded size.
3. Search: the block scorer with a probe mask -- a query only scores the
   points of the lists it probes.  ``nprobe = n_lists`` equals exact search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.config import TOP_K
from quarry.operators.similarity import Encoding, _dense_matrix, topk
from quarry.session import scratch_dir


CENTROID_BLOCK_BYTES = 16 * 1024 * 1024


def mean_vectors(df: DataFrame, group: str, vec: str = "vector") -> DataFrame:
    """``(group, vector array<double>)``: coordinate-wise mean per group."""
    coords = df.select(group, F.posexplode(vec).alias("i", "x"))
    avg = coords.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return avg.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias(vec))


def assign_lists(df: DataFrame, centroids: DataFrame, dim: int, nprobe: int = 1, vec: str = "vector",
                 list_key: str = "list_id", out: str = "probes", decimals: int | None = None) -> DataFrame:
    """Append ``out array<int>``: the ids of the ``nprobe`` most similar centroids
    (ties by centroid id).  Centroids are shipped in blocks of ``CENTROID_BLOCK_BYTES`` and
    compared block by block, so their number has no limit."""
    spark = df.sparkSession
    tbl = centroids.select(list_key, vec).orderBy(list_key).toArrow()
    step = max(1, CENTROID_BLOCK_BYTES // (dim * 8))
    blocks = []
    for i in range(0, max(1, tbl.num_rows), step):
        part = tbl.slice(i, step)
        ids = part.column(list_key).to_numpy(zero_copy_only=False).astype(np.int64)
        blocks.append(spark.sparkContext.broadcast({"ids": ids, "m": _dense_matrix(part.column(vec), dim)[0]}))
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pm, valid = _dense_matrix(batch.column(vec), dim)
            best_s = np.zeros((len(pm), 0))
            best_i = np.zeros((len(pm), 0), np.int64)
            for block in blocks:
                s = pm @ block.value["m"].T
                s = np.round(s, decimals) if decimals is not None else s
                ids = np.broadcast_to(block.value["ids"], s.shape)
                s, ids = np.concatenate((best_s, s), 1), np.concatenate((best_i, ids), 1)
                # blocks ascend by id, so a stable sort orders by score desc, then centroid id
                order = np.argsort(-s, axis=1, kind="stable")[:, :nprobe]
                best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(ids, order, 1)
            lists = [i.astype(np.int32).tolist() if v else None for i, v in zip(best_i, valid)]
            yield batch.append_column(out, pa.array(lists, type=pa.list_(pa.int32())))

    return df.mapInArrow(run, schema)


def ivf_topk(points: DataFrame, queries: DataFrame, centroids: DataFrame, dim: int, nprobe: int = 3,
             k: int = TOP_K, threshold: float = 0.0, point_key: str = "point_id",
             payload: list[str] | None = None, exclude_self: bool = False,
             decimals: int | None = None) -> DataFrame:
    # the centroids are computed once and stored; lists are numbered densely for the probe mask
    folder = scratch_dir(points.sparkSession, "centroids")
    by_id = Window.orderBy("list_id")
    centroids.select("list_id", "vector").write.parquet(folder)
    stored = points.sparkSession.read.parquet(folder).withColumn("list_id", F.row_number().over(by_id) - 1)
    n_lists = max(1, stored.count())
    pts = assign_lists(points, stored, dim, 1, out="_lists", decimals=decimals).withColumn("list_id", F.col("_lists")[0]).drop("_lists")
    qs = assign_lists(queries, stored, dim, nprobe, out="probes", decimals=decimals)
    return topk(pts, qs, encoding=Encoding("dense", dim), k=k, threshold=threshold, point_key=point_key,
                payload=payload, exclude_self=exclude_self, list_col="list_id", probe_col="probes",
                n_lists=n_lists, decimals=decimals)
