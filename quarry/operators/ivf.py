"""Inverted-file search over stored lists: trained centroids, points stored by list, probed lists only.

* :func:`train_centroids` -- k-means on unit vectors.  Seeding is k-means||: a few rounds in
  which every point becomes a candidate with a probability in proportion to its distance from
  the candidates so far (decided by a hash of its id, so a retried task decides alike), then
  weighted k-means++ on the candidates.  A Lloyd step assigns points in Arrow batches and adds
  up per task, then per cluster; the driver only ever sees ``lists x width`` numbers and the
  candidates, whose number ``lists`` bounds.  A list that runs empty is given half of the
  heaviest one.  It stops when no centroid moves by more than ``tol``.
* :func:`write_lists` -- each point goes to the list of its most similar centroid and is stored
  in blocks, partitioned by ``list_id``.  A list with many points is dealt over several writers
  (and so files) by a salt, so no task holds a list.
* :func:`search_lists` -- questions go to the lists they probe as blocks too; blocks meet on
  ``list_id`` (only the probed folders are read), and a task scores a pair of blocks with one
  matrix product.  A pair is left out where the angle between a block's centre and the
  question, less the block's own width, cannot reach what the question still needs.
* :func:`search_blocks` -- the same without lists, exact, for question tables of any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from quarry.config import TOP_K
from quarry.operators import blocks as B
from quarry.operators.ann import assign_lists
from quarry.operators.similarity import _dense_matrix, _exact_topk, _key_order, _looseness, near_pairs
from quarry.session import scratch_dir

SEED = 11
ROUNDS = 5                 # of candidates
OVERSAMPLE = 2             # candidates a round, times lists
BLOCK_ROWS = 1024
LIST_TASK_ROWS = 262_144   # of a list that one task writes


# --------------------------------------------------------------------------- training

def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most similar centre of each unit vector (the first of equals) and the squared distance to it."""
    s = x @ centres.T
    at = s.argmax(1)
    return at, np.maximum(2 - 2 * s[np.arange(len(x)), at], 0.0)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _seeds(points: DataFrame, lists: int, dim: int, key: str, vec: str, seed: int) -> np.ndarray:
    """k-means||, then weighted k-means++ on the candidates."""
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    first = points.select(vec).orderBy(draw, key).limit(1).toArrow()
    centres = _dense_matrix(first.column(vec), dim)[0]
    for step in range(ROUNDS):
        cost = _sum_cost(points, vec, dim, centres)
        if cost <= 0:
            break
        want, now = OVERSAMPLE * lists / cost, centres

        def pick(batches):
            for batch in batches:
                x, ok = _dense_matrix(batch.column(0), dim)
                take = ok & (batch.column(1).to_numpy() < want * _nearest(x, now)[1])
                yield pa.RecordBatch.from_arrays([pa.array(list(x[take]), pa.list_(pa.float64()))], names=["v"])

        chance = F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(step)), F.lit(1 << 53)) / float(1 << 53)
        found = points.select(vec, chance.alias("chance")).mapInArrow(pick, "v array<double>").toArrow()     # some 2 * lists
        if found.num_rows:
            centres = np.concatenate((centres, _dense_matrix(found.column("v"), dim)[0]))
    centres = np.unique(centres, axis=0)
    weights = np.zeros(len(centres))
    for r in _step(points, vec, dim, centres)[0]:
        weights[r[0]] = r[1]
    rng = np.random.default_rng(seed)
    chosen = [int(weights.argmax())]
    far = np.maximum(2 - 2 * centres @ centres[chosen[0]], 0.0)
    while len(chosen) < min(lists, len(centres)):
        mass = weights * far
        if mass.sum() <= 0:
            break
        chosen.append(int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum())))
        far = np.minimum(far, np.maximum(2 - 2 * centres @ centres[chosen[-1]], 0.0))
    return centres[chosen]


def _sum_cost(points: DataFrame, vec: str, dim: int, centres: np.ndarray) -> float:
    def run(batches):
        total = 0.0
        for batch in batches:
            x, ok = _dense_matrix(batch.column(0), dim)
            total += float(_nearest(x, centres)[1][ok].sum())
        yield pa.RecordBatch.from_pydict({"c": pa.array([total])})
    return points.select(vec).mapInArrow(run, "c double").agg(F.sum("c")).first()[0] or 0.0


def _step(points: DataFrame, vec: str, dim: int, centres: np.ndarray) -> tuple[list, np.ndarray]:
    """``[(list, points)]`` and the sums of the lists' unit vectors."""

    def run(batches):
        n, sums = np.zeros(len(centres), np.int64), np.zeros((len(centres), dim))
        for batch in batches:
            x, ok = _dense_matrix(batch.column(0), dim)
            x = x[ok]
            at = _nearest(x, centres)[0]
            n += np.bincount(at, minlength=len(centres))
            order = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0]) if len(at) else np.zeros(0, int)
            if len(at):
                sums[at[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.float64()))],
                                         names=["list", "n", "s"])

    parts = points.select(vec).mapInArrow(run, "list int, n bigint, s array<double>")
    cells = parts.select("list", "n", F.posexplode("s").alias("i", "s")).groupBy("list", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums, n = np.zeros((len(centres), dim)), {}
    for r in cells.collect():                           # lists x width at most
        sums[r.list, r.i] = r.s
        n[r.list] = r.n
    return sorted(n.items()), sums


def train_centroids(points: DataFrame, lists: int, dim: int, key: str = "point_id", vec: str = "vector",
                    steps: int = 12, tol: float = 1e-3, seed: int = SEED) -> DataFrame:
    """``(list_id bigint, vector array<double>)``: at most ``lists`` unit centroids of the points' directions.

    Points whose vector is missing or of another width take no part; fewer distinct directions
    than ``lists`` give fewer centroids; no points, none.
    """
    spark = points.sparkSession
    points = _stored(points.select(key, vec).filter(F.size(vec) == dim), "kmeans")
    schema = "list_id bigint, vector array<double>"
    if points.isEmpty():
        return spark.createDataFrame([], schema)
    centres = _seeds(points, lists, dim, key, vec, seed)
    for _ in range(steps):
        sizes, sums = _step(points, vec, dim, centres)
        new = _unit(sums)
        n = np.zeros(len(centres))
        for at, count in sizes:
            n[at] = count
        for empty in np.flatnonzero(n == 0):            # half of the heaviest list: its centroid, leaned to one side
            heavy = int(n.argmax())
            lean = np.random.default_rng([seed, int(empty)]).normal(size=dim)
            new[empty] = _unit((new[heavy] + 0.05 * lean / np.linalg.norm(lean))[None])[0]
            n[empty] = n[heavy] = n[heavy] / 2
        moved = float(np.linalg.norm(new - centres, axis=1).max())
        centres = new
        if moved <= tol:
            break
    table = pa.table({"list_id": pa.array(range(len(centres)), pa.int64()), "vector": pa.array(list(centres), pa.list_(pa.float64()))})
    return spark.createDataFrame(table).select("list_id", "vector")


# --------------------------------------------------------------------------- blocks by list

def _pack_lists(df: DataFrame, rows: int, by: str) -> DataFrame:
    """Blocks of at most ``rows`` rows of one list each: ``(list_id, data)``; rows of a list must lie together."""
    names = [c for c in df.columns if c != by]

    def cut(batches):
        held, count, current = [], 0, None

        def close():
            out = pa.RecordBatch.from_pydict({by: pa.array([current], pa.int64()),
                                              "data": pa.array([B.dump(pa.Table.from_batches(held))], pa.binary())})
            return out

        for batch in batches:
            lists = batch.column(by).to_numpy()
            edges = np.r_[0, np.flatnonzero(np.diff(lists)) + 1, len(lists)] if len(lists) else [0]
            body = batch.select(names)
            for a, b in zip(edges[:-1], edges[1:]):
                a, b = int(a), int(b)
                while a < b:
                    if held and (int(lists[a]) != current or count >= rows):
                        yield close()
                        held, count = [], 0
                    current = int(lists[a])
                    part = body.slice(a, min(rows - count, b - a))
                    held.append(part)
                    a, count = a + part.num_rows, count + part.num_rows
        if held:
            yield close()

    return df.mapInArrow(cut, f"{by} bigint, data binary")


def write_lists(points: DataFrame, centroids: DataFrame, base: str, dim: int, vec: str = "vector", key: str = "point_id",
                task_rows: int = LIST_TASK_ROWS, rows: int = BLOCK_ROWS, decimals: int | None = None) -> None:
    """Store points as blocks under ``<base>/lists/list_id=...``, and the centroids beside them."""
    spark = points.sparkSession
    centroids.write.mode("overwrite").parquet(f"{base}/centroids")
    centroids = spark.read.parquet(f"{base}/centroids")
    placed = assign_lists(points, centroids, dim, 1, vec=vec, out="_lists", decimals=decimals)
    placed = _stored(placed.withColumn("list_id", F.get("_lists", F.lit(0)).cast("bigint")).drop("_lists").filter("list_id is not null"), "placed")
    sizes = placed.groupBy("list_id").agg(F.ceil(F.count("*") / task_rows).alias("_ways"))          # a row a list
    salt = F.pmod(F.xxhash64(F.col(key)), F.col("_ways")).cast("int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (placed.join(sizes, "list_id").withColumn("_salt", salt).repartition(parts, "list_id", "_salt")
             .sortWithinPartitions("list_id", key).drop("_salt", "_ways"))
    (_pack_lists(dealt, rows, "list_id").write.mode("overwrite").partitionBy("list_id").parquet(f"{base}/lists"))
    (spark.createDataFrame([(placed.select(*points.columns).schema.json(),)], "schema string").coalesce(1)
     .write.mode("overwrite").parquet(f"{base}/schema"))


def stored_schema(spark: SparkSession, base: str) -> T.StructType:
    import json
    return T.StructType.fromJson(json.loads(spark.read.parquet(f"{base}/schema").first()[0]))


class PointBlock:
    """Unit vectors of a block, with a centre and the least cosine to it."""

    def __init__(self, data, vec: str, key: str, dim: int):
        self.rows = B.load(data)
        self.x, self.ok = _dense_matrix(self.rows.column(vec), dim)
        self.x32 = self.x.astype(np.float32)
        self.x32[~self.ok] = np.nan                     # reaches nothing
        self.keys = self.rows.column(key)
        self.order = _key_order(self.keys)
        centre = self.x[self.ok].sum(0)
        norm = np.linalg.norm(centre)
        self.centre = centre / norm if norm > 0 else centre
        self.width = float(np.arccos(np.clip((self.x[self.ok] @ self.centre).min(initial=1.0), -1, 1))) if norm > 0 else np.pi


class QueryBlock:
    """Questions of a block and the best points that they met so far."""

    def __init__(self, data, vec: str, key: str, dim: int, k: int):
        rows = B.load(data)
        self.ids = rows.column(key).to_numpy().astype(np.int64)
        self.q, self.ok = _dense_matrix(rows.column(vec), dim)
        self.q32 = self.q.astype(np.float32)
        self.kth = np.full(len(self.ids), -np.inf)
        self.best: pa.Table | None = None
        self.k = k

    def could(self, block: PointBlock, threshold: float, loose: float) -> np.ndarray:
        """Questions for which some point of the block may count."""
        angle = np.arccos(np.clip(self.q @ block.centre, -1, 1)) - block.width
        most = np.where(angle > 0, np.cos(np.maximum(angle, 0)), 1.0)
        return np.flatnonzero(self.ok & (most + loose >= np.maximum(self.kth, threshold)))

    def meet(self, block: PointBlock, threshold: float, exclude_self: bool, decimals: int | None, keep: list[str]) -> bool:
        """Score the block; False where no question needed it."""
        loose = 1e-9 + (0 if decimals is None else 10.0 ** -decimals)
        some = self.could(block, threshold, loose)
        if not len(some):
            return False
        least = np.maximum(self.kth[some], threshold) - _looseness(self.q.shape[1], decimals)
        r, c, s = near_pairs(block.x, self.q[some], block.x32, self.q32[some], least)
        ok = s >= threshold
        if exclude_self:
            ok &= block.keys.to_numpy(zero_copy_only=False)[r] != self.ids[some[c]]
        if decimals is not None:
            s = np.round(s, decimals)
        ok &= s >= self.kth[some[c]]
        r, c, s = r[ok], c[ok], s[ok]
        if not len(r):
            return True
        new = block.rows.select(keep).take(pa.array(r, pa.int64()))
        new = pa.Table.from_batches([new]).append_column("_q", pa.array(some[c])).append_column("_s", pa.array(s))
        new = new.append_column("_o", pa.array(block.order[r]))
        both = new if self.best is None else pa.concat_tables([self.best, new])
        qi, sc = both.column("_q").to_numpy(), both.column("_s").to_numpy()
        top = _exact_topk(qi, sc, both.column("_o").to_numpy(), self.k)
        self.best = both.take(pa.array(top, pa.int64())).combine_chunks()
        qi, sc = qi[top], sc[top]
        full = np.flatnonzero(np.bincount(qi, minlength=len(self.ids)) >= self.k)
        least = np.full(len(self.ids), np.inf)
        np.minimum.at(least, qi, sc)
        self.kth[full] = least[full]
        return True


def _score_pairs(pairs: DataFrame, schema: T.StructType, dim: int, k: int, threshold: float, key: str, vec: str,
                 query_key: str, qvec: str, payload: list[str], exclude_self: bool, decimals: int | None) -> DataFrame:
    """Top ``k`` of ``(q_block, q_data, p_data)`` pairs."""
    keep = list(dict.fromkeys([key, *payload]))
    out = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("score", T.DoubleType()), *[schema[c] for c in keep]])

    def run(batches):
        asked: dict[int, QueryBlock] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                at = batch.column(0)[i].as_py()
                if at not in asked:
                    asked[at] = QueryBlock(batch.column(1)[i].as_buffer(), qvec, query_key, dim, k)
                asked[at].meet(PointBlock(batch.column(2)[i].as_buffer(), vec, key, dim), threshold, exclude_self, decimals, keep)
        for block in asked.values():
            if block.best is not None:
                ids = pa.array(block.ids[block.best.column("_q").to_numpy()])
                table = pa.Table.from_arrays([ids, block.best.column("_s"), *[block.best.column(c) for c in keep]], names=["query_id", "score", *keep])
                yield from table.to_batches()

    found = pairs.select("q_block", "q_data", "p_data").mapInArrow(run, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    return (found.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "score", *keep))


def search_lists(spark: SparkSession, base: str, queries: DataFrame, dim: int, nprobe: int, k: int = TOP_K, threshold: float = 0.0,
                 key: str = "point_id", vec: str = "vector", query_key: str = "query_id", qvec: str = "vector",
                 payload: list[str] | None = None, exclude_self: bool = False, decimals: int | None = None) -> DataFrame:
    """The ``k`` best points with cosine >= ``threshold`` from the ``nprobe`` lists nearest to each question."""
    centroids = spark.read.parquet(f"{base}/centroids")
    probes = assign_lists(queries.select(query_key, qvec), centroids, dim, nprobe, vec=qvec, out="_p", decimals=decimals)
    probes = probes.select(F.explode(F.col("_p").cast("array<bigint>")).alias("list_id"), query_key, qvec)
    probes = probes.repartition("list_id", F.pmod(F.xxhash64(query_key), F.lit(16))).sortWithinPartitions("list_id", query_key)
    asked = _stored(_pack_lists(probes, BLOCK_ROWS, "list_id").select("list_id", F.col("data").alias("q_data"))
                    .withColumn("q_block", F.monotonically_increasing_id()), "probes")
    wanted = [r.list_id for r in asked.select("list_id").distinct().collect()]                     # lists at most
    stored = (spark.read.schema("data binary, list_id bigint").parquet(f"{base}/lists").filter(F.col("list_id").isin(wanted))
              .select("list_id", F.col("data").alias("p_data")))
    return _score_pairs(stored.join(asked, "list_id"), stored_schema(spark, base), dim, k, threshold, key, vec, query_key, qvec,
                        [c for c in payload or [] if c != key], exclude_self, decimals)


def search_blocks(points: DataFrame, queries: DataFrame, dim: int, k: int = TOP_K, threshold: float = 0.0, key: str = "point_id",
                  vec: str = "vector", query_key: str = "query_id", qvec: str = "vector", payload: list[str] | None = None,
                  exclude_self: bool = False, decimals: int | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact top ``k`` for question tables of any size: blocks of questions meet all blocks of points on the executors."""
    payload = [c for c in payload or [] if c != key]
    cols = list(dict.fromkeys([key, vec, *payload]))
    asked = _stored(B.pack(queries.select(query_key, qvec), rows, queries.count()), "question-blocks")
    stored = _stored(B.pack(points.select(*cols), rows, points.count()), "point-blocks")
    return _score_pairs(B.pairs(asked, stored), points.select(*cols).schema, dim, k, threshold, key, vec, query_key, qvec,
                        payload, exclude_self, decimals)
