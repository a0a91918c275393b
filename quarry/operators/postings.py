"""Stored posting lists in impact levels, searched exactly without reading all of them.

``<base>/postings`` holds one row for each block of up to ``BLOCK_CHUNKS`` chunks: their ids
(``pids``) and, in a column ``p<n>`` for every ``PART_DIMS`` dims, the block's lists of these dims.  A
list holds ``(row in the block, weight)`` by level: the weight ``tf / |p|`` of the bucket in its
chunk, cut into quarter octaves, heaviest first.  Only the columns of asked dims are read, and of
a list only its levels up to the cut.  ``<base>/directory`` holds for each ``(dim, level)`` the
number of postings and their greatest weight, ``dim x LEVELS`` rows at most however many chunks
there are.

A question adds up, over the lists of its own dims, the products of weights: an upper bound
of the cosine of every chunk it meets.  Let c_d be the greatest weight that is not read in
dim d.  A chunk's unread part is a vector with entries u_d <= c_d and at most unit length,
so it adds at most the greatest ``q . u`` over these (:func:`most_unread`); reading whole
lists leaves nothing.  A block holds all postings of its chunks, so a task adds them up where
they lie and hands on only the chunks whose bound reaches the threshold; neither postings nor
partial sums are shuffled.  Levels are read, cheapest gain first, until the rest is below ``REST``
times the threshold; a question for which that takes more than ``PAYS`` of its lists reads
them whole (chunks with many words of like weight leave little to skip).

Chunks are then scored exactly from their own terms: first the best few by upper bound,
which gives a k-th best cosine, then all whose bound reaches that.

Postings are only ever appended, before the chunks they belong to are visible.  Those of
chunks that went away or changed only raise a bound, and the exact step rejects them, so
the stored lists never need a rewrite to stay right (appending all live chunks to a new
folder drops the dead ones).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.config import LEXICAL_DIM, SCORE_THRESHOLD, TOP_K
from quarry.operators import blocks as B
from quarry.operators.lexical import token_dims
from quarry.session import scratch_dir

LEVELS = 32                # quarter octaves: weights from 1 down to 2 ** -8, all below in the last
REST, PAYS = 0.5, 0.5
AHEAD = 4                  # times k chunks are scored for a first k-th best
SLACK = 1e-9               # of rounding in weights and bounds
HALF = 1 << 63
PART_DIMS = 16
BLOCK_CHUNKS = 4096        # rows of a block are numbered in 16 bits
QUESTION_ROWS = 512        # questions of a block that meets the blocks of chunks
ROW_GROUP = 16 << 20
DIRECTORY = "dim int, level int, n bigint, top double"


def pid_of(point_id: Column) -> Column:
    """The uint64 id's 64 bits as BIGINT."""
    return F.when(point_id >= F.lit(str(HALF)).cast("decimal(20,0)"),
                  (point_id - F.lit(str(2 * HALF)).cast("decimal(20,0)")).cast("bigint")).otherwise(point_id.cast("bigint"))


def bag_norm2(terms: Column) -> Column:
    """Sum of squared counts: the r-th occurrence of a bucket adds 2r - 1."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).cast("bigint").alias("total"))

    def step(acc, x):
        run = F.when(x == acc["last"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), (acc["total"] + 2 * run - 1).cast("bigint").alias("total"))

    return F.aggregate(F.array_sort(terms), start, step, lambda acc: acc["total"])


def _cells(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row, dim, level, weight`` of every bucket of the bags."""
    sizes = np.diff(bags.offsets.to_numpy())
    row = np.repeat(np.arange(len(bags)), np.where(bags.is_valid().to_numpy(zero_copy_only=False), sizes, 0))
    term = bags.flatten().to_numpy()
    width = int(term.max(initial=0)) + 1
    cell, tf = np.unique(row * width + term, return_counts=True)
    row, dim = np.divmod(cell, width)
    weight = tf / np.sqrt(np.bincount(row, tf * tf, minlength=len(bags)))[row]
    level = np.clip(np.floor(-4 * np.log2(weight) + SLACK), 0, LEVELS - 1).astype(np.int64)
    return row, dim, level, weight


def levels_of(chunks: DataFrame) -> DataFrame:
    """``(dim, level, n, top)`` of chunks ``(point_id, terms)``: one part of the directory."""

    def run(batches):
        for batch in batches:
            _, dim, level, weight = _cells(batch.column(0))
            cell, at, n = np.unique(dim * LEVELS + level, return_inverse=True, return_counts=True)
            top = np.zeros(len(cell))
            np.maximum.at(top, at, weight)
            yield pa.RecordBatch.from_arrays([pa.array((cell // LEVELS).astype(np.int32)), pa.array((cell % LEVELS).astype(np.int32)),
                                              pa.array(n.astype(np.int64)), pa.array(top)], names=["dim", "level", "n", "top"])

    some = chunks.select("terms").mapInArrow(run, "dim int, level int, n bigint, top double")
    return some.groupBy("dim", "level").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def _dump_lists(bags: pa.Array, parts: int) -> list[bytes | None]:
    """The lists of a block by part: numbers by dim and level, then rows, then weights (rounded up)."""
    row, dim, level, weight = _cells(bags)
    cell = dim * LEVELS + level
    order = np.argsort(cell, kind="stable")
    n = np.bincount(cell, minlength=parts * PART_DIMS * LEVELS).astype("<u4").reshape(parts, -1)
    ends = np.cumsum(n.sum(1, dtype=np.int64))
    row, low = row[order].astype("<u2"), weight[order].astype("<f4")
    low = np.where(low < weight[order], np.nextafter(low, np.float32(2)), low).astype("<f4")
    return [n[p].tobytes() + row[a:b].tobytes() + low[a:b].tobytes() if b > a else None for p, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends))]


class Lists:
    """The lists of a block in one part."""

    def __init__(self, data):
        self.upto = np.concatenate(([0], np.cumsum(np.frombuffer(data, "<u4", PART_DIMS * LEVELS), dtype=np.int64)))
        head, total = 4 * PART_DIMS * LEVELS, int(self.upto[-1])
        self.row = np.frombuffer(data, "<u2", total, head)
        self.weight = np.frombuffer(data, "<f4", total, head + 2 * total)

    def first(self, dim: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and weights of a dim's levels below ``cut``."""
        a, b = self.upto[dim % PART_DIMS * LEVELS], self.upto[dim % PART_DIMS * LEVELS + cut]
        return self.row[a:b], self.weight[a:b].astype(np.float64)


def blocks_of(chunks: DataFrame, parts: int) -> DataFrame:
    """Chunks ``(point_id, terms)`` as rows ``(pids, p0, p1, ...)``, cut where they lie."""
    names = [f"p{p}" for p in range(parts)]

    def close(held):
        block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        lists = _dump_lists(block.column(1), parts)
        return pa.RecordBatch.from_arrays([pa.array([block.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                                           *[pa.array([x], pa.binary()) for x in lists]], names=["pids", *names])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK_CHUNKS - count)
                held.append(part)
                at, count = at + part.num_rows, count + part.num_rows
                if count == BLOCK_CHUNKS:
                    yield close(held)
                    held, count = [], 0
        if held:
            yield close(held)

    return chunks.select(pid_of(F.col("point_id")).alias("pid"), "terms").mapInArrow(run, ", ".join(f"{c} binary" for c in ["pids", *names]))


def append(chunks: DataFrame, base: str) -> None:
    """Add the postings of chunks and their part of the directory, in two passes over the terms.

    The directory part is written first: entries without postings only loosen a bound.
    """
    spark = chunks.sparkSession
    levels_of(chunks).write.mode("append").parquet(f"{base}/directory")
    most = spark.read.schema(DIRECTORY).parquet(f"{base}/directory").agg(F.max("dim")).first()[0]
    parts = 0 if most is None else most // PART_DIMS + 1
    blocks_of(chunks, parts).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(f"{base}/postings")


def exists(spark: SparkSession, base: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/postings/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_directory(spark: SparkSession, base: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and greatest weights by (dim, level): at most ``dim x LEVELS`` rows."""
    n, top = np.zeros((dim, LEVELS), np.int64), np.zeros((dim, LEVELS))
    rows = spark.read.schema(DIRECTORY).parquet(f"{base}/directory")
    for r in rows.groupBy("dim", "level").agg(F.sum("n").alias("n"), F.max("top").alias("top")).collect():
        n[r.dim, r.level], top[r.dim, r.level] = r.n, r.top
    return n, top


def most_unread(q: np.ndarray, cap: np.ndarray) -> tuple[float, np.ndarray]:
    """The greatest ``q . u`` with ``|u| <= 1`` and ``0 <= u <= cap``, and that ``u``.

    It is ``u = min(cap, s q)``: entries are capped in the order of ``cap / q``, and ``s`` uses up
    what the capped ones leave of the unit length.
    """
    if cap @ cap <= 1:
        return float(q @ cap), cap
    order = np.argsort(cap / q)
    c2, q2 = np.cumsum(np.r_[0, cap[order] ** 2]), np.cumsum(np.r_[0, q[order] ** 2])
    s = np.sqrt(np.maximum(1 - c2[:-1], 0) / np.maximum(q2[-1] - q2[:-1], 1e-300))
    at = int(np.argmax(s < (cap / q)[order]))               # the first entry that stays below its cap
    u = np.minimum(cap, s[at] * q)
    return float(q @ u), u


def plan_levels(q: np.ndarray, n: np.ndarray, top: np.ndarray, rest: float, pays: float = PAYS) -> tuple[np.ndarray, float]:
    """How many levels to read of each of a question's dims (its unit vector ``q``) so that what is
    unread adds less than ``rest``, and how much it may add; all, if that takes too large a share."""
    # greatest weight from a level on; a step of a dim goes to the next level
    caps = np.concatenate((np.maximum.accumulate(top[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))), axis=1)
    read, rows = np.zeros(len(q), np.int64), np.arange(len(q))
    upto = np.concatenate((np.zeros((len(q), 1), np.int64), np.cumsum(n, axis=1)), axis=1)
    while upto[rows, read].sum() <= pays * upto[:, -1].sum():
        cap = caps[rows, read]
        bound, u = most_unread(q, cap)
        if bound < rest or not cap.any():
            return read, bound * (1 + SLACK)
        after = caps[rows, np.minimum(read + 1, LEVELS)]
        gain = q * (np.maximum(u - after, 0) + 1e-3 * (cap - after))
        worth = np.where(cap > 0, (gain + 1e-12) / (1.0 + n[rows, np.minimum(read, LEVELS - 1)]), -1.0)
        read[(worth >= 0.5 * worth.max()) & (worth >= 0)] += 1
    return np.full(len(q), LEVELS), 0.0


PLAN = "struct<rest:double,lists:array<struct<dim:int,weight:double,cut:int>>>"


def plan(terms: Column, n: np.ndarray, top: np.ndarray, threshold: float, pays: float = PAYS) -> Column:
    """What a question reads: of each of its dims (with its weight) the levels below ``cut``."""

    @F.pandas_udf(PLAN)
    def run(bags: pd.Series) -> pd.DataFrame:
        rests, lists = [], []
        for bag in bags:
            dims, tf = np.unique(np.asarray(bag, np.int64), return_counts=True)
            q = tf / np.sqrt((tf * tf).sum()) if len(dims) else np.zeros(0)
            read, rest = plan_levels(q, n[dims], top[dims], REST * threshold, pays) if len(dims) else (q, 0.0)
            rests.append(rest)
            lists.append([{"dim": int(d), "weight": float(w), "cut": int(c)} for d, w, c in zip(dims, q, read) if c])
        return pd.DataFrame({"rest": rests, "lists": lists})

    return run(terms)


def _bounds(spark: SparkSession, base: str, asked: DataFrame, threshold: float) -> DataFrame:
    """``(query_id, pid, bound)`` of all chunks met whose cosine may reach the threshold.

    Blocks of questions meet the blocks of chunks on the executors; of these only the asked parts are read.
    """
    plans = asked.select("query_id", "plan.rest", "plan.lists")
    parts = sorted(r.p for r in plans.select(F.explode("lists.dim").alias("d"))                # dims / PART_DIMS at most
                   .select(F.floor(F.col("d") / PART_DIMS).cast("int").alias("p")).distinct().collect())
    questions = B.pack(plans, QUESTION_ROWS, plans.count())
    lists = spark.read.schema(", ".join(f"{c} binary" for c in ["pids", *(f"p{p}" for p in parts)])).parquet(f"{base}/postings")
    pairs = lists.crossJoin(questions.select(F.col("block").alias("q_block"), F.col("data").alias("q_data")))

    def run(batches):
        known = B.Last(lambda data: [(r["query_id"], r["rest"], r["lists"]) for r in B.load(data).to_pylist()])
        for batch in batches:
            for i in range(batch.num_rows):
                pids = np.frombuffer(batch.column("pids")[i].as_buffer(), "<i8")
                some = {p: Lists(batch.column(f"p{p}")[i].as_buffer()) for p in parts if batch.column(f"p{p}")[i].is_valid}
                out_q, out_p, out_b = [], [], []
                for query, rest, cuts in known.get_block(batch.column("q_block")[i].as_py(), batch.column("q_data")[i].as_buffer()):
                    bound = np.full(len(pids), rest)
                    for c in cuts:
                        if (at := some.get(c["dim"] // PART_DIMS)) is not None:
                            rows, weight = at.first(c["dim"], c["cut"])
                            bound[rows] += c["weight"] * weight
                    near = np.flatnonzero(bound >= threshold - SLACK) if cuts else []
                    if len(near):
                        out_q.append(np.full(len(near), query, np.int64))
                        out_p.append(pids[near])
                        out_b.append(bound[near])
                if out_q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_p, out_b)], names=["query_id", "pid", "bound"])

    # an id that was appended again has a bound in each of its blocks
    return pairs.mapInArrow(run, "query_id bigint, pid bigint, bound double").groupBy("query_id", "pid").agg(F.max("bound").alias("bound"))


def _exact(cands: DataFrame, chunks: DataFrame, asked: DataFrame, k: int, threshold: float) -> DataFrame:
    """The k best candidates by exact cosine: ``query_id, rank, score, point_id``."""
    live = chunks.select("point_id", "terms", pid_of(F.col("point_id")).alias("pid"))
    dot = F.aggregate("terms", F.lit(0).cast("bigint"), lambda acc, x: acc + F.get(F.col("dense"), x))
    met = (live.join(cands.select("query_id", "pid"), "pid").join(asked.select("query_id", "dense", "q2"), "query_id")
           .select("query_id", "point_id", "q2", dot.alias("dot"), bag_norm2(F.col("terms")).alias("p2"))
           .filter(F.col("dot") > 0))
    key = (F.col("dot") * F.col("dot")).cast("double") / F.col("p2").cast("double")
    order = Window.partitionBy("query_id").orderBy(F.desc("key"), F.asc("point_id"))
    return (met.select("query_id", "point_id", key.alias("key"), F.sqrt(key / F.col("q2").cast("double")).alias("score"))
            .filter(F.col("score") >= threshold).withColumn("rank", F.row_number().over(order).cast("bigint"))
            .filter(F.col("rank") <= k).select("query_id", "rank", "score", "point_id"))


def posting_topk(base: str, chunks: DataFrame, queries: DataFrame, k: int = TOP_K, threshold: float = SCORE_THRESHOLD,
                 payload: list[str] | None = None, dim: int = LEXICAL_DIM, method: str = "md5",
                 decimals: int | None = None, pays: float = PAYS) -> DataFrame:
    """The ``k`` best chunks with cosine >= ``threshold`` (above 0) for every question ``(query_id, text)``:
    ``(query_id, rank, score, point_id, *payload)``, equal cosines by point id."""
    if not threshold > 0:
        raise ValueError("posting lists hold only what shares a word: the threshold must be above 0")
    spark = chunks.sparkSession
    dense = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: F.size(F.filter(F.col("terms"), lambda x: x == d)))
    bags = queries.select("query_id", token_dims("text", dim, method).alias("terms"))
    n, top = read_directory(spark, base, dim)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    asked = stored(bags.select("query_id", dense.alias("dense"), bag_norm2(F.col("terms")).alias("q2"),
                               plan(F.col("terms"), n, top, threshold, pays).alias("plan")), "questions")
    bounds = stored(_bounds(spark, base, asked, threshold), "bounds")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), F.asc("pid"))
    ahead = bounds.withColumn("r", F.row_number().over(by_bound)).filter(F.col("r") <= AHEAD * k)
    kth = _exact(ahead, chunks, asked, k, threshold).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    near = bounds.join(kth, "query_id", "left").filter(F.col("bound") >= F.coalesce("kth", F.lit(threshold)) - SLACK)
    hits = stored(_exact(near, chunks, asked, k, threshold), "hits")
    if decimals is not None:
        hits = hits.withColumn("score", F.round("score", decimals))
    cols = [c for c in payload or [] if c != "point_id"]
    return hits.join(chunks.select("point_id", *cols), "point_id").select("query_id", "rank", "score", "point_id", *cols) if cols else hits


def postings_read(base: str, queries: DataFrame, threshold: float, dim: int = LEXICAL_DIM, method: str = "md5",
                  pays: float = PAYS) -> DataFrame:
    """``(query_id, n_read, n_lists, n_all)``: postings that a question reads, those in the lists of its dims, and all."""
    n, top = read_directory(queries.sparkSession, base, dim)
    upto = np.concatenate((np.zeros((dim, 1), np.int64), np.cumsum(n, axis=1)), axis=1)

    @F.pandas_udf("struct<n_read:bigint,n_lists:bigint>")
    def count(lists: pd.Series, bags: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"n_read": [sum(int(upto[c["dim"], c["cut"]]) for c in some) for some in lists],
                             "n_lists": [int(upto[np.unique(np.asarray(b, np.int64)), LEVELS].sum()) for b in bags]})

    terms = token_dims("text", dim, method)
    planned = queries.select("query_id", terms.alias("terms")).select("query_id", "terms", plan(F.col("terms"), n, top, threshold, pays).alias("plan"))
    return planned.select("query_id", count("plan.lists", "terms").alias("c")).select(
        "query_id", "c.n_read", "c.n_lists", F.lit(int(n.sum())).cast("bigint").alias("n_all"))
