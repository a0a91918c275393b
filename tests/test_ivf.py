"""Trained centroids, stored lists and block search."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import blocks as B
from quarry.operators import ivf as I
from quarry.operators.ann import ivf_topk, mean_vectors
from quarry.operators.search import dense_retrieve

SF = "/root/testdata/sf0.001"
POINTS = "point_id bigint, vector array<float>"


def _rows(df):
    return sorted((r.query_id, r["rank"], r.point_id, round(r.score, 6)) for r in df.collect())


def _clusters(spark, n=600, groups=6, dim=8, noise=0.05, seed=0):
    rng = np.random.default_rng(seed)
    centres = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:groups]
    x = centres[np.arange(n) % groups] + noise * rng.normal(size=(n, dim))
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], POINTS), centres


def test_training_finds_clusters_and_is_repeatable(spark):
    pts, centres = _clusters(spark)
    got = np.array([r.vector for r in I.train_centroids(pts, 6, 8).orderBy("list_id").collect()])
    assert got.shape == (6, 8) and (np.abs(np.linalg.norm(got, axis=1) - 1) < 1e-9).all()
    assert (np.sort((got @ centres.T).max(0)) > 0.98).all()
    again = np.array([r.vector for r in I.train_centroids(pts.repartition(7), 6, 8).orderBy("list_id").collect()])
    assert sorted(np.round(got, 6).tolist()) == sorted(np.round(again, 6).tolist())


def test_training_edges(spark):
    none = spark.createDataFrame([], POINTS)
    assert I.train_centroids(none, 4, 3).count() == 0
    few = spark.createDataFrame([(i, [float(i % 2), 1.0 - i % 2]) for i in range(50)] + [(60, None), (61, [1.0])], POINTS)
    assert I.train_centroids(few, 8, 2).count() == 2                       # two directions only
    uneven = spark.createDataFrame([(i, [1.0, 0.001 * (i % 7)]) for i in range(300)] + [(999, [0.0, 1.0])], POINTS)
    lists = I.train_centroids(uneven, 5, 2)
    assert 2 <= lists.count() <= 5 and lists.select("list_id").distinct().count() == lists.count()


def test_stored_lists_give_the_rows_of_the_masked_plan(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    pts = e.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), "label")
    qs = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    cents = mean_vectors(pts, "label").select(F.col("label").cast("bigint").alias("list_id"), "vector")
    base = tempfile.mkdtemp(prefix="quarry-ivf-")
    I.write_lists(pts, cents, base, 64, rows=16)
    for nprobe in (1, 3, 10):
        want = _rows(ivf_topk(pts, qs, cents, 64, nprobe=nprobe, k=3, threshold=0.2, exclude_self=True))
        assert _rows(I.search_lists(spark, base, qs, 64, nprobe, 3, 0.2, payload=["label"], exclude_self=True)) == want
    assert want == _rows(dense_retrieve(pts, qs, 64, k=3, threshold=0.2, exclude_self=True))


def test_only_probed_lists_are_read_and_a_hot_list_is_split(spark, capsys):
    pts, centres = _clusters(spark, n=900)
    hot = spark.createDataFrame([(10_000 + i, [float(v) for v in centres[2]]) for i in range(900)], POINTS)
    cents = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "list_id bigint, vector array<double>")
    base = tempfile.mkdtemp(prefix="quarry-ivf-")
    I.write_lists(pts.unionByName(hot), cents, base, 8, task_rows=200, rows=64)
    files = {d: [f for f in os.listdir(f"{base}/lists/{d}") if f.endswith(".parquet")] for d in os.listdir(f"{base}/lists") if d.startswith("list_id=")}
    assert len(files) == 6 and len(files["list_id=2"]) >= 3
    q = spark.createDataFrame([(1, [float(v) for v in centres[4]])], "query_id bigint, vector array<float>")
    hits = I.search_lists(spark, base, q, 8, 1, 5, 0.5)
    hits.explain("formatted")
    plan = capsys.readouterr().out
    assert any("PartitionFilters" in line and "list_id" in line and "= 4" in line for line in plan.splitlines())
    assert {r.point_id % 6 for r in hits.collect()} == {4}


def test_block_search_is_exact_at_any_block_size(spark):
    pts, _ = _clusters(spark, n=300, noise=0.4, seed=3)
    extra = spark.createDataFrame([(900, None), (901, [0.0] * 8), (902, [1.0])], POINTS)
    pts = pts.unionByName(extra).withColumn("tag", F.col("point_id") % 5)
    qs = pts.select(F.col("point_id").alias("query_id"), "vector").filter("point_id < 700").repartition(4)
    want = _rows(dense_retrieve(pts, qs, 8, k=4, threshold=0.3, payload=["tag"], exclude_self=True))
    for rows in (7, 64, 1024):
        assert _rows(I.search_blocks(pts, qs, 8, 4, 0.3, payload=["tag"], exclude_self=True, rows=rows)) == want
    assert I.search_blocks(pts.limit(0), qs, 8).count() == 0 and I.search_blocks(pts, qs.limit(0), 8).count() == 0


def test_far_blocks_are_skipped(spark):
    import pyarrow as pa
    rng = np.random.default_rng(5)
    centres = np.eye(8)[:4]
    scored = total = 0
    block = lambda c, n: pa.table({"point_id": list(range(n)), "vector": [list(map(float, c + 0.02 * rng.normal(size=8))) for _ in range(n)]})
    points = [I.PointBlock(B.dump(block(c, 40)), "vector", "point_id", 8) for c in centres]
    for c in centres:
        q = I.QueryBlock(B.dump(block(c, 10)), "vector", "point_id", 8, 3)
        for p in points:
            total += 1
            scored += q.meet(p, 0.5, False, None, ["point_id"])
    assert (scored, total) == (4, 16)
