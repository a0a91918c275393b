"""Top-k scorer invariants."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import similarity as SIM
from quarry.operators.ann import ivf_topk, mean_vectors
from quarry.operators.index import replace_files, upsert
from quarry.operators.search import dense_retrieve
from quarry.functions import vectors as V

SF = "/root/testdata/sf0.001"


def _emb(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    pts = e.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), "label")
    qs = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return pts, qs


def _rows(df):
    return sorted((r.query_id, r.rank, r.point_id, round(r.score, 6)) for r in df.collect())


def test_scorer_equals_sql_reference(spark):
    pts, qs = _emb(spark)
    fast = dense_retrieve(pts, qs, 64, k=3, threshold=0.2, exclude_self=True)
    pairs = (qs.withColumnRenamed("vector", "qv").join(pts, F.col("query_id") != F.col("point_id"))
             .select("query_id", "point_id", F.round(V.cosine("qv", "vector"), 6).alias("score"))
             .filter("score >= 0.2"))
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    ref = pairs.withColumn("rank", F.row_number().over(w)).filter("rank <= 3")
    assert _rows(fast) == _rows(ref)


def test_query_blocks_do_not_change_results(spark, monkeypatch):
    pts, qs = _emb(spark)
    base = _rows(dense_retrieve(pts, qs, 64, k=3, threshold=0.2, exclude_self=True))
    monkeypatch.setattr(SIM, "_SCORE_BLOCK_BYTES", 4096)
    monkeypatch.setattr(SIM, "_POINT_BLOCK_BYTES", 64 * 8 * 7)     # 7-row slices
    blocked = SIM.topk(pts.repartition(5), qs, encoding=SIM.Encoding("dense", 64), k=3, threshold=0.2,
                       exclude_self=True, max_query_bytes=64 * 8 * 37)
    assert _rows(blocked) == base


def test_ivf_with_all_lists_is_exact(spark):
    pts, qs = _emb(spark)
    cents = mean_vectors(pts, "label").withColumnRenamed("label", "list_id")
    exact = _rows(dense_retrieve(pts, qs, 64, k=3, threshold=0.2, exclude_self=True))
    approx = _rows(ivf_topk(pts, qs, cents, 64, nprobe=10, k=3, threshold=0.2, exclude_self=True))
    assert approx == exact


def test_exact_topk_helper():
    qi = np.array([0, 0, 0, 1, 1])
    sc = np.array([0.5, 0.9, 0.9, 0.1, 0.2])
    key = np.array([3, 2, 1, 5, 4])
    keep = sorted(SIM._exact_topk(qi, sc, key, 2).tolist())
    assert keep == [1, 2, 3, 4]


def test_upsert_idempotent_and_replace_no_surplus(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z")],
                                "point_id bigint, source_file string, text string")
    new = spark.createDataFrame([(1, "a", "x2")], "point_id bigint, source_file string, text string")
    once = upsert(old, new)
    twice = upsert(once, new)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.point_id: r.text for r in once.collect()} == {1: "x2", 2: "y", 3: "z"}
    rep = replace_files(old, new)
    assert sorted((r.point_id, r.text) for r in rep.collect()) == [(1, "x2"), (3, "z")]


def test_rows_that_repeat_a_key_are_decided_by_their_values(spark):
    old = spark.createDataFrame([(1, "a", "x", {"k": 1})], "point_id bigint, source_file string, text string, m map<string,int>")
    new = spark.createDataFrame([(2, "b", t, {"k": 2}) for t in "qzpm"], old.schema)
    for parts in (1, 3, 4):
        for out in (upsert(old, new.repartition(parts)), replace_files(old, new.repartition(parts))):
            assert sorted((r.point_id, r.text) for r in out.collect()) == [(1, "x"), (2, "z")]


def test_lexical_xxhash_option_is_consistent(spark):
    from decimal import Decimal
    from quarry.operators.search import lexical_retrieve
    chunks = spark.createDataFrame(
        [(Decimal(1), "a.txt", None, 0, "machine learning fits models"),
         (Decimal(2), "b.txt", None, 0, "cats purr and sleep")],
        "point_id decimal(20,0), source_file string, page_number bigint, chunk_index bigint, text string")
    q = spark.createDataFrame([(0, "machine learning")], "query_id bigint, text string")
    for method in ("md5", "xxhash64"):
        hits = lexical_retrieve(chunks, q, k=1, threshold=0.1, method=method).collect()
        assert [h.source_file for h in hits] == ["a.txt"]


def _one_word_chunks(spark):
    """Texts that repeat one word 1 to 60 times all have the same cosine."""
    from decimal import Decimal
    rows = [(Decimal((7 * n) % 61), "a.txt", None, n, "the " * n) for n in range(1, 61)]
    rows += [(Decimal(100 + n), "b.txt", None, n, "the " * n + "cat") for n in range(1, 9)]
    return spark.createDataFrame(
        rows, "point_id decimal(20,0), source_file string, page_number bigint, chunk_index bigint, text string")


def test_equal_cosines_go_by_point_id(spark):
    from quarry.operators.search import lexical_retrieve
    q = spark.createDataFrame([(0, "the cat the dog the bird"), (1, "the")], "query_id bigint, text string")
    for decimals in (None, 6):
        hits = lexical_retrieve(_one_word_chunks(spark).repartition(7), q, k=80, threshold=0.1, decimals=decimals).collect()
        alike = [int(h.point_id) for h in sorted(hits, key=lambda h: h["rank"]) if h.query_id == 1 and h.source_file == "a.txt"]
        assert alike == list(range(1, 61))
        mixed = [int(h.point_id) for h in sorted(hits, key=lambda h: h["rank"]) if h.query_id == 0 and h.source_file == "a.txt"]
        assert mixed == list(range(1, 61))


def test_many_equal_scores_take_little_memory():
    """Equal vectors are ranked by key without holding all of their pairs."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    n, nq, dim = 4096, 1500, 64
    vec = np.random.default_rng(5).normal(size=dim).astype(np.float32)
    keys = np.random.default_rng(6).permutation(n).astype(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array([vec] * n, pa.list_(pa.float32()))], names=["point_id", "vector"])
    unit = vec.astype(np.float64) / np.linalg.norm(vec.astype(np.float64))
    block = SimpleNamespace(value={"ids": np.arange(nq, dtype=np.int64), "matrix": np.tile(unit, (nq, 1))})
    run = SIM._scorer(SIM.Encoding("dense", dim), "point_id", "vector", [], block, 3, 0.2, 6, True, None)
    tracemalloc.start()
    hits = pa.Table.from_batches(list(run(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = {}
    for query, key in zip(hits.column("query_id").to_pylist(), hits.column("point_id").to_pylist()):
        found.setdefault(query, []).append(key)
    assert all(found[query] == [key for key in range(5) if key != query][:3] for query in range(nq))
    assert peak < 120e6, peak
