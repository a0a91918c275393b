"""Stored posting lists: bounds, plans and exact results, also with dead and changed chunks in the lists."""

import tempfile
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import postings as P
from quarry.operators.lexical import token_dims
from quarry.operators.search import lexical_retrieve

WORDS = "the of and cat dog bird tree stone river cloud ember quartz violet zephyr".split()


def _chunks(spark, seed, n, first=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 40))
        text = " ".join(WORDS[min(int(v), len(WORDS) - 1)] for v in rng.geometric(0.25, size) - 1)
        rows.append((Decimal(first + i) + (Decimal(2 ** 63) if i % 3 == 0 else 0), "f.txt", text))
    return (spark.createDataFrame(rows, "point_id decimal(20,0), source_file string, text string")
            .withColumns({"page_number": F.lit(None).cast("bigint"), "chunk_index": F.lit(0).cast("bigint"), "terms": token_dims("text")}))


def _hits(df):
    return sorted((r.query_id, r["rank"], r.score, r.point_id) for r in df.collect())


def _questions(spark):
    texts = ["zephyr quartz", "the cat and the dog", "the the the of", "violet river stone cloud ember", "unknown words", "", "cat", "quartz quartz the"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")


@pytest.mark.parametrize("seed", range(4))
def test_most_unread_is_the_greatest_product(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        d = int(rng.integers(1, 7))
        q = rng.random(d) + 0.01
        q /= np.linalg.norm(q)
        cap = rng.random(d) * rng.integers(0, 2, d) * rng.choice([0.2, 1.0])
        bound, u = P.most_unread(q, cap)
        assert (u <= cap + 1e-12).all() and np.linalg.norm(u) <= 1 + 1e-9 and abs(q @ u - bound) < 1e-12
        for _ in range(300):
            v = rng.random(d) * cap
            for _ in range(4):                      # grow a random point to the border
                v = np.minimum(v * 1.5, cap)
            if np.linalg.norm(v) > 1:
                v /= np.linalg.norm(v)
            assert q @ v <= bound + 1e-9


def test_lists_give_what_scoring_every_chunk_gives(spark):
    chunks, q = _chunks(spark, 1, 500), _questions(spark)
    base = tempfile.mkdtemp(prefix="quarry-postings-")
    P.append(chunks, base)
    for k, t, pays in [(3, 0.3, 0.5), (7, 0.05, 1.0), (2, 0.7, 1.0), (1000, 0.2, 0.5)]:
        assert _hits(P.posting_topk(base, chunks, q, k, t, pays=pays)) == _hits(lexical_retrieve(chunks, q, k, t)), (k, t, pays)
    read = {r.query_id: r for r in P.postings_read(base, q, 0.9, pays=1.0).collect()}
    assert all(r.n_read <= r.n_lists <= r.n_all for r in read.values())
    assert sum(r.n_read for r in read.values()) < sum(r.n_lists for r in read.values())      # levels are left out
    assert read[5].n_lists == 0
    with pytest.raises(ValueError):
        P.posting_topk(base, chunks, q, 3, 0.0)


def test_changed_and_dead_chunks_stay_in_the_lists_without_harm(spark):
    old, q = _chunks(spark, 2, 300), _questions(spark)
    base = tempfile.mkdtemp(prefix="quarry-postings-")
    P.append(old, base)
    new = _chunks(spark, 3, 120)                    # the same ids with other texts
    P.append(new, base)
    live = old.join(new, "point_id", "left_anti").unionByName(new).filter("cast(point_id as string) not like '%7'")
    live.write.parquet(base + "/live")
    live = spark.read.parquet(base + "/live")
    for t in (0.1, 0.6):
        assert _hits(P.posting_topk(base, live, q, 3, t)) == _hits(lexical_retrieve(live, q, 3, t))


def test_empty_collection(spark):
    base = tempfile.mkdtemp(prefix="quarry-postings-")
    none = _chunks(spark, 1, 1).limit(0)
    P.append(none, base)
    assert P.posting_topk(base, none, _questions(spark), 3, 0.3, payload=["text"]).count() == 0


def test_bounds_are_summed_where_a_block_lies(spark):
    chunks, q = _chunks(spark, 4, 400).coalesce(2), _questions(spark)
    base = tempfile.mkdtemp(prefix="quarry-postings-")
    P.append(chunks, base)
    assert spark.read.parquet(base + "/postings").count() == 2                    # a row a block, not a row a posting
    n, top = P.read_directory(spark, base, 384)
    dense = F.transform(F.sequence(F.lit(0), F.lit(383)), lambda d: F.size(F.filter("terms", lambda x: x == d)))
    asked = q.select("query_id", token_dims("text").alias("terms")).select(
        "query_id", dense.alias("dense"), P.plan(F.col("terms"), n, top, 0.4).alias("plan"))
    bounds = P._bounds(spark, base, asked, 0.4)
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "sum(" not in plan                    # postings and partial sums stay in their task
    found = {(r.query_id, r.pid): r.bound for r in bounds.collect()}
    pid = {r.point_id: r.pid for r in chunks.select("point_id", P.pid_of(F.col("point_id")).alias("pid")).collect()}
    for query, _, score, point in _hits(lexical_retrieve(chunks, q, 400, 0.4)):
        assert found[query, pid[point]] >= score - 1e-12
