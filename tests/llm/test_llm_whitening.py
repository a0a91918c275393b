"""Whitening against numpy on the distinct vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W
from quarry.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>"


def ints(v, scale=256):
    return np.floor(scale * np.array(v, np.float32).astype(np.float64)).astype(np.int64) + 0


def brute(rows, components=4, weighted=False):
    """{row number: (deviation, whitened up to sign, explained)} and n."""
    x = np.array([ints(v) for _, v in rows])
    fit, counts = np.unique(x, axis=0, return_counts=True)
    w = counts if weighted else np.ones(len(fit), np.int64)
    n, s = int(w.sum()), (fit * w[:, None]).sum(0)
    c = fit - s / n
    cov = (c * w[:, None]).T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    white = (x - s / n) @ u[:, :components] / np.sqrt(e[:components])
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, white, e[:components] / np.trace(cov)


@pytest.mark.parametrize("weighted", [False, True])
def test_against_numpy_with_copies(spark, weighted):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.3, (300, 6)) * [3, 2, 1.5, 1, 0.6, 0.3]
    rows = [(i, base[i].tolist()) for i in range(300)]
    rows += [(1000 + i, base[7].tolist()) for i in range(200)] + [(7, base[7].tolist()), (None, base[9].tolist())]
    rows += [(2000, (base[8] + 1e-6).tolist())]                         # equal only as integers, where no border lies between
    bad = [(3000, None), (3001, [0.1, None] + [0.0] * 4), (3002, [float("nan")] * 6), (3003, [float("inf")] * 6)]
    df = spark.createDataFrame(rows + bad, DDL).withColumns({c: F.lit("x") for c in ("n", "x", "h", "copies", "whitened", "key")})
    n, dev, white, explained = brute(rows, weighted=weighted)
    got = sorted(W.whiten(df, weighted=weighted).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    assert len(got) == len(rows) and {r.n for r in got} == {n}
    assert [r.deviation for r in got] == [dev[i] for i in order]
    have, want = np.array([r.whitened for r in got]), white[order]
    sign = np.sign((have * want).sum(0))
    assert np.abs(have * sign - want).max() < 1e-9
    assert np.allclose(got[0].explained, explained, rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_edges(spark):
    empty = spark.createDataFrame([], DDL)
    assert W.whiten(empty).count() == 0
    one = W.whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 3, DDL)).collect()
    assert len(one) == 3 and one[0].whitened == [None, None] and one[0].deviation == 0 and one[0].identity_error is None
    assert one[0].explained == [None, None]
    flat = W.whiten(spark.createDataFrame([(i, [float(i), 1.0, 0.0]) for i in range(9)], DDL)).collect()
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in flat)
    short = W.whiten(spark.createDataFrame([(1, []), (2, [1.0]), (3, [1.0, 2.0]), (4, [0.0, 0.0, 0.0])], DDL)).collect()
    assert {r.vec_id for r in short} == {1, 2, 3, 4} and {r.n for r in short} == {4} and len(short[0].whitened) == 3


def test_exact_sums_and_deviation_of_great_values(spark):
    big = float(2 ** 45)
    rows = [(i, [big + 2 ** 30 * i, -big]) for i in range(5)]
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in out) and out[2].n == 5
    small = [(i, [1e5 * i, 3.0]) for i in range(5)]
    n, dev, _, _ = brute(small)
    got = {r.vec_id: r.deviation for r in W.whiten(spark.createDataFrame(small, DDL)).collect()}
    assert [got[i] for i in range(5)] == dev
    vec = spark.createDataFrame([([2 ** 62, -2 ** 62], 3), ([2 ** 62 - 1, 5], 1)], "x array<bigint>, copies long")
    assert W.exact_sums(vec, 2, True) == (4, [3 * 2 ** 62 + 2 ** 62 - 1, -3 * 2 ** 62 + 5])
    assert W.exact_sums(vec, 2, False) == (2, [2 ** 63 - 1, 5 - 2 ** 62])


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(d + "/embeddings.parquet").collect()]
    n, dev, white, explained = brute(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    got = QUERIES["op13_whitening"](spark, d).collect()
    assert len(got) == 4 * len(rows) and {r.component for r in got} == {1, 2, 3, 4}
    for c in range(4):
        mine = [r for r in got if r.component == c + 1]
        have, want = np.array([r.whitened for r in mine]), np.array([white[at[r.vec_id], c] for r in mine])
        assert np.abs(have * np.sign(have @ want) - want).max() < 1e-9
        assert all(r.deviation == dev[at[r.vec_id]] and r.n == n and abs(r.explained / explained[c] - 1) < 1e-9 for r in mine)
