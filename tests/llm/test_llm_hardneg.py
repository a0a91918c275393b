"""Hard negatives by one-bit codes against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hardneg as H

DDL = "vec_id long, embedding array<float>, label int"


def ints(v, width):
    out = np.zeros(width, np.int64)
    out[:len(v)] = np.floor(256 * np.array(v, np.float32).astype(np.float64))
    return out


def brute(rows, every=50, positives=5, negatives=3):
    """All result rows by scoring all pairs; ``rows`` are usable."""
    width = max((len(v) for _, v, _ in rows), default=0)
    x = [ints(v, width) for _, v, _ in rows]
    label = [(b + 1) % 10 if i % 7 == 0 else b for i, _, b in rows]
    out = []
    for a, (aid, _, _) in enumerate(rows):
        if aid % every:
            continue
        ranked = sorted((-int(x[a] @ x[c]), rows[c][0], c) for c in range(len(rows)) if c != a)
        for s, pid, _ in [r for r in ranked if label[r[2]] == label[a]][:positives]:
            band = [(-n, nid) for n, nid, c in ranked if label[c] != label[a] and -50 * s <= -100 * n <= -95 * s]
            out += [(aid, pid, k + 1, nid, -s, n) for k, (n, nid) in enumerate(band[:negatives])]
    return sorted(out)


def mined(df, **kw):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 50 == 0, relabel=label, **kw).collect())


@pytest.mark.parametrize("high, dims", [(300, 64), (3, 5), (1, 130)])
def test_intervals_hold(high, dims):
    rng = np.random.default_rng(dims)
    x = rng.integers(-high, high + 1, (400, dims))
    x[7] = 0
    rows = H.Rows.of(np.arange(400), np.zeros(400, np.int64), x)
    a = H.Anchors(np.arange(20), np.arange(20), np.zeros(20, np.int64), x[:20])
    which, those, true = np.arange(20), np.arange(400), x[:20] @ x.T
    est = 0
    for level in range(H.LEVELS):
        part = a.part(which, rows, those, level)
        assert np.allclose(a.pair_part(np.full(400, 3), rows, those, level), part[3])
        est = est + part
        half = a.spread(which[:, None], rows, those[None, :], level)
        assert (np.abs(est - true) <= half).all()
    assert (half <= 0.05 * a.norm[:, None] * rows.norm + 1e-5).all()


def test_few_rows_are_scored_on_embeddings(spark):
    """With the shipped constants, what survives the intervals is a few hundredths of the pairs."""
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.array([ints(v, 64) for v in t.embedding])
    ids, label = t.vec_id.to_numpy(), t.label.to_numpy().astype(np.int64)
    at = np.flatnonzero(ids % 50 == 0)
    rows = H.Rows.of(ids, label, x)
    a = H.Anchors(at, ids[at], label[at], x[at])
    same = a.same_label(rows)
    assert same <= 0.12 * (label[at][:, None] == label[None, :]).sum()      # five of some 200 are asked for
    slot, score, _ = a.best
    bands = np.full((len(at), 5), H.LEAST)
    bands[slot, np.arange(len(slot)) - np.searchsorted(slot, slot)] = score
    b = H.Anchors(at, ids[at], label[at], x[at], bands, H.NEGATIVES)
    assert b.other_labels(rows) <= 0.03 * len(at) * len(x)


def test_against_all_pairs_with_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 6).tolist(), int(rng.integers(0, 4))) for i in range(260)]
    rows += [(300 + i, rows[0][1], 1) for i in range(8)]                      # equal vectors under one label
    rows += [rows[100], rows[100], (50, rows[3][1], 2), (400, [], 1), (450, [1.0, -1.0], 2)]
    bad = [(None, rows[0][1], 1), (500, rows[0][1], None), (550, None, 1), (600, [0.1, None], 1),
           (650, [float("nan")] * 6, 1), (700, [float("-inf")] * 6, 1)]
    df = spark.createDataFrame(rows + bad, DDL).withColumns({c: F.lit("x") for c in ("rid", "score", "rank", "x", "list", "positives")})
    want = brute(rows)
    assert len(want) > 40 and mined(df.repartition(5)) == want


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 16)
    monkeypatch.setattr(H, "ANCHORS", 2)
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist(), int(rng.integers(0, 2))) for i in range(400)]      # many ties
    assert mined(spark.createDataFrame(rows, DDL).repartition(9)) == brute(rows)


def test_edges(spark):
    assert mined(spark.createDataFrame([], DDL)) == []
    assert mined(spark.createDataFrame([(50, [1.0], 3)], DDL)) == []
    apart = [(50, [1.0, 0.0], 3), (51, [-1.0, 0.0], 3), (52, [0.5, 0.5], 4)]
    assert mined(spark.createDataFrame(apart, DDL)) == brute(apart) == []     # a negative positive score has no band
    nought = [(50, [0.0], 3), (51, [1.0], 3), (52, [2.0], 4), (53, [1.0], 4)]
    assert mined(spark.createDataFrame(nought, DDL)) == brute(nought) and len(brute(nought)) == 2
