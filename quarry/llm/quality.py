"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are functions of the whole text alone.  The trees are fitted with logistic
loss on a bounded sample of labelled rows (``TRAIN_ROWS``, chosen by a hash of the id), every
statistic cut into ``BINS`` quantile bins.  Fitted trees are complete binary trees
flattened into arrays, so a batch of texts walks all trees with one numpy step per level.

Defined cases: NULL and empty texts have all-zero statistics and are scored like any other;
a row without an id is scored and not held out; labels that repeat an id count once (the
lowest); without labels every score is 0.5, with one class only it is that class's smoothed
share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_ROWS = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
L2 = 1.0
LEAST_LEAF = 8
HELD_OUT = 1              # remainder of crc32(doc_id) by 3

STATISTICS = ["log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "same_as_before", "upper", "digits",
              "symbols", "odd_symbols", "stops", "breaks", "beyond_ascii", "entropy", "double_lines", "capital_words",
              "bars", "symbol_words"]
_ODD = np.frombuffer(b"#$%&*|~^<>{}[]=+_\\/@", np.uint8)
_ODD_SET = frozenset("#$%&*|~^<>{}[]=+_\\/@")


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    m = max(1, len(words))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    share = hist[hist > 0] / n
    symbols = int(hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum())
    odd = int(hist[_ODD].sum())
    return [np.log1p(n), np.log1p(len(words)), n / m, len(counts) / m, max(counts.values(), default=0) / m,
            sum(map(str.__eq__, words, words[1:])) / m, hist[65:91].sum() / n, hist[48:58].sum() / n, symbols / n, odd / n,
            (hist[46] + hist[33] + hist[63]) / m, hist[10] / m, hist[128:].sum() / n, float(-(share * np.log2(share)).sum()),
            1 - len(set(lines)) / max(1, len(lines)), sum(map(str.isupper, counts)) / max(1, len(counts)), hist[124] / m,
            sum(1 for w in counts if not _ODD_SET.isdisjoint(w)) / max(1, len(counts)) if odd else 0.0]


class Trees:
    """Complete binary trees in arrays: feature and threshold by (tree, node), value by (tree, leaf)."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        if not len(trees):
            return np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        depth = int(np.log2(self.value.shape[1]))
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.value[trees, node - (2 ** depth - 1)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Histogram gradient boosting with second-order leaf values."""
    n, width = len(x), len(STATISTICS) if not len(x) else x.shape[1]
    nodes, leaves = 2 ** depth - 1, 2 ** depth
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    feature = np.zeros((trees, nodes), np.int64)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, leaves))
    margin = np.full(n, base)
    offset = np.arange(width) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first = 2 ** level - 1
            many = 2 ** level
            key = ((node - first)[:, None] * (width * BINS) + offset + bins).ravel()
            shape = (many, width, BINS)
            size = many * width * BINS
            gs = np.bincount(key, np.repeat(g, width), size).reshape(shape).cumsum(2)
            hs = np.bincount(key, np.repeat(h, width), size).reshape(shape).cumsum(2)
            cs = np.bincount(key, minlength=size).reshape(shape).cumsum(2)
            G, H, C = gs[:, :, -1:], hs[:, :, -1:], cs[:, :, -1:]
            gain = gs ** 2 / (hs + L2) + (G - gs) ** 2 / (H - hs + L2) - G ** 2 / (H + L2)
            gain[(cs < LEAST_LEAF) | (C - cs < LEAST_LEAF)] = -1
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[t, first + k] = f
                    threshold[t, first + k] = edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - nodes
        value[t] = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        margin += value[t, leaf]
    return Trees(base, feature, threshold, value)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Fit on about ``rows`` labelled documents outside the held-out third."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    total = known.count()
    part = min(1 << 30, (rows << 30) // max(1, total))
    # the sample's size is bounded by `rows`, so it may be broadcast and its statistics collected
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part)
    found = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(sample), "doc_id")
             .select("doc_id", "y", statistics_of("text").alias("x"))
             .groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).select("doc_id", "r.x", "r.y").toPandas())
    found = found.sort_values("doc_id")
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(STATISTICS))
    return fit(x, (found["y"] > 0).to_numpy(float))


def score_text(model: Trees):
    """A column function: the text's score."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))
            yield pd.Series(model.score(x))
    return scored


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with ``quality_score`` and ``quality_predicted``."""
    scored = docs.withColumn("quality_score", score_text(train(docs, labels, label, rows))(F.col("text")))
    return scored.withColumn("quality_predicted", (F.col("quality_score") >= 0.5).cast("int"))
