"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct five-word shingles.  Each of ``REGISTERS`` hash
functions keeps the least hash of the set, truncated to an exponential scale with base
``BASE`` (a SetSketch register: registers of a union are the larger of each pair, and the
share of equal registers follows the similarity).  Documents that agree in all registers
of a band become candidates; a candidate pair's similarity is estimated by maximum
likelihood from the numbers of larger, smaller and equal registers and both set sizes; what
can reach the threshold is verified on the full sets.

Only links that can join components are looked for, so no group is paired off:

* Texts with the same words are one class from the start.
* Every class is held against the least class of each of its band buckets (its hub).
* A bucket is open while its other members lie in several components.  Open buckets
  that share members form a blob; its centre is the member with the most company.  Each
  member x is kept as its difference from the centre, D(x).  Differences compare as sets do:
  x and y differ in D(x) and D(y) taken together less what both hold, so x and y are
  linked if and only if 7 |D(x) ^ D(y)| <= |x| + |y|.
* Members linked to the centre, or in a component that is, form one component.  Any further
  link has a member x outside it, with D(x) larger than (|x| + |centre|) / 7; it must share
  more than half of D(y) with y, hence one of the rarest D elements of each (a prefix filter on
  the differences).  Elements that only one component holds can link nothing and come first
  in every difference, so neither copies made by own edits nor a second family with words of
  its own meet each other; what the filter lets through is verified on the differences, exactly.

Defined cases: a document without words (NULL, empty, blank) has no shingles, no links and
is its own component; fewer words than a shingle make one shingle; texts of any length are
read whole; rows that repeat an id are told apart by their words; a row without an id can
link others but names no component (its ``component_id`` is NULL if no row of its component
has an id, and then its ``kept`` is true: id and component_id are equally missing); an empty
table gives an empty result; further columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import materialise
from quarry.llm.components import components

SHINGLE = 5
THRESHOLD = 75            # percent
REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
BASE, RATE, TOP = 1.02, 20.0, 2000
LIKELY = 0.75 - 4 * 0.038  # four standard errors of the estimate below the threshold
BROADCAST_ROWS = 500_000   # 16-byte keys: some tens of MB
SKETCH = "doc_id bigint, node binary, n_shingles bigint, registers binary"

_rng = np.random.Generator(np.random.PCG64(20240501))
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HASH = _rng.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_list(text: str | None) -> list[bytes]:
    # bytes.lower() and bytes.split() know ASCII letters and white space only
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    import xxhash
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b"\0".join(words), seed=len(words))], np.uint64)
    w = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    n = len(w) - size + 1
    s = w[:n] * _PLACE[0]
    for i in range(1, size):
        s += w[i:n + i] * _PLACE[i]
    s ^= s >> np.uint64(31)
    s *= _MIX
    s ^= s >> np.uint64(29)
    return np.unique(s)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        np.minimum(least, (_HASH[:, None] * s[None, i:i + 2048]).min(1), out=least)
    h = -np.log1p(-np.minimum((least.astype(float) + 0.5) / 2.0 ** 64, 1 - 1e-15)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def estimate(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from both sizes and the order of the registers."""
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
        return (more * np.log(up + 1e-12) + less * np.log(down + 1e-12)
                + same * np.log(np.maximum(1 - up - down, 0) + 1e-12))

    lo, hi = np.zeros(len(na)), np.minimum(u / v, v / u)
    for _ in range(40):
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = likelihood(x) > likelihood(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def sketch(docs: DataFrame) -> DataFrame:
    """Digest of the words, set size and registers of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, regs = [], [], []
            for text in batch.column(1).to_pylist():
                words = word_list(text)
                s = shingles(words)
                node.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                size.append(len(s))
                regs.append(registers(s).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                                              pa.array(regs, pa.binary())], ["doc_id", "node", "n_shingles", "registers"])
    return _texts(docs).mapInArrow(run, SKETCH)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


@F.pandas_udf(T.DoubleType())
def likely_similarity(na: pd.Series, nb: pd.Series, ra: pd.Series, rb: pd.Series) -> pd.Series:
    if not len(na):
        return pd.Series([], dtype=float)
    both = [np.frombuffer(b"".join(r), "<u2").reshape(-1, REGISTERS) for r in (ra, rb)]
    return pd.Series(estimate(na.to_numpy(float), nb.to_numpy(float), *both))


@F.pandas_udf(T.BooleanType())
def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    last, known = None, None
    for texts in batches:
        out = []
        for a, b in zip(*texts):
            if a != last:
                last, known = a, shingles(word_list(a))
            other = shingles(word_list(b))
            shared = len(np.intersect1d(known, other, assume_unique=True))
            out.append(100 * shared >= THRESHOLD * (len(known) + len(other) - shared))
        yield pd.Series(out, dtype=bool)


def class_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for each class in ``nodes`` (node, first_id)."""
    node_of = F.pandas_udf(words_digest, "binary")
    side = nodes.select("node", F.col("first_id"))
    side = F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
    found = _texts(docs).join(side, F.col("doc_id").eqNullSafe(F.col("first_id")))
    return found.filter(node_of("text") == F.col("node")).groupBy("node").agg(F.min("text").alias("text"))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    info = classes.select("node", "n", "registers")
    sized = pairs
    for x in ("a", "b"):
        sized = sized.join(info.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")), x)
    sized = sized.filter(100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
    sized = materialise(sized.filter(likely_similarity("n_a", "n_b", "r_a", "r_b") >= LIKELY).select("a", "b"), "likely")
    full = sized
    for x in ("b", "a"):
        full = full.join(texts.select(F.col("node").alias(x), F.col("text").alias(f"t_{x}")), x)
    return full.filter(linked("t_a", "t_b")).select("a", "b")


def open_members(others: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (hubs left out: they met all others) of the buckets that hold several components."""
    labelled = others.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = (labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"),
                                            F.min("node").alias("head")).filter("x <> y").drop("x", "y"))
    return labelled.join(mixed, "bucket")


@F.pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("nc", T.LongType()),
                            T.StructField("d", T.ArrayType(T.LongType()))]))
def difference(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Set sizes of a text and its centre's, and the shingles that only one of them has."""
    last, centre = None, None
    for texts in batches:
        out = []
        for t, c in zip(*texts):
            if c != last:
                last, centre = c, shingles(word_list(c))
            own = shingles(word_list(t))
            out.append((len(own), len(centre), np.setxor1d(own, centre, assume_unique=True).view(np.int64)))
        yield pd.DataFrame(out, columns=["n", "nc", "d"])


def mixed_tokens(tokens: DataFrame) -> DataFrame:
    """Elements of differences that members of several components hold, with the number of members."""
    own = F.xxhash64("component")                       # as numbers, for hash aggregation; NULL is the centre's component
    return (tokens.groupBy("blob", "token").agg(F.count("*").alias("df"), F.min(own).alias("x"), F.max(own).alias("y"))
            .filter("x <> y").drop("x", "y"))


def meetings(probe: DataFrame, index: DataFrame) -> DataFrame:
    """Members that hold an element of the other's prefix."""
    return probe.join(index, ["blob", "token"])


def further_links(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that, with those found so far, join all members of open buckets that belong together."""
    blobs = components(open_, "head", "node").withColumnRenamed("component", "blob")
    company = open_.groupBy("node", "component").agg(F.sum("size").alias("company")).join(blobs, "node")
    company = materialise(company, "blobs")
    centres = company.groupBy("blob").agg(F.max(F.struct("company", "node")).alias("c")).select("blob", F.col("c.node").alias("centre"))
    centres = centres.join(texts.withColumnsRenamed({"node": "centre", "text": "centre_text"}), "centre")
    rows = (company.join(texts, "node").join(centres, "blob")
            .select("blob", "node", "centre", "component", difference("text", "centre_text").alias("v"))
            .select("blob", "node", "centre", "component", "v.n", "v.nc", "v.d", F.size("v.d").alias("w")))
    rows = materialise(rows, "differences")
    to_centre = rows.filter("7 * w <= n + nc and node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    near = rows.groupBy("blob", "component").agg(F.max(F.expr("7 * w <= n + nc")).alias("near"))
    some = near.groupBy("blob").agg(F.min("near").alias("all")).filter(~F.col("all")).select("blob")
    left = (rows.join(near, ["blob", "component"]).join(some, "blob").withColumn("outside", ~F.col("near"))
            .withColumn("component", F.when(F.col("outside"), F.col("component"))))     # NULL: the centre's component

    tokens = left.select("blob", "node", "component", F.explode("d").alias("token"))
    common = mixed_tokens(tokens)
    rare_first = tokens.drop("component").join(common, ["blob", "token"]).groupBy("blob", "node").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("df", "token"))), lambda x: x["token"]).alias("t"))
    # elements that no other component has come first and match nothing; `own` of a prefix are those
    info = (left.drop("d", "centre", "near").join(rare_first, ["blob", "node"]).withColumn("shared", F.size("t"))
            .withColumn("own", F.col("w") - F.col("shared"))
            .withColumn("index", F.expr("w - greatest(0, floor((7 * w + nc - n) / 14)) - own"))
            .withColumn("probe", F.expr("w - greatest(1, ceil((3 * w - n) / 3)) + 1 - own")))
    info = materialise(info, "prefixes")
    what = ("node", "component", "n", "w", "shared")

    def side(length, names):
        cut = info.select("blob", *[F.col(c).alias(names + c) for c in what], "outside",
                          F.explode(F.slice("t", 1, F.greatest(F.col(length), F.lit(0)).cast("int"))).alias("token"))
        return cut

    probe = side("probe", "x_").filter("outside").drop("outside")
    index = side("index", "y_").drop("outside")
    met = meetings(probe, index).filter(
        "x_node <> y_node and not (x_component <=> y_component) and 100 * least(x_n, y_n) >= 75 * greatest(x_n, y_n) "
        "and 7 * (x_w + y_w) - (x_n + y_n) <= 14 * least(x_shared, y_shared)")
    pairs = met.select("blob", F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    for x in ("a", "b"):
        pairs = pairs.join(rows.select("blob", F.col("node").alias(x), F.col("d").alias(f"d_{x}"), F.col("n").alias(f"n_{x}")), ["blob", x])
    both = F.size(F.array_intersect("d_a", "d_b"))
    found = pairs.filter(7 * (F.size("d_a") + F.size("d_b") - 2 * both) <= F.col("n_a") + F.col("n_b")).select("a", "b")
    return to_centre.union(found)


def near_duplicates(docs: DataFrame, detail: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept; with ``detail`` also
    ``node`` (the digest of its words, NULL without words) and ``component`` (the least node of its
    component), which tell rows apart that share or lack an id."""
    rows = materialise(sketch(docs), "sketches")
    classes = materialise(rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.min("n_shingles").alias("n"),
        F.min("registers").alias("registers")), "classes")
    bands = classes.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * (2 * ROWS) + 1, F.lit(2 * ROWS))))).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("c")).filter("c > 1").drop("c")
    members = materialise(bands.join(shared, "bucket"), "members")

    others = members.filter("node <> hub")
    pairs = materialise(others.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    labels = None
    if not pairs.isEmpty():
        nodes = members.select("node").distinct().join(classes.select("node", "first_id"), "node")
        texts = materialise(class_texts(docs, nodes), "texts")
        links = materialise(verified(pairs, classes, texts), "linked")
        labels = components(links)
        open_ = materialise(open_members(others, labels), "open")
        if not open_.isEmpty():
            more = materialise(further_links(open_, texts), "further")
            if not more.isEmpty():
                labels = components(links.union(more))

    named = classes.select("node", "first_id", "copies")
    if labels is None:
        named = named.withColumn("least_id", F.col("first_id")).withColumn("component", F.lit(None).cast("binary"))
    else:
        least = (labels.join(named, "node").groupBy("component").agg(F.min("first_id").alias("least_id")))
        named = (named.join(labels, "node", "left").join(least, "component", "left")
                 .withColumn("least_id", F.coalesce("least_id", "first_id")))
    # classes of one row outside any component need no look-up
    named = named.filter((F.col("copies") > 1) | F.col("component").isNotNull()).select("node", "least_id", "component")
    return (rows.select("doc_id", "node", "n_shingles").join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id"),
                    *([F.col("node"), F.coalesce("component", "node").alias("component")] if detail else []))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def words_digest(texts: pd.Series) -> pd.Series:
    """The ``node`` of texts."""
    return pd.Series([hashlib.blake2b(b" ".join(w), digest_size=16).digest() if (w := word_list(t)) else None for t in texts],
                     dtype=object)
