"""Hashed lexical vectors (the built-in embedder stand-in).

Tokens are maximal runs of letters/digits of the lower-cased text.  A token goes
to bucket ``int(md5(token)[:8], 16) mod dim``.  The vector of a text is the
count of tokens per bucket; its squared norm is an exact ``BIGINT``.

``method="xxhash64"`` buckets by ``pmod(xxhash64(token), dim)`` instead: about six
times cheaper per token on the JVM (measured 0.9 s vs 6.4 s of hashing for 47M
tokens on 8 cores), but not reproducible in DuckDB, so the registered queries
use md5.

Everything is computed row-locally (no shuffle): a chunk is at most 500
characters, so per-row array work is bounded.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.config import LEXICAL_DIM

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda w: F.length(w) > 0)


def token_bucket(word: Column, dim: int = LEXICAL_DIM, method: str = "md5") -> Column:
    if method == "xxhash64":
        return F.pmod(F.xxhash64(word), F.lit(dim)).cast("int")
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def token_dims(text: Column | str, dim: int = LEXICAL_DIM, method: str = "md5") -> Column:
    """array<int> of token buckets, one entry per token occurrence."""
    return F.transform(tokens(text), lambda w: token_bucket(w, dim, method))


@functools.lru_cache(maxsize=None)
def _counts():
    """Arrow UDF ``array<int> -> (dim, tf, norm2)``: a bag's distinct buckets, sorted once a batch."""

    @F.arrow_udf("struct<dim:array<int>,tf:array<bigint>,norm2:bigint>")
    def count(bags: pa.Array) -> pa.Array:
        sizes = np.where(bags.is_valid().to_numpy(zero_copy_only=False), np.diff(bags.offsets.to_numpy()), 0)
        term = bags.flatten().to_numpy()
        width = int(term.max(initial=0)) + 1
        cell, tf = np.unique(np.repeat(np.arange(len(bags)), sizes) * width + term, return_counts=True)
        row, dim = np.divmod(cell, width)
        ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(bags)))].astype(np.int32)
        squares = np.r_[0, np.cumsum(tf * tf)]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, dim.astype(np.int32)), pa.ListArray.from_arrays(ends, tf.astype(np.int64)),
                                           pa.array(squares[ends[1:]] - squares[ends[:-1]])], names=["dim", "tf", "norm2"])

    return count


def lexical_vectors(df: DataFrame, key: str = "point_id", text: str = "text",
                    dim: int = LEXICAL_DIM, method: str = "md5") -> DataFrame:
    """Sparse vectors ``(key, dim, tf, norm2)``: one row per non-zero bucket."""
    counted = df.select(key, _counts()(token_dims(text, dim, method)).alias("_c"))
    return counted.select(key, F.col("_c.norm2").alias("norm2"), F.explode(F.arrays_zip("_c.dim", "_c.tf")).alias("_e")).select(
        key, F.col("_e.dim").cast("bigint").alias("dim"), F.col("_e.tf").alias("tf"), "norm2")
