"""Deterministic ids.

Point id: the first 16 hex digits of SHA-256 over the UTF-8 key
``{source_file}_{page_number or ''}_{chunk_index}``, read as an unsigned 64-bit
integer and kept as ``DECIMAL(20,0)`` (half the ids exceed ``2^63-1``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_key(source_file: Column | str, page_number: Column | str, chunk_index: Column | str) -> Column:
    sf = F.col(source_file) if isinstance(source_file, str) else source_file
    pg = F.col(page_number) if isinstance(page_number, str) else page_number
    ix = F.col(chunk_index) if isinstance(chunk_index, str) else chunk_index
    return F.concat(sf, F.lit("_"), F.coalesce(pg.cast("string"), F.lit("")), F.lit("_"), ix.cast("string"))


def hash_u64(key: Column) -> Column:
    """uint64 from the first 16 hex digits of sha256(key), as DECIMAL(20,0)."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def point_id(source_file="source_file", page_number="page_number", chunk_index="chunk_index") -> Column:
    return hash_u64(point_key(source_file, page_number, chunk_index))


def bucket_of(col: Column | str, buckets: int) -> Column:
    """Stable hash bucket used to lay out index snapshots and ledger shards."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
