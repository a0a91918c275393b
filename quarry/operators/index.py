"""The point collection as a table: keyed upsert, delete, per-file replace, stats
(persistent storage lives in ``operators.bucketed``).

All mutations are anti-joins plus unions.  The changed side (new points, deleted
files) is normally much smaller than the index; Spark's planner broadcasts it only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-plans at runtime), otherwise both sides are shuffled on the key.  Nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import last_per_key


def check_dim(points: DataFrame, dim: int, vec: str = "vector") -> DataFrame:
    """Fail the write when a vector has the wrong width (collection contract)."""
    bad = F.size(F.col(vec)) != F.lit(dim)
    return points.withColumn(
        vec, F.when(bad, F.raise_error(F.lit(f"vector width differs from {dim}"))).otherwise(F.col(vec)))


def _last(new: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key.  What ``order`` leaves open is decided by the rows' own values, so a retried task picks alike."""
    ordered = [f.name for f in new.schema.fields if "map<" not in f.dataType.simpleString()]      # maps have no order
    return last_per_key(new, [key], [*(order or []), *[c for c in ordered if c != key and c not in (order or [])]])


def upsert(index: DataFrame, new: DataFrame, key: str = "point_id", order: list[str] | None = None) -> DataFrame:
    """Insert or overwrite by ``key``; within ``new`` the last row by ``order`` (and then by all its columns) wins."""
    fresh = _last(new, key, order)
    kept = index.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True).select(*index.columns)


def delete_by_file(index: DataFrame, files: DataFrame, col: str = "source_file") -> DataFrame:
    """Remove every point whose ``col`` equals one of ``files[col]`` (many files in one pass)."""
    return index.join(files.select(col).distinct(), col, "left_anti")


def replace_files(index: DataFrame, new: DataFrame, col: str = "source_file", key: str = "point_id") -> DataFrame:
    """Per-file replace: old points of every touched file go, the new ones come in.

    A file that produced fewer chunks this time leaves no surplus points behind.
    """
    touched = new.select(col).distinct()
    kept = index.join(touched, col, "left_anti")
    return kept.unionByName(_last(new, key), allowMissingColumns=True).select(*index.columns)


def filter_by_file(index: DataFrame, name: str, col: str = "source_file") -> DataFrame:
    return index.filter(F.col(col) == F.lit(name))


def collection_stats(index: DataFrame, vec: str | None = "vector", length: str | None = None) -> DataFrame:
    """``(n_points, n_files[, min_dim, max_dim][, min_length, max_length])`` in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_points"), F.count_distinct("source_file").alias("n_files")]
    if length:
        aggs += [F.min(length).cast("bigint").alias("min_length"),
                 F.max(length).cast("bigint").alias("max_length")]
    if vec:
        aggs += [F.min(F.size(vec)).cast("bigint").alias("min_dim"),
                 F.max(F.size(vec)).cast("bigint").alias("max_dim")]
    return index.agg(*aggs)


def payload(chunks: DataFrame) -> DataFrame:
    """Payload = metadata + text, also as a JSON string."""
    meta = F.struct("source_file", "file_type", "page_number", "chunk_index", "chunk_id", "text_length", "text")
    return chunks.select("point_id", meta.alias("payload"), F.to_json(meta).alias("payload_json"))
