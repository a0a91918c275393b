"""Retrieval: normalise -> embed -> similarity top-k -> hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import LEXICAL_DIM, SCORE_THRESHOLD, TOP_K
from quarry.operators.lexical import token_dims
from quarry.operators.similarity import Encoding, topk
from quarry.sources.queries import normalise_queries

HIT_PAYLOAD = ["source_file", "page_number", "chunk_index", "text"]


def lexical_retrieve(chunks: DataFrame, queries: DataFrame, k: int = TOP_K,
                     threshold: float = SCORE_THRESHOLD, dim: int = LEXICAL_DIM,
                     method: str = "md5", decimals: int | None = None) -> DataFrame:
    """Hits ``(query_id, rank, score, point_id, source_file, page_number, chunk_index, text)``.

    The query text is embedded with the same function as the chunks (symmetric).  A stored
    collection brings its ``terms``, hashed at ingest; only bare chunks are tokenised here.
    """
    q = normalise_queries(queries).select("query_id", token_dims("text", dim, method).alias("vector"))
    terms = F.col("terms") if "terms" in chunks.columns else token_dims("text", dim, method)
    pts = chunks.select("point_id", *HIT_PAYLOAD, terms.alias("vector"))
    hits = topk(pts, q, encoding=Encoding("bag", dim), k=k, threshold=threshold,
                point_key="point_id", payload=HIT_PAYLOAD, decimals=decimals)
    return hits.withColumn("text", F.coalesce(F.col("text"), F.lit("")))


def dense_retrieve(points: DataFrame, queries: DataFrame, dim: int, k: int = TOP_K,
                   threshold: float = SCORE_THRESHOLD, point_key: str = "point_id",
                   payload: list[str] | None = None, exclude_self: bool = False,
                   decimals: int | None = None) -> DataFrame:
    """Cosine top-k over dense ``vector`` columns (points and queries)."""
    return topk(points, queries, encoding=Encoding("dense", dim), k=k, threshold=threshold,
                point_key=point_key, payload=payload, exclude_self=exclude_self, decimals=decimals)
