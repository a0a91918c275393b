"""User-facing entry points: ingest folders into a state folder, ask questions in batch.

    from quarry.api import ingest_folders, ask
    ingest_folders(spark, pdf_dir, txt_dir, state)          # one incremental scan
    ask(spark, state, ["What is AI?"]).show()                 # prompts with ranked context

Questions may be a list of strings or a DataFrame ``(query_id, text)``; the
answers are a prompts table ``(query_id, system, prompt, n_hits)`` (plus the
question text) for any offline model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import scan as S
from quarry.operators.prompts import build_prompts
from quarry.operators.search import HIT_PAYLOAD, dense_retrieve, lexical_retrieve
from quarry.sources.queries import normalise_queries


def ingest_folders(spark: SparkSession, pdf_dir: str | None, txt_dir: str | None, state: str,
                   loaders: dict | None = None, embed=None) -> dict[str, DataFrame]:
    folders = {}
    if pdf_dir:
        folders[".pdf"] = pdf_dir
    if txt_dir:
        folders[".txt"] = txt_dir
    return S.run_scan(spark, folders, state, loaders=loaders, embed=embed)


def _questions(spark: SparkSession, questions) -> DataFrame:
    if isinstance(questions, DataFrame):
        return questions.select(F.col("query_id").cast("bigint"), F.col("text"))
    return spark.createDataFrame([(i, q) for i, q in enumerate(questions)], C.QUERIES)


def _hits(spark: SparkSession, state: str, q: DataFrame, k: int, threshold: float, embed) -> DataFrame:
    index = S.read_state_index(spark, state)
    if embed is None:
        return lexical_retrieve(index, q, k=k, threshold=threshold)
    # dense: the questions go through the same embedder the collection was built with
    qv = embed(q).select("query_id", "vector")
    dim = qv.select(F.size("vector").alias("d")).first()
    if dim is None:
        return lexical_retrieve(index, q.limit(0), k=k, threshold=threshold)
    pts = index.filter(F.col("vector").isNotNull())
    return dense_retrieve(pts, qv, int(dim.d), k=k, threshold=threshold, payload=HIT_PAYLOAD)


def retrieve(spark: SparkSession, state: str, questions, k: int = C.TOP_K,
             threshold: float = C.SCORE_THRESHOLD, embed=None) -> DataFrame:
    """Ranked hits for every question against the current collection.

    ``embed`` (``DataFrame -> DataFrame`` adding ``vector``) selects dense retrieval;
    without it the lexical terms stored at ingest are compared.
    """
    q = normalise_queries(_questions(spark, questions))
    return _hits(spark, state, q, k, threshold, embed)


def ask(spark: SparkSession, state: str, questions, k: int = C.TOP_K,
        threshold: float = C.SCORE_THRESHOLD, embed=None) -> DataFrame:
    """Prompt rows for every question (fallback prompt when nothing scores >= threshold)."""
    q = normalise_queries(_questions(spark, questions))
    hits = _hits(spark, state, q, k, threshold, embed)
    return build_prompts(q, hits).join(q.withColumnRenamed("text", "question"), "query_id")


def clear(spark: SparkSession, state: str) -> None:
    S.clear_all(spark, state)
