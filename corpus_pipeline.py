"""The corpus pipeline: documents to packed training sequences in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.

1. ``quality``: documents that the classifier (fitted on ``labels``) rejects go.
2. ``near_duplicates``: of each group of near copies one row stays, that with the least id.
3. ``substrings``: passages that an earlier document holds are cut; ``n_chars`` follows the
   text, and documents of which nothing is left go.
4. ``decontamination``: documents that hold benchmark passages go.
5. ``packing``: the pieces of what is left, in sequences of 2048 tokens.

Defined cases: of near copies that share a doc_id, or all lack one, the row with the least
digest of its words stays, of rows with equal words the one with the least text, lang,
source and n_chars; a row without a doc_id comes after those with one.  NULL and empty
texts are judged by the classifier like any other and are no duplicates; an empty table
passes through all stages.  Columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bound_batches, materialise, table
from quarry.llm.decontaminate import decontaminate
from quarry.llm.neardup import near_duplicates, words_digest
from quarry.llm.packing import pack_documents
from quarry.llm.quality import score_text, train
from quarry.llm.substring import substring_dedup
from quarry.session import ensure_checkpoint_dir, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BROADCAST_ROWS = 1_000_000    # ids of 8 bytes

ORACLE_SQL = None             # SQL expresses neither the classifier nor the chunking; see tests/llm


def _docs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    bound_batches(spark)
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _docs(spark, docs)
    score = score_text(train(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score(F.col("text")) >= 0.5)


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _same_id(other: str):
    return F.col("doc_id").cast("bigint").eqNullSafe(F.col(other))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _docs(spark, docs)
    rows = materialise(near_duplicates(docs, detail=True), "copies")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    best = rows.filter(F.col("node").isNotNull()).groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("size"))
    groups = best.filter("size > 1").select("component", F.col("best.doc_id").alias("keep_id"), F.col("best.node").alias("keep_node"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("node") == F.col("keep_node"))
    # ids of one row are decided by the id; rows that share or lack an id by id and words
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("rows"))
    shared = materialise(ids.filter("rows > 1 or doc_id is null").select(F.col("doc_id").alias("gone")), "shared_ids")
    gone = rows.join(groups, "component").filter(~stays).select(F.col("doc_id").alias("gone")).distinct()
    gone = materialise(gone.union(shared).distinct(), "gone")
    single = docs.join(_small(gone), _same_id("gone"), "left_anti")
    if shared.isEmpty():
        return single
    # not deterministic: else Spark copies the digest into the filters below and runs it twice, by two Python workers a task
    digest = F.pandas_udf(words_digest, "binary").asNondeterministic()
    digested = docs.join(_small(shared), _same_id("gone"), "left_semi").withColumn("node", digest("text"))
    wordless = digested.filter("node is null").select(*COLUMNS)
    # of rows with the same id and words one is taken, by a grouping that combines first
    one = digested.filter("node is not null").groupBy("doc_id", "node").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("r"))
    copies = rows.join(groups, "component").filter(~stays).select(F.col("doc_id").alias("gone"), F.col("node").alias("gone_node")).distinct()
    one = one.join(copies, _same_id("gone") & (F.col("node") == F.col("gone_node")), "left_anti")
    return single.union(wordless).union(one.select("doc_id", "r.text", "r.lang", "r.source", "r.n_chars").select(*COLUMNS))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _docs(spark, docs)
    cut = F.col("removed_spans").isNotNull()
    kept = substring_dedup(docs).filter(~cut | (F.length(F.trim("deduped_text")) > 0))
    return kept.select("doc_id", F.col("deduped_text").alias("text"), "lang", "source",
                       F.when(cut, F.length("deduped_text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _docs(spark, docs)
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contamination.contaminated")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(_docs(spark, docs))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates_stage), ("substrings", substrings),
          ("decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``; each result but the last is a stored table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
