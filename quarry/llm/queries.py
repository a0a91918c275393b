"""The registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import sql as S
from quarry.llm.bpe import decode_documents, encode_documents
from quarry.llm.common import bound_batches, table
from quarry.llm.decontaminate import decontaminate
from quarry.llm.hardneg import hard_negatives
from quarry.llm.html_text import extract_text
from quarry.llm.neardup import near_duplicates
from quarry.llm.packing import pack_documents
from quarry.llm.quality import classify, held_out
from quarry.llm.records import read_digests, write_records
from quarry.llm.sharding import shard_documents
from quarry.llm.substring import substring_dedup
from quarry.llm.topk import top_k
from quarry.llm.urls import filter_urls
from quarry.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark, sf_dir):
            bound_batches(spark)
            return fn(spark, sf_dir)
        query.__name__, query.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_url_filter")
def op1_url_filter(spark, d):
    """A verdict for the URL of every page."""
    return filter_urls(table(spark, d, "pages"))


@register("op2_quality")
def op2_quality(spark, d):
    """A quality score for every document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return classify(docs, table(spark, d, "labels")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        F.col("quality_predicted").alias("predicted"))


@register("op3_topk", S.TOP_K)
def op3_topk(spark, d):
    """The five best other vectors for every fiftieth."""
    return top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@register("op4_packing")
def op4_packing(spark, d):
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, d, "documents"))


@register("op5_sharding")
def op5_sharding(spark, d):
    """All documents on a bounded-load ring of 16 shards."""
    return shard_documents(table(spark, d, "documents"))


@register("op6_near_duplicates", S.NEAR_DUPLICATES)
def op6_near_duplicates(spark, d):
    """The near-duplicate component of every document."""
    return near_duplicates(table(spark, d, "documents"))


@register("op7_substring_dedup")
def op7_substring_dedup(spark, d):
    """Every document without the passages that an earlier one holds."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    removed = F.coalesce(F.aggregate("removed_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]), F.lit(0))
    return substring_dedup(docs).select("doc_id", removed.alias("n_removed"), "removed_spans",
                                        F.col("deduped_text").alias("text"))


@register("op8_html_text")
def op8_html_text(spark, d):
    """The visible text of every page."""
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", F.length("text").cast("bigint").alias("n_chars"), "text")


@register("op9_token_records")
def op9_token_records(spark, d):
    """All documents written as token records and read back from the files."""
    return read_digests(write_records(table(spark, d, "documents")))


@register("op10_decontaminate", S.DECONTAMINATE)
def op10_decontaminate(spark, d):
    """Every document against every benchmark window."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, d, "benchmark")).select(
        "doc_id", *[F.col(f"contamination.{c}").alias(c)
                    for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


@register("op11_hard_negatives", S.HARD_NEGATIVES)
def op11_hard_negatives(spark, d):
    """Up to three hard negatives for each positive of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, relabel=label)


@register("op12_bpe")
def op12_bpe(spark, d):
    """The token ids of every document, and the text they decode to."""
    coded = decode_documents(encode_documents(table(spark, d, "documents").select("doc_id", "text")))
    ids = F.col("token_ids")
    return coded.select("doc_id", (F.length(ids) / 4).cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"))


@register("op13_whitening")
def op13_whitening(spark, d):
    """Every vector on the first four whitened components."""
    white = whiten(table(spark, d, "embeddings"), components=4)
    cells = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "cell")
    return white.select("vec_id", "n", "deviation", "identity_error", cells).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("cell.whitened").alias("whitened"),
        F.col("cell.explained").alias("explained"), "identity_error")
