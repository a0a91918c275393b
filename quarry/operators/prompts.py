"""Hits -> ranked context -> one prompt row per query.

The per-query group is at most ``k`` hits, so the ordered concatenation is a
bounded ``collect_list``; queries without hits get the fallback prompt through a
left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import config as C


def context_line(source="source_file", page="page_number", text="text"):
    src = F.coalesce(F.col(source), F.lit(C.SOURCE_UNKNOWN))
    pg = F.when(F.col(page).isNotNull(), F.concat(F.lit(", Page: "), F.col(page).cast("string"))).otherwise(F.lit(""))
    return F.concat(F.lit("Source: "), src, pg, F.lit("\nContent: "), F.coalesce(F.col(text), F.lit("")))


def contexts(hits: DataFrame) -> DataFrame:
    """``(query_id, context, n_hits)``: hit contexts joined by a blank line in rank order."""
    per_hit = hits.select("query_id", F.struct(F.col("rank"), context_line().alias("ctx")).alias("h"))
    return per_hit.groupBy("query_id").agg(
        F.concat_ws("\n\n", F.transform(F.array_sort(F.collect_list("h")), lambda x: x["ctx"])).alias("context"),
        F.count(F.lit(1)).alias("n_hits"))


def build_prompts(queries: DataFrame, hits: DataFrame, query_text: str = "text",
                  no_hit: str = "answer") -> DataFrame:
    """``(query_id, system, prompt, n_hits)``, one row per query.

    Queries without hits get the question-loop fallback (``no_hit="answer"``) or the
    prompt builder's own zero-context text (``no_hit="context"``).
    """
    agg = contexts(hits)
    q = queries.select("query_id", F.col(query_text).alias("_q"))
    joined = q.join(agg, "query_id", "left")
    n = F.coalesce(F.col("n_hits"), F.lit(0)).cast("bigint")
    with_ctx = F.concat(F.lit(C.PROMPT_HEAD), F.col("context"), F.lit(C.PROMPT_QUERY), F.col("_q"), F.lit(C.PROMPT_TAIL))
    if no_hit == "context":
        head, tail = C.EMPTY_CONTEXT_PROMPT.split("{}")
        fallback = F.concat(F.lit(head), F.col("_q"), F.lit(tail))
    else:
        fallback = F.concat(F.lit(C.NO_HIT_PROMPT_HEAD), F.col("_q"), F.lit(C.NO_HIT_PROMPT_TAIL))
    return joined.select(
        "query_id",
        F.lit(C.SYSTEM_MESSAGE).alias("system"),
        F.when(n > 0, with_ctx).otherwise(fallback).alias("prompt"),
        n.alias("n_hits"))


def write_prompts(prompts: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Prompt table sink for an offline model (Parquet or JSON lines), one folder per run."""
    prompts.write.mode("errorifexists").format(fmt).save(path)
