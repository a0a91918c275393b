"""Structured Streaming forms of the two loops.

* ``stream_ledger`` (repeated scan): a stream of file-status events is folded
  into the bucketed ledger table in ``foreachBatch`` (last write per path wins;
  only the touched buckets are rewritten; a replayed batch gives the same result).
* ``stream_files`` (re-scan as a service): a stream of file versions, from a landing zone or
  from ``sources.changed_files``, is deduplicated, chunked and folded into index and ledger.
* ``stream_answers`` (question loop): a stream of questions joined, per
  micro-batch, against the static chunk collection (stream-static similarity
  join through the block scorer), producing prompt rows appended to a sink.

The built-in file source only suits append-only landing zones (an overwritten path is not
re-delivered); ``sources.changed_files`` sees overwritten files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import LEDGER, POINTS, STATUS_SKIPPED_EMPTY, STATUS_SKIPPED_NO_CHUNKS
from quarry.functions.text import basename
from quarry.operators import ledger as L
from quarry.operators import bucketed as BT
from quarry.operators.common import last_per_key
from quarry.operators.prompts import build_prompts
from quarry.operators.search import lexical_retrieve
from quarry.session import scratch_dir
from quarry.sources.queries import normalise_queries


def stream_ledger(spark: SparkSession, source: DataFrame, to_rows: Callable[[DataFrame], DataFrame],
                  ledger_base: str, checkpoint: str, buckets: int = 64) -> None:
    """Run ``source`` (a streaming DataFrame) to completion with ``availableNow``.

    Each micro-batch reads only the buckets of the paths it touches, keeps the last write
    per path and replaces these paths.  Replaying an epoch re-applies the same
    last-write-wins merge, so the result is unchanged.
    """

    def fold(batch: DataFrame, epoch_id: int) -> None:
        rows = to_rows(batch).persist()          # read for its buckets, its paths and the merge
        try:
            keys = rows.select("file_path").distinct()
            touched = BT.buckets_of(keys, "file_path", buckets)
            current = BT.read_current(spark, ledger_base, LEDGER, touched).join(keys, "file_path", "left_semi")
            BT.replace_keys(spark, ledger_base, LEDGER, "file_path", buckets, changed=L.upsert_ledger(current, rows))
        finally:
            rows.unpersist()

    q = (source.writeStream.foreachBatch(fold)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_ledger(spark: SparkSession, ledger_base: str) -> DataFrame:
    return BT.read_current(spark, ledger_base, LEDGER)


def _fold_files(spark: SparkSession, batch: DataFrame, state: str, index_buckets: int, ledger_buckets: int) -> None:
    """One micro-batch of file versions ``(file_path, mtime, text[, read_error])`` into index and ledger.

    Last version per path; versions older than the ledger's are dropped, and of the ledger's own
    only a failed one is tried again, so a replayed or late batch changes nothing.  The points go in before the ledger rows, and both
    replace by key: a crash in between makes the replay redo the same files.
    """
    from quarry.operators.ingest import file_type_of, ingest
    from quarry.operators.scan import _with_terms, _with_vectors

    run = scratch_dir(spark, "stream-files")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{run}/{name}")
        return spark.read.parquet(f"{run}/{name}")

    error = F.col("read_error") if "read_error" in batch.columns else F.lit(None).cast("string")
    # the batch is read once; what decides is found in narrow columns, and texts are shuffled only where paths repeat
    versions = stored(batch.select("file_path", "mtime", "text", error.alias("read_error")).filter("file_path is not null"), "versions")
    newest = stored(versions.groupBy("file_path").agg(F.max("mtime").alias("mtime"), F.count(F.lit(1)).alias("n")), "newest")
    paths = newest.select("file_path")
    known = (BT.read_current(spark, f"{state}/ledger", LEDGER, BT.buckets_of(paths, "file_path", ledger_buckets))
             .join(paths, "file_path", "left_semi"))
    ledger = stored(known, "ledger")
    late = ledger.select("file_path", "last_modified").join(newest, "file_path").filter("mtime < last_modified").select("file_path")
    listing = newest.select("file_path", "mtime").join(late, "file_path", "left_anti")
    ledger = ledger.join(late, "file_path", "left_anti")
    n_paths, n_most = newest.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    def load(files: DataFrame) -> DataFrame:
        texts = versions if n_most <= 1 else last_per_key(versions, ["file_path"], ["mtime", "text"])
        n_files = files.count()
        if n_files < n_paths:
            wanted = files.select("file_path")
            texts = texts.join(F.broadcast(wanted) if n_files <= BT.BROADCAST_KEYS else wanted, "file_path", "left_semi")
        name = basename("file_path")
        return texts.select(name.alias("source_file"), "file_path", file_type_of(name).alias("file_type"), "mtime",
                            F.lit(1).cast("bigint").alias("section_no"), F.lit(1).cast("bigint").alias("n_sections"), "text", "read_error")

    def kept(df: DataFrame, name: str) -> DataFrame:
        return df if name == "sections" else stored(df, name)         # the versions are stored already

    out = ingest(listing, ledger, load, BT.read_current(spark, f"{run}/none", POINTS), materialize=kept)
    status = out["status"]
    emptied = status.filter(F.col("status").isin(STATUS_SKIPPED_EMPTY, STATUS_SKIPPED_NO_CHUNKS)).select("source_file")
    BT.replace_keys(spark, f"{state}/index", POINTS, "source_file", index_buckets,
                    changed=_with_vectors(out["points"]), removed=emptied, derive=_with_terms)
    todo = L.files_to_ingest(out["changes"]).select("file_path", F.col("mtime").alias("last_modified"))
    rows = (todo.withColumn("source_file", basename("file_path")).join(status.select("source_file", "status", "error_message"), "source_file", "left")
            .select("file_path", "last_modified", F.current_timestamp().alias("ingested_at"), "status", "error_message"))
    BT.replace_keys(spark, f"{state}/ledger", LEDGER, "file_path", ledger_buckets, changed=rows)
    BT.clear(spark, run)


def stream_files(spark: SparkSession, versions: DataFrame, state: str, checkpoint: str,
                 index_buckets: int = 64, ledger_buckets: int = 64) -> None:
    """Fold a stream of file versions ``(file_path, mtime, text[, read_error])`` into the state that
    ``operators.scan`` and ``api.ask`` read: dedupe, chunk, replace the files' points, upsert the ledger."""

    def fold(batch: DataFrame, epoch_id: int) -> None:
        _fold_files(spark, batch, state, index_buckets, ledger_buckets)

    q = (versions.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_answers(spark: SparkSession, questions: DataFrame, chunks: DataFrame, sink: str,
                   checkpoint: str, k: int, threshold: float) -> None:
    """Prompts for every question of the stream, written to ``sink/epoch=<id>`` (Parquet)."""

    def answer(batch: DataFrame, epoch_id: int) -> None:
        q = normalise_queries(batch)
        hits = lexical_retrieve(chunks, q, k=k, threshold=threshold)
        # one folder per epoch, overwritten on replay: exactly-once output
        build_prompts(q, hits).write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")

    q = (questions.writeStream.foreachBatch(answer)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
