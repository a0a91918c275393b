"""Per-file status and the whole ingest scan as one batch job.

Scan plan: listing full-outer-join ledger -> files to ingest -> sections ->
chunks -> vectors -> per-file status -> replace the successful files' points in the
index -> ledger rows (one write per batch).  Failures are rows, never exceptions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.text import has_text
from quarry.operators.chunking import chunk_sections
from quarry.operators.index import delete_by_file, replace_files
from quarry.operators.ledger import change_detect, files_to_ingest, upsert_ledger, LEDGER_COLS


def _fingerprint():
    """Metrics that two tables share if they hold as many rows of each file (but for chance of 2 ** -40)."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("source_file"), F.lit(1 << 40)).cast("decimal(38,0)")).alias("files")]


def stored_with_metrics(df: DataFrame, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict]:
    """``df`` as ``store`` writes it, and its fingerprint, taken while it is written (no second pass)."""
    seen = Observation()
    stored = store(df.observe(seen, *_fingerprint()))
    return stored, seen.get


def upload_status(files: DataFrame, sections: DataFrame, chunks: DataFrame, points: DataFrame,
                  store: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write produced chunks and uploaded points once each; ``(stored points, document_status)``.

    Both writes are observed.  Equal fingerprints mean that nothing was lost, and no table is
    counted again; otherwise (points lost, or a metric counted twice by a retried stage) the
    points are counted per file.  ``points`` is derived from ``chunks`` by a function of it.
    """
    chunks, made = stored_with_metrics(chunks, lambda df: store(df, "chunks"))
    points, written = stored_with_metrics(points, lambda df: store(df, "points"))
    return points, document_status(files, sections, chunks, None if made == written else points)


def document_status(files: DataFrame, sections: DataFrame, chunks: DataFrame,
                    uploaded: DataFrame | None = None) -> DataFrame:
    """``(source_file, file_type, n_sections, n_chunks, n_uploaded, status, error_message)``.

    ``files`` holds ``(source_file, file_type[, read_error])``; ``sections`` the
    extracted sections; ``chunks`` / ``uploaded`` the produced and written points.
    All inputs are reduced per file by hash aggregates before they meet.
    """
    f = files.select("source_file", "file_type",
                     (F.col("read_error") if "read_error" in files.columns else F.lit(None).cast("string")).alias("read_error"))
    s = sections.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_sections"), F.bool_or(has_text("text")).alias("any_text"))
    if uploaded is None:
        # everything produced counts as written: one aggregate, one pass over the chunks
        c = chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_chunks")) \
                  .withColumn("n_uploaded", F.col("n_chunks"))
        j = f.join(s, "source_file", "left").join(c, "source_file", "left")
    else:
        c = chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_chunks"))
        u = uploaded.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_uploaded"))
        j = f.join(s, "source_file", "left").join(c, "source_file", "left").join(u, "source_file", "left")
    n_sec = F.coalesce(F.col("n_sections"), F.lit(0)).cast("bigint")
    n_ch = F.coalesce(F.col("n_chunks"), F.lit(0)).cast("bigint")
    n_up = F.coalesce(F.col("n_uploaded"), F.lit(0)).cast("bigint")
    known = F.col("file_type").isin(*C.FILE_TYPES)
    status = (F.when(~known, F.lit(C.STATUS_FAILED))
               .when(F.col("read_error").isNotNull(), F.lit(C.STATUS_FAILED))
               .when((n_sec == 0) | ~F.coalesce(F.col("any_text"), F.lit(False)), F.lit(C.STATUS_SKIPPED_EMPTY))
               .when(n_ch == 0, F.lit(C.STATUS_SKIPPED_NO_CHUNKS))
               .when(n_up == n_ch, F.lit(C.STATUS_SUCCESS))
               .otherwise(F.lit(C.STATUS_FAILED)))
    msg = (F.when(~known, F.format_string(C.MSG_NO_PROCESSOR.format("%s"), F.col("file_type")))
            .when(F.col("read_error").isNotNull(), F.col("read_error"))
            .when((n_sec == 0) | ~F.coalesce(F.col("any_text"), F.lit(False)), F.lit(C.MSG_EMPTY))
            .when(n_ch == 0, F.lit(C.MSG_NO_CHUNKS))
            .when(n_up == n_ch, F.lit(None).cast("string"))
            .otherwise(F.format_string(C.MSG_MISMATCH.format("%d", "%d"), n_ch, n_up)))
    return j.select("source_file", "file_type", n_sec.alias("n_sections"), n_ch.alias("n_chunks"),
                    n_up.alias("n_uploaded"), status.alias("status"), msg.alias("error_message"))


def file_type_of(name):
    return F.regexp_extract(name, r"^\.*[^.].*\.([^.]*)$", 1)


def ingest(listing: DataFrame, ledger: DataFrame, load_sections: Callable[[DataFrame], DataFrame],
           index: DataFrame, embed: Callable[[DataFrame], DataFrame] | None = None,
           now=None, size: int = C.CHUNK_SIZE, overlap: int = C.CHUNK_OVERLAP,
           materialize: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """One incremental scan.  Returns ``changes, status, points, index, ledger``.

    ``load_sections(files)`` maps the files to ingest (``file_path, source_file,
    file_type``) to sections, optionally with a ``read_error`` column per file.
    Old points of a file are replaced when its new chunks succeeded and removed when the
    file has become empty; a file that failed keeps them.  Chunks are counted before
    ``embed``, so vectors that go missing make the file fail.
    ``materialize(df, name)`` (e.g. write + read back) is applied to the changes, the loaded
    sections, the produced chunks and points and the status, so file bodies are read once and the
    chunking is not recomputed for statuses and the index.
    """
    changes = change_detect(listing, ledger)
    if materialize is not None:
        changes = materialize(changes, "changes")       # the ledger it reads is replaced later
    todo = files_to_ingest(changes).select("file_path", "mtime")
    files = todo.withColumn("source_file", F.regexp_extract("file_path", r"([^/]+)$", 1)) \
                .withColumn("file_type", file_type_of("source_file"))
    sections = load_sections(files)
    if materialize is not None:
        sections = materialize(sections, "sections")
    read_errors = (sections.filter(F.col("read_error").isNotNull()).groupBy("source_file")
                   .agg(F.first("read_error").alias("read_error"))
                   if "read_error" in sections.columns else None)
    good_sections = sections.filter(F.col("read_error").isNull()) if read_errors is not None else sections
    chunks = chunk_sections(good_sections.filter(F.col("file_type").isin(*C.FILE_TYPES)), size, overlap)
    made = written = None
    if materialize is not None:
        chunks, made = stored_with_metrics(chunks, lambda df: materialize(df, "chunks"))
    points = chunks
    if embed:
        points = embed(chunks)
        if materialize is not None:
            points, written = stored_with_metrics(points, lambda df: materialize(df, "points"))
    f_err = files.join(read_errors, "source_file", "left") if read_errors is not None else files
    # what the writes observed tells whether points were lost; only then are they counted per file
    whole = points is chunks or (written is not None and written == made)
    status = document_status(f_err, good_sections, chunks, None if whole else points)
    if materialize is not None:
        status = materialize(status, "status")
    ok = status.filter(F.col("status") == C.STATUS_SUCCESS)
    # points are joined with the successful files only if any other file has some
    all_ok = whole and made is not None and made["n"] == (
        ok.groupBy("source_file").agg(F.max("n_chunks").alias("n")).agg(F.sum("n")).first()[0] or 0)
    new_points = points if all_ok else points.join(ok.select("source_file"), "source_file", "left_semi")
    # a file that was read and turned out empty holds no text any more: its old points go too
    empty = status.filter(F.col("status").isin(C.STATUS_SKIPPED_EMPTY, C.STATUS_SKIPPED_NO_CHUNKS)).select("source_file")
    new_index = delete_by_file(replace_files(index, new_points), empty)
    ts = now if now is not None else F.current_timestamp()
    rows = files.join(status.select("source_file", "status", "error_message"), "source_file", "left").select(
        "file_path", F.col("mtime").alias("last_modified"), ts.alias("ingested_at"),
        "status", "error_message")
    gone = changes.filter(F.col("reason") == "missing").select("file_path")
    kept_ledger = ledger.join(gone, "file_path", "left_anti")
    new_ledger = upsert_ledger(kept_ledger, rows).select(*LEDGER_COLS)
    return {"changes": changes, "status": status, "points": new_points, "emptied": empty, "index": new_index, "ledger": new_ledger}
