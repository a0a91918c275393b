"""Folder scan with persistent state: the full incremental-ingest lifecycle.

State lives in one folder (on a cluster: under the shared checkpoint folder):

    <state>/index    points, partitioned by a bucket of the source file
    <state>/ledger   ledger rows, partitioned by a bucket of the file path (Parquet is the
                     primary store; JSON is import/export)
    <state>/runs/<id> this scan's listing, sections, points and status (each written once);
                     the listing, changes, status and points stay until the next scan or
                     ``clear_all``, the rest goes when the ledger is written

A scan reads the state, computes everything as one batch, writes its new points once,
then replaces the touched files in the index and after that in the ledger.  Only the
buckets of these files are rewritten.  A crash before the ledger is replaced makes the
next scan redo the same files; per-file replace is idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import ledger as L
from quarry.operators import bucketed as BT
from quarry.operators.ingest import ingest
from quarry.operators.lexical import token_dims
from quarry.sources.files import list_folders, registry, text_loader

# The stored index always has the points schema: ``terms`` are the lexical buckets of the
# text, hashed once here; ``vector`` stays NULL when no embedder is configured.
POINT_COLS = [f.name for f in C.POINTS.fields]
INDEX_BUCKETS = 256
LEDGER_BUCKETS = 64


def read_state_index(spark: SparkSession, state: str) -> DataFrame:
    return BT.read_current(spark, f"{state}/index", C.POINTS)


def _with_vectors(points: DataFrame) -> DataFrame:
    if "vector" in points.columns:
        return points.withColumn("vector", F.col("vector").cast("array<float>"))
    return points.withColumn("vector", F.lit(None).cast("array<float>"))


def _with_terms(points: DataFrame) -> DataFrame:
    return points.withColumn("terms", token_dims("text"))


def read_state_ledger(spark: SparkSession, state: str) -> DataFrame:
    return BT.read_current(spark, f"{state}/ledger", C.LEDGER)


def import_ledger(spark: SparkSession, json_path: str, state: str) -> DataFrame:
    """Bring a JSON ledger (one object keyed by path over the whole file) into the state.

    Returns the quarantine rows; an unparseable file contributes no ledger rows.
    """
    rows, bad = L.read_ledger_object(spark, json_path)
    BT.replace_keys(spark, f"{state}/ledger", C.LEDGER, "file_path", LEDGER_BUCKETS, changed=rows)
    return bad


def export_ledger_json(spark: SparkSession, state: str, path: str) -> None:
    """Write the ledger as JSON, one object keyed by its path per line."""
    L.export_ledger(read_state_ledger(spark, state)).select("json").write.mode("errorifexists").text(path)


def pdf_unavailable(files: DataFrame) -> DataFrame:
    """Default PDF loader: page extraction is not built in; files fail with a message."""
    return files.select("source_file", "file_path", "file_type", "mtime",
                        F.lit(None).cast("bigint").alias("section_no"), F.lit(None).cast("bigint").alias("n_sections"),
                        F.lit(None).cast("string").alias("text"),
                        F.lit("no PDF section extractor configured").alias("read_error"))


def run_scan(spark: SparkSession, folders: dict[str, str], state: str, loaders: dict | None = None,
             embed=None, now=None, index_buckets: int = INDEX_BUCKETS,
             ledger_buckets: int = LEDGER_BUCKETS) -> dict[str, DataFrame]:
    """One scan over ``folders`` (``{'.pdf': dir, '.txt': dir}``); returns the run's tables.

    The numbers of buckets are properties of the state's tables: choose them when the state is
    created (so that a bucket holds about a file of Parquet) and keep them.
    """
    BT.clear(spark, f"{state}/runs")                       # of scans before this one
    run_dir = f"{state}/runs/{uuid.uuid4().hex[:12]}"

    def materialize(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{run_dir}/{name}")
        return spark.read.parquet(f"{run_dir}/{name}")

    # one listing per scan: processing, index and ledger all see the same files
    listing = materialize(list_folders(spark, folders), "listing")
    ledger = read_state_ledger(spark, state)
    index = read_state_index(spark, state)
    txt_dirs = [d for suffix, d in folders.items() if suffix == ".txt"]
    load = registry(loaders or {"txt": text_loader(spark, txt_dirs), "pdf": pdf_unavailable})

    out = ingest(listing, ledger, load, index, embed=embed, now=now, materialize=materialize)
    status = out["status"]
    emptied = status.filter(F.col("status").isin(C.STATUS_SKIPPED_EMPTY, C.STATUS_SKIPPED_NO_CHUNKS)).select("source_file")
    new_points = _with_vectors(out["points"])
    changes = out["changes"]
    gone = changes.filter(F.col("reason") == "missing").select("file_path")
    gone_files = gone.select(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("source_file"))
    # index: successful files are replaced, missing and emptied files are purged
    BT.replace_keys(spark, f"{state}/index", C.POINTS, "source_file", index_buckets,
                     changed=new_points, removed=gone_files.unionByName(emptied), derive=_with_terms)
    # ledger: one new row per processed path (from the written status), missing paths dropped
    # (merged: Spark takes the size of the stored status from its zstd files, and a broadcast holds it unpacked on the driver)
    todo = L.files_to_ingest(changes).select("file_path", F.col("mtime").alias("last_modified"))
    rows = (todo.withColumn("source_file", F.regexp_extract("file_path", r"([^/]+)$", 1))
                .join(status.select("source_file", "status", "error_message").hint("merge"), "source_file", "left")
                .select("file_path", "last_modified",
                        (now if now is not None else F.current_timestamp()).alias("ingested_at"),
                        "status", "error_message"))
    BT.replace_keys(spark, f"{state}/ledger", C.LEDGER, "file_path", ledger_buckets,
                     changed=rows, removed=gone)
    BT.clear(spark, f"{run_dir}/sections")
    return {"changes": changes, "status": status, "points": _with_terms(new_points).select(*POINT_COLS),
            "index": read_state_index(spark, state), "ledger": read_state_ledger(spark, state)}


def clear_all(spark: SparkSession, state: str) -> None:
    """Empty the collection and the ledger."""
    for part in ("index", "ledger", "runs"):
        BT.clear(spark, f"{state}/{part}")
