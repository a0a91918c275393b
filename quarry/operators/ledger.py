"""Ingestion ledger: load/export as JSON, change detection, upsert, summaries.

The ledger is a table ``(file_path, last_modified, ingested_at, status,
error_message)``, one row per absolute path.  Its JSON form is an object keyed by
path, written one entry per line (every line is an object of one path), whatever the
number of files.  The classic form, one object over the whole file, is a separate import.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.config import LEDGER, LEDGER_JSON_ENTRY, STATUS_SUCCESS
from quarry.operators.common import last_per_key

LEDGER_COLS = [f.name for f in LEDGER.fields]


def _from_epoch(x) -> F.Column:
    return F.timestamp_micros(F.round(x * F.lit(1_000_000.0)).cast("bigint"))


def parse_ledger_json(texts: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON objects keyed by path -> ``(ledger rows, quarantine rows)``.

    A document that does not parse (or has the wrong shape) yields no rows and one
    quarantine row; an entry missing a required field (``last_modified``,
    ``ingested_at``, ``status``) is quarantined on its own.  Nothing fails the job.
    """
    parsed = texts.select(
        F.col(col).alias("raw"),
        F.from_json(F.col(col), f"map<string,{LEDGER_JSON_ENTRY}>", {"mode": "PERMISSIVE"}).alias("m"))
    bad_docs = parsed.filter(F.col("m").isNull() & F.col("raw").isNotNull()).select(
        F.lit("ledger").alias("source"), F.col("raw"), F.lit("unparseable ledger JSON").alias("reason"))
    entries = parsed.filter(F.col("m").isNotNull()).select(F.explode("m").alias("k", "v"))
    complete = (F.col("v").isNotNull() & F.col("v.last_modified").isNotNull()
                & F.col("v.ingested_at").isNotNull() & F.col("v.status").isNotNull())
    bad_entries = entries.filter(~complete).select(
        F.lit("ledger").alias("source"), F.to_json(F.struct("k", "v")).alias("raw"),
        F.lit("ledger entry misses a required field").alias("reason"))
    rows = entries.filter(complete).select(
        F.coalesce(F.col("v.file_path"), F.col("k")).alias("file_path"),
        _from_epoch(F.col("v.last_modified")).alias("last_modified"),
        _from_epoch(F.col("v.ingested_at")).alias("ingested_at"),
        F.col("v.status").alias("status"),
        F.col("v.error_message").alias("error_message"))
    return rows, bad_docs.unionByName(bad_entries)


def _read(spark: SparkSession, path: str, wholetext: bool) -> tuple[DataFrame, DataFrame]:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        empty = spark.createDataFrame([], LEDGER)
        return empty, spark.createDataFrame([], "source string, raw string, reason string")
    return parse_ledger_json(spark.read.text(path, wholetext=wholetext))


def read_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read an exported ledger (file or folder, one object per line) as ``(rows, quarantine)``.

    A damaged line is quarantined alone; a missing path is an empty ledger.
    """
    return _read(spark, path, wholetext=False)


def read_ledger_object(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read the classic form: one JSON object over the whole file."""
    return _read(spark, path, wholetext=True)


def export_ledger(ledger: DataFrame) -> DataFrame:
    """``(file_path, json)``: each row of the ledger as a one-line object keyed by its path.

    Rows without a path have no key in this form and are left out.
    """
    seconds = {c: (F.unix_micros(c) / F.lit(1_000_000)).cast("decimal(18,6)").alias(c)
               for c in ("last_modified", "ingested_at")}
    entry = F.struct(*[seconds.get(c, F.col(c)) for c in LEDGER_COLS])
    return ledger.filter(F.col("file_path").isNotNull()).select(
        "file_path", F.to_json(F.create_map("file_path", entry), {"ignoreNullFields": "false"}).alias("json"))


def change_detect(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listing (file_path, mtime) full-outer-joined with the ledger on path -> reason.

    Reasons: ``new``, ``retry`` (last status not success), ``modified`` (mtime
    strictly newer), ``unchanged``, ``missing`` (ledger row whose file is gone).
    """
    led = ledger.select("file_path", "last_modified", "status")
    j = listing.select("file_path", "mtime").join(led, "file_path", "full_outer")
    reason = (F.when(F.col("mtime").isNull() & F.col("status").isNotNull(), F.lit("missing"))
               .when(F.col("status").isNull(), F.lit("new"))
               .when(F.col("status") != F.lit(STATUS_SUCCESS), F.lit("retry"))
               .when(F.col("mtime") > F.col("last_modified"), F.lit("modified"))
               .otherwise(F.lit("unchanged")))
    return j.select("file_path", "mtime", "last_modified", "status", reason.alias("reason"))


def files_to_ingest(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("reason").isin("new", "retry", "modified"))


def missing_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows whose file is no longer listed (anti join)."""
    return ledger.join(listing.select("file_path"), "file_path", "left_anti")


def upsert_ledger(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Last write per path wins, ordered by ``(ingested_at, seq)``."""
    def prep(df, prio):
        seq = F.col("seq") if "seq" in df.columns else F.lit(0).cast("bigint")
        return df.select(*LEDGER_COLS, F.lit(prio).alias("_src"), seq.cast("bigint").alias("seq"))
    both = prep(ledger, 0).unionByName(prep(updates, 1))
    return last_per_key(both, ["file_path"], ["ingested_at", "_src", "seq"]).select(*LEDGER_COLS)


def ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_files"), F.max("ingested_at").alias("last_ingested_at"))


def ledger_durations(history: DataFrame) -> DataFrame:
    """Seconds between consecutive ledger writes of the same file, rounded half-up to
    2 places in exact integer arithmetic (microseconds -> centiseconds).

    Writes of one instant follow ``seq``; only the narrow projection is sorted.
    """
    w = Window.partitionBy("file_path").orderBy("ingested_at", "seq")
    us = F.unix_micros("ingested_at") - F.unix_micros(F.lag("ingested_at").over(w))
    centis = F.floor((us + F.lit(5000)) / F.lit(10000))
    return history.select("file_path", "ingested_at", "status", (centis / F.lit(100.0)).alias("elapsed_s"))
