"""Roles of the driver tables (see FIXTURES §3).

* ``documents``     -> one-section TXT files ``doc_<id>.txt``
* ``conversations`` -> multi-section PDF files ``conv_<id>.pdf``, sections by ``turn``
* ``benchmark``     -> the query table
* ``embeddings``    -> dense points (and dense queries) keyed by ``vec_id``
* ``events``        -> ingestion-ledger history and a file listing for ``user_<id>.txt``
* ``pages``         -> path strings for listings and path projections
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.config import STATUS_FAILED, STATUS_SKIPPED_EMPTY, STATUS_SUCCESS, MSG_EMPTY
from quarry.session import scratch_dir

# Cut-off between ledger history and later activity in the events table.
HISTORY_CUTOFF = "2024-01-20 00:00:00"


_SCHEMAS: dict[tuple, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; its footer schema is inferred once per file version and reused."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        st = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath)
        key = (path, st.getLen(), st.getModificationTime())
    except Exception:  # noqa: BLE001 - let the reader report a missing path
        return spark.read.parquet(path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def document_sections(documents: DataFrame) -> DataFrame:
    """One section per document file."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return documents.select(
        name.alias("source_file"), name.alias("file_path"), F.lit("txt").alias("file_type"),
        F.lit(None).cast("timestamp").alias("mtime"),
        F.lit(1).cast("bigint").alias("section_no"), F.lit(1).cast("bigint").alias("n_sections"),
        F.col("text"))


def number_sections(rows: DataFrame, file: str, order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``section_no`` (1.. within ``file`` by ``order``) and ``n_sections``, for files of any size.

    Rows are ranged by (file, order) and stored, so a file of most rows is sorted by many tasks; a
    row's number is its place in its range plus the rows of the file in the ranges before.  Only
    the counts by file and range (files + ranges rows) go through a window.  Rows that are equal
    in ``order`` are numbered in any order.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "numbered")
    at = F.monotonically_increasing_id()
    (rows.repartitionByRange(parts, file, *order).sortWithinPartitions(file, *order)
     .withColumns({"_part": F.shiftright(at, 33).cast("int"), "_at": at.bitwiseAND(F.lit((1 << 33) - 1))}).write.parquet(path))
    stored = spark.read.parquet(path)
    counts = stored.groupBy(file, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    by_file = Window.partitionBy(file)
    before = F.sum("_n").over(by_file.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(file).alias("_file"), F.col("_part").alias("_p"), "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                            F.sum("_n").over(by_file).alias("n_sections"))
    same = (F.col(file).eqNullSafe(F.col("_file"))) & (F.col("_part") == F.col("_p"))
    return stored.join(offsets, same).select(
        *rows.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("bigint").alias("section_no"), F.col("n_sections").cast("bigint"))


def conversation_sections(conversations: DataFrame) -> DataFrame:
    """Turns become pages of ``conv_<id>.pdf``: numbered 1.. by turn, counted per file.

    Turns that share a number follow their text; a missing number comes first.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "text")
    ranked = conversations.select(
        "conv_id", "text", F.row_number().over(by_turn).alias("section_no"),
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_sections"))
    name = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".pdf"))
    return ranked.select(
        name.alias("source_file"), name.alias("file_path"), F.lit("pdf").alias("file_type"),
        F.lit(None).cast("timestamp").alias("mtime"),
        F.col("section_no").cast("bigint").alias("section_no"),
        F.col("n_sections").cast("bigint").alias("n_sections"),
        F.col("text"))


def benchmark_queries(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("bigint").alias("query_id"), "text")


def user_file(user_id="user_id"):
    return F.concat(F.lit("user_"), F.col(user_id).cast("string"), F.lit(".txt"))


def _status_of(event_type="event_type"):
    et = F.col(event_type)
    return (F.when(et == "error", F.lit(STATUS_FAILED))
             .when(et == "signup", F.lit(STATUS_SKIPPED_EMPTY))
             .otherwise(F.lit(STATUS_SUCCESS)))


def _error_of(event_type="event_type", event_id="event_id"):
    et = F.col(event_type)
    return (F.when(et == "error", F.concat(F.lit("error event "), F.col(event_id).cast("string")))
             .when(et == "signup", F.lit(MSG_EMPTY)))


def ledger_rows(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events.select(
        user_file().alias("file_path"),
        ts.alias("last_modified"), ts.alias("ingested_at"),
        _status_of().alias("status"), _error_of().alias("error_message"),
        F.col("event_id").alias("seq"))


def ledger_history(events: DataFrame) -> DataFrame:
    """Ledger writes before the cut-off, but for the files of every fifth user: the
    change-detection queries need files that the ledger does not know."""
    h = events.filter((F.col("ts") < F.lit(HISTORY_CUTOFF).cast("timestamp")) & (F.pmod("user_id", F.lit(5)) != 0))
    return ledger_rows(h)


def ledger_updates(events: DataFrame) -> DataFrame:
    """Ledger writes after the cut-off (all users)."""
    return ledger_rows(events.filter(F.col("ts") >= F.lit(HISTORY_CUTOFF).cast("timestamp")))


def file_listing(events: DataFrame) -> DataFrame:
    """Listed files: users with ``user_id % 11 <> 3``.

    mtime is the latest event for odd users and the latest pre-cut-off event for
    even users (their file did not change since the last ingest).
    """
    before = F.col("ts") < F.lit(HISTORY_CUTOFF).cast("timestamp")
    odd = F.pmod(F.col("user_id"), F.lit(2)) == 1
    agg = (events.filter(F.pmod("user_id", F.lit(11)) != 3)
                 .groupBy("user_id")
                 .agg(F.max("ts").alias("_all"), F.max(F.when(before, F.col("ts"))).alias("_before")))
    mtime = F.when(odd, F.col("_all")).otherwise(F.coalesce(F.col("_before"), F.col("_all")))
    return agg.select(user_file().alias("file_path"), mtime.cast("timestamp").alias("mtime"),
                      F.col("user_id").alias("doc_id"))
