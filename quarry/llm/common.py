"""Shared by the operators: table reading, materialising, small bounded tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_dir

#: Rows per Arrow batch for the operators that hand whole texts to Python: with
#: texts of up to a few hundred KB a batch stays in the tens of MB.
TEXT_BATCH_ROWS = 256
#: Rows per columnar batch of a Parquet scan; the default of 4,096 whole texts is tens of MB a task.
SCAN_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Bound the rows that a scan or an Arrow batch of this session holds at once (runtime
    settings, read when a plan starts)."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
                       ("spark.sql.parquet.columnarReaderBatchSize", SCAN_ROWS)):
        if int(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: what follows
    survives lost executors and does not compute ``df`` again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_table(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """A table of driver rows whose number a constant bounds, as one literal (no RDD)."""
    names = [part.split()[0] for part in ddl.split(",")]
    doc = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(doc), f"array<struct<{_struct(ddl)}>>")))


def _struct(ddl: str) -> str:
    return ",".join(":".join(part.split()) for part in ddl.split(","))
