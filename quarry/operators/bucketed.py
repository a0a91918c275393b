"""State tables: Parquet partitioned by a hash bucket of the key, replaced bucket by bucket.

A replace reads the buckets that its keys fall into (partition pruning) and writes their new
rows once, with Spark's dynamic partition overwrite, which puts the buckets in place when all
their files are written; other buckets are not touched, and no version is kept.  Only new rows
are shuffled: rows that stay lie in their bucket's files already.  One writer at a time.
A crash before the overwrite leaves the table as it was; one during it leaves some buckets
replaced, and since replacing by key is idempotent, the same replace can be run again.

The number of buckets is a property of a table: choose it when the table is created and
pass the same one from then on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import bucket_of
from quarry.session import scratch_dir

BROADCAST_KEYS = 1_000_000     # replaced keys that every executor may hold (some 100 MB); more are joined by a shuffle


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _bucket_folders(spark: SparkSession, base: str) -> set[int]:
    fs, p = _fs(spark, base)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return {int(n.split("=", 1)[1]) for n in names if n.startswith("bucket=")}


def _bucket_files(spark: SparkSession, base: str, bucket: int) -> set[str]:
    fs, p = _fs(spark, f"{base}/bucket={bucket}")
    return {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()


def read_current(spark: SparkSession, base: str, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
    """The table, or the given buckets of it; a table that was never written is empty."""
    if not _bucket_folders(spark, base):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(base)
    if only is not None:
        stored = stored.filter(F.col("bucket").isin(sorted(only)))
    return stored.select(*schema.fieldNames())


def buckets_of(keys: DataFrame, key: str, buckets: int) -> set[int]:
    """The buckets that hold these keys: at most ``buckets`` numbers."""
    return {r.b for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect()}


def replace_keys(spark: SparkSession, base: str, schema: T.StructType, key: str, buckets: int,
                 changed: DataFrame | None = None, removed: DataFrame | None = None,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> set[int]:
    """Replace every row whose key is in ``changed`` or ``removed`` by the rows of ``changed``.

    ``derive`` adds the columns of the table that a row of ``changed`` yields by itself; it is
    applied behind the shuffle, so that they are not shuffled.  Returns the buckets that were rewritten.
    """
    cols = schema.fieldNames()
    keys = spark.range(0).select(F.lit(None).cast(schema[key].dataType).alias(key))
    for df in (changed, removed):
        if df is not None:
            keys = keys.unionByName(df.select(key))
    work = scratch_dir(spark, "replaced-keys")
    keys.distinct().write.parquet(work)                       # narrow, and both passes below need them
    keys = spark.read.schema(keys.schema).parquet(work)
    touched = buckets_of(keys, key, buckets)
    try:
        if touched:
            _rewrite(spark, base, schema, cols, key, keys, buckets, touched, changed, derive)
    finally:
        clear(spark, work)
    return touched


def _rewrite(spark, base, schema, cols, key, keys, buckets, touched, changed, derive) -> None:
    old = {b: _bucket_files(spark, base, b) for b in touched}
    rows = None
    if any(old.values()):
        rows = read_current(spark, base, schema, touched)
        if keys.count() <= BROADCAST_KEYS:
            rows = rows.join(F.broadcast(keys), key, "left_anti").withColumn("bucket", bucket_of(key, buckets))
        else:                                                 # the join deals the rows out anew
            rows = rows.join(keys, key, "left_anti").withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
        rows = rows.select(*cols, "bucket")
    if changed is not None:
        new = changed.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")      # AQE splits a hot bucket over several writers
        new = (derive(new) if derive else new).select(*cols, "bucket")
        rows = new if rows is None else rows.unionByName(new)
    if rows is not None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy("bucket").parquet(base))
    for b, files in old.items():                              # overwriting leaves emptied buckets alone
        if files and files == _bucket_files(spark, base, b):
            clear(spark, f"{base}/bucket={b}")


def clear(spark: SparkSession, base: str) -> None:
    """Empty the table."""
    fs, p = _fs(spark, base)
    if fs.exists(p):
        fs.delete(p, True)
