"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread rows over the session's shuffle partitions before a Python stage.

    How many splits a scan or a join below it has says little about the work a row makes
    here, so the number comes from the session and never from an estimate.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[F.col(k) for k in keys])


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by ``order`` (ties impossible when ``order`` ends with a unique column).

    ``max_by`` over a struct is a hash aggregate with map-side partial merge, so a
    hot key is reduced before the shuffle instead of being sorted in one task.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, ordering).alias("_last"))
              .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others]))
