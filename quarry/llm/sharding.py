"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every key is hashed onto a ring; each shard owns the arcs that end at its virtual
nodes.  A shard takes at most its capacity; keys beyond it continue clockwise to the
next virtual node whose shard has room.  Keys of one arc are ranked by their ring
position, so an arc's assignment is a few rank ranges: the walk needs only the number
of keys per cell of the ring (a constant number of cells), and every row finds its
shard by its rank.

With ``slack=0`` (the default) the capacities add up to the number of rows, so shard
counts differ by one at most (law ``rows``).  Defined cases: a NULL text has size 1
and checksum 0, a NULL key hashes like any other value, repeated rows are ranked apart.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded_table

CELL_BITS = 12          # cells of the ring: the positions virtual nodes can take
GROUP_ROWS = 20_000     # rows that are ranked together, about
POSITION_BITS = 48


def ring(shards: int, vnodes: int, cell_bits: int = CELL_BITS) -> list[int]:
    """The shard that owns each cell: that of the first virtual node at or after it."""
    cells = 1 << cell_bits
    if shards * vnodes > cells // 2:
        raise ValueError("too many virtual nodes for the cells of the ring")
    at: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big") % cells
            while h in at:
                h = (h + 1) % cells
            at[h] = s
    owner = [0] * cells
    last = at[min(at)]                       # past the last node the ring begins anew
    for c in range(cells - 1, -1, -1):
        last = at.get(c, last)
        owner[c] = last
    return owner


def capacities(total: int, wanted: list[int], slack: float) -> list[int]:
    """What each shard may take: equal parts, the remainder to the most wanted shards."""
    n = len(wanted)
    base = [math.ceil((1 + slack) * total / n)] * n if slack else [total // n] * n
    if not slack:
        for s in sorted(range(n), key=lambda s: (-wanted[s], s))[: total % n]:
            base[s] += 1
    return base


def walk(counts: dict[int, int], owner: list[int], shards: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """``(cell, first rank, end rank, shard, first slot)`` for the rows of every cell."""
    total = sum(counts.values())
    wanted = Counter()
    for c, n in counts.items():
        wanted[owner[c]] += n
    room = capacities(total, [wanted[s] for s in range(shards)], slack)
    parts: list[tuple[int, int, int, int]] = []
    spilled = []
    for c in sorted(counts):
        s = owner[c]
        own = min(counts[c], room[s])
        room[s] -= own
        if own:
            parts.append((c, 0, own, s))
        if own < counts[c]:
            spilled.append((c, own, counts[c]))
    cells = len(owner)
    for c, lo, hi in spilled:
        step = c
        while lo < hi:                       # clockwise, until a shard has room
            step = (step + 1) % cells
            s = owner[step]
            take = min(hi - lo, room[s])
            if take:
                parts.append((c, lo, lo + take, s))
                room[s] -= take
                lo += take
    out, used = [], Counter()
    for c, lo, hi, s in sorted(parts):
        out.append((c, lo, hi, s, used[s]))
        used[s] += hi - lo
    return out


def shard(df: DataFrame, key: str, shards: int = 16, vnodes: int = 64, slack: float = 0.0,
          tie_break: list[Column] | None = None) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``tie_break`` orders rows whose key hashes alike; rows equal in these too are interchangeable.
    """
    spark = df.sparkSession
    owner = ring(shards, vnodes)
    position = F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - POSITION_BITS)
    cell = F.shiftright(position, POSITION_BITS - CELL_BITS)
    counted = df.select(cell.alias("c")).groupBy("c").count().collect()     # at most one row a cell
    counts = {r["c"]: r["count"] for r in counted}
    plan = bounded_table(spark, walk(counts, owner, shards, slack),
                         "p_cell bigint,p_lo bigint,p_hi bigint,p_shard int,p_slot bigint")
    total = sum(counts.values())
    bits = min(40, max(CELL_BITS, math.ceil(math.log2(max(1, total / GROUP_ROWS)))))
    group = F.shiftright(F.col("_position"), POSITION_BITS - bits)

    placed = df.withColumn("_position", position).withColumn("_group", group)
    before = (df.select(position.alias("_position")).groupBy(group.alias("_g")).count()
              .withColumn("_before", F.coalesce(F.sum("count").over(
                  Window.partitionBy(F.shiftright("_g", bits - CELL_BITS)).orderBy("_g")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("_g", "_before"))
    in_group = Window.partitionBy("_group").orderBy("_position", F.col(key), *(tie_break or []))
    ranked = (placed.withColumn("_n", F.row_number().over(in_group) - 1)
              .join(before, F.col("_group") == F.col("_g"))
              .withColumn("_rank", F.col("_before") + F.col("_n"))
              .withColumn("_cell", F.shiftright("_group", bits - CELL_BITS)))
    # the plan has at most cells + shards * cells rows, whatever the input
    return (ranked.join(F.broadcast(plan), (F.col("_cell") == F.col("p_cell")) & (F.col("_rank") >= F.col("p_lo"))
                        & (F.col("_rank") < F.col("p_hi")))
            .withColumn("shard", F.col("p_shard"))
            .withColumn("slot", F.col("p_slot") + F.col("_rank") - F.col("p_lo"))
            .drop("_position", "_group", "_n", "_g", "_before", "_rank", "_cell", "p_cell", "p_lo", "p_hi", "p_shard", "p_slot"))


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = 64) -> DataFrame:
    """Documents with the digest of their text, their shard and slot; law ``rows``."""
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"))
    return (shard(narrow, "doc_id", shards, vnodes, tie_break=[F.col("text_crc32"), F.col("size")])
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
