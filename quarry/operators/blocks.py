"""Rows packed into numbered blocks, and a bounded set of question blocks met with point blocks.

A block is one row ``(block, n, data)``: up to ``rows`` rows of a table as one Arrow IPC
stream.  Blocks are cut where the rows lie (no shuffle) and stored; block pairs are then
read by executors straight from the stored tables, each side in its own partitions, so
neither side goes through the driver and nothing is replicated in a shuffle.  Spark
broadcasts a side only when its measured size is under its own threshold.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 * 1024 * 1024
SCHEMA = "block bigint, n int, data binary"
_PARTS = 1 << 32            # blocks that one task may cut


def dump(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def load(data) -> pa.RecordBatch:
    """The rows of one block, without a copy."""
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all().combine_chunks().to_batches()[0]


def pack(df: DataFrame, rows: int, total: int, enrich: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """``df`` (of ``total`` rows) as blocks of at most ``rows`` rows or about ``BLOCK_BYTES``;
    ``enrich`` maps the rows of a block before they are stored."""

    def cut(batches):
        first = TaskContext.get().partitionId() * _PARTS
        held, count, size = [], 0, 0

        def close():
            nonlocal held, count, size, first
            table = pa.Table.from_batches(held)
            if enrich is not None:
                table = enrich(table)
            first += 1
            out = pa.RecordBatch.from_pydict({"block": pa.array([first - 1], pa.int64()), "n": pa.array([count], pa.int32()),
                                              "data": pa.array([dump(table)], pa.binary())})
            held, count, size = [], 0, 0
            return out

        for batch in batches:
            step = max(1, min(rows, BLOCK_BYTES * batch.num_rows // max(1, batch.nbytes)))
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(step, rows - count))
                held.append(part)
                at, count, size = at + part.num_rows, count + part.num_rows, size + part.nbytes
                if count >= rows or size >= BLOCK_BYTES:
                    yield close()
        if held:
            yield close()

    return df.coalesce(max(1, -(-total // rows))).mapInArrow(cut, SCHEMA)


def pairs(questions: DataFrame, points: DataFrame) -> DataFrame:
    """Every question block with every point block: ``q_block, q_data, p_block, p_data``."""
    return (questions.select(F.col("block").alias("q_block"), F.col("data").alias("q_data"))
            .crossJoin(points.select(F.col("block").alias("p_block"), F.col("data").alias("p_data"))))


class Last(dict):
    """Blocks as ``make(data)`` gives them, the latest ``most`` kept."""

    def __init__(self, make: Callable, most: int = 4):
        super().__init__()
        self.make, self.most = make, most

    def get_block(self, number: int, data):
        if number not in self:
            if len(self) >= self.most:
                del self[next(iter(self))]
            self[number] = self.make(data)
        return self[number]
