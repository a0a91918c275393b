"""Length-delimited binary token records with masked checksums and a separate offset index.

A record is

    length   uint64   bytes of the payload
    check    uint32   masked CRC-32 of the 8 length bytes
    payload
    check    uint32   masked CRC-32 of the payload

all little-endian; the payload is ``flags uint8, doc_id int64`` and the ids, 2 bytes each
where the vocabulary allows it and else 4 (flag 2); flag 1 marks a NULL doc_id.  Beside
each file lies an index of one ``(offset uint64, ids uint64)`` pair per record, so that a
shuffled read seeks to any record.

Tasks write files under names of their own attempt and return a manifest row; the manifest
is written by Spark, so only files of attempts that succeeded are listed, and a lost
executor leaves at most an unlisted file.  Files follow one another in ascending key order.

Defined cases: a NULL text is empty (its record holds the end id alone); NULL ids come
first; rows that repeat a doc_id are records of their own, ordered by their text's hash;
an empty table gives an empty manifest.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise
from quarry.llm.tokens import encoder, tokenizer_path
from quarry.session import scratch_dir

END_ID = 2
NULL_ID, WIDE_IDS = 1, 2
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
OWN = struct.Struct("<Bq")
READ_ROWS = 4096
MANIFEST = "part int, path string, n_records bigint, n_tokens bigint, n_bytes bigint"
DIGESTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted so that a checksum of data that holds checksums stays sound."""
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    flags = (NULL_ID if doc_id is None else 0) | (WIDE_IDS if wide else 0)
    payload = OWN.pack(flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def unframe(read) -> tuple[int | None, np.ndarray]:
    """The record at which the stream stands; ``read(n)`` gives n bytes."""
    head = read(HEAD.size)
    size, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("record length is damaged")
    payload = read(size)
    if len(payload) != size or masked(payload) != TAIL.unpack(read(TAIL.size))[0]:
        raise ValueError("record is damaged")
    flags, doc_id = OWN.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE_IDS else "<u2", offset=OWN.size)
    return (None if flags & NULL_ID else doc_id), ids


def file_system(uri: str):
    """``(file system, path)`` of a URI; ``file:`` URIs and plain paths are local or mounted folders."""
    from pyarrow import fs
    local = re.match(r"(?:file:)?/+(.*)", uri)
    return (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(uri)


def read_index(uri: str) -> np.ndarray:
    """Pairs (offset, ids) of a record file."""
    fs, path = file_system(uri + ".idx")
    with fs.open_input_stream(path) as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 2)


def read_at(uri: str, numbers: list[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """The records with these numbers, in any order, by the index."""
    index = read_index(uri)
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        for i in numbers:
            f.seek(int(index[i, 0]))
            yield unframe(f.read)


def write_records(docs: DataFrame, folder: str | None = None, path: str | None = None, cut: str = "spaces",
                  end_id: int = END_ID) -> DataFrame:
    """Encode and write every document in ascending doc_id order; the manifest, a stored table."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "records")
    path = path or tokenizer_path("byte_bpe_50k.json")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        batch = next(batches, None)
        while batch is not None and not batch.num_rows:
            batch = next(batches, None)
        if batch is None:
            return
        enc = encoder(path, cut)
        wide = max(enc.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.rec"
        fs, at = file_system(uri)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        index, tokens, offset = [], 0, 0
        with fs.open_output_stream(at) as out:
            while batch is not None:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = np.append(np.frombuffer(enc.encode(text or ""), "<u4"), np.uint32(end_id))
                    data = frame(doc_id, ids, wide)
                    out.write(data)
                    index.append((offset, len(ids)))
                    offset += len(data)
                    tokens += len(ids)
                batch = next(batches, None)
        with fs.open_output_stream(at + ".idx") as out:
            out.write(np.array(index, "<u8").tobytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "path": uri, "n_records": len(index), "n_tokens": tokens,
                                           "n_bytes": offset}], schema=pa.schema(
            [("part", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64()),
             ("n_bytes", pa.int64())]))

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order))
    return materialise(rows.mapInArrow(write, MANIFEST), "manifest")


def read_digests(manifest: DataFrame) -> DataFrame:
    """Read all files back, checksums verified: place, length and checksum of every record's ids."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = file_system(row["path"])
                start, cols = row["first"], ([], [], [], [])
                with fs.open_input_stream(at, buffer_size=1 << 20) as f:
                    for i in range(row["n_records"]):
                        doc_id, ids = unframe(f.read)
                        for c, v in zip(cols, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                            c.append(v)
                        start += len(ids)
                        if len(cols[0]) == READ_ROWS or i + 1 == row["n_records"]:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)
                            cols = ([], [], [], [])

    # one row a file: the running sum needs them together
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("first", F.coalesce(before, F.lit(0)))
    return files.repartition(max(1, manifest.count())).mapInArrow(read, DIGESTS)
