"""A stream source that sees overwritten files (Spark's own file source delivers a path once).

    spark.dataSource.register(ChangedFiles)
    spark.readStream.format("changed_files").option("folder", d).option("suffix", ".txt").load()

Rows are ``(file_path, mtime, content)``, one for each file that is new or was written since
the last batch.  The offset is the newest modification time seen and the paths that have it,
so a file written within the same tick is still delivered, and nothing twice.  A batch's files
are dealt by size over partitions that executors read on their own; the driver only lists.  A
file that was overwritten again or removed between listing and reading is delivered as it
stands (or not at all), and its newer version comes with the next batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quarry.sources.files import file_system

PARTITION_BYTES = 32 * 1024 * 1024


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class ChangedFilesReader(DataSourceStreamReader):
    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix = folder, suffix

    def _listed(self) -> list[tuple[int, str, int]]:
        from pyarrow import fs
        system, at = file_system(self.folder)
        found = system.get_file_info(fs.FileSelector(at, recursive=False, allow_not_found=True))
        return sorted((f.mtime_ns, f.path, f.size) for f in found if f.is_file and f.base_name.endswith(self.suffix))

    def initialOffset(self) -> dict:
        return {"mtime_ns": -1, "paths": []}

    def latestOffset(self) -> dict:
        files = self._listed()
        newest = files[-1][0] if files else -1
        return {"mtime_ns": newest, "paths": [p for m, p, _ in files if m == newest]}

    @staticmethod
    def _after(start: dict, mtime: int, path: str) -> bool:
        return mtime > start["mtime_ns"] or (mtime == start["mtime_ns"] and path not in start["paths"])

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        groups, size = [[]], 0
        for mtime, path, length in self._listed():
            # what was written again after `end` is left to the next batch
            if not self._after(start, mtime, path) or self._after(end, mtime, path):
                continue
            if size + length > PARTITION_BYTES and groups[-1]:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += length
        return [Files(g) for g in groups if g]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        import datetime as dt
        from pyarrow import fs
        system, _ = file_system(self.folder)
        for path in partition.paths:
            info = system.get_file_info(path)
            if info.type != fs.FileType.File:
                continue
            with system.open_input_stream(path) as f:
                content = f.read()
            mtime = dt.datetime.fromtimestamp(info.mtime_ns // 1000 / 1e6, dt.timezone.utc)
            yield (path, mtime, content)

    def commit(self, end: dict) -> None:
        pass


class ChangedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changed_files"

    def schema(self) -> str:
        return "file_path string, mtime timestamp, content binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ChangedFilesReader(self.options["folder"], self.options.get("suffix", ".txt"))


def text_events(files):
    """``(file_path, mtime, text, read_error)`` of a (streaming) table of file contents."""
    from pyspark.sql import functions as F

    from quarry.sources.files import normalise_newlines
    decoded = F.col("content").cast("string")
    valid = F.is_valid_utf8(decoded)
    return files.select("file_path", "mtime", F.when(valid, normalise_newlines(decoded)).alias("text"),
                        F.when(~valid, F.lit("'utf-8' codec can't decode the file")).alias("read_error"))
