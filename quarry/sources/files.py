"""File sources: folder listings, whole-text reads, and the format registry.

* listing: ``binaryFile`` with a case-sensitive suffix glob, non-recursive; the
  ``content`` column is never selected, so no file body is read.
* large local folders: Spark's reader holds the status of every file on the driver, so a
  folder of more than ``DRIVER_FILES`` entries is listed, and its wanted files read, by tasks.
* text read: bytes are decoded only when valid UTF-8; invalid files become a
  ``read_error`` row (the job never aborts, nothing is silently replaced by
  U+FFFD).  Universal newlines as in Python's text mode.
* registry: ``{file_type: loader}``; every loader returns the sections schema.
* writers: tasks write files under given names through the file system of the
  folder's URI (test inputs and exports).
"""

from __future__ import annotations

import itertools
import os
import re
import stat
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import basename, extension, normalise_newlines

MTIME_SPANS = 32           # spans of modification times in one scan's filter
READ_WAVES = 4             # tasks of a folder scan for every shuffle partition or core
DRIVER_FILES = 20_000      # entries of a folder that Spark's reader may list (1 KB of the driver's heap each, more when read); larger ones go to tasks
BATCH_FILES, BATCH_BYTES = 256, 4 << 20      # files of a batch that a task reads, and bytes after which it ends early


def _few_tasks(files: DataFrame) -> DataFrame:
    """A folder scan in tasks whose number does not grow with the files: Spark deals some 32 small files to a
    task (and one output file), however many there are.  No shuffle; a task streams its files."""
    spark = files.sparkSession
    return files.coalesce(READ_WAVES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _large_folder(spark: SparkSession, folder: str, suffix: str) -> str | None:
    """The qualified URI of a local (or mounted) folder of more than ``DRIVER_FILES`` entries, else None:
    Spark's reader takes the others, stores that only it opens, and patterns.  Counts no further than that."""
    if re.search(r"[{}\[\]*?\\]", folder + suffix):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if not re.match(r"file:/(?!/)", uri):
        return None
    try:
        with os.scandir(uri.removeprefix("file:")) as entries:
            return uri.rstrip("/") if next(itertools.islice(entries, DRIVER_FILES, None), None) is not None else None
    except OSError:                                           # the reader says what is wrong with it
        return None


def _is_listed(name: str, suffix: str) -> bool:
    """What Spark's reader lists by name: not hidden, and of a name that can be written in UTF-8."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return name.endswith(suffix) and not hidden and name.encode("utf-8", "surrogateescape") == name.encode("utf-8", "replace")


def _status(path: str) -> os.stat_result | None:
    """The status of a file that holds something (Spark's reader lists no others), else None."""
    try:
        found = os.stat(path)
    except (FileNotFoundError, NotADirectoryError):
        return None
    return found if stat.S_ISREG(found.st_mode) and found.st_size else None


def _micros(found: os.stat_result) -> int:
    return found.st_mtime_ns // 1_000_000 * 1000              # whole milliseconds, as Hadoop gives them


def _list_in_tasks(spark: SparkSession, uri: str, suffix: str) -> DataFrame:
    """The rows of ``list_files`` for a large folder: one task streams its names, many take their status."""
    folder = uri.removeprefix("file:") + "/"

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                with os.scandir(folder) as entries:
                    found = (e.name for e in entries if _is_listed(e.name, suffix))
                    while some := list(itertools.islice(found, 10_000)):
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["name"])

    def statuses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, st) for name in batch.column(0).to_pylist() if (st := _status(folder + name)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.string()), pa.array([_micros(st) for _, st in found], pa.int64()),
                                              pa.array([st.st_size for _, st in found], pa.int64())], ["name", "us", "length"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = (spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition(parts, "name")
            .mapInArrow(statuses, "name string, us bigint, length bigint").withColumn("path", F.concat(F.lit(uri + "/"), "name")))
    name = basename("path")
    return rows.select(F.col("path").alias("file_path"), name.alias("source_file"), extension(name).alias("file_type"),
                       F.timestamp_micros("us").alias("mtime"), "length")


def _read_in_tasks(files: DataFrame, uris: list[str], suffix: str) -> DataFrame:
    """``(path, modificationTime, content)`` of the files of these large folders that ``files`` names, as they
    stand now; what has gone or become empty meanwhile has no row."""
    spark = files.sparkSession
    within = {uri + "/" for uri in uris}

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stored(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.binary()))], ["path", "us", "content"])

        for batch in batches:
            rows, size = [], 0
            for uri in batch.column(0).to_pylist():
                cut = uri.rfind("/") + 1
                path = uri.removeprefix("file:")
                if uri[:cut] not in within or not _is_listed(uri[cut:], suffix) or _status(path) is None:
                    continue
                try:
                    with open(path, "rb") as f:
                        found, content = os.fstat(f.fileno()), f.read()
                except FileNotFoundError:
                    continue
                if not content:
                    continue
                rows.append((uri, _micros(found), content))
                size += len(content)
                if len(rows) == BATCH_FILES or size >= BATCH_BYTES:
                    yield stored(rows)
                    rows, size = [], 0
            yield stored(rows)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    wanted = files.select("file_path").filter(F.col("file_path").isNotNull()).repartition(parts, "file_path").distinct()
    return wanted.mapInArrow(bodies, "path string, us bigint, content binary").select(
        "path", F.timestamp_micros("us").alias("modificationTime"), "content")


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``(file_path, source_file, file_type, mtime, length)`` for ``folder/*<suffix>``."""
    large = _large_folder(spark, folder, suffix)
    if large:
        return _list_in_tasks(spark, large, suffix)
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", "false")
          .load(folder)
          .select("path", "modificationTime", "length"))
    name = basename("path")
    return _few_tasks(df.select(F.col("path").alias("file_path"), name.alias("source_file"),
                                extension(name).alias("file_type"),
                                F.col("modificationTime").alias("mtime"), F.col("length")))


def list_folders(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Union of listings, e.g. ``{'.pdf': pdf_dir, '.txt': txt_dir}``."""
    out = None
    for suffix, folder in folders.items():
        df = list_files(spark, folder, suffix)
        out = df if out is None else out.unionByName(df)
    return out


def read_text_files(spark: SparkSession, paths: list[str] | str, recursive: bool = False,
                    suffix: str | None = None, min_mtime=None, spans: list[tuple] | None = None) -> DataFrame:
    """Whole-file text sections ``(file_path, source_file, file_type, mtime, section_no,
    n_sections, text, read_error)``.

    ``min_mtime`` and ``spans`` (``(first, last)`` modification times, None for no end) are pushed into the
    ``binaryFile`` reader, which then skips the bodies of all other files entirely.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    raw = reader.load(paths)
    if min_mtime is not None:
        raw = raw.filter(F.col("modificationTime") >= F.lit(min_mtime))
    if spans is not None:
        at = F.col("modificationTime")
        within = [at >= F.lit(lo) if hi is None else (at >= F.lit(lo)) & (at <= F.lit(hi)) for lo, hi in spans]
        raw = raw.filter(reduce(lambda a, b: a | b, within, F.lit(False)))
    return _few_tasks(_text_sections(raw))


def _text_sections(raw: DataFrame) -> DataFrame:
    decoded = F.col("content").cast("string")
    valid = F.is_valid_utf8(decoded)
    name = basename("path")
    return raw.select(
        F.col("path").alias("file_path"), name.alias("source_file"), extension(name).alias("file_type"),
        F.col("modificationTime").alias("mtime"),
        F.lit(1).cast("bigint").alias("section_no"), F.lit(1).cast("bigint").alias("n_sections"),
        F.when(valid, normalise_newlines(decoded)).alias("text"),
        F.when(~valid, F.lit("'utf-8' codec can't decode the file")).alias("read_error"))


def mtime_spans(days: list[tuple], most: int = MTIME_SPANS) -> list[tuple]:
    """At most ``most`` spans that cover the given ones, joined over the smallest gaps; the last has
    no end, so a file that is written again after the listing is still read."""
    spans = sorted(days)
    while len(spans) > most:
        gap = [b[0] - a[1] for a, b in zip(spans, spans[1:])]
        i = gap.index(min(gap))
        spans[i:i + 2] = [(spans[i][0], max(spans[i][1], spans[i + 1][1]))]
    return [*spans[:-1], (spans[-1][0], None)] if spans else []


def text_loader(spark: SparkSession, folders: list[str] | str, suffix: str = ".txt") -> Callable[[DataFrame], DataFrame]:
    """Loader for text files of ``folders`` named by a files DataFrame.

    No path list goes through the driver: the folders are scanned with the spans of
    modification times of the wanted files pushed into the reader (bodies outside are never
    read, so one old file that fails on every scan costs its own day) and the wanted files
    are kept by a semi-join on the path.  Of large local folders (``DRIVER_FILES``), tasks open
    the wanted files and no others.
    """
    def load(files: DataFrame) -> DataFrame:
        named = [folders] if isinstance(folders, str) else folders
        large = {folder: uri for folder in named if (uri := _large_folder(spark, folder, suffix))}
        if large:
            read = _text_sections(_read_in_tasks(files, list(large.values()), suffix))
            rest = [folder for folder in named if folder not in large]
            return read.unionByName(scan(files, rest)) if rest else read
        return scan(files, folders)

    def scan(files: DataFrame, folders: list[str] | str) -> DataFrame:
        days = files.filter(F.col("mtime").isNotNull()).groupBy(F.to_date("mtime")).agg(F.min("mtime").alias("lo"), F.max("mtime").alias("hi"))
        spans = mtime_spans([(r.lo, r.hi) for r in days.collect()])                 # a row a day
        if not spans:
            from quarry.config import SECTIONS
            return spark.createDataFrame([], SECTIONS).withColumn("read_error", F.lit(None).cast("string"))
        df = read_text_files(spark, folders, suffix=suffix, spans=spans)
        return df.join(files.select("file_path"), "file_path", "left_semi")
    return load


def sections_loader(sections: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Loader for paged documents whose pages stand ready in a table.

    ``sections`` holds ``source_file, section_no, n_sections, text``; a listed file
    without any row there fails with a message.
    """
    def load(files: DataFrame) -> DataFrame:
        pages = sections.select("source_file", "section_no", "n_sections", "text")
        joined = files.select("source_file", "file_path", "file_type", "mtime").join(pages, "source_file", "left")
        return joined.withColumn("read_error", F.when(F.col("section_no").isNull(), F.lit("no sections for the file")))
    return load


def file_system(uri: str):
    """``(pyarrow file system, path)``; plain paths and ``file:`` URIs are local or mounted folders."""
    from pyarrow import fs
    local = re.match(r"(?:file:)?/+(.*)", uri)
    return (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(uri)


def write_files(files: DataFrame, folder: str) -> int:
    """Write ``(name, content)`` rows as files of ``folder``; NULL content deletes the file.

    Writing again gives the same file, so a repeated task does no harm.  Returns the
    number of files handled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(folder)
        fs.create_dir(at, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{at}/{name}"
                if content is not None:
                    with fs.open_output_stream(path) as out:
                        out.write(content)
                elif fs.get_file_info(path).is_file:
                    fs.delete_file(path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = files.select(F.col("name").cast("string"), F.col("content").cast("binary"))
    return rows.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def registry(loaders: dict[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    """Dispatch files by ``file_type`` to their loader; unknown types get no sections."""
    def load(files: DataFrame) -> DataFrame:
        out = None
        for ftype, fn in loaders.items():
            df = fn(files.filter(F.col("file_type") == ftype))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out
    return load
