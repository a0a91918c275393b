"""Sections -> chunks (the splitter as one Arrow UDF, everything else on the JVM).

Plan shape: scan -> filter blank sections -> sections of one chunk on the JVM, longer ones
spread -> Arrow UDF -> posexplode; then metadata columns -> point id.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import CHUNK_OVERLAP, CHUNK_SIZE
from quarry.functions.hashing import point_id
from quarry.functions.text import extension, has_text, py_strip
from quarry.operators.common import spread
from quarry.operators.splitter import split_text

SLICE = 256


@functools.lru_cache(maxsize=None)
def chunk_udf(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP):
    """Arrow UDF ``string -> array<string>``; never raises (NULL text gives no chunks)."""

    @F.arrow_udf("array<string>")
    def _chunks(texts: pa.Array) -> pa.Array:
        # a batch holds up to 10,000 texts: only a slice of them is ever held as Python strings
        parts = [pa.array([split_text(t, size, overlap) for t in texts.slice(i, SLICE).to_pylist()],
                          type=pa.list_(pa.string())) for i in range(0, len(texts), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], type=pa.list_(pa.string()))

    return _chunks


def is_multi_page(n_sections="n_sections", file_type="file_type", text="text"):
    """More than one section, or one PDF section that holds a blank line."""
    n, ft, tx = F.col(n_sections), F.col(file_type), F.col(text)
    return (n > 1) | ((n == 1) & (ft == F.lit("pdf")) & F.contains(tx, F.lit("\n\n")))


def chunk_sections(sections: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunk table from ``sections(source_file, [file_type], section_no, n_sections, text)``.

    Blank sections are dropped after numbering, so later page numbers are kept.
    """
    s = sections
    if "file_type" not in s.columns:
        s = s.withColumn("file_type", extension("source_file"))
    s = (s.select("source_file", "file_type", "section_no", "n_sections", "text")
          .filter(has_text("text"))
          .withColumn("_multi", is_multi_page()))
    # a section within one chunk is its own chunk, stripped; only longer ones go through Python
    cols = ["source_file", "file_type", "section_no", "_multi"]
    short = s.filter(F.length("text") <= size).select(*cols, F.lit(0).alias("chunk_index"), py_strip("text").alias("text"))
    long_ = spread(s.filter(F.length("text") > size), "source_file", "section_no").select(
        *cols, F.posexplode(chunk_udf(size, overlap)(F.col("text"))).alias("chunk_index", "text"))
    exploded = short.unionByName(long_)
    page = F.when(F.col("_multi"), F.col("section_no").cast("bigint"))
    j = F.col("chunk_index").cast("bigint")
    chunk_id = F.when(
        F.col("_multi"),
        F.concat(F.col("source_file"), F.lit("_p"), F.col("section_no").cast("string"), F.lit("_"), j.cast("string")),
    ).otherwise(F.concat(F.col("source_file"), F.lit("_"), j.cast("string")))
    return exploded.select(
        "source_file", "file_type",
        page.alias("page_number"),
        j.alias("chunk_index"),
        chunk_id.alias("chunk_id"),
        F.length("text").cast("bigint").alias("text_length"),
        "text",
        point_id("source_file", page, j).alias("point_id"),
    )


def n_fixed_windows(n, width: int, stride: int):
    """Number of fixed windows for a string of length ``n`` (0 for empty)."""
    return F.when(n <= 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.ceil((n - F.lit(width - stride)) / F.lit(stride))).cast("int"))


def chunk_fixed(df: DataFrame, key: str, text: str = "text", width: int = CHUNK_SIZE,
                overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """The splitter's last level in closed form: windows of ``width`` every ``width-overlap``."""
    stride = width - overlap
    n = F.length(F.col(text))
    idx = F.sequence(F.lit(0), n_fixed_windows(n, width, stride) - 1)
    return (df.filter(F.length(F.col(text)) > 0)
              .select(key, text, F.explode(idx).alias("window_index"))
              .select(key, F.col("window_index").cast("bigint").alias("window_index"),
                      F.substring(F.col(text), F.col("window_index") * stride + 1, F.lit(width)).alias("text"))
              .withColumn("text_length", F.length("text").cast("bigint")))


def split_pieces(df: DataFrame, key: str, text: str = "text", sep: str = "\n") -> DataFrame:
    """Separator split that keeps the separator at the front of every later piece."""
    pattern = "(?=" + sep.replace("\\", "\\\\") + ")"
    return (df.select(key, F.posexplode(F.split(F.col(text), pattern)).alias("piece_no", "piece"))
              .filter(F.length("piece") > 0)
              .select(key, F.col("piece_no").cast("bigint").alias("piece_no"), "piece",
                      F.length("piece").cast("bigint").alias("piece_length")))


def chunks_per_file(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_chunks"))
