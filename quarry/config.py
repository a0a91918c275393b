"""Parameters and table schemas.

Fixed values that must equal the original system's for identical results are
collected in one block below; everything else is ours.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original system's) ------------------------
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
SEPARATORS = ("\n\n", "\n", " ", "")
VECTOR_DIM = 384
TOP_K = 3
SCORE_THRESHOLD = 0.7
FILE_TYPES = ("pdf", "txt")
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATUS_SKIPPED_EMPTY = "skipped_empty"
STATUS_SKIPPED_NO_CHUNKS = "skipped_no_chunks"
MSG_EMPTY = "No text extracted or extracted text was empty."
MSG_NO_CHUNKS = "No chunks generated from extracted text."
MSG_NO_PROCESSOR = "No processor for type '{}'"
MSG_MISMATCH = "Mismatch in uploaded chunks count. Expected {}, got {}."
STOP_WORDS = ("exit", "quit")
SYSTEM_MESSAGE = (
    "You are a helpful AI assistant specialized in providing concise and informative "
    "answers based on provided context. If the answer is not available in the context, "
    "clearly state that you don't have enough information."
)
PROMPT_HEAD = (
    "You are an AI assistant that answers questions based on the provided context.\n"
    "If the answer is not available in the context, clearly state that you don't have "
    "enough information.\n\nContext:\n"
)
PROMPT_QUERY = "\n\nQuery: "
PROMPT_TAIL = "\n\nAnswer:"
NO_HIT_PROMPT_HEAD = "Answer the following query: "
NO_HIT_PROMPT_TAIL = ". If you don't have enough information, state so clearly."
EMPTY_CONTEXT_PROMPT = "Query: {}\n\nNo relevant information was found in the knowledge base."
SOURCE_UNKNOWN = "Unknown"
# Characters Python's str.strip() removes: derived by rule from str.isspace().
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# -----------------------------------------------------------------------------

# Our own parameters.
LEXICAL_DIM = VECTOR_DIM          # hashed lexical vectors use the same width
DENSE_TEST_THRESHOLD = 0.2        # embeddings never reach 0.7 in the driver tables
LEXICAL_TEST_THRESHOLD = 0.3
SCORE_DECIMALS = 6                # scores are reported rounded (engines sum in different orders)
# Upper bound, in bytes, for a query block shipped to every executor.
MAX_BROADCAST_QUERY_BYTES = 64 * 1024 * 1024

SECTIONS = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("section_no", T.LongType()),
    T.StructField("n_sections", T.LongType()),
    T.StructField("text", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("page_number", T.LongType()),
    T.StructField("chunk_index", T.LongType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("text_length", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("point_id", T.DecimalType(20, 0)),
])

POINTS = T.StructType(CHUNKS.fields + [
    T.StructField("vector", T.ArrayType(T.FloatType())),
    T.StructField("terms", T.ArrayType(T.IntegerType())),      # lexical buckets, hashed once at ingest
])

LEDGER = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

LEDGER_JSON_ENTRY = (
    "struct<file_path:string,last_modified:double,ingested_at:double,"
    "status:string,error_message:string>"
)

QUERIES = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("text", T.StringType()),
])
