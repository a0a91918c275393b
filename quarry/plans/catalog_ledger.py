"""Registered queries for the ledger, per-file status, the ingest scan and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.text import basename, extension
from quarry.operators import ledger as L
from quarry.operators.chunking import chunk_sections
from quarry.operators.ingest import document_status, ingest
from quarry.operators.lexical import token_dims
from quarry.plans import oracle_sql as O
from quarry.plans.catalog import (ALL_SECTIONS_SQL, K, LEX_T, _conv_sections, _doc_chunks, _doc_sections,
                                  _prompt_sql, _t, register)
from quarry.session import scratch_dir
from quarry.sources import tables as TB

CUT = TB.HISTORY_CUTOFF

# ---------------------------------------------------------------- SQL pieces
_STATUS = ("CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'skipped_empty' "
           "ELSE 'success' END")
_ERROR = (f"CASE WHEN event_type = 'error' THEN 'error event ' || event_id "
          f"WHEN event_type = 'signup' THEN '{C.MSG_EMPTY}' END")


def _rows_sql(where: str) -> str:
    return f"""SELECT 'user_' || user_id || '.txt' AS file_path, ts AS last_modified, ts AS ingested_at,
         {_STATUS} AS status, {_ERROR} AS error_message, event_id AS seq
  FROM events WHERE {where}"""


HIST = _rows_sql(f"ts < TIMESTAMP '{CUT}' AND user_id % 5 <> 0")
UPD = _rows_sql(f"ts >= TIMESTAMP '{CUT}'")
LEDGER_CTES = f"""hist AS ({HIST}),
ledger AS (SELECT file_path, last_modified, ingested_at, status, error_message FROM (
   SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ingested_at DESC, seq DESC) AS r FROM hist) x WHERE r = 1),
listing AS (SELECT 'user_' || user_id || '.txt' AS file_path, user_id AS doc_id,
   CASE WHEN user_id % 2 = 1 THEN max(ts)
        ELSE coalesce(max(ts) FILTER (WHERE ts < TIMESTAMP '{CUT}'), max(ts)) END AS mtime
   FROM events WHERE user_id % 11 <> 3 GROUP BY user_id),
changes AS (
  SELECT coalesce(li.file_path, le.file_path) AS file_path, li.mtime, le.last_modified, le.status,
         CASE WHEN li.mtime IS NULL AND le.status IS NOT NULL THEN 'missing'
              WHEN le.status IS NULL THEN 'new'
              WHEN le.status <> 'success' THEN 'retry'
              WHEN li.mtime > le.last_modified THEN 'modified'
              ELSE 'unchanged' END AS reason
  FROM listing li FULL OUTER JOIN ledger le ON li.file_path = le.file_path)"""
EARLY = _rows_sql(f"ts < TIMESTAMP '{CUT}'")
ALL_ROWS = _rows_sql("true")


def _last_sql(rows: str) -> str:
    return f"""SELECT file_path, last_modified, ingested_at, status, error_message FROM (
   SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ingested_at DESC, seq DESC) AS r FROM ({rows}) h) x WHERE r = 1"""


UPSERTED = f"""ledger AS ({_last_sql(EARLY)}),
upd AS ({UPD}),
both_ AS (SELECT file_path, last_modified, ingested_at, status, error_message, 0 AS src, 0::BIGINT AS seq FROM ledger
          UNION ALL SELECT file_path, last_modified, ingested_at, status, error_message, 1 AS src, seq FROM upd),
upserted AS (SELECT file_path, last_modified, ingested_at, status, error_message FROM (
   SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY ingested_at DESC, src DESC, seq DESC) AS r FROM both_) y
   WHERE r = 1)"""


def _seconds_sql(ts: str) -> str:
    return f"(epoch_us({ts}) / 1000000)::DECIMAL(18,6)::VARCHAR"


def _json_sql(text: str) -> str:
    return f"coalesce(to_json({text})::VARCHAR, 'null')"


EXPORT_SQL = f"""SELECT file_path, '{{' || {_json_sql('file_path')} || ':{{"file_path":' || {_json_sql('file_path')}
    || ',"last_modified":' || {_seconds_sql('last_modified')} || ',"ingested_at":' || {_seconds_sql('ingested_at')}
    || ',"status":' || {_json_sql('status')} || ',"error_message":' || {_json_sql('error_message')} || '}}}}' AS json FROM ledger"""


def _fold(spark, rows):
    return L.upsert_ledger(spark.createDataFrame([], C.LEDGER), rows)


def _spark_ledger(spark, d):
    """The ledger that the change-detection cases are made from."""
    return _fold(spark, TB.ledger_history(_t(spark, d, "events")))


def _early_ledger(spark, d):
    ev = _t(spark, d, "events")
    return _fold(spark, TB.ledger_rows(ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp"))))


def _whole_ledger(spark, d):
    return _fold(spark, TB.ledger_rows(_t(spark, d, "events")))


# ---------------------------------------------------------------- ledger
@register("change_detect", sql=f"WITH {LEDGER_CTES}\nSELECT file_path, mtime, last_modified, status, reason FROM changes")
def q_change_detect(spark, d):
    ev = _t(spark, d, "events")
    return L.change_detect(TB.file_listing(ev), _spark_ledger(spark, d))


@register("files_to_ingest", sql=f"""WITH {LEDGER_CTES}
SELECT file_path, mtime, reason FROM changes WHERE reason IN ('new', 'retry', 'modified')""")
def q_files_to_ingest(spark, d):
    ev = _t(spark, d, "events")
    return L.files_to_ingest(L.change_detect(TB.file_listing(ev), _spark_ledger(spark, d))).select(
        "file_path", "mtime", "reason")


@register("missing_files", sql=f"""WITH {LEDGER_CTES}
SELECT * FROM ledger WHERE file_path NOT IN (SELECT file_path FROM listing)""")
def q_missing_files(spark, d):
    ev = _t(spark, d, "events")
    return L.missing_files(TB.file_listing(ev), _spark_ledger(spark, d))


@register("ledger_export", sql=f"WITH ledger AS ({_last_sql(ALL_ROWS)})\n{EXPORT_SQL}")
def q_ledger_export(spark, d):
    return L.export_ledger(_whole_ledger(spark, d))


@register("ledger_load", sql=_last_sql(ALL_ROWS))
def q_ledger_load(spark, d):
    """Export the ledger one entry per line, write it, read it back and parse."""
    path = scratch_dir(spark, "ledger-json")
    L.export_ledger(_whole_ledger(spark, d)).select("json").write.text(path)
    rows, _bad = L.read_ledger(spark, path)
    return rows


@register("ledger_quarantine", sql=f"""WITH ledger AS ({_last_sql(ALL_ROWS)}), lines AS ({EXPORT_SQL})
SELECT 'ledger' AS source, substring(json, 1, length(json) // 2) AS raw, 'unparseable ledger JSON' AS reason
FROM lines WHERE length(file_path) % 2 = 0""")
def q_ledger_quarantine(spark, d):
    """Lines cut off in the middle are quarantined one by one; the rest of the ledger loads."""
    path = scratch_dir(spark, "ledger-damaged")
    lines = L.export_ledger(_whole_ledger(spark, d))
    cut = F.length("file_path") % 2 == 0
    lines.select(F.when(cut, F.expr("substring(json, 1, length(json) div 2)")).otherwise(F.col("json"))).write.text(path)
    _rows, bad = L.read_ledger(spark, path)
    return bad


@register("ledger_upsert", sql=f"WITH {UPSERTED}\nSELECT * FROM upserted")
def q_ledger_upsert(spark, d):
    ev = _t(spark, d, "events")
    return L.upsert_ledger(_early_ledger(spark, d), TB.ledger_updates(ev))


@register("ledger_summary", sql=f"""WITH {UPSERTED}
SELECT status, count(*)::BIGINT AS n_files, max(ingested_at) AS last_ingested_at FROM upserted GROUP BY status""")
def q_ledger_summary(spark, d):
    return L.ledger_summary(q_ledger_upsert(spark, d)).select(
        "status", F.col("n_files").cast("bigint").alias("n_files"), "last_ingested_at")


@register("ledger_durations", sql=f"""WITH h AS ({ALL_ROWS}),
g AS (SELECT file_path, ingested_at, status,
             epoch_us(ingested_at) - epoch_us(lag(ingested_at) OVER (PARTITION BY file_path ORDER BY ingested_at, seq)) AS us
      FROM h)
SELECT file_path, ingested_at, status, ((us + 5000) // 10000) / 100.0 AS elapsed_s FROM g""")
def q_ledger_durations(spark, d):
    return L.ledger_durations(TB.ledger_rows(_t(spark, d, "events")))


# ---------------------------------------------------------------- status and ingest
_STATUS_FILES_SQL = f"""SELECT DISTINCT source_file, file_type FROM (
    SELECT source_file, file_type FROM ({ALL_SECTIONS_SQL}) s
    UNION ALL
    SELECT regexp_extract(url, '([^/]+)$', 1) AS source_file,
           regexp_extract(regexp_extract(url, '([^/]+)$', 1), '^\\.*[^.].*\\.([^.]*)$', 1) AS file_type FROM pages) f"""


@register("document_status", sql="WITH RECURSIVE " + O.chunk_ctes(ALL_SECTIONS_SQL) + f""",
files AS ({_STATUS_FILES_SQL}),
s AS (SELECT source_file, count(*) AS n_sections, bool_or({O.has_text('text')}) AS any_text
      FROM ({ALL_SECTIONS_SQL}) x GROUP BY source_file),
c AS (SELECT source_file, count(*) AS n_chunks FROM chunks GROUP BY source_file),
j AS (SELECT f.source_file, f.file_type, coalesce(s.n_sections, 0)::BIGINT AS n_sections,
             coalesce(c.n_chunks, 0)::BIGINT AS n_chunks, coalesce(c.n_chunks, 0)::BIGINT AS n_uploaded,
             coalesce(s.any_text, false) AS any_text
      FROM files f LEFT JOIN s ON s.source_file = f.source_file LEFT JOIN c ON c.source_file = f.source_file)
SELECT source_file, file_type, n_sections, n_chunks, n_uploaded,
       CASE WHEN file_type NOT IN ('pdf', 'txt') THEN 'failed'
            WHEN n_sections = 0 OR NOT any_text THEN 'skipped_empty'
            WHEN n_chunks = 0 THEN 'skipped_no_chunks'
            WHEN n_uploaded = n_chunks THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN file_type NOT IN ('pdf', 'txt') THEN 'No processor for type ''' || file_type || ''''
            WHEN n_sections = 0 OR NOT any_text THEN '{C.MSG_EMPTY}'
            WHEN n_chunks = 0 THEN '{C.MSG_NO_CHUNKS}'
            WHEN n_uploaded = n_chunks THEN NULL
            ELSE 'Mismatch in uploaded chunks count. Expected ' || n_chunks || ', got ' || n_uploaded || '.' END
            AS error_message
FROM j""")
def q_document_status(spark, d):
    sections = _doc_sections(spark, d).unionByName(_conv_sections(spark, d))
    pages = _t(spark, d, "pages").select(basename("url").alias("source_file"))
    files = (sections.select("source_file", "file_type")
             .unionByName(pages.select("source_file", extension("source_file").alias("file_type")))
             .distinct())
    chunks = chunk_sections(sections)
    return document_status(files, sections, chunks)


@register("upload_mismatch", sql="WITH RECURSIVE " + O.chunk_ctes(O.document_sections()) + f""",
c AS (SELECT source_file, count(*)::BIGINT AS n, count(*) FILTER (WHERE NOT (text_length % 5 = 0 AND chunk_index % 2 = 1))::BIGINT AS kept
      FROM chunks GROUP BY source_file)
SELECT 'doc_' || doc_id || '.txt' AS source_file, coalesce(n, 0)::BIGINT AS n_chunks, coalesce(kept, 0)::BIGINT AS n_uploaded,
       CASE WHEN n IS NULL THEN 'skipped_empty' WHEN n = kept THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN n IS NULL THEN '{C.MSG_EMPTY}' WHEN n <> kept
            THEN 'Mismatch in uploaded chunks count. Expected ' || n || ', got ' || kept || '.' END AS error_message
FROM documents LEFT JOIN c ON c.source_file = 'doc_' || doc_id || '.txt'""")
def q_upload_mismatch(spark, d):
    """An upload that loses points: the observed writes differ, and the files concerned fail with both counts."""
    from quarry.operators.ingest import upload_status
    base = scratch_dir(spark, "upload")

    def store(df, name):
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    sections = _doc_sections(spark, d)
    chunks = chunk_sections(sections)
    lost = (F.col("text_length") % 5 == 0) & (F.col("chunk_index") % 2 == 1)
    _points, status = upload_status(sections.select("source_file", "file_type"), sections, chunks, chunks.filter(~lost), store)
    return status.select("source_file", "n_chunks", "n_uploaded", "status", "error_message")


@register("number_sections", sql="""SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text)::BIGINT AS section_no,
       count(*) OVER (PARTITION BY conv_id)::BIGINT AS n_sections FROM conversations""")
def q_number_sections(spark, d):
    """Sections numbered by ranges and prefix counts: a file of any size is numbered by many tasks."""
    return TB.number_sections(_t(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", ["turn", "text"])


def _doc_loader(documents):
    def load(files):
        doc_id = F.regexp_extract("file_path", r"user_(\d+)\.txt$", 1).cast("bigint")
        f = files.withColumn("doc_id", doc_id)
        return f.join(documents.select("doc_id", "text"), "doc_id", "inner").select(
            "source_file", "file_path", "file_type", "mtime",
            F.lit(1).cast("bigint").alias("section_no"), F.lit(1).cast("bigint").alias("n_sections"), "text")
    return load


@register("ingest_scan", sql="WITH RECURSIVE " + LEDGER_CTES + ",\n" + O.chunk_ctes(
    f"""SELECT regexp_extract(c.file_path, '([^/]+)$', 1) AS source_file, c.file_path, 'txt' AS file_type,
               c.mtime, 1::BIGINT AS section_no, 1::BIGINT AS n_sections, d.text
        FROM changes c JOIN documents d ON d.doc_id = CAST(regexp_extract(c.file_path, 'user_(\\d+)\\.txt$', 1) AS BIGINT)
        WHERE c.reason IN ('new', 'retry', 'modified')""") + f""",
todo AS (SELECT file_path, reason, regexp_extract(file_path, '([^/]+)$', 1) AS source_file FROM changes
         WHERE reason IN ('new', 'retry', 'modified')),
has_doc AS (SELECT t.source_file, d.text IS NOT NULL AND {O.has_text('d.text')} AS ok
            FROM todo t LEFT JOIN documents d ON d.doc_id = CAST(regexp_extract(t.file_path, 'user_(\\d+)\\.txt$', 1) AS BIGINT)),
c AS (SELECT source_file, count(*) AS n_chunks FROM chunks GROUP BY source_file)
SELECT t.file_path, t.reason,
       CASE WHEN NOT h.ok THEN 'skipped_empty' WHEN coalesce(c.n_chunks, 0) = 0 THEN 'skipped_no_chunks'
            ELSE 'success' END AS status,
       coalesce(c.n_chunks, 0)::BIGINT AS n_chunks
FROM todo t JOIN has_doc h ON h.source_file = t.source_file LEFT JOIN c ON c.source_file = t.source_file""")
def q_ingest_scan(spark, d):
    """One incremental scan: ledger from events, file bodies from documents."""
    ev = _t(spark, d, "events")
    docs = _t(spark, d, "documents")
    empty_index = spark.createDataFrame([], C.CHUNKS)
    out = ingest(TB.file_listing(ev).drop("doc_id"), _spark_ledger(spark, d), _doc_loader(docs), empty_index)
    todo = L.files_to_ingest(out["changes"]).select("file_path", "reason")
    st = out["status"].select("source_file", "status", "n_chunks")
    return todo.withColumn("source_file", basename("file_path")).join(st, "source_file", "left").select(
        "file_path", "reason", "status", "n_chunks")


# Changes between the two scans of ``scan_lifecycle``: some files go, some turn blank, some grow.
_GONE, _BLANK, _GROWN, _MORE = 13, 11, 7, " and some more words"
_NEW_TEXT = f"CASE WHEN doc_id % {_BLANK} = 0 THEN '  ' WHEN doc_id % {_GROWN} = 0 THEN text || '{_MORE}' ELSE text END"


@register("scan_lifecycle", sql="WITH RECURSIVE " + O.chunk_ctes(
    f"""SELECT 'doc_' || doc_id || '.txt' AS source_file, 'txt' AS file_type, 1::BIGINT AS section_no, 1::BIGINT AS n_sections,
               {_NEW_TEXT} AS text FROM documents WHERE doc_id % {_GONE} <> 0
        UNION ALL SELECT source_file, file_type, section_no, n_sections, text FROM ({O.conversation_sections()}) cs""") + f""",
c AS (SELECT source_file, count(*)::BIGINT AS n FROM chunks GROUP BY source_file),
files AS (SELECT 'doc_' || doc_id || '.txt' AS source_file, doc_id % {_GONE} = 0 AS gone,
                 text IS NOT NULL AND {O.has_text('text')} AS was_ok,
                 doc_id % {_BLANK} = 0 OR doc_id % {_GROWN} = 0 AS touched FROM documents
          UNION ALL SELECT 'conv_' || conv_id || '.pdf', false, bool_or({O.has_text('text')}), false FROM conversations GROUP BY conv_id)
SELECT f.source_file, CASE WHEN gone THEN 'missing' WHEN NOT was_ok THEN 'retry' WHEN touched THEN 'modified' ELSE 'unchanged' END AS reason,
       CASE WHEN gone THEN NULL WHEN n IS NULL THEN 'skipped_empty' ELSE 'success' END AS status,
       coalesce(n, 0)::BIGINT AS n_points, CASE WHEN n IS NOT NULL THEN 2::BIGINT END AS dim
FROM files f LEFT JOIN c ON c.source_file = f.source_file
UNION ALL SELECT '(cleared)', 'cleared', NULL, 0, NULL""")
def q_scan_lifecycle(spark, d):
    """All documents as text files and all conversations as paged files: listed, scanned, changed
    and scanned again with a user's loader and embedder; then the state is cleared."""
    from quarry.operators import scan as SC
    from quarry.sources.files import sections_loader, text_loader, write_files
    base = scratch_dir(spark, "lifecycle")
    dirs = {".txt": base + "/texts", ".pdf": base + "/papers"}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = _t(spark, d, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name")
    pages = _conv_sections(spark, d)
    write_files(docs.select(name, F.coalesce("text", F.lit("")).alias("content")).repartition(parts, "name"), dirs[".txt"])
    write_files(pages.select(F.col("source_file").alias("name")).distinct().withColumn("content", F.lit("%PDF")), dirs[".pdf"])
    loaders = {"txt": text_loader(spark, dirs[".txt"]), "pdf": sections_loader(pages)}

    def embed(chunks):
        return chunks.withColumn("vector", F.array(F.col("text_length").cast("float"), F.col("chunk_index").cast("float")))

    SC.run_scan(spark, dirs, base + "/state", loaders, embed=embed, index_buckets=8, ledger_buckets=4)
    text = (F.when(F.col("doc_id") % _GONE == 0, F.lit(None)).when(F.col("doc_id") % _BLANK == 0, F.lit("  "))
            .otherwise(F.concat("text", F.lit(_MORE))))
    changed = docs.filter((F.col("doc_id") % _GONE == 0) | (F.col("doc_id") % _BLANK == 0) | (F.col("doc_id") % _GROWN == 0))
    write_files(changed.select(name, text.alias("content")).repartition(parts, "name"), dirs[".txt"])
    run = SC.run_scan(spark, dirs, base + "/state", loaders, embed=embed, index_buckets=8, ledger_buckets=4)
    points = run["index"].groupBy("source_file").agg(F.count(F.lit(1)).alias("n_points"), F.max(F.size("vector")).cast("bigint").alias("dim"))
    ledger = run["ledger"].select(basename("file_path").alias("source_file"), F.col("status").alias("now"))
    out = (run["changes"].select(basename("file_path").alias("source_file"), "reason").join(ledger.hint("merge"), "source_file", "left")
           .join(points, "source_file", "left")
           .select("source_file", "reason", F.col("now").alias("status"), F.coalesce("n_points", F.lit(0)).cast("bigint").alias("n_points"), "dim"))
    out.write.parquet(base + "/report")
    SC.clear_all(spark, base + "/state")
    left = SC.read_state_index(spark, base + "/state").count() + SC.read_state_ledger(spark, base + "/state").count()
    cleared = spark.range(1).select(F.lit("(cleared)").alias("source_file"), F.lit("cleared").alias("reason"),
                                    F.lit(None).cast("string").alias("status"), F.lit(left).cast("bigint").alias("n_points"),
                                    F.lit(None).cast("bigint").alias("dim"))
    return spark.read.parquet(base + "/report").unionByName(cleared)


# ---------------------------------------------------------------- streams
@register("stream_ingest", sql=f"WITH {UPSERTED}\nSELECT * FROM upserted")
def q_stream_ingest(spark, d):
    """Ledger writes arrive as a file stream; each micro-batch is folded into the ledger."""
    from quarry.streaming.incremental import read_ledger, stream_ledger
    ev = _t(spark, d, "events")
    base = scratch_dir(spark, "ledger-stream")
    ev.repartition(4, "event_id").write.parquet(base + "/in")          # several files, several micro-batches
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in")
    stream_ledger(spark, src, TB.ledger_rows, base + "/table", base + "/_checkpoint", buckets=8)
    return read_ledger(spark, base + "/table")


# Versions that arrive one after another in ``stream_replace``: every document, then some blank, grown or unreadable.
_VERSIONS = f"""SELECT doc_id, CASE WHEN doc_id % {_BLANK} = 0 THEN '  ' WHEN doc_id % {_GROWN} = 0 THEN text || '{_MORE}' ELSE text END AS text,
  doc_id % {_GONE} = 0 AND doc_id % {_BLANK} <> 0 AND doc_id % {_GROWN} <> 0 AS broken FROM documents"""


@register("stream_replace", sql="WITH RECURSIVE v AS (" + _VERSIONS + "),\n" + O.chunk_ctes(
    """SELECT 'doc_' || doc_id || '.txt' AS source_file, 'txt' AS file_type, 1::BIGINT AS section_no, 1::BIGINT AS n_sections, text FROM v""") + f""",
c AS (SELECT source_file, count(*)::BIGINT AS n, sum(text_length)::BIGINT AS total FROM chunks GROUP BY source_file)
SELECT 'doc_' || doc_id || '.txt' AS source_file,
       CASE WHEN broken THEN 'failed' WHEN v.text IS NULL OR NOT {O.has_text('v.text')} THEN 'skipped_empty' ELSE 'success' END AS status,
       CASE WHEN broken THEN 'unreadable' WHEN v.text IS NULL OR NOT {O.has_text('v.text')} THEN '{C.MSG_EMPTY}' END AS error_message,
       coalesce(c.n, 0)::BIGINT AS n_points, coalesce(c.total, 0)::BIGINT AS total_length
FROM v LEFT JOIN c ON c.source_file = 'doc_' || doc_id || '.txt'""")
def q_stream_replace(spark, d):
    """File versions arrive as a stream: points and ledger after all micro-batches.  A file that
    cannot be read any more keeps its old points and is marked failed."""
    from quarry.operators.scan import read_state_index, read_state_ledger
    from quarry.streaming.incremental import stream_files
    base = scratch_dir(spark, "file-stream")
    docs = _t(spark, d, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_path")
    blank, grown, broken = (F.col("doc_id") % m == 0 for m in (_BLANK, _GROWN, _GONE))
    first = docs.select(name, F.lit("2024-01-01").cast("timestamp").alias("mtime"), "text", F.lit(None).cast("string").alias("read_error"))
    text = F.when(blank, F.lit("  ")).when(grown, F.concat("text", F.lit(_MORE)))
    later = docs.filter(blank | grown | broken).select(
        name, F.lit("2024-01-02").cast("timestamp").alias("mtime"), text.alias("text"),
        F.when(broken & ~blank & ~grown, F.lit("unreadable")).alias("read_error"))
    schema = first.schema
    for part in (first, later, first.filter(F.length("file_path") % 2 == 0)):            # the last: old versions come late
        part.write.mode("append").parquet(base + "/in")
        src = spark.readStream.schema(schema).parquet(base + "/in")
        stream_files(spark, src, base + "/state", base + "/_checkpoint", index_buckets=8, ledger_buckets=4)
    points = read_state_index(spark, base + "/state").groupBy("source_file").agg(
        F.count("*").alias("n_points"), F.sum("text_length").alias("total_length"))
    return (read_state_ledger(spark, base + "/state").select(F.col("file_path").alias("source_file"), "status", "error_message")
            .join(points, "source_file", "left")
            .select("source_file", "status", "error_message", F.coalesce("n_points", F.lit(0)).cast("bigint").alias("n_points"),
                    F.coalesce("total_length", F.lit(0)).cast("bigint").alias("total_length")))


@register("stream_retrieve", sql=_prompt_sql())
def q_stream_retrieve(spark, d):
    """Questions arrive as a file stream and are answered against the stored chunk table."""
    from quarry.streaming.incremental import stream_answers
    base = scratch_dir(spark, "retrieve-stream")
    _doc_chunks(spark, d).withColumn("terms", token_dims("text")).write.parquet(base + "/chunks")
    chunks = spark.read.parquet(base + "/chunks")
    bm = _t(spark, d, "benchmark")
    src = (spark.readStream.schema(bm.schema).option("pathGlobFilter", "benchmark.parquet").parquet(d)
           .select(F.col("item_id").cast("bigint").alias("query_id"), "text"))
    stream_answers(spark, src, chunks, base + "/prompts", base + "/_checkpoint", K, LEX_T)
    return spark.read.parquet(base + "/prompts").drop("epoch")
