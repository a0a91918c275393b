"""The registered queries: one Spark plan per operator, each beside its DuckDB oracle.

Every query reads the driver tables in ``sf_dir`` (or data Spark derives from
them) over whole tables.  Column names and types match the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions import vectors as V
from quarry.functions.hashing import hash_u64, point_key
from quarry.functions.text import basename, extension, preview
from quarry.operators import index as IX
from quarry.operators.ann import ivf_topk, mean_vectors
from quarry.operators.chunking import chunk_fixed, chunk_sections, chunks_per_file, split_pieces
from quarry.operators.lexical import lexical_vectors, token_dims
from quarry.operators.prompts import build_prompts
from quarry.operators.search import HIT_PAYLOAD, dense_retrieve, lexical_retrieve
from quarry.plans import oracle_sql as O
from quarry.sources import tables as TB
from quarry.sources.queries import normalise_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

K = C.TOP_K
LEX_T = C.LEXICAL_TEST_THRESHOLD
DENSE_T = C.DENSE_TEST_THRESHOLD
DENSE_DIM = 64            # width of the driver's embeddings table
ALT_SIZE, ALT_OVERLAP = 300, 30   # second chunking used as the "new version" of documents
IVF_NPROBE = 3
TRAINED_LISTS, TRAINED_PROBES = 16, (4, 12)      # the driver's vectors have no clusters: 0.9 takes most lists


def report_types(df: DataFrame) -> DataFrame:
    """Types every consumer reads the same way: instants as naive UTC wall-clock
    values (the oracle's TIMESTAMP) and uint64 ids (DECIMAL(20,0)) as their exact
    decimal digits, which no float or pandas conversion can round."""
    from pyspark.sql import types as T

    def conv(f):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0:
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)
    return df.select(*[conv(f) for f in df.schema.fields])


def report_sql(sql: str, id_cols: tuple[str, ...]) -> str:
    """The oracle side of ``report_types`` for the given uint64 id columns."""
    if not id_cols:
        return sql
    repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in id_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) reported"


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn):
        def query(spark, d):
            return report_types(fn(spark, d))
        query.__name__, query.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = report_sql(sql.strip(), ids)
        return fn
    return deco


def _t(spark, d, name):
    return TB.read_table(spark, d, name)


def _doc_sections(spark, d):
    return TB.document_sections(_t(spark, d, "documents"))


def _conv_sections(spark, d):
    return TB.conversation_sections(_t(spark, d, "conversations"))


def _doc_chunks(spark, d, size=C.CHUNK_SIZE, overlap=C.CHUNK_OVERLAP):
    return chunk_sections(_doc_sections(spark, d), size, overlap)


def _all_chunks(spark, d):
    return chunk_sections(_doc_sections(spark, d).unionByName(_conv_sections(spark, d)))


def _queries(spark, d):
    return TB.benchmark_queries(_t(spark, d, "benchmark"))


# --- SQL building blocks -------------------------------------------------------

ALL_SECTIONS_SQL = f"{O.document_sections()}\nUNION ALL\n{O.conversation_sections()}"
DOC_CHUNKS = "WITH RECURSIVE " + O.chunk_ctes(O.document_sections())
ALL_CHUNKS = "WITH RECURSIVE " + O.chunk_ctes(ALL_SECTIONS_SQL)
TOKEN_RE = r"[^\p{L}\p{N}]+"


def _bucket_sql(w: str, dim: int = C.LEXICAL_DIM) -> str:
    return f"(('0x' || substr(md5({w}), 1, 8))::BIGINT % {dim})"


def _tokens_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, {_bucket_sql('w')} AS dim
  FROM (SELECT {key}, unnest(regexp_split_to_array(lower(text), '{TOKEN_RE}')) AS w FROM {table}) tw
  WHERE w <> ''"""


QUERY_NORM_SQL = f"""SELECT item_id::BIGINT AS query_id, {O.strip('text')} AS text FROM benchmark
  WHERE {O.has_text('text')} AND lower({O.strip('text')}) NOT IN ('exit', 'quit')"""


def _lexical_hits_ctes(t: float = LEX_T, k: int = K) -> str:
    """CTEs (after the chunk CTEs) ending in ``hits``."""
    return f""",
qn AS ({QUERY_NORM_SQL}),
tok_c AS ({_tokens_sql('chunks', 'point_id')}),
vec_c AS (SELECT point_id, dim, count(*) AS tf FROM tok_c GROUP BY point_id, dim),
norm_c AS (SELECT point_id, sum(tf * tf) AS n2 FROM vec_c GROUP BY point_id),
tok_q AS ({_tokens_sql('qn', 'query_id')}),
vec_q AS (SELECT query_id, dim, count(*) AS tf FROM tok_q GROUP BY query_id, dim),
norm_q AS (SELECT query_id, sum(tf * tf) AS n2 FROM vec_q GROUP BY query_id),
dots AS (SELECT q.query_id, c.point_id, sum(q.tf * c.tf) AS dot
         FROM vec_q q JOIN vec_c c ON q.dim = c.dim GROUP BY q.query_id, c.point_id),
keyed AS (SELECT d.query_id, d.point_id, nq.n2 AS q2, CAST(d.dot * d.dot AS DOUBLE) / CAST(nc.n2 AS DOUBLE) AS key
          FROM dots d JOIN norm_q nq ON nq.query_id = d.query_id JOIN norm_c nc ON nc.point_id = d.point_id),
scored AS (SELECT query_id, point_id, key, sqrt(key / CAST(q2 AS DOUBLE)) AS s FROM keyed),
ranked AS (SELECT query_id, point_id, round(s, {C.SCORE_DECIMALS}) AS score,
                  row_number() OVER (PARTITION BY query_id ORDER BY key DESC, point_id ASC) AS rnk
           FROM scored WHERE s >= {t}),
hits AS (SELECT r.query_id, r.rnk::BIGINT AS rank, r.score, r.point_id, c.source_file, c.page_number,
                c.chunk_index, coalesce(c.text, '') AS text
         FROM ranked r JOIN chunks c ON c.point_id = r.point_id WHERE r.rnk <= {k})"""


def _dense_vec_sql(col: str) -> str:
    return f"CAST({col} AS DOUBLE[])"


def _cos_sql(a: str, b: str) -> str:
    return f"list_cosine_similarity({_dense_vec_sql(a)}, {_dense_vec_sql(b)})"


# ============================== scans / sources ==============================

@register("scan_listing", sql=r"""
WITH paths AS (
  SELECT url AS file_path FROM pages
  UNION ALL SELECT 'doc_' || doc_id || '.txt' FROM documents
  UNION ALL SELECT 'conv_' || conv_id || '.pdf' FROM (SELECT DISTINCT conv_id FROM conversations)
)
SELECT file_path, regexp_extract(file_path, '([^/]+)$', 1) AS source_file,
       CASE WHEN suffix(file_path, '.pdf') THEN 'pdf' ELSE 'txt' END AS file_type
FROM paths WHERE suffix(file_path, '.pdf') OR suffix(file_path, '.txt')
""")
def q_scan_listing(spark, d):
    pages = _t(spark, d, "pages").select(F.col("url").alias("file_path"))
    docs = _t(spark, d, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_path"))
    convs = _t(spark, d, "conversations").select("conv_id").distinct().select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("file_path"))
    paths = pages.unionByName(docs).unionByName(convs)
    is_pdf, is_txt = F.col("file_path").endswith(".pdf"), F.col("file_path").endswith(".txt")
    return paths.filter(is_pdf | is_txt).select(
        "file_path", basename("file_path").alias("source_file"),
        F.when(is_pdf, F.lit("pdf")).otherwise(F.lit("txt")).alias("file_type"))


@register("path_parts", sql=r"""
SELECT page_id, url, regexp_extract(url, '([^/]+)$', 1) AS base_name,
       regexp_extract(regexp_extract(url, '([^/]+)$', 1), '^\.*[^.].*\.([^.]*)$', 1) AS extension
FROM pages
""")
def q_path_parts(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", "url", basename("url").alias("base_name"),
                    extension(basename("url")).alias("extension"))


@register("scan_text_files", sql="""
SELECT doc_id, 'doc_' || doc_id || '.txt' AS source_file, text, length(text)::BIGINT AS n_chars FROM documents
""")
def q_scan_text_files(spark, d):
    """Documents written as one text file each into one folder, then read back as files."""
    from quarry.session import scratch_dir
    from quarry.sources.files import read_text_files, write_files
    out = scratch_dir(spark, "docs-as-files")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    write_files(_t(spark, d, "documents").select(name.alias("name"), F.col("text").alias("content"))
                .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name"), out)
    back = read_text_files(spark, out, suffix=".txt")
    return back.select(F.regexp_extract("source_file", r"doc_(\d+)", 1).cast("bigint").alias("doc_id"), "source_file", "text",
                       F.length("text").cast("bigint").alias("n_chars"))


@register("scan_sections", sql=f"""
SELECT source_file, file_type, section_no, n_sections, text FROM ({O.conversation_sections()}) s
""")
def q_scan_sections(spark, d):
    return _conv_sections(spark, d).select("source_file", "file_type", "section_no", "n_sections", "text")


@register("corpus_union", sql=f"""
SELECT source_file, file_type, section_no, n_sections, length(text)::BIGINT AS n_chars FROM ({ALL_SECTIONS_SQL}) s
""")
def q_corpus_union(spark, d):
    u = _doc_sections(spark, d).unionByName(_conv_sections(spark, d), allowMissingColumns=True)
    return u.select("source_file", "file_type", "section_no", "n_sections",
                    F.length("text").cast("bigint").alias("n_chars"))


@register("query_normalise", sql=QUERY_NORM_SQL)
def q_query_normalise(spark, d):
    return normalise_queries(_queries(spark, d))


# ============================== chunking ==============================

@register("split_pieces", sql=r"""
WITH pieces AS (
  SELECT doc_id, list_filter(
           list_transform(range(1, len(parts) + 1), lambda i: CASE WHEN i = 1 THEN parts[i] ELSE chr(10) || parts[i] END),
           lambda x: x <> '') AS ps
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
), flat AS (
  SELECT doc_id, generate_subscripts(ps, 1) AS i, unnest(ps) AS piece FROM pieces
)
SELECT 'doc_' || doc_id || '.txt' AS source_file, (i - 1)::BIGINT AS piece_no, piece,
       length(piece)::BIGINT AS piece_length
FROM flat
""")
def q_split_pieces(spark, d):
    docs = _t(spark, d, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), "text")
    return split_pieces(docs, "source_file")


@register("chunk_fixed", sql=f"""
WITH w AS (
  SELECT doc_id, text, unnest(range(0, greatest(1, ceil((length(text) - {C.CHUNK_OVERLAP}) / {C.CHUNK_SIZE - C.CHUNK_OVERLAP}))::BIGINT)) AS window_index
  FROM documents WHERE length(text) > 0
)
SELECT 'doc_' || doc_id || '.txt' AS source_file, window_index::BIGINT AS window_index,
       substring(text, window_index * {C.CHUNK_SIZE - C.CHUNK_OVERLAP} + 1, {C.CHUNK_SIZE}) AS text,
       length(substring(text, window_index * {C.CHUNK_SIZE - C.CHUNK_OVERLAP} + 1, {C.CHUNK_SIZE}))::BIGINT AS text_length
FROM w
""")
def q_chunk_fixed(spark, d):
    docs = _t(spark, d, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), "text")
    return chunk_fixed(docs, "source_file")


@register("chunk_sections", sql=DOC_CHUNKS + "\nSELECT * FROM chunks", ids=("point_id",))
def q_chunk_sections(spark, d):
    return _doc_chunks(spark, d)


@register("chunk_metadata", sql=ALL_CHUNKS + """
SELECT source_file, file_type, page_number, chunk_index, chunk_id, text_length, point_id FROM chunks""", ids=("point_id",))
def q_chunk_metadata(spark, d):
    return _all_chunks(spark, d).drop("text")


@register("chunks_per_file", sql=ALL_CHUNKS + """
SELECT source_file, count(*)::BIGINT AS n_chunks FROM chunks GROUP BY source_file""")
def q_chunks_per_file(spark, d):
    return chunks_per_file(_all_chunks(spark, d))


@register("point_ids", sql=f"""
WITH s AS ({O.conversation_sections()}),
k AS (SELECT source_file, section_no AS page_number, 0::BIGINT AS chunk_index FROM s
      UNION ALL SELECT 'doc_' || doc_id || '.txt', NULL, i FROM documents, (SELECT unnest([0, 1, 2])::BIGINT AS i) n)
SELECT source_file, page_number, chunk_index, {O.point_key('source_file', 'page_number', 'chunk_index')} AS point_key,
       {O.point_id(O.point_key('source_file', 'page_number', 'chunk_index'))} AS point_id
FROM k
""", ids=("point_id",))
def q_point_ids(spark, d):
    """Ids of paged sections and of page-less chunks."""
    zero = F.lit(0).cast("bigint")
    paged = _conv_sections(spark, d).select("source_file", F.col("section_no").alias("page_number"), zero.alias("chunk_index"))
    plain = _doc_sections(spark, d).select("source_file", F.lit(None).cast("bigint").alias("page_number"),
                                           F.explode(F.sequence(zero, F.lit(2).cast("bigint"))).alias("chunk_index"))
    key = point_key("source_file", "page_number", F.col("chunk_index"))
    return paged.unionByName(plain).withColumn("point_key", key).withColumn("point_id", hash_u64(F.col("point_key")))


@register("point_payload", sql=DOC_CHUNKS + """
SELECT point_id, source_file, file_type, page_number, chunk_index, chunk_id, text_length, text FROM chunks""", ids=("point_id",))
def q_point_payload(spark, d):
    p = IX.payload(_doc_chunks(spark, d))
    return p.select("point_id", "payload.*")


@register("payload_map", sql=ALL_CHUNKS + f"""
SELECT point_id, coalesce(source_file, '{C.SOURCE_UNKNOWN}') AS source,
       page_number IS NOT NULL AS has_page,
       (6 + CASE WHEN page_number IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS n_keys,
       CASE WHEN page_number IS NOT NULL THEN CAST(page_number AS VARCHAR) ELSE 'n/a' END AS page
FROM chunks""", ids=("point_id",))
def q_payload_map(spark, d):
    ch = _all_chunks(spark, d)
    entries = F.array(
        F.struct(F.lit("source_file").alias("k"), F.col("source_file").alias("v")),
        F.struct(F.lit("file_type").alias("k"), F.col("file_type").alias("v")),
        F.struct(F.lit("chunk_index").alias("k"), F.col("chunk_index").cast("string").alias("v")),
        F.struct(F.lit("text_length").alias("k"), F.col("text_length").cast("string").alias("v")),
        F.struct(F.lit("chunk_id").alias("k"), F.col("chunk_id").alias("v")),
        F.struct(F.lit("text").alias("k"), F.col("text").alias("v")),
        F.struct(F.lit("page_number").alias("k"), F.col("page_number").cast("string").alias("v")))
    m = F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))
    return ch.select(
        "point_id",
        F.coalesce(F.element_at(m, F.lit("source_file")), F.lit(C.SOURCE_UNKNOWN)).alias("source"),
        F.map_contains_key(m, F.lit("page_number")).alias("has_page"),
        F.size(m).cast("bigint").alias("n_keys"),
        F.coalesce(F.element_at(m, F.lit("page_number")), F.lit("n/a")).alias("page"))


# ============================== vectors ==============================

@register("attach_vectors", sql=f"""
SELECT d.doc_id, 'doc_' || d.doc_id || '.txt' AS source_file, e.label,
       len(e.embedding)::BIGINT AS dim,
       round(sqrt(list_sum(list_transform(e.embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm,
       CASE WHEN e.embedding IS NULL THEN 'no_vector' ELSE 'attached' END AS status
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id
""")
def q_attach_vectors(spark, d):
    """Every document, with its vector or the report that it has none."""
    docs = _t(spark, d, "documents").select("doc_id")
    emb = IX.check_dim(_t(spark, d, "embeddings"), DENSE_DIM, vec="embedding")
    j = docs.join(emb, docs.doc_id == emb.vec_id, "left")
    has = F.col("embedding").isNotNull()
    return j.select("doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"),
                    "label", F.when(has, F.size("embedding").cast("bigint")).alias("dim"),
                    F.round(V.l2_norm("embedding"), 6).alias("norm"),
                    F.when(has, F.lit("attached")).otherwise(F.lit("no_vector")).alias("status"))


@register("normalise_vectors", sql="""
WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS nrm FROM embeddings)
SELECT vec_id, round(nrm, 6) AS norm,
       round(CASE WHEN nrm > 0 THEN embedding[1]::DOUBLE / nrm ELSE 0 END, 6) AS x0,
       round(sqrt(list_sum(list_transform(embedding, lambda x: (CASE WHEN nrm > 0 THEN x::DOUBLE / nrm ELSE 0 END) * (CASE WHEN nrm > 0 THEN x::DOUBLE / nrm ELSE 0 END)))), 6) AS unit_norm,
       len(embedding)::BIGINT AS dim
FROM n
""")
def q_normalise_vectors(spark, d):
    e = _t(spark, d, "embeddings")
    u = V.normalise("embedding")
    return e.select("vec_id", F.round(V.l2_norm("embedding"), 6).alias("norm"),
                    F.round(u[0], 6).alias("x0"), F.round(V.l2_norm(u), 6).alias("unit_norm"),
                    F.size("embedding").cast("bigint").alias("dim"))


@register("lexical_vectors", sql=DOC_CHUNKS + f""",
tok AS ({_tokens_sql('chunks', 'point_id')}),
v AS (SELECT point_id, dim, count(*)::BIGINT AS tf FROM tok GROUP BY point_id, dim)
SELECT point_id, sum(tf * tf) OVER (PARTITION BY point_id)::BIGINT AS norm2, dim::BIGINT AS dim, tf FROM v""", ids=("point_id",))
def q_lexical_vectors(spark, d):
    return lexical_vectors(_doc_chunks(spark, d))


# ============================== similarity search ==============================

def _dense_points(spark, d):
    return _t(spark, d, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), "label")


def _dense_queries(spark, d):
    return _t(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@register("vector_topk", sql=f"""
WITH s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS point_id, p.label, {_cos_sql('q.embedding', 'p.embedding')} AS s
  FROM embeddings q JOIN embeddings p ON q.vec_id <> p.vec_id
), r AS (
  SELECT query_id, point_id, label, round(s, 6) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(s, 6) DESC, point_id) AS rnk
  FROM s WHERE s >= {DENSE_T}
)
SELECT query_id, rnk::BIGINT AS rank, score, point_id, label FROM r WHERE rnk <= {K}
""")
def q_vector_topk(spark, d):
    return dense_retrieve(_dense_points(spark, d), _dense_queries(spark, d), DENSE_DIM, k=K,
                          threshold=DENSE_T, payload=["label"], exclude_self=True, decimals=C.SCORE_DECIMALS)


@register("vector_preview", sql=f"""
WITH s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS point_id, p.embedding, {_cos_sql('q.embedding', 'p.embedding')} AS s
  FROM embeddings q JOIN embeddings p ON q.vec_id <> p.vec_id
), r AS (
  SELECT query_id, point_id, embedding,
         row_number() OVER (PARTITION BY query_id ORDER BY round(s, 6) DESC, point_id) AS rnk
  FROM s WHERE s >= {DENSE_T}
)
SELECT query_id, rnk::BIGINT AS rank, point_id,
       round(embedding[1]::DOUBLE, 6) AS x1, round(embedding[2]::DOUBLE, 6) AS x2,
       round(embedding[3]::DOUBLE, 6) AS x3, round(embedding[4]::DOUBLE, 6) AS x4,
       round(embedding[5]::DOUBLE, 6) AS x5, len(embedding)::BIGINT AS dim
FROM r WHERE rnk <= {K}
""")
def q_vector_preview(spark, d):
    """Hit preview for dense hits: first five vector elements and the width."""
    hits = dense_retrieve(_dense_points(spark, d), _dense_queries(spark, d), DENSE_DIM, k=K,
                          threshold=DENSE_T, payload=["vector"], exclude_self=True, decimals=C.SCORE_DECIMALS)
    head = V.head("vector", 5)
    return hits.select("query_id", "rank", "point_id",
                       *[F.round(head[i].cast("double"), 6).alias(f"x{i + 1}") for i in range(5)],
                       F.size("vector").cast("bigint").alias("dim"))


MEAN_VEC_SQL = """SELECT list(x ORDER BY i) AS v FROM (
    SELECT i, avg(x::DOUBLE) AS x FROM (
      SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings) GROUP BY i)"""


@register("single_query_topk", sql=f"""
WITH c AS ({MEAN_VEC_SQL}),
s AS (SELECT e.vec_id AS point_id, e.label, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v) AS s
      FROM embeddings e, c)
SELECT 0::BIGINT AS query_id, (row_number() OVER (ORDER BY round(s, 6) DESC, point_id))::BIGINT AS rank,
       round(s, 6) AS score, point_id, label
FROM s ORDER BY round(s, 6) DESC, point_id LIMIT {K}
""")
def q_single_query_topk(spark, d):
    """One question: the collection's mean direction."""
    pts = _dense_points(spark, d)
    q = mean_vectors(pts.withColumn("query_id", F.lit(0).cast("bigint")), "query_id")
    return dense_retrieve(pts, q, DENSE_DIM, k=K, threshold=-1.0, payload=["label"], decimals=C.SCORE_DECIMALS)


@register("ivf_topk", sql=f"""
WITH coords AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings),
cent AS (SELECT label AS list_id, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(x::DOUBLE) AS x FROM coords GROUP BY label, i) GROUP BY label),
sim AS (SELECT e.vec_id, c.list_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v), 6) AS s
        FROM embeddings e, cent c),
ord AS (SELECT vec_id, list_id, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, list_id) AS r FROM sim),
plist AS (SELECT vec_id, list_id FROM ord WHERE r = 1),
probes AS (SELECT vec_id AS query_id, list_id FROM ord WHERE r <= {IVF_NPROBE}),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS point_id, p.label, {_cos_sql('q.embedding', 'p.embedding')} AS s
  FROM probes pr
  JOIN embeddings q ON q.vec_id = pr.query_id
  JOIN plist pl ON pl.list_id = pr.list_id
  JOIN embeddings p ON p.vec_id = pl.vec_id
  WHERE q.vec_id <> p.vec_id
), r AS (
  SELECT query_id, point_id, label, round(s, 6) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(s, 6) DESC, point_id) AS rnk
  FROM s WHERE s >= {DENSE_T}
)
SELECT query_id, rnk::BIGINT AS rank, score, point_id, label FROM r WHERE rnk <= {K}
""")
def q_ivf_topk(spark, d):
    pts = _dense_points(spark, d)
    cents = mean_vectors(pts, "label").withColumnRenamed("label", "list_id")
    return ivf_topk(pts, _dense_queries(spark, d), cents, DENSE_DIM, nprobe=IVF_NPROBE, k=K,
                    threshold=DENSE_T, payload=["label"], exclude_self=True, decimals=C.SCORE_DECIMALS)


@register("ivf_lists_topk", sql="{ORACLE_PLACEHOLDER_IVF}")
def q_ivf_lists_topk(spark, d):
    """The rows of ``ivf_topk`` from stored lists, of which only the probed ones are read."""
    from quarry.operators import ivf
    from quarry.session import scratch_dir
    pts, base = _dense_points(spark, d), scratch_dir(spark, "ivf")
    cents = mean_vectors(pts, "label").select(F.col("label").cast("bigint").alias("list_id"), "vector")
    ivf.write_lists(pts, cents, base, DENSE_DIM, decimals=C.SCORE_DECIMALS)
    return ivf.search_lists(spark, base, _dense_queries(spark, d), DENSE_DIM, IVF_NPROBE, K, DENSE_T, payload=["label"],
                            exclude_self=True, decimals=C.SCORE_DECIMALS)


@register("vector_blocks_topk", sql="{ORACLE_PLACEHOLDER_EXACT}")
def q_vector_blocks_topk(spark, d):
    """The rows of ``vector_topk`` by stored blocks of questions that meet blocks of points on the executors."""
    from quarry.operators import ivf
    return ivf.search_blocks(_dense_points(spark, d), _dense_queries(spark, d), DENSE_DIM, K, DENSE_T, payload=["label"],
                             exclude_self=True, decimals=C.SCORE_DECIMALS)


@register("ivf_trained")
def q_ivf_trained(spark, d):
    """Lists from the vectors alone (k-means): hits found of the exact ones, by the number of lists probed."""
    from quarry.operators import ivf
    from quarry.session import scratch_dir
    pts, qs, base = _dense_points(spark, d), _dense_queries(spark, d), scratch_dir(spark, "ivf")
    ivf.write_lists(pts, ivf.train_centroids(pts, TRAINED_LISTS, DENSE_DIM), base, DENSE_DIM)
    exact = q_vector_topk(spark, d).select("query_id", "point_id")
    out = None
    for nprobe in TRAINED_PROBES:
        hits = ivf.search_lists(spark, base, qs, DENSE_DIM, nprobe, K, DENSE_T, exclude_self=True, decimals=C.SCORE_DECIMALS)
        found = exact.join(hits.select("query_id", "point_id", F.lit(1).alias("hit")), ["query_id", "point_id"], "left")
        row = found.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found")).select(
            F.lit(TRAINED_LISTS).cast("bigint").alias("lists"), F.lit(nprobe).cast("bigint").alias("probed"), "n_exact", "n_found",
            F.round(F.col("n_found") / F.col("n_exact"), 6).alias("recall"))
        out = row if out is None else out.unionByName(row)
    return out


@register("ivf_recall", sql=f"""
WITH exact AS ({{ORACLE_PLACEHOLDER_EXACT}}),
approx AS ({{ORACLE_PLACEHOLDER_IVF}})
SELECT count(*)::BIGINT AS n_exact, count(a.point_id)::BIGINT AS n_found,
       round(count(a.point_id) / count(*), 6) AS recall
FROM exact e LEFT JOIN approx a ON a.query_id = e.query_id AND a.point_id = e.point_id
""")
def q_ivf_recall(spark, d):
    """recall@k of the IVF plan against exact search (reported, never asserted high)."""
    exact = q_vector_topk(spark, d).select("query_id", "point_id", F.lit(1).alias("_e"))
    approx = q_ivf_topk(spark, d).select("query_id", "point_id", F.lit(1).alias("_a"))
    j = exact.join(approx, ["query_id", "point_id"], "left")
    return j.agg(F.count("_e").alias("n_exact"), F.count("_a").alias("n_found")).select(
        "n_exact", "n_found", F.round(F.col("n_found") / F.col("n_exact"), 6).alias("recall"))


@register("lexical_topk", sql=DOC_CHUNKS + _lexical_hits_ctes() + "\nSELECT * FROM hits", ids=("point_id",))
def q_lexical_topk(spark, d):
    return lexical_retrieve(_doc_chunks(spark, d), _queries(spark, d), k=K, threshold=LEX_T, decimals=C.SCORE_DECIMALS)


@register("posting_topk", sql=DOC_CHUNKS + _lexical_hits_ctes(C.SCORE_THRESHOLD) + "\nSELECT * FROM hits", ids=("point_id",))
def q_posting_topk(spark, d):
    """The same question table at the production threshold, over a stored collection with posting lists."""
    from quarry.operators import postings as PL
    from quarry.session import scratch_dir
    base = scratch_dir(spark, "lists")
    _doc_chunks(spark, d).withColumn("terms", token_dims("text")).write.parquet(base + "/chunks")
    chunks = spark.read.parquet(base + "/chunks")
    PL.append(chunks, base)
    return PL.posting_topk(base, chunks, normalise_queries(_queries(spark, d)), k=K, threshold=C.SCORE_THRESHOLD,
                           payload=HIT_PAYLOAD, decimals=C.SCORE_DECIMALS)


@register("hit_preview", sql=DOC_CHUNKS + _lexical_hits_ctes() + """
SELECT h.query_id, h.rank, h.point_id, substring(q.text, 1, 50) AS query_preview,
       substring(h.text, 1, 100) AS text_preview, length(h.text)::BIGINT AS text_length
FROM hits h JOIN qn q ON q.query_id = h.query_id""", ids=("point_id",))
def q_hit_preview(spark, d):
    q = normalise_queries(_queries(spark, d))
    hits = lexical_retrieve(_doc_chunks(spark, d), _queries(spark, d), k=K, threshold=LEX_T, decimals=C.SCORE_DECIMALS)
    return hits.join(q.select("query_id", F.col("text").alias("qtext")), "query_id").select(
        "query_id", "rank", "point_id", preview("qtext", 50).alias("query_preview"),
        preview("text", 100).alias("text_preview"), F.length("text").cast("bigint").alias("text_length"))


def _prompt_sql() -> str:
    ctx = ("'Source: ' || coalesce(h.source_file, 'Unknown') || "
           "CASE WHEN h.page_number IS NOT NULL THEN ', Page: ' || h.page_number ELSE '' END || "
           "chr(10) || 'Content: ' || coalesce(h.text, '')")
    head = C.PROMPT_HEAD.replace("'", "''").replace("\n", "' || chr(10) || '")
    sysm = C.SYSTEM_MESSAGE.replace("'", "''")
    tail_q = C.PROMPT_QUERY.replace("\n", "' || chr(10) || '")
    tail = C.PROMPT_TAIL.replace("\n", "' || chr(10) || '")
    nh_head = C.NO_HIT_PROMPT_HEAD.replace("'", "''")
    nh_tail = C.NO_HIT_PROMPT_TAIL.replace("'", "''")
    return DOC_CHUNKS + _lexical_hits_ctes() + f""",
agg AS (SELECT h.query_id, string_agg({ctx}, chr(10) || chr(10) ORDER BY h.rank) AS context, count(*)::BIGINT AS n_hits
        FROM hits h GROUP BY h.query_id)
SELECT q.query_id, '{sysm}' AS system,
       CASE WHEN coalesce(a.n_hits, 0) > 0
            THEN '{head}' || a.context || '{tail_q}' || q.text || '{tail}'
            ELSE '{nh_head}' || q.text || '{nh_tail}' END AS prompt,
       coalesce(a.n_hits, 0)::BIGINT AS n_hits
FROM qn q LEFT JOIN agg a ON a.query_id = q.query_id"""


@register("build_prompts", sql=_prompt_sql())
def q_build_prompts(spark, d):
    chunks = _doc_chunks(spark, d)
    q = normalise_queries(_queries(spark, d))
    hits = lexical_retrieve(chunks, q, k=K, threshold=LEX_T, decimals=C.SCORE_DECIMALS)
    return build_prompts(q, hits)


# ============================== index mutations ==============================

def _old_new(spark, d):
    old = _doc_chunks(spark, d)
    labels = _t(spark, d, "labels")
    redo = labels.filter(F.col("quality") == 0).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"))
    new = _doc_chunks(spark, d, ALT_SIZE, ALT_OVERLAP).join(redo, "source_file", "left_semi")
    return old, new


def _old_new_sql() -> str:
    """Two chunkings side by side: ``chunks`` (old) and ``chunks_new`` (re-chunked files)."""
    second = O.chunk_ctes(
        f"SELECT * FROM ({O.document_sections()}) ds WHERE source_file IN "
        "(SELECT 'doc_' || doc_id || '.txt' FROM labels WHERE quality = 0)", ALT_SIZE, ALT_OVERLAP)
    names = ["sec", "l1_raw", "l1b", "l1", "l2_raw", "units", "unit_pos", "bounds", "run_m", "frame_end",
             "frame_next", "frame_a", "frame_b", "steps", "frames", "frame_text", "chunks0", "chunks"]
    import re
    for n in names:
        second = re.sub(rf"\b{n}\b", f"{n}_n", second)
    return "WITH RECURSIVE " + O.chunk_ctes(O.document_sections()) + "," + second


@register("upsert_points", sql=_old_new_sql() + """
SELECT point_id, source_file, chunk_index, chunk_id, text_length, text FROM chunks
WHERE point_id NOT IN (SELECT point_id FROM chunks_n)
UNION ALL
SELECT point_id, source_file, chunk_index, chunk_id, text_length, text FROM chunks_n""", ids=("point_id",))
def q_upsert_points(spark, d):
    old, new = _old_new(spark, d)
    cols = ["point_id", "source_file", "chunk_index", "chunk_id", "text_length", "text"]
    return IX.upsert(old.select(*cols), new.select(*cols), order=["chunk_index"])


@register("delete_by_file", sql=DOC_CHUNKS + """
SELECT point_id, source_file, chunk_index, text_length FROM chunks
WHERE source_file NOT IN (SELECT 'doc_' || doc_id || '.txt' FROM labels WHERE toxic = 1)""", ids=("point_id",))
def q_delete_by_file(spark, d):
    pts = _doc_chunks(spark, d).select("point_id", "source_file", "chunk_index", "text_length")
    toxic = _t(spark, d, "labels").filter(F.col("toxic") == 1).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"))
    return IX.delete_by_file(pts, toxic)


@register("replace_files", sql=_old_new_sql() + """
SELECT point_id, source_file, chunk_index, chunk_id, text_length, text FROM chunks
WHERE source_file NOT IN (SELECT source_file FROM chunks_n)
UNION ALL
SELECT point_id, source_file, chunk_index, chunk_id, text_length, text FROM chunks_n""", ids=("point_id",))
def q_replace_files(spark, d):
    old, new = _old_new(spark, d)
    cols = ["point_id", "source_file", "chunk_index", "chunk_id", "text_length", "text"]
    return IX.replace_files(old.select(*cols), new.select(*cols))


@register("collection_stats", sql=ALL_CHUNKS + """
SELECT count(*)::BIGINT AS n_points, count(DISTINCT source_file)::BIGINT AS n_files,
       min(text_length)::BIGINT AS min_length, max(text_length)::BIGINT AS max_length FROM chunks""")
def q_collection_stats(spark, d):
    return IX.collection_stats(_all_chunks(spark, d), vec=None, length="text_length")


@register("filter_by_payload", sql=DOC_CHUNKS + """
SELECT point_id, source_file, chunk_index, text_length FROM chunks
WHERE source_file = (SELECT max('doc_' || doc_id || '.txt') FROM documents)""", ids=("point_id",))
def q_filter_by_payload(spark, d):
    """The points of one file, from a stored collection: the equality reaches the Parquet scan."""
    from quarry.session import scratch_dir
    path = scratch_dir(spark, "points")
    _doc_chunks(spark, d).select("point_id", "source_file", "chunk_index", "text_length").write.parquet(path)
    name = _t(spark, d, "documents").agg(F.max(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))).first()[0]
    return IX.filter_by_file(spark.read.parquet(path), name)


@register("filter_by_file", sql=DOC_CHUNKS + """
SELECT point_id, source_file, chunk_index, text_length FROM chunks
WHERE source_file IN (SELECT 'doc_' || doc_id || '.txt' FROM labels WHERE quality = 1)""", ids=("point_id",))
def q_filter_by_file(spark, d):
    pts = _doc_chunks(spark, d).select("point_id", "source_file", "chunk_index", "text_length")
    good = _t(spark, d, "labels").filter(F.col("quality") == 1).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"))
    return pts.join(good, "source_file", "left_semi").select("point_id", "source_file", "chunk_index", "text_length")


# ledger, status, ingest and stream queries register themselves on import
from quarry.plans import catalog_ledger  # noqa: E402,F401

ORACLE["vector_blocks_topk"] = ORACLE["vector_topk"]
ORACLE["ivf_lists_topk"] = ORACLE["ivf_topk"]
ORACLE["ivf_recall"] = (ORACLE["ivf_recall"]
                        .replace("{ORACLE_PLACEHOLDER_EXACT}", ORACLE["vector_topk"])
                        .replace("{ORACLE_PLACEHOLDER_IVF}", ORACLE["ivf_topk"]))
