"""DuckDB SQL fragments used by the oracle queries.

The chunk oracle restates the chunking contract relationally:
sections -> level-1 pieces (lines, or words when a text has no newline) ->
level-2 word pieces for over-long lines -> runs -> unit offsets -> frame steps via
two ASOF joins -> a recursive CTE that follows each run's frame chain.

It covers the separator levels the driver tables exercise (they contain no
blank lines, no carriage returns and no word of 500+ characters; texts of at
most 500 characters are a single chunk).  The Spark operator is general; the
remaining levels are covered by unit tests.
"""

from __future__ import annotations

from quarry.config import CHUNK_OVERLAP, CHUNK_SIZE, PY_WHITESPACE

WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)
NL = "chr(10)"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def has_text(expr: str) -> str:
    return f"({strip(expr)} <> '')"


def point_id(key_expr: str) -> str:
    return f"CAST(('0x' || substr(sha256({key_expr}), 1, 16))::UBIGINT AS DECIMAL(20,0))"


def point_key(src: str, page: str, idx: str) -> str:
    return f"({src} || '_' || coalesce(CAST({page} AS VARCHAR), '') || '_' || CAST({idx} AS VARCHAR))"


def document_sections() -> str:
    return """SELECT 'doc_' || doc_id || '.txt' AS source_file, 'doc_' || doc_id || '.txt' AS file_path,
       'txt' AS file_type, CAST(NULL AS TIMESTAMP) AS mtime, 1::BIGINT AS section_no,
       1::BIGINT AS n_sections, text
FROM documents"""


def conversation_sections() -> str:
    return """SELECT 'conv_' || conv_id || '.pdf' AS source_file, 'conv_' || conv_id || '.pdf' AS file_path,
       'pdf' AS file_type, CAST(NULL AS TIMESTAMP) AS mtime,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS section_no,
       count(*) OVER (PARTITION BY conv_id)::BIGINT AS n_sections, text
FROM conversations"""


def chunk_ctes(sections_sql: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """CTEs ending in ``chunks`` (the chunk table schema) for the given sections query."""
    return f"""
sec AS (
  SELECT row_number() OVER () AS sid, source_file, file_type, section_no, n_sections, text,
         (n_sections > 1 OR (n_sections = 1 AND file_type = 'pdf' AND contains(text, {NL} || {NL}))) AS multi
  FROM ({sections_sql}) s0
  WHERE text IS NOT NULL AND {has_text('text')}
),
l1_raw AS (
  SELECT sid, text, generate_subscripts(parts, 1) AS i1, unnest(parts) AS part,
         CASE WHEN contains(text, {NL}) THEN {NL} ELSE ' ' END AS sep
  FROM (SELECT sid, text,
               CASE WHEN length(text) <= {size} THEN [text]
                    WHEN contains(text, {NL}) THEN string_split(text, {NL})
                    ELSE string_split(text, ' ') END AS parts
        FROM sec) x
),
l1 AS (
  SELECT sid, i1,
         CASE WHEN i1 = 1 OR length(text) <= {size} THEN part ELSE sep || part END AS piece
  FROM l1_raw
),
l1b AS (
  SELECT sid, i1, piece, length(piece) >= {size} AS bad,
         sum(CASE WHEN length(piece) >= {size} THEN 1 ELSE 0 END)
             OVER (PARTITION BY sid ORDER BY i1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nbad
  FROM l1 WHERE piece <> ''
),
l2_raw AS (
  SELECT sid, i1, generate_subscripts(w, 1) AS i2, unnest(w) AS part
  FROM (SELECT sid, i1, string_split(piece, ' ') AS w FROM l1b WHERE bad) y
),
units AS (
  SELECT sid, i1, 0 AS i2, piece AS u, 2 * coalesce(nbad, 0) AS run FROM l1b WHERE NOT bad
  UNION ALL
  SELECT r.sid, r.i1, r.i2, CASE WHEN r.i2 = 1 THEN r.part ELSE ' ' || r.part END AS u,
         2 * coalesce(b.nbad, 0) + 1 AS run
  FROM l2_raw r JOIN l1b b ON b.sid = r.sid AND b.i1 = r.i1
  WHERE NOT (r.i2 = 1 AND r.part = '')
),
unit_pos AS (
  SELECT sid, run, i1, i2, length(u) AS len,
         (sum(length(u)) OVER (PARTITION BY sid ORDER BY i1, i2 ROWS UNBOUNDED PRECEDING) - length(u))::BIGINT AS c0
  FROM units
),
bounds AS (
  SELECT sid, run, (row_number() OVER (PARTITION BY sid, run ORDER BY i1, i2) - 1)::BIGINT AS idx, c0 AS c
  FROM unit_pos
  UNION ALL
  SELECT sid, run, count(*)::BIGINT AS idx, max(c0 + len)::BIGINT AS c FROM unit_pos GROUP BY sid, run
),
run_m AS (SELECT sid, run, max(idx) AS m FROM bounds GROUP BY sid, run),
frame_end AS (
  SELECT s.sid, s.run, s.idx AS s, s.c AS cs, e.idx AS e, e.c AS ce
  FROM bounds s ASOF JOIN bounds e ON s.sid = e.sid AND s.run = e.run AND s.c + {size} >= e.c
),
frame_next AS (
  SELECT f.sid, f.run, f.s, f.cs, f.e, f.ce, n.c AS cnext
  FROM frame_end f LEFT JOIN bounds n ON n.sid = f.sid AND n.run = f.run AND n.idx = f.e + 1
),
frame_a AS (
  SELECT f.*, a.idx AS a
  FROM frame_next f ASOF JOIN bounds a ON f.sid = a.sid AND f.run = a.run AND f.ce - {overlap} <= a.c
),
frame_b AS (
  SELECT f.*, b.idx AS b
  FROM frame_a f ASOF LEFT JOIN bounds b ON f.sid = b.sid AND f.run = b.run AND f.cnext - {size} <= b.c
),
steps AS (
  SELECT f.sid, f.run, f.s, f.cs, f.e, f.ce, m.m,
         CASE WHEN f.cnext IS NULL THEN NULL ELSE least(greatest(f.a, f.b), f.e) END AS nxt
  FROM frame_b f JOIN run_m m ON m.sid = f.sid AND m.run = f.run
  WHERE f.s < m.m
),
frames AS (
  SELECT sid, run, s, cs, e, ce, m, nxt FROM steps WHERE s = 0
  UNION ALL
  SELECT st.sid, st.run, st.s, st.cs, st.e, st.ce, st.m, st.nxt
  FROM frames f JOIN steps st ON st.sid = f.sid AND st.run = f.run AND st.s = f.nxt
  WHERE f.e < f.m
),
frame_text AS (
  SELECT f.sid, f.run, f.s, {strip('substring(sec.text, f.cs + 1, f.ce - f.cs)')} AS ctext
  FROM frames f JOIN sec ON sec.sid = f.sid
),
chunks0 AS (
  SELECT sec.source_file, sec.file_type, sec.section_no, sec.multi, ft.ctext,
         (row_number() OVER (PARTITION BY ft.sid ORDER BY ft.run, ft.s) - 1)::BIGINT AS j
  FROM frame_text ft JOIN sec ON sec.sid = ft.sid
  WHERE ft.ctext <> ''
),
chunks AS (
  SELECT source_file, file_type,
         CASE WHEN multi THEN section_no END::BIGINT AS page_number,
         j AS chunk_index,
         CASE WHEN multi THEN source_file || '_p' || section_no || '_' || j
              ELSE source_file || '_' || j END AS chunk_id,
         length(ctext)::BIGINT AS text_length,
         ctext AS text,
         {point_id(point_key('source_file', 'CASE WHEN multi THEN section_no END', 'j'))} AS point_id
  FROM chunks0
)"""
