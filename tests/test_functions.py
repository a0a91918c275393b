"""Golden values for ids, paths, strip semantics, metadata and prompts."""

from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.hashing import point_id
from quarry.functions.text import basename, extension, has_text, py_strip
from quarry.operators.chunking import chunk_sections
from quarry.operators.prompts import build_prompts

GOLDEN_IDS = [
    ("sample_article.txt", None, 0, 11871442811586517013),
    ("new_research_paper.txt", None, 0, 10349555693127426363),
    ("sample_report.pdf", 1, 0, 3835935658475467951),
    ("sample_report.pdf", 2, 0, 9557121141999682215),
    ("sample_report.pdf", 3, 0, 4286213077117915977),
    ("é.txt", None, 0, 1085246769014541362),
]


def test_point_ids(spark):
    df = spark.createDataFrame([(a, b, c) for a, b, c, _ in GOLDEN_IDS],
                               "source_file string, page_number bigint, chunk_index bigint")
    got = [r.pid for r in df.select(point_id().alias("pid")).collect()]
    assert got == [Decimal(x) for *_, x in GOLDEN_IDS]


def test_path_parts(spark):
    paths = ["/a/b/report.pdf", "/a/.pdf", "/a/x.tar.gz", "/a/noext", "/a/b.", "/a/dir/", "..a"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select(basename("p").alias("b"), extension(basename("p")).alias("e")).collect()
    assert [(r.b, r.e) for r in rows] == [("report.pdf", "pdf"), (".pdf", ""), ("x.tar.gz", "gz"),
                                          ("noext", ""), ("b.", ""), ("", ""), ("..a", "")]


def test_strip_matches_python(spark):
    samples = ["  a ", " b ", "\x1c c \x1f", "\t\n", "", "x"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    rows = df.select(py_strip("s").alias("t"), has_text("s").alias("h")).collect()
    assert [r.t for r in rows] == [s.strip() for s in samples]
    assert [r.h for r in rows] == [bool(s.strip()) for s in samples]


def test_metadata_cases(spark):
    rows = [
        ("a.pdf", "pdf", 1, 1, "one page"),             # 1 section, no blank line -> no page
        ("b.pdf", "pdf", 1, 1, "x\n\ny"),              # pdf heuristic -> page 1
        ("c.txt", "txt", 1, 1, "x\n\ny"),              # heuristic is pdf-only
        ("d.pdf", "pdf", 1, 3, "p1"), ("d.pdf", "pdf", 2, 3, "   "), ("d.pdf", "pdf", 3, 3, "p3"),
        ("e.pdf", "pdf", 1, 2, ""), ("e.pdf", "pdf", 2, 2, "p2"),
    ]
    df = spark.createDataFrame(rows, "source_file string, file_type string, section_no bigint, n_sections bigint, text string")
    got = {(r.source_file, r.page_number, r.chunk_id) for r in chunk_sections(df).collect()}
    assert got == {("a.pdf", None, "a.pdf_0"), ("b.pdf", 1, "b.pdf_p1_0"), ("c.txt", None, "c.txt_0"),
                   ("d.pdf", 1, "d.pdf_p1_0"), ("d.pdf", 3, "d.pdf_p3_0"), ("e.pdf", 2, "e.pdf_p2_0")}


def test_prompt_golden(spark):
    q = spark.createDataFrame([(1, "Q"), (2, "R")], "query_id bigint, text string")
    hits = spark.createDataFrame([Row(query_id=1, rank=1, source_file="a.pdf", page_number=2, text="T")],
                                 "query_id bigint, rank int, source_file string, page_number bigint, text string")
    got = {r.query_id: r for r in build_prompts(q, hits).collect()}
    assert got[1].prompt == ("You are an AI assistant that answers questions based on the provided context.\n"
                             "If the answer is not available in the context, clearly state that you don't have "
                             "enough information.\n\nContext:\nSource: a.pdf, Page: 2\nContent: T\n\n"
                             "Query: Q\n\nAnswer:")
    assert got[1].n_hits == 1 and got[1].system == C.SYSTEM_MESSAGE
    assert got[2].prompt == ("Answer the following query: R. If you don't have enough information, "
                             "state so clearly.")
    assert got[2].n_hits == 0


def test_prompt_joins_contexts_in_rank_order(spark):
    q = spark.createDataFrame([(1, "Q")], "query_id bigint, text string")
    hits = spark.createDataFrame(
        [(1, 2, None, None, "second"), (1, 1, "a.txt", None, "first")],
        "query_id bigint, rank int, source_file string, page_number bigint, text string")
    p = build_prompts(q, hits).first().prompt
    assert "Source: a.txt\nContent: first\n\nSource: Unknown\nContent: second" in p


def test_prompt_zero_context_variant(spark):
    q = spark.createDataFrame([(1, "Q")], "query_id bigint, text string")
    hits = spark.createDataFrame([], "query_id bigint, rank int, source_file string, page_number bigint, text string")
    p = build_prompts(q, hits, no_hit="context").first().prompt
    assert p == "Query: Q\n\nNo relevant information was found in the knowledge base."
