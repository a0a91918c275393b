"""Unit tests for operators with hand-written edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import ledger as L
from quarry.operators.chunking import chunk_fixed, split_pieces
from quarry.operators.index import check_dim
from quarry.operators.ingest import document_status
from quarry.sources.queries import normalise_queries


def test_query_normalise_edges(spark):
    rows = [(1, "  hello  "), (2, "EXIT"), (3, " quit\n"), (4, "   "), (5, "　\twhat? "), (6, None),
            (7, "exit now")]
    q = spark.createDataFrame(rows, "query_id bigint, text string")
    got = {r.query_id: r.text for r in normalise_queries(q).collect()}
    assert got == {1: "hello", 5: "what?", 7: "exit now"}


def test_document_status_branches(spark):
    files = spark.createDataFrame(
        [("a.txt", "txt", None), ("b.txt", "txt", None), ("c.docx", "docx", None), ("d.txt", "txt", "boom"),
         ("e.pdf", "pdf", None), ("f.txt", "txt", None)],
        "source_file string, file_type string, read_error string")
    sections = spark.createDataFrame(
        [("a.txt", "hello"), ("b.txt", "  \n "), ("e.pdf", ""), ("e.pdf", "\t"), ("f.txt", "x")],
        "source_file string, text string")
    chunks = spark.createDataFrame([("a.txt", 0), ("f.txt", 0), ("f.txt", 1)], "source_file string, chunk_index int")
    uploaded = spark.createDataFrame([("a.txt", 0), ("f.txt", 0)], "source_file string, chunk_index int")
    got = {r.source_file: (r.status, r.error_message)
           for r in document_status(files, sections, chunks, uploaded).collect()}
    assert got["a.txt"] == ("success", None)
    assert got["b.txt"] == ("skipped_empty", C.MSG_EMPTY)
    assert got["c.docx"] == ("failed", "No processor for type 'docx'")
    assert got["d.txt"] == ("failed", "boom")
    assert got["e.pdf"] == ("skipped_empty", C.MSG_EMPTY)
    assert got["f.txt"] == ("failed", "Mismatch in uploaded chunks count. Expected 2, got 1.")


def test_check_dim_raises(spark):
    ok = spark.createDataFrame([(1, [1.0, 2.0])], "id bigint, vector array<float>")
    assert check_dim(ok, 2).count() == 1
    bad = spark.createDataFrame([(1, [1.0])], "id bigint, vector array<float>")
    with pytest.raises(Exception):
        check_dim(bad, 2).collect()


def test_chunk_fixed_and_pieces(spark):
    df = spark.createDataFrame([("k", "x" * 951), ("e", "")], "k string, text string")
    got = [(r.window_index, r.text_length) for r in chunk_fixed(df, "k").orderBy("window_index").collect()]
    assert got == [(0, 500), (1, 500), (2, 51)]
    p = spark.createDataFrame([("k", "\nab\ncd\n")], "k string, text string")
    assert [r.piece for r in split_pieces(p, "k").orderBy("piece_no").collect()] == ["\nab", "\ncd", "\n"]


def test_ledger_json_round_trip_and_change_reasons(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    led = spark.createDataFrame(
        [("/d/a.txt", t, t, "success", None), ("/d/b.txt", t, t, "failed", 'bad "quote"\\'),
         ("/d/gone.txt", t, t, "success", None), ("/d/c.txt", t, t, "success", None)], C.LEDGER)
    text = L.export_ledger(led).select(F.col("json").alias("value"))
    rows, bad = L.parse_ledger_json(text)
    assert bad.count() == 0
    assert sorted(rows.collect()) == sorted(led.collect())
    later = t + dt.timedelta(seconds=1)
    listing = spark.createDataFrame([("/d/a.txt", later), ("/d/b.txt", t), ("/d/c.txt", t), ("/d/new.txt", t)],
                                    "file_path string, mtime timestamp")
    reasons = {r.file_path: r.reason for r in L.change_detect(listing, led).collect()}
    assert reasons == {"/d/a.txt": "modified", "/d/b.txt": "retry", "/d/c.txt": "unchanged",
                       "/d/new.txt": "new", "/d/gone.txt": "missing"}


def test_ledger_upsert_last_write_wins(spark):
    t = dt.datetime(2024, 1, 1)
    led = spark.createDataFrame([("/a", t, t, "failed", "x")], C.LEDGER)
    upd = spark.createDataFrame([("/a", t, t + dt.timedelta(hours=1), "success", None),
                                 ("/b", t, t, "success", None)], C.LEDGER)
    got = {r.file_path: r.status for r in L.upsert_ledger(led, upd).collect()}
    assert got == {"/a": "success", "/b": "success"}


def test_section_numbers_with_repeated_and_missing_turns(spark):
    from quarry.sources.tables import conversation_sections
    rows = [(1, 2, "b"), (1, 1, "a"), (1, 2, "a2"), (1, None, "n"), (2, 1, None), (2, 1, "x"), (3, 5, "only")]
    got = conversation_sections(spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string")).collect()
    assert sorted((r.source_file, r.section_no, r.n_sections, r.text or "") for r in got) == [
        ("conv_1.pdf", 1, 4, "n"), ("conv_1.pdf", 2, 4, "a"), ("conv_1.pdf", 3, 4, "a2"), ("conv_1.pdf", 4, 4, "b"),
        ("conv_2.pdf", 1, 2, ""), ("conv_2.pdf", 2, 2, "x"), ("conv_3.pdf", 1, 1, "only")]


def test_ledger_durations_of_a_hot_file(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("/hot", t + dt.timedelta(milliseconds=1500 * i), "success", i) for i in range(2000)] + [("/one", t, "failed", 0)]
    got = L.ledger_durations(spark.createDataFrame(rows, "file_path string, ingested_at timestamp, status string, seq bigint"))
    assert got.filter("elapsed_s = 1.5").count() == 1999 and got.filter("elapsed_s is null").count() == 2


def test_ledger_files_survive_odd_paths_and_many_entries(spark, tmp_path):
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    odd = ["/q\"uote", "/back\\slash", "/ctrl\u0001\u001f", "/new\nline\ttab", "/ünï"]
    led = spark.createDataFrame([(p, t, t, "success", p) for p in odd] + [(f"/f{i}", t, t, "success", None) for i in range(300)],
                                C.LEDGER)
    path = str(tmp_path / "ledger")
    lines = L.export_ledger(led)
    assert lines.count() == 305                        # one line an entry, however many
    lines.coalesce(2).select("json").write.text(path)
    rows, bad = L.read_ledger(spark, path)
    assert bad.count() == 0 and sorted(rows.collect(), key=repr) == sorted(led.collect(), key=repr)
    (tmp_path / "ledger" / "part-damaged.txt").write_text('{"/x": {"file_pa\n{"/y": {"file_path": "/y", "last_modified": 1.5, '
                                                           '"ingested_at": 2.5, "status": "failed", "error_message": null}}\n')
    rows, bad = L.read_ledger(spark, path)
    assert bad.count() == 1 and rows.count() == 306    # the damaged line alone is lost


def test_topk_ranks_on_full_precision_and_answers_every_question(spark):
    from quarry.operators.search import dense_retrieve
    pts = spark.createDataFrame([(1, [1.0, 0.001]), (2, [1.0, 0.0009]), (3, [0.0, 1.0])], "point_id bigint, vector array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id bigint, vector array<double>")
    got = dense_retrieve(pts, q, 2, k=2, threshold=-1.0).collect()
    assert sorted((r.query_id, r["rank"], r.point_id) for r in got) == [(0, 1, 2), (0, 2, 1), (1, 1, 3), (1, 2, 1)]


def test_centroids_beyond_one_block(spark, monkeypatch):
    import numpy as np
    from quarry.operators import ann
    rng = np.random.default_rng(1)
    cents = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(23)], "list_id bigint, vector array<double>")
    pts = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(50)], "point_id bigint, vector array<double>")
    whole = sorted(ann.assign_lists(pts, cents, 4, nprobe=5).collect())
    monkeypatch.setattr(ann, "CENTROID_BLOCK_BYTES", 3 * 4 * 8)
    assert sorted(ann.assign_lists(pts, cents, 4, nprobe=5).collect()) == whole


def test_chunking_uses_the_sessions_parallelism(spark):
    from quarry.operators.chunking import chunk_sections
    from quarry.sources.tables import document_sections
    docs = spark.createDataFrame([(i, "some text " * 80) for i in range(400)], "doc_id bigint, text string").coalesce(1)
    plan = chunk_sections(document_sections(docs))._jdf.queryExecution().optimizedPlan().toString()
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert f"{n}, " in plan[plan.index("RepartitionByExpression"):].split("\n")[0] or plan.count("RepartitionByExpression") == 1
    parts = chunk_sections(document_sections(docs)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == int(n)


def test_ledger_entry_missing_field_is_quarantined(spark):
    doc = ('{"/a": {"file_path": "/a", "last_modified": 1.5, "ingested_at": 2.5, "status": "success", '
           '"error_message": null}, "/b": {"file_path": "/b", "last_modified": 1.0}}')
    rows, bad = L.parse_ledger_json(spark.createDataFrame([(doc,)], "value string"))
    assert [r.file_path for r in rows.collect()] == ["/a"]
    assert [r.reason for r in bad.collect()] == ["ledger entry misses a required field"]


def test_a_long_bag_is_counted_in_linear_time(spark):
    import time

    from quarry.operators.lexical import lexical_vectors
    words = [f"w{i % 12_000}" for i in range(24_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "a b a"), (4, "")], "point_id bigint, text string")
    began = time.time()
    rows = lexical_vectors(df, dim=1 << 24).collect()
    assert time.time() - began < 8
    assert {r.point_id for r in rows} == {1, 3}
    assert sum(r.tf for r in rows if r.point_id == 1) == 24_000 and {r.norm2 for r in rows if r.point_id == 1} == {sum(r.tf ** 2 for r in rows if r.point_id == 1)}
    assert sorted(r.tf for r in rows if r.point_id == 3) == [1, 2] and {r.norm2 for r in rows if r.point_id == 3} == {5}


def test_a_batch_of_texts_is_not_held_as_strings():
    import tracemalloc

    import pyarrow as pa

    from quarry.operators.chunking import chunk_udf
    from quarry.operators.splitter import split_text
    texts = pa.array([("some words " * 500) + str(i) for i in range(3_000)] + [None, ""])
    tracemalloc.start()
    out = chunk_udf(500, 50).func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == len(texts) and out[7].as_py() == split_text(texts[7].as_py(), 500, 50) and out[3000].as_py() == []
    assert peak < 12e6, peak                            # 16 MB of text
