"""Incremental ingest lifecycle in a temp folder (the manual scenario, automated)."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators import scan as S


def _write(path, data: bytes, mtime=None):
    with open(path, "wb") as f:
        f.write(data)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


@pytest.fixture()
def folders():
    root = tempfile.mkdtemp(prefix="quarry-life-")
    txt, pdf, state = (os.path.join(root, n) for n in ("texts", "pdfs", "state"))
    os.makedirs(txt)
    os.makedirs(pdf)
    os.makedirs(os.path.join(txt, "nested"))
    return {"txt": txt, "pdf": pdf, "state": state}


def _status(run):
    return {r.source_file: r.status for r in run["status"].collect()}


def _ledger(run):
    return {os.path.basename(r.file_path): r.status for r in run["ledger"].collect()}


def _points(run):
    return sorted((r.source_file, r.chunk_index) for r in run["index"].select("source_file", "chunk_index").collect())


def test_scan_lifecycle(spark, folders):
    txt, pdf, state = folders["txt"], folders["pdf"], folders["state"]
    t0 = time.time() - 1000
    _write(f"{txt}/ok.txt", "café latte\nsecond line".encode(), t0)
    _write(f"{txt}/crlf.txt", b"a\r\nb", t0)
    _write(f"{txt}/bad.txt", b"\xff\xfe bad", t0)
    _write(f"{txt}/blank.txt", b"   \n ", t0)
    _write(f"{txt}/UPPER.TXT", b"not listed", t0)
    _write(f"{txt}/nested/inner.txt", b"not listed either", t0)
    _write(f"{pdf}/doc.pdf", b"%PDF-1.4", t0)
    dirs = {".txt": txt, ".pdf": pdf}

    run1 = S.run_scan(spark, dirs, state)
    st = _status(run1)
    assert st == {"ok.txt": "success", "crlf.txt": "success", "bad.txt": "failed",
                  "blank.txt": "skipped_empty", "doc.pdf": "failed"}
    texts = {r.source_file: r.text for r in run1["index"].collect()}
    assert texts["crlf.txt"] == "a\nb"
    assert texts["ok.txt"] == "café latte\nsecond line"
    assert _ledger(run1) == st

    # no-op scan: only the non-success files are retried
    run2 = S.run_scan(spark, dirs, state)
    ch = {os.path.basename(r.file_path): r.reason for r in run2["changes"].collect()}
    assert ch["ok.txt"] == "unchanged" and ch["crlf.txt"] == "unchanged"
    assert ch["bad.txt"] == "retry" and ch["blank.txt"] == "retry"
    assert _points(run2) == _points(run1)

    # modify (more text -> more chunks), add a file, remove a file
    _write(f"{txt}/ok.txt", ("word " * 300).encode(), t0 + 500)
    _write(f"{txt}/new.txt", b"brand new", t0 + 500)
    os.remove(f"{txt}/crlf.txt")
    run3 = S.run_scan(spark, dirs, state)
    ch = {os.path.basename(r.file_path): r.reason for r in run3["changes"].collect()}
    assert ch["ok.txt"] == "modified" and ch["new.txt"] == "new" and ch["crlf.txt"] == "missing"
    pts = _points(run3)
    assert ("ok.txt", 2) in pts and ("new.txt", 0) in pts
    assert not any(f == "crlf.txt" for f, _ in pts)
    assert "crlf.txt" not in _ledger(run3)

    # shrink: re-ingest with fewer chunks leaves no surplus points
    _write(f"{txt}/ok.txt", b"short", t0 + 900)
    run4 = S.run_scan(spark, dirs, state)
    assert [p for p in _points(run4) if p[0] == "ok.txt"] == [("ok.txt", 0)]

    # a file that turns empty loses its points; one that fails keeps them
    _write(f"{txt}/ok.txt", b" \n", t0 + 950)
    _write(f"{txt}/new.txt", b"\xff\xfe", t0 + 950)
    run5 = S.run_scan(spark, dirs, state)
    assert _status(run5)["ok.txt"] == "skipped_empty" and _status(run5)["new.txt"] == "failed"
    assert _points(run5) == [("new.txt", 0)]

    # clear all
    S.clear_all(spark, state)
    assert S.read_state_index(spark, state).count() == 0
    assert S.read_state_ledger(spark, state).count() == 0


def test_corrupt_ledger_is_quarantined(spark, folders):
    path = folders["state"] + "-corrupt.json"
    _write(path, b"{")
    bad = S.import_ledger(spark, path, folders["state"])
    assert bad.count() == 1
    assert S.read_state_ledger(spark, folders["state"]).count() == 0


def test_missing_ledger_is_empty(spark, folders):
    bad = S.import_ledger(spark, folders["state"] + "-absent.json", folders["state"])
    assert bad.count() == 0
    assert S.read_state_ledger(spark, folders["state"]).count() == 0


def test_import_single_object_ledger(spark, folders):
    path = os.path.join(folders["state"] + "-import.json")
    _write(path, b'''{
    "/x/data/texts/a.txt": {
        "file_path": "/x/data/texts/a.txt",
        "last_modified": 1700000000.25,
        "ingested_at": 1700000100.5,
        "status": "success",
        "error_message": null
    }
}''')
    bad = S.import_ledger(spark, path, folders["state"])
    assert bad.count() == 0
    rows = S.read_state_ledger(spark, folders["state"]).collect()
    assert len(rows) == 1 and rows[0].status == "success"
    assert rows[0].file_path == "/x/data/texts/a.txt"


def _table(spark, base):
    from quarry import config as C
    from quarry.operators import bucketed as BT
    return {r.file_path: r.status for r in BT.read_current(spark, base, C.LEDGER).collect()}


def test_only_touched_buckets_are_rewritten(spark, folders):
    from quarry.operators import bucketed as BT
    from quarry import config as C
    base = folders["state"] + "/table"
    schema = C.LEDGER
    assert _table(spark, base) == {}
    rows = spark.createDataFrame([(f"/f/{i}.txt", None, None, "success", None) for i in range(40)], schema)
    BT.replace_keys(spark, base, schema, "file_path", 8, changed=rows)
    files = {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}
    one = spark.createDataFrame([("/f/3.txt", None, None, "failed", "x")], schema)
    touched = BT.replace_keys(spark, base, schema, "file_path", 8, changed=one,
                              removed=spark.createDataFrame([("/f/4.txt",)], "file_path string"))
    assert 1 <= len(touched) <= 2
    kept = {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")} & files
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files - kept} == touched    # the others are the same files
    got = _table(spark, base)
    assert len(got) == 39 and got["/f/3.txt"] == "failed" and "/f/4.txt" not in got
    # a replace that is run again changes nothing; emptied buckets disappear
    BT.replace_keys(spark, base, schema, "file_path", 8, changed=one)
    assert _table(spark, base) == got
    BT.replace_keys(spark, base, schema, "file_path", 8, removed=rows.select("file_path"))
    assert _table(spark, base) == {} and not [d for d in os.listdir(base) if d.startswith("bucket=")]


def test_a_writer_that_died_before_the_overwrite_leaves_the_table(spark, folders):
    from quarry.operators import bucketed as BT
    from quarry import config as C
    base = folders["state"] + "/crash"
    rows = spark.createDataFrame([(f"/f/{i}.txt", None, None, "success", None) for i in range(10)], C.LEDGER)
    BT.replace_keys(spark, base, C.LEDGER, "file_path", 4, changed=rows)
    rows.limit(1).write.parquet(base + "-work/half-written")
    assert len(_table(spark, base)) == 10


def test_ingest_then_ask(spark, folders):
    from quarry import api
    txt, state = folders["txt"], folders["state"]
    _write(f"{txt}/ai.txt", b"Artificial intelligence studies agents that learn.\nMachine learning fits models to data.")
    _write(f"{txt}/cats.txt", b"Cats sleep most of the day and purr.")
    api.ingest_folders(spark, None, txt, state)
    rows = {r.query_id: r for r in api.ask(spark, state, ["machine learning models", "exit", "quantum soup"],
                                         threshold=0.3).collect()}
    assert set(rows) == {0, 2}                       # the stop word is dropped
    assert rows[0].n_hits >= 1 and "Source: ai.txt" in rows[0].prompt
    assert rows[2].n_hits == 0 and rows[2].prompt.startswith("Answer the following query: quantum soup.")


def _toy_embed(df):
    """8-dim bag of letters: a stand-in for any Arrow/pandas embedder."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    @F.arrow_udf("array<float>")
    def vec(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            v = [0.0] * 8
            for ch in (t or "").lower():
                if ch.isalpha():
                    v[ord(ch) % 8] += 1.0
            out.append(v)
        return pa.array(out, type=pa.list_(pa.float32()))

    return df.withColumn("vector", vec(F.col("text")))


def test_pluggable_dense_embedder(spark, folders):
    from quarry import api
    txt, state = folders["txt"], folders["state"]
    _write(f"{txt}/a.txt", b"aaaa aaaa")
    _write(f"{txt}/b.txt", b"bbbb bbbb")
    api.ingest_folders(spark, None, txt, state, embed=_toy_embed)
    idx = S.read_state_index(spark, state)
    assert idx.filter("vector is null").count() == 0
    hits = api.retrieve(spark, state, ["aaa"], k=1, threshold=0.5, embed=_toy_embed).collect()
    assert [h.source_file for h in hits] == ["a.txt"] and abs(hits[0].score - 1.0) < 1e-6


def test_vectors_that_go_missing_fail_the_file(spark):
    from quarry import config as C
    from quarry.operators.ingest import ingest
    listing = spark.createDataFrame([("/d/a.txt", None)], "file_path string, mtime timestamp")
    listing = listing.withColumn("mtime", F.lit("2024-01-01").cast("timestamp"))

    def load(files):
        return files.select("source_file", "file_path", "file_type", "mtime", F.lit(1).cast("bigint").alias("section_no"),
                            F.lit(1).cast("bigint").alias("n_sections"), F.repeat(F.lit("word "), 600).alias("text"))

    index = spark.createDataFrame([], C.CHUNKS)
    ledger = spark.createDataFrame([], C.LEDGER)
    out = ingest(listing, ledger, load, index, embed=lambda c: c.filter("chunk_index <> 3"))
    row = out["status"].first()
    assert row.status == "failed" and row.n_uploaded == row.n_chunks - 1
    assert row.error_message == f"Mismatch in uploaded chunks count. Expected {row.n_chunks}, got {row.n_uploaded}."
    assert out["index"].count() == 0


def test_questions_are_answered_from_stored_terms(spark, folders):
    from quarry.api import ask, retrieve
    from quarry.operators.lexical import token_dims
    _write(f"{folders['txt']}/a.txt", b"alpha beta gamma delta")
    _write(f"{folders['txt']}/b.txt", b"unrelated words only")
    S.run_scan(spark, {".txt": folders["txt"]}, folders["state"])
    index = S.read_state_index(spark, folders["state"])
    assert index.filter(F.col("terms") == token_dims("text")).count() == index.count() == 2
    hits = retrieve(spark, folders["state"], ["beta gamma"], threshold=0.3)
    assert [r.source_file for r in hits.collect()] == ["a.txt"]
    assert "md5" not in index._jdf.queryExecution().optimizedPlan().toString()
    assert ask(spark, folders["state"], ["beta gamma", " "]).count() == 1


def test_a_replace_shuffles_new_rows_only_and_keeps_the_others(spark, folders, monkeypatch):
    from quarry import config as C
    from quarry.operators import bucketed as BT
    derived = []

    def derive(df):
        derived.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn("error_message", F.concat("status", F.lit("!")))

    def rows(names, status):
        return spark.createDataFrame([(n, None, None, status, None) for n in names], C.LEDGER)

    for most in (BT.BROADCAST_KEYS, 0):                  # 0: keys too many to broadcast
        monkeypatch.setattr(BT, "BROADCAST_KEYS", most)
        base = f"{folders['state']}/replace-{most}"
        BT.replace_keys(spark, base, C.LEDGER, "file_path", 4, changed=rows([f"{i}" for i in range(50)] + [None], "a").drop("error_message"), derive=derive)
        BT.replace_keys(spark, base, C.LEDGER, "file_path", 4, changed=rows([f"{i}" for i in range(5)], "b").drop("error_message"),
                        removed=spark.createDataFrame([("7",), ("none",)], "file_path string"), derive=derive)
        got = sorted((str(r.file_path), r.status, r.error_message) for r in BT.read_current(spark, base, C.LEDGER).collect())
        want = [(str(i), "b" if i < 5 else "a", "b!" if i < 5 else "a!") for i in range(50) if i != 7] + [("None", "a", "a!")]
        assert got == sorted(want)
        assert not os.path.exists(base + "-work")        # rows are written once, where they belong
    assert len(derived) == 4 and all("RebalancePartitions" in p for p in derived)
