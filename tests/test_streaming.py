"""Streams: availableNow runs equal the batch result and replays change nothing."""

import tempfile

from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import ledger as L
from quarry.operators import bucketed as BT
from quarry.sources import tables as TB
from quarry.streaming.incremental import read_ledger, stream_ledger

SF = "/root/testdata/sf0.001"


def _rows(batch):
    return TB.ledger_rows(batch)


def _as_set(df):
    return sorted(tuple(r) for r in df.select(*[f.name for f in C.LEDGER.fields]).collect())


def test_stream_ledger_equals_batch_and_is_idempotent(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    base = tempfile.mkdtemp(prefix="quarry-stream-")
    src = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
           .option("maxFilesPerTrigger", 1).parquet(SF))
    stream_ledger(spark, src, _rows, base + "/table", base + "/ckpt")
    first = _as_set(read_ledger(spark, base + "/table"))
    batch = L.upsert_ledger(spark.createDataFrame([], C.LEDGER), _rows(ev))
    assert first == _as_set(batch)
    # same checkpoint again: nothing new is delivered, nothing changes
    stream_ledger(spark, src, _rows, base + "/table", base + "/ckpt")
    assert _as_set(read_ledger(spark, base + "/table")) == first
    # a replayed micro-batch (same rows folded again) leaves the ledger unchanged
    current = read_ledger(spark, base + "/table")
    keys = _rows(ev).select("file_path").distinct()
    merged = L.upsert_ledger(current.join(keys, "file_path", "left_semi"), _rows(ev))
    BT.replace_keys(spark, base + "/table", C.LEDGER, "file_path", 64, changed=merged)
    assert _as_set(read_ledger(spark, base + "/table")) == first


def test_stream_answers_equal_batch_ties_included_and_replay(spark):
    from quarry.operators.prompts import build_prompts
    from quarry.operators.search import lexical_retrieve
    from quarry.streaming.incremental import stream_answers
    from test_similarity import _one_word_chunks
    base = tempfile.mkdtemp(prefix="quarry-answers-")
    chunks = _one_word_chunks(spark)
    q = spark.createDataFrame([(i, "the cat " * (i % 3 + 1)) for i in range(40)] + [(41, " "), (42, "quit")], C.QUERIES)
    q.repartition(3).write.parquet(base + "/in")
    src = spark.readStream.schema(C.QUERIES).option("maxFilesPerTrigger", 1).parquet(base + "/in")
    stream_answers(spark, src, chunks, base + "/out", base + "/ckpt", 5, 0.1)
    got = sorted(map(str, spark.read.parquet(base + "/out").drop("epoch").collect()))
    from quarry.sources.queries import normalise_queries
    nq = normalise_queries(q)
    want = build_prompts(nq, lexical_retrieve(chunks, nq, k=5, threshold=0.1))
    assert got == sorted(map(str, want.collect())) and len(got) == 40
    # the same questions from the start: every epoch's folder is written again, nothing doubles
    stream_answers(spark, src, chunks, base + "/out", base + "/ckpt2", 5, 0.1)
    assert sorted(map(str, spark.read.parquet(base + "/out").drop("epoch").collect())) == got


VERSIONS = "file_path string, mtime timestamp, text string, read_error string"


def _state(spark, state):
    from quarry.operators.scan import read_state_index, read_state_ledger
    points = sorted((r.source_file, r.chunk_index, r.text) for r in read_state_index(spark, state).collect())
    ledger = sorted((r.file_path, str(r.last_modified), r.status) for r in read_state_ledger(spark, state).collect())
    return points, ledger


def test_stream_files_replaces_and_a_replay_changes_nothing(spark):
    import datetime as dt
    from quarry.api import retrieve
    from quarry.streaming.incremental import _fold_files, stream_files
    base = tempfile.mkdtemp(prefix="quarry-files-")
    day = lambda n: dt.datetime(2024, 1, n)
    batches = [
        [("a.txt", day(1), "alpha " * 200, None), ("b.txt", day(1), "beta", None), ("c.txt", day(1), " ", None), ("b.txt", day(2), "beta two", None)],
        [("a.txt", day(3), "short now", None), ("b.txt", day(3), None, "unreadable"), ("d.txt", day(1), None, None)],
        [("a.txt", day(2), "late version", None), ("c.txt", day(4), "gamma", None), ("b.txt", day(3), "beta three", None)],
    ]
    schema = spark.createDataFrame([], VERSIONS).schema
    for rows in batches:
        spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(base + "/in")
        stream_files(spark, spark.readStream.schema(schema).parquet(base + "/in"), base + "/state", base + "/ckpt", 4, 4)
    points, ledger = _state(spark, base + "/state")
    assert [(f, t) for f, _, t in points] == [("a.txt", "short now"), ("b.txt", "beta three"), ("c.txt", "gamma")]
    assert [(f, s) for f, _, s in ledger] == [("a.txt", "success"), ("b.txt", "success"), ("c.txt", "success"), ("d.txt", "skipped_empty")]
    for rows in batches[1:]:                        # an epoch that is run again after a crash
        _fold_files(spark, spark.createDataFrame(rows, VERSIONS), base + "/state", 4, 4)
    assert _state(spark, base + "/state") == (points, ledger)
    hits = retrieve(spark, base + "/state", ["gamma"], threshold=0.5).collect()
    assert [h.source_file for h in hits] == ["c.txt"]


def test_changed_files_source_sees_overwritten_files(spark):
    import os
    from quarry.sources.changed_files import ChangedFiles, text_events
    from quarry.streaming.incremental import stream_files
    spark.dataSource.register(ChangedFiles)
    base = tempfile.mkdtemp(prefix="quarry-changed-")
    folder = base + "/texts"
    os.makedirs(folder)

    def put(name, data, at):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
        os.utime(f"{folder}/{name}", (at, at))

    def scan():
        src = text_events(spark.readStream.format("changed_files").option("folder", folder).option("suffix", ".txt").load())
        stream_files(spark, src, base + "/state", base + "/ckpt", 4, 4)
        return {(f, t) for f, _, t in _state(spark, base + "/state")[0]}

    put("a.txt", b"one\r\ntwo", 1_000_000)
    put("b.txt", b"bee", 1_000_000)
    put("x.md", b"not listed", 1_000_000)
    assert scan() == {("a.txt", "one\ntwo"), ("b.txt", "bee")}
    put("a.txt", b"three", 1_000_500)
    put("c.txt", b"same tick as the first scan's newest", 1_000_000)
    assert scan() == {("a.txt", "three"), ("b.txt", "bee"), ("c.txt", "same tick as the first scan's newest")}
    put("b.txt", b"\xff\xfe", 1_000_900)
    assert scan() == {("a.txt", "three"), ("b.txt", "bee"), ("c.txt", "same tick as the first scan's newest")}     # unreadable: old points stay
    assert {s for f, _, s in _state(spark, base + "/state")[1] if f.endswith("b.txt")} == {"failed"}


def test_a_batch_without_repeated_paths_stores_its_texts_once_and_shuffles_none(spark, monkeypatch):
    import datetime as dt
    from pyspark.sql import DataFrame, DataFrameWriter
    from quarry.streaming.incremental import _fold_files
    base = tempfile.mkdtemp(prefix="quarry-once-")
    written, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **k):
        written.append((path.rsplit("/", 1)[1], self._df))
        return plain(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = [(f"{i}.txt", dt.datetime(2024, 1, 1), f"text {i}", None) for i in range(20)]
    _fold_files(spark, spark.createDataFrame(rows, VERSIONS), base + "/state", 4, 4)
    texts = [name for name, df in written if "text" in df.columns]
    assert texts == ["versions", "chunks", "index"]
    stored: DataFrame = dict(written)["versions"]
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert _state(spark, base + "/state")[0] == sorted((f"{i}.txt", 0, f"text {i}") for i in range(20))
    # paths that repeat, late versions and known ones
    later = [("1.txt", dt.datetime(2024, 1, 3), "new", None), ("1.txt", dt.datetime(2024, 1, 2), "old", None),
             ("2.txt", dt.datetime(2023, 1, 1), "late", None), ("3.txt", dt.datetime(2024, 1, 1), "same time", None)]
    _fold_files(spark, spark.createDataFrame(later, VERSIONS), base + "/state", 4, 4)
    got = {f: t for f, _, t in _state(spark, base + "/state")[0]}
    assert got == {f"{i}.txt": f"text {i}" for i in range(20)} | {"1.txt": "new"}
