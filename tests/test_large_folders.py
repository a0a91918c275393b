"""Folders of more files than the driver may hold are listed and read by tasks, with the rows that Spark's reader gives."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from quarry.operators import scan as S
from quarry.sources import files as FS


@pytest.fixture()
def odd(tmp_path):
    """A folder of odd names, and a subfolder; some of it is no file that Spark's reader lists."""
    folder = tmp_path / "texts"
    (folder / "dir.txt").mkdir(parents=True)
    (folder / "dir.txt" / "inner.txt").write_text("not listed")
    for name, content in {"a.txt": b"caf\xc3\xa9\r\nsecond\rthird", "bad.txt": b"\xff\xfe", "empty.txt": b"", "blank.txt": b" \n", "sp ace%20#.txt": b"x", "_k=v.txt": b"x",
                          "_hidden.txt": b"x", ".dot.txt": b"x", "_metadata.txt": b"x", "UPPER.TXT": b"x", "new\nline.txt": b"x", ".txt": b"x"}.items():
        (folder / name).write_bytes(content)
    if sys.platform == "linux":
        with open(os.fsencode(folder) + b"/bytes\xff.txt", "wb") as f:
            f.write(b"x")
    (folder / "link.txt").symlink_to(folder / "a.txt")
    (folder / "broken.txt").symlink_to(folder / "none")
    for i in range(30):
        (folder / f"f{i}.txt").write_text(f"text {i}")
        os.utime(folder / f"f{i}.txt", ns=(0, 1_700_000_000_123_456_789 + i * 86_400_000_000_000))
    return str(folder)


def _rows(df):
    return sorted(map(repr, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_folder_is_listed_by_tasks_as_spark_lists_it(spark, odd, monkeypatch):
    for folder in (odd, "file://" + odd, odd + "/"):
        monkeypatch.setattr(FS, "DRIVER_FILES", 1000)
        few = FS.list_files(spark, folder, ".txt")
        monkeypatch.setattr(FS, "DRIVER_FILES", 10)
        many = FS.list_files(spark, folder, ".txt")
        assert "binaryFile" in _plan(few) and "binaryFile" not in _plan(many)
        assert few.schema == many.schema and _rows(few) == _rows(many) and many.count() > 30
    assert FS.list_files(spark, odd, ".none").count() == 0


def test_wanted_files_of_a_large_folder_are_opened_by_tasks(spark, odd, tmp_path, monkeypatch):
    small = tmp_path / "small"
    small.mkdir()
    (small / "s.txt").write_text("small")
    monkeypatch.setattr(FS, "DRIVER_FILES", 10)
    files = FS.list_folders(spark, {".txt": odd}).unionByName(FS.list_files(spark, str(small), ".txt")).filter(~F.col("source_file").isin("f3.txt", "f4.txt"))
    files = spark.createDataFrame(files.collect() * 2, files.schema)                     # rows may come twice
    stray = spark.createDataFrame([(f"file:{odd}/{n}", None) for n in ("gone.txt", "dir.txt/inner.txt", "UPPER.TXT", ".dot.txt")] + [(None, None)], "file_path string, mtime timestamp")
    wanted = files.select("file_path", "mtime").unionByName(stray)
    many = FS.text_loader(spark, odd)(wanted)
    both = FS.text_loader(spark, [odd, str(small)])(wanted)
    assert "binaryFile" not in _plan(many) and "binaryFile" in _plan(both)
    monkeypatch.setattr(FS, "DRIVER_FILES", 1000)
    few = FS.text_loader(spark, odd)(wanted)
    assert few.columns == many.columns and few.dtypes == many.dtypes and _rows(few) == _rows(many)
    assert _rows(FS.text_loader(spark, [odd, str(small)])(wanted)) == _rows(both) and both.count() == many.count() + 1
    assert {r.source_file: r.read_error is not None for r in many.collect()}["bad.txt"]
    # what is written, emptied or removed after the listing is read as it stands
    for name, content in (("f0.txt", "newer"), ("f1.txt", ""), ("f2.txt", None)):
        os.remove(f"{odd}/{name}")
        if content is not None:
            with open(f"{odd}/{name}", "w") as f:
                f.write(content)
    assert [(r.source_file, r.text) for r in many.filter(F.col("source_file").isin("f0.txt", "f1.txt", "f2.txt")).collect()] == [("f0.txt", "newer")]


def test_bodies_leave_a_task_in_small_batches(spark, odd, monkeypatch):
    monkeypatch.setattr(FS, "DRIVER_FILES", 10)
    was = _rows(FS.text_loader(spark, odd)(FS.list_files(spark, odd, ".txt")))
    for name, most in (("BATCH_FILES", 1), ("BATCH_BYTES", 7)):
        monkeypatch.setattr(FS, name, most)
        assert _rows(FS.text_loader(spark, odd)(FS.list_files(spark, odd, ".txt"))) == was


def test_a_state_goes_on_when_its_folder_becomes_large(spark, odd, tmp_path, monkeypatch):
    runs = []
    for name, limits in (("small", (1000, 1000, 1000)), ("grows", (1000, 10, 10))):
        folder, state = tmp_path / name, str(tmp_path / f"state-{name}")
        folder.mkdir()
        for i in range(15):
            (folder / f"f{i}.txt").write_text("" if i == 5 else " " if i == 6 else f"word{i} " * 200)
            os.utime(folder / f"f{i}.txt", ns=(0, 1_700_000_000_123_456_789 + i))
        told = []
        for turn, most in enumerate(limits):
            monkeypatch.setattr(FS, "DRIVER_FILES", most)
            if turn == 2:
                (folder / "f7.txt").write_text("short")
                (folder / "f8.txt").write_text(" ")
                os.remove(folder / "f9.txt")
            run = S.run_scan(spark, {".txt": str(folder)}, state, index_buckets=2, ledger_buckets=1)
            told.append((sorted((os.path.basename(r.file_path), r.reason) for r in run["changes"].collect()),
                         sorted((r.source_file, r.chunk_index, r.text) for r in run["index"].collect()),
                         sorted((os.path.basename(r.file_path), r.status) for r in run["ledger"].collect())))
        runs.append(told)
    assert runs[0] == runs[1]
    first, again, later = ({n: reason for n, reason in t[0]} for t in runs[0])
    assert set(first.values()) == {"new"} and "f5.txt" not in first                         # an empty file is not listed
    assert again == {n: "retry" if n == "f6.txt" else "unchanged" for n in first}
    assert later["f7.txt"] == later["f8.txt"] == "modified" and later["f9.txt"] == "missing" and later["f10.txt"] == "unchanged"
