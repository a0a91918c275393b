"""Only bodies within the wanted files' modification times are read."""

import os
import tempfile

from quarry.sources.files import list_files, mtime_spans, text_loader


def test_spans_cover_all_days_and_are_few():
    days = [(10 * d, 10 * d + 3) for d in range(100)] + [(5000, 5003)]
    spans = mtime_spans(days, most=8)
    assert len(spans) == 8 and spans[-1] == (5000, None)
    assert all(any(lo <= a and (hi is None or b <= hi) for lo, hi in spans) for a, b in days)
    assert mtime_spans(days[:3], most=8) == [(0, 3), (10, 13), (20, None)] and mtime_spans([]) == []


def test_an_old_file_does_not_make_the_scan_read_everything(spark):
    folder = tempfile.mkdtemp(prefix="quarry-spans-")
    day = 86_400
    for i in range(40):
        with open(f"{folder}/f{i}.txt", "w") as f:
            f.write(f"text {i}")
        os.utime(f"{folder}/f{i}.txt", (1_700_000_000 + i * day, 1_700_000_000 + i * day))
    files = list_files(spark, folder, ".txt")
    wanted = files.filter("source_file in ('f0.txt', 'f38.txt', 'f39.txt')")
    loaded = text_loader(spark, folder)(wanted)
    assert {r.source_file: r.text for r in loaded.collect()} == {f"f{i}.txt": f"text {i}" for i in (0, 38, 39)}
    scans = [line for line in loaded._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line or "binaryFile" in line]
    assert any("Or(" in line or "Or (" in line for line in scans)
    # what is written after the listing is read as it stands
    last = spark.createDataFrame(files.filter("source_file = 'f39.txt'").collect(), files.schema)
    with open(f"{folder}/f39.txt", "w") as f:
        f.write("newer")
    assert {r.text for r in text_loader(spark, folder)(last).collect()} == {"newer"}
    assert text_loader(spark, folder)(files.filter("false")).count() == 0


def test_a_scan_of_many_small_files_has_few_tasks(spark, tmp_path):
    from quarry.sources import files as FS
    for i in range(150):
        (tmp_path / f"f{i}.txt").write_text(f"text {i}")
    was = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))              # as if a task held one file
    try:
        most = FS.READ_WAVES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        read, listed = FS.read_text_files(spark, str(tmp_path), suffix=".txt"), FS.list_files(spark, str(tmp_path), ".txt")
        assert most < 150
        assert read.rdd.getNumPartitions() <= most and listed.rdd.getNumPartitions() <= most
        assert {r.text for r in read.collect()} == {f"text {i}" for i in range(150)} and listed.count() == 150
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", was)
