"""Section numbers by prefix counts, and upload checks by observed writes."""

import tempfile

from pyspark.sql import functions as F

from quarry.sources.tables import number_sections


def test_a_file_of_most_rows_is_numbered_by_many_tasks(spark):
    rows = [("big", (i * 37) % 4000, f"t{i}") for i in range(4000)] + [(f"f{i % 9}", i, "x") for i in range(90)] + [(None, 3, "n"), (None, None, "m")]
    df = spark.createDataFrame(rows, "file string, turn int, text string").repartition(5)
    out = number_sections(df, "file", ["turn", "text"], parts=12)
    got = {}
    for r in out.collect():
        got.setdefault(r.file, []).append((r.section_no, r.n_sections, r.turn))
    for file, nums in got.items():
        nums.sort()
        assert [n for n, _, _ in nums] == list(range(1, len(nums) + 1)) and {t for _, t, _ in nums} == {len(nums)}
        turns = [t for _, _, t in nums]
        assert turns == sorted(turns, key=lambda t: (t is not None, t or 0))
    assert len(got["big"]) == 4000 and len(got) == 11
    part = df.repartitionByRange(12, "file", "turn", "text").filter("file = 'big'").groupBy(F.spark_partition_id()).count()
    assert part.count() > 6                         # the range parts one file
    assert number_sections(df.limit(0), "file", ["turn"]).count() == 0


def test_observed_writes_count_per_file_only_when_points_are_lost(spark, monkeypatch):
    from quarry.operators import ingest as G
    base = tempfile.mkdtemp(prefix="quarry-upload-")
    files = spark.createDataFrame([(f"{c}.txt", "txt") for c in "abc"], "source_file string, file_type string")
    sections = files.withColumn("text", F.lit("word"))
    chunks = spark.createDataFrame([("a.txt", i) for i in range(4)] + [("b.txt", i) for i in range(4)], "source_file string, chunk_index int")
    calls = []
    real = G.document_status
    monkeypatch.setattr(G, "document_status", lambda f, s, c, u=None: calls.append(u is not None) or real(f, s, c, u))

    def run(name, points):
        def store(df, part):
            df.write.parquet(f"{base}/{name}-{part}")
            return spark.read.parquet(f"{base}/{name}-{part}")
        return {r.source_file: (r.status, r.error_message) for r in G.upload_status(files, sections, chunks, points, store)[1].collect()}

    assert run("all", chunks)["b.txt"] == ("success", None) and calls == [False]
    lost = run("lost", chunks.filter("not (source_file = 'b.txt' and chunk_index = 2)"))
    assert lost["b.txt"] == ("failed", "Mismatch in uploaded chunks count. Expected 4, got 3.") and lost["a.txt"][0] == "success"
    # as many points as before, but of another file
    moved = chunks.withColumn("source_file", F.when(F.col("chunk_index") == 3, "a.txt").otherwise(F.col("source_file")))
    assert run("moved", moved)["b.txt"][0] == "failed" and calls == [False, True, True]
