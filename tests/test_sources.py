import json

import pytest
from pyspark.sql import functions as F

from wakeline.sources import readers, writers


def test_rates(spark):
    rows = spark.createDataFrame([("30000/1001",), ("25",), ("5/0",), ("x/2",), ("1/2/3",), ("",), (None,)], "r string")
    got = [r[0] for r in rows.select(readers.rational(F.col("r"))).collect()]
    assert got == [30000 / 1001, 25.0, None, None, None, None, None]


def test_media_facts_take_the_first_video_stream(spark):
    doc = {"streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 1280, "height": 720, "avg_frame_rate": "30/2"}, {"codec_type": "video", "width": 1}], "format": {"duration": "2.5", "size": "10"}}
    rows = spark.createDataFrame([(json.dumps(doc),), ("{}",), ("no json",), (None,)], "p string").select(readers.media_facts(F.col("p")).alias("m")).select("m.*")
    got = [tuple(r) for r in rows.collect()]
    assert got == [(1280, 720, 15.0, 2.5, 10)] + [(None,) * 5] * 3


def test_documents_of_another_camera_end_the_read(spark, tmp_path):
    for name, camera in (("a", "front"), ("b", "rear")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"camera": camera, "events": [{"id": 1}] if name == "a" else None}, indent=1))
    docs = readers.run_documents(spark, str(tmp_path), "camera string, events array<struct<id:long>>")
    assert sorted(r["camera"] for r in docs.collect()) == ["front", "rear"]
    assert [tuple(r) for r in readers.events_of(docs, ["camera"]).collect()] == [("front", 1)]
    with pytest.raises(Exception, match="not a document of this camera"):
        readers.run_documents(spark, str(tmp_path), "camera string", "front").collect()


def test_recordings_lines_and_telemetry(spark, tmp_path):
    (tmp_path / "videos" / "2024-01-02").mkdir(parents=True)
    (tmp_path / "videos" / "2024-01-02" / "a.b.mp4").write_bytes(b"12345")
    (tmp_path / "videos" / "2024-01-02" / "note.txt").write_text("x\n\ny\n")
    got = readers.recordings(spark, str(tmp_path / "videos")).drop("path").collect()
    assert [tuple(r) for r in got] == [("2024-01-02", "a.b", 5)]
    assert [r["n_lines"] for r in readers.line_counts(spark, str(tmp_path / "videos" / "2024-01-02" / "note.txt")).collect()] == [2]
    (tmp_path / "t.csv").write_text("at,watts\n1,10\n2,\n3,30\n4,40\n")
    rows = readers.telemetry(spark, str(tmp_path / "t.csv"), "at int, watts double", "at", 2, 3)
    assert sorted((r["at"], r["watts"]) for r in rows.collect()) == [(2, None), (3, 30.0)]


def test_promotion_replaces_only_valid_partitions(spark, tmp_path):
    path = str(tmp_path / "final")
    rules = {"positive": F.col("x") > 0}
    rows = lambda *r: spark.createDataFrame(list(r), "date string, x int")
    writers.promote(rows(("a", 1), ("b", 2)), path, rules)
    staged = rows(("a", 5), ("b", 6), ("b", -1), ("c", None))
    for _ in range(2):
        report = {r["date"]: r["promoted"] for r in writers.promote(staged, path, rules).collect()}
        assert report == {"a": True, "b": False, "c": False}
        assert sorted((r["date"], r["x"]) for r in spark.read.parquet(path).collect()) == [("a", 5), ("b", 2)]


def test_ledgers_grow(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for state in ("failed", "done"):
        writers.append_attempts(spark.createDataFrame([("front", state)], "lane string, state string"), path)
    assert sorted(r["state"] for r in spark.read.parquet(path).collect()) == ["done", "failed"]
