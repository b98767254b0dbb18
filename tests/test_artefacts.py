"""Rule sets on an inventory: a consistent result is valid, and each thing that is wrong is named."""

import pytest
from pyspark.sql import functions as F

from wakeline import catalog
from wakeline.operators import artefacts

ROOT = "/srv/out"
EVIDENCE = [f"{ROOT}/b/v/{n}" for n in artefacts.EVIDENCE] + [f"{ROOT}/bench/v/benchmark.json"]


def camera(spark, run=None, files=None, rows=(), lines=0, **change):
    facts = {"result_dir": f"{ROOT}/b/v", "benchmark_dir": f"{ROOT}/bench/v", "heartbeat": "complete", "samples": 5} | change
    run = {"run_source": "s", "run_camera": "rear", "weights": "w", "device": "0", "decode": "hw", "sample_fps": 5.0, "run_size": 10, "run_duration": 60.0, "processed_seconds": 60.0, "wall_seconds": 7.0, "n_events": 0, "candidate_events": 0, "completed_tracks": 0, "clips_enabled": False, "unreadable": False} | (run or {})
    one = lambda schema, *values: spark.createDataFrame([values], schema)
    manifest = one("key long, camera string, source string, duration double, size long, result_dir string, benchmark_dir string", 1, "rear", "s", 60.0, 10, facts["result_dir"], facts["benchmark_dir"])
    kinds = "result_dir string, run_source string, run_camera string, weights string, device string, decode string, sample_fps double, run_size long, run_duration double, processed_seconds double, wall_seconds double, n_events long, candidate_events long, completed_tracks long, clips_enabled boolean, unreadable boolean"
    runs = one(kinds, facts["result_dir"], *run.values())
    beats = one("result_dir string, heartbeat string, heartbeat_source string, unreadable boolean", facts["result_dir"], facts["heartbeat"], "s", False)
    bench = one("benchmark_dir string, benchmark_source string, benchmark_seconds double, samples long, telemetry_available boolean, unreadable boolean", facts["benchmark_dir"], "s", 60.005, facts["samples"], None, False)
    event_rows = spark.createDataFrame([(facts["result_dir"], c) for c in rows], "result_dir string, clip string")
    tracks = one("result_dir string, n_lines long", facts["result_dir"], lines)
    inventory = spark.createDataFrame(files if files is not None else [(p, 5, 1000) for p in EVIDENCE], "path string, bytes long, uid long")
    r = artefacts.camera_results(manifest, runs, beats, bench, event_rows, tracks, inventory, ROOT, 1000, "w", "0", "hw", 5.0).collect()
    assert len(r) == 1
    return r[0]


def test_a_consistent_result_without_events_is_valid(spark):
    assert camera(spark)[1:] == ([], [], True, None)
    assert camera(spark, samples=0).warning == "no_telemetry"


def test_what_ends_the_check_is_told_alone(spark):
    files = [(p, 5, 1000) for p in EVIDENCE if "tracks" not in p and "bench" not in p]
    assert camera(spark, run={"run_source": "x"}, files=files).errors == ["missing benchmark.json", "missing tracks.jsonl"]
    assert camera(spark, result_dir=f"{ROOT}/../b/v").errors[0] == "result_outside"


@pytest.mark.parametrize("run,errors", [({"sample_fps": None}, ["sample_rate"]), ({"run_duration": 60.2, "processed_seconds": 58.0}, ["duration", "processed", "benchmark_seconds"]), ({"candidate_events": 2, "completed_tracks": 1}, ["events", "event_rows", "track_lines"])])
def test_facts_that_differ_are_named(spark, run, errors):
    assert camera(spark, run).errors == errors


def test_documents_that_do_not_parse_count_as_empty(spark):
    r = camera(spark, {"unreadable": True})
    assert r.errors[0] == "unreadable" and {"source", "weights", "heartbeat", "wall"} <= set(r.errors) and not r.valid


def test_clips_and_owners(spark):
    files = [(p, 5, 0 if "events" in p else 1000) for p in EVIDENCE] + [(f"{ROOT}/c/a.mp4", 9, 1000), (f"{ROOT}/c/b.mp4", 0, 1000)]
    on = {"clips_enabled": True, "n_events": 4, "candidate_events": 4}
    r = camera(spark, on, files, ["/output/c/a.mp4", "/output/c/b.mp4", "/output/c/z.mp4", "/tmp/a.mp4"])
    assert r.errors == ["clips", "owner"] and r.details == ["clip_empty", "clip_missing", "clip_path", "owner of events.csv"]
    assert camera(spark, on | {"clips_enabled": False}, None, ["", "", None, "/output/c/a.mp4"]).errors == ["clips"]
    assert camera(spark, on, files[:0] + [(p, 5, 1000) for p in EVIDENCE] + [(f"{ROOT}/c/a.mp4", 9, 1000)], ["/output/c/a.mp4"] * 4).valid


def combined(spark, document=None, event=None, files=None):
    document = {"schema_version": 3, "method": "v2", "layout": "new", "tolerance": 1.5, "accepted": 1, "combined_clips": 1, "attempted": 1, "n_skipped": 0, "unreadable": False} | (document or {})
    event = {"event_method": "v2", "front_track_id": 4, "residual": -1.5, "clip": "/output/c/x.mp4", "width": 2560, "height": 720, "seconds": 5.0} | (event or {})
    dates = spark.createDataFrame([("d", f"{ROOT}/combined/d")], "date string, result_dir string")
    docs = spark.createDataFrame([("d", *document.values())], "date string, schema_version int, method string, layout string, tolerance double, accepted long, combined_clips long, attempted long, n_skipped long, unreadable boolean")
    progress = spark.createDataFrame([("d", "complete", False)], "date string, progress string, unreadable boolean")
    events = spark.createDataFrame([("d", *event.values())], "date string, event_method string, front_track_id long, residual double, clip string, width int, height int, seconds double")
    default = [(f"{ROOT}/combined/d/{n}", 3, 1000) for n in ("combined.json", "progress.json")] + [(f"{ROOT}/c/x.mp4", 8, 1000)]
    inventory = spark.createDataFrame(default if files is None else files, "path string, bytes long, uid long")
    return artefacts.combined_results(dates, docs, progress, events, inventory, ROOT, 1000, "v2", "new").first().errors


def test_combined_clips_need_evidence_of_their_handoff(spark):
    assert combined(spark) == []
    assert combined(spark, {"method": "v1", "layout": "old", "schema_version": 2}) == ["schema", "method", "layout"]
    assert combined(spark, None, {"event_method": None, "front_track_id": 0, "residual": None}) == ["event_method", "front_track", "residual_evidence"]
    assert combined(spark, None, {"residual": 1.6, "seconds": 4.9, "height": 721}) == ["dimensions", "residual", "short"]
    assert combined(spark, {"tolerance": 2.1}) == ["tolerance"]
    assert combined(spark, {"attempted": 3, "accepted": 0}) == ["accepted", "attempted"]


def test_later_checks_of_a_clip_need_the_earlier_ones(spark):
    assert combined(spark, None, {"clip": "/output/../x.mp4", "seconds": 0.0}) == ["clip_outside"]
    assert combined(spark, None, {"clip": "/output/c/gone.mp4", "seconds": 0.0}) == ["clip_missing"]


def test_documents_of_a_date_must_be_there_and_parse(spark):
    assert combined(spark, {"unreadable": True})[:2] == ["readable", "schema"]
    assert combined(spark, None, None, [])[:2] == ["evidence", "schema"]


def test_queries_show_many_kinds_of_errors(spark):
    for name, least in (("camera_artefacts", 15), ("combined_artefacts", 15)):
        kinds = catalog.QUERIES[name](spark, "/root/testdata/sf0.01").select(F.explode("errors")).distinct().count()
        assert kinds >= least
