"""Settings, the older offset search, lookups that must hit, lane lines, composed rows."""

import pytest

from wakeline import settings
from wakeline.operators import matching, rules, summary


def test_settings_come_from_defaults_environment_and_session(spark):
    assert settings.load(None, {}) == settings.Settings() and settings.load(None, {"WAKELINE_BATCH_NAME": ""}).batch_name == "batch-1"
    env = {"WAKELINE_COMPOSITION_WORKERS": "8", "WAKELINE_OUTPUT_ROOT": "/x", "OTHER": "1"}
    assert (settings.load(None, env).composition_workers, settings.load(None, env).output_root) == (8, "/x")
    spark.conf.set("spark.wakeline.composition_workers", "16")
    try:
        assert settings.load(spark, env).composition_workers == 16
    finally:
        spark.conf.unset("spark.wakeline.composition_workers")


@pytest.mark.parametrize("change", [{"batch_name": "a b"}, {"batch_name": "../x"}, {"composition_workers": 0}, {"composition_workers": 17}, {"review_workers": 9}, {"max_source_failures": 0}, {"expected_front_files": -1}])
def test_settings_out_of_bounds(change):
    with pytest.raises(ValueError):
        settings.Settings(**change)


def test_settings_that_are_no_numbers():
    with pytest.raises(ValueError, match="not a number: 'many'"):
        settings.load(None, {"WAKELINE_MAX_SOURCE_FAILURES": "many"})


def lanes(spark, rear, front):
    return (spark.createDataFrame(rows, f"key string, {name}_id long, t double") for rows, name in ((rear, "rear"), (front, "front")))


def test_offset_of_two_event_sequences(spark):
    rear, front = lanes(spark, [("k", i, t) for i, t in enumerate((110.0, 210.0, 310.0, 410.0))] + [("alone", 9, 1.0)], [("k", i, t) for i, t in enumerate((105.0, 205.0, 305.0, 405.0))])
    got = {r.key: r for r in matching.event_offset(rear, front, 5.0, 2.0, 100.0, 0.0).collect()}
    assert (got["k"].offset, got["k"].matches, got["k"].anchor_rear, got["k"].anchor_front, got["k"].method) == (10.0, 4, 0, 0, "event_sequence")
    assert tuple(got["alone"]) == ("alone", 0.0, 0, None, None, "duration_fallback")


def test_the_offset_nearest_to_the_fallback_wins_among_equals(spark):
    rear, front = lanes(spark, [("k", 1, 100.0)], [("k", 1, 70.0), ("k", 2, 40.0)])
    find = lambda fallback: matching.event_offset(rear, front, 0.0, 2.0, 100.0, fallback).first()
    assert (find(25.0).offset, find(65.0).offset) == (30.0, 60.0)
    # a seed may lie beyond the bound
    far = matching.event_offset(*lanes(spark, [("k", 1, 500.0)], [("k", 1, 100.0)]), 0.0, 2.0, 100.0, 400.0).first()
    assert (far.offset, far.matches) == (400.0, 1)


def test_lookups_must_hit_once(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    table = lambda *r: spark.createDataFrame(list(r), "k int, e string")
    assert sorted(tuple(r) for r in rules.looked_up(rows, table((1, "a"), (2, "b"), (3, "c")), ["k"], "event").collect()) == [(1, "x", "a"), (2, "y", "b")]
    with pytest.raises(Exception, match='no event for {"k":2}'):
        rules.looked_up(rows, table((1, "a")), ["k"], "event").select("v").collect()
    with pytest.raises(Exception, match="more than one event for"):
        rules.looked_up(rows, table((1, "a"), (1, "b"), (2, "c")), ["k"], "event").collect()


def test_lane_lines(spark):
    runs = spark.createDataFrame([("rear", 120.0, 9.5), ("front", 119.96, 10.126), ("side", 1.0, 1.0)], "camera string, processed_source_seconds double, wall_seconds double")
    assert [r.line for r in summary.lane_lines(runs).orderBy("place").collect()] == ["front: 120.0s source in 10.13s wall", "rear: 120.0s source in 9.50s wall"]
    with pytest.raises(Exception, match="no run of rear"):
        summary.lane_lines(runs.where("camera <> 'rear'")).collect()


def test_composed_rows_are_planned(spark):
    pairs = spark.createDataFrame([("d", 1, 2, 50.0, 10.0, 0.25), ("d", 3, 4, 2.0, -1.0, 0.0), ("d", 5, 6, 99.0, 10.0, 0.0)], "key string, rear_id long, front_id long, rear_time double, offset double, residual double")
    got = {r.rear.track_id: r for r in matching.composed(matching.clip_plan(pairs, 100.0, 100.0)).collect()}
    assert sorted(got) == [1, 3]  # the third has four seconds left
    r = got[1]
    assert (r.rear.start, r.front.start, r.seconds, r.synchronization.clock_residual, tuple(r.media)) == (47.0, 37.0, 7.0, 0.25, (2560, 720, 7.0, True))
