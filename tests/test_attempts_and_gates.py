"""Attempts folded over ranges, against plain loops; the gate of a batch."""

import json
import random

import pytest
from pyspark.sql import functions as F

from wakeline.operators import attempts, ranges
from wakeline.sources import gate


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_attempts(codes, limit):
    partial, failures, phase, out = False, 0, "open", []
    names = {0: "complete", 2: "usage", 65: "blocked", 124: "watchdog", 130: "interrupted"}
    for code in codes:
        action = "skip" if phase == "validated" else "blocked" if phase == "blocked" or failures >= limit else "run"
        archived, ledger = action == "run" and partial, None
        if action == "blocked":
            phase = "blocked"
        elif action == "run":
            partial, ledger = True, names.get(code, "failed")
            phase = {0: "validated", 65: "blocked"}.get(code, "open")
            failures += code not in (0, 65, 130)
        out.append((action, archived, ledger, failures if phase == "open" else None, phase))
    return out


@pytest.mark.parametrize("limit", [1, 3, 40])
def test_a_source_with_very_many_attempts_over_ranges(spark, many_ranges, limit):
    rng = random.Random(limit)
    rows = [("hot", t, rng.choice([1, 124, 130, 130, 130, 130, 2, 0] if limit < 40 or t > 300 else [1, 130, 130, 130, 130, 130, 130, 130, 130, 130, 130])) for t in range(400)]
    rows += [(rng.choice("abc") if t % 9 else None, t, rng.choice([0, 1, 1, 2, 65, 124, 130])) for t in range(60)]
    got = {(r.key, r.t): (r.action, r.archived, r.ledger, r.failures, r.phase) for r in attempts.replayed(spark.createDataFrame(rows, "key string, t long, code int").repartition(3), "key", ["t"], limit).collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((t, c) for k, t, c in rows if k == key)
        assert [got[key, t] for t, _ in own] == plain_attempts([c for _, c in own], limit)


def test_any_machine_is_followed_over_ranges(spark, many_ranges):
    rng = random.Random(9)
    steps = [[rng.randrange(7) for _ in range(7)] for _ in range(3)]
    rows = [(rng.choice([1, 1, 1, 2, 3]), t, rng.randrange(3)) for t in range(500)]
    got = {(r.k, r.t): r.state for r in ranges.fold(spark.createDataFrame(rows, "k int, t int, s int"), ["k"], ["t"], "s", steps, first=4).collect()}
    for k in (1, 2, 3):
        state = 4
        for _, t, s in [r for r in rows if r[0] == k]:
            assert got[k, t] == state
            state = steps[s][state]
    assert ranges.fold(spark.createDataFrame([], "k int, t int, s int"), ["k"], ["t"], "s", steps).collect() == []


def test_limits_of_retries(spark):
    with pytest.raises(ValueError, match="at least one"):
        attempts.replayed(spark.createDataFrame([], "k int, t int, code int"), "k", ["t"], 0)


def staged(spark, tmp_path, rows, plan, **more):
    clips = spark.createDataFrame(rows, "date string, name string, seconds double")
    planned = spark.createDataFrame(plan, "date string, expected long")
    return gate.stage(clips, planned, str(tmp_path / "stage"), {"short": F.col("seconds") >= 5}, "date", "name", **more)


def test_a_right_batch_is_promoted_whole(spark, tmp_path):
    final = str(tmp_path / "final")
    for _ in range(2):
        v = staged(spark, tmp_path, [("d1", "a", 5.0), ("d1", "b", 9.0), ("d2", "c", 6.0)], [("d1", 2), ("d2", 1)], expected_dates=2, expected_clips=3)
        assert v.valid and json.loads(v.summary()) == {"valid": True, "dates": 2, "clips": 3, "errors": []}
        assert sorted((r.date, r["name"]) for r in gate.promote(v, spark, final).collect()) == [("d1", "a"), ("d1", "b"), ("d2", "c")]
    later = staged(spark, tmp_path, [("d2", "new", 7.0)], [("d2", 1)])
    assert sorted(r["name"] for r in gate.promote(later, spark, final).collect()) == ["a", "b", "new"]


def test_one_wrong_clip_stops_all_dates(spark, tmp_path):
    v = staged(spark, tmp_path, [("d1", "a", 5.0), ("d2", "b", 4.0), ("d3", "x", 8.0), ("d2", "c", None)], [("d1", 1), ("d2", 3), ("d4", 0)], expected_dates=28)
    dates = {r.date: (r.clips, r.expected, r.errors, r.valid) for r in v.dates.collect()}
    assert dates == {"d1": (1, 1, [], True), "d2": (2, 3, ["count", "broken"], False), "d3": (1, None, ["unplanned"], False), "d4": (0, 0, [], True)}
    assert not v.valid and v.errors == ["expected 28 dates, found 3", "d2: count, broken", "d2: b short", "d2: c short", "d3: unplanned"]
    with pytest.raises(gate.BatchRejected, match="expected 28 dates, found 3; d2: count, broken"):
        gate.promote(v, spark, str(tmp_path / "final"))
    assert not (tmp_path / "final").exists()


def test_the_first_errors_are_kept_in_order(spark, tmp_path):
    v = staged(spark, tmp_path, [("d", f"{k:03d}", 1.0) for k in range(300)], [("d", 300)])
    assert v.errors == ["d: broken", *(f"d: {k:03d} short" for k in range(9))] and v.n_clips == 300


def test_empty_batches(spark, tmp_path):
    v = staged(spark, tmp_path, [], [])
    assert v.valid and (v.n_dates, v.n_clips) == (0, 0)


def test_inputs_that_may_not_be_worked_on(spark):
    rows = [("d1", True, "clock_v2", "new", 3), ("d2", True, "clock_v2", "old", 4)]
    check = lambda rows, *want: gate.check_inputs(spark.createDataFrame(rows, "date string, valid boolean, method string, layout string, clips long"), "clock_v2", ("old", "new"), *want)
    assert check(rows, 2, 7).count() == 2 and check(rows).count() == 2 and check([], 0, 0).count() == 0
    for row, text in ((("d0", None, "clock_v2", "old", 1), "not valid: d0"), (("d0", True, "v1", "old", 1), "method is not clock_v2"), (("d0", True, "clock_v2", None, 1), "unsupported input layout: d0")):
        with pytest.raises(gate.BatchRejected, match=text):
            check([*rows, row])
    for want, text in (((3, 7), "expected 3 dates, found 2"), ((2, 8), "expected 8 clips, found 7")):
        with pytest.raises(gate.BatchRejected, match=text):
            check(rows, *want)
