"""Burned-in clocks: the fixed point against a plain loop, errors, readings in order."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wakeline import catalog
from wakeline.operators import clocks

REQUEST = "recording string, id long, rear_time double, rear_sample double, rear_clock double, offset double, front_length double"


def plain(request, readings, rounds=4):
    rec, i, rear_time, sample, rear_clock, offset, length = request
    at = min(max(0.0, rear_time - offset), length - 0.001)
    for k in range(1, rounds + 1):
        clock = readings.get((rec, math.floor(at)))
        if clock is None:
            return (rec, i, "no_clock", None, None, None, k)
        delta = rear_clock - clock
        at = math.floor(at) + delta
        if not 0 <= at < length:
            return (rec, i, "out_of_range", None, None, None, k)
        if abs(delta) <= 1:
            front = at + rear_time - sample
            return (rec, i, "converged", round(front, 3), round(rear_time - front, 3), delta, k)
    return (rec, i, "not_converged", None, None, None, rounds)


def test_fixed_point_equals_a_loop(spark):
    rng = random.Random(3)
    readings = {(r, s): float({"even": 50 + s, "fast": 40 + s + s // 20 * 3, "odd": 2 * s}[r]) for r in ("even", "fast", "odd") for s in range(300) if s % 97}
    rows = [(rng.choice(["even", "fast", "odd", "none"]), i, *(float(rng.randrange(300)) for _ in range(2)), float(rng.randrange(20, 420)), float(rng.randrange(-99, 99)), 300.0) for i in range(150)]
    given = spark.createDataFrame([(r, s, c) for (r, s), c in readings.items()], "recording string, second long, clock double")
    for rounds in (1, 4):
        got = clocks.synchronized(spark.createDataFrame(rows, REQUEST), given, ["recording", "id"], rounds)
        assert {tuple(r) for r in got.collect()} == {plain(r, readings, rounds) for r in rows}
    assert {plain(r, readings)[2] for r in rows} == {"no_clock", "out_of_range", "converged", "not_converged"}


def test_what_must_converge_is_an_error_if_it_does_not(spark):
    given = spark.createDataFrame([("a", s, 100.0 + s) for s in range(50)], "recording string, second long, clock double")
    run = lambda clock: clocks.required(clocks.synchronized(spark.createDataFrame([("a", 1, 20.0, 20.0, clock, 0.0, 50.0)], REQUEST), given, ["recording", "id"]), "id")
    assert run(130.0).first().front_time == 30.0
    with pytest.raises(Exception, match="clocks out_of_range for 1"):
        run(500.0).select("id").collect()


def test_query_has_every_status(spark):
    got = {r.status for r in catalog.QUERIES["clock_fixed_point"](spark, "/root/testdata/sf0.001").select("status").distinct().collect()}
    assert got == {"converged", "no_clock", "out_of_range", "not_converged"}


def test_texts_with_a_clock(spark):
    texts = {"CAM 22/05/2026 10:11:12 N52.1 E4.3": 1779444672, "22/45/2026 10:11:12": None, "22-05-2026 10:11:12": None, "30/02/2026 00:00:00": None, "": None, None: None}
    got = {r.t: r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", clocks.written(F.col("t")).alias("c")).collect()}
    assert got == texts


def test_attempts_outside_the_medium_are_left_out(spark):
    rows = spark.createDataFrame([(1, 0.1), (2, 9.9), (3, 5.0)], "id long, at double")
    text = lambda a, c: F.when(((a != 0) | (F.col("id") == 3)) & (c == 180), "x 01/01/2024 00:00:00")
    got = {r.id: (r.adjustment, r.contrast) for r in clocks.first_reading(rows, ["id"], text, F.lit(10.0)).collect()}
    assert got == {1: (0.4, 180), 2: (-0.4, 180), 3: (0.0, 180)}
    assert clocks.first_reading(rows, ["id"], lambda a, c: F.lit("nothing")).select("clock_seconds").distinct().collect() == [(None,)]


def test_readings_exploded_from_few_rows_are_not_broadcast(spark, monkeypatch):
    plans, settle = [], clocks.settle
    few = settle(spark.createDataFrame([("a",)], "recording string"))  # files have a size
    monkeypatch.setattr(clocks, "settle", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), settle(df))[1])
    given = few.select("recording", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(49).cast("long"))).alias("second"))
    got = clocks.synchronized(spark.createDataFrame([("a", 1, 20.0, 20.0, 130.0, 0.0, 50.0)], REQUEST), given.withColumn("clock", F.col("second") + 100.0), ["recording", "id"])
    assert got.first().front_time == 30.0
    assert plans and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
