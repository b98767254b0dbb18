"""Watchdog timers and tables kept by key, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wakeline.session import new_folder
from wakeline.sources import keyed
from wakeline.streaming import replay, sessions, tail, watchdog

T0 = datetime(2024, 1, 1)


def at(s):
    return T0 + timedelta(seconds=s)


def test_watchdog_reports_the_never_heard_of_and_clears_who_comes_back(spark):
    # (worker, second, is a beat); 10 s of silence are too long, exactly 10 s are not
    rows = [("a", 0, False), ("b", 0, False), ("b", 5, True), ("c", 30, False), ("c", 35, True), ("b", 41, True), ("d", 40, False), ("d", 50, True), ("e", 100, False), ("f", 38, True), ("f", 39, False)]
    df = spark.createDataFrame([(w, at(s), b) for w, s, b in rows], "w string, ts timestamp, beat boolean")
    want = {("a", "no_heartbeat", 10, 0, 0), ("b", "silent", 15, 5, 1), ("b", "back", 41, 5, 1), ("b", "silent", 51, 41, 2), ("c", "silent", 45, 35, 1), ("d", "silent", 60, 50, 1), ("f", "silent", 49, 39, 1)}
    for slices in (1, 3):
        with watchdog.timers(spark):
            found = replay.in_slices(df, "ts", slices, lambda s: watchdog.watched(s, "w", "ts", "beat", 10, "0 seconds"))
        assert {(r.worker, r.report, (r["at"] - T0).total_seconds(), (r.last_seen - T0).total_seconds(), r.beats) for r in found.collect()} == want
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


SCHEMA = "k string, t long, v string"


def kept(spark, *batches):
    t = keyed.KeyedTable(new_folder(spark), spark.createDataFrame([], SCHEMA).schema, ("k",), ("t",), 4).create(spark)
    for n, b in enumerate(batches):
        assert t.merge(spark.createDataFrame(b, SCHEMA), n) == bool(b)
    return t


def test_last_writer_wins_and_replays_change_nothing(spark):
    one, two = [("a", 1, "x"), ("b", 5, "y"), (None, 1, "n"), ("a", 3, "z")], [("b", 4, "old"), ("c", 1, "c"), ("a", 9, "new")]
    t = kept(spark, one, two, [])
    rows = lambda **k: {tuple(r) for r in t.read(spark, **k).collect()}
    now = {("a", 9, "new"), ("b", 5, "y"), (None, 1, "n"), ("c", 1, "c")}
    assert rows() == now and rows(as_of=0) == {("a", 3, "z"), ("b", 5, "y"), (None, 1, "n")} and rows(as_of=-1) == set()
    assert not t.merge(spark.createDataFrame([("a", 99, "again")], SCHEMA), 1) and rows() == now


def test_a_merge_that_broke_off_is_not_seen_and_can_be_given_again(spark):
    t = kept(spark, [("a", 1, "x")])
    # rows were written, the log was not
    spark.createDataFrame([("a", 7, "half", 0)], SCHEMA + ", bucket int").write.partitionBy("bucket").parquet(f"{t.path}/rows/batch=1")
    assert [tuple(r) for r in t.read(spark).collect()] == [("a", 1, "x")]
    assert t.merge(spark.createDataFrame([("a", 2, "whole")], SCHEMA), 1)
    assert [tuple(r) for r in t.read(spark).collect()] == [("a", 2, "whole")]


def test_only_touched_buckets_are_written(spark):
    t = kept(spark, [(str(k), 1, "x") for k in range(100)], [("7", 2, "y")])
    latest = t._latest(spark)
    assert sorted(latest) == [0, 1, 2, 3] and sorted(latest.values()) == [0, 0, 0, 1]
    assert t.read(spark).count() == 100


def test_equal_times_have_one_winner(spark):
    for order in (1, -1):
        t = kept(spark, [("a", 1, "x"), ("a", 1, "y")][::order])
        assert [tuple(r) for r in t.read(spark).collect()] == [("a", 1, "y")]


def test_updates_by_key_must_hit_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    change = lambda *r: spark.createDataFrame(list(r), "k int, v string, clip string")
    got = keyed.updated(base, change((2, None, "c")), ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", None), (2, None, "c")]
    with pytest.raises(Exception, match="not there"):
        keyed.updated(base, change((3, "x", "c")), ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        keyed.updated(base, change((2, "x", "c"), (2, "y", "d")), ["k"]).select(F.col("k")).collect()


def test_samples_are_cut_to_their_runs(spark):
    rows = spark.createDataFrame([(at(s), s, float(s)) for s in range(0, 100, 10)], "at timestamp, second long, value double")
    runs = spark.createDataFrame([("one", 20, 40), ("edge", 90, 90), ("late", 91, 99), ("over", 35, 62), ("wrong", 50, 20)], "run string, start long, end long")
    for bucket in (1, 25, 1000):
        found = replay.in_slices(rows, "at", 2, lambda s, b=bucket: tail.in_runs(s, runs, "second", b), mode="append", csv=True)
        got = {}
        for r in found.collect():
            got.setdefault(r.run, []).append(r.second)
        assert {k: sorted(v) for k, v in got.items()} == {"one": [20, 30, 40], "edge": [90], "over": [40, 50, 60]}


def test_statistics_of_runs_that_share_their_time_make_no_row_for_each_sample(spark):
    rng = random.Random(5)
    samples = [(rng.randrange(-300, 70_000), rng.choice([None, 1.5, -2.0, 7.25])) for _ in range(3000)] + [(None, 1.0)]
    runs = [(k, a, a + rng.choice([-1, 0, 1, 7, 8, 63, 64, 500, 9000, 40_000, 200_000])) for k in range(300) for a in [rng.randrange(-400, 71_000)]]
    df, laid = spark.createDataFrame(samples, "second long, value double"), spark.createDataFrame(runs, "run long, start long, end long")
    parts = [tail.by_second(d, "second", "value") for d in df.randomSplit([0.3, 0.7], 1)]
    found = tail.statistics(parts[0].unionByName(parts[1]), laid, "run")
    want = {}
    for run, a, b in runs:
        own = [v for s, v in samples if s is not None and a <= s <= b]
        known = [v for v in own if v is not None]
        if own:
            want[run] = (len(own), sum(known) / len(known) if known else None, min(known, default=None), max(known, default=None))
    assert {r.run: tuple(r)[1:] for r in found.collect()} == want and 100 < len(want) < 300
    # a second belongs to one block of a run, and a run has few blocks
    once = laid.where("end >= start").select("run", "start", "end", F.explode(tail._blocks(F.col("start"), F.col("end"))).alias("c"))
    size = F.pow(F.lit(tail.BASE), F.col("c.level"))
    told = once.groupBy("run", "start", "end").agg(F.sum(size).alias("long"), F.count("*").alias("n"), F.countDistinct("c").alias("apart")).collect()
    assert all(r.long == r.end - r.start + 1 and r.n == r.apart and r.n <= 80 for r in told)


def test_feeds_are_ready_after_two_samples(spark, tmp_path):
    states = []
    rows = spark.createDataFrame([("a", at(0)), ("b", at(1)), ("a", at(50)), ("c", at(60))], "feed string, at timestamp")
    replay.in_slices(rows, "at", 2, lambda s: tail.readiness(s, "feed"), lambda b, k: states.append({r.feed: (r.samples, r.ready) for r in b.collect()}))
    assert [s for s in states if s] == [{"a": (1, False), "b": (1, False)}, {"a": (2, True), "c": (1, False)}]
    (tmp_path / "x.csv").write_text("second,value\n1,2.5\n")
    assert tail.samples(spark, str(tmp_path), "second long, value double").isStreaming


@pytest.mark.parametrize("slices", [1, 3])
def test_sessions_of_a_frame_stream_and_those_still_open(spark, slices):
    # five frames a second: seen again after 1.2 s a track goes on, after 1.4 s it is a new one
    times = {"on": [0.0, 1.2, 2.0], "cut": [0.0, 1.4], "late": [30.0, 30.4], "gone": [3.0, 9.0]}
    rows = [(k, at(0) + timedelta(seconds=t), t, i) for k, ts in times.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "k string, moment timestamp, t double, obs long")
    df = df.withColumn("t", F.unix_micros("moment") / 1e6)  # seconds since 1970
    log = new_folder(spark)
    with watchdog.timers(spark):
        closed = replay.in_slices(df, "moment", slices, lambda s: sessions.frame_sessions(s, "k", "moment", "t", "obs", 1.0, 0.2, 1000.0, "0 seconds"), mode="append", log=log).collect()
        still = sessions.still_open(spark, log).collect()
    assert {tuple(r) for r in closed} == {("on", 0, 3, 0, 2), ("cut", 0, 1, 0, 0), ("cut", 1, 1, 1, 1), ("gone", 0, 1, 0, 0), ("gone", 1, 1, 1, 1)}
    assert {tuple(r) for r in still} == {("late", 0, 2, 0, 1)}
