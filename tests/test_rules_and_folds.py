"""What no SQL of the catalog covers: errors, alignment in two passes, suppression, folds against plain loops."""

import random
import statistics
from bisect import bisect_left

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wakeline import catalog
from wakeline.operators import boxes, matching, paths, review, rules, tracks
from wakeline.plans import fixtures as fx
from wakeline.sources import readers
from wakeline.session import shared_folder
from wakeline.streaming import replay

SF = "/root/testdata/sf0.001"


def plain_pairs(rear, front, bias, tolerance):
    """(rear id, front id, difference) by a loop over rear rows in order, each with the free front rows around its target."""
    front, taken, out = sorted(front), set(), []
    times = [t for t, _ in front]
    for t, k in sorted(rear):
        p = bisect_left(times, t - bias)
        free = [(abs(times[j] - (t - bias)), j) for j in range(p - 2, p + 3) if 0 <= j < len(times) and j not in taken]
        if free and min(free)[0] <= tolerance:
            j = min(free)[1]
            taken.add(j)
            out.append((k, front[j][1], t - times[j]))
    return out


def lanes_of(spark):
    rear, front = fx.lanes(spark, SF)
    out = {}
    for side, df in enumerate((rear, front)):
        for key, k, t in df.collect():
            out.setdefault(key, ([], []))[side].append((t, k))
    return out


def test_clock_alignment_matches_again_at_the_median(spark):
    got = {r.key: r for r in catalog.QUERIES["clock_alignment"](spark, SF).collect()}
    for key, (rear, front) in lanes_of(spark).items():
        if not rear:
            continue
        first = plain_pairs(rear, front, 0.0, 6.0)
        bias = statistics.median(o for *_, o in first) if first else 0.0
        second = plain_pairs(rear, front, bias, 6.0)
        r = got[key]
        assert r.bias == pytest.approx(bias, abs=1e-5) and r.accepted == len(second)
        off = [o for *_, o in second] or [0.0]
        assert (r.max_residual, r.min_offset, r.max_offset) == pytest.approx((max(abs(o - bias) for o in off) if second else 0.0, min(off), max(off)), abs=1e-5)


def test_bias_best_equals_a_search_over_all_candidates(spark):
    got = {r.key: r for r in catalog.QUERIES["bias_best"](spark, SF).collect()}
    found = {}
    for r in matching.candidates(*fx.lanes(spark, SF), 120.0).collect():
        found.setdefault(r.key, []).append(r.bias)
    for key, (rear, front) in lanes_of(spark).items():
        if not rear or not front:
            continue
        scored = []
        for bias in found[key]:
            pairs = plain_pairs(rear, front, bias, 1.5)
            scored.append((-len(pairs), round(sum(abs(o - bias) for *_, o in pairs), 6), abs(bias), bias, statistics.median([o for *_, o in pairs]) if pairs else 0.0))
        best = min(scored)
        assert (got[key].bias, got[key].matches) == (best[3], -best[0]) and got[key].refined == pytest.approx(best[4], abs=1e-5)


def test_biases_of_a_key_go_to_several_tasks(spark, monkeypatch):
    given, real = [], matching._matched
    monkeypatch.setattr(matching, "_matched", lambda rows, *a: (given.append(rows), real(rows, *a))[1])
    lane = lambda name, step: matching.settle(spark.range(12).select(F.lit("hot").alias("key"), F.col("id").alias(name), (F.col("id") * step).alias("t")))
    assert [r.key for r in matching.best_bias(lane("rear_id", 1.3), lane("front_id", 1.7), 0.5, 6.0).collect()] == ["hot"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = given[1].select("bias", F.spark_partition_id().alias("p")).distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.p for r in tasks}) > 1 and len(tasks) == len({r.bias for r in tasks})  # a bias whole in one


def test_suppression_equals_a_plain_loop(spark):
    rnd = random.Random(4)
    rows = []
    for k in range(300):
        x, y = rnd.random(), rnd.random()
        rows.append((k % 3, k % 7, 2, k, rnd.choice([0.5, 0.7, 0.9]), x, y, x + 0.3, y + 0.3))
    df = spark.createDataFrame(rows, "source long, frame long, class_id int, box_id long, score double, left double, top double, right double, bottom double")
    want = set()
    for key in {r[:3] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[:3] == key), key=lambda r: (-r[4], r[3])):
            def over(q, r=r):
                i = max(0, min(q[7], r[7]) - max(q[5], r[5])) * max(0, min(q[8], r[8]) - max(q[6], r[6]))
                return i / max(0.18 - i, 1e-9)
            if all(over(q) <= 0.45 for q in kept):
                kept.append(r)
        want |= {r[3] for r in kept}
    assert {r.box_id for r in boxes.nms(df).collect()} == want and len(want) < 300


def test_unknown_cameras_are_errors(spark):
    obs = fx.observations(spark, SF).withColumn("camera", F.when(F.col("source") == 1, None).otherwise(F.col("camera")))
    with pytest.raises(PySparkException, match="unknown camera"):
        tracks.summarize(obs).select("candidate").collect()


def test_camera_guard_is_not_pruned(spark):
    path = f"{shared_folder(spark)}/guard-{id(spark)}"
    spark.createDataFrame([("rear", "a")], "camera string, source string").coalesce(1).write.json(path)
    with pytest.raises(PySparkException, match="not a document of this camera"):
        readers.run_documents(spark, path, "camera string, source string", camera="front").select("source").collect()
    assert readers.run_documents(spark, path, "camera string, source string", camera="rear").count() == 1


def test_repeated_runs_are_errors(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "key long, v string")
    with pytest.raises(PySparkException, match="more than one run for 1"):
        rules.unique(df, "key", "run").select("key", "v").collect()
    assert rules.unique(df.where("v <> 'b'"), "key", "run").count() == 2


def test_arguments_are_checked(spark):
    df = spark.createDataFrame([(1, 1, 0.0, True)], "key long, ord long, at double, works boolean")
    with pytest.raises(ValueError):
        review.anchor_search(df, "key", 0)
    with pytest.raises(ValueError):
        review.first_of(df, "key", [F.col("ord")], -1)
    with pytest.raises(ValueError):
        boxes.letterbox(0, 10)
    assert boxes.letterbox(1280, 720) == (0.5, 0, 140)


def test_another_anchor_is_tried_after_a_failure(spark):
    rows = [(1, 1, 5.0, False), (1, 2, 5.0001, True), (1, 3, 7.0, True), (2, 1, 1.0, False), (2, 2, 2.0, False), (2, 3, 3.0, True)]
    df = spark.createDataFrame(rows, "key long, ord long, at double, works boolean")
    # 5.0001 is the time of the first attempt, to a thousandth, and is not tried again
    assert {r.key: (r.anchor, r.failures) for r in review.anchor_search(df, "key", 2).collect()} == {1: (7.0, 1), 2: (None, 2)}


def test_paths_stay_inside_the_root(spark):
    inside = {"/srv/out/a/../b": True, "/srv/out": True, "/srv/out/../x": False, "/srv/outer/x": False, "/srv/out/a/../../out/c": True, "/../srv/out/x": True}
    df = spark.createDataFrame([(p,) for p in inside], "p string").select("p", paths.within(F.col("p"), "/srv/out").alias("ok"))
    assert {r.p: r.ok for r in df.collect()} == inside
    roots = {"/srv/out/": True, "/": True, "/srv/ou": False}
    for root, ok in roots.items():
        assert spark.createDataFrame([("/srv/out/x", "srv/out/x")], "p string, q string").select(paths.within(F.col("p"), root), paths.within(F.col("q"), root)).first()[:] == (ok, False)
    host = spark.createDataFrame([("/a.b/x",), ("/aXb/x",), ("/a.b",), ("/a.bc",)], "p string").select(paths.host_path(F.col("p"), "/r", "/a.b", strict=True).alias("h"))
    assert [r.h for r in host.collect()] == ["/r/x", None, "/r", None]


def test_names_are_padded_and_never_cut(spark):
    rows = spark.createDataFrame([("s", 12.3456, 7, "car"), ("s", 1234567.5, 123456, "bus")], "s string, p double, t long, c string")
    got = [r[0] for r in rows.select(paths.clip_name(F.col("s"), F.col("p"), F.col("t"), F.col("c"))).collect()]
    assert got == ["s_t000012.346_track00007_car.mp4", "s_t1234567.500_track123456_bus.mp4"]


def test_paired_windows_are_offset_later(spark):
    a, b = paths.paired_window(F.lit(5.0), F.lit(12.0), F.lit(-7.0), F.lit(4.0))
    assert spark.range(1).select(a, b).first()[:] == (0.0, 4.0)
    a, b = paths.paired_window(F.lit(5.0), F.lit(12.0), F.lit(7.0), F.lit(100.0))
    assert spark.range(1).select(a, b).first()[:] == (12.0, 19.0)


def test_marks_keep_what_was_a_candidate(spark):
    row = lambda k, peak, n, candidate=True: (k, "front", "left", peak, peak - 0.5, peak + 0.3, n, 0.8, 0.1, candidate)
    df = spark.createDataFrame([row(20, 10.0, 5), row(21, 10.6, 9), row(22, 10.61, 99, False), row(23, 11.6004, 9)], "track_id long, camera string, side string, peak_time double, first_seen double, last_seen double, detections int, duration double, peak_area double, candidate boolean")
    for again in (tracks.marked(df, ("camera",)),):
        assert {r.track_id: (r.candidate_raw, r.candidate, r.duplicate_of) for r in again.collect()} == {20: (True, False, 21), 21: (True, True, None), 22: (False, False, None), 23: (True, False, 21)}
    twice = tracks.marked(tracks.marked(df, ("camera",)), ("camera",))
    assert {r.track_id: (r.candidate_raw, r.duplicate_of) for r in twice.collect()} == {20: (False, None), 21: (True, None), 22: (False, None), 23: (False, None)}


def test_slope_of_one_moment_is_zero(spark):
    row = lambda k, x: (1, "front", k, 5.0, 2, 0.9, x, 0.1, x + 0.1 + k / 50, 0.3)
    df = spark.createDataFrame([row(0, 0.2), row(1, 0.2)], "source long, camera string, obs_id long, ts double, class_id int, confidence double, left double, top double, right double, bottom double")
    assert tracks.summarize(tracks.sessionize(tracks.with_box(df), 1.0)).first().slope == 0.0


def test_sessions_end_at_frames(spark):
    # five frames a second: seen again after 1.2 s the track goes on, after 1.4 s it is a new one
    rows = [(k, i, t) for k, times in ((1, (0.0, 1.2)), (2, (0.0, 1.4)), (3, (0.0, 1.0))) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "source long, obs_id long, ts double")
    last = lambda frame: {r[0]: r[1] for r in tracks.sessionize(df, 1.0, frame=frame).groupBy("source").agg(F.max("session")).collect()}
    assert last(0.2) == {1: 0, 2: 1, 3: 0} and last(0.0) == {1: 1, 2: 1, 3: 0}


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    source, place = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(5).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    assert replay.replay(spark, stream, place).count() == 5
    spark.range(3, 9).write.mode("append").parquet(source)
    assert sorted(r.id for r in replay.replay(spark, stream, place).collect()) == sorted([*range(5), *range(3, 9)])
    assert replay.replay(spark, stream, place).count() == 11
    assert sorted(r.id for r in replay.pending(spark.range(12), replay.replay(spark, stream, place), ["id"]).collect()) == [9, 10, 11]
    query = stream.writeStream.format("noop").trigger(availableNow=True).start()
    query.awaitTermination()
    assert replay.progress(query)[-1][1] == 11


def test_timeouts_and_ready_days_state_their_rows(spark):
    t = lambda h: f"2024-01-0{1 + h // 24} {h % 24:02}:00:00"
    beats = spark.createDataFrame([("a", t(0)), ("a", t(1)), ("a", t(9)), ("b", t(0))], "worker string, ts string").withColumn("ts", F.to_timestamp("ts"))
    stream = replay.staged(replay.with_last_row(beats, "ts", "2 days"))
    out = replay.replay(spark, replay.timeouts(stream, "worker", "ts", "3 hours", "1 hour"))
    assert sorted((r.worker, r.beats, r.last_seen.hour, r.stale_at.hour) for r in out.collect()) == [("a", 1, 9, 12), ("a", 2, 1, 4), ("b", 1, 0, 3)]


def both_lanes(spark, rear, front):
    """(id, media, clock) of each event, of one key."""
    side = lambda rows, name: spark.createDataFrame([("k", i, float(c), float(m)) for i, m, c in rows], f"key string, {name}_id long, t double, media double")
    return side(rear, "rear"), side(front, "front")


def test_alignment_over_media_with_missing_sections(spark):
    # an event of equal clock is no match: two others agree on another bias, though their media are apart by different times
    rear, front = both_lanes(spark, [(21, 111, 1000), (22, 500, 2000)], [(10, 50, 1000), (11, 101, 1014), (12, 300, 2014)])
    pairs, heads = matching.alignment(rear, front, 1.5, 120.0)
    assert sorted((r.rear_id, r.front_id, r.physical) for r in pairs.collect()) == [(21, 11, 10.0), (22, 12, 200.0)]
    assert heads.collect() == [("k", -14.0, 2, 0.0, 10.0, 200.0, 21, 11)]


def test_alignment_without_matches(spark):
    rear, front = both_lanes(spark, [(1, 5, 10)], [(2, 5, 9000)])
    pairs, heads = matching.alignment(rear, front, 1.5, 120.0)
    assert pairs.collect() == [] and heads.collect() == [("k", 0.0, 0, 0.0, 0.0, 0.0, None, None)]


def test_an_unstable_match_is_not_accepted_at_the_median(spark):
    rear, front = both_lanes(spark, [(21, 0, 104), (22, 0, 204), (23, 0, 304)], [(11, 0, 94), (12, 0, 194.2), (13, 0, 250)])
    _, heads = matching.alignment(rear, front, 1.5, 100.0)
    r = heads.first()
    assert (r.accepted, r.anchor_rear) == (2, 22) and r.bias == pytest.approx(9.9) and r.max_residual == pytest.approx(0.1)


def test_biases_that_cannot_win_are_not_missed(spark):
    rnd = random.Random(12)
    sides = []
    for name in ("rear", "front"):
        rows = [(k, i, round(rnd.random() * 60, 2)) for k in range(12) for i in range(rnd.randrange(0, 14))]
        sides.append((rows, spark.createDataFrame(rows, f"key long, {name}_id long, t double")))
    got = {r.key: (r.bias, r.matches) for r in matching.best_bias(sides[0][1], sides[1][1], 1.5, 20.0).collect()}
    want = {}
    for key, bias in map(tuple, matching.candidates(sides[0][1], sides[1][1], 20.0).collect()):
        rear, front = ([(t, i) for k, i, t in s[0] if k == key] for s in sides)
        if front:
            pairs = plain_pairs(rear, front, bias, 1.5)
            rank = (-len(pairs), round(sum(abs(o - bias) for *_, o in pairs), 6), abs(bias), bias)
            want[key] = min(want.get(key, rank), rank)
    assert got == {k: (w[3], -w[0]) for k, w in want.items()} and len(got) > 5
