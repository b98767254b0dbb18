"""Raw frames and sound in segment files, and columns of long keys by ranges, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from wakeline.operators import ranges, signals
from wakeline.sources import recordings


@pytest.fixture(scope="module")
def clips(spark, tmp_path_factory):
    """Two recordings of 50 frames of 2 x 2 x 3 bytes in segments of 20 frames; frame 30 of b is missing."""
    path = f"file://{tmp_path_factory.mktemp('clips')}"
    rows = [(s, k, bytes([k] * 12)) for s in "ab" for k in range(50) if (s, k) != ("b", 30)]
    recordings.write_segments(spark.createDataFrame(rows, "source string, frame long, data binary").repartition(5), path, 12, 20)
    return path


def reader(path, **more):
    return recordings.FrameReader({"path": path, "width": "2", "height": "2", "rate": "10", "frames_per_task": "8", **more})


def test_frames_come_back_with_their_times(spark, clips):
    got = recordings.frames(spark, clips, 2, 2, 10.0, start=3.0).orderBy("source", "frame").collect()
    assert [(r.source, r.frame) for r in got] == [(s, k) for s in "ab" for k in range(50) if (s, k) != ("b", 30)]
    assert all(r.ts == 3.0 + r.frame / 10 and bytes(r.data) == bytes([r.frame] * 12) for r in got)


def test_only_ranges_within_the_filters_are_read(spark, clips):
    r = reader(clips)
    assert list(r.pushFilters([EqualTo(("source",), "a"), GreaterThanOrEqual(("ts",), 2.0), LessThan(("ts",), 2.5)]))  # Spark keeps the filters
    parts = r.partitions()
    assert {p.source for p in parts} == {"a"} and min(p.first for p in parts) == 19 and max(p.first + p.units for p in parts) == 27
    assert sum(p.units for p in reader(clips).partitions()) == 99 and max(p.units for p in reader(clips).partitions()) == 8
    none = reader(clips)
    list(none.pushFilters([In(("source",), ("a", "b")), EqualTo(("source",), "x")]))
    assert none.partitions() == []
    df = recordings.frames(spark, clips, 2, 2, 10.0, frames_per_task=8).where("source = 'a' and ts >= 2D and ts < 2.5D")
    assert sorted(x.frame for x in df.collect()) == [20, 21, 22, 23, 24] and df.rdd.getNumPartitions() == len(parts)


def test_short_frames_are_errors(spark, clips, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "000000000000.raw").write_bytes(b"x" * 25)
    with pytest.raises(ValueError, match="short unit"):
        reader(str(tmp_path)).partitions()
    with pytest.raises(Exception, match="short unit"):
        recordings.write_segments(spark.createDataFrame([("d", 0, b"x" * 7)], "source string, frame long, data binary"), str(tmp_path / "out"), 12)
    assert not list((tmp_path / "out").rglob("*.raw"))
    part = reader(clips).partitions()[0]
    part.units = 1000
    with pytest.raises(ValueError, match="short read"):
        list(reader(clips).read(part))


def test_frames_at_times_and_their_lower_left_part(spark, clips):
    all_frames = recordings.frames(spark, clips, 2, 2, 10.0)
    wanted = spark.createDataFrame([("a", 1.0), ("a", 1.01), ("b", 2.95), ("b", 9.0), ("x", 1.0)], "source string, t double")
    assert sorted((r.source, r.t, r.frame) for r in recordings.frames_at(all_frames, wanted, 10.0).collect()) == [("a", 1.0, 10), ("a", 1.01, 11)]
    data = bytes(k % 256 for k in range(300))
    row = spark.createDataFrame([(data,)], "d binary").select(recordings.lower_left(F.col("d"), 10, 10).alias("d")).first()
    assert bytes(row.d) == np.frombuffer(data, np.uint8).reshape(10, 10, 3)[9:, :7].tobytes()


def test_named_frame_files(spark, tmp_path):
    (tmp_path / "f1.rgb").write_bytes(b"y" * 12)
    got = recordings.frame_files(spark, [f"12.5:file://{tmp_path}/f1.rgb"], 2, 2).collect()
    assert [(r.ts, bytes(r.data)) for r in got] == [(12.5, b"y" * 12)]
    with pytest.raises(Exception, match="12 bytes, expected 27"):
        recordings.frame_files(spark, [f"1:{tmp_path}/f1.rgb"], 3, 3).collect()
    with pytest.raises(ValueError, match="TIME:FILE"):
        recordings.frame_files(spark, ["12.5"], 2, 2)


@pytest.mark.parametrize("samples_per_task", [7, 50, 999, 100_000])
def test_blocks_of_sound_do_not_depend_on_the_ranges(spark, tmp_path, samples_per_task):
    x = np.random.default_rng(2).integers(-32768, 32768, 2030).astype("<i2")
    recordings.write_segments(spark.createDataFrame([("m", k, x[k : k + 290].tobytes()) for k in range(0, 2030, 290)], "source string, frame long, data binary"), str(tmp_path), 2, 580)
    got = {r.idx: r.x for r in recordings.sound_blocks(spark, str(tmp_path), 50, samples_per_task=samples_per_task).collect()}
    want = np.log1p(np.sqrt(np.mean(x[:2000].reshape(-1, 50).astype(float) ** 2, axis=1) + 1))
    assert len(got) == 40 and np.allclose([got[k] for k in range(40)], want)
    with pytest.raises(Exception, match="insufficient sound in m"):
        recordings.sound_blocks(spark, str(tmp_path), 50, least_samples=2001).collect()


def test_flat_sound_is_an_error_if_strict(spark):
    flat = spark.createDataFrame([("k", i, 1.0) for i in range(3)], "key string, idx long, x double")
    assert all(r.envelope is None for r in signals.normalised(flat, 1).collect())
    with pytest.raises(Exception, match="no useful variation in k"):
        signals.normalised(flat, 1, strict=True).collect()


@pytest.mark.parametrize("block", [5, 7, 1000])
def test_windows_by_index_blocks_equal_convolution(spark, block):
    rng = np.random.default_rng(block)
    x = rng.normal(size=203)
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x)], "key string, idx long, x double")
    for width in (1, 4, 5):
        got = {r.idx: r.detrended for r in signals.detrend(df, width, block=block).collect()}
        want = [x[i] - sum(x[max(0, i - width // 2) : i + width - width // 2]) / width for i in range(203)]
        assert np.allclose([got[i] for i in range(203)], want)
    diff = {r.idx: r.diff for r in signals.first_difference(df, block=block).collect()}
    assert sorted(diff) == list(range(1, 203)) and np.allclose([diff[i] for i in range(1, 203)], np.diff(x))


def test_places_over_ranges(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), t, i) for i, t in enumerate(rng.sample(range(5000), 900))]
    df = spark.createDataFrame(rows, "key string, t long, id long").repartition(3)
    place = {}
    for key, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        place[i] = sum(1 for k, u, _ in rows if k == key and u < t)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranges.numbered(df, ["key"], ["t"])
        assert {r.id: r.idx for r in got.collect()} == place
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for skip in (0, 1, 5, 400):
        assert {r.id for r in ranges.after_first(df, ["key"], ["t"], skip).collect()} == {i for i, p in place.items() if p >= skip and (skip == 0 or sum(1 for r in rows if r[0] == rows[i][0]) >= skip)}


def test_groups_at_gaps_over_ranges_equal_windows(spark):
    from wakeline.operators import matching, tracks

    rng = random.Random(8)
    rows = [(rng.choice([1, 1, 1, 2, None]), round(rng.random() * 400, 1), i) for i in range(700)]
    df = spark.createDataFrame(rows, "source int, ts double, obs_id long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for frame in (0.0, 0.2):
            one, other = ({(r.obs_id, r.session) for r in tracks.sessionize(df, 1.0, frame=frame, spread=s).collect()} for s in (False, True))
            assert one == other and len({s for _, s in one}) > 20
        t = df.selectExpr("obs_id track_id", "source", "'left' side", "ts peak_time", "ts - 0.2 first_seen", "ts + 0.3 last_seen", "cast(obs_id % 5 as int) detections", "1.0D duration", "0.1D peak_area")
        one, other = ({(r.track_id, r.survivor, r.duplicate_of) for r in tracks.deduplicate(t, ("source",), spread=s).collect()} for s in (False, True))
        assert one == other and 100 < sum(x[1] for x in one) < 700
        sides = [df.where(f"obs_id % 2 = {k}").selectExpr("coalesce(source, 9) key", f"obs_id {name}_id", "ts t") for k, name in enumerate(("rear", "front"))]
        one, other = ({tuple(r) for r in matching.greedy_pairs(*sides, 0.4, spread=s).collect()} for s in (False, True))
        assert one == other and len(one) > 50
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
