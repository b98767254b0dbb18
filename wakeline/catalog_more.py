"""Queries of the review tier, rule sets, batch report, paths, signals and box chain, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.catalog import CHECKS, query
from wakeline.operators import boxes, clocks, matching, paths, review, rollup, rules, signals, summary, tracks
from wakeline.plans import fixtures as fx
from wakeline.session import table

_K = "(props->>'$.k')::INT"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


@query(f"""WITH e AS (SELECT event_id, {_K} AS k, 1280 + {_K} * 10 AS w, 720 + floor(value)::INT AS h, value FROM events),
d AS (SELECT *, round_even(h * 960.0::DOUBLE / w, 0)::BIGINT AS r FROM e), s AS (SELECT *, r + r % 2 AS dh FROM d)
SELECT event_id, dh AS height, round(k * 9.6::DOUBLE / 960, 6) AS x, round(value * 4 / dh, 6) AS y FROM s""")
def unit_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumns({"w": 1280 + F.col("k") * 10, "h": 720 + F.floor("value")})
    e = e.withColumn("height", paths.detection_height(F.col("w"), F.col("h"), 960))
    x, y = F.col("k") * 9.6, F.col("value") * 4
    left, top, _, _ = boxes.to_unit((x, y, x, y), F.lit(960), F.col("height"))
    return e.select("event_id", "height", F.round(left, 6).alias("x"), F.round(top, 6).alias("y"))


_TRACK_FILES = f"""WITH {fx.TRACKS_SQL}, p AS (SELECT source, session, source * 1000 + session AS track_id, class_id, (peak_time - 19723) * 100 AS peak FROM tracks),
q AS (SELECT *, round(peak * 1000)::BIGINT AS ms, greatest(0.0::DOUBLE, peak - 3) AS a, least(2500.0::DOUBLE, peak + 4) AS b FROM p)
SELECT source, session, round(a, 3) AS clip_start, round(b, 3) AS clip_end, round(greatest(0.0::DOUBLE, a + 12.5), 3) AS paired_start,
 round(least(2400.0::DOUBLE, b + 12.5), 3) AS paired_end, 'r:' || track_id || ':' || ms AS event_key,
 printf('%s_t%010.3f_track%05d_%s.mp4', source::VARCHAR, ms / 1000, track_id, CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' ELSE 'truck' END) AS name FROM q"""


@query(_TRACK_FILES)
def clip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks.summarize(fx.observations(spark, sf_dir)).withColumns({"track_id": F.col("source") * 1000 + F.col("session"), "peak_time": (F.col("peak_time") - 19723) * 100, "media_seconds": F.lit(2500.0)})
    t = tracks.clip_window(t)
    a, b = paths.paired_window(F.col("clip_start"), F.col("clip_end"), F.lit(12.5), F.lit(2400.0))
    r3 = lambda c: F.round(c, 3)
    return t.select("source", "session", r3("clip_start").alias("clip_start"), r3("clip_end").alias("clip_end"), r3(a).alias("paired_start"), r3(b).alias("paired_end"), paths.event_key(F.col("track_id"), F.col("peak_time"), "r").alias("event_key"), paths.clip_name(F.col("source"), F.col("peak_time"), F.col("track_id"), F.col("class_name")).alias("name"))


@query(f"""WITH p AS (SELECT event_id, CASE {_K} % 4 WHEN 0 THEN '/output/' || event_type || '/../' || event_id || '.mp4' WHEN 1 THEN '/output/a/../../../etc/' || event_id WHEN 2 THEN '/data/./' || event_type ELSE '/output' END AS path FROM events),
h AS (SELECT *, CASE WHEN regexp_full_match(path, '/output(/.*)?') THEN '/srv/out' || path[8:] ELSE path END AS host FROM p),
n AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '/\\./', '/'), '/[^/.]+/\\.\\./', '/'), '/[^/.]+/\\.\\./', '/'), '/[^/.]+/\\.\\./', '/') AS norm FROM h)
SELECT event_id, host, CASE WHEN regexp_full_match(path, '/output(/.*)?') THEN host END AS strict, norm AS normalized, norm = '/srv/out' OR starts_with(norm, '/srv/out/') AS inside FROM n""".replace("\\\\", "\\"))
def host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, m = _events(spark, sf_dir), F.col("k") % 4
    kinds = [F.concat(F.lit("/output/"), "event_type", F.lit("/../"), F.col("event_id").cast("string"), F.lit(".mp4")), F.concat(F.lit("/output/a/../../../etc/"), F.col("event_id").cast("string")), F.concat(F.lit("/data/./"), "event_type")]
    e = e.withColumn("path", F.when(m == 0, kinds[0]).when(m == 1, kinds[1]).when(m == 2, kinds[2]).otherwise("/output"))
    host = paths.host_path(F.col("path"), "/srv/out")
    return e.select("event_id", host.alias("host"), paths.host_path(F.col("path"), "/srv/out", strict=True).alias("strict"), paths.normalized(host).alias("normalized"), paths.within(host, "/srv/out").alias("inside"))


@query(f"SELECT event_id, epoch_us(ts) + {_K} * 100000 AS clock_us, round(epoch_us(ts) / 1e6 - 1704067200 - value, 3) AS physical_offset FROM events")
def clock_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    shifted = clocks.shifted(F.col("ts"), F.col("k") / 10, F.lit(0.0))
    us = lambda c: F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), c)
    return e.select("event_id", us(shifted).alias("clock_us"), F.round(us(F.col("ts")) / 1e6 - 1704067200 - F.col("value"), 3).alias("physical_offset"))


@query("""SELECT conv_id, turn, '{"conv_id":' || conv_id || ',"plan":{"turn":' || turn || ',"synchronization":{"method":"clock","turns":' || (turn + 1) || '}},"role":"' || role || '"}' AS plan_row FROM conversations""")
def nested_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    sync = F.struct(F.lit("clock").alias("method"), (F.col("turn") + 1).alias("turns"), F.length("text").alias("matches"))
    plan = F.struct("turn", sync.alias("synchronization")).dropFields("synchronization.matches")
    return c.select("conv_id", "turn", F.to_json(F.struct("conv_id", plan.alias("plan"), "role")).alias("plan_row"))


_REPORT = """d AS (SELECT doc_id, lang AS lane, n_chars::DOUBLE AS expected_seconds FROM documents),
u AS (SELECT doc_id, (doc_id % 900 + 1)::DOUBLE AS run_seconds, (doc_id % 97)::DOUBLE AS wall_seconds, toxic + doc_id % 3 AS candidate_events FROM labels WHERE doc_id % 11 <> 0),
b AS (SELECT doc_id, doc_id % 5 AS samples, CASE WHEN doc_id % 4 = 0 THEN doc_id % 8 = 0 END AS flag, CASE WHEN doc_id % 3 <> 0 THEN 40 + doc_id % 50 END::DOUBLE AS socket_mean, CASE WHEN doc_id % 13 <> 0 THEN (doc_id % 70) / 8 END AS energy_wh FROM labels WHERE doc_id % 7 <> 0),
v AS (SELECT doc_id, quality = 1 AS valid FROM labels),
j AS (SELECT d.*, u.* EXCLUDE doc_id, b.* EXCLUDE doc_id, valid, CASE WHEN run_seconds IS NOT NULL AND samples IS NOT NULL AND coalesce(valid, false) THEN 'completed' WHEN run_seconds IS NOT NULL AND samples IS NOT NULL THEN 'awaiting_validation' WHEN run_seconds IS NOT NULL THEN 'awaiting_benchmark' ELSE 'pending' END AS status
 FROM d LEFT JOIN u ON d.doc_id = u.doc_id LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN v ON d.doc_id = v.doc_id),
f AS (SELECT *, status = 'completed' AND coalesce(flag, samples > 0) AND socket_mean IS NOT NULL AND energy_wh IS NOT NULL AS telemetry_available FROM j)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("lane"), F.col("n_chars").cast("double").alias("expected_seconds"))
    k, lab = F.col("doc_id"), table(spark, sf_dir, "labels")
    runs = lab.where(k % 11 != 0).select("doc_id", (k % 900 + 1).cast("double").alias("run_seconds"), (k % 97).cast("double").alias("wall_seconds"), (F.col("toxic") + k % 3).alias("candidate_events"))
    bench = lab.where(k % 7 != 0).select("doc_id", (k % 5).alias("samples"), F.when(k % 4 == 0, k % 8 == 0).alias("flag"), F.when(k % 3 != 0, 40 + k % 50).cast("double").alias("socket_mean"), F.when(k % 13 != 0, (k % 70) / 8).alias("energy_wh"))
    return summary.file_report(d, runs, bench, lab.select("doc_id", (F.col("quality") == 1).alias("valid")), "doc_id")


@query(f"""WITH {_REPORT}, c AS (SELECT *, status = 'completed' AS done FROM f) SELECT doc_id, status, telemetry_available, CASE WHEN done THEN round(run_seconds / 3600, 4) END AS source_hours, CASE WHEN done THEN round(wall_seconds / 60, 3) END AS wall_minutes,
CASE WHEN done THEN round(run_seconds / nullif(wall_seconds, 0), 3) END AS real_time_factor, CASE WHEN done THEN round(60 / (run_seconds / nullif(wall_seconds, 0)), 3) END AS minutes_per_source_hour FROM c""")
def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("doc_id", "status", "telemetry_available", "source_hours", "wall_minutes", "real_time_factor", "minutes_per_source_hour")


@query(f"""WITH {_REPORT}, g AS (SELECT CASE WHEN grouping(lane) = 1 THEN 'overall' ELSE lane END AS lane, count(*) AS expected_files, count(*) FILTER (status = 'completed') AS completed_files, coalesce(sum(expected_seconds), 0) AS e, coalesce(sum(run_seconds) FILTER (status = 'completed'), 0) AS s,
coalesce(sum(wall_seconds) FILTER (status = 'completed'), 0) AS w, coalesce(sum(candidate_events) FILTER (status = 'completed'), 0)::BIGINT AS candidate_events, count(*) FILTER (telemetry_available) AS telemetry_files, coalesce(sum(run_seconds) FILTER (telemetry_available), 0) AS p, coalesce(sum(energy_wh) FILTER (telemetry_available), 0) AS q FROM f GROUP BY GROUPING SETS ((), (lane))),
r AS (SELECT *, CASE WHEN w <> 0 AND s <> 0 THEN s / w END AS k FROM g)
SELECT lane, expected_files, completed_files, round(e / 3600, 3) AS expected_hours, round(s / 3600, 3) AS processed_hours, round(w / 3600, 3) AS wall_hours, round(k, 3) AS real_time_factor, round(60 / k, 3) AS minutes_per_source_hour, round(greatest(0, e - s) / k / 3600, 3) AS hours_left,
candidate_events, telemetry_files, round(p / 3600, 3) AS telemetry_hours, round(q, 3) AS energy_wh, round(q / nullif(p / 3600, 0), 3) AS wh_per_source_hour FROM r""")
def lane_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.lane_report(_report(spark, sf_dir), "lane")


@query("""WITH g AS (SELECT l_returnflag AS lane, avg(l_quantity) AS m, count(*) / 3700.0::DOUBLE AS hours, count(*) FILTER (l_linenumber = 1) / 3600.0::DOUBLE AS src, count(DISTINCT l_suppkey)::DOUBLE AS fps FROM lineitem GROUP BY l_returnflag)
SELECT lane, round(m, 3) AS mean_watts, round(round(m, 3) * hours, 4) AS energy_wh, round(round(round(m, 3) * hours, 4) / nullif(src, 0), 4) AS wh_per_source_hour, round(round(m, 3) / nullif(fps, 0), 6) AS joules_per_inference FROM g""")
def energy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("lane")).agg(F.avg("l_quantity").alias("m"), F.count("*").alias("n"), F.count_if(F.col("l_linenumber") == 1).alias("one"), F.count_distinct("l_suppkey").alias("fps"))
    return summary.energy(g, "m", F.col("n") / 3700.0, F.col("one") / 3600.0, F.col("fps").cast("double")).select("lane", "mean_watts", "energy_wh", "wh_per_source_hour", "joules_per_inference")


@query("""SELECT l_orderkey, count(m) AS cells, round(avg(m), 6) AS mean, max(m) AS most FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE (l_quantity + l_linenumber) / 2 END AS m FROM lineitem) GROUP BY l_orderkey""")
def array_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda c: F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'"))
    cell = F.when(F.col("l_linenumber") % 4 == 0, "['N/A']").otherwise(F.concat(F.lit("["), item("l_quantity"), F.lit(", 'N/A', "), item("l_linenumber"), F.lit("]")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", summary.list_cell(cell).alias("m"))
    return rows.groupBy("l_orderkey").agg(F.count("m").alias("cells"), F.round(F.avg("m"), 6).alias("mean"), F.max("m").alias("most"))


_REVIEW = f"""WITH {fx.TRACKS_SQL}, b AS (SELECT source, session, ok_detections AND ok_peak_area AND ok_side_offset AS passes, class_id, max_confidence, detections, duration, peak_area FROM tracks),
s AS (SELECT *, passes AND class_id IN (2, 3, 5, 7) AND max_confidence >= 0.80 AND detections >= 5 AND duration >= 1.0 AND peak_area >= 0.01 AS strong FROM b),
l AS (SELECT source, session, count(*) FILTER (v) AS frames, coalesce(max(confidence) FILTER (v), 0) AS best FROM (SELECT *, area >= 0.003 AND confidence >= 0.25 AS v FROM obs) GROUP BY source, session),
w AS (SELECT s.source, s.session, strong, passes, passes AND NOT strong AS required, CASE WHEN passes AND NOT strong THEN frames ELSE 0 END AS frames, CASE WHEN passes AND NOT strong THEN best ELSE 0 END AS best FROM s JOIN l ON s.source = l.source AND s.session = l.session)
SELECT source, session, strong, required, frames, best, passes AND (strong OR frames >= 2 OR best >= 0.60) AS confirmed FROM w"""


@query(_REVIEW)
def review_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = fx.observations(spark, sf_dir)
    samples = obs.groupBy("source", "session").agg(F.collect_list(F.struct("ts", F.array(F.struct("class_id", "confidence", "area")).alias("detections"))).alias("samples"))
    return review.reviewed(tracks.summarize(obs), samples, ["source", "session"], ["ok_detections", "ok_peak_area", "ok_side_offset"])


@query(f"SELECT count(*) AS reviewed, count(*) FILTER (confirmed) AS confirmed, count(*) FILTER (NOT confirmed) AS rejected, count(*) FILTER (strong) AS strong, count(*) FILTER (confirmed AND NOT strong) AS secondary FROM ({_REVIEW})")
def review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.counters(review_tiers(spark, sf_dir))


@query(f"""WITH a AS (SELECT unnest(range(18)) AS ord), t AS (SELECT event_id, ord, ([{', '.join(f'{x}::DOUBLE' for x in clocks.ADJUSTMENTS)}])[ord // 2 + 1] AS adjust, ({_K} + ord * 7) % 23 = 0 AS works FROM events, a)
SELECT event_id, min(ord) FILTER (works) AS attempt, arg_min(adjust, ord) FILTER (works) AS value FROM t GROUP BY event_id""")
def first_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = [x for x in clocks.ADJUSTMENTS for _ in range(2)]
    e = _events(spark, sf_dir).select("event_id", "k")
    return review.first_success(e, ["event_id"], attempts, lambda k, _: (F.col("k") + k * 7) % 23 == 0)


@query(f"""WITH e AS (SELECT user_id AS key, event_id AS ord, ({_K} % 40)::DOUBLE / 8 AS t, event_id % 17 = 0 AS works FROM events), o AS (SELECT key, arg_min(ord, ord) AS ord, arg_min(t, ord) AS t, arg_min(works, ord) AS works FROM e GROUP BY key, round(t * 1000)),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS place FROM o), c AS (SELECT key, min(place) FILTER (works) AS hit, arg_min(t, place) FILTER (works) AS a, count(*) AS n FROM p WHERE place <= 12 GROUP BY key)
SELECT key, a AS anchor, coalesce(hit - 1, n) AS failures FROM c""")
def anchor_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select(F.col("user_id").alias("key"), F.col("event_id").alias("ord"), ((F.col("k") % 40).cast("double") / 8).alias("at"), (F.col("event_id") % 17 == 0).alias("works"))
    return review.anchor_search(e, "key", 12)


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 3")
def longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return review.first_of(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).drop("o_totalprice")


@query("""WITH e AS (SELECT user_id, event_type AS lane, event_id, ts FROM events), p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, lane, event_id) AS place FROM e)
SELECT user_id, event_id, place FROM p""")
def attempt_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("lane"), "event_id", "ts")
    return review.first_of(e, "user_id", [F.col("ts"), F.col("lane"), F.col("event_id")], 0).select("user_id", "event_id", "place")


_RUNS = """SELECT d.doc_id, source, source AS run_source, lang AS camera, CASE WHEN d.doc_id % 31 = 0 THEN 'other' ELSE lang END AS run_camera, CASE WHEN d.doc_id % 29 = 0 THEN 'old' ELSE 'new' END AS weights, '0' AS device, 'hw' AS decode, CASE WHEN d.doc_id % 23 = 0 THEN 4.0 ELSE 5.0 END::DOUBLE AS sample_fps,
 n_chars AS size, n_chars + (d.doc_id % 37 = 0)::INT AS run_size, n_chars::DOUBLE AS duration, n_chars + (d.doc_id % 19) / 250 AS run_duration, n_chars - (d.doc_id % 9) / 6 AS processed_seconds, (d.doc_id % 41)::DOUBLE AS wall_seconds, d.doc_id % 5 AS n_events, d.doc_id % 5 AS candidate_events, d.doc_id % 5 + (d.doc_id % 43 = 0)::INT AS event_rows,
 d.doc_id % 8 AS track_lines, d.doc_id % 8 AS completed_tracks, d.doc_id % 2 = 0 AS clips_enabled, (d.doc_id % 26 = 0)::INT AS clips_missing, (d.doc_id % 27 = 0)::INT AS clips_named, CASE WHEN quality IS NULL THEN 'running' ELSE 'complete' END AS heartbeat, source AS heartbeat_source, source AS benchmark_source,
 n_chars - (d.doc_id % 9) / 6 + (d.doc_id % 6) / 400 AS benchmark_seconds, d.doc_id % 3 AS samples, CASE WHEN d.doc_id % 10 = 0 THEN true END AS telemetry_available, 1000 + (d.doc_id % 47 = 0)::INT AS owner, 1000 AS expected_owner FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
_V1 = [("source", "run_source = source"), ("camera", "run_camera = camera"), ("weights", "weights = 'new'"), ("device", "device = '0'"), ("decode", "decode = 'hw'"), ("sample_rate", "sample_fps = 5"), ("size", "run_size = size"), ("duration", "abs(coalesce(run_duration, 0) - duration) <= 0.05::DOUBLE"), ("processed", "abs(processed_seconds - duration) <= 1"), ("wall", "wall_seconds > 0"), ("events", "n_events = candidate_events"),
       ("event_rows", "event_rows = candidate_events"), ("track_lines", "track_lines = completed_tracks"), ("clips", "CASE WHEN clips_enabled THEN clips_missing = 0 ELSE clips_named = 0 END"), ("heartbeat", "heartbeat = 'complete'"), ("heartbeat_source", "heartbeat_source = source"), ("benchmark_source", "benchmark_source = source"), ("benchmark_seconds", "abs(benchmark_seconds - processed_seconds) <= 0.01::DOUBLE"), ("owner", "owner = expected_owner")]


def _listed(named: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in named) + "], lambda x: x IS NOT NULL)"


@query(f"WITH r AS ({_RUNS}) SELECT doc_id, {_listed(_V1)} AS errors, len({_listed(_V1)}) = 0 AS valid, CASE WHEN NOT coalesce(telemetry_available, samples > 0, false) THEN 'no_telemetry' END AS warning FROM r")
def camera_result_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i = F.col("doc_id"), lambda c: c.cast("int")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("p", F.col("n_chars") - (k % 9) / 6)
    runs = d.select(
        "doc_id", "source", F.col("source").alias("run_source"), F.col("lang").alias("camera"), F.when(k % 31 == 0, "other").otherwise(F.col("lang")).alias("run_camera"), F.when(k % 29 == 0, "old").otherwise("new").alias("weights"), F.lit("0").alias("device"), F.lit("hw").alias("decode"),
        F.when(k % 23 == 0, 4.0).otherwise(5.0).alias("sample_fps"), F.col("n_chars").alias("size"), (F.col("n_chars") + i(k % 37 == 0)).alias("run_size"), F.col("n_chars").cast("double").alias("duration"), (F.col("n_chars") + (k % 19) / 250).alias("run_duration"), F.col("p").alias("processed_seconds"),
        (k % 41).cast("double").alias("wall_seconds"), (k % 5).alias("n_events"), (k % 5).alias("candidate_events"), (k % 5 + i(k % 43 == 0)).alias("event_rows"), (k % 8).alias("track_lines"), (k % 8).alias("completed_tracks"), (k % 2 == 0).alias("clips_enabled"), i(k % 26 == 0).alias("clips_missing"), i(k % 27 == 0).alias("clips_named"),
        F.when(F.col("quality").isNull(), "running").otherwise("complete").alias("heartbeat"), F.col("source").alias("heartbeat_source"), F.col("source").alias("benchmark_source"), (F.col("p") + (k % 6) / 400).alias("benchmark_seconds"), (k % 3).alias("samples"), F.when(k % 10 == 0, True).alias("telemetry_available"), (1000 + i(k % 47 == 0)).alias("owner"), F.lit(1000).alias("expected_owner"),
    )
    return rules.camera_result(runs, "new", "0", "hw", 5.0).select("doc_id", "errors", "valid", "warning")


_V2H = [("schema", "schema_version >= 3"), ("method", "method = 'clock_v2'"), ("layout", "layout = 'left_right'"), ("tolerance", "tolerance > 0 AND tolerance <= 2"), ("accepted", "accepted >= n_events"), ("clip_count", "combined_clips = n_events"), ("attempted", "attempted = n_events + n_skipped"), ("all_skipped", "attempted = 0 OR n_events > 0"), ("progress", "progress = 'complete'")]
_V2E = [("event_method", "event_method = 'clock_v2'"), ("front_track", "coalesce(front_track_id, 0) <> 0"), ("residual", "abs(residual) <= tolerance"), ("outside", "starts_with(clip, '/out/')"), ("missing", "NOT starts_with(clip, '/out/') OR clip_bytes > 0"), ("dimensions", "NOT (starts_with(clip, '/out/') AND clip_bytes > 0) OR (width = 2560 AND height = 720)"), ("short", "NOT (starts_with(clip, '/out/') AND clip_bytes > 0) OR seconds >= 5")]


@query(f"""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey), h AS (SELECT o_orderkey AS date, 2 + (o_orderkey % 9 > 0)::INT AS schema_version, CASE WHEN o_orderkey % 13 = 0 THEN 'v1' ELSE 'clock_v2' END AS method, CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE 'left_right' END AS layout, (o_orderkey % 26) / 10 AS tolerance,
 coalesce(n, 0) AS n_events, o_orderkey % 3 AS n_skipped, coalesce(n, 0) - (o_orderkey % 17 = 0)::INT AS accepted, coalesce(n, 0) AS combined_clips, coalesce(n, 0) + o_orderkey % 3 AS attempted, CASE WHEN o_orderkey % 19 = 0 THEN 'encoding' ELSE 'complete' END AS progress FROM orders LEFT JOIN n ON o_orderkey = l_orderkey),
e AS (SELECT l_orderkey AS date, CASE WHEN l_partkey % 211 = 0 THEN 'v1' ELSE 'clock_v2' END AS event_method, l_suppkey % 50 AS front_track_id, l_discount * 12 - 0.5::DOUBLE AS residual, CASE WHEN l_partkey % 97 = 0 THEN '/tmp/x' ELSE '/out/' || l_partkey END AS clip, l_partkey % 89 AS clip_bytes, 2560 AS width, 720 - (l_suppkey % 31 = 0)::INT AS height, l_quantity / 2 AS seconds, tolerance FROM lineitem JOIN h ON h.date = l_orderkey),
x AS (SELECT date, unnest({_listed(_V2E)}) AS b FROM e), b AS (SELECT date, list_sort(list_distinct(list(b))) AS below FROM x GROUP BY date)
SELECT h.date, list_concat({_listed(_V2H)}, coalesce(below, []::VARCHAR[])) AS errors, len(list_concat({_listed(_V2H)}, coalesce(below, []::VARCHAR[]))) = 0 AS valid FROM h LEFT JOIN b ON h.date = b.date""")
def combined_result_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i, li = F.col("date"), lambda c: c.cast("int"), table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "date")
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "date").join(li.groupBy("date").agg(F.count("*").alias("c")), "date", "left").withColumn("n_events", F.coalesce("c", F.lit(0)))
    n = F.col("n_events")
    heads = o.select("date", (2 + i(k % 9 > 0)).alias("schema_version"), F.when(k % 13 == 0, "v1").otherwise("clock_v2").alias("method"), F.when(F.col("o_orderstatus") == "P", "old").otherwise("left_right").alias("layout"), ((k % 26) / 10).alias("tolerance"), "n_events", (k % 3).alias("n_skipped"), (n - i(k % 17 == 0)).alias("accepted"), n.alias("combined_clips"), (n + k % 3).alias("attempted"), F.when(k % 19 == 0, "encoding").otherwise("complete").alias("progress"))
    p = F.col("l_partkey")
    events = li.select("date", F.when(p % 211 == 0, "v1").otherwise("clock_v2").alias("event_method"), (F.col("l_suppkey") % 50).alias("front_track_id"), (F.col("l_discount") * 12 - 0.5).alias("residual"), F.when(p % 97 == 0, "/tmp/x").otherwise(F.concat(F.lit("/out/"), p.cast("string"))).alias("clip"), (p % 89).alias("clip_bytes"), F.lit(2560).alias("width"), (720 - i(F.col("l_suppkey") % 31 == 0)).alias("height"), (F.col("l_quantity") / 2).alias("seconds"))
    return rules.combined_result(heads, events, "date", "clock_v2", "left_right", "/out")


@query(f"""WITH c AS (SELECT user_id AS date, count(*) AS collected, count(*) FILTER ({_K} <> 7) AS done, count(*) FILTER (event_type = 'click' AND {_K} % 50 = 0) AS lost FROM events GROUP BY user_id)
SELECT date, {_listed([("reviewed", "done = collected"), ("clips", "lost = 0")])} AS errors, done = collected AND lost = 0 AS valid FROM c""")
def review_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select(F.col("user_id").alias("date"), F.when(F.col("k") != 7, F.col("ts")).alias("reviewed_at"), (F.col("event_type") == "click").alias("confirmed"), (F.col("k") % 50).alias("clip_bytes"))
    return rules.review_result(e, "date")


@query("""WITH h AS (SELECT l_orderkey AS date, count(*) AS clips, count(*) FILTER (NOT (l_partkey % 83 > 0 AND l_quantity >= 5)) AS broken FROM lineitem GROUP BY 1), p AS (SELECT o_orderkey AS date, o_orderkey % 7 AS expected, coalesce(clips, 0) AS clips, coalesce(broken, 0) AS broken FROM orders LEFT JOIN h ON o_orderkey = date)
SELECT date, clips, list_filter([CASE WHEN clips <> expected THEN 'count' END, CASE WHEN broken > 0 THEN 'broken' END], lambda x: x IS NOT NULL) AS errors, clips = expected AS valid FROM p""")
def stage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("date"), (F.col("l_partkey") % 83).alias("bytes"), F.lit(2560).alias("width"), F.lit(720).alias("height"), F.col("l_quantity").alias("seconds"))
    planned = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("date"), (F.col("o_orderkey") % 7).alias("expected"))
    return rules.stage_result(clips, planned, "date")


@query("""WITH e AS (SELECT event_type AS camera, user_id AS date, count(*) AS n FROM events WHERE user_id % 3 = 0 OR event_type <> 'view' GROUP BY ALL), c AS (SELECT camera, sum(n)::BIGINT AS files, count(*) FILTER (n > 1) AS duplicates FROM e GROUP BY camera)
SELECT *, CASE camera WHEN 'click' THEN files >= 100 WHEN 'view' THEN files >= 1000000 ELSE true END AND duplicates = 0 AS valid FROM c""")
def manifest_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("user_id % 3 = 0 or event_type <> 'view'").select(F.col("event_type").alias("camera"), F.col("user_id").alias("date"))
    return rules.manifest_result(e, {"click": 100, "view": 1_000_000}, more=True)


@query("""WITH a AS (SELECT o_custkey, ([0, 2, 65, 124, 130, 1])[(o_orderkey % 6 + 1)::INT] AS code FROM orders), f AS (SELECT o_custkey, count(*) AS failures FROM a WHERE code IN (1, 2, 124) GROUP BY 1)
SELECT c_custkey, coalesce(failures, 0) AS failures, CASE WHEN coalesce(failures, 0) >= 3 THEN 'blocked' ELSE 'run' END AS action FROM customer LEFT JOIN f ON c_custkey = o_custkey WHERE c_acctbal <= 5000""")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.get(F.array(*map(F.lit, (0, 2, 65, 124, 130, 1))), (F.col("o_orderkey") % 6).cast("int")).alias("code"))
    return rules.work_queue(c.select("c_custkey"), c.where("c_acctbal > 5000"), a, "c_custkey")


@query("""WITH n AS (SELECT event_type AS key, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events), b AS (SELECT key, i // 50 AS idx, ln(1 + sqrt(avg(x * x) + 1)) AS x FROM n GROUP BY 1, 2),
d AS (SELECT key, idx, x - sum(x) OVER (PARTITION BY key ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 AS x FROM b), s AS (SELECT key, stddev_pop(x) AS sd FROM d GROUP BY key)
SELECT d.key, idx, round(CASE WHEN sd > 1e-6 THEN x / sd END, 6) AS envelope FROM d JOIN s ON d.key = s.key""")
def signal_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), "ts", "event_id", F.col("value").alias("x"))
    return signals.envelope(signals.indexed(e, ["ts", "event_id"]), 50, 5).select("key", "idx", F.round("envelope", 6).alias("envelope"))


@query(f"""WITH {fx.hourly_sql('a', 'click')}, {fx.hourly_sql('b', 'view')}, l AS (SELECT unnest(range(-24, 25)) AS lag), x AS (SELECT lag, round(sum(a.x * b.x) / count(*), 6) AS score FROM l, b, a WHERE a.idx = b.idx + lag GROUP BY lag), m AS (SELECT lag, score FROM x ORDER BY score DESC, lag LIMIT 1)
SELECT m.lag::INT AS lag, m.score, (SELECT max(score) FROM x WHERE abs(x.lag - m.lag) > 5) AS second, round(m.score / (SELECT max(score) FROM x WHERE abs(x.lag - m.lag) > 5), 3) AS score_ratio, 1 AS polarity, 40.0::DOUBLE - 12.5 + m.lag AS final_offset FROM m""")
def correlation_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = signals.xcorr(fx.hourly(spark, sf_dir, "click"), fx.hourly(spark, sf_dir, "view"), 24).withColumn("score", F.round("score", 6))
    return signals.best_lag(scores, 5).withColumn("final_offset", F.lit(40.0) - F.lit(12.5) + F.col("lag"))


@query("""WITH e AS (SELECT vec_id, unnest(range(4)) AS side, embedding FROM embeddings), v AS (SELECT vec_id, side, list_transform(embedding[side * 16 + 1:side * 16 + 16], lambda x: exp(x::DOUBLE)) AS w FROM e),
d AS (SELECT vec_id, side, list_sum(list_transform(w, lambda x, i: x * (i - 1))) / list_sum(w) AS d FROM v), p AS (SELECT vec_id, max(d) FILTER (side = 0) AS l, max(d) FILTER (side = 1) AS t, max(d) FILTER (side = 2) AS r, max(d) FILTER (side = 3) AS b FROM d GROUP BY vec_id),
a AS (SELECT *, (vec_id % 80 + 0.5::DOUBLE) AS ax, (vec_id * 7 % 80 + 0.5::DOUBLE) AS ay FROM p), q AS (SELECT vec_id, greatest(0::DOUBLE, least(1280::DOUBLE, ((ax - l) * 8 - 0) / 0.5::DOUBLE)) AS x1, greatest(0::DOUBLE, least(720::DOUBLE, ((ay - t) * 8 - 140) / 0.5::DOUBLE)) AS y1, greatest(0::DOUBLE, least(1280::DOUBLE, ((ax + r) * 8 - 0) / 0.5::DOUBLE)) AS x2, greatest(0::DOUBLE, least(720::DOUBLE, ((ay + b) * 8 - 140) / 0.5::DOUBLE)) AS y2 FROM a),
c AS (SELECT vec_id, list_transform(embedding[1:10], lambda x: x::DOUBLE) AS s FROM embeddings)
SELECT q.vec_id, round(x1, 3) AS x1, round(y1, 3) AS y1, round(x2, 3) AS x2, round(y2, 3) AS y2, round(1 / (1 + exp(-list_max(s))), 6) AS score, list_position(s, list_max(s))::INT - 1 AS class_id FROM q JOIN c ON q.vec_id = c.vec_id WHERE x2 > x1 AND y2 > y1""")
def box_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    e = e.withColumns({"ax": F.col("vec_id") % 80 + 0.5, "ay": F.col("vec_id") * 7 % 80 + 0.5})
    b = boxes.decoded(e, F.col("v"), 16, 8, F.col("ax"), F.col("ay"))
    b = boxes.unpadded(b, 0.5, 0.0, 140.0, 1280.0, 720.0)
    score, best = boxes.class_score(F.slice("v", 1, 10))
    return b.select("vec_id", *(F.round(c, 3).alias(c) for c in ("x1", "y1", "x2", "y2")), F.round(score, 6).alias("score"), best.alias("class_id"))


@query(f"""WITH RECURSIVE {fx.RANKED_SQL}, ones AS (SELECT DISTINCT key, 0.0::DOUBLE AS bias FROM r),{fx.greedy_sql('g', 'ones', 6.0)},
twos AS (SELECT ones.key, coalesce(median(o), 0) AS bias FROM ones LEFT JOIN g ON g.key = ones.key GROUP BY ones.key),{fx.greedy_sql('h', 'twos', 6.0)}
SELECT twos.key, round(twos.bias, 6) AS bias, count(front_id) AS accepted, round(coalesce(max(abs(o - twos.bias)), 0), 6) AS max_residual, round(coalesce(min(o), 0), 6) AS min_offset, round(coalesce(max(o), 0), 6) AS max_offset
FROM twos LEFT JOIN h ON h.key = twos.key GROUP BY twos.key, twos.bias""")
def clock_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rear, front = fx.lanes(spark, sf_dir)
    bias = rear.select("key").distinct().withColumn("bias", F.lit(0.0))
    _, heads = matching.aligned(rear, front, bias, 6.0)
    return heads.select("key", F.round("bias", 6).alias("bias"), "accepted", *(F.round(c, 6).alias(c) for c in ("max_residual", "min_offset", "max_offset")))


@query("""SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def unique_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = rules.unique(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey", "run")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey")


@query("""SELECT lane, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most, round(1 / avg(value), 6) AS per_second FROM (SELECT event_type AS lane, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events) WHERE i > 5 GROUP BY lane""")
def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("lane"), "ts", "event_id", "value")
    return summary.latency(e, "lane", ["ts", "event_id"], "value", 5)
