"""Rule sets on an inventory of artefacts: what is where, how large and whose, joined with what the documents say.

inventory: path, bytes, uid, a row for each file. Paths of documents are as the container calls them; see paths.host_path.
Documents come as tables with one row for each folder; one that could not be parsed has unreadable true and no facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators import paths, rules
from wakeline.operators.rollup import validated

EVIDENCE = ("run.json", "events.csv", "tracks.jsonl", "progress.json")
BENCHMARK = "benchmark.json"


def valid_media(width: Column, height: Column, seconds: Column, size: Column, frame: tuple[int, int] = (2560, 720)) -> Column:
    """A composed clip: of the frame's size, five seconds or longer, not empty; what is missing fails."""
    return F.coalesce((width == frame[0]) & (height == frame[1]) & (seconds >= 5) & (size > 0), F.lit(False))


def valid_rear_only(width: Column, height: Column, codec: Column, seconds: Column, size: Column, requested: Column) -> Column:
    """A clip cut from one medium: 1920 x 1080 in h264, five seconds or longer, at most three more than requested."""
    return F.coalesce((width == 1920) & (height == 1080) & (codec == "h264") & (seconds >= 5) & (seconds <= requested + 3) & (size > 0), F.lit(False))


def publishable(valid: Column, method: Column, layouts: list[Column], wanted_method: str, wanted_layout: str) -> Column:
    """valid is true, the method is the wanted one, and so is the layout in every document that tells it."""
    out = F.coalesce(valid, F.lit(False)) & F.coalesce(method == wanted_method, F.lit(False))
    for layout in layouts:
        out = out & F.coalesce(layout == wanted_layout, F.lit(False))
    return out


def clip_states(clips: DataFrame, inventory: DataFrame, root: str, clip: str = "clip", strict: bool = True) -> DataFrame:
    """clips with host, clip_state and clip_uid. clip_state: path (not a path of the container; only if strict), outside, missing, empty or there."""
    host = paths.host_path(F.col(clip), root, strict=strict)
    files = inventory.select(F.col("path").alias("_path"), F.col("bytes").alias("_bytes"), F.col("uid").alias("clip_uid"))
    rows = clips.withColumn("host", host).join(files, F.col("host") == F.col("_path"), "left")
    inside = F.lit(True) if strict else F.coalesce(paths.within(F.col("host"), root), F.lit(False))
    state = F.when(F.col("host").isNull() & F.lit(strict), "path").when(~inside, "outside").when(F.col("_path").isNull(), "missing").when(F.col("_bytes") <= 0, "empty").otherwise("there")
    return rows.withColumn("clip_state", state).drop("_path", "_bytes")


def camera_results(manifest: DataFrame, runs: DataFrame, heartbeats: DataFrame, benchmarks: DataFrame, event_rows: DataFrame, track_lines: DataFrame, inventory: DataFrame, root: str, uid: int, weights: str, device: str, decode: str, fps: float) -> DataFrame:
    """key, errors, details, valid, warning of each recording of the manifest.

    manifest: key, camera, source, duration, size, result_dir, benchmark_dir. runs, heartbeats, event_rows (a row for each
    line, with clip), track_lines (n_lines) by result_dir, benchmarks by benchmark_dir. A folder outside the root or a
    missing piece of evidence ends the check there; else all rules are judged on the joined facts. details name clips and
    owners that are wrong.
    """
    names = F.array(*(F.concat(F.col("result_dir"), F.lit(f"/{n}")) for n in EVIDENCE), F.concat(F.col("benchmark_dir"), F.lit(f"/{BENCHMARK}")))
    wanted = manifest.select("key", F.explode(names).alias("_path"))
    found = wanted.join(inventory.select(F.col("path").alias("_path"), F.col("uid").alias("_uid")), "_path", "left")
    name = F.substring_index("_path", "/", -1)
    gather = lambda c: F.sort_array(F.collect_list(F.when(c, name)))
    evidence = found.groupBy("key").agg(gather(F.col("_uid").isNull()).alias("_lacking"), gather(F.col("_uid") != uid).alias("_owners"))
    states = clip_states(event_rows, inventory, root)
    named = F.coalesce(F.col("clip"), F.lit("")) != ""
    clips = states.groupBy("result_dir").agg(F.count("*").alias("event_rows"), F.count_if(named).alias("clips_named"), F.count_if(F.col("clip_state") != "there").alias("clips_missing"), F.sort_array(F.collect_set(F.when(F.col("clip_state") != "there", F.concat(F.lit("clip_"), F.col("clip_state"))))).alias("_clips"))
    facts = manifest.join(evidence, "key", "left").join(runs.withColumnRenamed("unreadable", "_bad_run"), "result_dir", "left").join(heartbeats.withColumnRenamed("unreadable", "_bad_beat"), "result_dir", "left")
    facts = facts.join(benchmarks.withColumnRenamed("unreadable", "_bad_bench"), "benchmark_dir", "left").join(clips, "result_dir", "left").join(track_lines.select("result_dir", F.col("n_lines").alias("track_lines")), "result_dir", "left")
    facts = facts.na.fill({"event_rows": 0, "clips_named": 0, "clips_missing": 0, "track_lines": 0})
    bad = F.lit(False)
    for c in ("_bad_run", "_bad_beat", "_bad_bench"):
        bad = bad | F.coalesce(F.col(c), F.lit(False))
    # documents count as empty together
    for c in ("run_source", "run_camera", "weights", "device", "decode", "sample_fps", "run_size", "run_duration", "processed_seconds", "wall_seconds", "n_events", "candidate_events", "completed_tracks", "heartbeat", "heartbeat_source", "benchmark_source", "benchmark_seconds", "telemetry_available", "samples"):
        facts = facts.withColumn(c, F.when(~bad, F.col(c)))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("processed_seconds", "wall_seconds", "n_events", "candidate_events", "completed_tracks", "benchmark_seconds")}
    facts = facts.withColumns(zero | {"clips_enabled": F.coalesce("clips_enabled", F.lit(True)) | bad, "owner": F.size("_owners"), "expected_owner": F.lit(0)})
    judged = rules.camera_result(facts, weights, device, decode, fps)
    outside = [F.when(~paths.within(F.col(c), root), F.lit(n)) for c, n in (("result_dir", "result_outside"), ("benchmark_dir", "benchmark_outside"))]
    early = F.concat(F.array_compact(F.array(*outside)), F.transform("_lacking", lambda n: F.concat(F.lit("missing "), n)))
    later = F.concat(F.when(bad, F.array(F.lit("unreadable"))).otherwise(F.array().cast("array<string>")), F.col("errors"))
    stops = F.size(early) > 0
    none = F.array().cast("array<string>")
    details = F.concat(F.when(F.col("clips_enabled"), F.coalesce("_clips", none)).otherwise(none), F.transform("_owners", lambda n: F.concat(F.lit("owner of "), n)))
    errors = F.when(stops, early).otherwise(later)
    return judged.select("key", errors.alias("errors"), F.when(stops, none).otherwise(details).alias("details"), (F.size(errors) == 0).alias("valid"), F.when(~stops, F.col("warning")).alias("warning"))


def combined_results(dates: DataFrame, documents: DataFrame, progress: DataFrame, events: DataFrame, inventory: DataFrame, root: str, uid: int, method: str, layout: str) -> DataFrame:
    """date, errors, valid. dates: date, result_dir. documents, progress by date. events by date, with clip, media and residual.

    Both documents must be there and parse, else their facts count as empty. A clip's later checks need its earlier ones.
    """
    have = lambda n: dates.select("date", F.concat(F.col("result_dir"), F.lit(f"/{n}")).alias("path")).join(inventory.select("path"), "path", "left_semi").select("date", F.lit(True).alias(f"_{n.split('.')[0]}"))
    d = dates.join(have("combined.json"), "date", "left").join(have("progress.json"), "date", "left")
    d = d.join(documents.withColumnRenamed("unreadable", "_bad"), "date", "left").join(progress.withColumnRenamed("unreadable", "_worse"), "date", "left")
    there = F.col("_combined").isNotNull() & F.col("_progress").isNotNull()
    bad = F.coalesce(F.col("_bad"), F.lit(False)) | F.coalesce(F.col("_worse"), F.lit(False))
    good = there & ~bad
    facts = ["schema_version", "method", "layout", "tolerance", "accepted", "combined_clips", "attempted", "n_skipped", "progress"]
    d = d.select("date", "result_dir", there.alias("_there"), (there & bad).alias("_unread"), good.alias("_good"), *(F.when(good, F.col(c)).alias(c) for c in facts))
    own = events.join(d.where("_good").select("date", F.coalesce("tolerance", F.lit(0.0)).alias("_tolerance")), "date")
    d = d.join(own.groupBy("date").agg(F.count("*").alias("n_events")), "date", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("schema_version", "tolerance", "accepted", "combined_clips", "attempted", "n_skipped", "n_events")}
    d = d.withColumns(zero)
    n = F.col("n_events")
    head = {
        "root": paths.within(F.col("result_dir"), root), "evidence": F.col("_there"), "readable": ~F.col("_unread"), "schema": F.col("schema_version") >= 3, "method": F.col("method") == method,
        "layout": F.col("layout") == layout, "tolerance": (F.col("tolerance") > 0) & (F.col("tolerance") <= 2.0), "accepted": F.col("accepted") >= n, "clip_count": F.col("combined_clips") == n,
        "attempted": F.col("attempted") == n + F.col("n_skipped"), "all_skipped": (F.col("attempted") == 0) | (n > 0), "progress": F.col("progress") == "complete",
    }
    rows = clip_states(own, inventory, root, strict=False)
    at = F.col("clip_state") == "there"
    residual = F.abs(F.col("residual"))
    row = {
        "event_method": F.col("event_method") == method, "front_track": F.coalesce(F.col("front_track_id"), F.lit(0)) != 0, "residual_evidence": residual.isNotNull(), "residual": residual.isNull() | (residual <= F.col("_tolerance")),
        "clip_outside": F.col("clip_state") != "outside", "clip_missing": ~F.col("clip_state").isin("missing", "empty"), "dimensions": ~at | F.coalesce((F.col("width") == 2560) & (F.col("height") == 720), F.lit(False)),
        "short": ~at | (F.coalesce("seconds", F.lit(0.0)) >= 5), "owner": ~at | (F.col("clip_uid") == uid),
    }
    of_rows = validated(rows, row).select("date", F.explode("errors").alias("e")).groupBy("date").agg(F.sort_array(F.collect_set("e")).alias("_below"))
    judged = validated(d, head).join(of_rows, "date", "left")
    errors = F.concat("errors", F.coalesce("_below", F.array().cast("array<string>")))
    return judged.select("date", errors.alias("errors"), (F.size(errors) == 0).alias("valid"))


def review_results(collected: DataFrame, reviews: DataFrame, inventory: DataFrame, uid: int) -> DataFrame:
    """One row: reviewed, confirmed, rejected, errors, valid. collected: a row for each skipped event; reviews: confirmed, clip.

    Each confirmed event's clip must be there, not empty, and of the owner; errors name each kind once.
    """
    files = inventory.select(F.col("path").alias("_path"), "bytes", "uid")
    r = reviews.join(files, F.col("clip") == F.col("_path"), "left")
    there = F.coalesce(F.col("bytes") > 0, F.lit(False))
    c = r.agg(F.count("*").alias("reviewed"), F.count_if("confirmed").alias("confirmed"), F.count_if(F.col("confirmed") & ~there).alias("lost"), F.count_if(F.col("confirmed") & there & (F.col("uid") != uid)).alias("foreign"))
    both = c.crossJoin(collected.agg(F.count("*").alias("collected")))  # one row each
    judged = validated(both, {"reviewed": F.col("reviewed") == F.col("collected"), "clips": F.col("lost") == 0, "owner": F.col("foreign") == 0})
    return judged.select("reviewed", "confirmed", (F.col("reviewed") - F.col("confirmed")).alias("rejected"), "errors", "valid")
