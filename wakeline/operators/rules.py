"""Rule sets of the artefacts: one row for each artefact comes in, its failed rules by name go out (see rollup.validated).

Expected values are parameters; a fact that is missing fails its rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.rollup import validated, validated_groups


def _near(a: str, b: str, limit: float) -> Column:
    return F.abs(F.coalesce(F.col(a), F.lit(0)) - F.col(b)) <= limit


def camera_result(runs: DataFrame, weights: str, device: str, decode: str, fps: float) -> DataFrame:
    """Run, manifest, heartbeat and benchmark facts of one recording, joined in one row, with errors, valid and warning."""
    same = lambda a, b: F.col(a) == F.col(b)
    clips = F.when(F.col("clips_enabled"), F.col("clips_missing") == 0).otherwise(F.col("clips_named") == 0)
    rules = {
        "source": same("run_source", "source"), "camera": same("run_camera", "camera"), "weights": F.col("weights") == weights, "device": F.col("device") == device,
        "decode": F.col("decode") == decode, "sample_rate": F.col("sample_fps") == fps, "size": same("run_size", "size"), "duration": _near("run_duration", "duration", 0.05),
        "processed": _near("processed_seconds", "duration", 1.0), "wall": F.col("wall_seconds") > 0, "events": same("n_events", "candidate_events"),
        "event_rows": same("event_rows", "candidate_events"), "track_lines": same("track_lines", "completed_tracks"), "clips": clips,
        "heartbeat": F.col("heartbeat") == "complete", "heartbeat_source": same("heartbeat_source", "source"), "benchmark_source": same("benchmark_source", "source"),
        "benchmark_seconds": _near("benchmark_seconds", "processed_seconds", 0.01), "owner": same("owner", "expected_owner"),
    }
    silent = ~F.coalesce(F.col("telemetry_available"), F.col("samples") > 0, F.lit(False))
    return validated(runs, rules).withColumn("warning", F.when(silent, "no_telemetry"))


def combined_result(heads: DataFrame, events: DataFrame, key: str, method: str, layout: str, root: str) -> DataFrame:
    """key, errors, valid of a date: by its document and by each of its events."""
    n, skipped = F.col("n_events"), F.col("n_skipped")
    tolerance = F.coalesce(F.col("tolerance"), F.lit(0.0))
    head = {
        "schema": F.coalesce(F.col("schema_version"), F.lit(0)) >= 3, "method": F.col("method") == method, "layout": F.col("layout") == layout,
        "tolerance": (tolerance > 0) & (tolerance <= 2.0), "accepted": F.col("accepted") >= n, "clip_count": F.col("combined_clips") == n,
        "attempted": F.col("attempted") == n + skipped, "all_skipped": (F.col("attempted") == 0) | (n > 0), "progress": F.col("progress") == "complete",
    }
    inside = F.col("clip").startswith(root + "/")
    there = inside & (F.col("clip_bytes") > 0)
    row = {
        "event_method": F.col("event_method") == method, "front_track": F.coalesce(F.col("front_track_id"), F.lit(0)) != 0,
        "residual": F.abs(F.col("residual")) <= F.col("tolerance"), "outside": inside, "missing": ~inside | (F.col("clip_bytes") > 0),
        "dimensions": ~there | ((F.col("width") == 2560) & (F.col("height") == 720)), "short": ~there | (F.col("seconds") >= 5),
    }
    rows = events.join(heads.select(key, tolerance.alias("tolerance")), key)
    return validated_groups(heads, rows, key, head, row)


def review_result(reviews: DataFrame, key: str) -> DataFrame:
    """key, errors, valid: as many reviewed as collected, and each confirmed clip there."""
    counted = reviews.groupBy(key).agg(F.count("*").alias("collected"), F.count("reviewed_at").alias("done"), F.count_if(F.col("confirmed") & ~F.coalesce(F.col("clip_bytes") > 0, F.lit(False))).alias("lost"))
    return validated(counted, {"reviewed": F.col("done") == F.col("collected"), "clips": F.col("lost") == 0}).select(key, "errors", "valid")


def stage_result(clips: DataFrame, planned: DataFrame, key: str, width: int = 2560, height: int = 720) -> DataFrame:
    """key, clips, errors, valid of a staged date. Only its own count decides valid; broken clips are errors all the same."""
    good = F.coalesce((F.col("bytes") > 0) & (F.col("width") == width) & (F.col("height") == height) & (F.col("seconds") >= 5), F.lit(False))
    have = clips.groupBy(key).agg(F.count("*").alias("clips"), F.count_if(~good).alias("broken"))
    both = planned.join(have, key, "left").na.fill({"clips": 0, "broken": 0})
    count_ok = F.col("clips") == F.col("expected")
    errors = F.array_compact(F.array(F.when(~count_ok, F.lit("count")), F.when(F.col("broken") > 0, F.lit("broken"))))
    return both.select(key, "clips", errors.alias("errors"), count_ok.alias("valid"))


def manifest_result(manifest: DataFrame, expected: dict[str, int], more: bool = False) -> DataFrame:
    """camera, files, duplicates, valid: the count expected (0: any; more: or above), and no date twice."""
    each = manifest.groupBy("camera", "date").agg(F.count("*").alias("n"))
    c = each.groupBy("camera").agg(F.sum("n").alias("files"), F.count_if(F.col("n") > 1).alias("duplicates"))
    want = F.lit(0)
    for camera, n in expected.items():
        want = F.when(F.col("camera") == camera, n).otherwise(want)
    right = (want == 0) | ((F.col("files") >= want) if more else (F.col("files") == want))
    return c.withColumn("valid", right & (F.col("duplicates") == 0))


#: Exit codes of a worker and the state that the ledger keeps (fixed values).
EXIT_STATES = {0: "complete", 2: "usage", 65: "blocked", 124: "watchdog", 130: "interrupted"}


def exit_state(code: Column) -> Column:
    """The ledger's state of an exit code; all codes without one are failures."""
    out = F.lit("failed")
    for k, v in EXIT_STATES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def counts_as_failure(state: Column) -> Column:
    """Interrupted and blocked attempts do not use up retries."""
    return state.isin("failed", "watchdog", "usage")


def work_queue(manifest: DataFrame, valid: DataFrame, attempts: DataFrame, key: str, limit: int = 3) -> DataFrame:
    """Rows of the manifest that are not validated yet, with failures so far and action: run or blocked."""
    failed = attempts.where(counts_as_failure(exit_state(F.col("code")))).groupBy(key).agg(F.count("*").alias("failures"))
    rest = manifest.join(valid.select(key), key, "left_anti").join(failed, key, "left").na.fill({"failures": 0})
    return rest.withColumn("action", F.when(F.col("failures") >= limit, "blocked").otherwise("run"))


def unique(rows: DataFrame, key: str, what: str) -> DataFrame:
    """rows, each key once: a key that is there twice is an error when the rows are read."""
    n = F.count("*").over(Window.partitionBy(key))
    checked = rows.withColumn("_n", n)
    return checked.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"more than one {what} for "), F.col(key).cast("string"))).cast("boolean"))).drop("_n")


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], what: str) -> DataFrame:
    """rows with the columns of table, which must have each row's keys exactly once; else an error when the rows are read."""
    n = table.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*(c for c in table.columns if c not in keys))).alias("_new"))
    both = rows.join(n, keys, "left")
    text = F.concat(F.when(F.col("_n").isNull(), f"no {what} for ").otherwise(f"more than one {what} for "), F.to_json(F.struct(*keys)))
    checked = both.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    return checked.select(*rows.columns, "_new.*")
