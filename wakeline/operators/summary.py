"""The batch report: manifest and optional documents, all metrics by lane, energy, and telemetry cells that hold lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.ranges import after_first
from wakeline.operators.rollup import status


def file_report(manifest: DataFrame, runs: DataFrame, benchmarks: DataFrame, validations: DataFrame, key: str) -> DataFrame:
    """The manifest with what its optional documents say: status, telemetry_available and the metrics of each file."""
    j = manifest.join(runs, key, "left").join(benchmarks, key, "left").join(validations, key, "left")
    run, bench = F.col("run_seconds").isNotNull(), F.col("samples").isNotNull()
    telemetry = F.coalesce(F.col("flag"), F.col("samples") > 0) & F.col("socket_mean").isNotNull() & F.col("energy_wh").isNotNull()
    j = j.withColumn("status", status(run, bench, F.col("valid")))
    done = F.col("status") == "completed"
    factor = F.try_divide("run_seconds", "wall_seconds")
    return j.withColumns({
        "telemetry_available": F.when(done, telemetry).otherwise(F.lit(False)), "source_hours": F.when(done, F.round(F.col("run_seconds") / 3600, 4)),
        "wall_minutes": F.when(done, F.round(F.col("wall_seconds") / 60, 3)), "real_time_factor": F.when(done, F.round(factor, 3)),
        "minutes_per_source_hour": F.when(done, F.round(F.try_divide(F.lit(60.0), factor), 3)),
    })


def lane_report(files: DataFrame, lane: str) -> DataFrame:
    """lane (overall and each) with thirteen metrics; ratios are ratios of sums."""
    done = F.col("status") == "completed"
    power = done & F.col("telemetry_available")
    total = lambda c, only=None: F.coalesce(F.sum(F.when(only, F.col(c)) if only is not None else F.col(c)), F.lit(0)).cast("double")
    g = files.groupingSets([[], [lane]], lane).agg(
        F.when(F.grouping(lane) == 1, "overall").otherwise(F.col(lane)).alias("_lane"), F.count("*").alias("expected_files"), F.count_if(done).alias("completed_files"),
        total("expected_seconds").alias("e"), total("run_seconds", done).alias("s"), total("wall_seconds", done).alias("w"), total("candidate_events", done).cast("long").alias("candidate_events"),
        F.count_if(power).alias("telemetry_files"), total("run_seconds", power).alias("p"), total("energy_wh", power).alias("q"),
    )
    factor = F.when((F.col("w") != 0) & (F.col("s") != 0), F.col("s") / F.col("w"))
    left = F.greatest(F.lit(0.0), F.col("e") - F.col("s"))
    return g.select(
        F.col("_lane").alias("lane"), "expected_files", "completed_files", F.round(F.col("e") / 3600, 3).alias("expected_hours"), F.round(F.col("s") / 3600, 3).alias("processed_hours"),
        F.round(F.col("w") / 3600, 3).alias("wall_hours"), F.round(factor, 3).alias("real_time_factor"), F.round(60.0 / factor, 3).alias("minutes_per_source_hour"),
        F.round(left / factor / 3600, 3).alias("hours_left"), "candidate_events", "telemetry_files", F.round(F.col("p") / 3600, 3).alias("telemetry_hours"),
        F.round("q", 3).alias("energy_wh"), F.round(F.try_divide(F.col("q"), F.col("p") / 3600), 3).alias("wh_per_source_hour"),
    )


def energy(stats: DataFrame, mean: str, hours: Column, source_hours: Column, fps: Column) -> DataFrame:
    """stats with energy from the rounded mean power: Wh, Wh a source hour, joules an inference."""
    power = F.round(F.col(mean), 3)
    wh = F.round(power * hours, 4)
    return stats.withColumns({"mean_watts": power, "energy_wh": wh, "wh_per_source_hour": F.round(F.try_divide(wh, source_hours), 4), "joules_per_inference": F.round(F.try_divide(power, fps), 6)})


def list_cell(cell: Column) -> Column:
    """The mean of the numbers in a cell that holds a list as text; null without one."""
    items = F.filter(F.from_json(cell, "array<string>"), lambda x: x.try_cast("double").isNotNull())
    numbers = F.transform(items, lambda x: x.try_cast("double"))
    return F.when(F.size(numbers) > 0, F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x) / F.size(numbers))


def latency(runs: DataFrame, key: str, order: list[str], value: str, warm_up: int) -> DataFrame:
    """key, n, mean, least, most, per_second of the values after each key's first warm_up ones in the order."""
    mean = F.avg(value)
    timed = after_first(runs, [key], order, warm_up).groupBy(key)
    return timed.agg(F.count("*").alias("n"), F.round(mean, 6).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), F.round(1 / mean, 6).alias("per_second"))


def lane_lines(runs: DataFrame, lanes: tuple[str, ...] = ("front", "rear"), camera: str = "camera") -> DataFrame:
    """camera and line for each lane in turn: the seconds of its medium and how long they took; a lane without a run is an error."""
    one = runs.where(F.col(camera).isin(*lanes)).groupBy(camera).agg(F.sum("processed_source_seconds").alias("s"), F.sum("wall_seconds").alias("w"))
    wanted = runs.sparkSession.createDataFrame([(k, c) for k, c in enumerate(lanes)], f"place int, `{camera}` string")
    both = wanted.join(one, camera, "left")
    there = F.when(F.col("s").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no run of "), F.col(camera))).cast("boolean"))
    return both.where(there).select("place", camera, F.format_string("%s: %.1fs source in %.2fs wall", F.col(camera), F.col("s"), F.col("w")).alias("line"))
