"""Status, batch rollups, telemetry statistics, ledgers and rule sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import settle


def status(run: Column, benchmark: Column, valid: Column) -> Column:
    """completed, awaiting_validation, awaiting_benchmark or pending, from what of a file exists."""
    return (
        F.when(run & benchmark & F.coalesce(valid, F.lit(False)), "completed")
        .when(run & benchmark, "awaiting_validation")
        .when(run, "awaiting_benchmark")
        .otherwise("pending")
    )


def batch_rollup(files: DataFrame, group: str = "camera") -> DataFrame:
    """Overall and per group: files, completed, hours, share done, seconds left at the pace so far (ratio of sums)."""
    done = F.col("status") == "completed"
    seconds = lambda c, only=True: F.coalesce(F.sum(F.when(done, F.col(c)) if only else F.col(c)), F.lit(0).cast("long"))
    total = files.groupingSets([[], [group]], group).agg(
        F.when(F.grouping(group) == 1, "overall").otherwise(F.col(group)).alias("lane"), F.count("*").alias("files"), F.count_if(done).alias("completed"),
        seconds("media_seconds", False).alias("expected_seconds"), seconds("media_seconds").alias("processed_seconds"), seconds("wall_seconds").alias("wall_seconds"), seconds("events").alias("events"),
    )
    factor = F.try_divide("processed_seconds", "wall_seconds")
    left = F.col("expected_seconds") - F.col("processed_seconds")
    return total.drop(group).withColumns({"real_time_factor": F.round(factor, 6), "seconds_left": F.round(F.try_divide(left, factor), 3)})


def telemetry_stats(samples: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, n, least, most, mean, p95 (nearest rank, index rounded half to even) over the cells that hold a number."""
    long = samples.unpivot([], metrics, "metric", "value").where("value is not null")
    stats = long.groupBy("metric").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.avg("value"), 3).alias("mean"))
    # ranks from counts of equal values: values are range-partitioned, so a rank is a count of the parts before and a place in its part
    values = settle(long.groupBy("metric", "value").agg(F.count("*").alias("k")).repartitionByRange("metric", "value").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("metric").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = values.groupBy("metric", "part").agg(F.sum("k").alias("k")).select("metric", "part", "k", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    rank = F.bround(0.95 * (F.col("n") - 1))
    # only the part that holds the rank is sorted
    held = parts.join(stats.select("metric", "n"), "metric").where((F.col("base") <= rank) & (rank < F.col("base") + F.col("k"))).select("metric", "part", "base", "n")
    inside = Window.partitionBy("metric").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.join(held, ["metric", "part"]).withColumn("upto", F.col("base") + F.sum("k").over(inside))
    at = ranked.where(F.col("upto") > rank).groupBy("metric").agg(F.min("value").alias("p95"))
    return stats.join(at, "metric")


def attempt_union(lanes: dict[str, DataFrame]) -> DataFrame:
    """All ledgers in one, each row with its lane; missing columns are empty."""
    out = None
    for lane, df in lanes.items():
        df = df.withColumn("lane", F.lit(lane))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.na.fill("")


def retry_guard(attempts: DataFrame, key: str, limit: int = 3, version: str = "") -> DataFrame:
    """key, failures of this version, blocked."""
    failed = F.count_if((F.col("state") == "failed") & F.col("detail").startswith(version)).alias("failures")
    return attempts.groupBy(key).agg(failed).withColumn("blocked", F.col("failures") >= limit)


def pair_pivot(files: DataFrame, key: str, side: str, sides: tuple[str, str], value: str) -> DataFrame:
    """key with one value for each of the two sides; keys that lack a side or have one twice go."""
    one = files.groupBy(key).pivot(side, list(sides)).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("v"))
    a, b = sides
    return one.where((F.col(f"{a}_n") == 1) & (F.col(f"{b}_n") == 1)).select(key, F.col(f"{a}_v").alias("first_value"), F.col(f"{b}_v").alias("second_value"))


def schedulable(keys: DataFrame, done: DataFrame, active: DataFrame, ready: DataFrame, key: str) -> DataFrame:
    """Keys neither done nor active, and ready."""
    return keys.join(done, key, "left_anti").join(active, key, "left_anti").join(ready, key, "left_semi")


def watchdog(starts: DataFrame, beats: DataFrame, key: str, now: Column, limit: float) -> DataFrame:
    """key, last_beat, silent: more than limit since the last beat or, without one, since the start.

    starts: key, started; beats: key, at; all times are numbers of one unit.
    """
    last = beats.groupBy(key).agg(F.max("at").alias("last_beat"))
    since = now - F.coalesce("last_beat", "started")
    return starts.join(last, key, "left").select(key, "last_beat", (since > limit).alias("silent"))


def publish_list(clips: DataFrame, combined: DataFrame, reviews: DataFrame, reviewed: DataFrame, key: str, clip: tuple[str, ...]) -> DataFrame:
    """All clips of valid combined keys and, of valid reviews, the confirmed ones: key, the clip's columns, origin."""
    a = clips.join(combined.where("valid").select(key), key, "left_semi").select(key, *clip, F.lit("combined").alias("origin"))
    b = reviews.where("confirmed").join(reviewed.where("valid").select(key), key, "left_semi")
    return a.unionByName(b.select(key, *clip, F.lit("review").alias("origin")))


def validated_groups(heads: DataFrame, rows: DataFrame, key: str, head_rules: dict[str, Column], row_rules: dict[str, Column]) -> DataFrame:
    """key, errors, valid: a key fails by its own rules and by the rules that any of its rows fails.

    Rows fail by name, so a key holds each name once however many rows it has.
    """
    head = validated(heads, head_rules).select(key, F.col("errors").alias("own"))
    bad = validated(rows, row_rules).select(key, F.explode("errors").alias("e")).groupBy(key).agg(F.collect_set("e").alias("below"))
    errors = F.concat("own", F.sort_array(F.coalesce("below", F.array().cast("array<string>"))))
    return head.join(bad, key, "left").select(key, errors.alias("errors"), (F.size(errors) == 0).alias("valid"))


def validated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with errors (the names of failed rules; a rule without a value fails) and valid."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.withColumn("errors", failed).withColumn("valid", F.size("errors") == 0)
