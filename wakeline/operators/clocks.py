"""Clocks burned into frames: what a text says, readings tried in order, shifts, and the point where two clocks agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import settle

_WRITTEN = r"([0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2})"
#: Seconds around the wanted moment that are tried in turn, each at both levels of contrast (fixed values).
ADJUSTMENTS = (0.0, -0.4, 0.4, -0.8, 0.8, -2.0, 2.0, -5.0, 5.0)
CONTRASTS = (210, 180)


def written(text: Column) -> Column:
    """Seconds since 1970 of the first day/month/year time in a text; null if there is none or no such day."""
    return F.unix_timestamp(F.try_to_timestamp(F.regexp_extract(text, _WRITTEN, 1), F.lit("dd/MM/yyyy HH:mm:ss")))


def first_reading(rows: DataFrame, keys: list[str], text: Callable[[Column, Column], Column], most: Column | None = None) -> DataFrame:
    """keys, clock_seconds, adjustment, contrast of the first attempt whose text has a clock; nulls where none has.

    text(adjustment, contrast) is what the reader gives for an attempt. With most, attempts that many seconds or more
    from the start (or before it) are left out: rows need a column at, the wanted moment.
    """
    attempts = [(a, c) for a in ADJUSTMENTS for c in CONTRASTS]
    reading = lambda a: F.struct(written(text(a["adjustment"], a["contrast"])).alias("clock_seconds"), a["adjustment"].alias("adjustment"), a["contrast"].alias("contrast"))
    tried = F.array(*(F.struct(F.lit(a).alias("adjustment"), F.lit(c).alias("contrast")) for a, c in attempts))
    if most is not None:
        tried = F.filter(tried, lambda a: (F.col("at") + a["adjustment"] >= 0) & (F.col("at") + a["adjustment"] < most))
    found = F.get(F.filter(F.transform(tried, reading), lambda r: r["clock_seconds"].isNotNull()), 0)
    return rows.select(*keys, found.alias("r")).select(*keys, "r.clock_seconds", "r.adjustment", "r.contrast")


def shifted(clock: Column, requested: Column, sampled: Column) -> Column:
    """A clock read at sampled as it was at requested (both in seconds of the medium)."""
    return clock + F.make_dt_interval(secs=(requested - sampled).cast("decimal(18,6)"))


def synchronized(requests: DataFrame, readings: DataFrame, keys: list[str], rounds: int = 4, within: float = 1.0) -> DataFrame:
    """Follow a front clock until it shows what the rear clock shows: each round looks where the last difference points.

    requests: keys (the first one names the recording), rear_time, rear_sample (where the rear clock was read),
    rear_clock, offset, front_length. readings: the recording, second, clock. Returns keys, status, front_time,
    offset_seconds, residual, rounds. status: converged, no_clock, out_of_range, or not_converged after the last
    round; only rows that are still open go into the next one. readings may have far more rows than Spark takes them
    for (they may be exploded from recordings), so they are merged with the requests and never broadcast.
    """
    name = keys[0]
    start = F.least(F.greatest(F.lit(0.0), F.col("rear_time") - F.col("offset")), F.col("front_length") - 0.001)
    open_, done = requests.withColumn("_at", start), []
    for k in range(1, rounds + 1):
        seen = readings.select(name, F.col("second").alias("_second"), F.col("clock").alias("_clock"))
        tried = open_.withColumn("_second", F.floor("_at").cast("long")).join(seen.hint("merge"), [name, "_second"], "left")
        delta = F.col("rear_clock") - F.col("_clock")
        to = F.col("_second") + delta
        status = F.when(F.col("_clock").isNull(), "no_clock").when((to < 0) | (to >= F.col("front_length")), "out_of_range").when(F.abs(delta) <= within, "converged")
        status = status if k < rounds else F.coalesce(status, F.lit("not_converged"))
        tried = settle(tried.select(*requests.columns, to.cast("double").alias("_at"), delta.cast("double").alias("_delta"), status.alias("status")))
        done.append(tried.where("status is not null").withColumn("rounds", F.lit(k)))
        open_ = tried.where("status is null").drop("status", "_delta")
        if k < rounds and open_.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    good = lambda c: F.when(F.col("status") == "converged", c)
    front = F.col("_at") + F.col("rear_time") - F.col("rear_sample")
    return out.select(*keys, "status", good(F.round(front, 3)).alias("front_time"), good(F.round(F.col("rear_time") - front, 3)).alias("offset_seconds"), good(F.col("_delta")).alias("residual"), "rounds")


def required(rows: DataFrame, key: str) -> DataFrame:
    """rows of synchronized(); one that did not converge is an error when the rows are read."""
    text = F.concat(F.lit("clocks "), F.col("status"), F.lit(" for "), F.col(key).cast("string"))
    return rows.where(F.when(F.col("status") == "converged", F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
