"""The second look at events that found no partner: evidence tiers, ordered attempts, anchors, orders and limits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VEHICLES = (2, 3, 5, 7)


def all_checks(checks: list[str]) -> Column:
    """Every check is there and true."""
    out = F.lit(True)
    for c in checks:
        out = out & F.coalesce(F.col(c), F.lit(False))
    return out


def strong_evidence(passes: Column) -> Column:
    """Checks passed by a confident, long and large track of a known class; what is missing fails."""
    at_least = lambda c, v: F.coalesce(F.col(c), F.lit(0)) >= v
    return passes & F.col("class_id").isin(*VEHICLES) & at_least("max_confidence", 0.80) & at_least("detections", 5) & at_least("duration", 1.0) & at_least("peak_area", 0.01)


def secondary(samples: Column, least_area: float = 0.003, least_confidence: float = 0.25) -> Column:
    """frames, best of nested samples (arrays of detections): those with a vehicle, and the highest confidence or 0."""
    fits = lambda d: d["class_id"].isin(*VEHICLES) & (d["area"] >= least_area) & (d["confidence"] >= least_confidence)
    seen = F.transform(samples, lambda s: F.filter(s["detections"], fits))
    best = F.array_max(F.transform(F.flatten(seen), lambda d: d["confidence"]))
    return F.struct(F.size(F.filter(seen, lambda s: F.size(s) > 0)).alias("frames"), F.coalesce(best, F.lit(0.0)).alias("best"))


def reviewed(tracks: DataFrame, samples: DataFrame, keys: list[str], checks: list[str]) -> DataFrame:
    """keys, strong, required, frames, best, confirmed: weak tracks need the second look, others have none."""
    passes = all_checks(checks)
    strong = strong_evidence(passes)
    t = tracks.select(*keys, passes.alias("passes"), strong.alias("strong"))
    looked = samples.select(*keys, secondary(F.col("samples")).alias("look"))
    t = t.join(looked, keys, "left")
    required = F.col("passes") & ~F.col("strong")
    frames, best = (F.when(required, F.coalesce(F.col(f"look.{c}"), F.lit(0))).otherwise(F.lit(0)) for c in ("frames", "best"))
    second = (frames >= 2) | (best >= 0.60)
    return t.select(*keys, "strong", required.alias("required"), frames.cast("long").alias("frames"), best.cast("double").alias("best"), (F.col("passes") & (F.col("strong") | second)).alias("confirmed"))


def counters(reviews: DataFrame) -> DataFrame:
    """reviewed, confirmed, rejected, strong, secondary."""
    return reviews.agg(
        F.count("*").alias("reviewed"), F.count_if("confirmed").alias("confirmed"), F.count_if(~F.col("confirmed")).alias("rejected"),
        F.count_if("strong").alias("strong"), F.count_if(F.col("confirmed") & ~F.col("strong")).alias("secondary"),
    )


def first_success(rows: DataFrame, keys: list[str], attempts: Sequence[float], works: Callable[[Column, Column], Column]) -> DataFrame:
    """keys, attempt, value of the first of the (few, ordered) attempts that works(place, value); nulls where none does."""
    tried = F.array(*(F.struct(F.lit(k).cast("long").alias("attempt"), F.lit(v).alias("value")) for k, v in enumerate(attempts)))
    hit = F.get(F.filter(tried, lambda a: works(a["attempt"], a["value"])), 0)
    return rows.select(*keys, hit.alias("hit")).select(*keys, "hit.attempt", "hit.value")


def anchor_search(candidates: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """key, anchor, failures: candidates (key, ord, at, works) in order, equal times (to a thousandth) once, until one works.

    After limit failures the search gives up; anchor is then null.
    """
    if limit < 1:
        raise ValueError("at least one failure must be allowed")
    once = candidates.groupBy(key, F.round(F.col("at") * 1000).cast("long").alias("ms")).agg(F.min(F.struct("ord", "at", "works")).alias("c"))
    w = Window.partitionBy(key).orderBy("c.ord")
    tried = once.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)
    good = F.when(F.col("c.works"), F.col("place"))
    out = tried.groupBy(key).agg(F.min_by("c.at", F.coalesce(good, F.lit(1 << 30))).alias("a"), F.min(good).alias("hit"), F.count("*").alias("n"))
    return out.select(key, F.when(F.col("hit").isNotNull(), F.col("a")).alias("anchor"), F.coalesce(F.col("hit") - 1, "n").cast("long").alias("failures"))


def first_of(rows: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first rows of each key in the order, with their place; all of them for a most of 0."""
    if most < 0:
        raise ValueError("a limit cannot be negative")
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))
    return placed.where(F.col("place") <= most) if most else placed
