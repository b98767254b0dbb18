"""Observations to tracks: gap sessions, six checks, and the order-dependent removal of duplicates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.groups import whole_groups
from wakeline.operators.ranges import gap_groups

CLASS_NAMES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}


@dataclass(frozen=True)
class Thresholds:
    detections: int = 4
    duration: float = 0.8
    peak_area: float = 0.006
    area_ratio: float = 1.7
    vertical_travel: float = 0.06
    side_offset: float = 0.08
    radial_ratio: float = 0.30
    endpoint_growth: float = 0.03
    centreline: float = 0.04
    front_latest_peak: float = 0.45
    rear_earliest_peak: float = 0.45


def with_box(df: DataFrame) -> DataFrame:
    """Centre and area of the box (left, top, right, bottom); negative sides count as zero."""
    side = lambda a, b: F.greatest(F.lit(0.0), F.col(b) - F.col(a))
    return df.withColumns({"cx": (F.col("left") + F.col("right")) / 2, "cy": (F.col("top") + F.col("bottom")) / 2, "area": side("left", "right") * side("top", "bottom")})


def sessionize(df: DataFrame, gap: float, keys: tuple[str, ...] = ("source",), ts: str = "ts", tie: str = "obs_id", frame: float = 0.0, spread: bool = False) -> DataFrame:
    """df with session: a new one starts where the step from the key's row before exceeds gap.

    With the length of a frame given, sessions end at frames: a row still joins if the frame before its own is within
    gap of the last row, as a session is closed only after a frame's own rows are added. With spread the rows of one
    key are shared by tasks (see ranges.gap_groups).
    """
    return gap_groups(df, list(keys), [ts, tie], ts, gap, "session", frame, spread)


def summarize(obs: DataFrame, limits: Thresholds = Thresholds(), keys: tuple[str, ...] = ("source", "session")) -> DataFrame:
    """One row for each track: its measures, the six checks and candidate.

    The peak is the earliest row of largest area. A front camera is judged from the peak on (the object
    recedes), a rear camera up to the peak (it comes near).
    """
    known = F.when(F.col("camera").isin("front", "rear"), F.col("camera")).otherwise(F.raise_error(F.concat(F.lit("unknown camera: "), F.coalesce("camera", F.lit("null")))))
    obs = obs.withColumn("camera", known)
    w = Window.partitionBy(*keys).orderBy("ts", "obs_id")
    rows = obs.withColumn("idx", F.row_number().over(w) - 1).withColumn("floored", F.greatest("area", F.lit(1e-9)))
    whole = Window.partitionBy(*keys)
    rows = rows.withColumn("peak", -F.max(F.struct("floored", -F.col("idx"))).over(whole)["col2"])
    rows = rows.withColumn("used", F.when(F.col("camera") == "front", F.col("idx") >= F.col("peak")).otherwise(F.col("idx") <= F.col("peak")))
    at_peak = lambda c: F.max(F.when(F.col("idx") == F.col("peak"), F.col(c)))
    # times that hardly differ have no slope
    spread = F.var_pop(F.when(F.col("used"), F.col("ts"))) * F.count(F.when(F.col("used"), F.lit(1)))
    log_area = F.when(F.col("used"), F.log("floored"))
    used_ts = F.when(F.col("used"), F.col("ts"))
    ends = {"first": F.min_by(F.struct("cx", "bottom", "floored"), "idx"), "last": F.max_by(F.struct("cx", "bottom", "floored"), "idx")}
    t = rows.groupBy(*keys).agg(
        F.first("camera").alias("camera"), F.count("*").alias("detections"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.min_by("class_id", "idx").alias("class_id"), F.max("confidence").alias("max_confidence"), F.max("peak").alias("peak_index"),
        at_peak("ts").alias("peak_time"), at_peak("cx").alias("pcx"), at_peak("bottom").alias("pbottom"), at_peak("floored").alias("peak_area"),
        F.when(spread > 1e-12, F.regr_slope(log_area, used_ts)).alias("slope"), *(v.alias(k) for k, v in ends.items()),
    )
    front = F.col("camera") == "front"
    end = lambda f: F.when(front, F.col(f"last.{f}")).otherwise(F.col(f"first.{f}"))
    t = t.withColumns({
        "duration": F.col("last_seen") - F.col("first_seen"), "side_offset": F.abs(F.col("pcx") - 0.5), "side": F.when(F.col("pcx") < 0.5, "left").otherwise("right"),
        "class_name": F.coalesce(_class_name(F.col("class_id")), F.col("class_id").cast("string")),
        "slope": F.coalesce("slope", F.lit(0.0)), "peak_fraction": F.col("peak_index") / F.greatest(F.lit(1), F.col("detections") - 1),
        "area_ratio": F.col("peak_area") / end("floored"), "vertical_travel": F.col("pbottom") - end("bottom"),
        "endpoint_offset": F.abs(end("cx") - 0.5), "lateral_travel": F.abs(F.col("pcx") - end("cx")),
    })
    t = t.withColumn("radial_ratio", F.col("vertical_travel") / F.greatest("lateral_travel", F.lit(1e-6)))
    consistent = ((F.col("pcx") - 0.5) * (end("cx") - 0.5) >= 0) | (F.col("endpoint_offset") <= limits.centreline)
    radial = consistent & (F.col("endpoint_offset") <= F.col("side_offset") + limits.endpoint_growth) & (F.col("radial_ratio") >= limits.radial_ratio)
    position = F.when(front, F.col("peak_fraction") <= limits.front_latest_peak).otherwise(F.col("peak_fraction") >= limits.rear_earliest_peak)
    direction = F.when(front, F.col("slope") < 0).otherwise(F.col("slope") > 0)
    checks = {
        "ok_detections": F.col("detections") >= limits.detections, "ok_duration": F.col("duration") >= limits.duration, "ok_peak_area": F.col("peak_area") >= limits.peak_area,
        "ok_area_ratio": F.col("area_ratio") >= limits.area_ratio, "ok_side_offset": F.col("side_offset") >= limits.side_offset,
        "ok_trajectory": position & direction & (F.col("vertical_travel") >= limits.vertical_travel) & radial,
    }
    t = t.withColumns(checks | {"centreline_consistent": consistent})
    candidate = F.lit(True)
    for c in checks:
        candidate = candidate & F.col(c)
    return t.withColumn("candidate", candidate).drop("first", "last", "pcx", "pbottom")


def _class_name(class_id: Column) -> Column:
    name = F.lit(None).cast("string")
    for k, v in CLASS_NAMES.items():
        name = F.when(class_id == k, v).otherwise(name)
    return name


def deduplicate(tracks: DataFrame, lane: tuple[str, ...], peak_window: float = 1.0, track_gap: float = 0.25, spread: bool = False) -> DataFrame:
    """tracks with survivor and duplicate_of: a scan in the order of peak times compares each with the last survivor.

    Tracks of one side, near in time, are one object; the one with more detections, then the longer one, then
    the larger stays, and the earlier one of equals. duplicate_of is the track that won the comparison, which may
    lose a later one. Times are compared as they are reported, in thousandths. A chain can only run through steps of at most peak_window, so a lane falls at larger steps
    into groups, and tasks take whole groups from sorted rows. With spread these are found in ranges of a lane.
    """
    shown = {f"_{c}": F.round(c, 3) for c in ("peak_time", "first_seen", "last_seen")}
    tracks = tracks.withColumns(shown)
    cut = gap_groups(tracks, list(lane), ["_peak_time", "track_id"], "_peak_time", peak_window, "_group", spread=spread)
    own = [*lane, "_group"]

    def scan(batches):
        for g, at in whole_groups(batches, own):
            stays, winner = np.ones(len(g), bool), np.full(len(g), None, object)
            side, peak, first, last_seen = (g[c].tolist() for c in ("side", "_peak_time", "_first_seen", "_last_seen"))
            worth = list(zip(g["detections"].tolist(), g["duration"].tolist(), g["peak_area"].tolist(), strict=True))
            ids = g["track_id"].tolist()
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                last = i
                for k in range(i + 1, j):
                    if side[k] != side[last] or peak[k] - peak[last] > peak_window or first[k] > last_seen[last] + track_gap:
                        last = k
                    elif worth[k] > worth[last]:
                        stays[last], winner[last], last = False, ids[k], k
                    else:
                        stays[k], winner[k] = False, ids[last]
            yield g.assign(survivor=stays, duplicate_of=pd.array(winner, "Int64"))

    schema = cut.withColumns({"survivor": F.lit(True), "duplicate_of": F.lit(None).cast("long")}).schema
    return cut.repartition(*own).sortWithinPartitions(*own, "_peak_time", "track_id").mapInPandas(scan, schema).drop("_group", *shown)


def marked(tracks: DataFrame, lane: tuple[str, ...], peak_window: float = 1.0, track_gap: float = 0.25) -> DataFrame:
    """All tracks with candidate_raw (candidate as it was), duplicate_of, and candidate, which duplicates lose.

    Only candidates are compared. Done again it starts from what is a candidate by then, and sets duplicate_of anew.
    """
    tracks = tracks.drop("candidate_raw", "duplicate_of")
    compared = deduplicate(tracks.where("candidate"), lane, peak_window, track_gap)
    compared = compared.withColumns({"candidate_raw": F.lit(True), "candidate": F.col("survivor")}).drop("survivor")
    others = tracks.where(~F.coalesce(F.col("candidate"), F.lit(False)))
    return compared.unionByName(others.withColumns({"candidate_raw": F.lit(False), "candidate": F.lit(False), "duplicate_of": F.lit(None).cast("long")}))


def clip_window(df: DataFrame, before: float = 3.0, after: float = 4.0, length: str = "media_seconds") -> DataFrame:
    """clip_start and clip_end around the peak, within the medium."""
    return df.withColumns({"clip_start": F.greatest(F.lit(0.0), F.col("peak_time") - before), "clip_end": F.least(F.col(length), F.col("peak_time") + after)})

