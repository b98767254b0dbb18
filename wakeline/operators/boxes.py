"""Box geometry: overlaps, suppression of lower-scored overlapping boxes, anchor grids, score decoding."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.operators.groups import whole_groups

SIDES = ("left", "top", "right", "bottom")


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes given by column prefixes."""
    l, t, r, m = ((F.col(f"{a}{s}"), F.col(f"{b}{s}")) for s in SIDES)
    zero = F.lit(0.0)
    inter = F.greatest(zero, F.least(*r) - F.greatest(*l)) * F.greatest(zero, F.least(*m) - F.greatest(*t))
    area = lambda k: F.greatest(zero, r[k] - l[k]) * F.greatest(zero, m[k] - t[k])
    return inter / F.greatest(area(0) + area(1) - inter, F.lit(1e-9))


def to_unit(box: tuple[Column, Column, Column, Column], width: Column, height: Column) -> tuple[Column, ...]:
    """Left, top, right and bottom in pixels of a picture as shares of its sides."""
    return tuple(v / side for v, side in zip(box, (width, height) * 2, strict=True))


def suppress(left, top, right, bottom, order, threshold: float) -> np.ndarray:
    """Mask of the boxes that stay when, in this order, each removes later ones that overlap it more than the threshold."""
    keep = np.zeros(len(order), bool)
    area = np.maximum(0, right - left) * np.maximum(0, bottom - top)
    while len(order):
        k, rest = order[0], order[1:]
        keep[k] = True
        w = np.minimum(right[k], right[rest]) - np.maximum(left[k], left[rest])
        h = np.minimum(bottom[k], bottom[rest]) - np.maximum(top[k], top[rest])
        inter = np.maximum(0, w) * np.maximum(0, h)
        order = rest[inter / np.maximum(area[k] + area[rest] - inter, 1e-9) <= threshold]
    return keep


def nms(boxes: DataFrame, threshold: float = 0.45, keys: tuple[str, ...] = ("source", "frame", "class_id")) -> DataFrame:
    """The boxes of each source's frame and class that stay; a group is one frame's boxes, which a camera bounds."""

    def run(batches):
        for g, at in whole_groups(batches, list(keys)):
            keep = np.ones(len(g), bool)
            cols = [g[s].to_numpy() for s in SIDES]
            for k in np.flatnonzero(np.diff(at) > 1):
                own = slice(at[k], at[k + 1])
                keep[own] = suppress(*(c[own] for c in cols), np.arange(at[k + 1] - at[k]), threshold)
            yield g[keep]

    rows = boxes.repartition(*keys).sortWithinPartitions(*keys, F.desc("score"), "box_id")
    return rows.mapInPandas(run, boxes.schema)


def anchor_grid(spark: SparkSession, size: int = 640, strides: tuple[int, ...] = (8, 16, 32)) -> DataFrame:
    """stride, x, y: cell centres of each grid, in cells."""
    grids = spark.createDataFrame([(s, size // s) for s in strides], "stride int, n int")
    cells = lambda name: F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias(name)
    return grids.select("stride", "n", cells("i")).select("stride", "i", cells("j")).select("stride", (F.col("j") + 0.5).alias("x"), (F.col("i") + 0.5).alias("y"))


def expectation(logits: Column, bins: int, side: int) -> Column:
    """Mean bin of the softmax over one side's logits."""
    own = F.slice(logits, side * bins + 1, bins)
    top = F.array_max(own)
    e = F.transform(own, lambda v: F.exp(v - top))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    return total(F.transform(e, lambda v, k: v * k)) / total(e)


def decoded(df: DataFrame, logits: Column, bins: int, stride: int | Column, x: Column, y: Column) -> DataFrame:
    """df with the box (x1, y1, x2, y2): the anchor less or plus the expected distance of each side, in pixels."""
    l, t, r, b = (expectation(logits, bins, k) for k in range(4))
    return df.withColumns({"x1": (x - l) * stride, "y1": (y - t) * stride, "x2": (x + r) * stride, "y2": (y + b) * stride})


def letterbox(width: int, height: int, size: int = 640) -> tuple[float, float, float]:
    """Scale and left and top padding of a picture in a square."""
    if min(width, height, size) < 1:
        raise ValueError("sizes are positive")
    scale = min(size / width, size / height)
    return scale, (size - round(width * scale)) // 2, (size - round(height * scale)) // 2


def unpadded(df: DataFrame, scale: float, left: float, top: float, width: float, height: float) -> DataFrame:
    """Boxes in the pixels of the picture before it was scaled and padded, held within it; empty ones go."""
    back = lambda c, pad, most: F.greatest(F.lit(0.0), F.least(F.lit(most), (F.col(c) - pad) / scale))
    df = df.withColumns({"x1": back("x1", left, width), "y1": back("y1", top, height), "x2": back("x2", left, width), "y2": back("y2", top, height)})
    return df.where("x2 > x1 and y2 > y1")


def letterboxed(data: Column, width: int, height: int, size: int = 640, channels: int = 3, fill: int = 114) -> Column:
    """The bytes of a frame in the middle of a square of `fill`; the frame must have the square's width or height already."""
    scale, left, top = letterbox(width, height, size)
    if (round(width * scale), round(height * scale)) != (width, height):
        raise ValueError(f"the frame must be {round(width * scale)} x {round(height * scale)}, not {width} x {height}")

    @F.pandas_udf("binary")
    def padded(frames: pd.Series) -> pd.Series:
        out = []
        for f in frames:
            if f is not None and len(f) != width * height * channels:
                raise ValueError(f"a frame has {len(f)} bytes, expected {width * height * channels}")
            square = np.full((size, size, channels), fill, np.uint8)
            if f is not None:
                square[top : top + height, left : left + width] = np.frombuffer(f, np.uint8).reshape(height, width, channels)
            out.append(None if f is None else square.tobytes())
        return pd.Series(out)

    return padded(data)


def detections(
    maps: DataFrame, keys: list[str], frame: tuple[float, float], scale: float, left: float, top: float, size: int = 640, bins: int = 16, classes: int = 80,
    kept: dict[int, str] | None = None, confidence: float = 0.20, overlap: float = 0.45,
) -> DataFrame:
    """What the detector's output maps say: keys, class_id, class_name, confidence, x1, y1, x2, y2, their shares of the frame (u1, v1, u2, v2), place.

    maps: keys, stride, features: a flat map of (size / stride) squared cells, row by row, each of 4 * bins box logits and
    `classes` class logits. Cells below the confidence or of other classes than `kept` (number to name) go before a box
    is made; of a class's boxes that overlap more than allowed the best stays (of equal scores the one of the smaller
    stride, then the earlier cell); boxes go back to the frame's pixels (width, height), and those left empty go. place
    counts a frame's detections from 1, by confidence.
    """
    kept = kept or {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
    width = 4 * bins + classes
    side = (F.lit(size) / F.col("stride")).cast("int")
    logits = lambda i: F.slice("features", i * width + 4 * bins + 1, classes)
    # a sigmoid grows with its logit
    least = -math.log(1 / confidence - 1)
    good = F.filter(F.sequence(F.lit(0), side * side - 1), lambda i: F.array_max(logits(i)) >= least - 1e-6)
    whole = F.when(F.size("features") == side * side * width, F.lit(True)).otherwise(F.raise_error(F.lit("an output map has another size")).cast("boolean"))
    cells = maps.where(whole).select(*keys, "stride", side.alias("_side"), "features", F.explode(good).alias("_cell"))
    cells = cells.select(*keys, "stride", "_side", "_cell", F.transform(F.slice("features", F.col("_cell") * width + 1, width), lambda x: x.cast("double")).alias("_v"))
    score, best = class_score(F.slice("_v", 4 * bins + 1, classes))
    cells = cells.withColumns({"score": score, "class_id": best}).where((F.col("score") >= confidence) & F.col("class_id").isin(*kept))
    x, y = F.col("_cell") % F.col("_side") + 0.5, F.floor(F.col("_cell") / F.col("_side")) + 0.5
    b = decoded(cells, F.col("_v"), bins, F.col("stride"), x, y)
    b = b.select(*keys, "class_id", "score", (F.col("stride").cast("long") * (1 << 32) + F.col("_cell")).alias("box_id"), *(F.col(a).alias(c) for a, c in zip(("x1", "y1", "x2", "y2"), SIDES, strict=True)))
    b = nms(b, overlap, (*keys, "class_id"))
    b = unpadded(b.select(*keys, "class_id", "score", "box_id", *(F.col(c).alias(a) for a, c in zip(("x1", "y1", "x2", "y2"), SIDES, strict=True))), scale, left, top, float(frame[0]), float(frame[1]))
    name = F.element_at(F.create_map(*(F.lit(v) for kv in kept.items() for v in kv)), F.col("class_id"))
    unit = to_unit(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.lit(float(frame[0])), F.lit(float(frame[1])))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "class_id", "box_id"))
    b = b.select(*keys, "class_id", name.alias("class_name"), F.round("score", 5).alias("confidence"), *(F.round(c, 2).alias(c) for c in ("x1", "y1", "x2", "y2")), *(F.round(u, 5).alias(c) for u, c in zip(unit, ("u1", "v1", "u2", "v2"), strict=True)), place.cast("long").alias("place"))
    return b


def class_score(logits: Column) -> tuple[Column, Column]:
    """The largest sigmoid of the class logits (held within 30) and the first class that has it."""
    best = F.array_max(logits)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), best)))), F.array_position(logits, best).cast("int") - 1
