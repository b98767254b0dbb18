"""Cross-correlation of long series over many lags, as a sum of block convolutions.

The front series is cut into blocks; a block meets the part of the rear series that any lag can bring to it. Both
go through one FFT, and as all blocks have one length their spectra add up: a task keeps one spectrum for each key
and gives one value for each lag, so what is shuffled after the blocks depends on tasks and lags alone. No task
holds a series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.groups import whole_groups

LEAST_FFT = 1 << 14


def cross_correlation(front: DataFrame, rear: DataFrame, most: int, lengths: DataFrame | None = None, key: str = "key", fft: int | None = None) -> DataFrame:
    """key, lag, total, overlap, score for all lags from -most to most: rear place = front place + lag.

    front, rear: key, idx (from 0), x; places without a row are zero. total is the sum of products, overlap the
    number of places where both series are, at least 1, score their ratio. lengths (key, front_n, rear_n) are the
    last place plus one unless given. Keys without both series give no rows.
    """
    if most < 0:
        raise ValueError("the largest lag cannot be negative")
    size = fft or max(LEAST_FFT, 1 << (4 * most + 1).bit_length())
    block = size - 2 * most  # front places of one FFT; the rear part has size places
    if block < 1:
        raise ValueError("an FFT must be longer than the lags")
    if lengths is None:
        n = lambda df, c: df.groupBy(key).agg((F.max("idx") + 1).alias(c))
        lengths = n(front, "front_n").join(n(rear, "rear_n"), key)
    at = F.floor(F.col("idx") / block)
    f = front.select(key, at.alias("block"), F.lit(0).alias("side"), (F.col("idx") - at * block).alias("place"), F.col("x").cast("double").alias("x"))
    reach = F.explode(F.sequence(F.floor((F.col("idx") - most) / block), F.floor((F.col("idx") + most) / block))).alias("block")
    r = rear.select(key, "idx", F.col("x").cast("double").alias("x"), reach)
    r = r.select(key, "block", F.lit(1).alias("side"), (F.col("idx") - F.col("block") * block + most).alias("place"), "x")
    rows = f.unionByName(r).repartition(key, "block").sortWithinPartitions(key, "block")
    lags = np.arange(-most, most + 1)

    def run(batches):
        name, spectrum = None, None
        for g, ends in whole_groups(batches, [key, "block"]):
            names, side, place, x = (g[c].to_numpy() for c in (key, "side", "place", "x"))
            for i, j in zip(ends[:-1], ends[1:], strict=True):
                own = side[i:j] == 0
                if own.all() or not own.any():
                    continue
                if spectrum is None or names[i] != name:
                    if spectrum is not None:
                        yield pd.DataFrame({key: name, "lag": lags, "part": np.fft.irfft(spectrum, size)[: 2 * most + 1]})
                    name, spectrum = names[i], 0
                both = np.zeros((2, size))
                np.add.at(both, (side[i:j], place[i:j]), x[i:j])
                a, b = np.fft.rfft(both)
                spectrum = spectrum + b * np.conj(a)
        if spectrum is not None:
            yield pd.DataFrame({key: name, "lag": lags, "part": np.fft.irfft(spectrum, size)[: 2 * most + 1]})

    kind = front.schema[key].dataType.simpleString()
    parts = rows.mapInPandas(run, f"`{key}` {kind}, lag long, part double").groupBy(key, "lag").agg(F.sum("part").alias("total"))
    every = lengths.select(key, "front_n", "rear_n", F.explode(F.sequence(F.lit(-most).cast("long"), F.lit(most).cast("long"))).alias("lag"))
    lag, zero = F.col("lag"), F.lit(0)
    overlap = F.greatest(F.lit(1), F.least("front_n", F.col("rear_n") - F.greatest(lag, zero), F.col("front_n") + F.least(lag, zero)))
    done = every.join(parts, [key, "lag"], "left")
    total = F.coalesce("total", F.lit(0.0))
    return done.select(key, "lag", total.alias("total"), overlap.cast("long").alias("overlap"), (total / overlap).alias("score"))


def best_offset(scores: DataFrame, rate: float, apart: float = 10.0, absolute: bool = False, key: str = "key") -> DataFrame:
    """key, offset_seconds, score, polarity, score_ratio of each key's best lag (of equal ones the least).

    score_ratio is against the best lag further than `apart` seconds from it, null where that is not positive.
    absolute: a reversed signal counts as much as an upright one; polarity tells which it is.
    """
    worth = F.abs("score") if absolute else F.col("score")
    s = scores.select(key, "lag", "score", worth.alias("worth"))
    best = s.groupBy(key).agg(F.max_by(F.struct("lag", "score", "worth"), F.struct("worth", -F.col("lag"))).alias("best"))
    far = s.join(best, key).where(F.abs(F.col("lag") - F.col("best.lag")) > apart * rate)
    second = far.groupBy(key).agg(F.max("worth").alias("second"))
    ratio = F.when(F.col("second") > 0, F.round(F.col("best.worth") / F.col("second"), 3))
    return best.join(second, key, "left").select(
        key, F.round(F.col("best.lag") / rate, 3).alias("offset_seconds"), F.col("best.worth").alias("score"), F.when(F.col("best.score") >= 0, 1).otherwise(-1).alias("polarity"), ratio.alias("score_ratio")
    )
