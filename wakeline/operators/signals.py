"""Regular time series: detrending, differences, correlation over lags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.ranges import neighbours, numbered


BLOCK = 1 << 16  # places of a series that a task holds together


def detrend(df: DataFrame, width: int, key: str = "key", block: int = BLOCK) -> DataFrame:
    """df (key, idx, x) with detrended: x less the centred sum over width places divided by width, also at the edges.

    Places without a row count as zero. A series is cut by index, with the rows at each edge in both blocks.
    """
    before, after = width // 2, width - 1 - width // 2
    w = Window.partitionBy(key, "_block").orderBy("idx").rangeBetween(-before, after)
    rows = neighbours(df, before, after, max(block, width)).withColumn("detrended", F.col("x") - F.sum("x").over(w) / width)
    return rows.where(F.col("_block") == F.floor(F.col("idx") / max(block, width))).drop("_block")


def first_difference(df: DataFrame, key: str = "key", block: int = BLOCK) -> DataFrame:
    """df with diff: x less that of the place before; rows whose place before has no row go."""
    w = Window.partitionBy(key, "_block").orderBy("idx").rangeBetween(-1, -1)
    rows = neighbours(df, 1, 0, block).withColumn("diff", F.col("x") - F.first("x").over(w))
    return rows.where((F.col("_block") == F.floor(F.col("idx") / block)) & F.col("diff").isNotNull()).drop("_block")


def xcorr(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """lag, score: mean product of a(idx + lag) and b(idx) over the places where both exist, by an equi-join on shifted places."""
    shifted = b.select(F.col("x").alias("y"), F.col("idx").alias("at"), F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("lag")).withColumn("idx", F.col("at") + F.col("lag"))
    return a.join(shifted, "idx").groupBy("lag").agg((F.sum(F.col("x") * F.col("y")) / F.count("*")).alias("score"))


def indexed(df: DataFrame, order: list[str], key: str = "key") -> DataFrame:
    """df with idx, the place of each row of a key in the order, from 0 on."""
    return numbered(df, [key], order)


def normalised(df: DataFrame, width: int, key: str = "key", strict: bool = False) -> DataFrame:
    """key, idx, envelope: x (key, idx, x) detrended, in standard deviations.

    A signal that hardly varies has null values, or, if strict, is an error when the rows are read.
    """
    d = detrend(df, width, key)
    spread = d.groupBy(key).agg(F.stddev_pop("detrended").alias("sd"))
    flat = F.raise_error(F.concat(F.lit("no useful variation in "), F.col(key).cast("string"))).cast("double") if strict else F.lit(None)
    return d.join(spread, key).select(key, "idx", F.when(F.col("sd") > 1e-6, F.col("detrended") / F.col("sd")).otherwise(flat).alias("envelope"))


def envelope(df: DataFrame, block: int, width: int, key: str = "key", strict: bool = False) -> DataFrame:
    """key, idx, envelope: log of the root mean square of each block of samples, normalised()."""
    power = F.log1p(F.sqrt(F.avg(F.col("x") * F.col("x")) + 1)).alias("x")
    return normalised(df.groupBy(key, F.floor(F.col("idx") / block).alias("idx")).agg(power), width, key, strict)


def best_lag(scores: DataFrame, apart: int, absolute: bool = False) -> DataFrame:
    """lag, score, second (the best outside apart places of it), score_ratio, polarity, from lag and score.

    There is one row for each lag, a bounded number.
    """
    ranked = F.abs("score") if absolute else F.col("score")
    s = scores.withColumn("r", ranked)
    best = s.agg(F.max_by(F.struct("lag", "score", "r"), F.struct("r", -F.col("lag"))).alias("b")).select("b.*")
    other = s.crossJoin(F.broadcast(best.select(F.col("lag").alias("at")))).where(F.abs(F.col("lag") - F.col("at")) > apart).agg(F.max("r").alias("second"))
    ratio = F.when(F.col("second") > 0, F.round(F.col("r") / F.col("second"), 3))
    return best.crossJoin(F.broadcast(other)).select("lag", F.col("r").alias("score"), "second", ratio.alias("score_ratio"), F.when(F.col("score") >= 0, 1).otherwise(-1).alias("polarity"))
