"""Telemetry that is still being written, as a stream, cut to the runs it belongs to.

A feed is a folder to which files of samples are added; Spark doesn't follow a file that grows, so a writer closes a
file for each stretch. Runs are a static table with a start and an end, both included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

READY = 2  # samples that show that a feed works

#: Blocks of time are 1, BASE, BASE squared ... seconds long, at so many levels.
BASE, LEVELS = 8, 6


def samples(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stream of the samples (CSV with a header) in a feed's folder."""
    return spark.readStream.schema(schema).option("header", True).csv(path)


def in_runs(stream: DataFrame, runs: DataFrame, time_col: str, bucket: int) -> DataFrame:
    """Samples with the columns of each run (start and end in the samples' time) that they fall into.

    Runs are laid out in buckets of time that both sides share, so the join is on equal buckets; a bucket should be
    about as long as a run. No state is kept. The rows are as many as samples in runs: where many runs share their time,
    statistics of them come from by_second() and statistics() without these rows.
    """
    low, high = F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket)
    laid = runs.where("end >= start").withColumn("_bucket", F.explode(F.sequence(low, high)))
    s = stream.withColumn("_bucket", F.floor(F.col(time_col) / bucket))
    return s.join(laid, "_bucket").where(F.col(time_col).between(F.col("start"), F.col("end"))).drop("_bucket")


def readiness(stream: DataFrame, feed: str, least: int = READY) -> DataFrame:
    """feed, samples, ready of each feed (update mode): one is ready once it has given so many samples."""
    return stream.groupBy(feed).agg(F.count("*").alias("samples")).withColumn("ready", F.col("samples") >= least)


def by_second(batch: DataFrame, second: str, value: str) -> DataFrame:
    """second, n, valued, total, least, most of a batch's samples; second is a whole number."""
    v = F.col(value)
    stats = [F.count("*").alias("n"), F.count(v).alias("valued"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("most")]
    return batch.where(F.col(second).isNotNull()).groupBy(F.col(second).cast("long").alias("second")).agg(*stats)


def _blocks(start: Column, end: Column) -> Column:
    """The fewest blocks (level, block) that together are the seconds from start to end, both included."""
    spans, down = [], lambda x, w: F.floor(x / w)
    for k in range(LEVELS):
        w = BASE**k
        first, last = -down(-start, w), down(end + 1, w)  # without last
        if k + 1 == LEVELS:
            spans.append((k, first, last))
            break
        # what larger blocks leave at both ends
        a, b = -down(-start, w * BASE) * BASE, down(end + 1, w * BASE) * BASE
        spans += [(k, first, F.when(a < b, a).otherwise(last)), (k, F.when(a < b, b).otherwise(last), last)]
    blocks = lambda k, i, j: F.transform(F.sequence(i, j - 1), lambda x: F.struct(F.lit(k).alias("level"), x.alias("block")))
    each = [F.when(i < j, blocks(k, i, j)) for k, i, j in spans]
    return F.flatten(F.filter(F.array(*each), lambda x: x.isNotNull()))


def statistics(seconds: DataFrame, runs: DataFrame, run: str) -> DataFrame:
    """run, samples, mean, least, most of the samples in each run (run, start, end); runs without samples have no row.

    seconds are rows of by_second(), of any number of batches. Their sums over blocks of time meet the few blocks that a
    run is made of, so the work goes with seconds and runs, not with the samples in each run.
    """
    merged = [F.sum("n").alias("n"), F.sum("valued").alias("valued"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")]
    levels = F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("second") / BASE**k).alias("block")) for k in range(LEVELS)))
    once = seconds.groupBy("second").agg(*merged)
    sums = once.select(F.explode(levels).alias("c"), *once.columns[1:]).groupBy("c.level", "c.block").agg(*merged)
    laid = runs.where("end >= start").select(run, F.explode(_blocks(F.col("start"), F.col("end"))).alias("c")).select(run, "c.level", "c.block")
    # both sides have many more rows than Spark takes them for
    found = laid.join(sums.hint("merge"), ["level", "block"]).groupBy(run).agg(*merged)
    return found.select(run, F.col("n").alias("samples"), (F.col("total") / F.col("valued")).alias("mean"), "least", "most")
