"""Structured Streaming forms: gap sessions, timeouts, matches of two lanes, keys that are ready in both, and replay of a table.

A replay streams a table that is in the shared folder, ends when all of it is read, and returns what the
sink holds. State is kept by key in Spark's state store and leaves it when the watermark passes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import new_folder


def gap_sessions(stream: DataFrame, key: str, time_col: str, gap: str, delay: str, aggregates: list[Column]) -> DataFrame:
    """A row for each session of a key once the watermark is past it; rows exactly a gap apart are one session."""
    span = F.session_window(time_col, gap).alias("span")
    return stream.withWatermark(time_col, delay).groupBy(key, span).agg(*aggregates)


def interval_matches(rear: DataFrame, front: DataFrame, reach: str, delay: str) -> DataFrame:
    """Pairs of (key, rear_id) and (key, front_id) at most reach apart; t of each side bounds the state."""
    r = rear.select(F.col("key").alias("rkey"), "rear_id", F.col("t").alias("rt")).withWatermark("rt", delay)
    f = front.select("key", "front_id", F.col("t").alias("ft")).withWatermark("ft", delay)
    near = F.expr(f"ft >= rt - interval {reach} and ft <= rt + interval {reach}")
    return r.join(f, (F.col("rkey") == F.col("key")) & near).select("key", "rear_id", "front_id")


def timeouts(stream: DataFrame, key: str, time_col: str, timeout: str, delay: str) -> DataFrame:
    """key, beats, last_seen, stale_at: a row for each time a key has been silent for longer than timeout.

    It is given when the watermark passes, whether or not the key is heard of again; state is one row for each live key.
    """
    found = [F.count("*").alias("beats"), F.max(time_col).alias("last_seen")]
    return gap_sessions(stream, key, time_col, timeout, delay, found).select(key, "beats", "last_seen", F.col("span.end").alias("stale_at"))


def both_ready(rear: DataFrame, front: DataFrame, keys: list[str], day: str, delay: str) -> DataFrame:
    """keys and day, once, as soon as both streams have a row for them. Rows come already filtered to valid ones.

    day is a timestamp with a watermark: a day's state goes when the watermark is past it.
    """
    once = lambda s: s.select(*keys, day).withWatermark(day, delay).dropDuplicates([*keys, day])
    return once(rear).join(once(front), [*keys, day])


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of work whose keys have no result yet: what a restart has left to do."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def staged(df: DataFrame) -> DataFrame:
    """A stream of df's rows, from a table written for it."""
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def with_last_row(df: DataFrame, time_col: str, wait: str) -> DataFrame:
    """df and one row, null but for a time that much later than all: it moves the watermark past every session.

    For a replay that reads the table as one batch; the row makes no session that ends.
    """
    end = df.agg((F.max(time_col) + F.expr(f"interval {wait}")).alias(time_col))
    return df.unionByName(end, allowMissingColumns=True)


def replay(spark: SparkSession, stream: DataFrame, place: str | None = None) -> DataFrame:
    """What the stream has given when all that is there now is read.

    place is the folder of the results and of the stream's checkpoint. A later call with the same place and source
    takes up where this one ended: only new files are read, and results stand beside those from before.
    """
    place = place or new_folder(spark)
    out, log = f"{place}/rows", f"{place}/checkpoint"
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", log).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def in_slices(df: DataFrame, time_col: str, slices: int, run: Callable[[DataFrame], DataFrame], each: Callable[[DataFrame, int], None] | None = None, mode: str = "update", csv: bool = False, log: str | None = None) -> DataFrame | None:
    """Feed df to a stream in slices of time, one after another; the stream stops after each and goes on from its checkpoint.

    run makes the stream's result of its source. Each batch is written under its number, so that one that is given
    again replaces itself; or it goes to each(batch, number), and there is no result. The source is Parquet or CSV.
    log is the checkpoint's folder.
    """
    spark = df.sparkSession
    source, log, out = new_folder(spark), log or new_folder(spark), new_folder(spark)
    shares = [(k + 1) / slices for k in range(slices - 1)]
    bounds = df.agg(F.percentile_approx(F.unix_micros(time_col), shares).alias("at")).first()["at"] if shares else []
    at = F.unix_micros(time_col)
    kind, read = ("csv", spark.readStream.schema(df.schema).option("header", True)) if csv else ("parquet", spark.readStream.schema(df.schema))
    for low, high in zip([None, *(bounds or [])], [*(bounds or []), None], strict=True):
        own = df if low is None else df.where(at > low)
        (own if high is None else own.where(at <= high)).write.mode("append").format(kind).option("header", csv).save(source)
        result = run(read.format(kind).load(source))
        write = each or (lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/batch={k}"))
        result.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    return None if each else spark.read.schema(result.schema).option("recursiveFileLookup", True).parquet(out)


def progress(query) -> list[tuple[int, int]]:
    """(batch, rows read so far) of a streaming query's batches."""
    done, out = 0, []
    for p in query.recentProgress:
        done += p["numInputRows"]
        out.append((p["batchId"], done))
    return out
