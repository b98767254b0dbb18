"""Workers that fall silent, told by timers: also one that starts and never beats, and one that comes back.

Each worker has one row of state and one timer, at the time when its silence would be too long. A row moves the
timer; when the watermark passes a timer the worker is reported, and its next row clears it. Rows of a worker are
taken in the order of their times within a micro-batch; a row older than the state counts, but moves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REPORT = "worker {kind}, report string, at timestamp, last_seen timestamp, beats long"


class Watchdog(StatefulProcessor):
    """Reports silent (was heard of, then not for longer than the timeout), no_heartbeat (started, never beat) and back."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # times in microseconds, as timers alone are in milliseconds
        self.state = handle.getValueState("worker", "last_us long, beats long, reported boolean, timer_ms long")

    def _report(self, key, kind: str, at_us: int, last_us: int, beats: int) -> list:
        return [key[0], kind, pd.Timestamp(at_us, unit="us"), pd.Timestamp(last_us, unit="us"), beats]

    def _kind(self, beats: int) -> str:
        return "silent" if beats else "no_heartbeat"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["at_us", "is_beat"])
        held = self.state.get()
        last, beats, reported, timer = held if held is not None else (None, 0, False, None)
        out, limit = [], self.timeout_ms * 1000
        for at, is_beat in zip(new["at_us"].tolist(), new["is_beat"].tolist(), strict=True):
            if last is not None and at > last:
                if not reported and at - last > limit:
                    out.append(self._report(key, self._kind(beats), last + limit, last, beats))
                    reported = True
                if reported:
                    out.append(self._report(key, "back", at, last, beats))
                    reported = False
            last = at if last is None else max(at, last)
            beats += int(is_beat)
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = None
        if not reported:
            timer = -(-(last + limit) // 1000)  # the first millisecond not before it
            self.handle.registerTimer(timer)
        self.state.update((last, beats, reported, timer))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, beats, reported, timer = self.state.get()
        if timer == expiredTimerInfo.getExpiryTimeInMs() and not reported:
            self.state.update((last, beats, True, None))
            yield self._frame([self._report(key, self._kind(beats), last + self.timeout_ms * 1000, last, beats)])

    @staticmethod
    def _frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["worker", "report", "at", "last_seen", "beats"])

    def close(self) -> None:
        pass


def watched(stream: DataFrame, key: str, time_col: str, is_beat: str, timeout_s: float, delay: str) -> DataFrame:
    """worker, report, at, last_seen, beats from a stream of starts and beats (is_beat: a boolean column)."""
    rows = stream.withWatermark(time_col, delay).select(F.col(key).alias("worker"), F.col(time_col).alias("at"), F.unix_micros(time_col).alias("at_us"), F.col(is_beat).alias("is_beat"))
    kind = stream.schema[key].dataType.simpleString()
    # UpdateMode: a report is a new row each time
    return rows.groupBy("worker").transformWithStateInPandas(Watchdog(round(timeout_s * 1000)), REPORT.format(kind=kind), "Update", "EventTime")


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Timers need the state store that keeps its rows outside the heap; streams that start in here use it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)
