"""Tracks of a frame stream: one session of state for each source, closed at frames, and what is still open at the end.

The rule is that of tracks.sessionize with a frame: a row joins the open session if the frame before its own is within
the gap of the last row. A timer closes a session once the watermark is past the time when no row can join it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_STATE = "session long, n long, first_obs long, last_obs long, last double, timer_ms long"
_OUT = ["source", "session", "n", "first_obs", "last_obs"]


class FrameSessions(StatefulProcessor):
    def __init__(self, gap: float, frame: float, unit_ms: float):
        self.gap, self.frame, self.unit_ms = gap, frame, unit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["at", "obs_id"])
        session, n, first, last_obs, last, timer = self.state.get() or (0, 0, None, None, None, None)
        out = []
        for at, obs in zip(new["at"].tolist(), new["obs_id"].tolist(), strict=True):
            if n and at - self.frame - last > self.gap:
                out.append([key[0], session, n, first, last_obs])
                session, n = session + 1, 0
            first = obs if not n else min(first, obs)
            last_obs = obs if not n else max(last_obs, obs)
            last = at if not n else max(last, at)
            n += 1
        if timer is not None:
            self.handle.deleteTimer(timer)
        # a whole millisecond later than the last moment at which a row can join
        timer = math.floor((last + self.gap + self.frame) * self.unit_ms) + 2
        self.handle.registerTimer(timer)
        self.state.update((session, n, first, last_obs, last, timer))
        if out:
            yield pd.DataFrame(out, columns=_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        session, n, first, last_obs, last, timer = self.state.get()
        if n and timer == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((session + 1, 0, None, None, None, None))
            yield pd.DataFrame([[key[0], session, n, first, last_obs]], columns=_OUT)

    def close(self) -> None:
        pass


def frame_sessions(stream: DataFrame, key: str, time_col: str, at: str, obs: str, gap: float, frame: float, unit_ms: float, delay: str) -> DataFrame:
    """source, session, n, first_obs, last_obs of each session as it closes.

    time_col is the event time; at is the same moment as a number of units of unit_ms milliseconds since 1970, in which gap
    and frame are given. Needs watchdog.timers().
    """
    rows = stream.withWatermark(time_col, delay).select(F.col(key).alias("source"), time_col, F.col(at).alias("at"), F.col(obs).alias("obs_id"))
    kind = stream.schema[key].dataType.simpleString()
    return rows.groupBy("source").transformWithStateInPandas(FrameSessions(gap, frame, unit_ms), f"source {kind}, session long, n long, first_obs long, last_obs long", "Append", "EventTime")


def still_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions that a stream which has ended holds open in its state, with the columns of the closed ones."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.where("value.n > 0").select("key.source", "value.session", "value.n", "value.first_obs", "value.last_obs")
