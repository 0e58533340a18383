"""Sustained alerts on streams: conditions that must hold for a while, silence included.

The state of a key is a few numbers and what the watermark hasn't passed yet: runs of events, or steps. Event-time timers wake a key up, so an alert fires although
nothing arrives for it; what fires is settled, because no event before the watermark comes any more.
Both operators need the RocksDB state store: start their queries inside `timers`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewatch.streaming.queries import event_time, micros

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timers(spark: SparkSession) -> Iterator[SparkSession]:
    """State with timers exists for this state store only; queries started inside use it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        yield spark
    finally:
        spark.conf.set(name, before)


class _Timed(StatefulProcessor):
    """Settles what the watermark has passed, on new rows and on timers, and sets the next timer."""

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.STATE)

    def _wake(self, times: list[float]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if times:
            self.handle.registerTimer(math.floor(min(times) * 1000) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs() / 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, None, timerValues.getCurrentWatermarkInMs() / 1000)

    def _frame(self, key, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame([(key[0], *row) for row in out], columns=self.columns)


class _Silence(_Timed):
    """Events that the watermark hasn't passed are kept as runs without silence: first and last time.

    Inside a run nothing can fire, so its other events need no place in the state.
    """

    STATE = "last double, fired boolean, first array<double>, until array<double>"

    def __init__(self, limit: float, columns: list[str]):
        self.limit, self.columns = limit, columns

    def _runs(self, first: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs that no silence separates as one, in order of time."""
        order = np.argsort(first, kind="stable")
        first, until = first[order], np.maximum.accumulate(until[order])
        cut = np.flatnonzero(first[1:] - until[:-1] > self.limit)
        return first[np.r_[0, cut + 1]], until[np.r_[cut, len(until) - 1]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = None
        for pdf in rows:  # a part of the rows at a time
            times = pdf["ts"].to_numpy(dtype=float)
            if len(times):
                part = self._runs(times, times)
                new = part if new is None else self._runs(
                    *(np.concatenate(pair) for pair in zip(new, part, strict=True)))
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs() / 1000)

    def _advance(self, key, new, settled: float) -> Iterator[pd.DataFrame]:
        last, fired, first, until = self.kept.get() if self.kept.exists() else (None, False, [], [])
        first, until = np.array(list(first), dtype=float), np.array(list(until), dtype=float)
        if new is not None:
            first, until = np.concatenate([first, new[0]]), np.concatenate([until, new[1]])
            first, until = self._runs(first, until)
        out, gone = [], 0
        while gone < len(first) and first[gone] <= settled:
            at, end = float(first[gone]), float(until[gone])
            if last is not None and at - last > self.limit:
                if not fired:
                    out.append((last, last + self.limit, None))
                out.append((last, last + self.limit, at))
            if end > settled:
                # the run goes on; its part before the watermark ends here at the earliest
                if last is None or settled > last:
                    last, fired = max(at, settled), False
                first[gone] = max(at, settled)
                break
            if last is None or end > last:
                last, fired = end, False
            gone += 1
        first, until = first[gone:].tolist(), until[gone:].tolist()
        if last is not None and not fired and settled > last + self.limit:
            out.append((last, last + self.limit, None))
            fired = True
        self.kept.update((last, fired, first, until))
        begun = bool(first) and first[0] <= settled
        self._wake([until[0]] if begun else [*first[:1], *([last + self.limit] if last is not None and not fired else [])])
        yield from self._frame(key, out)


def silence_stream(stream: DataFrame, key: str, gap: float = 60, hold: float = 60,
                   delay: float = 5, ts: str = "ts") -> DataFrame:
    """(key, silent_from, fired_at, silent_until): an alert when it fires, `silent_until` being null,
    and again when the next event ends it.

    A key that has sent nothing for more than `gap + hold` seconds fires as soon as the others' events
    take the watermark, `delay` seconds behind the newest, past that point.
    """
    rows = stream.where(F.col(ts).isNotNull()).select(key, F.col(ts).cast("double").alias("ts")
                                                      ).withColumn("at", event_time("ts"))
    columns = [key, "silent_from", "fired_at", "silent_until"]
    out = T.StructType([rows.schema[key], *[T.StructField(c, T.DoubleType()) for c in columns[1:]]])
    return rows.withWatermark("at", micros(delay)).groupBy(key).transformWithStateInPandas(
        _Silence(gap + hold, columns), out, "append", "EventTime")


class _Sustained(_Timed):
    STATE = "start double, last double, peak double, fired boolean, waiting array<array<double>>"

    def __init__(self, step: float, hold: float, limit: float, columns: list[str]):
        self.step, self.hold, self.limit, self.columns = step, hold, limit, columns

    def _advance(self, key, new, settled: float) -> Iterator[pd.DataFrame]:
        start, last, peak, fired, waiting = self.kept.get() if self.kept.exists() else (
            None, None, None, False, [])
        waiting, out = [list(w) for w in waiting], []
        if new is not None:
            waiting = sorted([*waiting, *new[["s", "share"]].to_numpy(dtype=float).tolist()])

        def close():
            if start is not None and fired:
                out.append((start, start + self.hold, last, peak))

        ready = sum(w[0] <= settled for w in waiting)
        waiting, passed = waiting[ready:], waiting[:ready]
        for at, share in passed:
            if start is not None and (share <= self.limit or at > last + self.step):
                close()
                start, fired = None, False
            if share > self.limit:
                start, peak = (at, share) if start is None else (start, max(peak, share))
                last = at
                if not fired and last - start >= self.hold:
                    out.append((start, start + self.hold, None, None))
                    fired = True
        if start is not None and settled > last + self.step and not waiting:
            close()  # the steps since then had no events
            start, fired = None, False
        self.kept.update((start, last, peak, fired, waiting))
        self._wake([w[0] for w in waiting[:1]] or ([last + self.step] if start is not None else []))
        yield from self._frame(key, out)


def rate_alert_stream(stream: DataFrame, key: str, window: int = 120, step: int = 5,
                      limit: float = 0.5, hold: int = 120, delay: float = 5,
                      flag: str = "prediction") -> DataFrame:
    """(key, started_at, fired_at, ended_at, peak_share): an alert when it fires, `ended_at` being
    null, and again when it ends.

    The share of flagged events over the trailing window is an ordinary sliding aggregation; only
    its closed windows, one row per step and key, reach the state with timers.
    """
    if window % step:
        raise ValueError("window must be a multiple of step")
    rows = stream.select(key, F.col(flag).cast("long").alias("a"), event_time().alias("at"))
    share = rows.withWatermark("at", micros(delay)).groupBy(
        F.window("at", f"{window} seconds", f"{step} seconds"), key).agg(
        (F.sum("a") / F.count("*")).alias("share"))
    steps = share.select(key, "share", F.window_time("window").alias("at"),
                         F.unix_micros("window.end").cast("double").alias("us")).withColumn(
        "s", F.col("us") / 1_000_000).drop("us")
    columns = [key, "started_at", "fired_at", "ended_at", "peak_share"]
    out = T.StructType([rows.schema[key], *[T.StructField(c, T.DoubleType()) for c in columns[1:]]])
    return steps.groupBy(key).transformWithStateInPandas(
        _Sustained(step, hold, limit, columns), out, "append", "EventTime")
