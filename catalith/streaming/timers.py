"""Stuck assets reset by a timer of their own, as keyed state with timers instead of a scan over all assets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from catalith.operators.state import RESET_CAP, UNDER_WAY

OUT = "asset_id long, at timestamp, was string, attempts long, status string, status_reason string, reset_event boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state where timers need it; the session's own setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class Watch(StatefulProcessor):
    """State of an asset: its last event and what it was (a value), its attempts at recovery (a list), one timer while it is under way.

    An event moves the timer to the time after which the asset is stuck. When it fires the asset goes back to received and the
    reset joins its attempts; with cap attempts before, it fails instead. Assets that ended have no timer."""

    def __init__(self, older_than_s: float, cap: int, by_event: bool, forget_s: float | None):
        self.wait, self.cap, self.by_event = math.ceil(older_than_s * 1000), cap, by_event
        self.forget = None if forget_s is None else math.ceil(forget_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "state string, at timestamp, event_id long", self.forget)
        self.attempts = handle.getListState("attempts", "at timestamp, kind string", self.forget)

    def _due(self, at: pd.Timestamp, now_ms: int) -> int:
        # Later than the wait by a millisecond at most, as an asset is stuck only when more than the wait has passed.
        return (math.floor(at.value / 1e6) if self.by_event else now_ms) + self.wait + 1

    def _wind(self, due: int | None) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if due is not None:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Plain tuples: most keys have few rows, and frames made for each of them cost more than the rows.
        events = [e for part in rows for e in zip(part["ts"], part["event_id"].tolist(), part["state"], strict=True)]
        events.sort(key=lambda e: e[:2])
        tries = [(ts.to_pydatetime(), state) for ts, _, state in events if state in ("failed", "reset")]
        if tries:
            self.attempts.appendList(tries)
        ts, number, state = events[-1]
        before = self.last.get()
        if before is None or (pd.Timestamp(before[1]), before[2]) < (ts, number):
            self.last.update((state, ts.to_pydatetime(), int(number)))
            due = self._due(ts, timerValues.getCurrentProcessingTimeInMs()) if state in UNDER_WAY else None
            if before[0] in UNDER_WAY if before else self.forget is not None:  # only then a timer may run
                self._wind(due)
            elif due is not None:
                self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        if held is None or held[0] not in UNDER_WAY:
            return
        was, at, number = held
        n = sum(1 for _ in self.attempts.get()) if self.attempts.exists() else 0
        over = n >= self.cap
        now = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        status = "failed" if over else "received"
        self.last.update((status, at, number))
        if not over:
            self.attempts.appendValue((now.to_pydatetime(), "reset"))
        yield pd.DataFrame({"asset_id": [key[0]], "at": [now], "was": [was], "attempts": [n], "status": [status], "status_reason": [RESET_CAP if over else None], "reset_event": [not over]})


def resets(events: DataFrame, older_than_s: float, cap: int, *, delay: str | None = "0 seconds", forget_s: float | None = None) -> DataFrame:
    """A stream of (asset_id, event_id, ts, state) gives a row for each asset that was under way (routing, classifying,
    extracting) for longer than older_than_s without an event: (asset_id, at, was, attempts, status, status_reason, reset_event).

    Attempts are the failures and resets before, so an asset that keeps getting stuck is reset cap times at most and then
    failed with a reason; each asset has its own timer, so nothing scans all of them, and only keys with events or due timers are touched.
    With a delay, timers go by event time: they fire once the watermark has passed. An event that comes in before that
    counts, however old the asset's last one is; of events of an asset the latest (ts, event_id) counts. Events behind the
    watermark are dropped. delay=None: timers go by the clock from the batch an event came in with, and forget_s lets the state
    of an asset go that long after its last change; run it with lifecycle.run_until. Start either within timed_state.
    """
    by_event = delay is not None
    if by_event and forget_s is not None:
        raise ValueError("state is forgotten by the clock only: set delay to None")
    rows = events.select(F.col("asset_id").cast("long"), F.col("event_id").cast("long"), F.col("ts").cast("timestamp"), F.col("state").cast("string"))
    rows = rows.withWatermark("ts", delay) if by_event else rows
    watch = Watch(older_than_s, cap, by_event, forget_s)
    return rows.groupBy("asset_id").transformWithStateInPandas(watch, OUT, "Append", "EventTime" if by_event else "ProcessingTime")
