"""The no-data alarm: keyed state with timers that fire although nothing arrives.

A service's state is its newest settled sample and, of the samples that may still get earlier neighbours, the first and last of each
block half as long as the limit: no silence fits inside a block, so a crowded service keeps a handful of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from peakledger.functions.shipping import by_value
from peakledger.operators.metrics import SILENCE_MINUTES
from peakledger.streaming.monitors import LATE, _instant, _plain

by_value(__name__)

ALARM, RECOVERY = "alarm", "recovery"


class Watch(StatefulProcessor):
    """Times are microseconds since the epoch. ``arrival``: go by the clock of arrival, not by the samples' own instants."""

    def __init__(self, limit: int, arrival: bool) -> None:
        self.limit, self.block, self.arrival = limit, limit // 2, arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", "last bigint, silent boolean")
        self.timer = handle.getValueState("timer", "at bigint")
        self.open = handle.getMapState("open", "block bigint", "first bigint, last bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        for part in rows:
            at = pd.Series([now]) if self.arrival else part["us"].dropna().astype("int64")
            for block, group in at.groupby(at // self.block):
                first, last = int(group.min()), int(group.max())
                if self.open.containsKey((int(block),)):
                    seen = self.open.getValue((int(block),))
                    first, last = min(first, seen[0]), max(last, seen[1])
                self.open.updateValue((int(block),), (first, last))
        yield self._advance(key, now)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        yield self._advance(key, self._now(timerValues))

    def _now(self, timerValues: TimerValues) -> int:
        return 1000 * (timerValues.getCurrentProcessingTimeInMs() if self.arrival else timerValues.getCurrentWatermarkInMs())

    def _advance(self, key: tuple, now: int) -> pd.DataFrame:
        """Settles what lies at or before ``now``: nothing can come any more between such samples."""
        out = []
        last, silent = self.settled.get() if self.settled.exists() else (None, False)
        waiting = sorted((tuple(span), block[0]) for block, span in self.open.iterator())
        while waiting and waiting[0][0][0] <= now:
            (first, end), block = waiting.pop(0)
            self.open.removeKey((block,))
            if last is not None and first - last > self.limit:
                if not silent:
                    out.append((ALARM, last, last + self.limit))
                out.append((RECOVERY, last, first))
                silent = False
            last = end if last is None else max(last, end)
        if last is not None and not silent and now > last + self.limit and not (waiting and waiting[0][0][0] <= last + self.limit):
            out.append((ALARM, last, last + self.limit))
            silent = True
        if last is not None:
            self.settled.update((last, silent))
        due = [waiting[0][0][0]] if waiting else []
        if last is not None and not silent:
            due.append(last + self.limit)
        self._wake(-(-min(due) // 1000) + 1 if due else None)
        return pd.DataFrame([(key[0], *row) for row in out], columns=["service", "kind", "silent_from", "at"])

    def _wake(self, at: int | None) -> None:
        """One timer a service."""
        if self.timer.exists():
            set_for = self.timer.get()[0]
            if set_for == at:
                return
            self.handle.deleteTimer(set_for)
            self.timer.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def close(self) -> None:
        pass


def silence_alarms(samples: DataFrame, limit_minutes: float = SILENCE_MINUTES, late: str = LATE, arrival: bool = False) -> DataFrame:
    """service, kind, silent_from, at: one alarm when a service has sent nothing for the limit, one recovery when it sends again.

    ``samples``: a stream of service, ts. In event time, the default, the alarms are those of ``metrics.silences`` as of the watermark, for
    samples in any order and batches of any cut; the watermark moves on as long as any service sends. With ``arrival`` the instants are
    those at which micro-batches took the samples in, and an alarm needs no data at all: the stream must run on a processing-time trigger.
    A sample without an instant counts in arrival mode only. The session must use the state store that ``stateful.STORE`` names.
    """
    timed = samples.select("service", _instant(F.col("ts")).alias("at"))
    timed = timed if arrival else timed.withWatermark("at", late)
    found = timed.withColumn("us", F.unix_micros("at")).groupBy("service").transformWithStateInPandas(
        statefulProcessor=Watch(int(limit_minutes * 60_000_000), arrival), outputMode="append",
        outputStructType="service string, kind string, silent_from bigint, at bigint", timeMode="processingTime" if arrival else "eventTime")
    return found.select("service", "kind", *[_plain(F.timestamp_micros(c)).alias(c) for c in ("silent_from", "at")])
