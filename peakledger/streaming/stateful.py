"""The arrival-order change filter as keyed streaming state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from peakledger.functions.events import CURRENT_KEY
from peakledger.functions.shipping import by_value
from peakledger.operators.changes import ARRIVAL_ORDER, _NONE, _step

by_value(__name__)

#: The state store that typed state needs; a setting of the session.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class NewsFilter(StatefulProcessor):
    """Keeps the last version and value of an interval in one typed state variable."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "version bigint, value double")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        row = initialState.iloc[0]
        self.last.update((int(row["version"]), float(row["value_mw"])))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.last.get()) if self.last.exists() else _NONE
        for part in rows:  # an Arrow batch at a time
            part = part.sort_values(ARRIVAL_ORDER, kind="stable")
            kept, states = [], []
            for i, (version, value) in enumerate(zip(part["version"].tolist(), part["value_mw"].tolist())):
                news, state = _step(state, version, value)
                if news:
                    kept.append(i)
                    states.append(state)
            out = part.iloc[kept].copy()
            out["state_version"], out["state_value"] = [s[0] for s in states], [s[1] for s in states]
            yield out
        if state != _NONE:
            self.last.update(state)

    def close(self) -> None:
        pass


def news_stream(events: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Streaming twin of ``news_in_arrival_order``: late older versions are judged, never dropped, so there is no watermark.

    ``state`` (report, interval_start, zone, version, value_mw; one row per interval) is what was known before the stream's first batch, so
    a stream with a new checkpoint goes on where a table left off. State is one (version, value) per interval and is kept for good, as any
    interval may be restated at any time. Of one interval and micro-batch, events are judged in order of arrival within each Arrow
    batch. The session must use the state store that STORE names.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema) + ", state_version bigint, state_value double"
    seeded = None if state is None else state.select(*CURRENT_KEY, "version", "value_mw").groupBy(*CURRENT_KEY)
    return events.groupBy(*CURRENT_KEY).transformWithStateInPandas(
        statefulProcessor=NewsFilter(), outputStructType=schema, outputMode="append", timeMode="none", initialState=seeded)
