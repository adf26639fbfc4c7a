"""Which events carry news: change filters over the versions of one interval."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from peakledger.functions.events import CURRENT_KEY, RAW_KEY
from peakledger.functions.shipping import by_value
from peakledger.operators.skew import previous, split_hot_groups

by_value(__name__)

VERSION_ORDER = ["version", "ingested_at", "published_at", "source_uri", "value_mw"]
ARRIVAL_ORDER = ["ingested_at", "published_at", "version", "source_uri", "value_mw"]
STATE = "report string, interval_start timestamp_ntz, zone string, version bigint, value_mw double"


def changed_values(events: DataFrame, floor: int | None = None) -> DataFrame:
    """In version order, the events whose value differs from the one before (the first always counts)."""
    before = previous(events, CURRENT_KEY, VERSION_ORDER, "value_mw", "previous_mw", floor)
    return before.where(~F.col("value_mw").eqNullSafe(F.col("previous_mw")))


def judged_values(events: DataFrame, floor: int | None = None) -> DataFrame:
    """report, outcome of every event in version order: produced if its value differs from the one before, else deduplicated."""
    before = previous(events, CURRENT_KEY, VERSION_ORDER, "value_mw", "previous_mw", floor)
    same = F.col("value_mw").eqNullSafe(F.col("previous_mw"))
    return before.select("report", F.when(same, "events_deduplicated").otherwise("events_produced").alias("outcome"))


def silent_restatements(events: DataFrame) -> DataFrame:
    """Versions that were issued with more than one value."""
    return (events.groupBy(*RAW_KEY).agg(F.count_distinct("value_mw").alias("n_values"), F.min("value_mw").alias("lowest"),
                                         F.max("value_mw").alias("highest"))
            .where(F.col("n_values") > 1))


# ---- in arrival order ----
#
# State per interval: the last (version, value) that moved it. An event is news when its value differs from the state's;
# news moves the state unless its version is older. With no state yet, anything is news.

_NONE = (-(2 ** 62), float("nan"))  # older than any version, equal to no value


def _step(state, version, value):
    """(is news, state after)"""
    if value == state[1]:
        return False, state
    return True, ((version, value) if version >= state[0] else state)


def _ids(batch: pa.RecordBatch, keys: list[str]) -> list[tuple]:
    return list(zip(*(batch.column(k).to_pylist() for k in keys)))


def _replayer(keys: list[str]):
    """Walks rows sorted by key and arrival; keeps news and adds the state after it. Holds one Arrow batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, _NONE
        for batch in batches:
            keep, versions, values = [], [], []
            rows = zip(_ids(batch, keys), batch.column("version").to_pylist(), batch.column("value_mw").to_pylist(),
                       batch.column("_seed").to_pylist(), batch.column("_from_version").to_pylist(),
                       batch.column("_from_value").to_pylist())
            for this, version, value, seed, from_version, from_value in rows:
                if this != key:
                    key, state = this, (_NONE if from_version is None else (from_version, from_value))
                news, state = _step(state, version, value)
                emit = news and seed == 1
                keep.append(emit)
                if emit:
                    versions.append(state[0])
                    values.append(state[1])
            kept = batch.filter(pa.array(keep, pa.bool_()))
            names = [n for n in batch.schema.names if not n.startswith("_")]
            arrays = [kept.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(versions, pa.int64()), pa.array(values, pa.float64())],
                                             names=names + ["state_version", "state_value"])
    return run


class _Outcomes:
    """What a run of events does to any state it may start from, as pieces of the start version.

    A start (sv, sx) first moves at the first event with version >= sv and a value other than sx. For sv in (lo, hi] that is
    the event that first reached hi (value x1) if x1 != sx, else the first later one with version >= sv and value != x1.
    From there on the state is known, so each piece just follows its two possible states. Start versions above ``cap``
    cannot occur and get no pieces.
    """

    def __init__(self, cap):
        self.cap, self.top, self.pieces = cap, _NONE[0] - 1, []

    def feed(self, version, value):
        added = []
        for piece in self.pieces:
            piece["first"] = _step(piece["first"], version, value)[1]
            if piece["second"] is not None:
                piece["second"] = _step(piece["second"], version, value)[1]
            elif value != piece["x1"] and version > piece["lo"]:
                if version < piece["hi"]:
                    added.append({**piece, "lo": version})
                    piece["hi"] = version
                piece["second"] = (version, value)
        self.pieces += added
        if version > self.top and self.top < self.cap:
            self.pieces.append({"lo": self.top, "hi": version, "x1": value, "first": (version, value), "second": None})
            self.top = version


def _summarizer(keys: list[str], fields: list[tuple]):
    """Per (key, slice): its outcome pieces."""
    types = {name: kind for name, kind in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, outcomes, out = None, None, []

        def close():
            for p in outcomes.pieces if outcomes else []:
                second = p["second"] or (None, None)
                out.append((*key, p["lo"], p["hi"], p["x1"], *p["first"], *second))

        def flush():
            columns = list(zip(*out)) if out else [[] for _ in types]
            arrays = [pa.array(list(c), types[n]) for n, c in zip(types, columns)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=list(types))

        for batch in batches:
            rows = zip(_ids(batch, keys), batch.column("version").to_pylist(), batch.column("value_mw").to_pylist(),
                       batch.column("_cap").to_pylist())
            for this, version, value, cap in rows:
                if this != key:
                    close()
                    key, outcomes = this, _Outcomes(cap)
                outcomes.feed(version, value)
            yield flush()
        close()
        yield flush()
    return run


def _fold(pdf):
    """One key's slices in order: the state each begins with. Rows: at most (range partitions x pieces)."""
    state, starts = _NONE, []
    for number, pieces in pdf.groupby("_slice", sort=True):
        starts.append((number, *state))
        hit = pieces[(pieces["lo"] < state[0]) & (state[0] <= pieces["hi"])]
        if len(hit):
            piece = hit.iloc[0]
            if piece["x1"] != state[1]:
                state = (int(piece["v1"]), float(piece["w1"]))
            elif piece["v2"] == piece["v2"] and piece["v2"] is not None:
                state = (int(piece["v2"]), float(piece["w2"]))
    out = pdf.iloc[[0] * len(starts)][CURRENT_KEY].reset_index(drop=True)
    out["_slice"] = [s[0] for s in starts]
    out["_from_version"] = [s[1] for s in starts]
    out["_from_value"] = [s[2] for s in starts]
    return out


def _slice_starts(hot: DataFrame, order: list[str]) -> DataFrame:
    """keys, _slice, _from_version, _from_value for every slice of every hot key."""
    tops = hot.groupBy(*CURRENT_KEY, "_slice").agg(F.max("version").alias("_top"))
    earlier = Window.partitionBy(*CURRENT_KEY).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    caps = tops.select(*CURRENT_KEY, "_slice", F.coalesce(F.max("_top").over(earlier), F.lit(_NONE[0])).alias("_cap"))
    keys = CURRENT_KEY + ["_slice"]
    fields = [("interval_start", pa.timestamp("us")), ("report", pa.string()), ("zone", pa.string()), ("_slice", pa.int32()),
              ("lo", pa.int64()), ("hi", pa.int64()), ("x1", pa.float64()), ("v1", pa.int64()), ("w1", pa.float64()),
              ("v2", pa.int64()), ("w2", pa.float64())]
    schema = ("interval_start timestamp_ntz, report string, zone string, _slice int, lo bigint, hi bigint, x1 double, "
              "v1 bigint, w1 double, v2 bigint, w2 double")
    # caps: one row per slice of a hot key, at most SHARES plus one per range partition
    needed = [c for c in dict.fromkeys([*keys, *order, "version", "value_mw", "_seed"])]
    pieces = (hot.select(*needed).join(F.broadcast(caps), keys).repartition(*keys)
              .sortWithinPartitions(*keys, "_seed", *order).mapInArrow(_summarizer(keys, fields), schema))
    return pieces.groupBy(*CURRENT_KEY).applyInPandas(
        _fold, "interval_start timestamp_ntz, report string, zone string, _slice int, _from_version bigint, _from_value double")


def news_in_arrival_order(events: DataFrame, state: DataFrame | None = None, floor: int | None = None,
                          order: list[str] | None = None) -> DataFrame:
    """The events that are news, each with the state after it (state_version, state_value).

    ``order`` names the columns of arrival; it must be total up to exact copies.

    ``state`` holds one row per interval (columns of STATE) from earlier runs. State rows ride along as the first row of
    their key, so one shuffle serves both. An interval with very many events is cut into slices: each slice is reduced to
    what it does to any incoming state, the reductions are chained per interval, then all slices run at once.
    """
    rows = events.withColumn("_seed", F.lit(1))
    if state is not None:
        rows = rows.unionByName(state.withColumn("_seed", F.lit(0)), allowMissingColumns=True)
    order = order or ARRIVAL_ORDER
    cold, hot = split_hot_groups(rows, CURRENT_KEY, ["_seed", *order], floor)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema) + ", state_version bigint, state_value double"

    def replay(df, keys):
        # the worker's output columns go by position: events' own columns first
        carried = [*events.columns, *[k for k in keys if k not in events.columns], "_seed", "_from_version", "_from_value"]
        return (df.select(*carried).repartition(*keys).sortWithinPartitions(*keys, "_seed", *order)
                .mapInArrow(_replayer(keys), schema))

    nothing = cold.withColumn("_from_version", F.lit(None).cast("bigint")).withColumn("_from_value", F.lit(None).cast("double"))
    news = replay(nothing, CURRENT_KEY)
    if hot is None:
        return news
    starts = F.broadcast(_slice_starts(hot, order))  # one row per slice of a hot key: bounded as above
    return news.unionByName(replay(hot.join(starts, CURRENT_KEY + ["_slice"]), CURRENT_KEY + ["_slice"]))


def moved_state(news: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The last state of each interval that had news, in the columns of STATE."""
    last = news.groupBy(*CURRENT_KEY).agg(
        F.max_by(F.struct("state_version", "state_value"), F.struct(*(order or ARRIVAL_ORDER))).alias("s"))
    return last.select(*CURRENT_KEY, F.col("s.state_version").alias("version"), F.col("s.state_value").alias("value_mw"))
