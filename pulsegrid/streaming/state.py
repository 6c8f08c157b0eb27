"""State that knows when a key has gone idle: cumulative figures that are forgotten, and sessions.

Both are opt-in, since a key that comes back starts anew; `operators.aggregates.bucketed` in update mode has
no such gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from pulsegrid.functions.codec import floor_to

_OUT = "opc_tag_id long, aggregate timestamp, count long, sum double, min double, max double"
_STATE = "count long, sum double, min double, max double"


def idle_cumulative(readings: DataFrame, unit: str = "HOUR", idle_ms: int = 60_000) -> DataFrame:
    """Count, sum, min and max so far of each tag and bucket, emitted whenever readings arrive. Null
    values are left out. For a streaming table in update mode. Idleness is the machine's time, so what a
    slow stream forgets depends on its speed; `idle_sessions` goes by the readings' own times."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, total, low, high = state.get if state.exists else (0, 0.0, float("inf"), float("-inf"))
        for b in batches:
            v = b["value"].dropna()
            if len(v):
                n, total, low, high = n + len(v), total + float(v.sum()), min(low, float(v.min())), max(high, float(v.max()))
        state.update((n, total, low, high))
        state.setTimeoutDuration(idle_ms)
        if n:
            yield pd.DataFrame({"opc_tag_id": [key[0]], "aggregate": [key[1]], "count": [n], "sum": [total], "min": [low], "max": [high]})

    rows = readings.select("opc_tag_id", floor_to(readings["timestamp"], unit).alias("aggregate"), "value")
    return rows.groupBy("opc_tag_id", "aggregate").applyInPandasWithState(step, _OUT, _STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


_SESSION = "opc_tag_id long, started timestamp, ended timestamp, readings long, count long, sum double, min double, max double, closed_by string"
_FIGURES = ("started", "ended", "readings", "count", "sum", "min", "max")
#: The open sessions of a bucket's tags, an entry for each tag. Times as microseconds; `count`, `sum`, `min` and
#: `max` are of the values that aren't null; without any the last three are NaN.
_OPEN = "opc_tag_id array<long>, started array<long>, ended array<long>, readings array<long>, count array<long>, sum array<double>, min array<double>, max array<double>"
#: Buckets that tags are dealt to: a call from Spark and its state cost far more than a reading, so each serves many tags.
BUCKETS = 256


def _folded(held: pd.DataFrame, new: pd.DataFrame, idle_us: int) -> tuple[pd.DataFrame, np.ndarray]:
    """Sessions of open ones, one for a tag at most, and readings (`opc_tag_id`, `untagged`, `at`, `value`), by tag
    and time; and which of them are their tag's last."""
    one = pd.DataFrame({"opc_tag_id": new["opc_tag_id"].astype("Int64").mask(new["untagged"].astype(bool)), "started": new["at"], "ended": new["at"], "readings": 1, "count": new["value"].notna().astype("int64")})
    rows = pd.concat([held, one.assign(**{c: new["value"].astype("float64") for c in ("sum", "min", "max")})], ignore_index=True)
    tag, null = rows["opc_tag_id"].fillna(0).to_numpy("int64"), rows["opc_tag_id"].isna().to_numpy()
    reading = np.arange(len(rows)) >= len(held)
    at = rows["started"].to_numpy("int64")
    order = np.lexsort((at, reading, tag, null))  # a tag's open session before its readings
    rows, tag, null, at = rows.iloc[order], tag[order], null[order], at[order]
    ended = rows["ended"].to_numpy("int64")
    turn = np.concatenate([[True], (tag[1:] != tag[:-1]) | (null[1:] != null[:-1])])
    first = np.flatnonzero(turn)
    # readings come by time, so only the open session may have ended later than the last reading
    before = np.maximum(np.concatenate([[0], ended[:-1]]), ended[first][np.cumsum(turn) - 1])
    begin = np.flatnonzero(turn | (at - before > idle_us))
    found = {"opc_tag_id": rows["opc_tag_id"].iloc[begin].reset_index(drop=True)}
    ways = {"started": np.minimum, "ended": np.maximum, "min": np.fmin, "max": np.fmax}
    for c in _FIGURES:
        v = rows[c].to_numpy("float64" if c in ("sum", "min", "max") else "int64")
        found[c] = ways.get(c, np.add).reduceat(np.where(rows["count"] > 0, v, 0.0) if c == "sum" else v, begin)
    found["sum"] = np.where(found["count"] > 0, found["sum"], np.nan)
    return pd.DataFrame(found), np.append(turn[begin][1:], True)


class _Idle(StatefulProcessor):
    """The open sessions of a bucket's tags: one value, and one timer at the instant at which the first of the tags
    will have been idle for too long."""

    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN)

    def _held(self) -> pd.DataFrame:
        columns = self.open.get() if self.open.exists() else ((),) * (1 + len(_FIGURES))
        kinds = ("Int64", *["int64"] * 4, *["float64"] * 3)
        return pd.DataFrame({c: pd.Series(list(v), dtype=k) for c, v, k in zip(("opc_tag_id", *_FIGURES), columns, kinds, strict=True)})

    def _keep(self, held: pd.DataFrame, timer: int | None, running: bool) -> None:
        """Store what is open; `timer` is the one at hand, which is `running` still or has run out."""
        due = self._due(held["ended"]).min() if len(held) else None
        if running and timer is not None and timer != due:
            self.handle.deleteTimer(int(timer))
        if due is None:
            self.open.clear()
            return
        tags = [None if tag is pd.NA else tag for tag in held["opc_tag_id"].tolist()]
        self.open.update((tags, *(held[c].tolist() for c in _FIGURES)))
        if timer != due or not running:
            self.handle.registerTimer(int(due))

    def _due(self, ended: pd.Series) -> pd.Series:
        """When sessions that have ended so are over, in whole milliseconds, as timers count."""
        return -(-(ended + self.idle_us) // 1000)

    def _frame(self, over: pd.DataFrame, closed_by: str) -> Iterator[pd.DataFrame]:
        if len(over):
            yield over.assign(started=pd.to_datetime(over["started"], unit="us"), ended=pd.to_datetime(over["ended"], unit="us"), closed_by=closed_by)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        found, last = _folded(held, pd.concat(list(rows)), self.idle_us)
        self._keep(found[last], self._due(held["ended"]).min() if len(held) else None, True)
        return self._frame(found[~last], "reading")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, now = self._held(), expiredTimerInfo.getExpiryTimeInMs()
        over = self._due(held["ended"]) <= max(now, timerValues.getCurrentWatermarkInMs())
        if not over.any():
            return iter(())
        self._keep(held[~over], now, False)
        return self._frame(held[over], "timer")

    def close(self) -> None: ...


def idle_sessions(readings: DataFrame, idle: str = "60 seconds", delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """A row for each session of a tag: readings no more than `idle` apart. It is emitted when a later
    reading shows that it is over, or when the watermark, `delay` behind the newest reading of all tags,
    has passed its end by `idle`; then the tag's state is cleared. So what is emitted depends on the
    readings only, not on the machine's speed.

    For a streaming table in append mode, with the state store in RocksDB (`StreamConfig.state`). A reading
    that is earlier than the session at hand, but not behind the watermark, counts in that session. Tags are dealt
    by a hash to `buckets`, which a stream keeps: a bucket's readings of one micro-batch, and the open sessions of
    its tags, are held together, and its state is written whole. Null tags are a tag; null times are left out.
    """
    micros = int(pd.Timedelta(idle).total_seconds() * 1_000_000)
    # null tags go by a flag: beside nulls pandas would make doubles of large ids
    rows = readings.where(F.col("timestamp").isNotNull()).select(F.coalesce("opc_tag_id", F.lit(0)).cast("long").alias("opc_tag_id"), F.col("opc_tag_id").isNull().alias("untagged"), "timestamp", F.unix_micros("timestamp").alias("at"), F.col("value").cast("double").alias("value"), F.pmod(F.xxhash64("opc_tag_id"), F.lit(buckets)).cast("int").alias("bucket"))
    return rows.withWatermark("timestamp", delay).groupBy("bucket").transformWithStateInPandas(_Idle(micros), _SESSION, "Append", "EventTime")
