"""What happens to targets after a hit, as streams: states on the ground, trails that are flushed some time after their last emission, and sweeps.

Each operator keeps a small state for each target and uses event-time timers, so what it gives depends on the samples and not on when batches
run: a query that is stopped and started again from its checkpoint goes on where it was. Streams have target (long), ts (timestamp), and a watermark on ts; rows of
a batch are taken in order of ts, rows that come in a later batch than newer ones in the order of arrival, and rows behind the watermark are
dropped. The state store must be RocksDB's (`use_timers` sets it). Nulls in target or ts drop a row. Results in seconds since the epoch equal those of the batch forms in tracking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strataframe.config import Hits
from strataframe.streaming.tracking import FLUSH, TOUCH

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_timers(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def _ordered(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """The rows of a batch in order of time."""
    rows = pd.concat(list(frames), ignore_index=True).sort_values("ts", kind="stable")
    seconds = (rows["ts"] - pd.Timestamp(0)) / pd.Timedelta(seconds=1)
    return rows.drop(columns=["target"]).assign(ts=seconds).itertuples(index=False)


def _given(value: float | None) -> float | None:
    return None if value is None or math.isnan(value) else float(value)


class _Kept(StatefulProcessor):
    """One value of state for each target."""

    schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("kept", self.schema)

    def kept(self) -> tuple | None:
        return tuple(self.state.get()) if self.state.exists() else None

    def close(self) -> None:
        pass


class GroundTracker(_Kept):
    """airborne, contact, braced, recovered: each change of a target's state, once."""

    schema = "contact double, braced double, done boolean"

    def __init__(self, p: Hits):
        self.p = p

    def handleInputRows(self, key, rows, timerValues):
        contact, braced, done = self.kept() or (None, None, False)
        out = []
        for r in _ordered(rows):
            ground, speed = _given(r.ground), _given(r.speed)
            if done:
                break
            if braced is None and ground is not None and ground < TOUCH:
                if contact is None:
                    contact = r.ts
                    out.append((key[0], r.ts, "contact"))
                if r.ts - contact >= self.p.brace_delay:
                    braced = r.ts
                    out.append((key[0], r.ts, "braced"))
            limit = self.p.stop_speed if braced is None else self.p.stand_speed if r.ts > braced else None
            if limit is not None and speed is not None and speed < limit:
                done = True
                out.append((key[0], r.ts, "recovered"))
        self.state.update((contact, braced, done))
        yield pd.DataFrame(out, columns=["target", "at", "state"])


class TrailFlusher(_Kept):
    """Trails of emissions at least `cooldown` apart while a target touches the ground, each flushed `after` seconds after its last one."""

    schema = "last double, open int, number int, trails array<struct<trail:int,first:double,last:double>>"

    def __init__(self, cooldown: float, after: float):
        self.cooldown, self.after = cooldown, after

    def handleInputRows(self, key, rows, timerValues):
        last, open_, number, trails = self.kept() or (None, None, 0, [])
        waiting = {t[0]: [t[1], t[2]] for t in trails}
        for r in _ordered(rows):
            ground = _given(r.ground)
            on = ground is not None and ground < TOUCH
            if on and (last is None or r.ts - last >= self.cooldown):
                last = r.ts
                if open_ is None:
                    number += 1
                    open_ = number
                    waiting[open_] = [r.ts, r.ts]
                else:
                    # a trail that was flushed already, as the watermark went on without samples, is not begun again
                    waiting.setdefault(open_, [r.ts, r.ts])[1] = r.ts
            elif not on:
                open_ = None
        self._keep(last, open_, number, waiting)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, open_, number, trails = self.kept()
        now = expiredTimerInfo.getExpiryTimeInMs()
        due = [t for t in trails if self._due(t[2]) <= now]
        self._keep(last, open_, number, {t[0]: [t[1], t[2]] for t in trails if self._due(t[2]) > now})
        yield pd.DataFrame([(key[0], t[0], t[1], t[2] + self.after) for t in due], columns=["target", "trail", "first", "due"])

    def _due(self, last: float) -> int:
        return math.ceil((last + self.after) * 1000)

    def _keep(self, last, open_, number, waiting) -> None:
        self.state.update((last, open_, number, [(k, v[0], v[1]) for k, v in sorted(waiting.items())]))
        for due in {self._due(v[1]) for v in waiting.values()}:  # what is registered already stays as it is
            self.handle.registerTimer(due)


class Sweeper(_Kept):
    """At each tick a target whose last height before it is below 0, with the height that it had first."""

    schema = "home double, tick long, y double, told boolean"

    def __init__(self, every: float):
        self.every = every

    def handleInputRows(self, key, rows, timerValues):
        home, tick, y, told = self.kept() or (None, None, None, True)
        out = []
        for r in _ordered(rows):
            here = _given(r.y)
            home = here if tick is None else home
            own = math.floor(r.ts / self.every) + 1
            if tick is not None and own != tick and not told and y is not None and y < 0:
                out.append((key[0], tick, y, home))
            if own != tick:
                told = False
            tick, y = own, here
        self.state.update((home, tick, y, told))
        if not told:
            self.handle.registerTimer(math.ceil(tick * self.every * 1000))
        yield pd.DataFrame(out, columns=["target", "tick", "y", "home"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        home, tick, y, told = self.kept()
        due = not told and math.ceil(tick * self.every * 1000) <= expiredTimerInfo.getExpiryTimeInMs()
        if due:
            self.state.update((home, tick, y, True))
        yield pd.DataFrame([(key[0], tick, y, home)] if due and y is not None and y < 0 else [], columns=["target", "tick", "y", "home"])


def _timed(stream: DataFrame, columns: list[str], processor: _Kept, schema: str) -> DataFrame:
    use_timers(stream.sparkSession)
    rows = stream.select(F.col("target").cast("long").alias("target"), "ts", *(F.col(c).cast("double").alias(c) for c in columns)).filter("target IS NOT NULL AND ts IS NOT NULL")
    return rows.groupBy("target").transformWithStateInPandas(processor, schema, "Append", "EventTime")


def ground_states(samples: DataFrame, p: Hits = Hits()) -> DataFrame:
    """target, at, state: each change of state of the targets of samples (target, ts, speed, ground)."""
    return _timed(samples, ["speed", "ground"], GroundTracker(p), "target long, at double, state string")


def flushed_trails(samples: DataFrame, cooldown: float = Hits().dust_cooldown, after: float = FLUSH) -> DataFrame:
    """target, trail, first, due of the trails of samples (target, ts, ground), when the watermark has passed due."""
    return _timed(samples, ["ground"], TrailFlusher(cooldown, after), "target long, trail int, first double, due double")


def swept(positions: DataFrame, every: float = 1.0) -> DataFrame:
    """target, tick, y, home of positions (target, ts, y), when a later one or the watermark has passed the tick."""
    return _timed(positions, ["y"], Sweeper(every), "target long, tick long, y double, home double")
