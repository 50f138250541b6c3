"""Streams of hits: validation, the newest generation of each target, and emission with a cooldown."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least length of a direction, seconds between two emissions.
LEAST_LENGTH = 0.01
COOLDOWN = 0.3


def valid_hits(hits: DataFrame) -> DataFrame:
    """The hits with a target and a direction of at least LEAST_LENGTH."""
    return hits.filter(F.col("target").isNotNull() & (F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + F.col("dz") * F.col("dz") >= LEAST_LENGTH * LEAST_LENGTH))


def latest_generation(hits: DataFrame) -> DataFrame:
    """target, generation (number of hits so far) and event_id of the newest; a partial aggregate, also on streams."""
    newest = F.max_by("event_id", F.struct("ts", "event_id"))
    return hits.groupBy("target").agg(F.count("*").alias("generation"), newest.alias("event_id"))


def cooled_down(hits: DataFrame, seconds: float = COOLDOWN) -> DataFrame:
    """target, event_id, ts of the hits that come at least `seconds` after the last emitted one of their target.

    hits is a stream with (target, event_id, ts); the state of a target is its last emission. Hits that arrive in a
    later batch than newer ones are not emitted. A batch's hits of one target are ordered in memory: bound batches by
    the source (maxFilesPerTrigger).
    """
    step = pd.Timedelta(seconds=seconds)

    def emit(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        kept = []
        for ts in rows["ts"]:
            kept.append(last is None or ts - last >= step)
            last = ts if kept[-1] else last
        state.update((int(last.value // 1000),))
        yield rows.loc[kept, ["target", "event_id", "ts"]]

    rows = hits.select("target", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts")).dropna()
    return rows.groupBy("target").applyInPandasWithState(emit, "target long, event_id long, ts timestamp_ntz", "last long", "append", "NoTimeout")
