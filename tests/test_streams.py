"""Streams that are stopped half way and started again give what the batch forms give."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataframe.streaming import ground, tracking

SCHEMA = "target long, ts timestamp_ntz, speed double, ground double, y double"
START = 1_700_000_000


def rows():
    rng = random.Random(9)
    out = []
    for target in range(6):
        t, near = START + rng.random(), False
        for _ in range(90):
            near = near if rng.random() < 0.8 else not near
            out.append((target, t, rng.choice([0.5, 5.0, 9.0, 20.0, 30.0]) if t > START + 6 else 30.0, rng.uniform(0, 3.9) if near else rng.choice([None, 6.0]), rng.uniform(-3, 6)))
            t += rng.choice([rng.uniform(0.04, 0.2), rng.uniform(0.04, 0.2), rng.uniform(0.3, 0.5), rng.uniform(1.0, 1.4)])
    return sorted(out, key=lambda r: r[1])


@pytest.fixture(scope="module")
def parts():
    own = rows()
    closing = [(999, own[-1][1] + 60, 0.0, None, 1.0), (999, own[-1][1] + 120, 0.0, None, 1.0)]
    return [own[:200], own[200:350], own[350:], closing[:1], closing[1:]]


def streamed(spark, tmp_path, parts, operator, columns):
    """All parts as files, the query stopped and started again from its checkpoint between them; each is a batch of its own."""
    for n, part in enumerate(parts):
        frame = [(k, pd.Timestamp(t, unit="s").to_pydatetime(), s, g, y) for k, t, s, g, y in part]
        spark.createDataFrame(frame, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if n == 1:
            continue  # two files for the next start
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "2 seconds")
        query = operator(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
        assert query.awaitTermination(180)
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).filter("target <> 999").select(*columns).collect())


def batch(spark, parts):
    own = [(k, pd.Timestamp(t, unit="s").to_pydatetime(), s, g, y) for part in parts for k, t, s, g, y in part if k != 999]
    return spark.createDataFrame(own, SCHEMA).withColumn("ts", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double"))


def same(got, want):
    assert {a[:2] for a in got} == {b[:2] for b in want} and len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y if not isinstance(x, float) or y is None else x == pytest.approx(y, abs=1e-5) for x, y in zip(a, b)), (a, b)


def test_ground_states(spark, tmp_path, parts):
    got = streamed(spark, tmp_path, parts, ground.ground_states, ["target", "state", "at"])
    want = []
    for r in tracking.ground_state(batch(spark, parts)).collect():
        want += [(r["target"], s, r[s]) for s in ("contact", "braced", "recovered") if r[s] is not None]
    same(got, sorted(want))
    assert {s for _, s, _ in got} == {"contact", "braced", "recovered"}


def test_trails_are_flushed(spark, tmp_path, parts):
    got = streamed(spark, tmp_path, parts, ground.flushed_trails, ["target", "trail", "first", "due"])
    want = tracking.flushes(tracking.emissions(batch(spark, parts))).select("target", F.col("trail").cast("int"), "first", "due").collect()
    same(got, sorted(tuple(r) for r in want))
    assert len(got) > 10


def test_sweeps(spark, tmp_path, parts):
    got = streamed(spark, tmp_path, parts, ground.swept, ["target", "tick", "y", "home"])
    want = tracking.sweeps(batch(spark, parts)).select("target", F.col("tick").cast("long"), "y", "home").collect()
    same(got, sorted(tuple(r) for r in want))
    assert len(got) > 20
