"""Plans of slices and tiers, tracks and cascades on small cases: nulls, empty tables, repeated rows and refusals."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.config import Tracks
from strataframe.functions import polygons as P
from strataframe.operators import massing, meshes, nearest, places, slices, smooth, tracks
from strataframe.plans import works
from strataframe.storage import stored

RING = P.RING


def box(x0, z0, x1, z1):
    return [[x0, z0], [x1, z0], [x1, z1], [x0, z1]]


def plan(**changes):
    whole = {"version": 1, "id": "a", "origin": {"x": 0.0, "y": 1.0, "z": 0.0}, "core": {"minX": 4.0, "minZ": 4.0, "maxX": 9.0, "maxZ": 9.0}}
    whole["levels"] = [{"y": 20.0 * k, "thickness": 5.0, "pieces": [box(0.0, 0.0, 6.5, 13.0), box(6.5, 0.0, 13.0, 13.0)]} for k in range(3)]
    return whole | changes


def levels(change):
    own = plan()["levels"]
    change(own)
    return plan(levels=own)


CASES = {
    None: [plan(), levels(lambda v: v[1].pop("thickness")), levels(lambda v: v[0].update(pieces=[[[0, 0], [13, 0], [13, 6], [6, 6], [6, 13], [0, 13]], box(6.0, 6.0, 13.0, 13.0)]))],
    "missing plan": [None], "invalid plan": ["{", "[]", {}], "unsupported plan version": [plan(version=2)], "plan needs a short nonempty id": [plan(id=""), plan(id="x" * 181), plan(id=None)],
    "invalid source origin": [plan(origin=None), plan(origin={"x": 1.0, "y": None, "z": 0.0})], "invalid levels count": [plan(levels=[]), plan(levels=None), plan(levels=plan()["levels"][:1])],
    "missing or invalid common core": [plan(core=None)], "common core must be at least 4 wide and deep": [plan(core={"minX": 4.0, "minZ": 4.0, "maxX": 7.5, "maxZ": 9.0})], "invalid level elevation": [levels(lambda v: v[2].update(y=None))],
    "invalid slab thickness": [levels(lambda v: v[1].update(thickness=0.01))], "consecutive levels leave too little clear": [levels(lambda v: v[1].update(y=12.0)), levels(lambda v: v.reverse())], "invalid floor pieces count": [levels(lambda v: v[0].update(pieces=[]))],
    "piece vertices must be [x,z] pairs": [levels(lambda v: v[0]["pieces"].append([[1.0], [2.0, 3.0], [4.0, 5.0]])), levels(lambda v: v[0].update(pieces=[[[0.0, 0.0], [1.0, 1.0]]]))], "edges cross or touch": [levels(lambda v: v[0].update(pieces=[[[0, 0], [13, 13], [13, 0], [0, 13]]]))],
    "pieces overlap": [levels(lambda v: v[2]["pieces"].append(box(1.0, 1.0, 2.0, 2.0)))], "common core leaves the pieces or enters a hole": [levels(lambda v: v[1]["pieces"].pop()), levels(lambda v: v[1].update(pieces=[box(0.0, 0.0, 13.0, 8.9)]))],
}


def test_contract_of_slices(spark):
    rows = [(reason, c if isinstance(c, str) else c if c is None else json.dumps(c)) for reason, some in CASES.items() for c in some]
    texts = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "id int, plan string").repartition(3)
    verdicts, pieces = slices.checked(slices.decoded(texts), "id")
    got = {r["id"]: r for r in verdicts.collect()}
    assert {i: got[i]["reason"] for i in got} == {i: reason for i, (reason, _) in enumerate(rows)}
    assert (got[0]["levels"], got[0]["pieces"], got[0]["area"]) == (3, 6, pytest.approx(507))
    parts = slices.built(pieces, "id")
    audit = {r["id"]: r for r in slices.audited(parts, pieces, "id").collect()}
    assert set(audit) == {0, 1, 2} and all(r["reason"] is None and r["cores"] == 12 for r in audit.values()) and audit[0]["slabs"] == 6
    lost = parts.filter("NOT (id = 0 AND name = 'CoreWallLeft' AND level = 1) AND NOT (id = 1 AND piece = 1 AND level = 2)")
    assert {r["id"]: r["reason"] for r in slices.audited(lost, pieces, "id").collect()} == {0: "the core walls are not those expected", 1: "a piece's parts have another area", 2: None}
    twice = parts.unionByName(parts.filter("id = 2 AND name = 'CoreDividerX'"))
    assert {r["id"]: r["reason"] for r in slices.audited(twice, pieces, "id").collect()}[2] == "the core walls are not those expected"
    none, no_pieces = slices.checked(slices.decoded(texts.limit(0)), "id")
    assert none.count() == no_pieces.count() == slices.built(no_pieces, "id").count() == 0


def test_tiers(spark):
    at = lambda b, t, s=0.0: (b, t, [(s, s), (30.0 - s, s), (30.0 - s, 30.0 - s), (s, 30.0 - s)])
    cases = {
        None: [(90.0, [at(0.0, 90.0)]), (90.0, [at(0.0, 40.0), at(40.00005, 90.0, 3.0)])], smooth.WHOLE[0]: [(None, [at(0.0, 90.0)]), (float("nan"), [at(0.0, 90.0)])], smooth.WHOLE[1]: [(9.0, [at(0.0, 9.0)])], smooth.WHOLE[2]: [(90.0, []), (90.0, None)],
        smooth.TIER[0]: [(90.0, [at(0.0, 0.0)]), (90.0, [at(None, 90.0)])], smooth.TIER[1]: [(90.0, [at(1.0, 90.0)]), (90.0, [at(0.0, 40.0), at(41.0, 90.0)])], smooth.TIER[2]: [(90.0, [at(0.0, 91.0)])], smooth.TIER[4]: [(90.0, [at(0.0, 40.0, 3.0), at(40.0, 90.0)])],
        smooth.LAST: [(90.0, [at(0.0, 80.0)])], "missing ring": [(90.0, [(0.0, 90.0, None)])],
    }
    rows = [(reason, *c) for reason, some in cases.items() for c in some]
    plans = spark.createDataFrame([(i, h, t) for i, (_, h, t) in enumerate(rows)], f"id int, height double, tiers array<struct<bottom:double,top:double,ring:{RING}>>")
    found = smooth.normalized(plans, "id")
    assert {r["id"]: r["reason"] for r in found.collect()} == {i: reason for i, (reason, *_) in enumerate(rows)}
    floors = smooth.tiered_floors(found, "id").filter("reason IS NULL").orderBy("id", "k").collect()
    assert [(r["k"], r["tier"]) for r in floors if r["id"] == 1][:1] == [(1, 1)] and {r["n"] for r in floors} == {4} and floors[0]["bottom"] == 0
    many = smooth.tiered_floors(found.filter("id < 2"), "id", F.lit(30))
    assert {r["reason"] for r in many.collect()} == {smooth.CLEAR}
    one = smooth.tiered_floors(found.filter("id = 1"), "id", F.lit(1))
    assert {r["reason"] for r in one.collect()} == {smooth.MANY}
    assert smooth.tiered_floors(smooth.normalized(plans.limit(0), "id"), "id").count() == 0


def test_scenes_of_tiles(spark):
    """Scenes of other sizes and order, a scene without targets, sizes of 0, and ties that any matching solves."""
    schema = "scene int, id string, dx double, dy double, dz double, x double, y double, z double"
    own = [(1, f"s{k}", 3.0 + k, 5.0 + 2 * k, 4.0 + 3 * k, 10.0 * k, 7.0 * k * k, -3.0 * k) for k in range(6)] + [(2, "a", 1.0, 1.0, 1.0, 0.0, 0.0, 0.0)] + [(3, "a", 1.0, 2.0, 3.0, 0.0, 0.0, 0.0)]
    there = [(1, f"t{5 - k}", 2 * (3.0 + k), 2 * (5.0 + 2 * k), 2 * (4.0 + 3 * k), -20.0 * k + 1, 14.0 * k * k + 2, -6.0 * k + 3) for k in range(6)] + [(3, "b", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (4, "b", 1.0, 1.0, 1.0, 0.0, 0.0, 0.0)]
    got = meshes.aligned(spark.createDataFrame(own, schema).repartition(3), spark.createDataFrame(there, schema), ["scene"]).collect()
    first = {r["source"]: r for r in got if r["scene"] == 1}
    assert {s: r["target"] for s, r in first.items()} == {f"s{k}": f"t{5 - k}" for k in range(6)}
    r = first["s0"]
    assert (r["scale"], r["sx"], r["sy"], r["sz"], r["ox"], r["oy"], r["oz"], r["intact"], r["reason"]) == (2, -1, 1, 1, 1, 2, 3, 6, None)
    assert all(r["reason"] == "too few intact tiles" for r in got if r["scene"] != 1) and not {r["scene"] for r in got} & {2, 4}
    wide = spark.createDataFrame([(1, a, b, float((a - b) ** 2)) for a in range(3) for b in range(5)], "g int, source int, target int, cost double")
    assert sorted((r["source"], r["target"]) for r in meshes.matched(wide, ["g"]).collect()) == [(0, 0), (1, 1), (2, 2)]
    tall = wide.select("g", F.col("target").alias("source"), F.col("source").alias("target"), "cost")
    assert sorted((r["source"], r["target"]) for r in meshes.matched(tall, ["g"]).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_tracks_of_nothing(spark):
    loops = spark.createDataFrame([], f"m long, sample int, share double, y double, loop int, ring {RING}, area double, x double, z double")
    models = spark.createDataFrame([(1, 0.0, 90.0)], "m long, y0 double, y1 double")
    cells = spark.createDataFrame([(1, 0.0, 5.0, 0.0), (1, 0.0, 5.0, 0.0)], "m long, x double, y double, z double")
    found, verdicts = tracks.diagnosed(loops, models, cells, Tracks())
    assert found.count() == 0 and [(r["tracks"], r["accepted"], r["volume"], r["complete"]) for r in verdicts.collect()] == [(0, 0, 0.0, False)]
    assert places.tracked(loops).count() == 0


def test_overlapping_tracks(spark):
    square = lambda x, a: [(x, 0.0), (x + a, 0.0), (x + a, a), (x, a)]
    rows = [(1, s, s / 12, 10.0 * s, n, square(x, a), a * a, x + a / 2, a / 2) for s in range(1, 12) for n, (x, a) in enumerate(((0.0, 40.0), (100.0, 30.0), (110.0, 8.0)), 1)]
    loops = spark.createDataFrame(rows, f"m long, sample int, share double, y double, loop int, ring {RING}, area double, x double, z double")
    models = spark.createDataFrame([(1, 0.0, 120.0)], "m long, y0 double, y1 double")
    cells = spark.createDataFrame([(1, 10.0, float(y), 10.0) for y in range(0, 120, 10)] + [(1, 300.0, 0.0, 0.0)], "m long, x double, y double, z double")
    found, verdicts = tracks.diagnosed(loops, models, cells)
    v = verdicts.first()
    assert (v["tracks"], v["accepted"], v["overlaps"], v["complete"]) == (3, 3, 1, False) and v["ground"] == 0.5 and found.filter("reason IS NULL").count() == 3


def test_last_ways(spark):
    schema = "m long, cell double, size_x double, size_y double, size_z double, ground double, upper double, floors int"
    models = spark.createDataFrame([(m, 3.0, 60.0, h, 60.0, 15.0, 12.5, 3) for m, h in ((1, 60.0), (2, 60.0), (3, 20.0), (4, 60.0))], schema)
    cells = [(1, k, i, j) for k in (1, 2, 3) for i in range(1, 9) for j in range(1, 9)] + [(2, 1, 1, 1), (2, 1, 19, 19), (2, 3, 1, 19)] + [(3, 1, i, j) for i in range(1, 9) for j in range(1, 9)]
    got = {r["m"]: r for r in massing.final_plans(spark.createDataFrame(cells, "m long, k int, i int, j int"), models, 20).collect()}
    ways = list(massing.WAYS)
    assert [got[m]["method"] for m in (1, 2, 3, 4)] == [ways[0], ways[1], ways[2], ways[2]] and got[1]["area"] == 576 and (got[3]["top"], got[4]["top"]) == (30, 60)
    assert massing.final_plans(spark.createDataFrame([], "m long, k int, i int, j int"), models.limit(0), 20).count() == 0


def test_nearest_of_nothing(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0), (3, 1e6, 1e6), (3, 1e6, 1e6)], "id int, x double, z double")
    none = points.limit(0)
    assert nearest.nearest_any(points, none, 1.0).count() == nearest.nearest_any(none, points, 1.0).count() == nearest.mutual_any(none, 1.0).count() == 0
    assert sorted(tuple(r) for r in nearest.nearest_any(points, points.filter("id = 1"), 1.0).collect()) == [(1, 1, 0.0), (3, 1, 2e12), (3, 1, 2e12)]
    assert [tuple(r) for r in nearest.mutual_any(points.dropDuplicates(), 1.0).collect()] == [(1, 3, 2e12)]


def test_far_places_meet_few_cells(spark, monkeypatch):
    """Thousands of places far from thousands of targets, some of them together: each keeps a few cells on a level, and the nearest is right."""
    rng = np.random.default_rng(4)
    own = np.round(rng.uniform(0, 500, (3000, 2)), 1)
    own[:600] = np.round(own[:600] / 100, 1)
    there = np.vstack([np.round(rng.uniform(-20000, 20000, (2000, 2)), 1), own[:500] + 0.3])
    frame = lambda v: spark.createDataFrame([(k, float(x), float(z)) for k, (x, z) in enumerate(v)], "id long, x double, z double")
    kept = []
    monkeypatch.setattr(nearest, "stored", lambda df, name="stage": (found := stored(df, name), kept.append(found.count()) if name == "near" else None)[0])
    got = {r["id"]: (r["target"], r["d2"]) for r in nearest.nearest_any(frame(there), frame(own), 1.0).collect()}
    d2 = (there[:, :1] - own[:, 0]) ** 2 + (there[:, 1:] - own[:, 1]) ** 2
    assert got == {k: (int(row.argmin()), float(row.min())) for k, row in enumerate(d2)}
    assert kept and max(kept) < 8 * len(there)


def test_neighbours_meet_by_stretches(spark, tmp_path):
    """Parts of one size are many, so the join needs a key that grows with the table."""
    spark.createDataFrame([(k, k % 2) for k in range(0, 400, 3)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = works.neighbours(spark, str(tmp_path))
    assert re.search(r"Join \[p_size#\d+, at#\d+L?\]", found._jdf.queryExecution().executedPlan().toString())
    keys = list(range(0, 400, 3))
    assert sorted(map(tuple, found.collect())) == [(a, b) for a in keys for b in keys if a < b < a + 60 and a % 2 == b % 2]
