"""What keeps the work of a query in proportion to its tables: what is broadcast, read anew or compared before it is dealt."""

import random

from pyspark.sql import functions as F

from strataframe.functions import geometry, rings
from strataframe.operators import graph, masks, places, slices
from strataframe.operators import tracks as track_operators
from strataframe.plans import scenes, stores, tracks, works

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def kept(monkeypatch, module):
    """The frames that a module writes, by name."""
    seen, own = {}, module.stored
    monkeypatch.setattr(module, "stored", lambda df, name="stage": seen.setdefault(name, df) and own(df, name))
    return seen


def test_plans_are_parsed_once(spark, monkeypatch):
    seen = kept(monkeypatch, slices)
    slices.checked(slices.decoded(stores._slice_texts(spark, SF)), "s_suppkey")
    assert "from_json" not in plan(seen["levels"]) and "from_json" not in plan(seen["verdicts"])


def test_cells_of_sections(spark):
    """Cells by the kernel against the plain expression; sections, of which a small table makes many, are not broadcast."""
    rng = random.Random(5)
    point = lambda: (rng.choice((-9.0, -3.0, 0.0, 4.5, 9.0)) + rng.choice((0.0, 0.3)), rng.uniform(-8, 8))
    path = lambda n: [point() for _ in range(n)]
    rings = [path(rng.randint(3, 9)) for _ in range(40)]
    rows = [(m, 1, [[p, q] for p, q in zip(r, r[1:] + r[:1])]) for m, r in enumerate(rings)] + [(40, 1, []), (41, 1, [[(None, 1.0), (2.0, 3.0)]])]
    sections = spark.createDataFrame(rows, "m long, k int, segments array<array<struct<x:double,z:double>>>").cache()
    models = spark.range(43).selectExpr("id AS m", "20D AS sx", "17D AS sz")
    found = places.sampled_sections(models, sections)
    assert "Broadcast" not in plan(found)
    grid = places._floor_cells(models, F.greatest(F.lit(3.0), F.greatest("sx", "sz") / 24)).join(sections, "m")
    wanted = grid
    for a, b in ((0, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)):
        wanted = wanted.filter(geometry.enclosed(F.col("segments"), F.col("x") + F.col("cell") * 0.4 * a, F.col("z") + F.col("cell") * 0.4 * b))
    wanted = {tuple(r) for r in wanted.select("m", "k", "i", "j").collect()}
    assert wanted and sorted(wanted) == sorted(tuple(r) for r in found.collect())


def test_loops_are_not_broadcast(spark, monkeypatch):
    seen = kept(monkeypatch, places)
    rows = spark.createDataFrame([(m, s, 1, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)], 40.5, 6.0, 3.0) for m in range(3) for s in (1, 2)], "m long, sample int, loop int, ring array<struct<x:double,z:double>>, area double, x double, z double")
    assert {r["track"] for r in places.tracked(rows).collect()} == {1}
    assert "Broadcast" not in plan(seen["pairs"])


def test_faces_of_tracks_are_not_broadcast(spark, monkeypatch):
    """A small file of suppliers made faces, cuts and cells that were broadcast, some kilobytes a supplier."""
    seen = kept(monkeypatch, track_operators)
    found = tracks.track_verdicts(spark, SF)
    assert {"loops", "tracked", "tracks"} <= set(seen)
    assert not [name for name, df in (seen | {"rows": found}).items() if "Broadcast" in plan(df)]


def test_parts_are_dealt_before_they_are_compared(spark):
    """One exchange, and nothing aggregated before it."""
    text = plan(scenes._built(spark, SF))
    assert text.count("Exchange") == 1 and "min_by" not in text and "Aggregate" not in text[text.index("Exchange") :]


def test_edges_are_made_once_for_all_points(spark):
    """One array of sides for all probes of a ring, and the same answers as point by point near borders."""
    rng = random.Random(3)
    near = lambda: (rng.choice((0.0, 2.0, 4.0)) + rng.choice((0.0, 9e-6, -9e-6, 1.1e-5, 0.5)), rng.choice((0.0, 2.0, 4.0)) + rng.choice((0.0, 9e-6, -1.1e-5, 1.0)))
    ell = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]
    rows = spark.createDataFrame([(k, ell, near()) for k in range(200)], "id int, ring array<struct<x:double,z:double>>, p struct<x:double,z:double>")
    plain = geometry.inside_ring(F.col("ring"), F.col("p.x"), F.col("p.z")) | (rings.distance_to_ring(F.col("ring"), F.col("p")) <= 1e-5)
    found = rows.select(rings.contains_point(F.col("ring"), F.col("p")).alias("a"), plain.alias("b")).collect()
    assert {r["a"] for r in found} == {True, False} and all(r["a"] == r["b"] for r in found)
    lone = rows.limit(0).select(rings.contains_probe(F.col("ring"), F.col("ring")).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert lone.count("zip_with") <= 4  # the inner ring's twice, the outer's once


def test_components_of_numbered_structs(spark, monkeypatch):
    """Structs of integers are numbered by arrays, to the same components as texts."""
    rng = random.Random(11)
    pairs = [((rng.randint(-3, 3), rng.randint(0, 40)), (rng.randint(-3, 3), rng.randint(0, 40))) for _ in range(120)]
    rows = spark.createDataFrame(pairs, "src struct<mesh:int,id:long>, dst struct<mesh:int,id:long>")
    found = {tuple(r["node"]): tuple(r["component"]) for r in graph.connected_components(rows).collect()}
    group = {x: {x} for p in pairs for x in p}
    for a, b in pairs:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    assert found == {x: min(g) for x, g in group.items() if len(g) > 1}


def test_meshes_are_welded_once(spark, monkeypatch):
    runs, own = [], works.meshes.connected_components
    monkeypatch.setattr(works.meshes, "connected_components", lambda *a: runs.append(1) or own(*a))
    assert works.weld_points(spark, SF).count() and len(runs) == 1


def test_floors_are_put_together_alone(spark):
    """Edges and corners are made within a floor's row, not compared over all floors; as plainly counted."""
    rng = random.Random(7)
    some = sorted({(m, k, rng.randint(1, 6), rng.randint(1, 6)) for m in range(4) for k in (1, 2) for _ in range(14)})
    rows = spark.createDataFrame(some, "m long, k int, i int, j int")
    seen = [(m, k, *e) for m, k, i, j in some for e in ((0, i, j), (0, i + 1, j), (1, i, j), (1, i, j + 1))]
    edges, corners = masks.boundary(rows), places.cell_corners(rows, 3.0, 29.0, 28.5)
    assert sorted(tuple(r) for r in edges.collect()) == sorted(e for e in seen if seen.count(e) == 1)
    for x, z in ((29.0, 28.5), (8.0, 10.0)):  # the second box ends before the cells do
        wanted = {(m, k, min(-x / 2 + (i - 1 + a) * 3, x / 2), min(-z / 2 + (j - 1 + b) * 3, z / 2)) for m, k, i, j in some for a in (0, 1) for b in (0, 1)}
        assert sorted(tuple(r) for r in places.cell_corners(rows, 3.0, x, z).collect()) == sorted(wanted)
    assert all("HashAggregate(keys=[m#" not in plan(df).replace("ObjectHashAggregate", "") for df in (edges, corners))


def test_buildings_near_hits_are_not_broadcast(spark, tmp_path):
    """A small file of keys can hold millions of buildings; and hits longer than a cell, without length or without a place count as the others do."""
    from strataframe.operators import hits

    p = "struct<x:double,y:double,z:double>"
    spark.range(2000).selectExpr("id AS building", f"CAST(struct(id * 10, 0, 0) AS {p}) AS lo", f"CAST(struct(id * 10 + 4, 6, 4) AS {p}) AS hi").write.parquet(f"{tmp_path}/b")
    towers = spark.read.parquet(f"{tmp_path}/b")
    rays = spark.createDataFrame([(1, (-1.0, 1.0, 1.0), (99.0, 1.0, 1.0)), (2, (2.0, 1.0, 1.0), (2.0, 1.0, 1.0)), (3, None, (2.0, 1.0, 1.0)), (4, (2.0, 9.0, 2.0), (2.0, 3.0, 2.0))], f"hit int, start {p}, end {p}")
    parts = towers.selectExpr("building AS part", "building", f"CAST(struct(lo.x + 2, 3, 2) AS {p}) AS at", f"CAST(struct(4, 6, 4) AS {p}) AS size")
    found, through = hits.capsule_hits(rays, towers, parts, 1.0, 8.0), hits.surface_hits(rays, towers, 8.0)
    for plan in (found, through):
        assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()
    got = {(r["hit"], r["part"]): r["distance"] for r in found.collect()}
    assert sorted(k for k in got if k[0] != 1) == [(2, 0), (4, 0)] and got[2, 0] == 5**0.5 and got[4, 0] == 0
    assert [k[1] for k in sorted(got) if k[0] == 1] == list(range(11)) and got[1, 0] == 5**0.5 and got[1, 10] == 14**0.5
    assert sorted(tuple(r) for r in through.collect()) == [*((1, n + 1, n * 10 + 1.0) for n in range(10)), (4, 1, 3.0)]


def test_components_are_dealt_to_more_tasks_as_edges_grow(spark, monkeypatch):
    """The number of tasks was fixed, so that a task's tables grew with the edges."""
    import random

    from strataframe.operators import graph

    seen = []
    monkeypatch.setattr(graph, "CHUNK", 50)
    monkeypatch.setattr(graph, "restored", lambda df, old, name, real=graph.restored: (seen.append(df.rdd.getNumPartitions()), real(df, old, name))[1])
    rng = random.Random(5)
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2000)] + [(7, None), (None, 8), (9, 9)] + [(5000, 5001 + k) for k in range(300)]
    got = dict(graph.connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect())
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in pairs:
        if None not in (a, b) and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert got == {x: find(x) for x in list(root)}
    assert max(seen[1:]) > 20


def test_segments_are_noded_in_more_tasks_as_they_grow(spark, monkeypatch):
    """The number of tasks was fixed and the segments were broadcast."""
    from strataframe.operators import linework

    seen, plans = [], []
    note = lambda df: (seen.append(df.rdd.getNumPartitions()), plans.append(df._jdf.queryExecution().executedPlan().toString()))
    monkeypatch.setattr(linework, "SEGMENTS", 20, raising=False)
    monkeypatch.setattr(linework, "stored", lambda df, name, real=linework.stored: (note(df), real(df, name))[1])
    p = "struct<x:bigint,z:bigint>"
    lines = [(m, (k * 10, -5), (k * 10, 35)) for m in range(20) for k in range(4)] + [(m, (-5, k * 10), (35, k * 10)) for m in range(20) for k in range(4)]
    found = linework.noded(spark.createDataFrame(lines, f"m int, a {p}, b {p}"), ["m"], 20).collect()
    assert len(found) == 20 * 2 * 4 * 5 and all(abs(r["a"]["x"] - r["b"]["x"]) + abs(r["a"]["z"] - r["b"]["z"]) <= 10 for r in found)
    assert seen[0] >= 8 and not any("Broadcast" in x for x in plans)
