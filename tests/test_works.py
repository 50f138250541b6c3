"""Kernels, options, sinks and selection on small cases: nulls, empty tables, ties and refusals."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe import config, sinks
from strataframe.functions import polygons as P
from strataframe.functions import rings
from strataframe.sources import meshes as archives
from strataframe.operators import graph, hits, masks, meshes, sections, select
from strataframe.streaming import tracking

RNG = random.Random(19381)
SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
ELL = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]


def star(n):
    """A ring around the origin with n vertices at random distances: simple, rarely convex."""
    angles = [(k + RNG.uniform(0, 0.4)) / n * 2 * math.pi for k in range(n)]
    return [(r * math.cos(a), r * math.sin(a)) for a, r in ((a, RNG.uniform(3, 9)) for a in angles)]


def test_rings_become_valid():
    assert P.valid_ring(SQUARE[::-1]) == P.valid_ring(SQUARE[::-1] + [(0.0, 4.0)]) and P.signed_area(P.valid_ring(SQUARE[::-1])) == 16
    assert len(P.valid_ring([*SQUARE[:2], (4.0, 2.0), *SQUARE[2:]])) == 4  # a straight vertex goes
    for bad, why in (([(0, 0), (4, 4), (4, 0), (0, 4)], "cross"), (SQUARE[:2], "vertices"), ([(0, 0), (1, 0), (2, 0)], "area|cross|back"), ([(0, 0), (math.nan, 1), (2, 0)], "finite"), ([(0, 0), (4, 0), (2, 0), (2, 3)], "cross|back"), (SQUARE[:1] * 3, "degenerate")):
        with pytest.raises(ValueError, match=why):
            P.valid_ring([(float(x), float(z)) for x, z in bad])


def test_clip_hull_box_and_overlap():
    assert P.clipped(SQUARE, [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]) == []
    assert P.overlap_area(ELL, SQUARE) == pytest.approx(12) and P.overlap_area(ELL, [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]) == pytest.approx(0)
    for _ in range(30):
        ring = star(9)
        own = P.hull(ring)
        assert all(P.turn(a, b, p) >= -1e-9 for a, b in zip(own, own[1:] + own[:1]) for p in ring)
        _, w, d, _ = P.smallest_box(own)
        xs, zs = zip(*own)
        assert P.signed_area(own) <= w * d + 1e-9 <= (max(xs) - min(xs)) * (max(zs) - min(zs)) * 2 + 1e-6
    with pytest.raises(ValueError):
        P.hull([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)])
    turned = [(x * 0.8 - z * 0.6, x * 0.6 + z * 0.8) for x, z in [(0, 0), (7, 0), (7, 3), (0, 3)]]
    assert sorted(P.smallest_box(turned)[1:3]) == pytest.approx([3, 7])


def test_loops_of_segments():
    edges = list(zip(SQUARE, SQUARE[1:] + SQUARE[:1]))
    assert [sorted(r) for r in P.walked(edges + edges, 0.1)] == [sorted(SQUARE)]
    near = [(a, (b[0] + 0.05, b[1])) for a, b in edges]
    assert len(P.walked(near, 0.1)[0]) == 4
    with pytest.raises(ValueError, match="open"):
        P.walked(edges[:3], 0.1)
    with pytest.raises(ValueError, match="branching"):
        P.walked([*edges, ((0.0, 0.0), (9.0, 9.0)), ((9.0, 9.0), (4.0, 0.0))], 0.1)
    inner = [(x / 2 + 1, z / 2 + 1) for x, z in SQUARE]
    assert P.nested([SQUARE, inner, [(x / 4 + 1.5, z / 4 + 1.5) for x, z in SQUARE]]) == [(0, False), (1, True), (2, False)]


def test_simplified_stays_close_and_simple():
    for _ in range(20):
        ring = star(30)
        thin = P.simplified_safely(ring, 1.0)
        assert len(thin) <= len(ring) and abs(abs(P.signed_area(thin)) - abs(P.signed_area(ring))) <= 0.035 * abs(P.signed_area(ring)) + 1e-9


def test_ring_functions_refuse_with_a_reason(spark):
    rows = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]), (2, None), (3, SQUARE)], f"id int, ring {P.RING}")
    got = {r["id"]: r["v"] for r in rows.select("id", P.as_valid("ring").alias("v")).collect()}
    assert got[1]["reason"] == "edges cross or touch" and got[2]["reason"] == "missing ring" and got[3]["reason"] is None and len(got[3]["value"]) == 4
    assert rows.limit(0).select(P.as_hull("ring")).count() == 0


def test_contains_along_borders(spark):
    rows = spark.createDataFrame([(ELL, [(0.0, 0.0), (2.0, 0.0), (2.0, 4.0), (0.0, 4.0)], True), (ELL, [(0.0, 0.0), (2.5, 0.0), (2.5, 4.0), (0.0, 4.0)], False), (ELL, [(1.0, 1.0), (3.0, 1.0), (1.0, 3.0)], True), (ELL, [(1.0, 1.0), (3.9, 1.9), (1.9, 3.9)], False)], f"o {P.RING}, i {P.RING}, want boolean")
    for r in rows.select("want", rings.contains_ring(F.col("o"), F.col("i")).alias("exact"), rings.contains_probe(F.col("o"), F.col("i")).alias("probe")).collect():
        assert r["exact"] == r["want"] and (r["probe"] or not r["want"])


def test_options():
    assert config.configured(config.GridMassing, config.RESIDUAL_GRID).min_floors == 2 and config.configured(config.Massing) == config.Massing()
    for kind, options in ((config.GridMassing, {"nothing": 1}), (config.GridMassing, {"similarity": 1.1}), (config.GridMassing, {"max_tiers": 2.5}), (config.GridMassing, {"min_area": math.nan}), (config.GridMassing, {"min_area": True}), (config.Massing, {"roof_fallback": 1}), (config.Clusters, {"max_components": 3}), (config.Hits, {"drag": 0})):
        with pytest.raises(ValueError):
            config.configured(kind, options)


def test_components_of_chains_and_structs(spark):
    chain = [(i, i + 1) for i in range(0, 3000) if i % 1000 != 999]
    RNG.shuffle(chain)
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame([*chain, (5, 5), (None, 1)], "src long, dst long").repartition(7)).collect()}
    assert got == {i: i // 1000 * 1000 for i in range(3000)}
    texts = [("b", "a"), ("c", "b"), ("z", "y")]
    assert {tuple(r) for r in graph.connected_components(spark.createDataFrame(texts, "src string, dst string")).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("y", "y"), ("z", "y")}
    rows = spark.createDataFrame([((1, 2), (1, 1)), ((1, 1), (0, 9))], "src struct<m:int,i:int>, dst struct<m:int,i:int>")
    assert {tuple(r["component"]) for r in graph.connected_components(rows).collect()} == {(0, 9)}
    assert graph.connected_subsets(spark.createDataFrame([(1, 2), (2, 3)], "src int, dst int"), 3).count() == 3


def test_labels_equal_a_search():
    for _ in range(30):
        n = RNG.randrange(2, 40)
        edges = [(RNG.randrange(n), RNG.randrange(n)) for _ in range(RNG.randrange(n))]
        from strataframe.operators.kernels import labelled

        head = list(range(n))
        for _ in range(n):
            for a, b in edges:
                head[a] = head[b] = min(head[a], head[b])
        assert labelled(n, np.array([a for a, _ in edges], int), np.array([b for _, b in edges], int)).tolist() == head


def test_disjoint_plans_walk(spark):
    plans = [(i, float(RNG.randrange(5)), [RNG.randrange(12) for _ in range(RNG.randrange(4))]) for i in range(60)]
    used, want = set(), set()
    for i, _, s in sorted(plans, key=lambda p: (-p[1], p[0])):
        if not used & set(s):
            used |= set(s)
            want.add(i)
    for kind, of in (("int", lambda i: i), ("string", lambda i: f"{i:03}")):
        rows = spark.createDataFrame([(of(i), s, m) for i, s, m in plans], f"id {kind}, score double, m array<int>")
        assert {r["id"] for r in select.disjoint(rows, "id", "score", "m").collect()} == {of(i) for i in want}


def test_assignment_is_the_cheapest():
    from itertools import permutations

    for _ in range(20):
        costs = np.array([[RNG.random() for _ in range(6)] for _ in range(5)])
        got = meshes.assignment(costs)
        best = min(sum(costs[i, p[i]] for i in range(5)) for p in permutations(range(6), 5))
        assert len(set(got)) == 5 and costs[np.arange(5), got].sum() == pytest.approx(best)


def test_concatenated_faces(spark):
    vertices = spark.createDataFrame([(m, i) for m, n in ((1, 3), (2, 4), (5, 2)) for i in range(n)], "mesh int, id int")
    faces = spark.createDataFrame([(1, 0, 1, 2), (2, 0, 1, 3), (5, 0, 1, 1)], "mesh int, a int, b int, c int")
    assert sorted(tuple(r) for r in meshes.concatenated(faces, vertices).collect()) == [(1, 0, 1, 2), (2, 3, 4, 6), (5, 7, 8, 8)]


def test_store_versions(spark, tmp_path):
    schema = "id int, v string"
    store = sinks.Store(spark, f"file://{tmp_path}/store")
    assert store.current() is None
    first = store.begin(spark.createDataFrame([(1, "a"), (2, "b")], schema))
    failures = spark.createDataFrame([], schema)
    staged = store.stage(spark.createDataFrame([(2, "c"), (3, "d")], schema), failures)
    with pytest.raises(sinks.Conflict, match="complete"):
        store.apply(staged, first, ["id"], expected=spark.createDataFrame([(2,)], "id int"))
    with pytest.raises(sinks.Conflict, match="audit"):
        store.apply(staged, first, ["id"], check=F.col("v") == "c")
    second = store.apply(staged, first, ["id"], expected=spark.createDataFrame([(3,), (2,)], "id int"), check=F.col("v").isNotNull())
    assert {tuple(r) for r in store.read().collect()} == {(1, "a"), (2, "c"), (3, "d")} and {tuple(r) for r in store.read(part="archive").collect()} == {(2, "b")}
    late = store.stage(spark.createDataFrame([(1, "z")], schema), failures)
    with pytest.raises(sinks.Conflict, match="another version"):
        store.apply(late, first, ["id"])
    twice = store.stage(spark.createDataFrame([(1, "y"), (1, "z")], schema), failures)
    with pytest.raises(sinks.Conflict, match="unique"):
        store.apply(twice, second, ["id"])
    assert store.undo() == first and {tuple(r) for r in store.read().collect()} == {(1, "a"), (2, "b")}
    with pytest.raises(sinks.Conflict):
        store.undo()
    with pytest.raises(sinks.Conflict, match="has a version"):
        store.begin(spark.createDataFrame([(1, "a")], schema))


def test_one_of_two_writers_succeeds(spark, tmp_path):
    """Both have seen the same pointer; and a pointer that was claimed and never written holds nothing."""
    store = sinks.Store(spark, f"file://{tmp_path}/store")
    first = store.begin(spark.createDataFrame([(1, "a")], "id int, v string"))
    last, names = store._latest()
    store._point(last, ["one", *names])
    with pytest.raises(sinks.Conflict):
        store._point(last, ["other", *names])
    assert store.history() == ["one", first]
    store._fs().create(store._path(f"pointer-{last + 2:08d}"), False).close()
    assert store.current() == "one"
    store._point(store._latest()[0], ["next"])
    assert store.current() == "next"


def test_archives_and_records(spark, tmp_path):
    vertices = spark.createDataFrame([(m, i * 10, float(i), float(m), 0.5) for m in (1, 2) for i in range(4)], "mesh int, id int, x double, y double, z double").repartition(3)
    faces = spark.createDataFrame([(1, 0, 10, 20), (1, 30, 20, 0), (2, 30, 0, 10)], "mesh int, a int, b int, c int")
    folder = f"file://{tmp_path}/npz"
    assert archives.write_npz(vertices, faces, folder) == ["1.npz", "2.npz"]
    v, f = archives.archived_meshes(spark, folder)
    assert sorted(tuple(r) for r in f.collect()) == [("1", 0, 1, 2), ("1", 3, 2, 0), ("2", 3, 0, 1)]
    assert sorted(tuple(r) for r in v.collect()) == sorted((str(m), i, float(i), float(m), 0.5) for m in (1, 2) for i in range(4))
    with pytest.raises(Exception, match="missing"):
        archives.write_npz(vertices, spark.createDataFrame([(1, 0, 10, 25)], "mesh int, a int, b int, c int"), f"file://{tmp_path}/bad")
    assert archives.write_npz(vertices.limit(0), faces.limit(0), f"file://{tmp_path}/none") == []
    (tmp_path / "r.json").write_text('[{"name": "a", "size": [1, 2, 3]}, {"name": "b"}, {"name": "c", "size": 7}]')
    got = archives.read_records(spark, f"file://{tmp_path}/r.json", "name string, size array<double>").collect()
    assert [(r["name"], r["reason"] is None) for r in got] == [("a", True), ("b", False), ("c", False)]


def test_batches_and_links(spark):
    plans = spark.createDataFrame([("a", 1, None), ("a", 2, "bad"), ("b", 3, None)], "source string, output int, reason string")
    staged, failures = sinks.staged_batch(plans, "source")
    assert [r["output"] for r in staged.collect()] == [3] and [tuple(r) for r in failures.collect()] == [("a", 1, "bad")]
    links = sinks.source_links(plans, spark.createDataFrame([("a",)], "source string"), "source")
    assert sorted(tuple(r) for r in links.collect()) == [(1, "a", 2), (2, "a", 2)]
    assert sinks.report_row(plans, "x", n=F.count("*")).first()["figures"] == '{"n":3}'


def test_surfaces_and_ground(spark):
    p = "struct<x:double,y:double,z:double>"
    boxes = spark.createDataFrame([(1, (2.0, -1.0, -1.0), (4.0, 1.0, 1.0)), (2, (2.5, -1.0, -1.0), (3.0, 1.0, 1.0)), (3, (6.0, -1.0, -1.0), (9.0, 1.0, 1.0)), (4, (-1.0, -1.0, -1.0), (1.0, 1.0, 1.0))], f"building int, lo {p}, hi {p}")
    rays = spark.createDataFrame([(1, (0.0, 0.0, 0.0), (20.0, 0.0, 0.0)), (2, (0.0, 0.0, 0.0), (0.5, 0.0, 0.0)), (3, (0.0, 5.0, 0.0), (20.0, 5.0, 0.0))], f"hit int, start {p}, end {p}")
    assert [(r["hit"], r["n"], r["t"]) for r in hits.surface_hits(rays, boxes, 8.0).orderBy("n").collect()] == [(1, 1, 2.0), (1, 2, 6.0)]
    samples = spark.createDataFrame([(1, 0.0, 9.0, 2.0), (1, 0.5, 9.0, None), (1, 1.0, 9.0, 1.0), (1, 2.0, 3.0, 1.0), (2, 0.0, 0.5, None), (2, 1.0, 9.0, 1.0)], "target int, ts double, speed double, ground double")
    assert sorted(tuple(r) for r in tracking.ground_state(samples).collect()) == [(1, 0.0, 1.0, 2.0, "recovered"), (2, None, None, 0.0, "recovered")]
    assert [tuple(r) for r in tracking.emissions(samples, 0.9).filter("target = 1").orderBy("ts").collect()] == [(1, 0.0, None), (1, 1.0, None), (1, 2.0, 1.0)]


def test_loops_give_reasons(spark):
    p = "struct<x:double,z:double>"
    edges = [(1, a, b) for a, b in zip(SQUARE, SQUARE[1:] + SQUARE[:1])] + [(2, a, b) for a, b in zip(SQUARE, SQUARE[1:])]
    got = {r["g"]: r for r in sections.loops(spark.createDataFrame(edges, f"g int, a {p}, b {p}"), ["g"], 0.1).collect()}
    assert got[1]["area"] == 16 and got[1]["reason"] is None and got[2]["reason"] == "open contour" and got[2]["ring"] is None


def test_corner_cells_stay_apart(spark):
    cells = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 2, 2), (1, 1, 4, 4)], "m int, k int, i int, j int")
    assert sorted((r["area"], len(r["corners"])) for r in masks.loops(cells, 5).collect()) == [(1.0, 4)] * 3
    ring = spark.createDataFrame([(1, 1, i, j) for i in range(1, 4) for j in range(1, 4) if (i, j) != (2, 2)], "m int, k int, i int, j int")
    assert sorted(r["area"] for r in masks.loops(ring, 5).collect()) == [-1.0, 9.0]
    assert masks.rectangles(ring, 5).agg(F.sum((F.col("i1") - F.col("i0") + 1) * (F.col("j1") - F.col("j0") + 1))).first()[0] == 8


def test_radius_weld_on_random_points(spark):
    """Against a plain search: crowds, points on cell borders, distances of exactly the reach, and clusters that only one pair of points joins."""
    import random

    from strataframe.operators import meshes

    rng = random.Random(5)
    rows = [(k, rng.choice([-1, 1]) * rng.randrange(0, 60) * 2.5, rng.randrange(0, 60) * 2.5) for k in range(260)] + [(1000 + k, 400.0 + k % 7 / 10, 400.0 + k // 7 / 10) for k in range(300)] + [(2000, 410.5, 400.0), (2001, 420.5, 400.0), (2002, 430.6, 400.0)]
    head = list(range(len(rows)))

    def top(k):
        while head[k] != k:
            k = head[k]
        return k

    for i, (_, x, z) in enumerate(rows):
        for j in range(i):
            if (x - rows[j][1]) ** 2 + (z - rows[j][2]) ** 2 <= 100:
                a, b = sorted((top(i), top(j)))
                head[b] = a
    want = {r[0]: rows[top(k)][0] for k, r in enumerate(rows)}
    frame = spark.createDataFrame([*rows, (3000, None, 1.0)], "id long, x double, z double")
    found = meshes.radius_weld(frame, 10.0)
    assert "__cx" not in found._jdf.queryExecution().toString()
    assert {r["id"]: r["cluster"] for r in found.collect()} == want | {3000: 3000} and len(set(want.values())) > 5
