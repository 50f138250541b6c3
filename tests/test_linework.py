"""Polygons of linework against plain counts, and what is refused or left out."""

import math
import random

import pytest

from strataframe.operators import linework

SCHEMA = "m long, a struct<x:double,z:double>, b struct<x:double,z:double>"


def polygonised(spark, groups, **options):
    rows = [(m, p and {"x": float(p[0]), "z": float(p[1])}, q and {"x": float(q[0]), "z": float(q[1])}) for m, lines in groups.items() for p, q in lines]
    found, figures = linework.polygonised(spark.createDataFrame(rows, SCHEMA), ["m"], **options)
    return found.collect(), {r["m"]: r for r in figures.collect()}


def ring(*points):
    return list(zip(points, points[1:] + points[:1]))


def net(face):
    area = lambda r: sum(a["x"] * b["z"] - b["x"] * a["z"] for a, b in zip(r, r[1:] + r[:1])) / 2
    return area(face["ring"]) + sum(area(h) for h in face["holes"])


def test_kinds_of_lines(spark):
    square, inner = ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((2, 2), (4, 2), (4, 4), (2, 4))
    groups = {
        1: [*square, ((5, 0), (5, 4))],  # a dangle that starts inside an edge
        2: [*square, *inner],  # an island
        3: [*square, *inner, ((4, 3), (10, 3))],  # joined by a cut
        4: [*square, ((0, 0), (10, 10)), ((0, 10), (10, 0))],  # crossing diagonals
        5: [*square, *ring((10, 10), (20, 10), (20, 20), (10, 20))],  # they touch at a corner
        6: [*square, *ring((0, 0), (3, 1), (1, 3))],  # a hole that touches its shell at a corner
        7: [*square[:3], ((0, 10), (0, 2)), ((5, 5), (5, 7)), ((5, 7), (8, 7)), ((8, 7), (6, 9))],  # a seam of two; a tree apart
        8: [((0, 0), (4, 0)), ((2, 0), (9, 0)), ((0, 0), (4, 0))],  # along each other
        9: [*square, *ring((10, 3), (16, 3), (16, 7), (10, 7))],  # a shared part of an edge
        10: [*square, *ring((2, 2), (8, 2), (8, 8), (2, 8)), *ring((4, 4), (6, 4), (6, 6), (4, 6))],  # islands in islands
        11: [((1, 1), (1, 1)), (None, (2, 2)), ((3, 3), None)],  # nothing
    }
    found, figures = polygonised(spark, groups, seam=2.0)
    got = {m: sorted((round(f["area"], 6), len(f["holes"])) for f in found if f["m"] == m) for m in groups}
    assert got[1] == [(100, 0)] and (figures[1]["dangle_length"], figures[1]["cut_length"]) == (4, 0)
    assert got[2] == [(4, 0), (96, 1)] and figures[2]["cut_length"] == 0
    assert got[3] == [(4, 0), (96, 1)] and (figures[3]["dangle_length"], figures[3]["cut_length"]) == (0, 6)
    assert got[4] == [(25, 0)] * 4
    assert got[5] == [(100, 0)] * 2
    assert got[6] == [(4, 0), (96, 1)]
    assert got[7] == [(100, 0)] and (figures[7]["seam_count"], figures[7]["seam_length"]) == (1, 2) and figures[7]["dangle_length"] == pytest.approx(5 + math.sqrt(8))
    assert got[8] == [] and (figures[8]["dangle_length"], figures[8]["segments"], figures[8]["closed"]) == (9, 3, 0)
    assert got[9] == [(24, 0), (100, 0)]
    assert got[10] == [(4, 0), (32, 1), (64, 1)]
    assert got[11] == [] and figures[11]["segments"] == 3
    assert all(f["area"] == pytest.approx(net(f)) for f in found) and all(r["invalid"] == 0 for r in figures.values())


def test_faces_of_random_lines_meet_euler(spark):
    """Edges less places, and parts: the number of faces; with random segments, most of them crossing."""
    rng = random.Random(4)
    groups = {m: [((rng.uniform(0, 30), rng.uniform(0, 30)), (rng.uniform(0, 30), rng.uniform(0, 30))) for _ in range(3 + 4 * m)] for m in range(6)}
    rows = [(m, dict(zip("xz", p)), dict(zip("xz", q))) for m, lines in groups.items() for p, q in lines]
    edges = linework.noded(linework.snapped(spark.createDataFrame(rows, SCHEMA), ["m"], 0.05), ["m"], 200)
    own = [(r["m"], tuple(r["a"]), tuple(r["b"])) for r in edges.collect()]
    again = linework.noded(edges, ["m"], 333)
    assert {(r["m"], tuple(r["a"]), tuple(r["b"])) for r in again.collect()} == set(own)
    parts = linework.borders(edges, ["m"], 0.05).collect()
    for m in groups:
        lines = [(a, b) for g, a, b in own if g == m]
        head = {p: p for e in lines for p in e}

        def root(p, head=head):
            while head[p] != p:
                p = head[p]
            return p

        for a, b in lines:
            head[root(a)] = root(b)
        count = len({root(p) for p in head})
        assert sum(r["kind"] == "shell" for r in parts if r["m"] == m) == len(lines) - len(head) + count
        # what is on a face's border on one side is on another's on the other, and the rest is no border
        lengths = lambda *kinds: sum(r["length"] for r in parts if r["m"] == m and r["kind"] in kinds)
        total = 0.05 * sum(math.dist(a, b) for a, b in lines)
        assert lengths("shell", "hole") / 2 + lengths("dangle", "cut") == pytest.approx(total)
        assert sum(r["area"] for r in parts if r["m"] == m) == pytest.approx(0, abs=1e-6)


def test_no_lines(spark):
    found, figures = linework.polygonised(spark.createDataFrame([], SCHEMA), ["m"])
    assert found.count() == figures.count() == 0
