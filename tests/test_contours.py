"""Buildings from contours: setbacks, roofs, courtyards, boxes from facades, and what is refused."""

import math

import numpy as np
import pytest

from strataframe.functions import outline
from strataframe.operators import contours, sections

SCHEMA = "m long, t long, points array<struct<x:double,y:double,z:double>>"
BOX = [(0, 0), (40, 0), (40, 30), (0, 30)]
ELL = [(0, 0), (60, 0), (60, 25), (25, 25), (25, 60), (0, 60)]


def moved(ring, dx, dz=0.0, inset=0.0):
    xs, zs = zip(*ring)
    mx, mz = (min(xs) + max(xs)) / 2, (min(zs) + max(zs)) / 2
    return [(mx + (x - mx) * (1 - inset) + dx, mz + (z - mz) * (1 - inset) + dz) for x, z in ring]


def tower(m, levels, caps=True):
    """Triangles of prisms: levels are (rings, low, high); the first ring of each is capped at its top by a fan."""
    faces = []
    for rings, low, high in levels:
        for ring in rings:
            for (x, z), (u, w) in zip(ring, ring[1:] + ring[:1]):
                faces += [[(x, low, z), (u, low, w), (u, high, w)], [(x, low, z), (u, high, w), (x, high, z)]]
        if caps:
            a = rings[0][0]
            faces += [[(a[0], high, a[1]), (p[0], high, p[1]), (q[0], high, q[1])] for p, q in zip(rings[0][1:], rings[0][2:])]
    return [(m, n, [dict(zip("xyz", map(float, p))) for p in f]) for n, f in enumerate(faces)]


@pytest.fixture(scope="module")
def plans(spark):
    inner, beside = [(10, 10), (20, 10), (20, 20), (10, 20)], moved(BOX, 60)
    cases = {
        "plain": [([BOX], 0, 100)], "set back": [([BOX], 0, 50), ([moved(BOX, 0, 0, 0.3)], 50, 100)], "ell": [([ELL], 0, 80)], "courtyard": [([BOX, inner], 0, 100)], "two": [([BOX, beside], 0, 100)],
        "short": [([BOX], 0, 20)], "offset": [([BOX], 0, 50), ([moved(BOX, 15)], 50, 100)], "wider": [([moved(BOX, 0, 0, 0.3)], 0, 50), ([BOX], 50, 100)], "back again": [([BOX], 0, 40), ([moved(BOX, 0, 0, 0.3)], 40, 70), ([BOX], 70, 100)],
        "equipment": [([BOX], 0, 84), ([moved(BOX, 0, 0, 0.6)], 84, 100)], "antenna": [([BOX], 0, 92), ([[(18, 14), (20, 14), (20, 16), (18, 16)]], 92, 100)], "small": [([[(0, 0), (8, 0), (8, 9), (0, 9)]], 0, 60)],
    }
    names = list(cases)
    rows = [r for m, n in enumerate(names) for r in tower(m, cases[n])]
    rows += [(50, 0, [{"x": 0.0, "y": 0.0, "z": 0.0}] * 3), (51, 0, [{"x": None, "y": 0.0, "z": 0.0}] * 3)]
    # without caps no plane tells where the setback is
    rows += tower(60, cases["set back"], caps=False)
    found = contours.contour_plans(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    return {(names[r["m"]] if r["m"] < len(names) else r["m"]): r for r in found}


def test_tiers(plans):
    spans = lambda n: [(round(t["bottom"], 3), round(t["top"], 3), len(t["ring"])) for t in plans[n]["tiers"]]
    assert spans("plain") == [(0, 100, 4)] and plans["plain"]["area"] == pytest.approx(1200) and plans["plain"]["samples"] == 11 and plans["plain"]["confidence"] == pytest.approx(0.52 + 0.35 + 0.13 * 0.945 - 0.003 * plans["plain"]["repaired"])
    assert spans("set back") == [(0, 50, 4), (50, 100, 4)] and spans("ell") == [(0, 80, 6)]
    assert spans("antenna") == [(0, 92, 4)] and plans["antenna"]["roof_trim"] == pytest.approx(8)
    assert spans("equipment") == [(0, 84, 4)]
    bare = plans[60]["tiers"]
    assert bare[0]["top"] == pytest.approx(50, abs=0.2) and bare[0]["top"] != 50
    # in the frame, the middle of the base's box is at 0, and its first side lies along x
    for n in ("plain", "set back"):
        xs, zs = zip(*((p["x"], p["z"]) for p in plans[n]["tiers"][0]["ring"]))
        assert (max(xs), max(zs)) == (pytest.approx(-min(xs)), pytest.approx(-min(zs))) and sorted((2 * max(xs), 2 * max(zs))) == pytest.approx([30, 40])
        assert (plans[n]["at"]["x"], plans[n]["at"]["y"], plans[n]["at"]["z"]) == pytest.approx((20, 0, 15))


@pytest.mark.parametrize(
    ("name", "reason"),
    [("courtyard", sections.ALONE[0]), ("two", sections.ALONE[2]), ("short", contours.GATES[1]), ("offset", contours.TIER[0]), ("wider", contours.TIER[0]), ("back again", contours.GATES[5]), ("small", contours.GATES[3]), (50, contours.GATES[0])],
)
def test_what_is_refused(plans, name, reason):
    assert plans[name]["reason"] == reason and plans[name]["tiers"] is None
    assert 51 not in plans  # a model of nothing but nulls


def test_boxes_from_facades():
    def box(w, d, angle, drop=0, extra=()):
        c, s = math.cos(angle), math.sin(angle)
        corners = [(x * c - z * s, x * s + z * c) for x, z in ((0, 0), (w, 0), (w, d), (0, d))]
        lines = []
        for p, q in zip(corners, corners[1:] + corners[:1]):
            cuts = np.linspace(0, 1, 21)
            lines += [((p[0] + (q[0] - p[0]) * t, p[1] + (q[1] - p[1]) * t), (p[0] + (q[0] - p[0]) * u, p[1] + (q[1] - p[1]) * u)) for t, u in zip(cuts, cuts[1:])]
        lines = lines[drop:] + list(extra)
        return np.array([a for a, _ in lines]), np.array([b for _, b in lines])

    for angle in (0.0, 0.3, 1.2):
        ring = outline.facade_box(*box(40, 30, angle), 1.2)
        assert abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2 == pytest.approx(1200, rel=1e-6)
    assert outline.facade_box(*box(100, 30, 0.2, drop=0, extra=[((40, 20), (41, 20))]), 1.2) is not None  # a little inside
    assert outline.facade_box(*box(40, 30, 0.2, drop=1), 1.2) is None  # a twentieth of a side is missing
    assert outline.facade_box(*box(40, 30, 0.0, extra=[((5, 5), (30, 20))]), 1.2) is None  # too much inside
    assert outline.facade_box(np.zeros((3, 2)), np.full((3, 2), 0.1), 1.2) is None


def test_open_sections_may_be_boxes(spark):
    """A side that ends short of its corner by more than a seam, with a spur: open, but all sides are covered."""
    ring = [(0, 0), (200, 0), (200, 100), (0, 100)]
    rows = [r for r in tower(1, [([ring], 0, 50)])]
    rows += [(1, 100 + n, [dict(zip("xyz", map(float, p))) for p in f]) for n, f in enumerate([[(50, 0, 1), (60, 0, 1), (60, 50, 1)], [(50, 0, 1), (60, 50, 1), (50, 50, 1)]])]
    found = contours.sampled(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, 20.0), (1, 70.0), (2, 20.0)], "m long, y double")).collect()
    got = {(r["m"], r["y"]): r for r in found}
    assert got[1, 20.0]["fallback"] and got[1, 20.0]["foot"]["area"] == pytest.approx(20000)
    assert got[1, 70.0]["reason"] == got[2, 20.0]["reason"] == "no cross-section"


def test_of_two_planes_as_near_the_upper_is_the_setback(spark):
    """A tier with one sample lies between two that persist; the planes below and above it are as far from the middle of the search."""
    ring = lambda s: [(-32.5 + s, -35.5 + s), (32.5 - s, -35.5 + s), (32.5 - s, 35.5 - s), (-32.5 + s, 35.5 - s)]
    rows = tower(1, [([ring(0)], 5, 73), ([ring(3)], 73, 84), ([ring(7)], 84, 110)])
    got = contours.contour_plans(spark.createDataFrame(rows, SCHEMA)).first()
    assert [(t["bottom"], t["top"]) for t in got["tiers"]] == [(0, 79), (79, 105)]
