"""Boxes from slices, and walks that accept what is free."""

import math
import random

import numpy as np
import pytest

from strataframe.functions import outline
from strataframe.operators import boxes, select
from test_contours import BOX, ELL, SCHEMA, moved, tower


def test_walks_by_rank(spark):
    """Random conflicts, repeated and with themselves, against the walk itself."""
    rng = random.Random(6)
    for n, m in ((1, 0), (40, 30), (60, 400), (80, 79)):
        ranks = rng.sample(range(1000), n)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 79 else [(k, k + 1) for k in range(79)]
        items = spark.createDataFrame([(k, r, "x") for k, r in enumerate(ranks)], "id int, rank int, v string")
        found = select.accepted(items, "id", "rank", spark.createDataFrame([*pairs, *pairs[:3]], "a int, b int") if pairs else spark.createDataFrame([], "a int, b int"))
        taken: set[int] = set()
        for k in sorted(range(n), key=lambda k: ranks[k]):
            if not any((a == k and b in taken) or (b == k and a in taken) for a, b in pairs if a != b):
                taken.add(k)
        assert {r["id"] for r in found.collect()} == taken and found.columns == ["id", "rank", "v"]


def test_hulls_that_facades_bear_out():
    def lines(ring, parts=10, skip=()):
        own = [(np.array(p) + (np.array(q) - p) * k / parts, np.array(p) + (np.array(q) - p) * (k + 1) / parts) for p, q in zip(ring, ring[1:] + ring[:1]) for k in range(parts)]
        own = [s for k, s in enumerate(own) if k not in skip]
        return np.array([a for a, _ in own], float), np.array([b for _, b in own], float)

    box = [(0.0, 0.0), (50.0, 0.0), (50.0, 40.0), (0.0, 40.0)]
    turned = [(x * math.cos(0.4) - z * math.sin(0.4), x * math.sin(0.4) + z * math.cos(0.4)) for x, z in box]
    for ring in (box, turned):
        assert outline.facade_hull(*lines(ring)) and not outline.facade_hull(*lines(ring, skip=(3,)))  # a tenth of a side
    assert outline.facade_hull(*lines([(float(x), float(z)) for x, z in ELL])) is None  # its hull is no box
    a, b = lines(box)
    assert outline.facade_hull(np.vstack([a, [[5, 5]]]), np.vstack([b, [[9, 9]]])) and outline.facade_hull(np.vstack([a, [[5, 5]]]), np.vstack([b, [[30, 30]]])) is None
    assert outline.facade_hull(np.zeros((2, 2)), np.ones((2, 2))) is None


def test_kinds_of_models(spark):
    cases = {
        "box": [([BOX], 0, 60)], "low": [([BOX], 0, 30)], "ell": [([ELL], 0, 60)], "set back": [([BOX], 0, 30), ([moved(BOX, 0, 0, 0.2)], 30, 60)], "shifted": [([BOX], 0, 20), ([moved(BOX, 1.5)], 20, 60)],
        "two": [([BOX, moved(BOX, 90)], 0, 60)], "narrow": [([[(0, 0), (60, 0), (60, 15), (0, 15)]], 0, 60)], "tiny": [([[(0, 0), (24, 0), (24, 21), (0, 21)]], 0, 60)],
    }
    names = list(cases)
    rows = [r for m, n in enumerate(names) for r in tower(m, cases[n])]
    found = boxes.classified(spark.createDataFrame(rows, SCHEMA).repartition(3).select("m", "points"))
    got = {names[r["m"]]: r for r in found.collect()}
    assert {n: r["reason"] for n, r in got.items()} == {"box": None, "low": "small", "ell": "non rectangular", "set back": "non rectangular", "shifted": "changing footprint", "two": "open or disconnected", "narrow": "size", "tiny": "small footprint"}
    one = got["box"]
    assert sorted((one["width"], one["depth"])) == pytest.approx([30, 40]) and (one["x"], one["z"]) == pytest.approx((20, 15)) and one["confidence"] == pytest.approx(1)
    tops = lambda *rows: spark.createDataFrame(list(rows), "x0 double, x1 double, z0 double, z1 double, y1 double")
    why = lambda *rows: {names[r["m"]]: (r["reason"], r["base"]) for r in boxes.grounded(found.filter("reason IS NULL"), tops(*rows)).collect()}["box"]
    assert why((-9.0, 99.0, -9.0, 99.0, -3.0)) == (None, -3.0) and why((500.0, 600.0, 0.0, 1.0, 0.0))[0] == boxes.GROUND[0] and why((-9.0, 99.0, -9.0, 99.0, -70.0))[0] == boxes.GROUND[1] and why((-9.0, 99.0, -9.0, 99.0, 16.0))[0] == boxes.GROUND[1]
    assert why((-9.0, 99.0, -9.0, 99.0, -3.0), (30.0, 99.0, -9.0, 99.0, 2.0))[0] == boxes.GROUND[2] and why((5.0, 99.0, -9.0, 99.0, -3.0))[0] == boxes.GROUND[2]


def test_no_boxes(spark):
    none = boxes.grounded(boxes.classified(spark.createDataFrame([], SCHEMA).select("m", "points")), spark.createDataFrame([], "x0 double, x1 double, z0 double, z1 double, y1 double"))
    assert boxes.clear(none, none.select("ring")).count() == 0


def test_sides_at_the_bound(spark):
    """A box as narrow as may be is a building at whatever angle it stands."""
    turned = lambda a: [(x * math.cos(a) - z * math.sin(a), x * math.sin(a) + z * math.cos(a)) for x, z in ((0, 0), (65, 0), (65, 20), (0, 20))]
    frame = spark.createDataFrame([r for m in range(40) for r in tower(m, [([turned(0.02 * m + 0.007)], 0, 40)])], SCHEMA)
    assert [r["m"] for r in boxes.classified(frame.select("m", "points")).filter("reason IS NOT NULL").collect()] == []
