"""Whole floors to buildings: what persists becomes tiers, what is ambiguous is refused with its reason."""

import re

import numpy as np
import pytest

from strataframe.config import RESIDUAL_GRID, GridMassing, configured
from strataframe.operators import masks, massing

SIDE, CELL, SIZE = 20, 3.0, (60.0, 110.0, 60.0)


def floor(*boxes):
    grid = np.zeros((SIDE, SIDE), bool)
    for i0, i1, j0, j1 in boxes:
        grid[i0:i1, j0:j1] = True
    return grid


WIDE, SLIM, LOW = floor((1, 19, 1, 19)), floor((4, 16, 4, 16)), floor((0, 10, 0, 20))
ELL = floor((1, 19, 1, 10), (1, 10, 1, 19))
YARD = WIDE & ~floor((8, 12, 8, 12))
DOT = WIDE & ~floor((9, 10, 9, 10))
TWO = floor((1, 9, 1, 19), (11, 19, 1, 19))
SPECK = WIDE & ~floor((0, 20, 17, 19)) | floor((18, 19, 18, 19))


FLOOR_PITCH = 12.5 + 1.5 / 0.28
CASES = {
    "plain": [WIDE] * 6, "set back": [WIDE] * 3 + [SLIM] * 3, "ell": [ELL] * 6, "dot": [DOT] * 6, "speck": [SPECK] * 6, "bridged": [WIDE, WIDE, floor(), WIDE, WIDE, WIDE], "near": [WIDE, WIDE, WIDE & ~floor((1, 2, 1, 19)), WIDE, WIDE, WIDE],
    "too few": [WIDE] * 2, "courtyard": [YARD] * 6, "disconnected": [TWO] * 6, "ground floor": [floor()] + [WIDE] * 5, "repeated": [WIDE, SLIM, LOW, ELL, WIDE, SLIM], "expanding|envelope": [SLIM] * 3 + [WIDE] * 3,
    "oscillating": [WIDE] * 3 + [SLIM] * 3 + [WIDE] * 2, "offset": [WIDE] * 3 + [LOW] * 3, "envelope": [SLIM] * 6, "interior|coverage": [WIDE] * 4 + [floor()] * 2 + [WIDE], "upper": [WIDE] * 5 + [ELL], "coverage": [WIDE] * 3 + [floor()] * 3,
    "disconnected|touching": [floor((0, 10, 0, 10), (10, 20, 10, 20))] * 6,
}
GOOD = ("plain", "set back", "ell", "dot", "speck", "bridged", "near")
FIELDS = "m long, cell double, size_x double, size_y double, size_z double, ground double, upper double, floors int"


def planned(spark, cases, options=None, height=110.0):
    names = list(cases)
    cells = [(m, k + 1, int(i) + 1, int(j) + 1) for m, name in enumerate(names) for k, g in enumerate(cases[name]) for i, j in np.argwhere(g)]
    models = spark.createDataFrame([(m, CELL, SIZE[0], height(n) if callable(height) else height, SIZE[2], 15.0, 12.5, len(cases[n])) for m, n in enumerate(names)], FIELDS)
    found = massing.grid_plans(spark.createDataFrame(cells, "m long, k int, i int, j int"), models, SIDE, configured(GridMassing, options)).collect()
    return {names[r["m"]]: r for r in found}


@pytest.fixture(scope="module")
def plans(spark):
    return planned(spark, CASES)


def test_one_body_and_setbacks(plans):
    plain = plans["plain"]
    assert len(plain["tiers"]) == 1 and plain["area"] == pytest.approx(54 * 54) and len(plain["tiers"][0]["ring"]) == 4 and plain["confidence"] == pytest.approx(0.8)
    set_back = plans["set back"]["tiers"]
    assert [len(t["ring"]) for t in set_back] == [4, 4] and set_back[0]["top"] == set_back[1]["bottom"]
    assert len(plans["ell"]["tiers"][0]["ring"]) == 6
    assert plans["dot"]["area"] == pytest.approx(54 * 54) and plans["dot"]["evidence"]["filled_hole_area"] == pytest.approx(54)
    assert plans["speck"]["evidence"]["removed_island_area"] == pytest.approx(54) and plans["speck"]["evidence"]["cleanup_floors"] == 6
    assert len(plans["bridged"]["tiers"]) == 1 and plans["bridged"]["evidence"]["bridged_missing_floors"] == 1 and plans["bridged"]["evidence"]["valid_floors"] == 5
    assert plans["near"]["evidence"]["regularized_floors"] == 1 and plans["near"]["evidence"]["max_regularized_area_change"] == pytest.approx(18 / 17 - 1)
    assert all(plans[n]["reason"] is None for n in GOOD)


@pytest.mark.parametrize("why", [n for n in CASES if n not in GOOD])
def test_what_is_refused(plans, why):
    assert re.search(why, plans[why]["reason"]) and plans[why]["tiers"] is None and plans[why]["evidence"] is None


def test_relaxed_options_take_more(spark):
    assert planned(spark, {"slim": [floor((2, 18, 2, 18))] * 6}, RESIDUAL_GRID)["slim"]["tiers"]


def test_fixtures_of_twenty_by_twenty(spark):
    """Thirteen kinds of floors, of which six become buildings."""
    of = lambda f: np.array([[f(i, j) for j in range(1, 21)] for i in range(1, 21)])
    full = of(lambda i, j: True)
    cases = {
        "rectangle": [full] * 5, "diagonal": [of(lambda i, j: i + j <= 21)] * 5, "large_L": [of(lambda i, j: i <= 10 or j <= 8)] * 5, "short_majority": [full, full, of(lambda i, j: i <= 17)], "partial_half": [of(lambda i, j: i <= 10)] * 5,
        "disconnected": [of(lambda i, j: i <= 5 or i >= 16)] * 5, "courtyard": [of(lambda i, j: not (8 <= i <= 12 and 8 <= j <= 12))] * 5, "unsupported_middle": [full, full, of(lambda i, j: i <= 10), full, full],
        "tiny_island": [of(lambda i, j: i <= 18 or (i == 20 and j == 10))] * 5, "tiny_hole": [of(lambda i, j: not (i == 10 and j == 10))] * 5, "slender_second_body": [of(lambda i, j: i <= 18 or (i == 20 and 8 <= j <= 13))] * 5,
        "small_courtyard": [of(lambda i, j: not (9 <= i <= 10 and 9 <= j <= 10))] * 5,
    }
    got = planned(spark, cases, height=lambda n: len(cases[n]) * FLOOR_PITCH + 1.5 / 0.28)
    assert {n for n, r in got.items() if r["reason"] is None} == {"rectangle", "diagonal", "large_L", "short_majority", "tiny_island", "tiny_hole"}
    ring = lambda n: [(p["x"], p["z"]) for p in got[n]["tiers"][0]["ring"]]
    assert len(ring("rectangle")) == len(ring("tiny_island")) == len(ring("tiny_hole")) == 4 and len(ring("diagonal")) <= 6 and len(ring("large_L")) >= 6
    assert any(abs(a[0] - b[0]) > 10 and abs(a[1] - b[1]) > 10 for a, b in zip(ring("diagonal"), ring("diagonal")[1:] + ring("diagonal")[:1]))
    assert got["large_L"]["area"] == pytest.approx(2520) and got["tiny_island"]["evidence"]["removed_island_area"] == pytest.approx(45) and got["tiny_hole"]["evidence"]["filled_hole_area"] == pytest.approx(45)


def test_plans_of_models(spark):
    cells = [(m, k + 1, int(i) + 1, int(j) + 1) for m, floors in ((1, [WIDE] * 6), (2, [YARD] * 6)) for k, g in enumerate(floors) for i, j in np.argwhere(g)]
    models = spark.createDataFrame([(m, CELL, *SIZE, 15.0, 12.5, 6) for m in (1, 2, 3)], "m long, cell double, size_x double, size_y double, size_z double, ground double, upper double, floors int")
    got = {r["m"]: r for r in massing.grid_plans(spark.createDataFrame(cells, "m long, k int, i int, j int"), models, SIDE).collect()}
    assert len(got[1]["tiers"]) == 1 and got[1]["reason"] is None and "courtyard" in got[2]["reason"] and got[3]["reason"] == "ground floor is not a complete usable body"


def test_splits_and_residuals(spark):
    """Two towers on their own, two on a podium, and a tower with a speck beside it."""
    tower = [(1, 9, 1, 19), (11, 19, 1, 19)]
    models = {1: [floor(*tower)] * 6, 2: [floor((1, 19, 1, 19))] * 3 + [floor(*tower)] * 4, 3: [floor(tower[0])] * 6, 4: [floor(*tower) | floor((0, 1, 0, 1))] + [floor(*tower)] * 5}
    cells = spark.createDataFrame([(m, k + 1, int(i) + 1, int(j) + 1) for m, floors in models.items() for k, g in enumerate(floors) for i, j in np.argwhere(g)], "m long, k int, i int, j int")
    frames = spark.createDataFrame([(m, CELL, 60.0, 130.0, 60.0, 15.0, 12.5, len(f)) for m, f in models.items()], "m long, cell double, size_x double, size_y double, size_z double, ground double, upper double, floors int")
    got = massing.split_plans(cells, frames, SIDE).collect()
    why = {r["m"]: r["source_reason"] for r in got}
    assert why[1] is None and why[3] == "one body only" and why[2] == "one body only" and why[4] is None
    assert sorted(r["area"] for r in got if r["m"] == 1) == [pytest.approx(24 * 54)] * 2 and sum(r["tiny"] for r in got) == 1
    accepted, rest = massing.residual_plans(cells, frames, SIDE)
    taken = {(r["m"], r["first"]): r["cells"] for r in accepted.orderBy("m").collect()}
    assert taken[2, 1] == 3 * 18 * 18 and taken[2, 4] == 4 * 8 * 18
    assert sum(r["cells"] for r in accepted.collect()) + rest.count() == cells.count() and rest.count() == 1


def test_cells_are_labelled_without_joins(spark):
    """A table of cells is small on disk and large in memory, so that Spark broadcasts it where cells are joined with cells."""
    cells = spark.createDataFrame([(m, k, i, j) for m in (1, 2) for k in (1, 2, 4) for i in range(1, 6) for j in range(1, 6) if (i, j) != (3, 3) or k == 1], "m long, k int, i int, j int")
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(masks.chains(cells, SIDE)) == 0
    got = masks.bodies(cells, SIDE, "chain").groupBy("m", "body").count().collect()
    assert sorted(r["count"] for r in got) == [24, 24, 49, 49] and {r["m"] for r in got} == {1, 2}


def test_holes_are_found_without_joins(spark):
    cells = spark.createDataFrame([(1, k, i, j) for k in (1, 2) for i in range(2, 6) for j in range(2, 6) if (i, j) != (3, 3) or k == 1], "m long, k int, i int, j int")
    found = masks.holes(cells, SIDE)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 0
    assert [tuple(r) for r in found.filter("NOT outside").select("m", "k", "i", "j").collect()] == [(1, 2, 3, 3)] and found.count() == 2 * 400 - 31


def test_floors_are_compared_without_a_join_of_cells(spark):
    cells = spark.createDataFrame([(1, k, i, j) for k in (1, 2, 3) for i in range(1, 5) for j in range(1, 6 - k)], "m long, k int, i int, j int")
    found = masks.floor_jaccard(cells)
    # the two joins are those with the floors' sizes
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2, 0.75), (1, 1, 3, 0.5), (1, 2, 3, 2 / 3)]


def test_bodies_with_large_numbers(spark):
    """A body's number is its model's times PER_MODEL, so that of a cell in the grid of a body would exceed 64 bits."""
    cells = spark.createDataFrame([(m, k, i, j) for m in (7, 200_000) for k in range(1, 5) for i in range(1, 21) for j in range(1, 19) if i != 10 and (i, j) != (5, 5)], "m long, k int, i int, j int")
    models = spark.createDataFrame([(m, CELL, SIZE[0], 80.0, SIZE[2], 15.0, 12.5, 4) for m in (7, 200_000)], FIELDS)
    rows = massing.split_plans(cells, models, SIDE).select("m", "cells", "area", "reason", "source_reason").orderBy("m", "cells").collect()
    assert [tuple(r)[1:] for r in rows[:2]] == [tuple(r)[1:] for r in rows[2:]] == [(644, 27 * 54.0, None, None), (720, 30 * 54.0, None, None)] and rows[-1]["m"] == 200_000


def test_the_largest_rectangle_costs_no_call_for_each_height(monkeypatch):
    """Of equal rectangles that whose lower right corner comes first by rows, then the widest; no array is made for a height."""
    def plain(grid):
        r, c = grid.shape
        boxes = [(a, b, d, e) for a in range(r) for b in range(a, r) for d in range(c) for e in range(d, c) if grid[a : b + 1, d : e + 1].all()]
        return max(boxes, key=lambda q: ((q[1] - q[0] + 1) * (q[3] - q[2] + 1), -q[1], -q[3], q[3] - q[2]), default=(0, 0, 0, 0))

    rng = np.random.default_rng(3)
    grids = [rng.random(rng.integers(1, 7, 2)) < share for share in (0.4, 0.7, 0.95) for _ in range(60)]
    want = [plain(g) for g in grids]
    monkeypatch.setattr(np, "unique", None)
    assert [masks.largest_rectangle(g) for g in grids] == want
