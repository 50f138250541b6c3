"""Roofs whose outline the walls bear out."""

import pytest

from strataframe.config import Massing
from strataframe.operators import contours, roofs
from test_contours import BOX, ELL, SCHEMA, tower



def strip(x0, z0, x1, z1, y=60.0):
    return [[(x0, y, z0), (x1, y, z0), (x1, y, z1)], [(x0, y, z0), (x1, y, z1), (x0, y, z1)]]


def faces(m, lists, start=0):
    return [(m, start + n, [dict(zip("xyz", map(float, p))) for p in f]) for n, f in enumerate(f for part in lists for f in part)]


def walls(m, ring, missing=(), low=0.0):
    rows = tower(m, [([ring], low, 60)], caps=False)
    return [r for r in rows if r[1] // 2 not in missing]


@pytest.fixture(scope="module")
def found(spark):
    rows = []
    # an L of three strips: the long one's side meets two, so that its edge is cut where they meet
    rows += walls(1, ELL, {0}) + faces(1, [strip(0, 0, 25, 60), strip(25, 0, 60, 10), strip(25, 10, 60, 25)], 100)
    rows += walls(2, BOX, {1}) + faces(2, [strip(0, 0, 40, 30), strip(0, 0, 40, 30)], 100)  # twice the same faces
    rows += walls(3, BOX, {1}) + faces(3, [strip(0, 0, 40, 30), strip(0, 0, 40, 30, 60.3), strip(0, 0, 40, 15, 60.2)], 100)  # faces over each other
    rows += walls(4, BOX, {1}) + faces(4, [strip(0, 0, 40, 10)], 100)  # a narrow strip along one side
    rows += walls(5, BOX, {0, 2}) + faces(5, [strip(0, 0, 40, 30)], 100)  # two walls are missing
    rows += walls(6, BOX, {0})  # no roof
    rows += walls(7, BOX, {1}) + faces(7, [strip(0, 0, 40, 30, 30.0), strip(0, 0, 8, 8)], 100)  # one too low, one too small
    rows += walls(8, BOX, {1}, low=30.0) + faces(8, [strip(0, 0, 40, 30)], 100) + [(8, 900, [{"x": 0.0, "y": 0.0, "z": 0.0}, {"x": 1.0, "y": 0.0, "z": 0.0}, {"x": 1.0, "y": 0.5, "z": 0.0}])]  # walls of the upper half only
    rows += walls(9, BOX) + faces(9, [strip(0, 0, 40, 30)], 100)  # closed: contours
    triangles = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return triangles, {r["m"]: r for r in roofs.analysed(triangles).collect()}


def test_roofs_stand_in_for_contours(found):
    _, got = found
    assert (got[1]["method"], got[2]["method"], got[9]["method"]) == ("roof", "roof", "contours")
    assert got[1]["area"] == pytest.approx(25 * 60 + 35 * 25) and len(got[1]["tiers"][0]["ring"]) == 6 and got[1]["height"] == 60 and got[1]["samples"] == 6
    assert got[2]["area"] == pytest.approx(1200) and got[2]["confidence"] == pytest.approx(0.67 + 0.18 * 100 / 140 + 0.1, abs=0.01) or got[2]["confidence"] <= 0.95
    xs, zs = zip(*((p["x"], p["z"]) for p in got[2]["tiers"][0]["ring"]))
    assert sorted((max(xs) - min(xs), max(zs) - min(zs))) == pytest.approx([30, 40]) and max(xs) == pytest.approx(-min(xs))


@pytest.mark.parametrize(("m", "reason"), [(3, roofs.NO_ROOF), (4, roofs.NO_ROOF), (5, roofs.NO_ROOF), (6, roofs.NO_BAND), (7, roofs.NO_BAND), (8, roofs.NO_ROOF)])
def test_what_is_refused(found, m, reason):
    assert found[1][m]["method"] is None and found[1][m]["reason"] == contours.GATES[3] and found[1][m]["roof_reason"] == reason


def test_reasons_of_bands(spark, found):
    models = spark.createDataFrame([(m, 0.0, 60.0) for m in range(1, 10)], "m long, y0 double, y1 double")
    _, rows = roofs.roof_plans(found[0], models, Massing())
    why = {}
    for r in rows.collect():
        why.setdefault(r["m"], set()).add(r["reason"])
    assert why[1] == {None} and why[3] <= {roofs.MANIFOLD, roofs.LOOSE} and why[5] <= {roofs.LACKING, roofs.EDGES} and why[8] <= {roofs.LACKING, roofs.EDGES} and why[4] <= {roofs.LACKING, roofs.EDGES, roofs.TINY}
    assert 6 not in why and 7 not in why


def test_no_models(spark):
    assert roofs.analysed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_roofs_of_stitched_parts(spark):
    """Two halves of a box without one wall, each with its half of the roof: the cluster's roof stands in for its contours."""
    from strataframe.operators import tracks

    left, right = [(0, 0), (40, 0), (40, 30), (0, 30)], [(40, 0), (80, 0), (80, 30), (40, 30)]
    rows = walls(1, left, {0, 1}) + faces(1, [strip(0, 0, 40, 30)], 100) + walls(2, right, {3}) + faces(2, [strip(40, 0, 80, 30)], 100)
    triangles = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("m", "id")
    parts = spark.createDataFrame([(1, 1, "a", 0.0, 40.0, 0.0, 60.0, 0.0, 30.0), (2, 2, "b", 40.0, 80.0, 0.0, 60.0, 0.0, 30.0), (3, 3, "c", 900.0, 940.0, 0.0, 60.0, 0.0, 30.0)], "id long, source long, key string, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double")
    got = {r["cluster"]: r for r in tracks.stitched(triangles, parts).collect()}
    assert (got[1]["method"], got[1]["n"], got[1]["reason"]) == ("roof", 2, None) and got[1]["area"] == pytest.approx(2400) and got[1]["key"].startswith("Global2_")
    assert got[3]["reason"] == tracks.CLUSTER[0]
