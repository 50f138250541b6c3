"""Sections whose gaps close by the directions of their ends, and those that stay open."""

import math
import random

import pytest

from strataframe.functions import outline
from strataframe.functions import polygons as P
from strataframe.operators import sections

SCHEMA = "m long, a struct<x:double,z:double>, b struct<x:double,z:double>"


def path(*points):
    return [((float(a[0]), float(a[1])), (float(b[0]), float(b[1]))) for a, b in zip(points, points[1:])]


def turned(lines, angle):
    c, s = math.cos(angle), math.sin(angle)
    return [tuple((x * c - z * s + 3, x * s + z * c - 7) for x, z in line) for line in lines]


OPEN = {
    "straight": path((18, 0), (20, 0), (20, 20), (0, 20), (0, 0), (15.5, 0)),
    "too long": path((19, 0), (20, 0), (20, 20), (0, 20), (0, 0), (15.5, 0)),
    "bent ends": path((18, 0.5), (20, 0), (20, 20), (0, 20), (0, 0), (16, 0)),
    "beside": path((17, 0.7), (20, 0.7), (20, 20), (0, 20), (0, 0), (16, 0)),
    "corner": path((0, 2), (0, 20), (20, 20), (20, 0), (2, 0)),
    "far corner": path((0, 3.5), (0, 20), (20, 20), (20, 0), (1, 0)),
    "blocked corner": [*path((0, 2), (0, 20), (20, 20), (20, 0), (2, 0)), *path((0.2, 0.6), (0.6, 0.2), (-4, -4), (0.2, 0.6))],
    "two seams": [*path((8, 0), (0, 0), (0, 20), (8, 20)), *path((10, 20), (20, 20), (20, 0), (10, 0))],
}


@pytest.mark.parametrize("angle", [0.0, 0.4, 2.0])
def test_gaps(angle):
    found = {n: outline.section_loops(turned(lines, angle), outline.OutlineParams()) for n, lines in OPEN.items()}
    areas = {n: round(abs(P.signed_area(f["loops"][0])), 4) if f["loops"] else f["reason"] for n, f in found.items()}
    assert areas["straight"] == 400 and (found["straight"]["seams"], found["straight"]["corners"], found["straight"]["open"]) == (1, 0, 2)
    assert areas["corner"] == 400 and found["corner"]["corners"] == 1
    assert areas["two seams"] == 400 and found["two seams"]["seams"] == 2 and found["two seams"]["open"] == 4
    for n in ("too long", "beside", "far corner", "blocked corner"):
        assert areas[n] == "open cross-section", n


def test_ends_of_short_runs_are_not_lengthened_far():
    """Up to three in any case; beyond, by a share of the straight run, whose segments may be many."""
    p = outline.OutlineParams(corner_gap=9, corner_reach=6)
    long = [(x, 0.0) for x in range(4, 41, 4)]
    lines = path((0, 4), (0, 40), (40, 40), *reversed(long))
    assert outline.section_loops(lines, p)["corners"] == 1  # 36 back from the ends: 5.4 at most
    kinked = path((0, 4), (0, 40), (40, 40), (40, 8), (12, 1), (8, 0), (4, 0))
    assert outline.section_loops(kinked, p)["reason"] == "open cross-section"  # only 8 or so straight


def test_ambiguous_ends_are_refused():
    """Three ends about one gap: the nearest two may not be each other's nearest."""
    lines = [*path((10, 0), (0, 0), (0, 20), (20, 20), (20, 0), (12, 0)), *path((11, 1.5), (11, 9))]
    found = outline.section_loops(lines, outline.OutlineParams())
    assert found["reason"] == "open cross-section" and found["open"] == 4
    by_part = outline.section_loops(lines, outline.OutlineParams(each=True))
    assert len(by_part["loops"]) == 1 and by_part["invalid"] == 1


def test_parts_one_by_one():
    square = path((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    spur = path((10, 0), (14, 0), (14, 4), (10, 4), (10, 0), (8, -2))
    p = outline.OutlineParams(each=True)
    found = outline.section_loops([*square, *spur], p)
    assert len(found["loops"]) == 1 and found["invalid"] == 1 and found["branches"] == 1
    assert outline.section_loops([*square, *spur], outline.OutlineParams())["reason"] == "branched cross-section"
    assert outline.section_loops(spur, p)["reason"] == "no independently enclosed cross-section"
    assert outline.section_loops([], p)["reason"] == "no cross-section"


def test_outlines_by_group(spark):
    """Groups of any size in any order of rows; loops in and beside the largest."""
    ring = lambda x, z, a: path((x, z), (x + a, z), (x + a, z + a), (x, z + a), (x, z))
    groups = {1: ring(0, 0, 20), 2: [*ring(0, 0, 20), *ring(5, 5, 3)], 3: [*ring(0, 0, 20), *ring(30, 0, 9)], 4: [*ring(0, 0, 20), *ring(30, 0, 2)], 5: [*ring(0, 0, 40), *ring(5, 5, 4), *ring(12, 5, 4), *ring(20, 5, 6)], 6: path((0, 0), (9, 0)), 8: [*ring(0, 0, 20), *ring(5, 5, 6)]}
    for m in range(20, 220):
        groups[m] = ring(0, 0, m)
    rows = [(m, dict(zip("xz", a)), dict(zip("xz", b))) for m, lines in groups.items() for a, b in lines] + [(7, None, {"x": 1.0, "z": 1.0}), (7, {"x": 1.0, "z": 1.0}, None)]
    random.Random(3).shuffle(rows)
    segments = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = sections.mended_loops(segments, ["m"])
    plain = {r["m"]: r for r in sections.outlines(found, ["m"]).collect()}
    roof = {r["m"]: r for r in sections.outlines(found, ["m"], holes=True).collect()}
    assert set(plain) == set(groups) | {7}
    assert [plain[m]["reason"] for m in (1, 2, 3, 4, 6, 7)] == [None, sections.ALONE[0], sections.ALONE[2], None, "no cross-section", "no cross-section"]
    assert roof[2]["reason"] is None and (roof[2]["holes"], roof[2]["hole_area"]) == (1, 9) and roof[8]["reason"] == sections.ALONE[1] and roof[5]["reason"] == sections.ALONE[3]
    assert all(plain[m]["area"] == m * m for m in range(20, 220))


def test_no_sections(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sections.mended_loops(none, ["m"]).count() == sections.outlines(sections.mended_loops(none, ["m"]), ["m"]).count() == sections.loops(none, ["m"], 0.1).count() == 0


def test_ends_as_near_as_the_weld():
    """A corner cut by as much as the weld is closed and keeps both its ends, also where rounding lengthens the cut."""
    for cut, area in (((0.0, 0.6), 2000), ((0.1, 0.3), 2000 - 0.015), ((0.36, 0.48), 2000 - 0.0864)):
        x, z = cut
        for low in (z, 40 + (z - 40) * 3 / 3 + 1e-15):
            found = outline.section_loops(path((x, 0), (50, 0), (50, 40), (0, 40), (0, low)), outline.OutlineParams())
            assert (found["open"], found["corners"], found["reason"]) == (0, 0, None) and abs(P.signed_area(found["loops"][0])) == pytest.approx(area, abs=1e-6)


def test_vertices_are_not_broadcast(spark, tmp_path):
    """A small file of vertices can hold millions of rows in memory."""
    from strataframe.operators import sections

    spark.range(3000).selectExpr("id % 2 AS mesh", "id", "0D AS x", "CAST(id AS DOUBLE) AS y", "1D AS z").write.parquet(f"{tmp_path}/v")
    spark.range(1000).selectExpr("id % 2 AS mesh", "id AS a", "id + 2 AS b", "id + 4 AS c").write.parquet(f"{tmp_path}/f")
    found = sections.triangles(spark.read.parquet(f"{tmp_path}/v"), spark.read.parquet(f"{tmp_path}/f"))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 1000


def test_tracks_whose_ends_lie_at_the_weld(spark, tmp_path):
    """Suppliers of which a sample's segments end at the weld's length apart, but for rounding: their tracks lost that sample."""
    import duckdb

    from strataframe.plans import tracks

    duckdb.sql(f"COPY (SELECT unnest([1991, 4135, 5983])::BIGINT AS s_suppkey) TO '{tmp_path}/supplier.parquet' (FORMAT parquet)")
    found = tracks.track_verdicts(spark, str(tmp_path))
    sql = tracks.VERDICT_SQL.replace("FROM supplier", f"FROM '{tmp_path}/supplier.parquet'")
    columns = ["m", "samples", "area", "base", "top", "confidence", "reason", "volume", "complete"]
    wanted = duckdb.sql(sql)
    place = [wanted.columns.index(c) for c in columns]
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(str(tuple(r[k] for k in place)) for r in wanted.fetchall())
