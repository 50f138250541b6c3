"""Sections of meshes: triangles cut by level planes, the segments' ends by degree, and closed loops."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import outline, polygons, rings
from strataframe.functions.outline import OutlineParams
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.spatial import section

C = F.col


def triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """mesh and points (array of three struct<x, y, z>) of each face; faces with a vertex that is missing are left out. Vertices are many, however small their file, and are not broadcast."""
    rows = faces.select("mesh", *(C(c).cast("long").alias(c) for c in "abc"))
    for c in "abc":
        rows = rows.join(vertices.select("mesh", C("id").cast("long").alias(c), F.struct("x", "y", "z").alias(f"p{c}")).hint("merge"), ["mesh", c])
    return rows.select("mesh", F.array("pa", "pb", "pc").alias("points"))


def at_heights(rows: DataFrame, heights: Column, least: float = 1e-5) -> DataFrame:
    """rows (with points) cut at each height: the other columns, y, and the ends a and b of each segment longer than least."""
    y = lambda f: f(F.transform("points", lambda p: p["y"]))
    cut = rows.withColumn("y", F.explode(heights)).filter((y(F.array_min) <= C("y")) & (y(F.array_max) > C("y"))).withColumn("s", section(C("points"), C("y"))).filter("s IS NOT NULL")
    long = F.hypot(C("s")[1]["x"] - C("s")[0]["x"], C("s")[1]["z"] - C("s")[0]["z"]) > least
    return cut.filter(long).select(*(c for c in rows.columns if c != "points"), "y", C("s")[0].alias("a"), C("s")[1].alias("b"))


def degrees(segments: DataFrame, by: list[str], step: float) -> DataFrame:
    """by, segments, loose, joined, branching (places, welded to whole steps, at which one, two and more ends lie), length."""
    length = F.hypot(C("b.x") - C("a.x"), C("b.z") - C("a.z"))
    end = lambda c, n: F.struct(*(F.round(C(f"{c}.{v}") / step).cast("long").alias(v) for v in "xz"), n.alias("n"))
    ends = segments.select(*by, F.inline(F.array(end("a", length), end("b", F.lit(0.0)))))
    places = ends.groupBy(*by, "x", "z").agg(F.count("*").alias("d"), F.sum("n").alias("n"))
    return places.groupBy(*by).agg((F.sum("d") / 2).cast("long").alias("segments"), F.count_if(C("d") == 1).alias("loose"), F.count_if(C("d") == 2).alias("joined"), F.count_if(C("d") > 2).alias("branching"), F.sum("n").alias("length"))


def loops(segments: DataFrame, by: list[str], weld: float, least_area: float = 0.0, least_width: float = 0.0) -> DataFrame:
    """by, loop, ring, depth, hole, area, centre, reason: the closed loops of each group's segments (a, b), with how many larger ones they
    are in, and whether that is odd. A group whose ends do not meet two by two has one row with the reason and no ring. Loops below
    least_area or narrower than least_width are left out. A group's segments are walked in one task."""

    def walk(group: pa.Table) -> list[dict]:
        try:
            found = polygons.walked(_pairs(group), weld)
        except ValueError as e:
            return [{"loop": 0, "reason": str(e)}]
        out = []
        for ring, (depth, hole) in zip(found, polygons.nested(found)):
            area, (w, d) = abs(polygons.signed_area(ring)), ([max(p[v] for p in ring) - min(p[v] for p in ring) for v in (0, 1)])
            if area >= least_area and min(w, d) >= least_width:
                middle = {v: sum(p[k] for p in ring) / len(ring) for k, v in enumerate("xz")}
                out.append({"loop": len(out) + 1, "ring": _shown(ring), "depth": depth, "hole": hole, "area": area, "centre": middle})
        return out

    fields = [("loop", "int"), ("ring", polygons.RING), ("depth", "int"), ("hole", "boolean"), ("area", "double"), ("centre", "struct<x:double,z:double>"), ("reason", "string")]
    return by_sorted_group(segments.select(*by, "a", "b"), by, walk, fields)


def _pairs(group: pa.Table) -> list[tuple[polygons.Point, polygons.Point]]:
    """The segments of a group, in an order that doesn't depend on that of its rows."""
    own = [((a["x"], a["z"]), (b["x"], b["z"])) for a, b in zip(group.column("a").to_pylist(), group.column("b").to_pylist()) if a and b]
    return sorted(tuple(sorted(s)) for s in own)


def _shown(ring: polygons.Ring) -> list[dict]:
    return [{"x": x, "z": z} for x, z in ring]


FIGURES = ("vertices", "branches", "open", "seams", "corners", "invalid")


def mended_loops(segments: DataFrame, by: list[str], params: OutlineParams = OutlineParams()) -> DataFrame:
    """by, loop, ring, area, reason and FIGURES: the loops of each section's segments (a, b), the largest first, after gaps were closed that the directions of
    their ends close (see outline). A section without loops has one row with the reason. Segments with a null end are left out. A section is one task's."""

    def walk(group: pa.Table) -> list[dict]:
        found = outline.section_loops(_pairs(group), params)
        figures = {f: found[f] for f in FIGURES}
        rows = [{"loop": n, "ring": _shown(r), "area": abs(polygons.signed_area(r))} | figures for n, r in enumerate(found["loops"], 1)]
        return rows or [{"loop": 0, "reason": found["reason"]} | figures]

    fields = [("loop", "int"), ("ring", polygons.RING), ("area", "double"), ("reason", "string"), *((f, "int") for f in FIGURES)]
    return by_sorted_group(segments.select(*by, "a", "b"), by, walk, fields)


#: Areas of one hole and of all holes against the outline's, and of a second body: in all and against it.
HOLE, HOLES, SECOND, SECOND_SHARE = 0.025, 0.04, 50.0, 0.015
#: Why a section has no outline.
ALONE = ("courtyard or internal loop", "large roof opening", "multiple substantial bodies", "many roof openings")


def outlines(found: DataFrame, by: list[str], holes: bool = False) -> DataFrame:
    """by, ring, area, holes, hole_area, reason and FIGURES of each section of mended_loops: its largest loop, unless others tell that it is not all of it. A loop in it
    is a courtyard, and with `holes` an opening of a roof that must be small, alone and with the others; a loop beside it must be a scrap. The largest loop at fault gives the reason."""
    main = found.filter("loop <= 1").select(*by, C("ring").alias("main"), C("area").alias("main_area"), C("reason").alias("why"), *FIGURES)
    rest = found.filter("loop > 1").join(main.select(*by, "main", "main_area"), by)
    inner = rings.contains_point(C("main"), C("ring")[0], 0.01)
    opening = F.when(C("area") > C("main_area") * HOLE, ALONE[1]) if holes else F.lit(ALONE[0])
    fault = F.when(inner, opening).otherwise(F.when(C("area") > F.least(F.lit(SECOND), C("main_area") * SECOND_SHARE), ALONE[2]))
    judged = rest.withColumns({"inner": inner, "fault": fault})
    sums = judged.groupBy(*by).agg(F.count_if("inner").alias("n"), F.coalesce(F.sum(F.when(C("inner"), C("area"))), F.lit(0.0)).alias("hole_area"), F.min(F.when(C("fault").isNotNull(), F.struct("loop", "fault")))["fault"].alias("fault"))
    rows = main.join(sums, by, "left").withColumn("hole_area", F.coalesce("hole_area", F.lit(0.0)))
    reason = F.coalesce("why", "fault", F.when(C("hole_area") > C("main_area") * HOLES, ALONE[3]))
    return rows.withColumn("reason", reason).select(*by, F.when(C("reason").isNull(), C("main")).alias("ring"), F.when(C("reason").isNull(), C("main_area")).alias("area"), F.coalesce("n", F.lit(0).cast("long")).alias("holes"), "hole_area", "reason", *FIGURES)
