"""Joins and aggregates over rings and turned boxes.

Joins of shapes that lie near each other meet on the cells of a grid: the shape with an extent is repeated in each cell that
its bounds touch, so that the join has an equality and no task compares all with all. Cells should be about as
large as the shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import motion, rings

C = F.col


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / cell).cast("long")


def spread(df: DataFrame, x0: Column, x1: Column, z0: Column, z1: Column, cell: float) -> DataFrame:
    """df with a row for each grid cell (gx, gz) that the bounds touch; none where a bound is null or they are reversed."""
    some = (x0 <= x1) & (z0 <= z1)
    rows = df.filter(some).withColumn("gx", F.explode(F.sequence(_cell(x0, cell), _cell(x1, cell))))
    return rows.withColumn("gz", F.explode(F.sequence(_cell(z0, cell), _cell(z1, cell))))


def covered_points(points: DataFrame, key: str, shapes: DataFrame, shape_key: str, cell: float, tolerance: float = 1e-5) -> DataFrame:
    """(key, shape_key): the points (x, z) that lie in a ring of shapes (ring) or on its border."""
    b = rings.bounds(C("ring"))
    wide = shapes.select(shape_key, "ring").withColumn("__b", b)
    wide = spread(wide, C("__b.x0") - tolerance, C("__b.x1") + tolerance, C("__b.z0") - tolerance, C("__b.z1") + tolerance, cell)
    near = points.select(key, "x", "z", _cell(C("x"), cell).alias("gx"), _cell(C("z"), cell).alias("gz"))
    within = C("x").between(C("__b.x0") - tolerance, C("__b.x1") + tolerance) & C("z").between(C("__b.z0") - tolerance, C("__b.z1") + tolerance)
    held = rings.contains_point(C("ring"), rings.point(C("x"), C("z")), tolerance)
    # the bounds before the ring: an argument of when is computed only where it is asked for
    return near.join(wide, ["gx", "gz"]).filter(F.when(within, held).otherwise(F.lit(False))).select(key, shape_key)


def coverage(points: DataFrame, key: str, by: list[str], shapes: DataFrame, shape_key: str, cell: float) -> DataFrame:
    """by, points, covered, coverage: the share of a group's points that any ring covers; each counts once."""
    hit = covered_points(points, key, shapes, shape_key, cell).select(key).distinct().withColumn("__hit", F.lit(1))
    found = points.join(hit, key, "left").groupBy(*by).agg(F.count("*").alias("points"), F.count("__hit").alias("covered"))
    return found.withColumn("coverage", C("covered") / C("points"))


def oriented_box(boxes: DataFrame, by: list[str]) -> DataFrame:
    """by, yaw, size, at: the box around all boxes (id, at, size, yaw) of a group, in the frame of the one with the most volume
    (of equal ones that with the least id)."""
    volume = C("size.x") * C("size.y") * C("size.z")
    frame = boxes.groupBy(*by).agg(F.max_by("yaw", F.struct(volume, -C("id"))).alias("__f"))
    half = motion.half_extents(C("size"), C("yaw") - C("__f"))
    local = motion.to_local(C("at"), motion.vector(F.lit(0), F.lit(0), F.lit(0)), C("__f"))
    rows = boxes.join(frame, by).withColumn("__p", local).withColumn("__h", half)
    ends = [f(C(f"__p.{a}") + sign * C(f"__h.{a}")).alias(f"{name}{a}") for a in "xyz" for f, sign, name in ((F.min, -1, "lo"), (F.max, 1, "hi"))]
    found = rows.groupBy(*by, "__f").agg(*ends)
    middle = motion.vector(*((C(f"lo{a}") + C(f"hi{a}")) / 2 for a in "xyz"))
    at = motion.to_world(middle, motion.vector(F.lit(0), F.lit(0), F.lit(0)), C("__f"))
    return found.select(*by, C("__f").alias("yaw"), motion.vector(*(C(f"hi{a}") - C(f"lo{a}") for a in "xyz")).alias("size"), at.alias("at"))


def turned_overlaps(boxes: DataFrame, cell: float, slack: float = 0.001) -> DataFrame:
    """(a, b): the pairs a < b of boxes (id, at, size, yaw) that overlap."""
    rows = boxes.select("id", "at", "size", "yaw", motion.half_extents(C("size"), C("yaw")).alias("h"))
    wide = spread(rows, C("at.x") - C("h.x"), C("at.x") + C("h.x"), C("at.z") - C("h.z"), C("at.z") + C("h.z"), cell)
    a, b = wide.alias("a"), wide.alias("b")
    # of the cells that two boxes share, the one where the larger of their lower ends lies
    low = lambda v: _cell(F.greatest(*(C(f"{s}.at.{v}") - C(f"{s}.h.{v}") for s in "ab")), cell)
    same = (C("a.gx") == C("b.gx")) & (C("a.gz") == C("b.gz")) & (C("a.id") < C("b.id")) & (low("x") == C("a.gx")) & (low("z") == C("a.gz"))
    meet = motion.turned_boxes_overlap(C("a.at"), C("a.size"), C("a.yaw"), C("b.at"), C("b.size"), C("b.yaw"), slack)
    return a.join(b, same & meet).select(C("a.id").alias("a"), C("b.id").alias("b"))
