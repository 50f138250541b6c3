"""Buildings that are one box: five slices that stay close to one rectangle, on level ground, clear of what is there."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import outline, polygons, rings
from strataframe.functions.outline import OutlineParams
from strataframe.operators import sections
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.places import ground_below
from strataframe.operators.rings import spread
from strataframe.operators.select import accepted
from strataframe.storage import stored

C = F.col
#: Heights of the slices; least height and triangles; least area, least and greatest side of the middle one; area of each against its box; how far a side
#: may be from the middle one's, in all and against the lesser side; weld of a slice.
SLICES, LEAST_HEIGHT, LEAST_TRIANGLES, LEAST_AREA, SIDES, RATIO, DRIFT, DRIFT_SHARE, WELD = (0.08, 0.25, 0.5, 0.75, 0.92), 35.0, 8, 600.0, (20.0, 500.0), (0.93, 1.03), 2.0, 0.025, 0.05
REASONS = ("small", "open or disconnected", "small footprint", "size", "non rectangular", "changing footprint")
#: Rise and depth of a probe, how far the base may be above ground (and no more than the height) and below, how even the ground must be, least height on it; share of the smaller
#: ground area that two may have in common.
RISE, DEPTH, ABOVE, BELOW, EVEN, SHARED = 500.0, 1000.0, 125.0, 15.0, 4.0, 0.05
#: Fixed value: so far beyond a bound a measured length, area or share still counts as the bound: what is measured on a turned box is rounded.
ROUNDING = 1e-6
GROUND = ("ground unverified", "floating or buried", "uneven ground", "overlap")


def slices(triangles: DataFrame, cuts: DataFrame) -> DataFrame:
    """m, y, ring of each cut (m, y) of triangles (m, points): its one closed loop, else the hull that its facades bear out; null where there is neither."""
    own = cuts.groupBy("m").agg(F.collect_set("y").alias("ys"))
    segments = stored(sections.at_heights(triangles.select("m", "points").join(own, "m"), C("ys")).select("m", "y", "a", "b"), "segments")

    def contour(group: pa.Table) -> list[dict]:
        pairs = sections._pairs(group)
        found = outline.section_loops(pairs, OutlineParams(WELD, 0.0, 0.0, 0.0))
        ends = np.array(pairs).reshape(-1, 2, 2)
        ring = found["loops"][0] if len(found["loops"]) == 1 else outline.facade_hull(ends[:, 0], ends[:, 1]) if len(pairs) else None
        return [{"ring": ring and [{"x": float(x), "z": float(z)} for x, z in ring]}]

    return by_sorted_group(segments, ["m", "y"], contour, [("ring", polygons.RING)])


def classified(triangles: DataFrame) -> DataFrame:
    """m, x, z (the middle), yaw, width, depth, y0, y1, confidence, reason of each model of triangles (m, points): the box that it is, or why it is none."""
    height = lambda f: f(F.transform("points", lambda q: q["y"]))
    models = stored(triangles.groupBy("m").agg(F.count("*").alias("n"), F.min(height(F.array_min)).alias("y0"), F.max(height(F.array_max)).alias("y1")), "models")
    small = (C("y1") - C("y0") < LEAST_HEIGHT) | (C("n") < LEAST_TRIANGLES)
    at = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), (C("y0") + (C("y1") - C("y0")) * f).alias("y")) for k, f in enumerate(SLICES))))
    wanted = stored(models.filter(~small).select("m", at.alias("c")).select("m", "c.*"), "wanted")
    cut = stored(wanted.join(slices(triangles, wanted), ["m", "y"], "left"), "slices")
    middle = cut.filter(C("k") == len(SLICES) // 2).select("m", polygons.as_box("ring")["value"].alias("f"))
    frame = middle.select("m", C("f.angle").alias("turn"), C("f.width").alias("width"), C("f.depth").alias("depth"), *(((C("f.ring")[0][v] + C("f.ring")[2][v]) / 2).alias(v) for v in "xz"))
    u = lambda q: q["x"] * F.cos("turn") + q["z"] * F.sin("turn")
    w = lambda q: q["z"] * F.cos("turn") - q["x"] * F.sin("turn")
    ends = {f"{name}{i}": f(F.transform("ring", g)) for name, g in (("u", u), ("w", w)) for i, f in enumerate((F.array_min, F.array_max))}
    rows = cut.join(frame, "m").withColumns(ends).withColumn("area", F.abs(rings.signed_area(C("ring"))))
    mid = {"u": u(rings.point(C("x"), C("z"))), "w": w(rings.point(C("x"), C("z")))}
    near = F.least(F.lit(DRIFT), F.least("width", "depth") * DRIFT_SHARE)
    off = F.greatest(*(F.abs(C(f"{v}{i}") - (mid[v] + sign * C(size) / 2)) for v, size in (("u", "width"), ("w", "depth")) for i, sign in ((0, -1), (1, 1))))
    ratio = C("area") / (C("width") * C("depth"))
    judged = rows.select("m", "k", "ring", ratio.alias("ratio"), F.when(~ratio.between(RATIO[0] - ROUNDING, RATIO[1] + ROUNDING), REASONS[4]).when(off > near + ROUNDING, REASONS[5]).alias("fault"))
    sums = judged.groupBy("m").agg(F.min("ratio").alias("least"), F.min(F.when(C("fault").isNotNull(), F.struct("k", "fault")))["fault"].alias("fault"))
    closed = cut.groupBy("m").agg(F.count("ring").alias("closed"))
    rows = models.join(closed, "m", "left").join(frame, "m", "left").join(sums, "m", "left")
    low, high = F.least("width", "depth"), F.greatest("width", "depth")
    reason = F.when(small, REASONS[0]).when(C("closed") < len(SLICES), REASONS[1]).when(C("width").isNull() | (C("width") * C("depth") < LEAST_AREA - ROUNDING), REASONS[2]).when((low < SIDES[0] - ROUNDING) | (high > SIDES[1] + ROUNDING), REASONS[3]).otherwise(C("fault"))
    rows = rows.withColumn("reason", reason)
    good = C("reason").isNull()
    values = {"x": C("x"), "z": C("z"), "yaw": -C("turn"), "width": C("width"), "depth": C("depth"), "confidence": F.least(F.lit(1.0), "least")}
    return rows.select("m", *(F.when(good, v).alias(k) for k, v in values.items()), "y0", "y1", "reason")


def footprint(x: Column, z: Column, yaw: Column, width: Column, depth: Column) -> Column:
    """The ring of a box on the ground."""
    at = lambda a, b: rings.point(x + a * width / 2 * F.cos(-yaw) - b * depth / 2 * F.sin(-yaw), z + a * width / 2 * F.sin(-yaw) + b * depth / 2 * F.cos(-yaw))
    return F.array(at(-1, -1), at(1, -1), at(1, 1), at(-1, 1))


def grounded(boxes: DataFrame, surfaces: DataFrame, cell: float = 64.0) -> DataFrame:
    """boxes (classified) with ring and base (the ground below the middle, to which the body is let down), and reason where the ground is unknown, too far or uneven.
    surfaces: boxes x0, x1, z0, z1, y1 (their tops)."""
    rows = stored(boxes.withColumn("ring", footprint(C("x"), C("z"), C("yaw"), C("width"), C("depth"))), "boxes")
    places = rows.filter("reason IS NULL").select("m", "y0", F.posexplode(F.concat(F.array(rings.point(C("x"), C("z"))), C("ring"))).alias("k", "p"))
    probes = places.select(F.struct("m", "k").alias("id"), C("p.x").alias("x"), C("y0").alias("y"), C("p.z").alias("z"))
    found = stored(ground_below(probes, surfaces, cell, RISE, DEPTH).select(C("id.m").alias("m"), C("id.k").alias("k"), "ground"), "ground")
    sums = found.groupBy("m").agg(F.max(F.when(C("k") == 0, C("ground"))).alias("base"), F.min(F.when(C("k") > 0, C("ground"))).alias("low"), F.max(F.when(C("k") > 0, C("ground"))).alias("high"), F.count(F.when(C("k") > 0, C("ground"))).alias("known"))
    rows = rows.join(sums, "m", "left")
    far = C("y0") - C("base")
    uneven = (C("known") < 4) | (C("high") - C("base") > EVEN) | (C("base") - C("low") > EVEN) | (C("y1") - C("base") < LEAST_HEIGHT)
    reason = F.coalesce("reason", F.when(C("base").isNull(), GROUND[0]).when((far > F.least(F.lit(ABOVE), C("y1") - C("y0"))) | (far < -BELOW), GROUND[1]).when(uneven, GROUND[2]))
    return rows.withColumn("reason", reason).drop("low", "high", "known")


def clear(boxes: DataFrame, kept: DataFrame, cell: float = 64.0) -> DataFrame:
    """boxes (grounded) whose reason is null, as a walk by falling ground area (then m) accepts them: none shares more than a part of the smaller ground area with a ring of
    kept (ring) or with one accepted before; the others have the reason that they overlap."""
    good = stored(boxes.filter("reason IS NULL").withColumn("own", C("width") * C("depth")), "good")

    def near(a: DataFrame, b: DataFrame) -> DataFrame:
        wide = lambda df, p: spread(df.withColumn("q", rings.bounds(C("ring"))).select(*(C(c).alias(f"{p}{c}") for c in ("id", "ring", "own")), "q"), C("q.x0"), C("q.x1"), C("q.z0"), C("q.z1"), cell).withColumnRenamed("q", f"{p}q")
        first = (C("gx") == F.floor(F.greatest("aq.x0", "bq.x0") / cell)) & (C("gz") == F.floor(F.greatest("aq.z0", "bq.z0") / cell))
        met = wide(a, "a").join(wide(b, "b"), ["gx", "gz"]).filter(first)
        return met.filter(polygons.as_overlap("aring", "bring")["value"] > F.least("aown", "bown") * SHARED)

    own = good.select(C("m").alias("id"), "ring", "own")
    there = kept.select(F.lit(0).cast(own.schema["id"].dataType).alias("id"), "ring", F.abs(rings.signed_area(C("ring"))).alias("own"))
    blocked = stored(near(own, there).select(C("aid").alias("m")).distinct(), "blocked")
    free = good.join(blocked, "m", "left_anti")
    ranked = stored(free.select("m", F.struct((-C("own")).alias("own"), "m").alias("rank")), "ranked")
    pairs = near(free.select(C("m").alias("id"), "ring", "own"), free.select(C("m").alias("id"), "ring", "own")).filter("aid < bid").select(C("aid").alias("a"), C("bid").alias("b"))
    chosen = accepted(ranked, "m", "rank", stored(pairs, "pairs")).select("m", F.lit(True).alias("__ok"))
    rows = boxes.join(chosen, "m", "left")
    return rows.withColumn("reason", F.when(C("reason").isNull() & C("__ok").isNull(), GROUND[3]).otherwise(C("reason"))).drop("__ok")
