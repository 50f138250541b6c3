"""Audits: what the parts of buildings add up to, and what is wrong with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

C = F.col
#: The six pieces of a core, the least size of a structural part, how far a piece may move between floors.
CORE_NAMES = ("CoreWallFront", "CoreWallBack", "CoreWallRight", "CoreWallLeft", "CoreDividerX", "CoreDividerZ")
LEAST_SIZE, DRIFT = 0.05, 0.03


def structure_counts(parts: DataFrame) -> DataFrame:
    """model, parts, structural, cores, wedges, slabs, levels (distinct heights of slabs, in thousandths), slab_volume; wedges count half.

    parts: model, name, kind (block or wedge), structural, core, y, sx, sy, sz.
    """
    solid = C("structural")
    slab = solid & (C("name") == "Slab")
    volume = C("sx") * C("sy") * C("sz") * F.when(C("kind") == "wedge", 0.5).otherwise(1.0)
    return parts.groupBy("model").agg(
        F.count("*").alias("parts"), F.count_if(solid).alias("structural"), F.count_if(solid & C("core")).alias("cores"), F.count_if(solid & (C("kind") == "wedge")).alias("wedges"), F.count_if(slab).alias("slabs"),
        F.count_distinct(F.when(slab, F.round(C("y") * 1000))).alias("levels"), F.coalesce(F.sum(F.when(slab, volume)), F.lit(0.0)).alias("slab_volume"),
    )


def floor_areas(parts: DataFrame) -> DataFrame:
    """model, floor, area of the slabs of each floor; floor is null for the roof. Wedges count half."""
    area = C("sx") * C("sz") * F.when(C("kind") == "wedge", 0.5).otherwise(1.0)
    return parts.filter(C("structural") & (C("name") == "Slab")).groupBy("model", "floor").agg(F.sum(area).alias("area"))


def structure_audit(parts: DataFrame, models: DataFrame) -> DataFrame:
    """models (model, floors) with reasons, sorted, empty where all is well.

    parts: model, floor (0 for the roof, null outside), part (order in the model), name, kind, structural, core, anchored, collides, sx, sy,
    sz, x, z (in the core's frame). Structural parts must be anchored, solid, of a known kind, large enough and on a floor or the
    roof; each floor and the roof needs a slab; each floor all core pieces, once; a piece may not move between floors, against
    where it is first. A model without parts lacks everything.
    """
    flag = lambda c, text: F.max(F.when(F.coalesce(c, F.lit(False)), F.lit(text)))
    solid = C("structural")
    small = F.least("sx", "sy", "sz") < LEAST_SIZE - 1e-6
    core = solid & C("core")
    piece = W.partitionBy("model", "name").orderBy("part")
    first = lambda c: F.first(F.when(core, C(c)), ignorenulls=True).over(piece)
    rows = parts.withColumns({"__x": first("x"), "__z": first("z")})
    moved = core & (F.hypot(C("x") - C("__x"), C("z") - C("__z")) > DRIFT)
    of_part = [
        flag(~C("anchored"), "Unanchored part"), flag(solid & ~C("collides"), "Non-collidable structural part"), flag(solid & ~C("kind").isin("block", "wedge"), "Unexpected structural class"), flag(solid & small, "Invalid/minimum size"),
        flag(solid & C("floor").isNull(), "Structural part outside a named floor/roof"), flag(core & (F.coalesce("floor", F.lit(0)) < 1), "Core part outside an occupied floor"), flag(core & ~C("name").isin(*CORE_NAMES), "Unexpected core part"), flag(moved, "Core shifts between floors"),
    ]
    whole = rows.groupBy("model").agg(F.array_compact(F.array(*of_part)).alias("__parts"), F.count_if(core).alias("__cores"))
    per_floor = rows.filter(solid & C("floor").isNotNull()).groupBy("model", "floor").agg(
        (F.count_if(C("name") == "Slab") > 0).alias("slab"), F.count_if(C("core")).alias("cores"),
        reduce(lambda a, b: a & b, [F.count_if(C("core") & (C("name") == n)) == 1 for n in CORE_NAMES]).alias("complete"),
    )
    wanted = models.select("model", "floors", F.explode(F.sequence(F.lit(0), C("floors").cast("int"))).alias("floor"))
    seen = wanted.join(per_floor, ["model", "floor"], "left")
    floor = C("floor") > 0
    lacks = seen.groupBy("model").agg(
        F.array_compact(F.array(
            flag(floor & C("slab").isNull(), "Missing floor"), flag(floor & ~C("slab"), "Floor has no slab"), flag(floor & C("slab").isNotNull() & (C("cores") != len(CORE_NAMES)), "Floor does not have all six core pieces"),
            flag(floor & ~C("complete"), "Missing or duplicate core piece"), flag(~floor & C("slab").isNull(), "Missing Roof"), flag(~floor & ~C("slab"), "Roof has no slab"),
        )).alias("__floors")
    )
    none = F.array().cast("array<string>")
    rows = models.join(whole, "model", "left").join(lacks, "model", "left")
    total = F.when(F.coalesce("__cores", F.lit(0)) != C("floors") * len(CORE_NAMES), F.array(F.lit("Total core count does not match generated floors"))).otherwise(none)
    return rows.select(*models.columns, F.array_sort(F.concat(F.coalesce("__parts", none), F.coalesce("__floors", none), total)).alias("reasons"))


def roof_bands(faces: DataFrame, by: list[str], reach: float = 0.6) -> DataFrame:
    """by, low, y, area: faces (y, area) in bands that begin with their lowest face and hold what is at most `reach` above it;
    y is the mean by area. The distinct heights of a group are folded in memory; the faces of a height are summed before."""
    levels = faces.groupBy(*by, "y").agg(F.sum("area").alias("area"))
    own = levels.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("y", "area"))).alias("f"))
    start = F.struct(F.lit(float("-inf")).alias("low"), F.array().cast("array<struct<low:double,y:double,area:double>>").alias("out"))

    def step(acc: Column, f: Column) -> Column:
        low = F.when((acc["low"] == float("-inf")) | (f["y"] - acc["low"] > reach), f["y"]).otherwise(acc["low"])
        return F.struct(low.alias("low"), F.array_append(acc["out"], F.struct(low.alias("low"), f["y"].alias("y"), f["area"].alias("area"))).alias("out"))

    placed = own.select(*by, F.inline(F.aggregate("f", start, step, lambda acc: acc["out"])))
    return placed.groupBy(*by, "low").agg((F.sum(C("y") * C("area")) / F.sum("area")).alias("y"), F.sum("area").alias("area"))


def roof_planes(faces: DataFrame, by: list[str], order: str) -> DataFrame:
    """by, quarter, y, area: faces (y, area) by height in quarters; y is that of the first one by order."""
    quarter = F.round(C("y") * 4).cast("long").alias("quarter")
    return faces.groupBy(*by, quarter).agg(F.min_by("y", order).alias("y"), F.sum("area").alias("area"))
