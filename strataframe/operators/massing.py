"""Buildings from the whole floors of an occupancy grid: tiers of simple rings, or the reason why there are none.

All is tables: plates (the distinct masks of a model) with their ring and figures, their likeness, the floors with the group
of plates that each is given, runs of equal groups, and gates. A gate is a row (m, rank, k, reason); of a model's gates the first by
rank, then by floor, is the reason why it is refused. Only the labelling of cells, the walk along a border and the thinning of a ring are kernels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import RESIDUAL_GRID, Final, GridMassing, Residual, Split, configured
from strataframe.functions import polygons, rings
from strataframe.functions.building import FloorParams, floor_bottom
from strataframe.operators import masks
from strataframe.operators.masks import CELL
from strataframe.operators.places import cropped
from strataframe.operators.tables import first_like, lower_median, runs
from strataframe.storage import stored

C = F.col
#: How far an unsupported floor's area may be from that of the group it joins, and a body above the roof may reach.
NEAR_AREA, UPPER_SHARE = (0.85, 1.15), 0.65
#: The reasons of the gates, in order of rank; those of floors; and what makes a floor's reason one of its model.
GATES = {
    "few": "too few legacy floors",
    "ambiguous": "ambiguous floor topology: ",
    "ground": "ground floor is not a complete usable body",
    "valid": "too little complete floor coverage",
    "repeated": "no repeated major footprint",
    "distinct": "too many distinct major footprints",
    "base": "base has no persistent footprint support",
    "envelope": "base footprint covers too little source envelope",
    "height": "persistent body covers too little height",
    "walk": "",
    "supported": "too little supported building coverage",
    "upper": "unsupported substantial upper body",
}
WALK = ("unsupported interior footprint transition", "oscillating major footprints", "offset or expanding grid tier")
FLOOR = ("tiny usable floor", "simplified boundary is not simple", "too many significant footprint corners", "simplification changes too much floor area", "narrow fragment footprint")
AMBIGUOUS = "disconnected|detached|courtyard|touching|enclosed"
METHODS = ("simplified repeated grid polygon", "high agreement grid rectangle")
TIERS = f"array<struct<bottom:double,top:double,ring:{polygons.RING}>>"
EVIDENCE = (
    "struct<source_floors:int,valid_floors:int,supported_floors:int,base_support_floors:int,envelope_coverage:double,max_area_change:double,tolerance:double,methods:array<string>,"
    "regularized_floors:int,max_regularized_area_change:double,bridged_missing_floors:int,cleanup_floors:int,removed_island_area:double,filled_hole_area:double>"
)


def plates(cells: DataFrame, models: DataFrame, side: int, p: GridMassing) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(floors, plates, cells): floors m, k with plate, the least floor of the model with the same mask; each plate (m, plate) with ring, raw (area of
    its cells), area, change, method, tolerance, low (covers too little of the envelope), clean (the least plate that is the same when clean), island_area, hole_area, reason; the cells of good plates."""
    own = stored(cells.select(*CELL).join(models.select("m", "floors"), "m").filter("k BETWEEN 1 AND floors").select(*CELL), "own")
    places = F.sort_array(F.collect_set((C("i") - 1) * side + C("j")))
    floors = own.groupBy("m", "k").agg(places.alias("places"))
    floors = stored(floors.select("m", "k", F.min("k").over(W.partitionBy("m", "places")).alias("plate")), "floors")
    sizes = models.select("m", "cell", "size_x", "size_z")
    clean = masks.CleanParams(p.min_dominant_area, p.max_island_cells, p.max_island_area, p.max_hole_cells, p.max_hole_area, p.max_hole_fraction)
    found, kept = masks.cleaned(own.join(floors.filter("k = plate").select("m", "k"), ["m", "k"], "left_semi"), side, params=clean, sizes=sizes)
    found, kept = stored(found, "cleaned"), stored(kept, "kept")
    area = masks.cell_area(C("cell"), C("i"), C("j"), C("size_x"), C("size_z"))
    raw = kept.join(sizes, "m").groupBy("m", "k").agg(F.sum(area).alias("raw"))
    at = lambda v, size: F.least(v * C("cell") - C(size) / 2, C(size) / 2)
    # a clean floor is one body without holes, so its border is one loop
    border = masks.loops(kept, side).join(sizes, "m").withColumn("outline", F.transform("corners", lambda q: F.struct(at(q["x"], "size_x").alias("x"), at(q["z"], "size_z").alias("z"))))
    tolerance = F.least(C("cell") * p.tolerance_cells, F.lit(p.max_simplify))
    rows = border.join(raw, ["m", "k"]).withColumn("tolerance", tolerance).withColumn("thin", polygons.as_thinned("outline", "tolerance")).withColumn("box", polygons.as_box("thin.value")["value"])
    rows = rows.withColumns({"thin_area": F.abs(rings.signed_area(C("thin.value"))), "box_area": C("box.width") * C("box.depth")})
    change = lambda a: F.abs(a / C("raw") - 1)
    square = (C("thin_area") >= p.rectangle_agreement * C("box_area")) & (change(C("box_area")) <= p.max_area_change)
    reasons = (C("raw") < p.min_area, C("thin.value").isNull(), F.size("thin.value") > p.max_vertices, change(C("thin_area")) > p.max_area_change, F.least("box.width", "box.depth") < p.min_width)
    reason = F.coalesce(*(F.when(test, text) for test, text in zip(reasons, FLOOR)))
    made = rows.select("m", "k", "raw", "tolerance", reason.alias("why"), F.when(square, C("box.ring")).otherwise(C("thin.value")).alias("ring"), F.when(square, METHODS[1]).otherwise(METHODS[0]).alias("method"), "size_x", "size_z")
    extent = lambda v: F.array_max(F.transform("ring", lambda q: q[v])) - F.array_min(F.transform("ring", lambda q: q[v]))
    low = (extent("x") < p.min_envelope_span * C("size_x")) | (extent("z") < p.min_envelope_span * C("size_z")) | (C("raw") < p.min_envelope_area * C("size_x") * C("size_z"))
    shape = kept.groupBy("m", "k").agg(F.sort_array(F.collect_list((C("i") - 1) * side + C("j"))).alias("places"))
    made = made.join(shape.select("m", "k", F.min("k").over(W.partitionBy("m", "places")).alias("clean")), ["m", "k"])
    made = made.withColumn("area", F.abs(rings.signed_area(C("ring")))).withColumns({"low": low, "change": C("area") / C("raw") - 1}).drop("size_x", "size_z")
    measured = found.select("m", "k", "island_area", "hole_area", "reason").join(made, ["m", "k"], "left")
    measured = stored(measured.withColumn("reason", F.coalesce("reason", "why")).withColumnRenamed("k", "plate").drop("why"), "plates")
    good = measured.filter("reason IS NULL").select("m", C("plate").alias("k"))
    return floors, measured, kept.join(good, ["m", "k"], "left_semi")


def floor_groups(cells: DataFrame, models: DataFrame, side: int, p: GridMassing) -> tuple[DataFrame, DataFrame]:
    """(levels, groups). levels: every floor m, k of every model with plate, raw, reason (null where it is good; "empty floor"), group (of its
    plate), home (the supported group that it is given, null if none), bridged. groups: m, group, members, supported and the columns of its middle plate."""
    floors, plate_rows, kept = plates(cells, models, side, p)
    like = stored(masks.floor_jaccard(kept).filter(C("jaccard") >= min(p.similarity, p.nearby_similarity)), "like")
    every = models.select("m", "floors", F.explode(F.sequence(F.lit(1), C("floors"))).alias("k"))
    rows = every.join(floors, ["m", "k"], "left").join(plate_rows, ["m", "plate"], "left").join(first_like(plate_rows.filter("reason IS NULL"), "m", "plate", like.filter(C("jaccard") >= p.similarity)), ["m", "plate"], "left")
    rows = stored(rows.withColumn("reason", F.when(C("plate").isNull(), "empty floor").otherwise(C("reason"))), "levels")
    valid = rows.filter("reason IS NULL")
    counts = valid.groupBy("m", "group").agg(F.count("*").alias("members"))
    majority = (C("floors") == 3) & (C("members") >= 2) & (F.sum("members").over(W.partitionBy("m")) == 3)
    middle = lower_median(valid, ["m", "group"], ["raw", "k"]).join(counts, ["m", "group"])
    groups = middle.withColumn("supported", (C("members") >= p.min_support_floors) | majority)
    groups = stored(groups.select("m", "group", "members", "supported", "plate", "clean", "raw", "ring", "area", "change", "low", "method", "tolerance"), "groups")
    held = groups.filter("supported").select("m", "group", C("plate").alias("middle"), C("raw").alias("middle_raw"))
    # a floor of a group without support joins the first supported one that its mask and area are near
    lone = valid.select("m", "k", "plate", "raw", "group").join(groups.filter("NOT supported").select("m", "group"), ["m", "group"], "left_semi").drop("group")
    near = lone.join(held, "m").filter((C("raw") / C("middle_raw")).between(*NEAR_AREA))
    pair = like.filter(C("jaccard") >= p.nearby_similarity).select("m", "a", "b")
    near = near.withColumns({"a": F.least("plate", "middle"), "b": F.greatest("plate", "middle")}).join(pair, ["m", "a", "b"], "left_semi").groupBy("m", "k").agg(F.min("group").alias("near"))
    own = rows.join(held.select("m", "group", C("group").alias("own")), ["m", "group"], "left").join(near, ["m", "k"], "left").withColumn("given", F.coalesce("own", "near"))
    order = W.partitionBy("m").orderBy("k")
    # an empty or bad floor between two of one group is taken for one of that group
    around = F.when(C("reason").isNotNull() & (F.lag("given").over(order) == F.lead("given").over(order)), F.lag("given").over(order))
    levels = own.withColumn("home", F.coalesce("given", around)).withColumn("bridged", C("given").isNull() & C("home").isNotNull())
    return stored(levels.select("m", "k", "floors", "clean", "raw", "reason", "island_area", "hole_area", "group", "given", "home", "bridged"), "homes"), groups


def grid_plans(cells: DataFrame, models: DataFrame, side: int, params: GridMassing = GridMassing()) -> DataFrame:
    """m, tiers, height, area, confidence, reason, evidence for each of models (m, cell, size_x, size_y, size_z, ground, upper, floors): what its cells
    (m, k, i, j) are as a building, or why they are none. Floors without cells are empty, cells of other floors are not looked at."""
    p, slab = params, FloorParams().slab
    models = models.select("m", "cell", "size_x", "size_y", "size_z", "ground", "upper", "floors")
    levels, groups = floor_groups(cells, models, side, p)
    ring = groups.select("m", C("group").alias("home"), "members", C("clean").alias("middle"), "ring", "area", C("raw").alias("group_raw"), "change", "low", "method", "tolerance")
    stats = levels.groupBy("m").agg(
        F.count_if(C("reason").isNull()).alias("valid"), F.max(F.when(C("given").isNotNull(), C("k"))).alias("last"), F.max(F.when(C("k") == 1, C("given"))).alias("base"), F.bool_or((C("k") == 1) & C("reason").isNull()).alias("ground_good"),
        F.min(F.when(C("reason").rlike(AMBIGUOUS), F.struct("k", "reason"))).alias("odd"),
    )
    support = groups.groupBy("m").agg(F.count_if("supported").alias("tiers_wanted"))
    base = ring.select("m", C("home").alias("base"), "low", C("group_raw").alias("base_raw"), C("members").alias("base_members"), "tolerance")
    one = models.join(stats, "m", "left").join(support, "m", "left").join(base, ["m", "base"], "left")
    top = F.least("size_y", floor_bottom(C("ground"), C("upper"), C("last") + 1) + slab)
    one = stored(one.withColumn("height", top), "models")
    walk = levels.join(one.select("m", "last"), "m").filter("k <= last")
    own = runs(walk.filter("home IS NOT NULL").select("m", "k", "home"), ["m"], "k", "home").join(ring, ["m", "home"])
    order = W.partitionBy("m").orderBy("run")
    own = own.withColumns({"again": F.row_number().over(W.partitionBy("m", "home").orderBy("run")) > 1, "below": F.lag("ring").over(order), "next": F.lead("first").over(order)})
    own = stored(own.withColumn("off", C("below").isNotNull() & ~rings.contains_ring(C("below"), C("ring"))), "runs")
    last_raw = own.groupBy("m").agg(F.max_by("group_raw", "run").alias("last_raw"))
    upper = levels.join(one.select("m", "last"), "m").filter("k > last AND reason IS NULL").join(last_raw, "m").filter(C("raw") > C("last_raw") * UPPER_SHARE).select("m").distinct()
    rank = {name: n for n, name in enumerate(GATES)}
    closed = lambda name, test: F.when(test, F.struct(F.lit(rank[name]).alias("rank"), F.lit(0).alias("k"), F.lit(0).alias("kind"), F.lit(GATES[name]).alias("reason")))
    whole = one.select(
        "m", F.explode(F.array_compact(F.array(
            closed("few", C("floors") < p.min_floors), F.when(C("odd").isNotNull(), F.struct(F.lit(rank["ambiguous"]).alias("rank"), F.lit(0).alias("k"), F.lit(0).alias("kind"), F.concat(F.lit(GATES["ambiguous"]), C("odd.reason")).alias("reason"))),
            closed("ground", ~F.coalesce("ground_good", F.lit(False))), closed("valid", F.coalesce("valid", F.lit(0)) < p.min_valid_fraction * C("floors")), closed("repeated", F.coalesce("tiers_wanted", F.lit(0)) == 0),
            closed("distinct", C("tiers_wanted") > p.max_tiers), closed("base", C("base").isNull()), closed("envelope", C("low")), closed("height", C("height") < p.min_height_coverage * C("size_y")),
            closed("supported", C("last") < p.min_valid_fraction * C("floors")),
        ))).alias("gate"),
    ).select("m", "gate.*")
    step = lambda df, k, kind: df.select("m", F.lit(rank["walk"]).alias("rank"), C(k).cast("int").alias("k"), F.lit(kind).alias("kind"), F.lit(WALK[kind]).alias("reason"))
    above = upper.select("m", F.lit(rank["upper"]).alias("rank"), F.lit(0).alias("k"), F.lit(0).alias("kind"), F.lit(GATES["upper"]).alias("reason"))
    gates = reduce(DataFrame.unionByName, [whole, step(walk.filter("home IS NULL"), "k", 0), step(own.filter("again"), "first", 1), step(own.filter("off"), "first", 2), above])
    refused = gates.groupBy("m").agg(F.min(F.struct("rank", "k", "kind", "reason"))["reason"].alias("reason"))
    lower = F.when(C("run") == 0, F.lit(0.0)).otherwise(floor_bottom(C("ground"), C("upper"), C("first")))
    tier = F.struct("run", lower.alias("bottom"), F.coalesce(floor_bottom(C("ground"), C("upper"), C("next")), C("height")).alias("top"), "ring")
    built = own.join(one.select("m", "ground", "upper", "height"), "m").groupBy("m").agg(
        F.array_sort(F.collect_list(tier)).alias("tiers"), F.min_by("area", "run").alias("area"), F.max(F.abs("change")).alias("max_change"), F.array_sort(F.collect_set("method")).alias("methods")
    )
    given = walk.join(ring.select("m", "home", "middle", C("area").alias("home_area")), ["m", "home"]).filter("given IS NOT NULL")
    regular = given.groupBy("m").agg(F.count_if(C("clean") != C("middle")).alias("regularized"), F.max(F.abs(C("home_area") / C("raw") - 1)).alias("regular_change"))
    mended = levels.filter("reason IS NULL").groupBy("m").agg(F.count_if((C("island_area") > 0) | (C("hole_area") > 0)).alias("mended"), F.sum("island_area").alias("island_area"), F.sum("hole_area").alias("hole_area"))
    bridges = walk.groupBy("m").agg(F.count_if("bridged").alias("bridges"))
    rows = reduce(lambda x, y: x.join(y, "m", "left"), [one, refused, built, regular, mended, bridges])
    good = C("reason").isNull()
    evidence = F.struct("floors", "valid", "last", "base_members", C("base_raw") / (C("size_x") * C("size_z")), "max_change", "tolerance", "methods", "regularized", "regular_change", "bridges", "mended", "island_area", "hole_area").cast(EVIDENCE)
    confidence = F.least(F.lit(0.85), F.greatest(F.lit(0.0), 0.60 + 0.20 * C("valid") / C("floors") - C("max_change") * 0.5))
    shown = F.transform("tiers", lambda t: F.struct(t["bottom"].alias("bottom"), t["top"].alias("top"), t["ring"].alias("ring"))).cast(TIERS)
    return rows.select("m", F.when(good, shown).alias("tiers"), F.when(good, C("height")).alias("height"), F.when(good, C("area")).alias("area"), F.when(good, confidence).alias("confidence"), "reason", F.when(good, evidence).alias("evidence"))


def part_plans(parts: DataFrame, models: DataFrame, side: int, params: GridMassing, elevated: bool) -> DataFrame:
    """m, body, cells, most, first, tiers, height, area, confidence, reason of each part (cells with m, body, component, k, i, j) as a grid of its own."""
    shape = stored(cropped(parts, elevated), "shapes")
    sizes = parts.groupBy("m", "body").agg(F.count("*").alias("cells")).join(parts.groupBy("m", "body", "k").agg(F.count("*").alias("n")).groupBy("m", "body").agg(F.max("n").alias("most")), ["m", "body"])
    c, slab = F.col, FloorParams().slab
    base = lambda k: F.when(k <= 1, F.lit(0.0)).otherwise(slab + c("ground") + (k - 2) * (c("upper") + slab))
    span = lambda v, size: F.least(c(f"{v}1") * c("cell"), c(size)) - (c(f"{v}0") - 1) * c("cell")
    own = shape.join(models, "m")
    made = own.filter("reason IS NULL").select(
        c("body").alias("m"), "cell", span("i", "size_x").alias("size_x"), (F.least("size_y", base(c("last") + 1) + slab) - base(c("first"))).alias("size_y"), span("j", "size_z").alias("size_z"),
        F.when(c("first") == 1, c("ground")).otherwise(c("upper")).alias("ground"), "upper", (c("last") - c("first") + 1).cast("int").alias("floors"),
    )
    moved = parts.join(shape.filter("reason IS NULL").select("m", "body", "first", "i0", "j0"), ["m", "body"])
    cells = moved.select(c("body").alias("m"), *((c(v) - c(o) + 1).cast("int").alias(v) for v, o in (("k", "first"), ("i", "i0"), ("j", "j0"))))
    plans = grid_plans(cells, stored(made, "made"), side, params).select(c("m").alias("body"), "tiers", "height", "area", "confidence", c("reason").alias("__why"))
    rows = shape.select("m", "body", "first", "reason").join(sizes, ["m", "body"]).join(plans, "body", "left")
    return rows.select("m", "body", "cells", "most", "first", "tiers", "height", "area", "confidence", F.coalesce("reason", "__why").alias("reason"))


def split_plans(cells: DataFrame, models: DataFrame, side: int, params: GridMassing = GridMassing(), split: Split = Split()) -> DataFrame:
    """part_plans of the vertical bodies of each model, and source_reason: null where all substantial bodies have a plan; a body is tiny, and left out of
    that, with at most max_tiny_cells cells a floor and max_tiny_fraction of the model's cells. All outputs of a model, or none."""
    both = stored(masks.bodies(cells, side, "vertical"), "bodies")
    plans = part_plans(both, models, side, params, elevated=False)
    own = W.partitionBy("m")
    tiny = (F.col("most") <= split.max_tiny_cells) & (F.col("cells") <= F.sum("cells").over(own) * split.max_tiny_fraction)
    rows = stored(plans, "plans").withColumn("tiny", tiny)
    count = F.sum((~F.col("tiny")).cast("int")).over(own)
    worst = F.min(F.when(~F.col("tiny"), F.col("reason"))).over(own)
    return rows.withColumn("source_reason", F.when(count < 2, "one body only").when(count > split.max_bodies, "too many bodies").otherwise(worst))


def residual_plans(cells: DataFrame, models: DataFrame, side: int, params: GridMassing | None = None, residual: Residual = Residual()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rest): the unbranched runs of floors of each model that make a plan and hold at least min_extract_fraction of its cells, and the cells that
    no accepted run holds: together each cell once."""
    bodies = stored(masks.bodies(cells, side, "chain"), "bodies")
    plans = part_plans(bodies, models, side, params or configured(GridMassing, RESIDUAL_GRID), elevated=True)
    total = F.sum("cells").over(W.partitionBy("m"))
    good = F.col("reason").isNull() & (F.col("most") > residual.max_tiny_cells) & (F.col("cells") >= total * residual.min_extract_fraction)
    accepted = stored(plans.withColumn("__ok", good).filter("__ok").drop("__ok"), "accepted")
    return accepted, bodies.join(accepted.select("m", "body"), ["m", "body"], "left_anti").select(*CELL)


#: What each way of the last pass is called, and how far it is trusted; least sides and height of an envelope.
WAYS = {"final segment hull": 0.48, "final aggregate hull": 0.35, "final envelope box": 0.25}
ENVELOPE = (10.0, 30.0)


def final_plans(cells: DataFrame, models: DataFrame, side: int, params: Final = Final()) -> DataFrame:
    """m, n, method, ring (about the middle of the model's box), bottom, top, area, confidence: a plan for every model (m, cell, size_x, size_y, size_z, ground, upper, floors),
    by the first way that gives one for all of it: the hull of each unbranched run of floors, where all that are large enough have one and there are at most max_bodies; the hull of all
    cells over the whole height; the box. Cells are m, k, i, j. n numbers a model's plans by their first floor and least cell."""
    p, slab = params, FloorParams().slab
    models = models.select("m", "cell", "size_x", "size_y", "size_z", "ground", "upper", "floors")
    own = stored(masks.bodies(cells, side, "chain"), "bodies")
    shape = own.groupBy("m", "body").agg(F.count("*").alias("cells"), F.min("k").alias("first"), F.max("k").alias("last"), *(f(v).alias(f"{v}{e}") for v in "ij" for e, f in ((0, F.min), (1, F.max)))).join(models, "m")
    at = lambda v, size: F.greatest(-C(size) / 2, F.least(v * C("cell") - C(size) / 2, C(size) / 2))
    sides = {f"w{v}": at(C(f"{v}1"), size) - at(C(f"{v}0") - 1, size) for v, size in (("i", "size_x"), ("j", "size_z"))}
    shape = shape.withColumns(sides | {"bottom": floor_bottom(C("ground"), C("upper"), C("first")), "top": F.least("size_y", floor_bottom(C("ground"), C("upper"), C("last") + 1) + slab)})
    large = (C("cells") >= p.min_segment_cells) & (F.least("wi", "wj") >= p.min_width) & (C("top") - C("bottom") >= p.min_height)
    usable = stored(shape.filter(large).select("m", "body", "first", "bottom", "top"), "usable")
    # of a row of cells its two ends are enough for the hull
    rows = own.groupBy("m", "body", "i").agg(F.min("j").alias("j0"), F.max("j").alias("j1")).join(models, "m")
    corner = lambda i, j: F.struct(at(i, "size_x").alias("x"), at(j, "size_z").alias("z"))
    ends = rows.select("m", "body", F.explode(F.array(*(corner(C("i") - di, j) for di in (0, 1) for j in (C("j0") - 1, C("j1"))))).alias("q")).distinct()

    def hulls(points: DataFrame, keys: list[str]) -> DataFrame:
        made = points.groupBy(*keys).agg(F.collect_set("q").alias("qs")).withColumn("ring", polygons.as_hull("qs")["value"])
        wide = lambda v: F.array_max(F.transform("ring", lambda q: q[v])) - F.array_min(F.transform("ring", lambda q: q[v]))
        return made.filter(C("ring").isNotNull() & (F.least(wide("x"), wide("z")) >= p.min_width)).select(*keys, "ring")

    parts = stored(usable.join(hulls(ends.join(usable.select("m", "body"), ["m", "body"], "left_semi"), ["m", "body"]), ["m", "body"], "left"), "parts")
    whole = parts.groupBy("m").agg(F.count("*").alias("n"), F.count("ring").alias("made")).filter((C("n") == C("made")) & (C("n") <= p.max_bodies)).select("m")
    number = F.row_number().over(W.partitionBy("m").orderBy("first", "body"))
    first = parts.join(whole, "m").select("m", number.alias("n"), F.lit(0).alias("way"), "ring", "bottom", "top")
    rest = stored(models.join(whole, "m", "left_anti").join(hulls(ends.drop("body").distinct().join(whole, "m", "left_anti"), ["m"]), "m", "left"), "rest")
    least, low = ENVELOPE
    ends_of = lambda size: F.greatest(F.lit(least), size) / 2
    box = rings.box_ring(-ends_of(C("size_x")), -ends_of(C("size_z")), ends_of(C("size_x")), ends_of(C("size_z")))
    hull_ok = C("ring").isNotNull() & (C("size_y") >= p.min_height)
    second = rest.select("m", F.lit(1).alias("n"), F.when(hull_ok, 1).otherwise(2).alias("way"), F.when(hull_ok, C("ring")).otherwise(box).alias("ring"), F.lit(0.0).alias("bottom"), F.when(hull_ok, C("size_y")).otherwise(F.greatest(F.lit(low), C("size_y"))).alias("top"))
    ways = F.array(*(F.struct(F.lit(k).alias("method"), F.lit(v).alias("confidence")) for k, v in WAYS.items()))
    plans = first.unionByName(second).withColumn("w", F.get(ways, C("way")))
    return plans.select("m", "n", "w.method", "ring", "bottom", "top", F.abs(rings.signed_area(C("ring"))).alias("area"), "w.confidence")
