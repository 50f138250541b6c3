"""Buildings from the contours of meshes: level sections at fixed shares of the height, groups of like footprints, tiers and their setbacks.

All models are cut, judged and refined together: a sample is a row, its section's segments become a footprint in one pass over all
samples, and each round of the search for a setback is one more pass. A gate is a row (m, rank, k, reason), as in massing.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import FRACTIONS, Massing
from strataframe.functions import motion, outline, polygons, rings
from strataframe.functions.outline import OutlineParams
from strataframe.operators import sections
from strataframe.operators.audit import roof_planes
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.tables import first_like, lower_median, runs
from strataframe.storage import stored

C = F.col
#: Why a sample has no footprint, after the reasons of its section.
SAMPLE = ("invalid simplified boundary", "boundary remains too complex", "small footprint", "narrow fragment")
#: The reasons of the gates in order of rank; the third and the last have their own.
GATES = ("insufficient facade geometry", "short fragment", "", "no persistent building body", "too many independent massing changes", "oscillating footprint", "no usable massing", "body too short after roof trim", "")
TIER = ("offset or expanding upper body", "unusable thin massing tier")
#: Least triangles; shares of the height between which a section with a courtyard or two bodies refuses the model; share of a box that makes a footprint the box;
#: span of a group of two samples; rounds of the search for a setback; least height of a tier.
TRIANGLES, MIDDLE, BOX, SPAN, ROUNDS, THIN = 6, (0.15, 0.85), 0.98, 0.055, 7, 2.0
#: Equipment on a roof: its area against the body below, the share of the height it begins at, the area of the roof plane below it; a trimmed roof: share of
#: the height, area of its plane against the top's, slack in height; a setback's plane: its area against the change.
SMALL, ABOVE, BROAD, HIGH, ROOF, SLACK, LEDGE = 0.45, 0.86, 0.4, 0.80, 0.50, 0.5, 0.25
FOOTPRINT = f"struct<ring:{polygons.RING},area:double,width:double>"


def facade_boxes(segments: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    """by, box of each section's segments (a, b): the box whose four sides they cover, null where there is none."""

    def fit(group: pa.Table) -> list[dict]:
        at = lambda c: np.column_stack([group.column(c).combine_chunks().field(v).to_numpy(zero_copy_only=False) for v in "xz"])
        ring = outline.facade_box(at("a"), at("b"), tolerance)
        return [{"box": ring and [{"x": float(x), "z": float(z)} for x, z in ring]}]

    rows = segments.filter("a IS NOT NULL AND b IS NOT NULL")
    return by_sorted_group(rows.select(*by, "a", "b"), by, fit, [("box", polygons.RING)])


def sampled(triangles: DataFrame, cuts: DataFrame, params: Massing = Massing()) -> DataFrame:
    """m, y, foot (ring, area, width), raw_area, repaired (gaps closed), fallback (the box of an open or branched section), reason (null with a foot) of each row of
    cuts (m, y). triangles: m, points (three of x, y, z). Cuts without segments have the reason that they are no cross-section."""
    p = params
    own = cuts.select("m", "y").distinct().groupBy("m").agg(F.collect_list("y").alias("ys"))
    segments = stored(sections.at_heights(triangles.select("m", "points").join(own, "m"), C("ys")).select("m", "y", "a", "b"), "segments")
    loops = stored(sections.mended_loops(segments, ["m", "y"], OutlineParams(p.weld_tolerance, p.max_seam_gap, p.max_corner_gap, p.max_corner_extension)), "loops")
    found = sections.outlines(loops, ["m", "y"])
    rows = found.join(facade_boxes(segments, ["m", "y"], p.simplify_tolerance), ["m", "y"], "left")
    fallback = C("reason").isin("open cross-section", "branched cross-section") & C("box").isNotNull()
    rows = rows.withColumn("fallback", fallback).withColumn("raw", F.when(C("fallback"), C("box")).otherwise(C("ring")))
    rows = rows.withColumn("thin", polygons.as_simplified("raw", F.lit(p.simplify_tolerance))["value"]).withColumn("frame", polygons.as_box("thin")["value"])
    area = F.abs(rings.signed_area(C("thin")))
    rows = rows.withColumns({"area": area, "width": F.least("frame.width", "frame.depth")})
    tests = (C("thin").isNull(), F.size("thin") > p.max_vertices, C("area") < p.min_area, C("width") < p.min_width)
    reason = F.coalesce(F.when(~C("fallback"), C("reason")), *(F.when(t, text) for t, text in zip(tests, SAMPLE)))
    ring = F.when((C("area") / (C("frame.width") * C("frame.depth")) >= BOX) & C("box").isNotNull(), C("box")).otherwise(C("thin"))
    ring = F.when(rings.signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)
    rows = rows.withColumns({"reason": reason, "out": ring})
    foot = F.struct(C("out").alias("ring"), F.abs(rings.signed_area(C("out"))).alias("area"), C("width").alias("width")).cast(FOOTPRINT)
    rows = rows.select("m", "y", F.when(C("reason").isNull(), foot).alias("foot"), F.abs(rings.signed_area(C("raw"))).alias("raw_area"), (C("seams") + C("corners")).alias("repaired"), "fallback", "reason")
    out = cuts.select("m", "y").distinct().join(rows, ["m", "y"], "left")
    return out.withColumn("reason", F.when(C("foot").isNull(), F.coalesce("reason", F.lit("no cross-section"))))


def level_planes(triangles: DataFrame) -> DataFrame:
    """m, y, area: the level faces (m, t, points) by quarters of height."""
    face = motion.flat_face(*(C("points")[k] for k in range(3)), 0.995, 0.5)
    faces = triangles.withColumn("f", face).filter("f IS NOT NULL").select("m", "t", "f.y", "f.area")
    return roof_planes(faces, ["m"], "t").select("m", "y", "area")


def setbacks(triangles: DataFrame, steps: DataFrame, params: Massing = Massing()) -> DataFrame:
    """steps (m, run, low, high, own, next: footprints) with low and high nearer: in each round all are cut half way, where the cut is like
    the one below it is the new low, where like the one above the new high, and else the search ends."""
    found = steps.withColumn("live", F.lit(True))
    for _ in range(ROUNDS):
        found = stored(found.withColumn("y", (C("low") + C("high")) / 2), "setbacks")
        live = found.filter("live").select("m", "y")
        if live.isEmpty():
            break
        cut = sampled(triangles, live, params).select("m", "y", "foot")
        rows = found.join(cut, ["m", "y"], "left")
        like = lambda c: F.when(C("live") & C("foot").isNotNull(), rings.similar(C("foot"), C(c)))
        rows = rows.withColumns({"below": F.coalesce(like("own"), F.lit(False)), "above": F.coalesce(like("next"), F.lit(False))})
        found = rows.select("m", "run", F.when(C("below"), C("y")).otherwise(C("low")).alias("low"), F.when(C("above") & ~C("below"), C("y")).otherwise(C("high")).alias("high"), "own", "next", (C("below") | C("above")).alias("live"))
    return found.select("m", "run", "low", "high")


def contour_plans(triangles: DataFrame, params: Massing = Massing()) -> DataFrame:
    """m, tiers (bottom, top, ring in the frame), at (the frame's middle and base), yaw, height, area, roof_trim, confidence, samples, repaired, fallbacks, reason for each
    model of triangles (m, t: their order, points): what its repeated contours are as a building, or why they are none. A model's samples are eleven; nulls in a
    point drop a triangle."""
    p = params
    # written, as every round of sections reads them
    whole = stored(triangles.filter(~F.exists("points", lambda q: q["x"].isNull() | q["y"].isNull() | q["z"].isNull())), "triangles")
    height = lambda f: f(F.transform("points", lambda q: q["y"]))
    models = stored(whole.groupBy("m").agg(F.count("*").alias("n"), F.min(height(F.array_min)).alias("y0"), F.max(height(F.array_max)).alias("y1")), "models")
    at = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(f).alias("share"), (C("y0") + (C("y1") - C("y0")) * f).alias("y")) for i, f in enumerate(FRACTIONS))))
    wanted = models.filter((C("n") >= TRIANGLES) & (C("y1") - C("y0") >= p.min_height)).select("m", at.alias("c")).select("m", "c.*")
    found = stored(wanted.join(sampled(whole, wanted, p), ["m", "y"]), "samples")
    good = found.filter("reason IS NULL")
    a, b = good.select("m", C("i").alias("a"), C("foot").alias("fa")), good.select("m", C("i").alias("b"), C("foot").alias("fb"))
    near = stored(a.join(b, "m").filter("a < b").filter(rings.similar(C("fb"), C("fa"))).select("m", "a", "b"), "like")
    placed = stored(good.join(first_like(good, "m", "i", near), ["m", "i"]), "placed")
    middle = lower_median(placed.withColumn("size", C("foot.area")), ["m", "group"], ["size", "i"]).select("m", "group", C("foot").alias("rep"))
    groups = placed.groupBy("m", "group").agg(F.count("*").alias("members"), F.min("share").alias("first"), F.max("share").alias("last"))
    main = F.row_number().over(W.partitionBy("m").orderBy(F.desc("members"), "group")) == 1
    groups = groups.withColumn("main", main).withColumn("supported", C("main") | ((C("members") >= 2) & (C("last") - C("first") >= SPAN)))
    groups = stored(groups.join(middle, ["m", "group"]), "groups")
    kept = placed.join(groups.filter("supported").select("m", "group"), ["m", "group"])
    stretches = runs(kept, ["m"], "i", "group").join(groups.select("m", "group", "rep"), ["m", "group"])
    place = kept.select("m", "i", "y", "share")
    ends = [place.select("m", C("i").alias(k), C("y").alias(f"{k}_y"), C("share").alias(f"{k}_share")) for k in ("first", "last")]
    stretches = stretches.join(ends[0], ["m", "first"]).join(ends[1], ["m", "last"])
    stretches = stored(stretches.withColumn("again", F.row_number().over(W.partitionBy("m", "group").orderBy("run")) > 1).select("m", "run", "group", "rep", "first_y", "first_share", "last_y", "again"), "runs")
    planes = stored(level_planes(whole), "planes")
    # a small body that begins near the top is equipment where a broad roof lies between it and the body below
    order = W.partitionBy("m").orderBy("run")
    top = stretches.withColumns({"upper": F.row_number().over(W.partitionBy("m").orderBy(F.desc("run"))) == 1, "under": F.lag(F.struct("rep", "last_y")).over(order)})
    small = top.filter(C("upper") & C("under").isNotNull() & (C("rep.area") < C("under.rep.area") * SMALL) & (C("first_share") >= ABOVE))
    bare = small.join(planes, "m").filter((C("y") > C("under.last_y")) & (C("y") <= C("first_y")) & (C("area") >= C("under.rep.area") * BROAD)).groupBy("m", "run").agg(F.min("y").alias("bare_y"))
    used = stored(stretches.join(bare, ["m", "run"], "left_anti"), "used")
    last = used.groupBy("m").agg(F.max_by(F.struct("rep", "last_y"), "run").alias("l"))
    roof = models.join(bare.select("m", "bare_y"), "m", "left").join(last, "m", "left").withColumn("roof", F.coalesce("bare_y", "y1"))
    trims = roof.join(planes, "m").filter((C("y") >= C("y0") + (C("y1") - C("y0")) * HIGH) & (C("y") >= C("l.last_y") - SLACK) & (C("y") < C("roof") - SLACK) & (C("area") >= C("l.rep.area") * ROOF)).groupBy("m").agg(F.min("y").alias("trim_y"))
    roof = stored(roof.join(trims, "m", "left").withColumn("roof", F.coalesce("trim_y", "roof")).select("m", "n", "y0", "y1", "roof", C("l").isNotNull().alias("usable")), "roofs")
    after = lambda c: F.lead(c).over(order)
    steps = used.withColumns({"next": after("rep"), "high": after("first_y")}).filter("next IS NOT NULL").withColumn("off", ~rings.contains_probe(C("rep.ring"), C("next.ring"), p.simplify_tolerance * 1.5))
    steps = stored(steps.select("m", "run", C("last_y").alias("low"), "high", C("rep").alias("own"), "next", "off"), "steps")
    refined = stored(setbacks(whole, steps.drop("off"), p), "refined").join(steps.select("m", "run", F.abs(C("own.area") - C("next.area")).alias("change")), ["m", "run"])
    refined = refined.withColumns({"half": (C("low") + C("high")) / 2, "reach": F.greatest(F.lit(1.0), (C("high") - C("low")) / 2)})
    # of two planes as near the upper one
    ledges = refined.join(planes, "m").withColumn("off", F.abs(C("y") - C("half"))).filter((C("off") < C("reach")) & (C("area") > C("change") * LEDGE)).groupBy("m", "run").agg(F.min_by("y", F.struct("off", -C("y"))).alias("ledge"))
    tops = refined.join(ledges, ["m", "run"], "left").select("m", "run", F.coalesce("ledge", "half").alias("step_y"))
    tiers = used.join(tops, ["m", "run"], "left").join(roof.select("m", "y0", "y1", "roof"), "m").withColumn("top", F.coalesce("step_y", "roof")).withColumn("bottom", F.coalesce(F.lag("top").over(order), "y0"))
    tiers = stored(tiers.select("m", "run", "rep", "bottom", "top", "y0"), "tiers")
    sums = groups.groupBy("m").agg(F.count_if("supported").alias("kinds"), F.max(F.when(C("main"), F.struct("members", (C("last") - C("first")).alias("span")))).alias("main"))
    odd = found.filter(C("share").between(*MIDDLE) & C("reason").isin(sections.ALONE[0], sections.ALONE[2]))
    gate = lambda rank, k, kind, reason: F.struct(F.lit(rank).alias("rank"), k.cast("int").alias("k"), F.lit(kind).alias("kind"), reason.alias("reason"))
    rows = roof.join(sums, "m", "left")
    closed = lambda rank, test: F.when(F.coalesce(test, F.lit(True)), gate(rank, F.lit(0), 0, F.lit(GATES[rank])))
    plain = rows.select("m", F.explode(F.array_compact(F.array(
        closed(0, C("n") < TRIANGLES), closed(1, C("y1") - C("y0") < p.min_height), closed(3, (C("main.members") < p.min_support_samples) | (C("main.span") < p.min_support_span)), closed(4, C("kinds") > p.max_tiers),
        closed(6, ~C("usable")), closed(7, C("roof") - C("y0") < p.min_height),
    ))).alias("g"))
    gates = [plain, odd.select("m", gate(2, C("i"), 0, C("reason")).alias("g")), stretches.filter("again").select("m", gate(5, C("run"), 0, F.lit(GATES[5])).alias("g"))]
    gates += [steps.filter("off").select("m", gate(8, C("run"), 0, F.lit(TIER[0])).alias("g")), tiers.filter(C("top") - C("bottom") < THIN).select("m", gate(8, C("run"), 1, F.lit(TIER[1])).alias("g"))]
    refused = reduce(DataFrame.unionByName, gates).groupBy("m").agg(F.min("g")["reason"].alias("reason"))
    base = tiers.filter("run = 0").select("m", C("rep.ring").alias("base")).withColumn("f", polygons.as_box("base")["value"])
    middle = F.struct(*(((C("f.ring")[0][v] + C("f.ring")[2][v]) / 2).alias(v) for v in "xz"))
    base = base.select("m", middle.alias("c"), C("f.angle").alias("turn"))

    def local(q: Column) -> Column:
        dx, dz = q["x"] - C("c.x"), q["z"] - C("c.z")
        return F.struct((dx * F.cos("turn") + dz * F.sin("turn")).alias("x"), (dz * F.cos("turn") - dx * F.sin("turn")).alias("z"))

    tier = F.struct("run", (C("bottom") - C("y0")).alias("bottom"), (C("top") - C("y0")).alias("top"), F.transform("rep.ring", local).alias("ring"))
    built = tiers.join(base, "m").groupBy("m").agg(F.array_sort(F.collect_list(tier)).alias("tiers"), F.min_by("rep.area", "run").alias("area"), F.first("c").alias("c"), F.first("turn").alias("turn"))
    figures = good.groupBy("m").agg(F.count("*").cast("int").alias("samples"), F.sum("repaired").cast("int").alias("repaired"), F.count_if("fallback").cast("int").alias("fallbacks"))
    rows = reduce(lambda x, y: x.join(y, "m", "left"), [rows, refused, built, figures])
    ok = C("reason").isNull()
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.52 + 0.35 * C("samples") / len(FRACTIONS) + 0.13 * C("main.span") - 0.006 * C("fallbacks") - 0.003 * C("repaired")))
    shown = F.transform("tiers", lambda t: F.struct(t["bottom"].alias("bottom"), t["top"].alias("top"), t["ring"].alias("ring")))
    values = {"tiers": shown, "at": motion.vector(C("c.x"), C("y0"), C("c.z")), "yaw": -C("turn"), "height": C("roof") - C("y0"), "area": C("area"), "roof_trim": C("y1") - C("roof"), "confidence": confidence, "samples": C("samples"), "repaired": C("repaired"), "fallbacks": C("fallbacks")}
    return rows.select("m", *(F.when(ok, v).alias(k) for k, v in values.items()), "reason")


def diagnosis(triangles: DataFrame, params: Massing = Massing()) -> DataFrame:
    """m, samples (valid ones), groups, persistent (groups of enough samples and span), most (samples of the largest), span (of the share of the height, of that one), failures (reason, n of the samples without a footprint),
    reason: what the contours of each model of triangles show, without a plan."""
    p = params
    whole = triangles.filter(~F.exists("points", lambda q: q["x"].isNull() | q["y"].isNull() | q["z"].isNull()))
    height = lambda f: f(F.transform("points", lambda q: q["y"]))
    models = stored(whole.groupBy("m").agg(F.count("*").alias("n"), F.min(height(F.array_min)).alias("y0"), F.max(height(F.array_max)).alias("y1")), "models")
    at = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(f).alias("share"), (C("y0") + (C("y1") - C("y0")) * f).alias("y")) for i, f in enumerate(FRACTIONS))))
    wanted = models.select("m", at.alias("c")).select("m", "c.*")
    found = stored(wanted.join(sampled(whole, wanted, p), ["m", "y"]), "samples")
    good = found.filter("reason IS NULL")
    a, b = good.select("m", C("i").alias("a"), C("foot").alias("fa")), good.select("m", C("i").alias("b"), C("foot").alias("fb"))
    near = a.join(b, "m").filter("a < b").filter(rings.similar(C("fb"), C("fa"))).select("m", "a", "b")
    groups = good.join(first_like(good, "m", "i", near), ["m", "i"]).groupBy("m", "group").agg(F.count("*").alias("count"), (F.max("share") - F.min("share")).alias("span"))
    lasting = (C("count") >= p.min_support_samples) & (C("span") >= p.min_support_span)
    sums = groups.groupBy("m").agg(F.count("*").alias("groups"), F.count_if(lasting).alias("persistent"), F.max(F.struct("count", (-C("group")).alias("first"), "span")).alias("main"), F.sum("count").alias("samples"))
    failed = found.filter("reason IS NOT NULL").groupBy("m", "reason").agg(F.count("*").alias("n")).groupBy("m").agg(F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("failures"))
    rows = models.join(sums, "m", "left").join(failed, "m", "left").na.fill(0, ["samples", "groups", "persistent"])
    reason = F.when(C("y1") - C("y0") < p.min_height, GATES[1]).when(C("n") < TRIANGLES, GATES[0]).when(F.coalesce((C("main.count") < p.min_support_samples) | (C("main.span") < p.min_support_span), F.lit(True)), GATES[3])
    return rows.select("m", "samples", "groups", "persistent", F.coalesce("main.count", F.lit(0)).alias("most"), F.coalesce("main.span", F.lit(0.0)).alias("span"), "failures", reason.alias("reason"))
