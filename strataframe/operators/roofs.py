"""Buildings from a level roof whose outline the walls below bear out, for models whose contours are not closed.

A roof is a band of level faces. Its outline is what is left of the faces' edges when shared ones cancel, after edges are split where another
face's corner lies on them. The outline is held against sections at six heights: each segment is given to the edge that it runs along, and the
parts of each edge that are covered are intervals. All roofs of all models are looked at together.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import FACADE_FRACTIONS, Massing
from strataframe.functions import motion, polygons, rings
from strataframe.functions.outline import OutlineParams, Section
from strataframe.operators import contours, sections
from strataframe.operators.audit import roof_bands
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.tables import covered_length
from strataframe.storage import stored

C = F.col
#: What a level face of a band may slope and rise, the height of a band, corners of a band, bands of a model, share of the height from which a
#: band may be the roof, area of the faces against the outline's.
LEVEL, RISE, BAND, CORNERS, BANDS, HIGH, COVERED = 0.99, 0.7, 0.6, 1600, 8, 0.78, (0.92, 1.06)
#: Fixed values of an edge split at a corner: largest distance, in all and as a share of the weld.
SPLIT, SPLIT_SHARE = 0.06, 0.1
#: Fixed values of a segment along an edge: least product of the directions, least length along it; how far from it, as a share of the width and between which.
ALONG, LENGTH, NEAR_SHARE, NEAR = 0.975, 0.05, 0.015, (1.2, 3.0)
#: Fixed values of a good section: least support of the outline, most of it elsewhere outside and inside; of all: least good ones, the highest that the first and the lowest that
#: the last may be, least span; most of the outline without support; an edge without: most covered, least length and share.
SUPPORT, OUTSIDE, INSIDE, GOOD, FIRST, LAST, SPAN, BARE, EDGE, EDGE_LENGTH, EDGE_SHARE = 0.72, 0.12, 0.16, 4, 0.22, 0.72, 0.5, 0.26, 0.2, 5.0, 0.04
#: The reasons.
COMPLEX, MANIFOLD, SHAPE, TINY, LOOSE, LACKING, EDGES = (
    "planar roof triangulation too complex", "non-manifold planar roof", "invalid or excessive roof boundary", "roof too small or narrow", "roof surface does not cover its boundary", "roof footprint lacks persistent facade support", "too many unsupported roof edges",
)
NO_BAND, NO_ROOF = "no broad planar roof near source top", "no roof with verified facade support"
ROOF = ["m", "low"]


def bands(triangles: DataFrame, models: DataFrame, params: Massing = Massing()) -> tuple[DataFrame, DataFrame]:
    """(candidates, faces): of each model's bands of level faces near its top the broadest, m, low, y, area, rank; and their faces m, low, t, points, area."""
    face = motion.flat_face(*(C("points")[k] for k in range(3)), LEVEL, RISE)
    flat = stored(triangles.withColumn("f", face).filter("f IS NOT NULL").select("m", "t", "points", "f.y", "f.area"), "flat")
    found = roof_bands(flat.select("m", "y", "area"), ["m"], BAND).join(models, "m")
    found = found.filter((C("y") >= C("y0") + (C("y1") - C("y0")) * HIGH) & (C("y") - C("y0") >= params.min_height) & (C("area") >= params.min_area))
    rank = F.row_number().over(W.partitionBy("m").orderBy(F.desc("area"), "low"))
    found = stored(found.withColumn("rank", rank).filter(C("rank") <= BANDS).select("m", "low", "y", "area", "rank", "y0", "y1"), "bands")
    own = flat.join(found.select("m", "low"), "m").filter((C("y") >= C("low")) & (C("y") - C("low") <= BAND))
    return found, own.select("m", "low", "t", "points", "area")


def roof_edges(faces: DataFrame, weld: float) -> DataFrame:
    """m, low, a, b, total (area of the faces, each once), reason: the edges of a band's faces that border one face only. A band has at most CORNERS corners."""

    def outline_of(group: pa.Table) -> list[dict]:
        place = lambda r: tuple(r["t"].values()) if isinstance(r["t"], dict) else r["t"]
        rows = sorted(group.select(["t", "points", "area"]).to_pylist(), key=place)
        s = Section(weld)
        corners = [tuple(s.vertex((p["x"], p["z"])) for p in r["points"]) for r in rows]
        whole = {}  # a face that repeats counts once
        for c, r in zip(corners, rows):
            if len(set(c)) == 3:
                whole.setdefault(tuple(sorted(c)), (c, r["area"]))
        total = sum(area for _, area in whole.values())
        if len(s.vertices) > CORNERS:
            return [{"total": total, "reason": COMPLEX}]
        v = np.array(s.vertices)
        near = min(SPLIT, weld * SPLIT_SHARE)
        count: dict[tuple[int, int], int] = {}
        for c, _ in whole.values():
            for a, b in zip(c, c[1:] + c[:1]):
                delta = v[b] - v[a]
                t = (v - v[a]) @ delta / (delta @ delta)
                off = np.hypot(*(v - v[a] - t[:, None] * delta).T)
                on = np.flatnonzero((t > 1e-5) & (t < 1 - 1e-5) & (off <= near))
                path = [a, *(k for k in on[np.argsort(t[on], kind="stable")].tolist() if k not in (a, b)), b]
                for e in zip(path, path[1:]):
                    count[min(e), max(e)] = count.get((min(e), max(e)), 0) + 1
        if max(count.values(), default=0) > 2:
            return [{"total": total, "reason": MANIFOLD}]
        at = lambda k: dict(zip("xz", s.vertices[k]))
        return [{"a": at(i), "b": at(j), "total": total} for (i, j), n in count.items() if n == 1] or [{"total": total}]

    point = "struct<x:double,z:double>"
    return by_sorted_group(faces.select(*ROOF, "t", "points", "area"), ROOF, outline_of, [("a", point), ("b", point), ("total", "double"), ("reason", "string")])


def roof_outlines(faces: DataFrame, params: Massing = Massing()) -> DataFrame:
    """m, low, ring, area, width, coverage, repairs, holes, reason of each band of faces."""
    p = params
    edges = stored(roof_edges(faces, p.weld_tolerance), "edges")
    sums = edges.groupBy(*ROOF).agg(F.max("total").alias("total"), F.max("reason").alias("why"))
    loops = stored(sections.mended_loops(edges.select(*ROOF, "a", "b"), ROOF, OutlineParams(p.weld_tolerance, p.max_seam_gap, p.max_corner_gap, p.max_corner_extension)), "loops")
    found = sections.outlines(loops, ROOF, holes=True).join(sums, ROOF)
    rows = found.withColumn("thin", polygons.as_simplified("ring", F.lit(p.simplify_tolerance))["value"]).withColumn("box", polygons.as_box("thin")["value"])
    rows = rows.withColumns({"size": F.abs(rings.signed_area(C("thin"))), "width": F.least("box.width", "box.depth")}).withColumn("coverage", C("total") / C("size"))
    tests = ((C("thin").isNull() | (F.size("thin") > p.max_vertices), SHAPE), ((C("size") < p.min_area) | (C("width") < p.min_width), TINY), (~C("coverage").between(*COVERED), LOOSE))
    reason = F.coalesce("why", F.concat(F.lit("roof "), C("reason")), *(F.when(t, text) for t, text in tests))
    ring = F.when(rings.signed_area(C("thin")) < 0, F.reverse("thin")).otherwise(C("thin"))
    return rows.select(*ROOF, ring.alias("ring"), C("size").alias("area"), "width", "coverage", (C("seams") + C("corners")).alias("repairs"), "holes", reason.alias("reason"))


def facade_support(triangles: DataFrame, roofs: DataFrame) -> DataFrame:
    """m, low, good (sections), mean (support of the good ones), bare (share of the outline without support), reason of roofs (m, low, y0, y, ring, width)."""
    heights = F.array(*(F.struct(F.lit(f).alias("share"), (C("y0") + (C("y") - C("y0")) * f).alias("h")) for f in FACADE_FRACTIONS))
    wanted = stored(roofs.select(*ROOF, "ring", "width", F.explode(heights).alias("c")).select(*ROOF, "ring", "width", "c.*"), "heights")
    cuts = wanted.groupBy("m").agg(F.collect_set("h").alias("hs"))
    # heights of several roofs of a model may be the same one
    cut = sections.at_heights(triangles.select("m", "points").join(cuts, "m"), C("hs")).select("m", C("y").alias("h"), "a", "b")
    own = cut.withColumn("s", F.monotonically_increasing_id()).join(wanted, ["m", "h"])
    own = stored(own.withColumn("near", F.greatest(F.lit(NEAR[0]), F.least(F.lit(NEAR[1]), C("width") * NEAR_SHARE))), "cuts")
    edge = wanted.groupBy(*ROOF).agg(F.first("ring").alias("ring")).select(*ROOF, F.posexplode(rings.edges(C("ring"))).alias("n", "e"))
    edge = edge.withColumn("size", F.hypot(C("e.b.x") - C("e.a.x"), C("e.b.z") - C("e.a.z")))
    edge = stored(edge.withColumns({f"d{v}": (C(f"e.b.{v}") - C(f"e.a.{v}")) / C("size") for v in "xz"}), "outline")
    met = own.drop("ring").join(edge, ROOF)
    length = F.hypot(C("b.x") - C("a.x"), C("b.z") - C("a.z"))
    across = lambda p: F.abs(C("dx") * (C(f"{p}.z") - C("e.a.z")) - C("dz") * (C(f"{p}.x") - C("e.a.x")))
    along = lambda p: (C(f"{p}.x") - C("e.a.x")) * C("dx") + (C(f"{p}.z") - C("e.a.z")) * C("dz")
    level = F.abs((C("b.x") - C("a.x")) * C("dx") + (C("b.z") - C("a.z")) * C("dz")) / length
    met = met.withColumns({"da": across("a"), "db": across("b"), "from": F.greatest(F.lit(0.0), F.least(along("a"), along("b"))), "to": F.least("size", F.greatest(along("a"), along("b")))})
    met = met.filter((level >= ALONG) & (F.greatest("da", "db") <= C("near")) & (C("to") - C("from") > LENGTH))
    keys = [*ROOF, "share"]
    best = stored(met.groupBy(*keys, "s").agg(F.min(F.struct((C("da") + C("db")).alias("cost"), "n", "from", "to")).alias("k")).select(*keys, "s", "k.n", "k.from", "k.to"), "along")
    lost = own.join(best.select(*keys, "s"), [*keys, "s"], "left_anti").withColumn("length", length)
    probes = F.array(*(rings.along(C("a"), C("b"), F.lit(t)) for t in (0.0, 0.25, 0.5, 0.75, 1.0)))
    out = F.size(F.filter(probes, lambda q: ~rings.contains_point(C("ring"), q, C("near")))) / 5
    astray = lost.withColumn("out", out).groupBy(*keys).agg(F.sum(C("length") * C("out")).alias("outside"), F.sum(C("length") * (1 - C("out"))).alias("inside"))
    around = edge.groupBy(*ROOF).agg(F.sum("size").alias("perimeter"))
    held = covered_length(best, [*keys, "n"], "from", "to").groupBy(*keys).agg(F.sum("covered").alias("covered"))
    rows = wanted.select(*keys).join(around, ROOF).join(held, keys, "left").join(astray, keys, "left").na.fill(0.0, ["covered", "outside", "inside"])
    rows = rows.withColumn("support", C("covered") / C("perimeter"))
    rows = stored(rows.withColumn("ok", (C("support") >= SUPPORT) & (C("outside") <= C("perimeter") * OUTSIDE) & (C("inside") <= C("perimeter") * INSIDE)), "support")
    sums = rows.groupBy(*ROOF).agg(F.first("perimeter").alias("perimeter"), F.count_if("ok").alias("good"), F.min(F.when(C("ok"), C("share"))).alias("first"), F.max(F.when(C("ok"), C("share"))).alias("last"), F.avg(F.when(C("ok"), C("support"))).alias("mean"))
    every = covered_length(best.join(rows.filter("ok").select(*keys), keys, "left_semi"), [*ROOF, "n"], "from", "to")
    sides = edge.select(*ROOF, "n", "size").join(every, [*ROOF, "n"], "left").join(around, ROOF).withColumn("covered", F.coalesce("covered", F.lit(0.0)))
    lone = (C("covered") < EDGE * C("size")) & (C("size") > F.greatest(F.lit(EDGE_LENGTH), C("perimeter") * EDGE_SHARE))
    bare = sides.groupBy(*ROOF).agg((F.sum(C("size") - C("covered")) / F.first("perimeter")).alias("bare"), F.count_if(lone).alias("lone"))
    rows = sums.join(bare, ROOF)
    lacking = (C("good") < GOOD) | (C("first") > FIRST) | (C("last") < LAST) | (C("last") - C("first") < SPAN)
    return rows.select(*ROOF, "good", "mean", "bare", F.when(lacking, LACKING).when((C("bare") > BARE) | (C("lone") > 1), EDGES).alias("reason"))


def roof_plans(triangles: DataFrame, models: DataFrame, params: Massing = Massing()) -> tuple[DataFrame, DataFrame]:
    """(plans, roofs) of models (m, y0, y1): the roof that is largest in area, height and support together as a building, or why there is none; and every band looked at with its reason."""
    own = triangles.join(models.select("m"), "m", "left_semi")
    found, faces = bands(own, models, params)
    shapes = stored(found.join(roof_outlines(faces, params).withColumnRenamed("area", "size"), ROOF), "shapes")
    good = shapes.filter("reason IS NULL")
    seen = stored(facade_support(own, good.select(*ROOF, "y0", "y", "ring", "width")).withColumnRenamed("reason", "facade"), "facades")
    rows = stored(shapes.join(seen, ROOF, "left").withColumn("reason", F.coalesce("reason", "facade")).drop("facade"), "roofs")
    score = F.struct((C("size") * (C("y") - C("y0")) * C("mean")).alias("score"), (-C("rank")).alias("first"))
    best = rows.filter("reason IS NULL").groupBy("m").agg(F.max_by(F.struct("ring", "size", "y", "y0", "y1", "mean", "good", "repairs", "coverage", "bare", "holes"), score).alias("r"))
    best = best.select("m", "r.*").withColumn("f", polygons.as_box("ring")["value"]).withColumns({f"c{v}": (C("f.ring")[0][v] + C("f.ring")[2][v]) / 2 for v in "xz"})

    def local(q: Column) -> Column:
        dx, dz, turn = q["x"] - C("cx"), q["z"] - C("cz"), C("f.angle")
        return F.struct((dx * F.cos(turn) + dz * F.sin(turn)).alias("x"), (dz * F.cos(turn) - dx * F.sin(turn)).alias("z"))

    tier = F.struct(F.lit(0.0).alias("bottom"), (C("y") - C("y0")).alias("top"), F.transform("ring", local).alias("ring"))
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(0.95), 0.67 + C("mean") * 0.18 + C("good") / len(FACADE_FRACTIONS) * 0.1 - C("repairs") * 0.005))
    values = {"tiers": F.array(tier), "at": motion.vector(C("cx"), C("y0"), C("cz")), "yaw": -C("f.angle"), "height": C("y") - C("y0"), "area": C("size"), "roof_trim": C("y1") - C("y"), "confidence": confidence, "samples": C("good").cast("int"), "repaired": C("repairs").cast("int"), "fallbacks": F.lit(0)}
    plans = best.select("m", *(v.alias(k) for k, v in values.items()), "mean", "coverage", "bare")
    counted = rows.groupBy("m").agg(F.count("*").alias("n"))
    whole = models.select("m").join(plans, "m", "left").join(counted, "m", "left")
    reason = F.when(C("tiers").isNull(), F.when(C("n").isNull(), NO_BAND).otherwise(NO_ROOF))
    return whole.withColumn("reason", reason).drop("n"), rows


def analysed(triangles: DataFrame, params: Massing = Massing()) -> DataFrame:
    """contour_plans with method (contours or roof) and roof_reason: models without a persistent body are tried by their roofs, all others keep what
    their contours say."""
    triangles = stored(triangles.select("m", "t", "points"), "triangles")
    plans = stored(contours.contour_plans(triangles, params), "contours")
    failed = plans.filter(C("reason") == contours.GATES[3]).select("m")
    rest = plans.join(failed, "m", "left_anti").select("*", F.when(C("reason").isNull(), "contours").alias("method"), F.lit(None).cast("string").alias("roof_reason"))
    if not params.roof_fallback:
        kept = plans.join(failed, "m", "left_semi").select("*", F.lit(None).cast("string").alias("method"), F.lit(None).cast("string").alias("roof_reason"))
        return rest.unionByName(kept)
    height = lambda f: f(F.transform("points", lambda q: q["y"]))
    spans = triangles.join(failed, "m", "left_semi").groupBy("m").agg(F.min(height(F.array_min)).alias("y0"), F.max(height(F.array_max)).alias("y1"))
    tried, _ = roof_plans(triangles, stored(spans, "spans"), params)
    names = [c for c in plans.columns if c not in ("m", "reason")]
    roofed = tried.select("m", *names, F.when(C("reason").isNotNull(), contours.GATES[3]).alias("reason"), F.when(C("reason").isNull(), "roof").alias("method"), C("reason").alias("roof_reason"))
    return reduce(DataFrame.unionByName, [rest, roofed])
