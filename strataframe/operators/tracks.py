"""Verdicts on tracks of section loops and on clusters that are stitched to one building."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.config import CLUSTER_MASSING, TRACK_FRACTIONS, TRACK_SLICES, Clusters, Massing, Tracks, configured
from strataframe.functions import rings
from strataframe.functions.outline import OutlineParams
from strataframe.operators import nearest, places, roofs, sections
from strataframe.operators.rings import spread
from strataframe.operators.tables import lower_median
from strataframe.storage import stored

C = F.col
#: Reasons why a track is no plan, in the order in which they are asked.
TRACK = ("too few samples", "too short a part of the height", "too low", "it begins too high", "it ends too low", "a plan would be too low")
#: Share of the height that a track goes on beyond its ends, least height of a plan.
BEYOND, LEAST_PLAN = 0.05, 30.0
#: Why a cluster is not stitched.
CLUSTER = ("isolated component", "cluster has too many source components", "cluster envelope is too large", "cluster repeats a legacy source")
#: What each component beyond two takes from a stitched plan's confidence.
EACH = 0.005


def sampled_loops(triangles: DataFrame, models: DataFrame, params: Tracks = Tracks()) -> DataFrame:
    """m, sample (from 1), share, y, loop, ring, area, x, z: the loops that lie in or near models (m, x0, x1, y0, y1, z0, z1) at fixed shares of the height, of
    triangles (m, points) of all that is near each; a loop in an odd number of larger ones is a hole and left out. Triangles and models are many, however small the file that they are made of,
    and are not broadcast."""
    p = configured(Massing, TRACK_SLICES)
    cut = F.explode(F.array(*(F.struct(F.lit(i).alias("sample"), F.lit(f).alias("share"), (C("y0") + (C("y1") - C("y0")) * f).alias("y")) for i, f in enumerate(TRACK_FRACTIONS, 1))))
    wanted = stored(models.select("m", "x0", "x1", "z0", "z1", cut.alias("c")).select("m", "x0", "x1", "z0", "z1", "c.*"), "wanted")
    ys = wanted.groupBy("m").agg(F.collect_set("y").alias("ys"))
    segments = sections.at_heights(triangles.select("m", "points").join(ys.hint("merge"), "m"), C("ys")).select("m", "y", "a", "b")
    found = sections.mended_loops(segments, ["m", "y"], OutlineParams(p.weld_tolerance, p.max_seam_gap, p.max_corner_gap, p.max_corner_extension, each=True))
    found = stored(found.filter("reason IS NULL").select("m", "y", "loop", "ring", "area"), "loops")
    outer = found.select("m", "y", C("loop").alias("o"), C("ring").alias("around"), C("area").alias("size"))
    inside = found.join(outer.hint("merge"), ["m", "y"]).filter(C("size") > C("area")).filter(rings.contains_point(C("around"), C("ring")[0], 0.01))
    depth = inside.groupBy("m", "y", "loop").agg(F.count("*").alias("depth"))
    rows = found.join(depth.hint("merge"), ["m", "y", "loop"], "left").filter(F.coalesce("depth", F.lit(0)) % 2 == 0).withColumn("c", rings.centroid(C("ring")))
    near = lambda v: C(f"c.{v}").between(C(f"{v}0") - params.region_padding, C(f"{v}1") + params.region_padding)
    rows = rows.join(wanted.hint("merge"), ["m", "y"]).filter(near("x") & near("z") & (C("area") >= p.min_area))
    return rows.select("m", "sample", "share", "y", "loop", "ring", "area", C("c.x").alias("x"), C("c.z").alias("z"))


def diagnosed(loops: DataFrame, models: DataFrame, cells: DataFrame, params: Tracks = Tracks(), cell: float = 32.0) -> tuple[DataFrame, DataFrame]:
    """(tracks, verdicts) of loops (sampled_loops) of models (m, y0, y1).

    tracks: m, track, samples, first, last (shares of the height), base, top, ring, area, confidence and reason, the first of TRACK that holds, null where it is a plan. verdicts, a row a model:
    m, tracks, accepted (long and high enough), plans, volume (share of cells, m, x, y, z, in a track accepted and between its ends), ground (of the lowest ones, in x and z alone), overlaps (pairs of accepted tracks at the
    same heights of which one has the middle or first vertex of the other), complete. A model without loops has no tracks, one without cells no shares and is not complete.
    Nothing is broadcast: what is made of a small file is large in memory.
    """
    p = params
    own = stored(loops.join(places.tracked(loops, p.min_area_ratio, p.max_centroid_shift, p.max_shape_distance).hint("merge"), ["m", "sample", "loop"]), "tracked")
    ends = own.groupBy("m", "track").agg(F.count("*").cast("int").alias("samples"), F.min("share").alias("first"), F.max("share").alias("last"), F.min("y").alias("low"), F.max("y").alias("high"))
    middle = lower_median(own, ["m", "track"], ["area", "sample"]).select("m", "track", "ring", "area", "x", "z")
    rows = ends.join(middle.hint("merge"), ["m", "track"]).join(models.select("m", "y0", "y1").hint("merge"), "m")
    size = C("y1") - C("y0")
    rows = rows.withColumns({"base": F.greatest("y0", C("low") - size * BEYOND), "top": F.least("y1", C("high") + size * BEYOND)})
    tests = (C("samples") < p.min_track_samples, C("last") - C("first") < p.min_track_span, C("high") - C("low") < p.min_track_height, C("first") > p.max_first_fraction, C("last") < p.min_last_fraction)
    fault = F.coalesce(*(F.when(t, why) for t, why in zip(tests, TRACK)))
    rows = rows.withColumn("fault", fault).withColumn("reason", F.coalesce("fault", F.when(C("top") - C("base") < LEAST_PLAN, TRACK[5])))
    rows = stored(rows.withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(0.9), 0.55 + C("samples") / len(TRACK_FRACTIONS) * 0.3 + (C("last") - C("first")) * 0.15))), "tracks")
    good = rows.filter("fault IS NULL")
    box = rings.bounds(C("ring"))
    wide = good.withColumn("box", box)
    wide = spread(wide, C("box.x0"), C("box.x1"), C("box.z0"), C("box.z1"), cell).select("m", "gx", "gz", "box", "ring", "base", "top")
    points = stored(cells.select("m", "x", "y", "z").withColumn("id", F.monotonically_increasing_id()), "points")
    placed = points.withColumns({g: F.floor(C(v) / cell).cast("long") for g, v in (("gx", "x"), ("gz", "z"))})
    within = C("x").between(C("box.x0"), C("box.x1")) & C("z").between(C("box.z0"), C("box.z1"))
    held = F.when(within, rings.contains_point(C("ring"), rings.point(C("x"), C("z")))).otherwise(F.lit(False))
    hit = placed.join(wide.hint("merge"), ["m", "gx", "gz"]).filter(held).groupBy("m", "id").agg(F.bool_or(C("y").between(C("base"), C("top"))).alias("solid"))
    low = points.groupBy("m").agg(F.min("y").alias("floor"))
    share = points.join(hit.hint("merge"), ["m", "id"], "left").join(low.hint("merge"), "m").groupBy("m").agg(
        F.avg(F.coalesce("solid", F.lit(False)).cast("int")).alias("volume"), F.avg(F.when(C("y") == C("floor"), C("solid").isNotNull().cast("int"))).alias("ground"),
    )
    a, b = (good.select("m", *(C(c).alias(f"{s}_{c}") for c in ("track", "ring", "x", "z", "low", "high"))) for s in "ab")
    pairs = a.join(b.hint("merge"), "m").filter((C("a_track") < C("b_track")) & (F.least("a_high", "b_high") >= F.greatest("a_low", "b_low")))
    covers = lambda s, t: rings.contains_point(C(f"{s}_ring"), rings.point(C(f"{t}_x"), C(f"{t}_z"))) | rings.contains_point(C(f"{s}_ring"), C(f"{t}_ring")[0])
    clash = pairs.filter(covers("a", "b") | covers("b", "a")).groupBy("m").agg(F.count("*").alias("overlaps"))
    counts = rows.groupBy("m").agg(F.count("*").alias("tracks"), F.count_if(C("fault").isNull()).alias("accepted"), F.count_if(C("reason").isNull()).alias("plans"))
    verdicts = models.select("m").join(counts.hint("merge"), "m", "left").join(share.hint("merge"), "m", "left").join(clash.hint("merge"), "m", "left").na.fill(0, ["tracks", "accepted", "plans", "overlaps"])
    complete = (C("accepted") > 0) & F.coalesce(C("volume") >= p.min_volume_coverage, F.lit(False)) & (C("overlaps") == 0) & (C("plans") == C("accepted"))
    return rows.select("m", "track", "samples", "first", "last", "base", "top", "ring", "area", "confidence", "reason"), verdicts.withColumn("complete", complete)


def stitched(triangles: DataFrame, components: DataFrame, params: Clusters = Clusters(), massing: Massing | None = None) -> DataFrame:
    """cluster, n, key, tiers, height, area, confidence, method, reason: clusters of components (id, source, key, x0, x1, y0, y1, z0, z1) that may be parts of one building,
    analysed as one model, in triangles (id, t, points); or why they are none. A component's key may not be null."""
    p = params
    limits = nearest.ClusterParams(p.min_vertical_overlap, p.max_base_delta, p.max_top_delta, p.max_horizontal_gap)
    found = stored(nearest.clusters(components, "id", limits).join(components, "id"), "clusters")
    sums = found.groupBy("cluster").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), *((F.max(f"{v}1") - F.min(f"{v}0")).alias(f"size_{v}") for v in "xz"))
    tests = (C("n") < p.min_components, C("n") > p.max_components, (C("size_x") > p.max_cluster_width) | (C("size_z") > p.max_cluster_depth))
    sums = stored(sums.withColumn("why", F.coalesce(*(F.when(t, text) for t, text in zip(tests, CLUSTER)))), "sums")
    fit = sums.filter("why IS NULL").select("cluster")
    members = stored(found.join(fit, "cluster"), "members")
    keys = nearest.cluster_keys(members, "cluster", C("key")).select("cluster", C("key").alias("name"))
    merged = triangles.join(members.select("id", "cluster"), "id").select(C("cluster").alias("m"), F.struct("id", "t").alias("t"), "points")
    plans = roofs.analysed(merged, massing or configured(Massing, CLUSTER_MASSING)).select(C("m").alias("cluster"), "tiers", "height", "area", "confidence", "method", "reason")
    rows = sums.join(keys, "cluster", "left").join(plans, "cluster", "left")
    repeats = C("reason").isNull() & (C("sources") < C("n"))
    reason = F.coalesce("why", "reason", F.when(repeats, CLUSTER[3]))
    rows = rows.withColumn("reason", reason)
    good = C("reason").isNull()
    confidence = F.greatest(F.lit(0.0), C("confidence") - F.greatest(F.lit(0), C("n") - 2) * EACH)
    return rows.select("cluster", "n", F.when(good, C("name")).alias("key"), *(F.when(good, C(c)).alias(c) for c in ("tiers", "height", "area")), F.when(good, confidence).alias("confidence"), F.when(good, C("method")).alias("method"), "reason")
