"""Plans of explicit slices: decoded, checked against their contract, built to parts and audited.

A plan is a row with plan, a struct of PLAN; its levels and pieces are exploded, checked as rows of their own, and the first fault by rank, level and
piece is the reason why a plan is refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.functions import polygons, rings, slabs
from strataframe.functions.building import FloorParams
from strataframe.functions.geometry import finite
from strataframe.operators.rings import spread
from strataframe.storage import stored

C = F.col
VERSION = 1
PLAN = "struct<version:int,id:string,origin:struct<x:double,y:double,z:double>,core:struct<minX:double,minZ:double,maxX:double,maxZ:double>,levels:array<struct<y:double,thickness:double,pieces:array<array<array<double>>>>>>"
#: Longest id, levels and pieces of a plan, least side of the core, thickness of a wall of it, least thickness of a level, slack of the clear height; shared area that pieces may have, in all and
#: against the smaller; how much of the core may be uncovered, in all and against it.
ID, LEVELS, PIECES, CORE, WALL, THIN, CLEAR_SLACK, SHARED, BARE = 180, (2, 200), (1, 2048), 4.0, 1.0, 0.05, 1e-5, (1e-4, 1e-7), (0.002, 1e-6)
#: The reasons, by rank.
REASONS = (
    "missing plan", "invalid plan", "unsupported plan version", "plan needs a short nonempty id", "invalid source origin", "invalid levels count", "missing or invalid common core", "common core must be at least 4 wide and deep", "invalid level elevation",
    "invalid slab thickness", "consecutive levels leave too little clear", "invalid floor pieces count", "piece vertices must be [x,z] pairs", "", "pieces overlap", "common core leaves the pieces or enters a hole",
)
CORE_NAMES = ("CoreWallFront", "CoreWallBack", "CoreWallRight", "CoreWallLeft", "CoreDividerX", "CoreDividerZ")


def decoded(df: DataFrame, raw: str = "plan") -> DataFrame:
    """df with raw, a plan as JSON, as a struct of PLAN, null where it is none, and text (whether there was one)."""
    return df.withColumn("text", C(raw).isNotNull()).withColumn(raw, F.from_json(raw, PLAN))


def encoded(df: DataFrame, plan: str = "plan") -> DataFrame:
    """df with plan as JSON."""
    return df.withColumn(plan, F.to_json(plan))


def checked(plans: DataFrame, key: str, cell: float = 32.0) -> tuple[DataFrame, DataFrame]:
    """(verdicts, pieces) of plans (key, plan, and text where it was decoded). verdicts: key, levels, pieces, area, reason. pieces of the plans without fault: key, level, piece, y, thickness, ring."""
    # written, so that a text is read once, not for each field that is asked for
    rows = stored(plans.select(C(key).alias("k"), "plan", (C("text") if "text" in plans.columns else C("plan").isNotNull()).alias("text")), "plans")
    p = lambda f: C(f"plan.{f}")
    sound = lambda *cs: reduce(lambda a, b: a & b, [F.coalesce(finite(c), F.lit(False)) for c in cs])
    core = [p(f"core.{c}") for c in ("minX", "minZ", "maxX", "maxZ")]
    n = F.coalesce(F.size(p("levels")), F.lit(0))
    fault = lambda rank, level, piece, reason: F.struct(F.lit(rank).alias("rank"), level.cast("int").alias("level"), piece.cast("int").alias("piece"), reason.alias("reason"))
    none = F.lit(0)
    plain = lambda rank, test: F.when(F.coalesce(test, F.lit(True)), fault(rank, none, none, F.lit(REASONS[rank])))
    whole = F.array_compact(F.array(
        plain(0, ~C("text")), plain(1, C("plan").isNull() | p("version").isNull()), plain(2, p("version") != VERSION), plain(3, ~F.length(p("id")).between(1, ID)), plain(4, ~sound(*(p(f"origin.{v}") for v in "xyz"))),
        plain(5, ~n.between(*LEVELS)), plain(6, ~sound(*core)), plain(7, (core[2] - core[0] < CORE) | (core[3] - core[1] < CORE)),
    ))
    rows = rows.withColumn("faults", whole)
    levels = rows.filter(F.size("faults") == 0).select("k", C("plan.core").alias("core"), F.posexplode("plan.levels").alias("at", "l"))
    levels = levels.select("k", "core", (C("at") + 1).alias("level"), "l.y", F.coalesce("l.thickness", F.lit(FloorParams().slab)).alias("thickness"), "l.pieces")
    order = W.partitionBy("k").orderBy("level")
    levels = levels.withColumn("clear", C("y") - F.lag("y").over(order) - F.lag("thickness").over(order))
    levels = stored(levels, "levels")
    each = lambda rank, test: F.when(F.coalesce(test, F.lit(True)), fault(rank, C("level"), none, F.lit(REASONS[rank])))
    low = (C("level") > 1) & (C("clear") < FloorParams().least_clear - CLEAR_SLACK)
    of_levels = levels.select("k", F.explode(F.array_compact(F.array(each(8, ~sound(C("y"))), each(9, ~sound(C("thickness")) | (C("thickness") < THIN)), each(10, low), each(11, ~F.coalesce(F.size("pieces"), F.lit(0)).between(*PIECES))))).alias("f"))
    pieces = levels.select("k", "level", "y", "thickness", "core", F.posexplode("pieces").alias("at", "raw")).withColumn("piece", C("at") + 1)
    pairs = F.coalesce(F.forall("raw", lambda v: F.coalesce((F.size(v) == 2) & finite(v[0]) & finite(v[1]), F.lit(False))) & F.size("raw").between(3, polygons.MOST_VERTICES), F.lit(False))
    vertices = F.transform("raw", lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("z")))
    pieces = pieces.withColumn("pairs", pairs).withColumn("v", polygons.as_valid(F.when(C("pairs"), vertices)))
    pieces = stored(pieces.select("k", "level", "piece", "y", "thickness", "core", "pairs", C("v.value").alias("ring"), C("v.reason").alias("why")), "pieces")
    bad = F.coalesce(F.when(~C("pairs"), fault(12, C("level"), C("piece"), F.lit(REASONS[12]))), F.when(C("ring").isNull(), fault(13, C("level"), C("piece"), C("why"))))
    of_pieces = pieces.select("k", bad.alias("f")).filter("f IS NOT NULL")
    good = pieces.filter("ring IS NOT NULL").withColumn("area", F.abs(rings.signed_area(C("ring"))))
    box = good.withColumn("box", rings.bounds(C("ring")))
    wide = lambda s: spread(box, C("box.x0"), C("box.x1"), C("box.z0"), C("box.z1"), cell).select("k", "level", "gx", "gz", *(C(c).alias(f"{s}_{c}") for c in ("piece", "ring", "area", "box")))
    first = (C("gx") == F.floor(F.greatest("a_box.x0", "b_box.x0") / cell)) & (C("gz") == F.floor(F.greatest("a_box.z0", "b_box.z0") / cell))
    met = wide("a").join(wide("b"), ["k", "level", "gx", "gz"]).filter((C("a_piece") < C("b_piece")) & first)
    for v in "xz":  # their bounds have an inside in common
        met = met.filter(F.least(f"a_box.{v}1", f"b_box.{v}1") > F.greatest(f"a_box.{v}0", f"b_box.{v}0"))
    common = met.withColumn("shared", polygons.as_overlap("a_ring", "b_ring")["value"]).filter(C("shared") > F.greatest(F.lit(SHARED[0]), F.least("a_area", "b_area") * SHARED[1]))
    of_pairs = common.select("k", fault(14, C("level"), C("a_piece"), F.lit(REASONS[14])).alias("f"))
    inner = rings.box_ring(*(C(f"core.{c}") for c in ("minX", "minZ", "maxX", "maxZ")))
    held = good.withColumn("held", F.coalesce(F.abs(rings.signed_area(polygons.as_clipped("ring", inner)["value"])), F.lit(0.0)))
    covered = held.groupBy("k", "level").agg(F.sum("held").alias("held"), F.first((C("core.maxX") - C("core.minX")) * (C("core.maxZ") - C("core.minZ"))).alias("core"))
    of_cores = covered.filter(F.abs(C("held") - C("core")) > F.greatest(F.lit(BARE[0]), C("core") * BARE[1])).select("k", fault(15, C("level"), none, F.lit(REASONS[15])).alias("f"))
    faults = [rows.select("k", F.explode("faults").alias("f")), of_levels, of_pieces, of_pairs, of_cores]
    worst = reduce(DataFrame.unionByName, faults).groupBy("k").agg(F.min("f")["reason"].alias("reason"))
    sums = good.groupBy("k").agg(F.count_distinct("level").alias("levels"), F.count("*").alias("pieces"), F.sum("area").alias("area"))
    verdicts = stored(rows.select("k").join(sums, "k", "left").join(worst, "k", "left"), "verdicts")
    kept = good.join(verdicts.filter("reason IS NULL").select("k"), "k").select(C("k").alias(key), "level", "piece", "y", "thickness", "ring", "core")
    ok = lambda c: F.when(C("reason").isNull(), C(c)).alias(c)
    return verdicts.select(C("k").alias(key), ok("levels"), ok("pieces"), ok("area"), "reason"), kept


def built(pieces: DataFrame, key: str) -> DataFrame:
    """key, level, piece (null of the core), name, kind, ring (null of the core), x, z, sx, sz, y0, y1, reason: the parts of the pieces of checked plans: slabs of blocks and wedges on every level, and the six
    walls of the core between a level and the next. reason where a piece can't be built of parts."""
    slab = pieces.withColumn("s", slabs.as_slab("ring"))
    made = slab.filter("s.value IS NOT NULL").select(key, "level", "piece", "y", "thickness", F.explode("s.value.pieces").alias("part"))
    box = rings.bounds(C("part.ring"))
    parts = made.withColumn("b", box).select(
        key, "level", "piece", F.lit("Slab").alias("name"), "part.kind", "part.ring", ((C("b.x0") + C("b.x1")) / 2).alias("x"), ((C("b.z0") + C("b.z1")) / 2).alias("z"), (C("b.x1") - C("b.x0")).alias("sx"), (C("b.z1") - C("b.z0")).alias("sz"),
        C("y").alias("y0"), (C("y") + C("thickness")).alias("y1"), F.lit(None).cast("string").alias("reason"),
    )
    failed = slab.filter("s.value IS NULL").select(key, "level", "piece", *(F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in parts.columns[3:-1]), C("s.reason").alias("reason"))
    levels = pieces.groupBy(key, "level").agg(F.first("y").alias("y"), F.first("thickness").alias("thickness"), F.first("core").alias("c"))
    after = F.lead("y").over(W.partitionBy(key).orderBy("level"))
    between = levels.withColumn("next", after).filter("next IS NOT NULL")
    walls = between.select(key, "level", F.lit(None).cast("int").alias("piece"), F.inline(_core(C("c"))), (C("y") + C("thickness")).alias("y0"), C("next").alias("y1"))
    walls = walls.select(key, "level", "piece", "name", F.lit("block").alias("kind"), F.lit(None).cast(polygons.RING).alias("ring"), "x", "z", "sx", "sz", "y0", "y1", F.lit(None).cast("string").alias("reason"))
    return reduce(DataFrame.unionByName, [parts, failed.select(parts.columns), walls])


def _core(c: Column) -> Column:
    """The six walls of a core, its border on their outside."""
    x, z = (c["minX"] + c["maxX"]) / 2, (c["minZ"] + c["maxZ"]) / 2
    width, depth, half = c["maxX"] - c["minX"], c["maxZ"] - c["minZ"], WALL / 2
    wall, long, deep = F.lit(WALL), width - 2 * WALL, depth - 2 * WALL
    at = ((x, c["maxZ"] - half, width, wall), (x, c["minZ"] + half, width, wall), (c["maxX"] - half, z, wall, deep), (c["minX"] + half, z, wall, deep), (x, z, long, wall), (x, z, wall, deep))
    return F.array(*(F.struct(F.lit(n).alias("name"), *(v.cast("double").alias(k) for k, v in zip(("x", "z", "sx", "sz"), a))) for n, a in zip(CORE_NAMES, at)))


def audited(parts: DataFrame, pieces: DataFrame, key: str, slack: float = 2e-5) -> DataFrame:
    """key, slabs, cores, reason of built parts against the pieces of their plans: the area of each piece is that of its parts, and the core walls are those expected, each once."""
    area = F.abs(rings.signed_area(C("ring")))
    made = parts.filter("name = 'Slab'").groupBy(key, "level", "piece").agg(F.sum(area).alias("made"), F.count("*").alias("n"))
    want = pieces.select(key, "level", "piece", area.alias("wanted"))
    both = want.join(made, [key, "level", "piece"], "full_outer")
    off = F.abs(F.coalesce("made", F.lit(0.0)) - F.coalesce("wanted", F.lit(0.0))) > F.greatest(F.lit(0.001), F.coalesce("wanted", F.lit(0.0)) * slack)
    sums = both.groupBy(key).agg(F.sum("n").alias("slabs"), F.bool_or(off).alias("off"))
    walls = parts.filter(C("name") != "Slab").groupBy(key, "level", "name").agg(F.count("*").alias("have"))
    expected = pieces.select(key, "level").distinct().withColumn("more", F.lead("level").over(W.partitionBy(key).orderBy("level"))).filter("more IS NOT NULL").select(key, "level", F.explode(F.array(*map(F.lit, CORE_NAMES))).alias("name"))
    cores = expected.withColumn("want", F.lit(1)).join(walls, [key, "level", "name"], "full_outer").groupBy(key).agg(F.sum("have").alias("cores"), F.bool_or(~C("want").eqNullSafe(C("have").cast("int"))).alias("lost"))
    return sums.join(cores, key, "left").select(key, "slabs", "cores", F.when(C("off"), "a piece's parts have another area").when(C("lost"), "the core walls are not those expected").alias("reason"))
