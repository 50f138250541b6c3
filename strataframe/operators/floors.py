"""Ordered folds and summaries over the levels of a model. A fold gathers one model's distinct levels only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import CLEANUP_BOUNDS, Cleanup
from strataframe.operators.tables import covered_length


def anchored_bands(df: DataFrame, keys: list[str], value: str, gap: float = 0.6) -> DataFrame:
    """keys, low, high, n: a value more than gap above the lowest of its band opens the next band. Nulls are left out."""
    kind = df.schema[value].dataType.simpleString()
    levels = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    ordered = levels.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), "n"))).alias("levels"))
    band = lambda low, high, n: F.struct(low.alias("low"), high.alias("high"), n.alias("n"))

    def step(bands: Column, x: Column) -> Column:
        last = F.element_at(bands, -1)
        opens = (F.size(bands) == 0) | (x["v"] - F.try_element_at(bands, F.lit(-1))["low"] > gap)
        grown = F.concat(F.slice(bands, F.lit(1), F.size(bands) - 1), F.array(band(last["low"], x["v"], last["n"] + x["n"])))
        return F.when(opens, F.concat(bands, F.array(band(x["v"], x["v"], x["n"])))).otherwise(grown)

    none = F.expr(f"CAST(array() AS array<struct<low: {kind}, high: {kind}, n: bigint>>)")
    return ordered.select(*keys, F.inline(F.aggregate("levels", none, step)))


def tier_floors(df: DataFrame, keys: list[str], bottom: str, pitch: float, floors: int) -> DataFrame:
    """keys, tier (from 1), bottom, first_floor: tiers by height begin on rising floors, and each leaves room for those above.

    Groups with more distinct tiers than floors have no assignment and give no rows.
    """
    tiers = df.filter(F.col(bottom).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set(bottom)).alias("bottoms")).filter(F.size("bottoms") <= floors)
    start = F.expr("CAST(array(1L) AS array<bigint>)")

    def step(firsts: Column, b: Column) -> Column:
        room = floors - (F.size("bottoms") - F.size(firsts) - 1)
        wish = F.greatest(F.ceil(b / pitch + 0.5 - 1e-9), F.element_at(firsts, -1) + 1)
        return F.concat(firsts, F.array(F.least(wish, room.cast("long"))))

    firsts = F.aggregate(F.slice("bottoms", F.lit(2), F.size("bottoms")), start, step)
    rows = tiers.withColumn("first_floors", firsts).select(*keys, F.posexplode(F.arrays_zip("bottoms", "first_floors")).alias("at", "t"))
    return rows.select(*keys, (F.col("at") + 1).alias("tier"), F.col("t.bottoms").alias(bottom), F.col("t.first_floors").alias("first_floor"))


def oscillating(df: DataFrame, keys: list[str], order: str, group: str) -> DataFrame:
    """keys, oscillates: whether a group comes back along order after another stood between."""
    w = W.partitionBy(*keys).orderBy(order)
    starts = df.withColumn("__new", ~F.col(group).eqNullSafe(F.lag(group).over(w)) | (F.row_number().over(w) == 1))
    runs = starts.groupBy(*keys, group).agg(F.count_if("__new").alias("__runs"))
    return runs.groupBy(*keys).agg((F.max("__runs") > 1).alias("oscillates"))


def drift(df: DataFrame, keys: list[str], order: list[str], value: str, tolerance: float) -> DataFrame:
    """keys, drift, n_off: largest distance to the value of the first row of the group, and rows beyond tolerance.

    The first row is found by aggregation and joined back, so a hot group is split.
    """
    first = df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("__first"))
    off = F.abs(F.col(value) - F.col("__first"))
    return df.join(first, keys).groupBy(*keys).agg(F.max(off).alias("drift"), F.count_if(off > tolerance).alias("n_off"))


def highest_supported(df: DataFrame, keys: list[str], level: str, supported: Column, size: str | None = None, share: float = 0.65) -> DataFrame:
    """keys, top, tail: highest supported level (null if none) and the number of rows above it; with size also reason: a level above
    the top may not have more than `share` of the largest size at the top."""
    sizes = [F.max(size).alias("__size")] if size else []
    tops = df.groupBy(*keys, level).agg(F.count("*").alias("__n"), F.bool_or(supported).alias("__ok"), *sizes)
    own = W.partitionBy(*keys)
    rows = tops.withColumn("__top", F.max(F.when(F.col("__ok"), F.col(level))).over(own))
    above = F.col("__top").isNull() | (F.col(level) > F.col("__top"))
    out = [F.max("__top").alias("top"), F.coalesce(F.sum(F.when(above, F.col("__n"))), F.lit(0)).alias("tail")]
    if size:
        tall = F.max(F.when(above, F.col("__size"))) > F.max(F.when(F.col(level) == F.col("__top"), F.col("__size"))) * share
        out.append(F.when(F.max("__top").isNull(), "no repeated major footprint").when(tall, "unsupported substantial upper body").alias("reason"))
    return rows.groupBy(*keys).agg(*out)


def orientations(df: DataFrame, keys: list[str], dx: Column, dz: Column, order: str, top: int = 12, least: float = 1.0) -> DataFrame:
    """keys, key, weight, ux, uz: of each group the directions, folded to a quarter turn and in quarter degrees, of the edges longer
    than `least`; the heaviest by total length, with the unit vector of the first edge by order. Ties go to the lesser key."""
    length, quarter = F.sqrt(dx * dx + dz * dz), F.lit(3.141592653589793 / 2)
    key = F.round(F.pmod(F.atan2(dz, dx), quarter) * 720 / F.lit(3.141592653589793)).cast("long")
    first = lambda v, name: F.min_by(v / length, order).alias(name)
    weighed = df.filter(length > least).groupBy(*keys, key.alias("key")).agg(F.round(F.sum(length), 6).alias("weight"), first(dx, "ux"), first(dz, "uz"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("weight"), "key"))
    return weighed.withColumn("__n", rank).filter(F.col("__n") <= top).drop("__n")


def supported_rectangles(segments: DataFrame, keys: list[str], order: str, tolerance: float = 3.0, share: float = 0.97, inner: float = 0.045) -> DataFrame:
    """keys, ux, uz, u0, u1, v0, v1: the rectangle of least area along one of a group's orientations, where its segments (ax, az, bx, bz)
    cover all four sides to at least `share` and what lies inside is at most `inner` of the perimeter. Other groups are left out."""
    c = F.col
    turns = orientations(segments, keys, c("bx") - c("ax"), c("bz") - c("az"), order)
    rows = segments.join(turns.drop("weight"), keys)
    rows = rows.withColumns({f"{e}{n}": (c(f"{e}x") * c("ux") + c(f"{e}z") * c("uz")) if n == "u" else (c(f"{e}z") * c("ux") - c(f"{e}x") * c("uz")) for e in "ab" for n in "uv"})
    ends = [f(*(f2(f"{e}{n}") for e in "ab")).alias(f"{n}{k}") for n in "uv" for k, f, f2 in ((0, F.least, F.min), (1, F.greatest, F.max))]
    boxes = rows.groupBy(*keys, "key", "ux", "uz").agg(*ends).withColumns({"w": c("u1") - c("u0"), "d": c("v1") - c("v0")})
    best = boxes.groupBy(*keys).agg(F.min(F.struct((c("w") * c("d")).alias("area"), "key", "ux", "uz", "u0", "u1", "v0", "v1", "w", "d")).alias("r")).select(*keys, "r.*").drop("area").filter(F.least("w", "d") >= 1)
    at = rows.drop("ux", "uz").join(best, [*keys, "key"])
    near = F.least(F.lit(tolerance), F.least("w", "d") * 0.025)
    on = lambda n, k: (F.abs(c(f"a{n}") - c(f"{n}{k}")) <= near) & (F.abs(c(f"b{n}") - c(f"{n}{k}")) <= near)
    side = F.when(on("u", 0), 1).when(on("u", 1), 2).when(on("v", 0), 3).when(on("v", 1), 4)
    n = F.when(side <= 2, F.struct(c("av").alias("p"), c("bv").alias("q"))).otherwise(F.struct(c("au").alias("p"), c("bu").alias("q")))
    placed = at.withColumns({"side": side, "s": n}).withColumns({"low": F.least("s.p", "s.q"), "high": F.greatest("s.p", "s.q")})
    loose = placed.filter("side IS NULL").groupBy(*keys).agg(F.sum(F.hypot(c("au") - c("bu"), c("av") - c("bv"))).alias("inner"))
    covered = covered_length(placed.filter("side IS NOT NULL"), [*keys, "side"], "low", "high")
    sides = covered.groupBy(*keys).agg(*(F.max(F.when(c("side") == k, c("covered"))).alias(f"c{k}") for k in (1, 2, 3, 4)))
    found = best.join(sides, keys).join(loose, keys, "left")
    whole = (F.least("c1", "c2") >= c("d") * share) & (F.least("c3", "c4") >= c("w") * share) & c("c1").isNotNull() & c("c2").isNotNull() & c("c3").isNotNull() & c("c4").isNotNull()
    return found.filter(whole & (F.coalesce("inner", F.lit(0.0)) <= 2 * (c("w") + c("d")) * inner)).select(*keys, "ux", "uz", "u0", "u1", "v0", "v1")


def fragment_rules(p: Cleanup = Cleanup()) -> dict[str, Column]:
    """What makes a section a fragment, by the columns floor_area, envelope_volume, slab_volume, clearance, height, has_core."""
    c = F.col
    return {
        "area": c("floor_area") <= p.max_floor_area, "envelope": c("envelope_volume") <= p.max_envelope_volume, "slabs": c("slab_volume") <= p.max_slab_volume,
        "elevated": c("clearance") >= p.elevated_clearance, "short": c("height") <= p.max_short_height, "no_core": ~c("has_core"),
    }


def fragments(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with reasons (names of the rules that hold, in order) and fragment: a small area, small bulk and a poor stand.

    rules has, in order, area, envelope, slabs, elevated, short, no_core; an unknown rule does not hold.
    """
    holds = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    poor = holds["area"] & (holds["envelope"] | holds["slabs"]) & (holds["elevated"] | holds["short"] | holds["no_core"])
    return df.withColumns({"reasons": F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in holds.items()))), "fragment": poor})


def fragment_report(measured: DataFrame, bounds: dict[str, tuple] = CLEANUP_BOUNDS) -> DataFrame:
    """name, bucket, upto, n, fragments: for each figure of bounds how many rows of measured (its columns, and fragment) fall in each of its buckets, and how many of these are fragments. upto is a bucket's
    bound, null of the last; rows without a figure are in no bucket of it. One pass over the rows."""
    at = lambda name: F.coalesce(*(F.when(F.col(name) <= b, F.lit(k)) for k, b in enumerate(bounds[name])), F.lit(len(bounds[name])))
    upto = lambda name: F.get(F.array(*(F.lit(float(b)) for b in bounds[name])), at(name))
    figures = F.array(*(F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("name"), at(name).alias("bucket"), upto(name).alias("upto"))) for name in bounds))
    rows = measured.select("fragment", F.explode(F.array_compact(figures)).alias("f")).select("fragment", "f.*")
    return rows.groupBy("name", "bucket", "upto").agg(F.count("*").alias("n"), F.count_if("fragment").alias("fragments"))
