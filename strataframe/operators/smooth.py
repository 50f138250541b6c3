"""Plans of tiers: checked, and divided into floors that change where the tiers do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import polygons, rings
from strataframe.functions.building import FloorParams, floor_bottom
from strataframe.functions.geometry import finite
from strataframe.storage import stored

C = F.col
#: Slack of heights, most tiers; the reasons of whole plans, of tiers, and of their floors.
EPS, MOST_TIERS, MOST_FLOORS = 1e-4, 100, 200
WHOLE = ("invalid massing plan", "massing is too short", "invalid tier list")
TIER = ("invalid tier height interval", "tiers must be ordered, contiguous, and start at zero", "tier extends above massing height", "", "upper tier extends outside its supporting lower tier")
LAST, CLEAR, MANY = "tiers must cover the full massing height", "requested floors leave less than 2m clear", "more supported massing tiers than floors permitted by the clear height"


def normalized(plans: DataFrame, key: str) -> DataFrame:
    """key, height, tiers (bottom, top, ring: valid, and the lowest bottoms exactly the tops below), reason of plans (key, height, tiers). The first fault in the order of the tiers is the
    reason; the heights of a plan without tiers can't be covered. Nulls in a height or ring are faults."""
    p = FloorParams()
    rows = plans.select(key, "height", "tiers")
    count = F.coalesce(F.size("tiers"), F.lit(0))
    whole = F.when(~F.coalesce(finite(C("height")), F.lit(False)), WHOLE[0]).when(C("height") < 2 * p.slab + p.least_clear, WHOLE[1]).when(~count.between(1, MOST_TIERS), WHOLE[2])
    rows = stored(rows.withColumn("whole", whole), "plans")
    each = rows.filter("whole IS NULL").select(key, "height", "tiers", F.posexplode("tiers").alias("k", "t"))
    below = F.get("tiers", C("k") - 1)
    each = each.select(key, "height", "k", "t.bottom", "t.top", F.when(C("k") == 0, 0.0).otherwise(below["top"]).alias("prior"), polygons.as_valid("t.ring").alias("v"), polygons.as_valid(F.when(C("k") > 0, below["ring"]))["value"].alias("under"))
    sound = F.coalesce(finite(C("bottom")) & finite(C("top")) & (C("top") > C("bottom")), F.lit(False))
    tests = ((~sound, F.lit(TIER[0])), (F.abs(C("bottom") - C("prior")) > EPS, F.lit(TIER[1])), (C("top") > C("height") + EPS, F.lit(TIER[2])), (C("v.value").isNull(), C("v.reason")), (C("under").isNotNull() & ~rings.contains_ring(C("under"), C("v.value")), F.lit(TIER[4])))
    fault = F.coalesce(*(F.when(test, text) for test, text in tests))
    judged = each.withColumn("fault", fault)
    sums = judged.groupBy(key).agg(
        F.min(F.when(C("fault").isNotNull(), F.struct("k", "fault")))["fault"].alias("fault"), F.max_by("top", "k").alias("last"),
        F.array_sort(F.collect_list(F.struct("k", C("prior").alias("bottom"), "top", C("v.value").alias("ring")))).alias("made"),
    )
    found = rows.join(sums, key, "left")
    reason = F.coalesce("whole", "fault", F.when(F.abs(C("last") - C("height")) > EPS, LAST))
    made = F.transform("made", lambda t: F.struct(t["bottom"].alias("bottom"), t["top"].alias("top"), t["ring"].alias("ring")))
    found = found.withColumn("reason", reason)
    return found.select(key, "height", F.when(C("reason").isNull(), made).alias("tiers"), "reason")


def tiered_floors(plans: DataFrame, key: str, requested: Column | None = None) -> DataFrame:
    """key, k, n, bottom, ring, tier, reason: the floors of normalized plans, each with the outline of the tier that it is of; one row without a floor where there is a reason.

    Without a request there are as many floors as fit at the usual pitch, and one for each tier if these leave the least clear height. A tier begins on the floor next above its
    bottom, after the tier below, and leaves a floor for each above it.
    """
    p = FloorParams()
    pitch = p.clear + p.slab
    wish = F.greatest(F.lit(1), F.floor((C("height") - p.slab) / pitch)).cast("int")
    tiers = F.size("tiers")
    fits = (C("height") - p.slab) / tiers - p.slab >= p.least_clear
    free = F.when((tiers > wish) & fits, tiers).otherwise(wish)
    n = free if requested is None else F.coalesce(requested.cast("int"), free)
    rows = plans.withColumn("n", n).withColumn("pitch", (C("height") - p.slab) / C("n"))
    fault = F.when((C("n") < 1) | (C("n") >= MOST_FLOORS) | (C("pitch") - p.slab < p.least_clear), CLEAR).when(tiers > C("n"), MANY)
    rows = rows.withColumn("reason", F.coalesce("reason", fault))

    def begin(firsts: Column, t: Column) -> Column:
        at = F.size(firsts) + 1
        ideal = F.ceil(t["bottom"] / C("pitch") + 0.5 - 1e-9).cast("int")
        return F.concat(firsts, F.array(F.greatest(F.element_at(firsts, -1) + 1, F.least(ideal, C("n") - (F.size("tiers") - at))))).cast("array<int>")

    rows = rows.withColumn("firsts", F.when(C("reason").isNull(), F.aggregate(F.slice("tiers", F.lit(2), F.greatest(F.size("tiers"), F.lit(1))), F.array(F.lit(1)), begin)))
    good = rows.filter("reason IS NULL").withColumn("k", F.explode(F.sequence(F.lit(1), C("n"))))
    tier = F.size(F.filter("firsts", lambda f: f <= C("k")))
    clear = C("pitch") - p.slab
    floors = good.select(key, "k", "n", floor_bottom(clear, clear, C("k")).alias("bottom"), F.element_at("tiers", tier)["ring"].alias("ring"), tier.alias("tier"), "reason")
    none = rows.filter("reason IS NOT NULL").select(key, *(F.lit(None).cast(floors.schema[c].dataType).alias(c) for c in floors.columns[1:-1]), "reason")
    return floors.unionByName(none)
