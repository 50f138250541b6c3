"""Distance joins over the ground plane. Rows are dealt to grid cells, so only neighbouring cells are compared."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import Clusters
from strataframe.functions.geometry import rolling_checksum
from strataframe.operators.graph import connected_components
from strataframe.operators.spatial import overlapping_boxes
from strataframe.storage import stored


def nearest_within(points: DataFrame, targets: DataFrame, reach: float) -> DataFrame:
    """id, target, d2 of each point (id, x, z) that has a target (id, x, z) at most reach away; ties go to the least id.

    Rows at one place are searched for once, however many they are. Null coordinates have no place. The nearest is searched at any distance, as what
    a cell of the reach holds grows with the crowd in it.
    """
    return nearest_any(points, targets, reach).filter(F.col("d2") <= F.lit(reach * reach))


def mutual_nearest(points: DataFrame, reach: float) -> DataFrame:
    """(a, b, d2), a < b: points (id unique, x, z) that are each other's nearest and at most reach apart.

    Ties go to the least id. Of several points at one place the two least pair up; they are found by aggregation.
    """
    return mutual_any(points, reach).filter(F.col("d2") <= F.lit(reach * reach))


#: Cells of a level on a side against those of the one above, as a power of 2; the levels; a cell with so few targets is not divided; a level with so
#: few cells goes to all tasks.
BITS, LEVELS, FEW, SMALL = 2, 12, 32, 50_000


def _nearest(places: DataFrame, targets: DataFrame, other: bool) -> DataFrame:
    """id, near, d2 of each of places (id, x, z): the nearest of targets (id, x, z at places of their own; with other, one of another id), ties to the least id.

    The square about the targets is divided level by level, a cell being the box about its targets. On each level a place keeps the cells that may hold
    its nearest: those no farther than the farthest point of the cell that is best in that. So a place meets few cells on a level and few targets in the end, however
    many there are and however far it lies; the levels grow with the logarithm of the targets.
    """
    c = F.col
    finite = lambda df: df.select("id", "x", "z").filter(~(F.isnan("x") | F.isnan("z")) & (F.abs("x") < float("inf")) & (F.abs("z") < float("inf")))
    own, last = finite(targets), BITS * LEVELS
    least = own.agg(*(f(v).alias(f"{v}{k}") for v in "xz" for k, f in enumerate((F.min, F.max)))).first()
    size = max((least[f"{v}1"] - least[f"{v}0"] for v in "xz"), default=0) if least["x0"] is not None else 0
    at = lambda v: F.least(F.floor((c(v) - F.lit(least[f"{v}0"])) / F.lit(float(size or 1)) * (1 << last)), F.lit((1 << last) - 1)).cast("long").alias(f"g{v}")
    own = stored(own.select("*", at("x"), at("z")), "targets")
    found = finite(places).withColumns({"px": F.lit(0).cast("long"), "pz": F.lit(0).cast("long")})
    apart = lambda f, v: f(c(v) - c(f"{v}1"), c(f"{v}0") - c(v))
    square = lambda f: f("x") * f("x") + f("z") * f("z")
    low = square(lambda v: F.greatest(F.lit(0.0), apart(F.greatest, v)))
    high = square(lambda v: F.greatest(F.abs(c(v) - c(f"{v}0")), F.abs(c(v) - c(f"{v}1"))))
    # a cell of one target bounds nothing for the place that is that target
    sure = ~((c("n") == 1) & (c("x") == c("x0")) & (c("z") == c("z0"))) if other else F.lit(True)
    for level in range(1, LEVELS + 1):
        shift = last - BITS * level
        cells = own.groupBy(*(F.shiftright(f"g{v}", shift).alias(f"c{v}") for v in "xz")).agg(F.count("*").alias("n"), *(f(v).alias(f"{v}{k}") for v in "xz" for k, f in enumerate((F.min, F.max))))
        cells = stored(cells.withColumns({f"p{v}": F.shiftright(f"c{v}", BITS) for v in "xz"}), "cells")
        count, most = cells.agg(F.count("*"), F.max("n")).first()
        met = found.join(F.broadcast(cells) if count <= SMALL else cells, ["px", "pz"]).withColumns({"low": low, "high": F.when(sure, high)})
        near = met.withColumn("best", F.min("high").over(W.partitionBy("id"))).filter(c("best").isNull() | (c("low") <= c("best")))
        found = stored(near.select("id", "x", "z", c("cx").alias("px"), c("cz").alias("pz")), "near")
        if (most or 0) <= FEW:
            break
    leaves = own.select(c("id").alias("near"), c("x").alias("tx"), c("z").alias("tz"), *(F.shiftright(f"g{v}", shift).alias(f"p{v}") for v in "xz"))
    met = found.join(leaves, ["px", "pz"])
    met = met.filter("id <> near") if other else met
    d2 = (c("x") - c("tx")) * (c("x") - c("tx")) + (c("z") - c("tz")) * (c("z") - c("tz"))
    return met.groupBy("id").agg(F.min(F.struct(d2.alias("d2"), "near")).alias("best")).select("id", "best.near", "best.d2")


def nearest_any(points: DataFrame, targets: DataFrame, reach: float) -> DataFrame:
    """id, target, d2 of each point (id, x, z): the nearest target (id, x, z), however far; ties go to the least id. reach is not needed any more. Rows
    at one place are searched for once; null coordinates have no place, and without targets there are no rows."""
    places = stored(points.select("x", "z").distinct().filter("x IS NOT NULL AND z IS NOT NULL").withColumn("id", F.monotonically_increasing_id()), "places")
    there = stored(targets.filter("x IS NOT NULL AND z IS NOT NULL").groupBy("x", "z").agg(F.min("id").alias("id")), "targets")
    found = stored(_nearest(places, there, other=False), "found")
    return points.select("id", "x", "z").join(places.withColumnRenamed("id", "place"), ["x", "z"]).join(found.withColumnRenamed("id", "place"), "place").select("id", F.col("near").alias("target"), "d2")


def mutual_any(points: DataFrame, reach: float) -> DataFrame:
    """(a, b, d2), a < b: points (id unique, x, z) that are each other's nearest, however far; ties go to the least id, so of several at one place the two least pair up."""
    placed = stored(points.filter("x IS NOT NULL AND z IS NOT NULL").select("id", "x", "z"), "points")
    places = placed.groupBy("x", "z").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    crowded = places.filter("n > 1").select("x", "z", F.col("id").alias("a"))
    inside = placed.join(crowded, ["x", "z"]).filter("id > a").groupBy("x", "z", "a").agg(F.min("id").alias("b"))
    places = stored(places, "places")
    best = stored(_nearest(places.filter("n = 1"), places, other=True), "best")
    back = best.select(F.col("id").alias("near"), F.col("near").alias("id"))
    pairs = best.join(back, ["id", "near"]).filter("id < near").select(F.col("id").alias("a"), F.col("near").alias("b"), "d2")
    return pairs.unionByName(inside.select("a", "b", F.lit(0).cast(pairs.schema["d2"].dataType).alias("d2")))


@dataclass(frozen=True)
class ClusterParams:
    """Least shared part of the lower height; largest distance of bases, of tops (one is enough), and on the ground."""

    overlap: float = Clusters.min_vertical_overlap
    base: float = Clusters.max_base_delta
    top: float = Clusters.max_top_delta
    gap: float = Clusters.max_horizontal_gap


def cluster_pairs(boxes: DataFrame, params: ClusterParams = ClusterParams(), cell: float = 32.0) -> DataFrame:
    """(a, b), a < b: boxes (id, x0, x1, y0, y1, z0, z1) that may belong to one cluster."""
    p, pad = params, params.gap / 2
    wide = boxes.select("id", *((F.col(f"{v}0") - pad).alias(f"{v}0") for v in "xz"), *((F.col(f"{v}1") + pad).alias(f"{v}1") for v in "xz"))
    sides = [boxes.select(*(F.col(c).alias("id" if c == "id" else f"{k}_{c}") for c in ("id", "x0", "x1", "y0", "y1", "z0", "z1"))).withColumnRenamed("id", k) for k in "ab"]
    pairs = overlapping_boxes(wide, cell).join(sides[0], "a").join(sides[1], "b")
    shared = F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0")
    lower = F.least(F.col("a_y1") - F.col("a_y0"), F.col("b_y1") - F.col("b_y0"))
    apart = {v: F.greatest(F.lit(0.0), F.col(f"a_{v}0") - F.col(f"b_{v}1"), F.col(f"b_{v}0") - F.col(f"a_{v}1")) for v in "xz"}
    level = (F.abs(F.col("a_y0") - F.col("b_y0")) <= p.base) | (F.abs(F.col("a_y1") - F.col("b_y1")) <= p.top)
    close = F.sqrt(apart["x"] * apart["x"] + apart["z"] * apart["z"]) <= p.gap
    return pairs.filter((shared > 0) & (shared >= lower * p.overlap) & level & close).select("a", "b")


def same_sets(rows: DataFrame, group: str, part: str, member: str) -> DataFrame:
    """group, same: whether all parts of a group have equal sets of members. Counts only; no set is gathered."""
    rows = rows.select(group, part, member).distinct()
    parts = rows.select(group, part).distinct().groupBy(group).agg(F.count("*").alias("__parts"))
    least = rows.groupBy(group, member).agg(F.count("*").alias("__n")).groupBy(group).agg(F.min("__n").alias("__least"))
    return parts.join(least, group).select(group, (F.col("__least") == F.col("__parts")).alias("same"))


def loose_ends(edges: DataFrame, ends: list[list[Column]], names: list[str]) -> DataFrame:
    """The places, named names, at which exactly one end of an edge lies."""
    both = edges.select(F.explode(F.array(*(F.struct(*(c.alias(n) for c, n in zip(e, names))) for e in ends))).alias("__e"))
    return both.select("__e.*").groupBy(*names).agg(F.count("*").alias("__n")).filter("__n = 1").drop("__n")


def clusters(boxes: DataFrame, key: str = "id", params: ClusterParams = ClusterParams(), cell: float = 32.0) -> DataFrame:
    """key, cluster: the least key of the boxes that compatible ones connect each with; alone where there is none."""
    found = connected_components(cluster_pairs(boxes.withColumnRenamed(key, "id"), params, cell), "a", "b")
    return boxes.select(key).join(found.select(F.col("node").alias(key), "component"), key, "left").select(key, F.coalesce("component", key).alias("cluster"))


def cluster_keys(members: DataFrame, cluster: str, key: Column) -> DataFrame:
    """cluster, n, the box around its members, and a key: how many, a checksum over the members' keys in order, and the middle in tenths.

    The keys of a cluster are gathered for their order; clusters beyond a bound on members are no buildings and should be refused before.
    """
    ends = [(F.min if e == "0" else F.max)(f"{v}{e}").alias(f"{v}{e}") for v in "xyz" for e in "01"]
    found = members.groupBy(cluster).agg(F.count("*").alias("n"), *ends, F.array_join(F.array_sort(F.collect_list(key)), "").alias("__keys"))
    middle = [F.round((F.col(f"{v}0") + F.col(f"{v}1")) / 2 * 10).cast("long").cast("string") for v in "xyz"]
    name = F.concat_ws("_", F.concat(F.lit("Global"), F.col("n").cast("string")), rolling_checksum(F.col("__keys")).cast("string"), *middle)
    return found.withColumn("key", name).drop("__keys")
