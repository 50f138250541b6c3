"""Joins of models, components and tracks: what lies near, touches, covers or blocks what.

Shapes are boxes with x0, x1, y0, y1, z0, z1 unless said otherwise; joins meet on the cells of a grid over x and z, and a pair
counts in one cell only, that of the lower corner of what the two share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.config import Tracks
from strataframe.functions import rings
from strataframe.operators.rings import spread

C = F.col
SIDES = ("x0", "x1", "y0", "y1", "z0", "z1")


def touching(left: DataFrame, right: DataFrame, cell: float, padding: float = 0.0, left_key: str = "id", right_key: str = "id", padded_y: bool = False) -> DataFrame:
    """The pairs of left and right boxes that have a point in common when left is padded in x and z: the columns of left with the prefix
    l_, of right with r_. Null bounds touch nothing."""
    a = left.select(*(C(c).alias(f"l_{c}") for c in left.columns))
    b = right.select(*(C(c).alias(f"r_{c}") for c in right.columns))
    a = spread(a, C("l_x0") - padding, C("l_x1") + padding, C("l_z0") - padding, C("l_z1") + padding, cell)
    b = spread(b, C("r_x0"), C("r_x1"), C("r_z0"), C("r_z1"), cell)
    rise = padding if padded_y else 0.0
    near = (C("l_x0") - padding <= C("r_x1")) & (C("r_x0") <= C("l_x1") + padding) & (C("l_z0") - padding <= C("r_z1")) & (C("r_z0") <= C("l_z1") + padding) & (C("l_y0") - rise <= C("r_y1")) & (C("r_y0") <= C("l_y1") + rise)
    first = (C("gx") == F.floor(F.greatest(C("l_x0") - padding, C("r_x0")) / cell)) & (C("gz") == F.floor(F.greatest(C("l_z0") - padding, C("r_z0")) / cell))
    return a.join(b, ["gx", "gz"]).filter(near & first).drop("gx", "gz")


def shared(v: str) -> Column:
    """Of a pair of touching(), the length that both have on an axis."""
    return F.greatest(F.lit(0.0), F.least(C(f"l_{v}1"), C(f"r_{v}1")) - F.greatest(C(f"l_{v}0"), C(f"r_{v}0")))


def bindings(models: DataFrame, tracks: DataFrame, cells: DataFrame, cell: float, least: float = Tracks.min_binding_overlap, complete: float = Tracks.min_volume_coverage) -> tuple[DataFrame, DataFrame]:
    """(bound, tracks): models that touch a track and of whose cells it covers at least `least`; and the tracks with complete, whether each
    model bound to them is covered to at least `complete`. cells: model, x, y, z of the middles of occupied cells. A model without cells has coverage 0."""
    pairs = touching(models, tracks, cell).select(C("l_id").alias("model"), C("r_id").alias("track"), *(C(f"r_{s}").alias(s) for s in SIDES))
    inside = C("x").between(C("x0"), C("x1")) & C("y").between(C("y0"), C("y1")) & C("z").between(C("z0"), C("z1"))
    found = pairs.join(cells, "model", "left").groupBy("model", "track").agg(F.coalesce(F.count_if(inside) / F.nullif(F.count("x"), F.lit(0)), F.lit(0.0)).alias("coverage"))
    bound = found.filter(C("coverage") >= least)
    whole = bound.groupBy("track").agg(F.bool_and(C("coverage") >= complete).alias("complete"))
    return bound, tracks.join(whole, tracks["id"] == whole["track"], "left").select(*tracks.columns, F.coalesce("complete", F.lit(False)).alias("complete"))


def blockers(models: DataFrame, tracks: DataFrame, cell: float, least: float = 0.2) -> DataFrame:
    """The models that a track (with ring) runs into: they share at least `least` of the lower one's height (1 at least), and the middle or
    a vertex of the ring is in the model's box, or the box's middle is in the ring."""
    pairs = touching(models, tracks, cell)
    height = F.greatest(F.lit(1.0), F.least(C("l_y1") - C("l_y0"), C("r_y1") - C("r_y0")))
    boxed = lambda p: p["x"].between(C("l_x0"), C("l_x1")) & p["z"].between(C("l_z0"), C("l_z1"))
    middle = rings.point((C("l_x0") + C("l_x1")) / 2, (C("l_z0") + C("l_z1")) / 2)
    over = F.exists(F.array(rings.centroid(C("r_ring"))), boxed) | rings.contains_point(C("r_ring"), middle) | F.exists(C("r_ring"), boxed)
    hit = pairs.filter((shared("y") > 0) & (shared("y") / height >= least) & over).select(C("l_id").alias("id")).distinct()
    return models.join(hit, "id", "left_semi")


def ambiguous(tracks: DataFrame, cell: float) -> DataFrame:
    """(a, b), a < b: tracks (with ring) at the same heights of which one has the middle or the first vertex of the other in its ring."""
    pairs = touching(tracks, tracks, cell).filter("l_id < r_id")
    held = lambda a, b: rings.contains_point(C(f"{a}_ring"), rings.centroid(C(f"{b}_ring"))) | rings.contains_point(C(f"{a}_ring"), F.element_at(C(f"{b}_ring"), 1))
    return pairs.filter(held("l", "r") | held("r", "l")).select(C("l_id").alias("a"), C("r_id").alias("b"))


def crowded(plans: DataFrame, others: DataFrame, cell: float, most: float = 0.05) -> DataFrame:
    """(a, b): plans and others whose ground areas share more than `most` of the smaller one."""
    pairs = touching(plans, others, cell)
    area = lambda s: (C(f"{s}_x1") - C(f"{s}_x0")) * (C(f"{s}_z1") - C(f"{s}_z0"))
    return pairs.filter(shared("x") * shared("z") > F.least(area("l"), area("r")) * most).select(C("l_id").alias("a"), C("r_id").alias("b"))


def unbuilt(components: DataFrame, buildings: DataFrame, cell: float) -> DataFrame:
    """The components (id, key, box) that no building (key, x, y, z) has the key of or its middle in."""
    points = buildings.select(C("key").alias("__k"), *(C(v).alias(s) for v in "xyz" for s in (f"{v}0", f"{v}1")))
    over = touching(components, points, cell).select(C("l_id").alias("id")).distinct()
    known = buildings.select("key").dropna().distinct()
    return components.join(over, "id", "left_anti").join(known, "key", "left_anti")


def overlap_areas(pieces: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, a, b, area of the pairs a < b of level pieces (id, box) of a group whose insides overlap."""
    pairs = touching(pieces, pieces, cell).filter("l_id < r_id")
    for c in by:
        pairs = pairs.filter(C(f"l_{c}") == C(f"r_{c}"))
    return pairs.withColumn("area", shared("x") * shared("z")).filter("area > 0").select(*(C(f"l_{c}").alias(c) for c in by), C("l_id").alias("a"), C("r_id").alias("b"), "area")


def neighbours(boxes: DataFrame, cell: float, reach: float) -> DataFrame:
    """(id, near, distance): the other boxes that come within reach in x and z, with the distance of the middles."""
    pairs = touching(boxes, boxes, cell, padding=reach, padded_y=True).filter("l_id <> r_id")
    off = lambda v: (C(f"l_{v}0") + C(f"l_{v}1") - C(f"r_{v}0") - C(f"r_{v}1")) / 2
    return pairs.select(C("l_id").alias("id"), C("r_id").alias("near"), F.sqrt(off("x") * off("x") + off("y") * off("y") + off("z") * off("z")).alias("distance"))


def traced(accepted: DataFrame, proxies: DataFrame, sources: DataFrame) -> DataFrame:
    """Accepted plans (proxy) back to the source (source) of their proxy; what has none is left out."""
    return accepted.join(proxies.select("proxy", "source"), "proxy").join(sources, "source")
