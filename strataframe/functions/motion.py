"""Frames, boxes and movement in space as column expressions.

A vector is struct<x, y, z>. A box has a middle, sizes and a frame: here a turn about the vertical, yaw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = "xyz"
#: Strength and drag of a hit, the floor's height.
STRENGTH, DRAG, FLOOR_Y = 6000.0, 10.0, 0.0


def vector(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), z.cast("double").alias("z"))


def mapped(f, *vectors: Column) -> Column:
    """The vector of f over the coordinates of vectors."""
    return vector(*(f(*(v[a] for v in vectors)) for a in AXES))


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def length(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Column, b: Column) -> Column:
    return vector(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def unit(a: Column) -> Column:
    """a with length 1; null for a vector of none."""
    n = length(a)
    return F.when(n > 0, mapped(lambda v: v / n, a))


def between(a: Column, b: Column, t: Column) -> Column:
    return mapped(lambda p, q: p + (q - p) * t, a, b)


def to_world(p: Column, origin: Column, yaw: Column) -> Column:
    """A point of a frame that stands at origin, turned by yaw about the vertical."""
    c, s = F.cos(yaw), F.sin(yaw)
    return vector(origin["x"] + p["x"] * c + p["z"] * s, origin["y"] + p["y"], origin["z"] - p["x"] * s + p["z"] * c)


def to_local(p: Column, origin: Column, yaw: Column) -> Column:
    c, s = F.cos(yaw), F.sin(yaw)
    dx, dz = p["x"] - origin["x"], p["z"] - origin["z"]
    return vector(dx * c - dz * s, p["y"] - origin["y"], dx * s + dz * c)


def permuted(p: Column, order: str, signs: tuple[int, int, int], scale: float, offset: tuple[float, float, float]) -> Column:
    """Axes in another order, with signs, one scale and an offset; order names the source axis of x, y and z."""
    return vector(*(p[a] * s * scale + o for a, s, o in zip(order, signs, offset)))


def half_extents(size: Column, yaw: Column) -> Column:
    """Half the size of the world box around a turned box."""
    c, s = F.abs(F.cos(yaw)), F.abs(F.sin(yaw))
    return vector((size["x"] * c + size["z"] * s) / 2, size["y"] / 2, (size["x"] * s + size["z"] * c) / 2)


def vertical_reach(size: Column, row: Column) -> Column:
    """Half the height of a tilted box: row is the vertical row of its rotation, by the box's own axes."""
    return (F.abs(row["x"]) * size["x"] + F.abs(row["y"]) * size["y"] + F.abs(row["z"]) * size["z"]) / 2


def segment_distance(p: Column, a: Column, b: Column) -> Column:
    """Distance of a point to a segment; to its first end where it is shorter than about 0.03."""
    ab, ap = mapped(lambda x, y: y - x, a, b), mapped(lambda x, y: x - y, p, a)
    n = dot(ab, ab)
    t = F.when(n < 0.001, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(ap, ab) / n)))
    return length(mapped(lambda x, y: x - y * t, ap, ab))


def endpoint(start: Column, direction: Column, strength: Column | float = STRENGTH, drag: float = DRAG, floor: float = FLOOR_Y) -> Column:
    """Where a hit from start ends: strength / drag along the direction. What would go below the floor goes on flat from
    where it meets it, or stops there where it falls straight. Null without a direction."""
    d = unit(direction)
    reach = F.lit(strength) / drag if isinstance(strength, float) else strength / drag
    there = mapped(lambda s, v: s + v * reach, start, d)
    down = (start["y"] - floor) / -d["y"]
    met = mapped(lambda s, v: s + v * down, start, d)
    flat = F.sqrt(d["x"] * d["x"] + d["z"] * d["z"])
    on = F.when((flat > 0.01) & (reach > down), (reach - down) / flat).otherwise(0.0)
    bent = vector(met["x"] + d["x"] * on, F.lit(floor), met["z"] + d["z"] * on)
    return F.when((there["y"] < floor) & (d["y"] < 0), bent).otherwise(there)


def launch(direction: Column, strength: float = STRENGTH, drag: float = DRAG) -> Column:
    """The velocity of what was hit."""
    return mapped(lambda v: v * (strength / drag), unit(direction))


def boxes_touch(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column, padding: float = 0.0, axes: str = AXES) -> Column:
    """Whether two boxes, one of them padded, have a point in common on the axes."""
    out = F.lit(True)
    for a in axes:
        out = out & (lo_a[a] <= hi_b[a] + padding) & (lo_b[a] <= hi_a[a] + padding)
    return out


def shrunk_overlap(at_a: Column, size_a: Column, at_b: Column, size_b: Column, shrink: float) -> Column:
    """Whether two boxes overlap when shrunk about their middles."""
    out = F.lit(True)
    for a in AXES:
        out = out & (F.abs(at_a[a] - at_b[a]) < (size_a[a] + size_b[a]) * (shrink / 2))
    return out


def turned_boxes_overlap(at_a: Column, size_a: Column, yaw_a: Column, at_b: Column, size_b: Column, yaw_b: Column, slack: float = 0.001) -> Column:
    """Separating axes of two upright turned boxes: their heights, and the two level axes of each; touching is no overlap."""
    dx, dz = at_b["x"] - at_a["x"], at_b["z"] - at_a["z"]
    turn = yaw_b - yaw_a
    c, s = F.abs(F.cos(turn)), F.abs(F.sin(turn))

    def apart(yaw: Column, own: Column, other: Column) -> Column:
        right, look = F.abs(dx * F.cos(yaw) - dz * F.sin(yaw)), F.abs(dx * F.sin(yaw) + dz * F.cos(yaw))
        wide = (own["x"] + other["x"] * c + other["z"] * s) / 2 - slack
        deep = (own["z"] + other["x"] * s + other["z"] * c) / 2 - slack
        return (right >= wide) | (look >= deep)

    high = F.abs(at_a["y"] - at_b["y"]) >= (size_a["y"] + size_b["y"]) / 2 - slack
    return ~(high | apart(yaw_a, size_a, size_b) | apart(yaw_b, size_b, size_a))


def in_solid(p: Column, size: Column, wedge: Column, eps: float = 0.0) -> Column:
    """Whether a point of a box's own frame is in it, or in the wedge under its slope from the low front (-z) to the high back."""
    box = (F.abs(p["x"]) <= size["x"] / 2 + eps) & (F.abs(p["y"]) <= size["y"] / 2 + eps) & (F.abs(p["z"]) <= size["z"] / 2 + eps)
    above = (p["y"] / size["y"] - p["z"] / size["z"]) / F.sqrt(1 / (size["y"] * size["y"]) + 1 / (size["z"] * size["z"]))
    return box & (~wedge | (above <= eps))


def flat_face(a: Column, b: Column, c: Column, least_up: float, most_rise: float) -> Column:
    """struct(y, area) of a nearly level triangle (the level part of its area), null for others and for slivers."""
    n = cross(mapped(lambda p, q: q - p, a, b), mapped(lambda p, q: q - p, a, c))
    size = length(n)
    rise = F.greatest(a["y"], b["y"], c["y"]) - F.least(a["y"], b["y"], c["y"])
    level = (size > 0.1) & (F.abs(n["y"]) / size >= least_up) & (rise <= most_rise)
    return F.when(level, F.struct(((a["y"] + b["y"] + c["y"]) / 3).alias("y"), (F.abs(n["y"]) / 2).alias("area")))
