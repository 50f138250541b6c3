"""Rings (arrays of struct<x, z>, closed without repeating the first vertex) as column expressions.

Edges are numbered like the vertices they begin at. Everything is made of higher-order functions, so that rings stay
in the JVM; the cost of one with n vertices is n for a point and n * m for two rings.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataframe.functions.geometry import following, signed_area, turn


def point(x: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), z.cast("double").alias("z"))


def box_ring(x0: Column, z0: Column, x1: Column, z1: Column) -> Column:
    return F.array(point(x0, z0), point(x1, z0), point(x1, z1), point(x0, z1))


def edges(ring: Column) -> Column:
    """array of struct(a, b)."""
    return F.zip_with(ring, following(ring), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def bounds(ring: Column) -> Column:
    """struct(x0, z0, x1, z1)."""
    of = lambda f, v: f(F.transform(ring, lambda p: p[v]))
    return F.struct(of(F.array_min, "x").alias("x0"), of(F.array_min, "z").alias("z0"), of(F.array_max, "x").alias("x1"), of(F.array_max, "z").alias("z1"))


def centroid(ring: Column) -> Column:
    """The mean of the vertices."""
    mean = lambda v: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[v]) / F.size(ring)
    return point(mean("x"), mean("z"))


def along(a: Column, b: Column, t: Column | float) -> Column:
    return point(a["x"] + (b["x"] - a["x"]) * t, a["z"] + (b["z"] - a["z"]) * t)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _spans(ring: Column) -> Column:
    """array of struct(x, z, dx, dz, n): where each edge begins, which way it goes, and the square of its length (1 where it has none)."""

    def span(p: Column, q: Column) -> Column:
        dx, dz = q["x"] - p["x"], q["z"] - p["z"]
        return F.struct(p["x"].alias("x"), p["z"].alias("z"), dx.alias("dx"), dz.alias("dz"), F.coalesce(F.nullif(dx * dx + dz * dz, F.lit(0.0)), F.lit(1.0)).alias("n"))

    return F.zip_with(ring, following(ring), span)


def _nearest(spans: Column, p: Column) -> Column:
    def away(e: Column) -> Column:
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - e["x"]) * e["dx"] + (p["z"] - e["z"]) * e["dz"]) / e["n"]))
        return bound(share, lambda t: F.hypot(p["x"] - e["x"] - t * e["dx"], p["z"] - e["z"] - t * e["dz"]))

    return F.array_min(F.transform(spans, away))


def distance_to_ring(ring: Column, p: Column) -> Column:
    """Distance of a point to the nearest edge."""
    return _nearest(_spans(ring), p)


def contains_point(ring: Column, p: Column, tolerance: float = 1e-5) -> Column:
    """Even-odd rule; what lies within the tolerance of an edge is inside."""
    return bound(_sides(ring), lambda sides: _held(sides, p, tolerance))


def _sides(ring: Column) -> Column:
    """The edges and spans of a ring in one array, for many points: struct(a, b, x, z, dx, dz, n)."""

    def side(p: Column, q: Column) -> Column:
        dx, dz = q["x"] - p["x"], q["z"] - p["z"]
        return F.struct(p.alias("a"), q.alias("b"), p["x"].alias("x"), p["z"].alias("z"), dx.alias("dx"), dz.alias("dz"), F.coalesce(F.nullif(dx * dx + dz * dz, F.lit(0.0)), F.lit(1.0)).alias("n"))

    return F.zip_with(ring, following(ring), side)


def _held(sides: Column, p: Column, tolerance: float) -> Column:
    """contains_point of a ring's _sides."""

    def crossed(e: Column) -> Column:
        at = e["x"] + (p["z"] - e["z"]) * e["dx"] / F.nullif(e["dz"], F.lit(0.0))
        return ((e["z"] > p["z"]) != (e["b"]["z"] > p["z"])) & F.coalesce(p["x"] < at, F.lit(False))

    # what is not near an edge's box is not near the edge: that tells most without a root
    def close(e: Column) -> Column:
        beside = lambda v, d: (p[v] >= F.least(e[v], e["b"][v]) - d) & (p[v] <= F.greatest(e[v], e["b"][v]) + d)
        return beside("x", 2 * tolerance) & beside("z", 2 * tolerance) & (_nearest(F.array(e), p) <= tolerance)

    return (F.size(F.filter(sides, crossed)) % 2 == 1) | F.exists(sides, close)


def meet(p: Column, q: Column, eps: float) -> Column:
    """Whether two edges, struct(a, b), have a point in common: neither lies on one side of the other's line, and where
    they lie on one line their spans overlap. eps is the area below which a turn counts as straight."""
    side = lambda s, t: F.signum(F.when(F.abs(turn(s["a"], s["b"], t)) <= eps, F.lit(0.0)).otherwise(turn(s["a"], s["b"], t)))
    parted = lambda s, t: side(s, t["a"]) * side(s, t["b"]) > 0
    far = reduce(lambda x, y: x | y, [F.greatest(p["a"][v], p["b"][v]) < F.least(q["a"][v], q["b"][v]) for v in "xz"] + [F.greatest(q["a"][v], q["b"][v]) < F.least(p["a"][v], p["b"][v]) for v in "xz"])
    return ~(parted(p, q) | parted(q, p) | far)


def simple(ring: Column, least_area: float = 0.0, least_edge: float = 0.0, eps: float = 1e-9) -> Column:
    """Whether a ring has three vertices at least, an area above least_area, edges above least_edge, and no two edges that
    are not neighbours have a point in common."""
    own = F.transform(edges(ring), lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    n = F.size(ring)
    clash = F.exists(own, lambda s: F.exists(own, lambda t: (s["i"] + 1 < t["i"]) & ~((s["i"] == 0) & (t["i"] == n - 1)) & meet(s["e"], t["e"], eps)))
    short = F.exists(edges(ring), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["z"] - e["a"]["z"]) <= least_edge)
    return (n >= 3) & (F.abs(signed_area(ring)) > least_area) & ~short & ~clash


def shape_distance(a: Column, b: Column) -> Column:
    """How far two rings are apart: the largest distance of a vertex or edge middle of one to the other."""

    def one_way(p: Column, q: Column) -> Column:
        tried = F.flatten(F.transform(p, lambda e: F.array(point(e["x"], e["z"]), point(e["x"] + e["dx"] / 2, e["z"] + e["dz"] / 2))))
        return F.array_max(F.transform(tried, lambda v: _nearest(q, v)))

    return bound(_spans(a), lambda p: bound(_spans(b), lambda q: F.greatest(one_way(p, q), one_way(q, p))))


def similar(a: Column, b: Column, least_ratio: float = 0.92, least_reach: float = 1.5, reach_share: float = 0.035) -> Column:
    """Whether two footprints, struct(ring, area, width), are alike: in area, and in shape within a share of the lesser width."""
    ratio = F.least(a["area"], b["area"]) / F.greatest(a["area"], b["area"])
    reach = F.greatest(F.lit(least_reach), F.least(a["width"], b["width"]) * reach_share)
    return F.when(ratio < least_ratio, F.lit(False)).otherwise(shape_distance(a["ring"], b["ring"]) <= reach)


def contains_probe(outer: Column, inner: Column, tolerance: float = 1e-5) -> Column:
    """Whether inner lies in outer as far as four points of each edge tell and no two edges cross."""
    probes = F.flatten(F.transform(edges(inner), lambda e: F.transform(F.array(*map(F.lit, (0.0, 0.25, 0.5, 0.75))), lambda t: along(e["a"], e["b"], t))))
    crossing = lambda sides: F.exists(edges(inner), lambda s: F.exists(sides, lambda t: _crosses(s, t)))
    return bound(_sides(outer), lambda sides: ~crossing(sides) & F.forall(probes, lambda p: _held(sides, p, tolerance)))


def _crosses(s: Column, t: Column, eps: float = 1e-8) -> Column:
    return (turn(s["a"], s["b"], t["a"]) * turn(s["a"], s["b"], t["b"]) < -eps) & (turn(t["a"], t["b"], s["a"]) * turn(t["a"], t["b"], s["b"]) < -eps)


def contains_ring(outer: Column, inner: Column, tolerance: float = 1e-5) -> Column:
    """Whether inner lies in outer, exactly: each edge is cut where outer's edges meet it, and the middle of every part is inside."""

    def cuts(sides: Column, s: Column) -> Column:
        rx, rz = s["b"]["x"] - s["a"]["x"], s["b"]["z"] - s["a"]["z"]

        def of(t: Column) -> Column:
            tx, tz = t["b"]["x"] - t["a"]["x"], t["b"]["z"] - t["a"]["z"]
            cx, cz = t["a"]["x"] - s["a"]["x"], t["a"]["z"] - s["a"]["z"]
            det = rx * tz - rz * tx
            at, on = (cx * tz - cz * tx) / F.nullif(det, F.lit(0.0)), (cx * rz - cz * rx) / F.nullif(det, F.lit(0.0))
            size = F.nullif(rx * rx + rz * rz, F.lit(0.0))
            foot = lambda p: ((p["x"] - s["a"]["x"]) * rx + (p["z"] - s["a"]["z"]) * rz) / size
            level = F.abs(cx * rz - cz * rx) <= 1e-8
            return F.when(F.abs(det) > 1e-8, F.when(on.between(0, 1), F.array(at))).when(level, F.array(foot(t["a"]), foot(t["b"])))

        found = F.flatten(F.filter(F.transform(sides, of), lambda x: x.isNotNull()))
        return F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.filter(found, lambda t: (t > 0) & (t < 1))))

    def held(sides: Column, s: Column) -> Column:
        parts = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        middle = lambda t: _held(sides, along(s["a"], s["b"], (t["x"] + t["y"]) / 2), tolerance)
        ends = _held(sides, s["a"], tolerance) & _held(sides, s["b"], tolerance)
        # the cuts in an array of one, so that they are computed once
        return ends & F.forall(F.array(cuts(sides, s)), lambda c: F.forall(parts(c), lambda t: (t["y"] - t["x"] <= 1e-7) | middle(t)))

    return bound(_sides(outer), lambda sides: F.forall(edges(inner), lambda s: held(sides, s)))


def enters_box(e: Column, x0: Column, z0: Column, x1: Column, z1: Column, eps: float = 1e-9) -> Column:
    """Whether an edge passes through the inside of a box (clipped to it, some length is left away from its sides)."""
    a, b = e["a"], e["b"]

    def span(p: Column, q: Column, low: Column, high: Column) -> tuple[Column, Column, Column]:
        """From where to where the edge is between low and high, and whether it is at all."""
        d = q - p
        t0, t1 = (low - p) / F.nullif(d, F.lit(0.0)), (high - p) / F.nullif(d, F.lit(0.0))
        return F.coalesce(F.least(t0, t1), F.lit(0.0)), F.coalesce(F.greatest(t0, t1), F.lit(1.0)), (d != 0) | ((p > low + eps) & (p < high - eps))

    xs, zs = span(a["x"], b["x"], x0, x1), span(a["z"], b["z"], z0, z1)
    return xs[2] & zs[2] & (F.least(xs[1], zs[1], F.lit(1.0)) - F.greatest(xs[0], zs[0], F.lit(0.0)) > eps)


def contains_box(ring: Column, x0: Column, z0: Column, x1: Column, z1: Column, tolerance: float = 1e-6) -> Column:
    """Whether a box lies in a ring: its corners do and no edge passes through it."""
    corners = box_ring(x0, z0, x1, z1)
    return bound(_sides(ring), lambda sides: F.forall(corners, lambda p: _held(sides, p, tolerance)) & ~F.exists(sides, lambda e: enters_box(e, x0, z0, x1, z1)))


def is_rectangle(ring: Column, eps: float = 1e-7) -> Column:
    """Whether a ring has four vertices and right angles; eps is relative to the edges."""
    side = lambda k: F.struct((F.element_at(ring, (k + 1) % 4 + 1)["x"] - F.element_at(ring, k + 1)["x"]).alias("x"), (F.element_at(ring, (k + 1) % 4 + 1)["z"] - F.element_at(ring, k + 1)["z"]).alias("z"))

    def right(p: Column, q: Column) -> Column:
        return F.abs(p["x"] * q["x"] + p["z"] * q["z"]) <= eps * F.hypot(p["x"], p["z"]) * F.hypot(q["x"], q["z"])

    square = reduce(lambda x, y: x & y, [right(side(k), side((k + 1) % 4)) for k in range(4)])
    return F.when(F.size(ring) == 4, square).otherwise(False)


def in_triangle(p: Column, a: Column, b: Column, c: Column, eps: float = 0.0) -> Column:
    """Whether a point is in a counter-clockwise triangle, its sides included."""
    return (turn(a, b, p) >= -eps) & (turn(b, c, p) >= -eps) & (turn(c, a, p) >= -eps)
