"""Scalar functions on rings: arrays of struct<x, z>, implicitly closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def following(ring: Column) -> Column:
    """The ring from its second vertex on, then its first."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings; 0 for fewer than three vertices."""
    cross = F.zip_with(ring, following(ring), lambda a, b: a["x"] * b["z"] - b["x"] * a["z"])
    return F.aggregate(cross, F.lit(0.0), lambda s, v: s + v) / 2


def segment_distance(px: Column, pz: Column, ax: Column, az: Column, bx: Column, bz: Column) -> Column:
    """Distance of a point to a segment; the foot is clamped to the ends."""
    dx, dz = bx - ax, bz - az
    length = dx * dx + dz * dz
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (pz - az) * dz) / length))).otherwise(0.0)
    return F.sqrt(F.pow(px - ax - t * dx, 2) + F.pow(pz - az - t * dz, 2))


def inside_ring(ring: Column, px: Column, pz: Column) -> Column:
    """Even-odd rule with half-open edges."""
    hit = F.zip_with(ring, following(ring), lambda a, b: ((a["z"] > pz) != (b["z"] > pz)) & (px < (b["x"] - a["x"]) * (pz - a["z"]) / (b["z"] - a["z"]) + a["x"]))
    return F.size(F.filter(hit, lambda v: v)) % 2 == 1


def crossings(ya: Column, yb: Column, at: Column) -> Column:
    """Half-open plane crossing: each height belongs to one side only."""
    return ((ya <= at) & (yb > at)) | ((yb <= at) & (ya > at))


def grid_key(*values: Column, step: float) -> Column:
    """Weld key: coordinates rounded half away from zero to multiples of step."""
    return F.concat_ws(":", *(F.round(v / step).cast("long").cast("string") for v in values))


def rolling_checksum(text: Column) -> Column:
    """(c * 131 + byte) mod 1000000007 over the characters of an ASCII text."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda s, c: F.pmod(s * 131 + c, F.lit(1_000_000_007).cast("long")))


def finite(*values: Column) -> Column:
    """Whether all are numbers other than NaN and the infinities; null counts as no number."""
    return F.forall(F.array(*values), lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))


def turn(a: Column, b: Column, c: Column) -> Column:
    """Twice the signed area of three struct<x, z>: positive when c is to the left of a to b."""
    return (b["x"] - a["x"]) * (c["z"] - a["z"]) - (b["z"] - a["z"]) * (c["x"] - a["x"])


def segments_meet(a: Column, b: Column, c: Column, d: Column, length_eps: float = 1e-6, area_eps: float = 1e-6) -> Column:
    """Whether the segments a to b and c to d have a point in common: neither lies strictly on one side of the other's line,
    and on both axes the spans of the two overlap. What is within an eps counts as on the line, or as overlapping."""
    side = lambda p, q, r: F.when(turn(p, q, r) > area_eps, 1).when(turn(p, q, r) < -area_eps, -1).otherwise(0)
    one_sided = lambda p, q, r, s: side(p, q, r) * side(p, q, s) > 0
    overlap = F.lit(True)
    for v in "xz":
        overlap = overlap & (F.greatest(F.least(a[v], b[v]), F.least(c[v], d[v])) <= F.least(F.greatest(a[v], b[v]), F.greatest(c[v], d[v])) + length_eps)
    return overlap & ~one_sided(a, b, c, d) & ~one_sided(c, d, a, b)


def enclosed(segments: Column, px: Column, pz: Column) -> Column:
    """Whether an odd number of segments (array of array of two struct<x, z>) is crossed to the left, right, front and back."""

    def odd(along: str, across: str, p: Column, q: Column, before: bool) -> Column:
        def hit(s: Column) -> Column:
            a, b = s[0], s[1]
            at = a[along] + (q - a[across]) * (b[along] - a[along]) / F.nullif(b[across] - a[across], F.lit(0.0))
            return F.coalesce(crossings(a[across], b[across], q) & ((at < p) if before else (at > p)), F.lit(False))

        return F.size(F.filter(segments, hit)) % 2 == 1

    return odd("x", "z", px, pz, True) & odd("x", "z", px, pz, False) & odd("z", "x", pz, px, True) & odd("z", "x", pz, px, False)
