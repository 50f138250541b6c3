"""Arithmetic of buildings as column expressions: floors, cells, keys, cores and names.

Lengths are in studs; METER is one metre. Nulls give nulls unless a function says otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataframe.config import Generator

#: One metre in studs, and the multipliers and the modulus of a position's seed.
METER = 1 / 0.28
SEED_FACTORS = (73856093, 19349663, 83492791)
SEED_MODULUS = 1 << 31
#: Name patterns.
BUILDING, GENERATED, SMOOTH, FLOOR = "^Building", "^BuildingAuto_", "^BuildingSmooth_", "^Floor([0-9]+)$"


_MADE = Generator()


@dataclass(frozen=True)
class FloorParams:
    """clear, least_clear: height of a floor between its slabs, by default and at least. slab: thickness of a slab."""

    clear: float = _MADE.floor_clear
    least_clear: float = _MADE.min_floor_clear
    slab: float = _MADE.slab


def floor_plan(height: Column, requested: Column, p: FloorParams = FloorParams()) -> Column:
    """struct(floors, ground, upper): how many floors a height holds, and the clear heights of the first and the others.

    Without a request (null, or below 1) whole floors at the default height, what is left over goes to the ground floor; a
    height below one floor makes one low floor. With a request that many equal floors, fewer if they fell below least_clear.
    """
    pitch = p.clear + p.slab
    wanted = F.floor(requested)
    most = F.greatest(F.lit(1), F.floor((height - p.slab) / (p.least_clear + p.slab)))
    equal = lambda n: (height - (n + 1) * p.slab) / n
    asked = F.when(equal(wanted) < p.least_clear, most).otherwise(wanted)
    free = F.floor((height - 2 * p.slab - p.clear) / pitch) + 1
    low = height < 2 * p.slab + p.clear
    floors = F.when(requested >= 1, asked).when(low, F.lit(1)).otherwise(free).cast("int")
    ground = F.when(requested >= 1, equal(asked)).when(low, F.greatest(height - 2 * p.slab, F.lit(p.clear / 2))).otherwise(height - 2 * p.slab - (free - 1) * pitch)
    return F.struct(floors.alias("floors"), ground.alias("ground"), F.when(requested >= 1, equal(asked)).otherwise(F.lit(p.clear)).alias("upper"))


def floor_bottom(ground: Column, upper: Column, k: Column, slab: float = FloorParams().slab) -> Column:
    """Height above the base of the slab line k: that of floor k, and of the roof where k is one more than the floors."""
    return F.when(k <= 1, F.lit(0.0)).otherwise(slab + ground + (k - 2) * (upper + slab))


def line_bottom(size_y: Column, ground: Column, upper: Column, k: Column, slab: float = FloorParams().slab) -> Column:
    """The same, from the middle of a box of height size_y."""
    return floor_bottom(ground, upper, k, slab) - size_y / 2


def clear_of(ground: Column, upper: Column, k: Column) -> Column:
    return F.when(k == 1, ground).otherwise(upper)


def cell_centre(least: Column, cell: Column, i: Column) -> Column:
    return least + (i - 0.5) * cell


def cell_of(least: Column, cell: Column, at: Column) -> Column:
    """The number, from 1, of the cell that a coordinate is in; it may lie outside the grid."""
    return (F.floor((at - least) / cell) + 1).cast("int")


def occupied(mask: Column, i: Column, j: Column, nx: Column, nz: Column) -> Column:
    """Whether the mask (rows of nz characters) has a 1 at row i, column j; false outside and for a missing mask."""
    inside = i.between(1, nx) & j.between(1, nz)
    return F.coalesce(inside & (F.substr(mask, (i - 1) * nz + j, F.lit(1)) == "1"), F.lit(False))


def position_seed(x: Column, y: Column, z: Column) -> Column:
    total = sum((v * f for v, f in zip((y, z), SEED_FACTORS[1:])), x * SEED_FACTORS[0])
    return F.pmod(F.floor(total).cast("long"), F.lit(SEED_MODULUS).cast("long"))


def source_key(mesh: Column, x: Column, y: Column, z: Column) -> Column:
    """mesh_x_y_z with the centre in tenths, rounded half away from zero."""
    return F.concat_ws("_", mesh.cast("string"), *(F.round(v * 10).cast("long").cast("string") for v in (x, y, z)))


def key_suffix(key: Column) -> Column:
    """The x_y_z part of a source key, null where it is none."""
    found = F.regexp_extract(key, r"^[0-9]+_(-?[0-9]+_-?[0-9]+_-?[0-9]+)$", 1)
    return F.when(found != "", found)


def floor_number(name: Column) -> Column:
    found = F.regexp_extract(name, FLOOR, 1)
    return F.when(found != "", found.cast("int"))


def plain_reason(message: Column) -> Column:
    """A message without the place it was raised at (up to the first `:number: `)."""
    return F.regexp_replace(message, r"^[^:]*:[0-9]+: ", "")


def clamped(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def selection_score(confidence: Column, area: Column, height: Column, n: Column) -> Column:
    """What disjoint plans are chosen by: confidence first, then size, then how many sources a plan joins."""
    return F.pow(confidence, 3) * F.sqrt(area) * height * (1 + n * 0.05)


def cluster_confidence(confidence: Column, n: Column) -> Column:
    """The confidence of a plan of n sources: each beyond the second takes a little."""
    return F.greatest(F.lit(0.0), F.coalesce(confidence, F.lit(0.0)) - F.greatest(F.lit(0), n - 2) * 0.005)


def core_size(width: Column, small: Column, ring: Column, ratio: float = _MADE.core_ratio, small_ratio: float = _MADE.small_core_ratio, least: float = _MADE.min_core) -> Column:
    """One side of a core in a rectangle of that width: a share of it, but no farther from the edge than ring, at least
    `least` where that is no more than half; within 2 and the width less 2."""
    share = width * F.when(small, F.lit(small_ratio)).otherwise(F.lit(ratio))
    want = F.greatest(share, width - 2 * ring, F.least(F.lit(least), width * 0.5))
    return F.greatest(F.lit(2.0), F.least(want, F.greatest(F.lit(2.0), width - 2)))


def core_pieces(x: Column, z: Column, width: Column, depth: Column, wall: float = _MADE.core_wall) -> Column:
    """array of struct(name, x, z, sx, sz): four walls and two dividers of a core with its middle at x, z."""
    piece = lambda name, dx, dz, sx, sz: F.struct(F.lit(name).alias("name"), (x + dx).alias("x"), (z + dz).alias("z"), sx.cast("double").alias("sx"), sz.cast("double").alias("sz"))
    none, thick = F.lit(0.0), F.lit(wall)
    return F.array(
        piece("CoreWallFront", none, depth / 2, width + wall, thick), piece("CoreWallBack", none, -depth / 2, width + wall, thick),
        piece("CoreWallRight", width / 2, none, thick, depth - wall), piece("CoreWallLeft", -width / 2, none, thick, depth - wall),
        piece("CoreDividerX", none, none, width - wall, thick), piece("CoreDividerZ", none, none, thick, depth - wall),
    )
