"""Grids from solids and from sections, bodies cut out of grids, ground below points, picks by rays, tracks of loops and contracts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.functions import building, geometry, motion, rings
from strataframe.operators import masks
from strataframe.operators.rings import _cell, spread, turned_overlaps
from strataframe.storage import restored, stored

C = F.col


def _floor_grid(models: DataFrame, cell: Column) -> DataFrame:
    """models with the size of a cell and how many of them there are on a floor's sides."""
    return models.withColumn("cell", cell).withColumns({"nx": F.ceil(C("sx") / C("cell")).cast("int"), "nz": F.ceil(C("sz") / C("cell")).cast("int")})


def _floor_cells(models: DataFrame, cell: Column) -> DataFrame:
    """models with a row per cell of a floor: i, j and the middle x, z in the model's frame."""
    rows = _floor_grid(models, cell)
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1), C("nx")))).withColumn("j", F.explode(F.sequence(F.lit(1), C("nz"))))
    return rows.withColumns({"x": building.cell_centre(-C("sx") / 2, C("cell"), C("i")), "z": building.cell_centre(-C("sz") / 2, C("cell"), C("j"))})


def sampled_solids(models: DataFrame, solids: DataFrame, low: float = 0.15, high: float = 0.95) -> DataFrame:
    """m, k, i, j, tight of the cells of each floor whose middle a solid of the model holds near the floor; tight where one does near the ceiling too.

    models: m, sx, sy, sz (the box), floors, ground, upper. solids: m, lo, hi in the model's frame (its middle at 0). Cells are a
    share of the box, at least 2.5. Each cell meets the solids of its own model only. Where solids tell (upright), a model of one upright block is all cells, tight ones.
    """
    grid = _floor_cells(models, F.greatest(F.lit(2.5), F.greatest("sx", "sz") / 18)).withColumn("k", F.explode(F.sequence(F.lit(1), C("floors"))))
    base = building.line_bottom(C("sy"), C("ground"), C("upper"), C("k")) + building.FloorParams().slab
    clear = building.clear_of(C("ground"), C("upper"), C("k"))
    rows = grid.select("m", "k", "i", "j", "x", "z", (base + clear * low).alias("y0"), (base + clear * high).alias("y1")).join(solids, "m")
    flat = C("x").between(C("lo.x"), C("hi.x")) & C("z").between(C("lo.z"), C("hi.z"))
    held = lambda y: F.bool_or(C(y).between(C("lo.y"), C("hi.y")))
    found = rows.filter(flat).groupBy("m", "k", "i", "j").agg(held("y0").alias("loose"), held("y1").alias("high"))
    cells = found.filter("loose").select("m", "k", "i", "j", C("high").alias("tight"))
    if "upright" not in solids.columns:
        return cells
    lone = solids.groupBy("m").agg(F.count("*").alias("n"), F.bool_and(F.coalesce("upright", F.lit(False))).alias("block")).filter("n = 1 AND block").select("m")
    return cells.join(lone, "m", "left_anti").unionByName(grid.select("m", "k", "i", "j").join(lone, "m").withColumn("tight", F.lit(True)).select("m", "k", "i", "j", "tight"))


def sampled_sections(models: DataFrame, slices: DataFrame) -> DataFrame:
    """m, k, i, j of the cells whose middle and four corners (drawn in a little) lie within the section of their floor.

    models: m, sx, sz. slices: m, k, segments (array of arrays of two struct<x, z>) in the model's frame. Cells are a share of the box, at
    least 3. A point is within where it has an odd number of segments on all four sides. A section is one task's.
    """
    grid = _floor_grid(models, F.greatest(F.lit(3.0), F.greatest("sx", "sz") / 24)).join(slices.hint("merge"), "m")
    ends = F.transform("segments", lambda s: F.struct(*(s[e][v].cast("double").alias(f"{p}{v}") for e, p in enumerate("ab") for v in "xz")))
    rows = grid.select("m", "k", "cell", "nx", "nz", (-C("sx") / 2).alias("x0"), (-C("sz") / 2).alias("z0"), ends.alias("ends"))
    schema = T.StructType([*rows.select("m", "k").schema.fields, T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICES):
                part = batch.slice(at, SLICES)
                own, ends = part.drop_columns(["m", "k", "ends"]).to_pylist(), part.column("ends")
                flat, cuts = ends.values, ends.offsets.to_numpy()
                a, b = (np.column_stack([flat.field(f"{p}{v}").to_numpy(zero_copy_only=False) for v in "xz"]) for p in "ab")
                found = [_held_cells(a[x:y], b[x:y], **r) for r, x, y in zip(own, cuts, cuts[1:])]
                place = pa.array(np.repeat(np.arange(len(own)), [len(i) for i, _ in found]))
                i, j = (pa.array(np.concatenate(c), pa.int32()) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([part.column("m").take(place), part.column("k").take(place), i, j], names=["m", "k", "i", "j"])

    return rows.mapInArrow(cells, schema)


#: Where a cell is tried, as shares of its size from its middle; sections of which the cells are made together.
PROBES, SLICES = ((0.0, 0.0), (0.4, 0.4), (0.4, -0.4), (-0.4, 0.4), (-0.4, -0.4)), 256


def _held_cells(a: np.ndarray, b: np.ndarray, cell: float, nx: int, nz: int, x0: float, z0: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), from 1, of the cells of a grid that begins at x0, z0 of which all probes have an odd number of segments a to b (n by 2) on all four sides. Ends that are missing meet nothing."""
    if None in (cell, nx, nz, x0, z0) or not len(a):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    i, j = np.repeat(np.arange(1, nx + 1), nz), np.tile(np.arange(1, nz + 1), nx)
    for dx, dz in PROBES:
        x, z = x0 + (i - 0.5) * cell + cell * dx, z0 + (j - 0.5) * cell + cell * dz
        inside = np.ones(len(i), bool)
        for u, v, p, q in ((0, 1, x, z), (1, 0, z, x)):
            over = (a[None, :, v] > q[:, None]) != (b[None, :, v] > q[:, None])
            rise = np.where(a[:, v] == b[:, v], 1.0, b[:, v] - a[:, v])
            at = a[None, :, u] + (q[:, None] - a[None, :, v]) * (b[:, u] - a[:, u]) / rise
            for beyond in (at < p[:, None], at > p[:, None]):
                inside &= (over & beyond).sum(axis=1) % 2 == 1
        i, j = i[inside], j[inside]
    return i, j


def sample_reasons(models: DataFrame, cells: DataFrame, least_width: float = 12.0, share: float = 0.6, least_cells: int = 4, least_area: float = 150.0) -> DataFrame:
    """models (m, sx, sz, floors) with reason: why what was sampled is no building, null where it is."""
    floors = cells.groupBy("m", "k").agg(F.count("*").alias("n"))
    own = floors.groupBy("m").agg(F.count_if(C("n") >= least_cells).alias("__good"), F.sum("n").alias("__n"))
    cell = F.greatest(F.lit(3.0), F.greatest("sx", "sz") / 24)
    rows = models.join(own, "m", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("__good", "__n")})
    reason = F.when(F.least("sx", "sz") < least_width, "too narrow").when(C("__good") < C("floors") * share, "too few floors").when(C("__n") * cell * cell / C("floors") < least_area, "too small")
    return rows.withColumn("reason", reason).drop("__good", "__n")


def cropped(bodies: DataFrame, elevated: bool = False) -> DataFrame:
    """m, body, first, last, i0, i1, j0, j1, reason: bodies (m, body, component, k, i, j) as grids of their own; reason where a floor has
    several components, a floor is missing, or (without elevated) the first floor is not 1."""
    floors = bodies.groupBy("m", "body", "k").agg(F.count_distinct("component").alias("n"), *(f(v).alias(f"{v}{e}") for v in "ij" for e, f in ((0, F.min), (1, F.max))))
    whole = floors.groupBy("m", "body").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.count("*").alias("__k"), F.max("n").alias("__n"), *(f(f"{v}{e}").alias(f"{v}{e}") for v in "ij" for e, f in ((0, F.min), (1, F.max))))
    reason = F.when(C("__n") > 1, "body branches or merges")
    if not elevated:
        reason = reason.when(C("first") != 1, "substantial body does not begin on the ground floor")
    return whole.withColumn("reason", reason.when(C("__k") != C("last") - C("first") + 1, "body has an unsupported vertical gap")).drop("__k", "__n")


def cell_corners(cells: DataFrame, cell: float, size_x: float, size_z: float) -> DataFrame:
    """m, k and the four corners x, z of each cell, cut at the box (whose middle is 0); corners that cells share come once for each floor."""
    at = lambda n, size: F.least(F.greatest(-size / 2 + n * cell, F.lit(-size / 2)), F.lit(size / 2))
    # the corners of a floor, which is bounded, are put together within its row
    last = [next(n for n in itertools.count() if -size / 2 + n * cell >= size / 2) for size in (size_x, size_z)]
    line = lambda n, most: F.least(F.greatest(n, F.lit(0)), F.lit(most))
    corner = lambda i, j, a, b: line(i - 1 + a, last[0]).cast("long") * masks.ROW + line(j - 1 + b, last[1])
    around = F.array_distinct(F.flatten(F.transform("own", lambda p: F.array(*(corner(*masks.of_place(p), a, b) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1)))))))
    i, j = masks.of_place(C("p"))
    corners = masks.places(cells).select("m", "k", F.explode(around).alias("p")).select("m", "k", i.alias("i"), j.alias("j"))
    return corners.select("m", "k", at(C("i"), size_x).alias("x"), at(C("j"), size_z).alias("z"))


def ground_below(points: DataFrame, surfaces: DataFrame, cell: float, rise: float = 500.0, depth: float = 2000.0) -> DataFrame:
    """points (id, x, y, z) with ground: the highest top (y1) of the surfaces (boxes) over which a point lies, from `rise` above to `depth` below it; null where there is none."""
    wide = spread(surfaces.select("x0", "x1", "z0", "z1", C("y1").alias("__top")), C("x0"), C("x1"), C("z0"), C("z1"), cell)
    near = points.select("id", "x", "y", "z", _cell(C("x"), cell).alias("gx"), _cell(C("z"), cell).alias("gz")).join(wide, ["gx", "gz"])
    under = C("x").between(C("x0"), C("x1")) & C("z").between(C("z0"), C("z1")) & C("__top").between(C("y") - depth, C("y") + rise)
    return points.join(near.filter(under).groupBy("id").agg(F.max("__top").alias("ground")), "id", "left")


def ray_picks(rays: DataFrame, triangles: DataFrame, cell: float) -> DataFrame:
    """hit, triangle, t: of the triangles (triangle, a, b, c) that a segment (hit, start, end) goes through the nearest, t from 0 to 1; ties to the least. Both
    meet on the grid cells that their bounds touch."""
    ends = lambda cs, v: (F.least(*(C(f"{c}.{v}") for c in cs)), F.greatest(*(C(f"{c}.{v}") for c in cs)))
    box = lambda df, cs, p: df.withColumns({f"{p}{v}{k}": e for v in "xyz" for k, e in enumerate(ends(cs, v))})
    a = spread(box(rays, ("start", "end"), "r"), C("rx0"), C("rx1"), C("rz0"), C("rz1"), cell)
    b = spread(box(triangles, "abc", "w"), C("wx0"), C("wx1"), C("wz0"), C("wz1"), cell)
    # each pair in the cell of the lower corner of what the two share, and only where their boxes meet
    meet = (C("gx") == _cell(F.greatest("rx0", "wx0"), cell)) & (C("gz") == _cell(F.greatest("rz0", "wz0"), cell))
    for v in "xyz":
        meet &= (C(f"r{v}0") <= C(f"w{v}1")) & (C(f"w{v}0") <= C(f"r{v}1"))
    less = lambda p, q: motion.mapped(lambda x, y: x - y, C(p), C(q))
    rows = a.join(b, ["gx", "gz"]).filter(meet).withColumns({"d": less("end", "start"), "e": less("b", "a"), "f": less("c", "a"), "s": less("start", "a")})
    rows = rows.withColumns({"h": motion.cross(C("d"), C("f")), "q": motion.cross(C("s"), C("e"))}).withColumn("det", motion.dot(C("e"), C("h")))
    part = lambda p, q: motion.dot(C(p), C(q)) / F.nullif(C("det"), F.lit(0.0))
    rows = rows.withColumns({"u": part("s", "h"), "v": part("d", "q"), "t": part("f", "q")}).filter("u >= 0 AND v >= 0 AND u + v <= 1 AND t BETWEEN 0 AND 1")
    return rows.groupBy("hit").agg(F.min(F.struct("t", "triangle")).alias("p")).select("hit", "p.triangle", "p.t")


def tracked(loops: DataFrame, least_ratio: float = 0.78, most_shift: float = 18.0, most_apart: float = 8.0) -> DataFrame:
    """m, sample, loop, track of loops (m, sample, loop, ring, area, x, z): loops that follow each other from sample to sample are one track.

    Pairs of loops of neighbouring samples that are alike in area, place and shape have a cost. In each sample the loops in order take the
    cheapest of theirs that no loop before took, of equal ones the least; what takes none begins a track. Tracks are numbered by model, by where
    they begin. A model without a sample between two has no track over the gap. Nulls in a key or figure pair with nothing.
    Loops are many, however small the file that they are made of, and are not broadcast.
    """
    later = loops.select("m", "sample", "loop", "ring", "area", "x", "z")
    before = later.select("m", (C("sample") + 1).alias("sample"), C("loop").alias("prev"), *(C(c).alias(f"p_{c}") for c in ("ring", "area", "x", "z")))
    ratio, shift = F.least("area", "p_area") / F.greatest("area", "p_area"), F.hypot(C("x") - C("p_x"), C("z") - C("p_z"))
    near = later.join(before.hint("merge"), ["m", "sample"]).withColumns({"ratio": ratio, "shift": shift}).filter((C("ratio") >= least_ratio) & (C("shift") <= most_shift))
    # written, so that the dearest figure is computed once, and after the others have ruled pairs out
    near = stored(near.select("m", "sample", "loop", "prev", "ratio", "shift", rings.shape_distance(C("p_ring"), C("ring")).alias("apart")), "pairs").filter(C("apart") <= most_apart)
    offers = near.select("m", "sample", F.struct("loop", (C("apart") + C("shift") / 4 + (1 - C("ratio")) * 10).alias("cost"), "prev").alias("offer"))
    pair = F.struct("offer.loop", "offer.prev")
    kind = f"array<{offers.select(pair.alias('p')).schema['p'].dataType.simpleString()}>"

    def take(done: Column, offer: Column) -> Column:
        free = ~F.exists(done, lambda d: (d["loop"] == offer["loop"]) | (d["prev"] == offer["prev"]))
        return F.when(free, F.concat(done, F.array(F.struct(offer["loop"].alias("loop"), offer["prev"].alias("prev"))))).otherwise(done).cast(kind)

    # a sample's offers, a few for each of its loops, in order of loop and cost
    taken = offers.groupBy("m", "sample").agg(F.aggregate(F.array_sort(F.collect_list("offer")), F.array().cast(kind), take).alias("taken"))
    taken = taken.select("m", "sample", F.explode("taken").alias("t")).select("m", "sample", "t.loop", "t.prev")
    own = loops.select("m", "sample", "loop").join(taken.hint("merge"), ["m", "sample", "loop"], "left")
    # where each loop's track begins: each round doubles the steps back
    head = F.when(C("prev").isNull(), F.struct("sample", "loop")).otherwise(F.struct((C("sample") - 1).alias("sample"), C("prev").alias("loop")))
    led, path = restored(own.select("m", "sample", "loop", head.alias("head")), None, "tracks")
    while True:
        to = led.select("m", F.struct("sample", "loop").alias("head"), C("head").alias("further"))
        step = led.join(to.hint("merge"), ["m", "head"]).select("m", "sample", "loop", "head", "further")
        if step.filter("head <> further").isEmpty():
            break
        led, path = restored(step.select("m", "sample", "loop", C("further").alias("head")), path, "tracks")
    return led.select("m", "sample", "loop", F.dense_rank().over(W.partitionBy("m").orderBy("head")).alias("track"))


def same_envelope(lo: Column, hi: Column, size: Column, tolerance: float = 0.35) -> Column:
    """Whether a local box is, on all six sides, within the tolerance of one of that size around 0."""
    off = [F.abs(lo[a] + size[a] / 2) for a in motion.AXES] + [F.abs(hi[a] - size[a] / 2) for a in motion.AXES]
    return F.greatest(*off) <= tolerance


def removable(kind: Column, tags: Column) -> Column:
    """Whether a part is deleted and not carved: meshes, and what is tagged so."""
    return (kind == "mesh") | F.coalesce(F.array_contains(tags, "NoCSG"), F.lit(False))


def in_building(path: Column) -> Column:
    """Whether a part lies below a building: some step of its path, but for its own name, begins so."""
    return path.rlike(r"(^|/)Building[^/]*/")


def section_contract(sections: DataFrame, cell: float, least_side: float = 4.0, least_height: float = 6.5 / 0.28, most: int = 100) -> DataFrame:
    """building, n, reason: authored sections (id, building, name, at, size, yaw, floors) of each building against the contract: a name,
    1 to `most` of them, finite, large enough, whole floors, and none overlapping another."""
    own = F.lit(True)
    for a in motion.AXES:
        own = own & geometry.finite(C(f"at.{a}"), C(f"size.{a}"))
    own = own & geometry.finite(C("yaw"))
    big = (C("size.x") > least_side) & (C("size.z") > least_side) & (C("size.y") >= least_height)
    floors = C("floors").isNull() | ((C("floors") >= 1) & (C("floors") == F.floor("floors")))
    pairs = turned_overlaps(sections.filter(own), cell)
    both = pairs.join(sections.select(C("id").alias("a"), C("building").alias("p")), "a").join(sections.select(C("id").alias("b"), C("building").alias("q")), "b").filter("p = q").select(C("p").alias("building")).distinct().withColumn("__over", F.lit(True))
    rows = sections.groupBy("building").agg(F.count("*").alias("n"), F.bool_and(F.coalesce(C("name").rlike(building.BUILDING), F.lit(False))).alias("__name"), F.bool_and(own).alias("__finite"), F.bool_and(F.coalesce(big, F.lit(False))).alias("__big"), F.bool_and(floors).alias("__floors"))
    reason = F.when(~C("__name"), "Name must begin with Building").when(C("n") > most, "too many sections").when(~C("__finite"), "Nonfinite frame").when(~C("__big"), "Section is too small for interior floors").when(~C("__floors"), "Invalid floors").when(C("__over"), "Sections overlap")
    return rows.join(both, "building", "left").select("building", "n", reason.alias("reason"))


def plan_audit(expected: DataFrame, actual: DataFrame, keys: list[str], tolerance: float = 1e-3) -> DataFrame:
    """keys, expected, found, reason of the pieces whose area is missing, not planned, or other than planned (relative to it, 1 at least)."""
    a = expected.groupBy(*keys).agg(F.sum("area").alias("expected"))
    b = actual.groupBy(*keys).agg(F.sum("area").alias("found"))
    off = F.abs(C("expected") - C("found")) > tolerance * F.greatest(C("expected"), F.lit(1.0))
    reason = F.when(C("found").isNull(), "missing piece").when(C("expected").isNull(), "unplanned piece").when(off, "area disagrees with plan")
    return a.join(b, keys, "full").withColumn("reason", reason).filter("reason IS NOT NULL")


def frame_of(triangles: DataFrame, yaws: DataFrame, by: list[str]) -> DataFrame:
    """by, yaw, size, at: the box around a group's triangles (a, b, c) in the frame turned by its yaw."""
    zero = motion.vector(F.lit(0), F.lit(0), F.lit(0))
    points = triangles.select(*by, F.explode(F.array("a", "b", "c")).alias("p")).join(yaws, by)
    rows = points.withColumn("q", motion.to_local(C("p"), zero, C("yaw")))
    ends = [f(f"q.{a}").alias(f"{n}{a}") for a in motion.AXES for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.groupBy(*by, "yaw").agg(*ends)
    middle = motion.vector(*((C(f"lo{a}") + C(f"hi{a}")) / 2 for a in motion.AXES))
    return found.select(*by, "yaw", motion.vector(*(C(f"hi{a}") - C(f"lo{a}") for a in motion.AXES)).alias("size"), motion.to_world(middle, zero, C("yaw")).alias("at"))


def moved_frame(at: Column, yaw: Column, saved: Column, saved_yaw: Column, pivot: Column, pivot_yaw: Column) -> tuple[Column, Column]:
    """Where a stored frame (at, yaw) is after its model has moved from saved to pivot: (at, yaw)."""
    return motion.to_world(motion.to_local(at, saved, saved_yaw), pivot, pivot_yaw), yaw + pivot_yaw - saved_yaw


def measured_box(a: Column, b: Column, c: Column, ground: Column, roof: Column | None = None, most: float = 5.0) -> Column:
    """struct(at, size, right, reason): the upright box whose roof has the corners a, b and c, c beside one of the others: from the ground to the mean height
    of the corners, or to `roof`. right is the level direction of its width, so that its depth is positive. Corners more than `most` apart in height are refused."""
    rise = F.greatest(a["y"], b["y"], c["y"]) - F.least(a["y"], b["y"], c["y"])
    top = (a["y"] + b["y"] + c["y"]) / 3 if roof is None else F.coalesce(roof, (a["y"] + b["y"] + c["y"]) / 3)
    dx, dz = b["x"] - a["x"], b["z"] - a["z"]
    width = F.hypot(dx, dz)
    ux, uz = dx / width, dz / width
    # the level direction across: right, turned by a quarter
    deep = (c["x"] - a["x"]) * -uz + (c["z"] - a["z"]) * ux
    sign = F.when(deep < 0, -1.0).otherwise(1.0)
    depth = F.abs(deep)
    middle = motion.vector((a["x"] + b["x"]) / 2 - uz * deep / 2, (top + ground) / 2, (a["z"] + b["z"]) / 2 + ux * deep / 2)
    reason = F.when((rise >= most) & (F.lit(True) if roof is None else roof.isNull()), "corners are on different roofs").when(ground.isNull(), "ground missing").when(~(width > 0) | ~(depth > 0), "corners are in line")
    size = motion.vector(width, top - ground, depth)
    return F.struct(F.when(reason.isNull(), middle).alias("at"), F.when(reason.isNull(), size).alias("size"), F.when(reason.isNull(), rings.point(ux * sign, uz * sign)).alias("right"), reason.alias("reason"))


def shell_sections(parts: DataFrame, by: list[str]) -> DataFrame:
    """by, sections (array of at, size, yaw, floors, core by part), reason: an authored shell's blocks as sections; refused where a part is no block."""
    own = F.struct("part", "at", "size", "yaw", "floors", "core")
    found = parts.groupBy(*by).agg(F.array_sort(F.collect_list(own)).alias("s"), F.bool_and(C("kind") == "block").alias("__ok"))
    reason = F.when(~C("__ok"), "only block parts are accepted")
    return found.select(*by, F.when(reason.isNull(), C("s")).alias("sections"), reason.alias("reason"))


#: Least size of a cell, and cells on an axis, of the grid of an exact box.
BOX_CELL, BOX_AXIS = 2.5, 18


def exact_boxes(boxes: DataFrame, p: building.FloorParams = building.FloorParams()) -> DataFrame:
    """boxes (with sx, sy, sz and requested, a number of floors or null) with cell, nx, nz, floors, ground, upper, mask (all cells, a text for every floor) and reason, null where the box is large enough and the request a whole
    number of floors."""
    bad = F.coalesce((C("requested") < 1) | (C("requested") != F.floor("requested")), F.lit(False))
    reason = F.when(~F.coalesce((C("sx") > 0) & (C("sz") > 0) & (C("sy") >= 2 * p.slab + p.clear), F.lit(False)), "box is too small").when(bad, "invalid floor count")
    rows = boxes.withColumn("reason", reason).withColumn("cell", F.greatest(F.lit(BOX_CELL), F.greatest("sx", "sz") / BOX_AXIS)).withColumn("f", building.floor_plan(C("sy"), C("requested"), p))
    sides = {"nx": F.ceil(C("sx") / C("cell")).cast("int"), "nz": F.ceil(C("sz") / C("cell")).cast("int"), "floors": C("f.floors"), "ground": C("f.ground"), "upper": C("f.upper")}
    rows = rows.withColumns(sides).drop("f")
    good = C("reason").isNull()
    return rows.withColumns({c: F.when(good, C(c)) for c in ("cell", *sides)}).withColumn("mask", F.when(good, F.repeat(F.lit("1"), C("nx") * C("nz"))))


def children(models: DataFrame, parent: str, name: str, pattern: str, kind: str | None = None, kinds: tuple[str, ...] = (), protected: tuple[str, ...] = ()) -> DataFrame:
    """The direct children (parent not null) whose name matches pattern, of one of kinds (all, if none is named), and without a value in any of the protected columns."""
    rows = models.filter(C(parent).isNotNull() & F.coalesce(C(name).rlike(pattern), F.lit(False)))
    rows = rows.filter(C(kind).isin(*kinds)) if kinds else rows
    for column in protected:
        rows = rows.filter(C(column).isNull())
    return rows


def slab_shapes(parts: DataFrame) -> DataFrame:
    """parts (kind: block or wedge; at, size and yaw of an upright part) with ring, the polygon that the part covers seen from above, and low and high. A wedge lies on its side: of size (thickness, height, depth) its
    triangle has the right angle at the lower end of the depth, its sides along height and depth, and its thickness is its extent upwards."""
    corner = lambda a, b: rings.point(C("at.x") + a * F.cos("yaw") - b * F.sin("yaw"), C("at.z") + a * F.sin("yaw") + b * F.cos("yaw"))
    half = {v: C(f"size.{v}") / 2 for v in "xyz"}
    block = F.array(*(corner(a * half["x"], b * half["z"]) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))))
    wedge = F.array(corner(-half["y"], -half["z"]), corner(-half["y"], half["z"]), corner(half["y"], half["z"]))
    flat = C("kind") == "wedge"
    ring = F.when(flat, wedge).otherwise(block)
    up = F.when(flat, half["x"]).otherwise(half["y"])
    turned = F.when(geometry.signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)
    return parts.withColumns({"ring": turned, "low": C("at.y") - up, "high": C("at.y") + up})
