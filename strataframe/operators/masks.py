"""Occupancy grids as cell tables: a row (m, k, i, j) per occupied cell, with model, floor, row and column from 1.

Operators keep cells as rows. Those that follow neighbours take one model in a task: a grid has at most MOST_CELLS cells a
floor and MOST_FLOORS floors, so that a model is bounded, and what lies outside raises an error. Rows with a null
coordinate are in no cell and drop out of joins; repeated cells count once where cells() has made the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.config import GridMassing, Incomplete
from strataframe.operators.kernels import by_group, by_sorted_group, labelled
from strataframe.storage import stored

CELL = ["m", "k", "i", "j"]
#: The largest grid, and floors stay below MOST_FLOORS. Cell numbers of one model stay below PER_MODEL.
MOST_CELLS, MOST_FLOORS = 16_384, 200
PER_MODEL = 1 << 24


def cells(df: DataFrame) -> DataFrame:
    """The distinct cells with all coordinates."""
    return df.select(*CELL).dropna().distinct()


def node(side: int) -> Column:
    """The number of a cell, unique over models."""
    return F.col("m").cast("long") * PER_MODEL + F.col("k") * (side * side) + (F.col("i") - 1) * side + F.col("j") - 1


def checked(k: np.ndarray, i: np.ndarray, j: np.ndarray, side: int) -> None:
    """Raises where a cell lies outside the grid, so that no two cells share a number."""
    if side * side > MOST_CELLS or (len(k) and (min(i.min(), j.min()) < 1 or max(i.max(), j.max()) > side or k.min() < 0 or k.max() >= MOST_FLOORS)):
        raise ValueError(f"a cell lies outside a grid of {side} by {side} and floors 0 to {MOST_FLOORS - 1}, or the grid exceeds {MOST_CELLS} cells")


def _beside(number: np.ndarray, there: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to): where the cells with some, of sorted cell numbers, have a cell at the number there."""
    at = np.minimum(np.searchsorted(number, there), len(number) - 1)
    hit = np.flatnonzero(some & (number[at] == there))
    return hit, at[hit]


def _flat(number: np.ndarray, side: int) -> np.ndarray:
    """For each of sorted cell numbers the place of the least that it reaches through shared sides on its floor."""
    sides = [_beside(number, number + step, some) for step, some in ((side, number // side % side < side - 1), (1, number % side < side - 1))]
    return labelled(len(number), *(np.concatenate(ends) for ends in zip(*sides)))


def bodies(occupied: DataFrame, side: int, kind: str, own: bool = False) -> DataFrame:
    """The cells with component, the least cell number reachable through shared sides on their floor, and body: with kind "vertical" the least one
    reachable also up and down; with "chain" the least component of the unbranched run of floors that the component is in; "flat" gives no body.

    A run goes on from a floor to the next where the one has one component above it and that has one below. One shuffle: a model's cells are labelled together.
    With own, numbers are those within the model: where m is itself the number of a body, those over all models exceed 64 bits.
    """

    def label(model: pa.Table) -> pa.Table:
        k, i, j = (model.column(c).to_numpy().astype(np.int64) for c in "kij")
        checked(k, i, j, side)
        number = k * side * side + (i - 1) * side + j - 1
        known, place = np.unique(number, return_inverse=True)
        flat = _flat(known, side)
        base = model.column("m").to_numpy().astype(np.int64) * (0 if own else PER_MODEL)
        out = model.append_column("component", pa.array(base + known[flat][place]))
        if kind == "flat":
            return out
        low, high = (flat[ends] for ends in _beside(known, known + side * side, np.ones(len(known), bool)))
        if kind == "chain":
            low, high = np.unique(np.stack([low, high]), axis=1)
            only = (np.bincount(low, minlength=len(known))[low] == 1) & (np.bincount(high, minlength=len(known))[high] == 1)
            low, high = low[only], high[only]
        return out.append_column("body", pa.array(base + known[labelled(len(known), low, high)[flat]][place]))

    fields = [(c, "long") for c in (("component",) if kind == "flat" else ("component", "body"))]
    return by_group(occupied.select(*CELL), ["m"], label, [*occupied.select(*CELL).schema.fields, *fields])


def components(occupied: DataFrame, side: int, vertical: bool = False, own: bool = False) -> DataFrame:
    """The cells with component: the least cell number reachable through shared sides, with vertical also up and down; with own, numbers within the model."""
    if not vertical:
        return bodies(occupied, side, "flat", own)
    return bodies(occupied, side, "vertical", own).select(*CELL, F.col("body").alias("component"))


def cell_area(cell: Column, i: Column, j: Column, size_x: Column, size_z: Column) -> Column:
    """The area of a cell of a grid that begins at the lower corner of a box, cut at the box's upper sides; never below 0."""
    side = lambda n, size: F.greatest(F.lit(0.0), F.least(cell, size - (n - 1) * cell))
    return side(i, size_x) * side(j, size_z)


def chains(occupied: DataFrame, side: int) -> DataFrame:
    """m, component, k, cells, chain: the floor components, with the least component of the unbranched run of floors they are in (see bodies)."""
    return bodies(occupied, side, "chain").groupBy("m", "component", "k", F.col("body").alias("chain")).agg(F.count("*").alias("cells")).select("m", "component", "k", "cells", "chain")


def holes(occupied: DataFrame, side: int, own: bool = False) -> DataFrame:
    """m, k, i, j, component, outside of the empty cells of every floor that has a cell: outside where their component reaches the border; with own, component
    is a number within the model. One shuffle."""
    kinds = occupied.select(*CELL).schema

    def label(model: pa.Table) -> pa.Table:
        k, i, j = (model.column(c).to_numpy().astype(np.int64) for c in "kij")
        checked(k, i, j, side)
        floors, row = np.unique(k, return_inverse=True)
        empty = np.ones((len(floors), side * side), bool)
        empty[row, (i - 1) * side + j - 1] = False
        row, at = np.nonzero(empty)
        number = floors[row] * side * side + at
        found = _flat(number, side)
        i, j = at // side, at % side
        outside = np.zeros(len(number), bool)
        outside[found[(i == 0) | (i == side - 1) | (j == 0) | (j == side - 1)]] = True
        m = model.column("m")[0].as_py()
        columns = [pa.array(np.full(len(at), m)), pa.array(floors[row]), pa.array(i + 1), pa.array(j + 1), pa.array(number[found] + m * (0 if own else PER_MODEL)), pa.array(outside[found])]
        return pa.table(columns, names=[*CELL, "component", "outside"])

    return by_group(occupied.select(*CELL), ["m"], label, [*kinds.fields, ("component", "long"), ("outside", "boolean")])


@dataclass(frozen=True)
class CleanParams:
    """dominant: least share of the largest body where there are several. island_cells, island_area: bounds of what is
    removed. hole_cells, hole_area, hole_share: bounds of what is filled, each and together, against the whole."""

    dominant: float = GridMassing.min_dominant_area
    island_cells: int = GridMassing.max_island_cells
    island_area: float = GridMassing.max_island_area
    hole_cells: int = GridMassing.max_hole_cells
    hole_area: float = GridMassing.max_hole_area
    hole_share: float = GridMassing.max_hole_fraction


def cleaned(occupied: DataFrame, side: int, cell: float | None = None, size_x: float | None = None, size_z: float | None = None, params: CleanParams = CleanParams(), sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(floors, cells): small islands removed and small holes filled, or a reason why a floor is ambiguous.

    floors: m, k, bodies, area, dominant, islands, island_area, holes, hole_area, reason (null where the floor is clean). cells: those
    of the clean floors. Of bodies of equal area the one with the least component is the dominant one. The size of a cell and of the
    envelope are numbers, or those of each model in sizes (m, cell, size_x, size_z).
    """
    p = params

    def measured(df: DataFrame) -> DataFrame:
        if sizes is None:
            return df.withColumn("a", cell_area(F.lit(cell), F.col("i"), F.col("j"), F.lit(size_x), F.lit(size_z)))
        area = cell_area(F.col("cell"), F.col("i"), F.col("j"), F.col("size_x"), F.col("size_z"))
        return df.join(sizes.select("m", "cell", "size_x", "size_z"), "m").withColumn("a", area).drop("cell", "size_x", "size_z")

    # written, as both results rest on them and a grid's labels are dear; components count within their model, which may be a body with a large number
    solid = stored(measured(components(occupied, side, own=True)), "solid")
    bodies = solid.groupBy("m", "k", "component").agg(F.count("*").alias("n"), F.sum("a").alias("area"), F.min("a").alias("least"))
    floor = W.partitionBy("m", "k")
    bodies = bodies.withColumns({"rank": F.row_number().over(floor.orderBy(F.desc("area"), "component"))})
    isle = F.col("rank") > 1
    stats = bodies.groupBy("m", "k").agg(
        F.count("*").alias("bodies"), F.sum("area").alias("area"), (F.max("area") / F.sum("area")).alias("dominant"), F.count_if(isle).alias("islands"), F.coalesce(F.sum(F.when(isle, F.col("area"))), F.lit(0.0)).alias("island_area"),
        F.max(isle & ((F.col("n") > p.island_cells) | (F.col("area") > p.island_area))).alias("big"), F.min("least").alias("least"),
    )
    kept = solid.join(bodies.filter(~isle).select("m", "k", "component"), ["m", "k", "component"], "left_semi").select(*CELL)
    inner = stored(measured(holes(kept, side, own=True).filter("NOT outside")), "inner")
    each = inner.groupBy("m", "k", "component").agg(F.count("*").alias("n"), F.sum("a").alias("area"))
    gaps = each.groupBy("m", "k").agg(F.count("*").alias("holes"), F.sum("area").alias("hole_area"), F.max((F.col("n") > p.hole_cells) | (F.col("area") > p.hole_area)).alias("yard"))
    stats = stats.join(gaps, ["m", "k"], "left").withColumns({"holes": F.coalesce("holes", F.lit(0).cast("long")), "hole_area": F.coalesce("hole_area", F.lit(0.0))})
    reason = (
        F.when(F.col("least") <= 0, "occupied cells outside source envelope").when((F.col("bodies") > 1) & (F.col("dominant") < p.dominant), "substantial disconnected floor bodies")
        .when(F.col("big"), "detached floor body exceeds fragment bounds").when(F.col("yard"), "courtyard exceeds small-hole bounds").when(F.col("hole_area") > F.col("area") * p.hole_share, "too much enclosed empty area")
    )
    stats = stats.withColumn("reason", reason).drop("big", "yard", "least")
    clean = kept.unionByName(inner.select(*CELL)).join(stats.filter("reason IS NULL").select("m", "k"), ["m", "k"], "left_semi")
    return stats, clean


def audited(occupied: DataFrame, models: DataFrame, side: int, share: float = Incomplete.max_envelope_fraction, least_body: float = Incomplete.max_largest_body_area, tall: float = Incomplete.min_source_height_for_tiny_body) -> DataFrame:
    """models (m, cell, size_x, size_y, size_z, floors) with what their floors hold and why they look incomplete.

    Adds occupied, largest_body and complete (the largest values over the floors: area in all, of one body, and of floors of
    one body), empty_floors, disconnected_floors, and reasons: every floor covers at most `share` of the envelope; or no body
    reaches least_body in a model of at least `tall`.
    """
    found = components(occupied, side).join(models, "m")
    area = cell_area(F.col("cell"), F.col("i"), F.col("j"), F.col("size_x"), F.col("size_z"))
    bodies = found.groupBy("m", "k", "component").agg(F.sum(area).alias("body"))
    floors = bodies.groupBy("m", "k").agg(F.sum("body").alias("area"), F.max("body").alias("body"), F.count("*").alias("n"))
    sums = floors.groupBy("m").agg(F.max("area").alias("occupied"), F.max("body").alias("largest_body"), F.max(F.when(F.col("n") == 1, F.col("area"))).alias("complete"), F.count("*").alias("__some"), F.count_if(F.col("n") > 1).alias("disconnected_floors"))
    rows = models.join(sums, "m", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("occupied", "largest_body", "complete")})
    rows = rows.withColumns({"empty_floors": F.col("floors") - F.coalesce("__some", F.lit(0)), "disconnected_floors": F.coalesce("disconnected_floors", F.lit(0).cast("long"))})
    envelope = F.col("size_x") * F.col("size_z")
    sparse = (F.col("occupied") <= envelope * share) & (F.col("complete") <= envelope * share)
    tiny = (F.col("largest_body") < least_body) & (F.col("size_y") >= tall)
    return rows.withColumn("reasons", F.array_compact(F.array(F.when(sparse, "sparse floors"), F.when(tiny, "tiny bodies")))).drop("__some")


def floor_jaccard(occupied: DataFrame) -> DataFrame:
    """m, a, b, jaccard of the floors a < b of a model that share a cell place.

    The floors of a place are gathered and paired: at most one row per cell and higher floor of its model, and no join of cells.
    """
    size = occupied.groupBy("m", "k").agg(F.count("*").alias("n"))
    places = occupied.groupBy("m", "i", "j").agg(F.collect_list("k").alias("ks"))
    pairs = places.select("m", "ks", F.explode("ks").alias("a")).select("m", "a", F.explode(F.filter("ks", lambda b: b > F.col("a"))).alias("b"))
    common = pairs.groupBy("m", "a", "b").agg(F.count("*").alias("c"))
    for x in "ab":
        common = common.join(size.select("m", F.col("k").alias(x), F.col("n").alias(f"n{x}")), ["m", x])
    return common.select("m", "a", "b", (F.col("c") / (F.col("na") + F.col("nb") - F.col("c"))).alias("jaccard"))


def difference(source: DataFrame, taken: DataFrame) -> DataFrame:
    """The cells of source that taken has not."""
    return source.select(*CELL).join(taken.select(*CELL), CELL, "left_anti")


def lines(occupied: DataFrame, tight: DataFrame | None = None) -> DataFrame:
    """The cells of each slab line: those of its floor and of the floor below, of which tight, where it is given, has those that reach the ceiling."""
    below = (occupied if tight is None else tight).select("m", (F.col("k") + 1).alias("k"), "i", "j")
    return occupied.select(*CELL).unionByName(below).distinct()


#: Fixed value: what a step to the next row adds to a place, i and j in one number.
ROW = 1 << 32


def places(occupied: DataFrame) -> DataFrame:
    """m, k, own: each floor's cells as an array of places (i * ROW + j), each once. Dealt by floor, so that a floor, which is bounded, is put together alone in memory."""
    place = F.col("i").cast("long") * ROW + F.col("j")
    return occupied.select("m", "k", place.alias("own")).repartition("m", "k").groupBy("m", "k").agg(F.collect_set("own").alias("own"))


def of_place(place: Column) -> tuple[Column, Column]:
    """(i, j) of a place, j not below 0."""
    return F.shiftright(place, 32).cast("int"), place.bitwiseAND(F.lit(ROW - 1)).cast("int")


def boundary(occupied: DataFrame) -> DataFrame:
    """m, k, axis, i, j: unit edges with one cell only; axis 0 lies before row i, axis 1 before column j."""
    # an edge before a cell that is not after another, or the other way round
    after = lambda step: F.transform("own", lambda p: p + step)
    alone = lambda step: F.concat(F.array_except("own", after(step)), F.array_except(after(step), "own"))
    edges = places(occupied).select("m", "k", F.explode(F.array(*(F.struct(F.lit(axis).alias("axis"), alone(step).alias("at")) for axis, step in ((0, ROW), (1, 1))))).alias("e"))
    i, j = of_place(F.col("p"))
    return edges.select("m", "k", "e.axis", F.explode("e.at").alias("p")).select("m", "k", "axis", i.alias("i"), j.alias("j"))


def leading(df: DataFrame, keys: list[str], order: str, flag: str) -> DataFrame:
    """keys, span: number of rows along order before the first whose flag is not true."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    held = F.min(F.coalesce(F.col(flag), F.lit(False)).cast("int")).over(w)
    return df.withColumn("__held", held).groupBy(*keys).agg(F.sum("__held").cast("long").alias("span"))


def bridged(df: DataFrame, keys: list[str], order: str, group: str) -> DataFrame:
    """df with group replaced by that of both neighbours, the rows whose order is one less and one more, where these agree; neighbours count as they were."""
    w = W.partitionBy(*keys).orderBy(order)
    beside = lambda f, off: F.when(f(order).over(w) == F.col(order) + off, f(group).over(w))
    before, after = beside(F.lag, -1), beside(F.lead, 1)
    return df.withColumn(group, F.when(before == after, before).otherwise(F.col(group)))


def to_masks(occupied: DataFrame, side: int) -> DataFrame:
    """m, k, mask: the cells of each floor as a text of side * side characters, 1 where there is one."""
    at = F.collect_set((F.col("i") - 1) * side + F.col("j")).alias("at")
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(side * side)), lambda n: F.when(F.array_contains("at", n.cast("int")), "1").otherwise("0")), "")
    rows = occupied.select("m", "k", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"))
    return rows.groupBy("m", "k").agg(at).select("m", "k", text.alias("mask"))


def from_masks(masks: DataFrame, side: int, mask: str = "mask") -> DataFrame:
    """The cells of masks; a mask of another length, or with another character, gives none."""
    good = masks.filter((F.length(mask) == side * side) & ~F.col(mask).rlike("[^01]"))
    number = F.posexplode(F.split(mask, "")).alias("at", "c")
    rows = good.select("m", "k", number).filter("c = '1'")
    return rows.select("m", "k", (F.floor(F.col("at") / side) + 1).cast("int").alias("i"), (F.col("at") % side + 1).cast("int").alias("j"))


def reused(masks: DataFrame, measure, mask: str = "mask") -> DataFrame:
    """masks with what measure (from a frame of distinct masks, to that frame with more columns) finds: each mask is measured once."""
    return masks.join(measure(masks.select(mask).distinct()), mask)


def rectangles(occupied: DataFrame, side: int) -> DataFrame:
    """m, k, n, i0, i1, j0, j1: rectangles that cover the cells of each floor without overlap, the largest that is left first.
    Of equal ones that whose lower right corner comes first by rows, then the widest."""

    def cut(floor: pa.Table) -> list[dict]:
        i, j = (floor.column(c).to_numpy().astype(np.int64) - 1 for c in "ij")
        checked(np.zeros(1, np.int64), i + 1, j + 1, side)
        grid = np.zeros((side, side), bool)
        grid[i, j] = True
        out = []
        while grid.any():
            a, b, c, d = largest_rectangle(grid)
            grid[a : b + 1, c : d + 1] = False
            out.append({"n": len(out) + 1, "i0": a + 1, "i1": b + 1, "j0": c + 1, "j1": d + 1})
        return out

    return by_sorted_group(occupied.select(*CELL), ["m", "k"], cut, [(c, "int") for c in ("n", "i0", "i1", "j0", "j1")])


def largest_rectangle(grid: np.ndarray) -> tuple[int, int, int, int]:
    """(first row, last row, first column, last column) of the largest rectangle of true cells; heights of columns are kept as
    rows go by, and each stretch that is as high as its lowest column is met once, where a lower column ends it."""
    best, end, found = 0, 0, (0, 0, 0, 0)
    height = [0] * grid.shape[1]
    for i, row in enumerate(grid.tolist()):
        height = [h + 1 if c else 0 for h, c in zip(height, row)]
        open_: list[tuple[int, int]] = []
        for e, h in enumerate([*height, 0]):
            s = e
            while open_ and open_[-1][1] >= h:
                s, k = open_.pop()
                area = k * (e - s)
                # of those that end at one column the wider comes later
                if area > best or (area == best and (found[1], end) == (i, e)):
                    best, end, found = area, e, (i - k + 1, i, s, e - 1)
            if h:
                open_.append((s, h))
    return found


def loops(occupied: DataFrame, side: int) -> DataFrame:
    """m, k, loop, corners (array of struct<x, z>, at cell borders), area: the borders of each floor, with the cells on the left, so
    that the area of what encloses cells is positive, of a hole negative. Where two cells meet at a corner only, the
    border turns so that they stay apart."""

    def walk(floor: pa.Table) -> pa.Table:
        i, j = (floor.column(c).to_numpy().astype(np.int64) for c in "ij")
        checked(np.zeros(1, np.int64), i, j, side)
        grid = np.zeros((side + 2, side + 2), bool)
        grid[i, j] = True
        after: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for x, z in zip(i.tolist(), j.tolist()):
            for (nx, nz), a, b in (((x, z - 1), (x - 1, z - 1), (x, z - 1)), ((x + 1, z), (x, z - 1), (x, z)), ((x, z + 1), (x, z), (x - 1, z)), ((x - 1, z), (x - 1, z), (x - 1, z - 1))):
                if not grid[nx, nz]:
                    after.setdefault(a, []).append(b)
        found = []
        while after:
            first = at = min(after)
            ring, came = [first], None
            while True:
                ends = after[at]
                # the leftmost way on keeps the same cell at the left
                turn = lambda b: (came[0] * (b[1] - at[1]) - came[1] * (b[0] - at[0])) if came else 0
                to = max(ends, key=turn) if came else ends[0]
                ends.remove(to)
                if not ends:
                    del after[at]
                came, at = (to[0] - at[0], to[1] - at[1]), to
                if at == first and (first not in after or len(ring) >= 4):
                    break
                ring.append(at)
            v = np.array(ring, np.float64)
            w = np.roll(v, -1, axis=0)
            u = np.roll(v, 1, axis=0)
            bend = ((v - u)[:, 0] * (w - v)[:, 1] - (v - u)[:, 1] * (w - v)[:, 0]) != 0
            found.append((v[bend], float((v[:, 0] * w[:, 1] - w[:, 0] * v[:, 1]).sum() / 2), len(ring)))
        one = floor.slice(0, 1).select(["m", "k"])
        head = [pa.concat_arrays([one.column(c).combine_chunks()] * len(found)) for c in "mk"]
        corners = pa.array([[{"x": x, "z": z} for x, z in ring.tolist()] for ring, *_ in found], pa.list_(pa.struct([("x", pa.float64()), ("z", pa.float64())])))
        return pa.table([*head, pa.array(np.arange(1, len(found) + 1, dtype=np.int32)), corners, pa.array([a for _, a, _ in found]), pa.array([n for *_, n in found], pa.int32())], names=["m", "k", "loop", "corners", "area", "edges"])

    fields = [*occupied.select("m", "k").schema.fields, ("loop", "int"), ("corners", "array<struct<x:double,z:double>>"), ("area", "double"), ("edges", "int")]
    return by_group(occupied.select(*CELL), ["m", "k"], walk, fields)
