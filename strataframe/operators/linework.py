"""Polygons of loose linework: segments noded on a grid, faces of the planar graph they make, and what encloses nothing.

Everything but the walk along one face's border is joins and windows: a segment meets those of its grid cells; half-edges are
numbered so that the other direction of 2n is 2n + 1, the next one around a face is a neighbour by angle, and faces are the components
of "next". Coordinates are whole steps of the grid from noding on, so that ends are equal or not. Segments have the columns `by` (the
section they are of) and their ends a and b, struct<x, z>; nulls in an end drop a segment, and repeated segments count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.functions import polygons, rings
from strataframe.operators.graph import connected_components
from strataframe.operators.kernels import by_group
from strataframe.operators.rings import spread
from strataframe.storage import restored, stored, tasks

C = F.col
#: Segments that one task is dealt to be noded, with all that they meet.
SEGMENTS = 50_000
NODE = "struct<x:bigint,z:bigint>"


def snapped(segments: DataFrame, by: list[str], grid: float) -> DataFrame:
    """by, a, b: the distinct segments with ends in whole steps, a before b; those that shrink to a place are gone."""
    at = lambda c: F.struct(*(F.round(C(f"{c}.{v}") / grid).cast("long").alias(v) for v in "xz"))
    rows = segments.select(*by, at("a").alias("p"), at("b").alias("q")).filter("p.x IS NOT NULL AND p.z IS NOT NULL AND q.x IS NOT NULL AND q.z IS NOT NULL AND p <> q")
    return rows.select(*by, F.least("p", "q").cast(NODE).alias("a"), F.greatest("p", "q").cast(NODE).alias("b")).distinct()


def _cross(p: Column, q: Column, r: Column) -> Column:
    return (q["x"] - p["x"]) * (r["z"] - p["z"]) - (q["z"] - p["z"]) * (r["x"] - p["x"])


def _apart2(e: Column, a: Column, b: Column) -> Column:
    """Square of the distance of a place to a segment."""
    dx, dz = b["x"] - a["x"], b["z"] - a["z"]
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((e["x"] - a["x"]) * dx + (e["z"] - a["z"]) * dz) / (dx * dx + dz * dz)))
    x, z = e["x"] - a["x"] - t * dx, e["z"] - a["z"] - t * dz
    return x * x + z * z


def noded(edges: DataFrame, by: list[str], cell: int, max_rounds: int = 30) -> DataFrame:
    """edges (by, a, b in whole steps) split where they cross, touch or run along each other, and where an end of one lies within
    half a step of another: in rounds, as a cut moves a segment by up to half a step, until nothing is to be cut. Segments meet by sorting, in tasks whose
    number grows with them."""
    have, path = restored(edges, None, "noded")
    for _ in range(max_rounds):
        n = tasks(have, SEGMENTS)
        rows = have.withColumn("id", F.struct(*by, "a", "b"))
        ends = lambda v: (F.least(C(f"a.{v}"), C(f"b.{v}")), F.greatest(C(f"a.{v}"), C(f"b.{v}")))
        (x0, x1), (z0, z1) = ends("x"), ends("z")
        wide = spread(rows.withColumns({"x0": x0 - 1, "x1": x1 + 1, "z0": z0 - 1, "z1": z1 + 1}), C("x0"), C("x1"), C("z0"), C("z1"), cell).repartition(n, *by, "gx", "gz")
        p, q = wide.alias("p"), wide.hint("merge").alias("q")
        low = lambda v: F.floor(F.greatest(C(f"p.{v}0"), C(f"q.{v}0")) / cell)
        meet = (C("p.gx") == C("q.gx")) & (C("p.gz") == C("q.gz")) & (C("p.id") < C("q.id")) & (low("x") == C("p.gx")) & (low("z") == C("p.gz"))
        meet &= (F.greatest("p.x0", "q.x0") <= F.least("p.x1", "q.x1")) & (F.greatest("p.z0", "q.z0") <= F.least("p.z1", "q.z1"))
        for c in by:
            meet &= C(f"p.{c}") == C(f"q.{c}")
        a, b, c, d = C("p.a"), C("p.b"), C("q.a"), C("q.b")
        s, t, u, v = _cross(c, d, a), _cross(c, d, b), _cross(a, b, c), _cross(a, b, d)
        share = s / F.nullif(s - t, F.lit(0))
        across = F.when((F.signum(s) * F.signum(t) < 0) & (F.signum(u) * F.signum(v) < 0), F.struct(*(F.round(a[w] + share * (b[w] - a[w])).cast("long").alias(w) for w in "xz")))
        cut = lambda own, e, when: F.when(when, F.struct(C(f"{own}.id").alias("id"), e.cast(NODE).alias("e")))
        on = lambda own, e, f, g: cut(own, e, (e != f) & (e != g) & (_apart2(e, f, g) <= 0.25))
        made = F.array_compact(F.array(cut("p", across, across.isNotNull()), cut("q", across, across.isNotNull()), on("p", c, a, b), on("p", d, a, b), on("q", a, c, d), on("q", b, c, d)))
        cuts = p.join(q, meet).select(F.explode(made).alias("c")).select("c.*").filter("e <> id.a AND e <> id.b").repartition(n, "id").distinct()
        cuts = stored(cuts.groupBy("id").agg(F.collect_list("e").alias("es")), "cuts")
        if cuts.isEmpty():
            return have
        along = lambda e: (e["x"] - C("a.x")) * (C("b.x") - C("a.x")) + (e["z"] - C("a.z")) * (C("b.z") - C("a.z"))
        order = F.transform(F.array_sort(F.transform("es", lambda e: F.struct(along(e).alias("t"), e.alias("e")))), lambda w: w["e"])
        pieces = rows.join(cuts.hint("merge"), "id", "left").withColumn("path", F.concat(F.array("a"), F.coalesce(order, F.array().cast(f"array<{NODE}>")), F.array("b")))
        steps = pieces.select(*by, F.explode(F.zip_with(F.slice("path", F.lit(1), F.size("path") - 1), F.slice("path", F.lit(2), F.size("path") - 1), lambda m, n: F.struct(m.alias("m"), n.alias("n")))).alias("s"))
        have, path = restored(steps.filter("s.m <> s.n").select(*by, F.least("s.m", "s.n").alias("a"), F.greatest("s.m", "s.n").alias("b")).repartition(n, *by, "a", "b").distinct(), path, "noded")
    raise RuntimeError(f"noding did not settle in {max_rounds} rounds")


def loose_ends(edges: DataFrame, by: list[str]) -> DataFrame:
    """by, n: the places where one edge ends."""
    ends = edges.select(*by, F.explode(F.array("a", "b")).alias("n"))
    return ends.groupBy(*by, "n").agg(F.count("*").alias("d")).filter("d = 1").drop("d")


def seams(edges: DataFrame, by: list[str], reach: int) -> DataFrame:
    """by, a, b: pairs of loose ends that are each other's nearest (ties: the least place) and at most reach steps apart."""
    ends = stored(loose_ends(edges, by), "loose")
    cell = lambda v: F.floor(C(f"n.{v}") / reach)
    near = ends.withColumn("gx", F.explode(F.sequence(cell("x") - 1, cell("x") + 1))).withColumn("gz", F.explode(F.sequence(cell("z") - 1, cell("z") + 1)))
    other = ends.select(*by, C("n").alias("o"), cell("x").alias("gx"), cell("z").alias("gz"))
    x, z = C("n.x") - C("o.x"), C("n.z") - C("o.z")
    pairs = near.join(other, [*by, "gx", "gz"]).withColumn("d2", x * x + z * z).filter((C("n") != C("o")) & (C("d2") <= reach * reach))
    best = pairs.groupBy(*by, "n").agg(F.min(F.struct("d2", "o"))["o"].alias("o"))
    back = best.select(*by, C("n").alias("o"), C("o").alias("n"))
    return best.join(back, [*by, "n", "o"]).filter("n < o").select(*by, C("n").alias("a"), C("o").alias("b"))


def borders(edges: DataFrame, by: list[str], grid: float) -> DataFrame:
    """by, face, kind, ring, area, length of the noded edges. kind shell: the border of a face, ring counter-clockwise; hole: a ring around what
    a face leaves out, clockwise with a negative area (of a face without a shell, the outside, as well); dangle: an edge that only leads to loose ends; cut: an edge
    that alone joins what it joins. A face's half-edges are walked in one task."""
    numbered = stored(edges.withColumn("e", F.monotonically_increasing_id()), "edges")
    side = lambda k, p, q: F.struct((C("e") * 2 + k).alias("h"), C(p).alias("src"), C(q).alias("dst"))
    halves = numbered.select(*by, F.inline(F.array(side(0, "a", "b"), side(1, "b", "a"))))
    around = W.partitionBy(*by, "src").orderBy(F.atan2(C("dst.z") - C("src.z"), C("dst.x") - C("src.x")))
    last = around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # at the end of a half-edge its face goes on by the edge clockwise from the way back
    turned = halves.withColumn("next", F.coalesce(F.lag("h").over(around), F.last("h").over(last)))
    after = stored(halves.join(turned.select(F.col("h").bitwiseXOR(F.lit(1)).alias("h"), "next"), "h"), "halves")
    face = connected_components(after, "h", "next").select(C("node").alias("h"), C("component").alias("face"))
    rows = after.join(face, "h").select(*by, "face", "h", "next", C("src.x").alias("x"), C("src.z").alias("z"))

    def walk(group: pa.Table) -> pa.Table:
        h, to, x, z = (group.column(c).to_numpy() for c in ("h", "next", "x", "z"))
        order = np.argsort(h)
        after_ = order[np.searchsorted(h[order], to)]
        ring = np.empty(len(h), np.int64)
        at = order[0]
        for k in range(len(h)):
            ring[k], at = at, after_[at]
        h, x, z = h[ring], x[ring].astype(np.float64), z[ring].astype(np.float64)
        _, edge, count = np.unique(h >> 1, return_inverse=True, return_counts=True)
        bridge = count[edge] == 2  # both sides of it are of this face
        length = np.hypot(np.roll(x, -1) - x, np.roll(z, -1) - z) * grid
        out: list[tuple] = []
        real = np.r_[0, np.cumsum(~bridge)]
        first: dict[int, int] = {}
        loops: list[list[int]] = [[]]
        found: list[list[int]] = []
        for k in range(len(h)):
            if not bridge[k]:
                loops[-1].append(k)
            elif edge[k] not in first:
                first[edge[k]] = k
                loops.append([])
            else:
                between = real[k] - real[first[edge[k]] + 1]
                out.append(("dangle" if between in (0, real[-1]) else "cut", None, 0.0, float(length[k])))
                found.append(loops.pop())
        for loop in [*found, *loops]:
            # where the loop comes back to a place it was at, a loop of its own is closed
            stack: list[int] = []
            place: dict[tuple, int] = {}
            for k in loop:
                p = (x[k], z[k])
                if p in place:
                    out.append(shown(stack[place[p] :], x, z, length))
                    for gone in stack[place[p] :]:
                        del place[x[gone], z[gone]]
                    del stack[len(place) :]
                place[p] = len(stack)
                stack.append(k)
            if stack:
                out.append(shown(stack, x, z, length))
        kinds, points, areas, lengths = zip(*out)
        names = [*by, "face"]
        head = [pa.concat_arrays([group.column(c).slice(0, 1).combine_chunks()] * len(out)) for c in names]
        point = pa.struct([("x", pa.float64()), ("z", pa.float64())])
        return pa.table([*head, pa.array(kinds), pa.array(points, pa.list_(point)), pa.array(areas, pa.float64()), pa.array(lengths, pa.float64())], names=[*names, "kind", "ring", "area", "length"])

    def shown(loop: list[int], x: np.ndarray, z: np.ndarray, length: np.ndarray) -> tuple:
        own = np.array(loop)
        px, pz = x[own] * grid, z[own] * grid
        area = float(((px - px[0]) * (np.roll(pz, -1) - pz[0]) - (np.roll(px, -1) - px[0]) * (pz - pz[0])).sum() / 2)
        return ("shell" if area > 0 else "hole", [{"x": a, "z": b} for a, b in zip(px.tolist(), pz.tolist())], area, float(length[own].sum()))

    fields = [*rows.select(*by, "face").schema.fields, ("kind", "string"), ("ring", polygons.RING), ("area", "double"), ("length", "double")]
    return by_group(rows, [*by, "face"], walk, fields)


def faces(parts: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, face, ring, holes (rings), area of each face of borders: the holes that its own border has, and the outer rings of other parts that lie in it and in
    no smaller face."""
    shells = parts.filter("kind = 'shell'").select(*by, "face", "ring", "area")
    rings_ = parts.filter("kind = 'hole'").select(*by, "face", C("ring").alias("hole"), "area")
    own = rings_.join(shells.select(*by, "face"), [*by, "face"], "left_semi").select(*by, "face", "hole", "area")
    outer = rings_.join(shells.select(*by, "face"), [*by, "face"], "left_anti").withColumn("p", C("hole")[0])
    box = rings.bounds(C("ring"))
    wide = shells.withColumn("box", box).withColumnRenamed("face", "around").withColumnRenamed("area", "size")
    wide = spread(wide, C("box.x0"), C("box.x1"), C("box.z0"), C("box.z1"), cell)
    placed = outer.withColumns({g: F.floor(C(f"p.{v}") / cell).cast("long") for g, v in (("gx", "x"), ("gz", "z"))})
    within = C("p.x").between(C("box.x0"), C("box.x1")) & C("p.z").between(C("box.z0"), C("box.z1"))
    strict = rings.contains_point(C("ring"), C("p"), 0.0) & (rings.distance_to_ring(C("ring"), C("p")) > 1e-9)
    held = placed.join(wide, [*by, "gx", "gz"]).filter(within).filter(strict)
    held = held.groupBy(*by, "face").agg(F.min(F.struct("size", "around"))["around"].alias("around"), F.first("hole").alias("hole"), F.first("area").alias("area"))
    # a part's outside may be several rings; all of them lie where its first one does
    given = outer.join(held.select(*by, "face", "around"), [*by, "face"]).select(*by, C("around").alias("face"), "hole", "area")
    holes = own.unionByName(given).groupBy(*by, "face").agg(F.array_sort(F.collect_list("hole")).alias("holes"), F.sum("area").alias("less"))
    rows = shells.join(holes, [*by, "face"], "left")
    return rows.select(*by, "face", "ring", F.coalesce("holes", F.array().cast(f"array<{polygons.RING}>")).alias("holes"), (C("area") + F.coalesce("less", F.lit(0.0))).alias("area"))


def polygonised(segments: DataFrame, by: list[str], grid: float = 0.05, seam: float = 4.0, cell: float = 20.0, large: float = 150.0) -> tuple[DataFrame, DataFrame]:
    """(faces, figures) of each section's segments (by, a, b): noded on the grid, loose ends that are each other's nearest within seam joined (none
    with seam 0), and noded again. figures: by, segments, closed, seam_count, seam_length, cut_length, dangle_length, invalid (rings without area), large
    (faces of that area at least). A section without faces has figures alone, one without segments neither."""
    step = max(1, round(cell / grid))
    edges = noded(snapped(segments, by, grid), by, step)
    added = stored(seams(edges, by, max(1, round(seam / grid))), "seams") if seam else edges.limit(0)
    if seam:
        edges = noded(edges.unionByName(added).distinct(), by, step)
    parts = stored(borders(edges, by, grid), "borders")
    found = stored(faces(parts, by, cell), "faces")
    of = lambda kind: F.coalesce(F.sum(F.when(C("kind") == kind, C("length"))), F.lit(0.0))
    counts = segments.groupBy(*by).agg(F.count("*").alias("segments"))
    bridges = added.groupBy(*by).agg(F.count("*").alias("seam_count"), (F.sum(F.hypot(C("b.x") - C("a.x"), C("b.z") - C("a.z"))) * grid).alias("seam_length"))
    lines = parts.groupBy(*by).agg(of("cut").alias("cut_length"), of("dangle").alias("dangle_length"), F.count_if((C("kind") == "hole") & (C("area") == 0)).alias("invalid"))
    closed = found.groupBy(*by).agg(F.count("*").alias("closed"), F.count_if(C("area") >= large).alias("large"))
    rows = counts.join(bridges, by, "left").join(lines, by, "left").join(closed, by, "left")
    return found, rows.na.fill(0, ["closed", "seam_count", "invalid", "large"]).na.fill(0.0, ["seam_length", "cut_length", "dangle_length"])
