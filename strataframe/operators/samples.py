"""Occupancy grids from meshes: each floor cut near its bottom and its top, cells filled where they lie within both cuts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions import building, motion
from strataframe.operators import meshes, sections
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.masks import MOST_FLOORS
from strataframe.storage import stored

C = F.col
#: Least triangles and width, cells on an axis, least size of a cell, how far a cut is from slab and roof, how far a corner is drawn in, shortest segment; share of floors with so many
#: cells, and mean area of a floor, that a building has at least.
TRIANGLES, WIDTH, AXIS, CELL, OFF, INSET, SHORTEST, FILLED, SOME, AREA = 8, 12.0, 24, 3.0, 0.03, 0.05, 0.001, 0.6, 4, 150.0
REASONS = ("Open facade or tiny fragment", "Too small", "No continuous enclosed interior", "Insufficient usable floor area")


def enclosed(a: np.ndarray, b: np.ndarray, x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """For each point, whether an odd number of the segments a to b (n by 2) is crossed on each of its four sides."""
    out = np.ones(len(x), bool)
    for u, v, p, q in ((0, 1, x, z), (1, 0, z, x)):
        over = (a[None, :, v] > q[:, None]) != (b[None, :, v] > q[:, None])
        rise = np.where(a[:, v] == b[:, v], 1.0, b[:, v] - a[:, v])
        at = a[None, :, u] + (q[:, None] - a[None, :, v]) * ((b[:, u] - a[:, u]) / rise)[None, :]
        after = at > p[:, None]
        out &= ((over & after).sum(axis=1) % 2 == 1) & ((over & ~after).sum(axis=1) % 2 == 1)
    return out


def sampled_models(triangles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(models, floors) of triangles (m, points). models: m, at (the middle), yaw, size, floors, ground, upper, cell, nx, nz, cells (loose ones), reason. floors of the models without reason: m, k, loose, tight: the cells as texts of nx * nz
    characters, row by row; a tight cell lies within the cut near the ceiling too. A model lies along its longest level edge, has whole floors at the usual height, and fewer than MOST_FLOORS of them; what is higher raises an
    error. A cut is one task's."""
    p = building.FloorParams()
    rows = stored(triangles.select("m", "points").filter(~F.exists("points", lambda q: q["x"].isNull() | q["y"].isNull() | q["z"].isNull())), "triangles")
    yaw = meshes.triangle_frame(rows.select("m", *(C("points")[k].alias(c) for k, c in enumerate("abc"))), ["m"])
    edge = lambda v, k: (F.min if k == "lo" else F.max)((F.array_min if k == "lo" else F.array_max)(F.transform("points", lambda q: q[v]))).alias(f"{k}{v}")
    ends = [edge(v, k) for v in "xyz" for k in ("lo", "hi")]
    raw = rows.groupBy("m").agg(F.count("*").alias("n"), *ends).join(yaw, "m")
    centre = motion.vector(*((C(f"lo{v}") + C(f"hi{v}")) / 2 for v in "xyz"))
    frames = stored(raw.select("m", "n", "yaw", centre.alias("c")), "frames")
    local = rows.join(frames, "m").select("m", F.transform("points", lambda q: motion.to_local(q, C("c"), C("yaw"))).alias("points"))
    spans = local.groupBy("m").agg(*ends)
    models = frames.join(spans, "m").withColumns({"size": motion.vector(*(C(f"hi{v}") - C(f"lo{v}") for v in "xyz")), "mid": motion.vector(*((C(f"hi{v}") + C(f"lo{v}")) / 2 for v in "xyz"))})
    small = (F.least("size.x", "size.z") < WIDTH) | (C("size.y") < 2 * p.slab + p.clear)
    why = F.when(C("n") < TRIANGLES, REASONS[0]).when(small, REASONS[1])
    models = models.withColumn("why", why).withColumn("f", building.floor_plan(C("size.y"), F.lit(None).cast("double"))).withColumn("cell", F.greatest(F.lit(CELL), F.greatest("size.x", "size.z") / AXIS))
    models = models.select("m", motion.to_world(C("mid"), C("c"), C("yaw")).alias("at"), "mid", "c", "yaw", "size", "f.floors", "f.ground", "f.upper", "cell", F.ceil(C("size.x") / C("cell") - 1e-9).cast("int").alias("nx"), F.ceil(C("size.z") / C("cell") - 1e-9).cast("int").alias("nz"), "why")
    high = F.when(C("why").isNull() & (C("floors") >= MOST_FLOORS), F.raise_error(F.lit(f"a model has {MOST_FLOORS} floors or more"))).otherwise(C("why"))
    models = stored(models.withColumn("why", high), "models")
    good = models.filter("why IS NULL")
    floors = good.select("m", "size", "ground", "upper", "floors", F.explode(F.sequence(F.lit(1), C("floors"))).alias("k"))
    base = building.line_bottom(C("size.y"), C("ground"), C("upper"), C("k")) + p.slab
    clear = building.clear_of(C("ground"), C("upper"), C("k"))
    cuts = F.array(F.struct(F.lit("loose").alias("layer"), (base + OFF).alias("y")), F.struct(F.lit("tight").alias("layer"), F.least(C("size.y") / 2 - OFF, base + clear + p.slab - OFF).alias("y")))
    cuts = stored(floors.select("m", "k", F.inline(cuts)), "cuts")
    ys = cuts.groupBy("m").agg(F.collect_set("y").alias("ys"))
    placed = local.join(good.select("m", "mid"), "m").join(ys, "m").select("m", "ys", F.transform("points", lambda q: motion.vector(*(q[v] - C(f"mid.{v}") for v in "xyz"))).alias("points"))
    segments = sections.at_heights(placed, C("ys"), SHORTEST).select("m", "y", "a", "b")
    met = segments.join(cuts, ["m", "y"]).join(good.select("m", C("size.x").alias("sx"), C("size.z").alias("sz"), "cell", "nx", "nz"), "m")

    def fill(group: pa.Table) -> list[dict]:
        one = group.slice(0, 1).to_pylist()[0]
        at = lambda c: np.column_stack([group.column(c).combine_chunks().field(v).to_numpy(zero_copy_only=False) for v in "xz"])
        side = lambda n, size: (-size / 2 + np.arange(n) * one["cell"], np.minimum(-size / 2 + (np.arange(n) + 1) * one["cell"], size / 2))
        (x0, x1), (z0, z1) = side(one["nx"], one["sx"]), side(one["nz"], one["sz"])
        inside = np.ones((one["nx"], one["nz"]), bool)
        a, b = at("a"), at("b")
        for x, z in ((x0 + INSET, z0 + INSET), (x1 - INSET, z0 + INSET), (x0 + INSET, z1 - INSET), (x1 - INSET, z1 - INSET), ((x0 + x1) / 2, (z0 + z1) / 2)):
            inside &= enclosed(a, b, np.repeat(x, len(z)), np.tile(z, len(x))).reshape(inside.shape)
        return [{"mask": "".join(np.where(inside, "1", "0").ravel().tolist())}]

    masks = by_sorted_group(met.select("m", "k", "layer", "a", "b", "sx", "sz", "cell", "nx", "nz"), ["m", "k", "layer"], fill, [("mask", "string")])
    layer = lambda name: F.max(F.when(C("layer") == name, C("mask"))).alias(name)
    both = floors.select("m", "k").join(masks.groupBy("m", "k").agg(layer("loose"), layer("tight")), ["m", "k"], "left").join(good.select("m", "nx", "nz"), "m")
    none = F.repeat(F.lit("0"), C("nx") * C("nz"))
    # what is tight is loose as well
    both = both.withColumns({"loose": F.coalesce("loose", none), "tight": F.coalesce("tight", none)})
    joint = F.array_join(F.zip_with(F.split("loose", ""), F.split("tight", ""), lambda a, b: F.least(a, b)), "")
    both = stored(both.select("m", "k", "loose", joint.alias("tight"), F.regexp_count("loose", F.lit("1")).alias("n")), "floors")
    sums = both.groupBy("m").agg(F.sum("n").cast("long").alias("cells"), F.count_if(C("n") >= SOME).alias("filled"), F.max(F.when(C("k") == 1, C("n"))).alias("first"))
    rows = models.join(sums, "m", "left")
    reason = F.coalesce("why", F.when((C("filled") < F.ceil(C("floors") * FILLED)) | (C("first") == 0), REASONS[2]).when(C("cells") * C("cell") * C("cell") / C("floors") < AREA, REASONS[3]))
    verdicts = stored(rows.select("m", "at", "yaw", "size", "floors", "ground", "upper", "cell", "nx", "nz", "cells", reason.alias("reason")), "verdicts")
    return verdicts, both.join(verdicts.filter("reason IS NULL").select("m"), "m", "left_semi").select("m", "k", "loose", "tight")
