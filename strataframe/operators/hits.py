"""Hits against solids: capsules, rays through surfaces, and what is left lying about.

Solids are axis-aligned boxes with lo and hi (struct<x, y, z>) that belong to buildings. A hit has a start and an end. Both
joins meet on the cells of a grid over x and z that the hit's box and the building's box (both widened by the reach)
touch, so that no task compares all hits with all buildings; what passes the broad test meets the parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.functions import motion
from strataframe.operators.rings import spread
from strataframe.storage import stored, tasks

C = F.col


def _flat(v: Column, name: str) -> list[Column]:
    return [v[a].cast("double").alias(f"{name}{a}") for a in motion.AXES]


def near_pairs(hits: DataFrame, buildings: DataFrame, reach: Column, cell: float) -> tuple[DataFrame, int]:
    """(hit, sx, sy, sz, ex, ey, ez, and the columns of buildings with lo and hi as lx to hz) whose boxes come within reach (of the building's columns) of each
    other, each pair once: in the cell of the lower corner of what the two share; and the number of tasks.

    Both are dealt by cell and sorted: a small file of keys can hold millions of buildings, so none are broadcast. Hits are written, so that what they are made
    of is computed once, and coordinates are columns of their own: the join's condition stays small enough to be compiled."""
    flat = stored(hits.select("hit", *_flat(C("start"), "s"), *_flat(C("end"), "e")), "hits")
    n = tasks(flat)
    low, high = (lambda v: F.least(f"s{v}", f"e{v}")), (lambda v: F.greatest(f"s{v}", f"e{v}"))
    a = spread(flat, low("x"), high("x"), low("z"), high("z"), cell)
    wide = buildings.select(*(c for c in buildings.columns if c not in ("lo", "hi")), *_flat(C("lo"), "l"), *_flat(C("hi"), "h"), reach.alias("__r"))
    b = spread(wide, C("lx") - C("__r"), C("hx") + C("__r"), C("lz") - C("__r"), C("hz") + C("__r"), cell)
    first = (C("gx") == F.floor(F.greatest(low("x"), C("lx") - C("__r")) / cell)) & (C("gz") == F.floor(F.greatest(low("z"), C("lz") - C("__r")) / cell))
    for v in motion.AXES:  # the boxes themselves, on three axes, before anything dearer
        first &= (low(v) <= C(f"h{v}") + C("__r")) & (high(v) >= C(f"l{v}") - C("__r"))
    a, b = (rows.repartition(n, "gx", "gz") for rows in (a, b))
    return a.join(b.hint("merge"), ["gx", "gz"]).filter(first).drop("gx", "gz", "__r"), n


def _computed(rows: DataFrame, names: list[str], kernel: Callable[[Callable[[str], np.ndarray]], tuple[np.ndarray, dict[str, np.ndarray]]]) -> DataFrame:
    """The rows that kernel keeps, with the doubles names that it computes: from the columns of a batch as arrays, NaN for null, what is kept and the new ones."""
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(all="ignore"):
                keep, made = kernel(lambda c: batch.column(c).to_numpy(zero_copy_only=False))
            out = pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(made[c]) for c in names)], names=[*batch.schema.names, *names])
            yield out.filter(pa.array(keep))

    return rows.mapInArrow(run, schema)


def within_own(rows: DataFrame) -> DataFrame:
    """The rows whose point (px, py, pz) lies within own of their segment (sx to ez), with its distance; a segment shorter than about 0.03 is its first end."""

    def kernel(col: Callable[[str], np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        start, end, at = ([col(f"{k}{a}") for a in motion.AXES] for k in "sep")
        ab, ap = [e - s for s, e in zip(start, end)], [p - s for s, p in zip(start, at)]
        dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
        n = dot(ab, ab)
        t = np.where(n < 0.001, 0.0, np.clip(dot(ap, ab) / n, 0.0, 1.0))
        off = [p - d * t for p, d in zip(ap, ab)]
        distance = np.sqrt(dot(off, off))
        return distance <= col("own"), {"distance": distance}

    return _computed(rows, ["distance"], kernel)


def capsule_hits(hits: DataFrame, buildings: DataFrame, parts: DataFrame, radius: float, cell: float) -> DataFrame:
    """(hit, part, distance): the parts whose middle lies within radius and half their diagonal of a hit's segment, in
    buildings whose middle does so too. hits: hit, start, end. buildings: building, lo, hi. parts: part, building, at, size."""
    own = radius + motion.length(motion.mapped(lambda p, q: q - p, C("lo"), C("hi"))) / 2
    # of a building its middle counts, so the box that a hit must come near is that point's
    points = buildings.select("building", own.alias("own"), motion.between(C("lo"), C("hi"), F.lit(0.5)).alias("lo")).withColumn("hi", C("lo"))
    near, n = near_pairs(hits, points, C("own"), cell)
    ends = [f"{k}{a}" for k in "se" for a in motion.AXES]
    near = within_own(near.select("hit", "building", *ends, *(C(f"l{a}").alias(f"p{a}") for a in motion.AXES), "own")).select("hit", "building", *ends)
    parts = parts.select("part", "building", *_flat(C("at"), "p"), (radius + motion.length(C("size")) / 2).alias("own"))
    met = near.repartition(n, "building").join(parts.repartition(n, "building").hint("merge"), "building")
    for v in motion.AXES:
        met = met.filter((F.least(f"s{v}", f"e{v}") - C("own") <= C(f"p{v}")) & (F.greatest(f"s{v}", f"e{v}") + C("own") >= C(f"p{v}")))
    return within_own(met.select("hit", "part", *ends, *(f"p{a}" for a in motion.AXES), "own")).select("hit", "part", "distance")


def surface_hits(hits: DataFrame, boxes: DataFrame, cell: float, most: int = 20, step: float = 1.0) -> DataFrame:
    """(hit, n, t): where a segment goes through surfaces of boxes (building, lo, hi), in order, as distances from its start.

    Only what faces the segment counts: where it enters a box from outside. After each the search goes on `step` further, so that
    nearer surfaces are passed over; at most `most` are found, and none once no more than step is left. Segments shorter
    than step have none. The surfaces on one segment are ordered in memory.
    """
    near, _ = near_pairs(hits, boxes, F.lit(0.0), cell)

    def entered(col: Callable[[str], np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        start, end, low, high = ([col(f"{k}{a}") for a in motion.AXES] for k in "selh")
        way = [e - s for s, e in zip(start, end)]
        length = np.sqrt(way[0] * way[0] + way[1] * way[1] + way[2] * way[2])
        t, u, inside = np.zeros(len(length)), length, np.ones(len(length), bool)
        for s, w, a, b in zip(start, way, low, high):
            d = w / length
            level, held = d == 0, (s >= a) & (s <= b)
            ends = (a - s) / d, (b - s) / d
            t = np.where(level, np.where(held, t, np.inf), np.maximum(t, np.minimum(*ends)))
            u = np.where(level, u, np.minimum(u, np.maximum(*ends)))
            inside &= held
        return (length >= step) & (t <= u) & ~inside, {"length": length, "t": t}

    found = _computed(near, ["length", "t"], entered).groupBy("hit", "length").agg(F.array_sort(F.collect_list("t")).alias("all"))
    none = F.array().cast("array<double>")
    take = lambda acc, t: F.when((F.size(acc) < most) & ((F.size(acc) == 0) | ((t >= F.element_at(F.concat(acc, F.array(F.lit(0.0))), F.greatest(F.size(acc), F.lit(1))) + step) & (C("length") - F.element_at(F.concat(acc, F.array(F.lit(0.0))), F.greatest(F.size(acc), F.lit(1))) - step > step))), F.array_append(acc, t)).otherwise(acc)
    return found.select("hit", F.posexplode(F.aggregate("all", none, take)).alias("n", "t")).withColumn("n", C("n") + 1)


def trail_ground(pieces: DataFrame, by: list[str]) -> DataFrame:
    """by, ground: the lowest bottom of a trail's pieces (at, size); 0 where none has one."""
    return pieces.groupBy(*by).agg(F.coalesce(F.min(C("at.y") - C("size.y") / 2), F.lit(0.0)).alias("ground"))


def isolated_high(pieces: DataFrame, by: list[str], key: str, drop: float = 3.5, shrink: float = 0.75, cell: float = 8.0) -> DataFrame:
    """The pieces (at, size) whose bottom is more than `drop` above their trail's ground and that overlap no other piece of it,
    when all are shrunk about their middles."""
    low = pieces.join(trail_ground(pieces, by), by).withColumn("high", C("at.y") - C("size.y") / 2 > C("ground") + drop)
    wide = spread(low, C("at.x") - C("size.x") / 2, C("at.x") + C("size.x") / 2, C("at.z") - C("size.z") / 2, C("at.z") + C("size.z") / 2, cell).select(*by, key, "at", "size", "high", "gx", "gz")
    a, b = wide.filter("high").alias("a"), wide.alias("b")
    same = (C("a.gx") == C("b.gx")) & (C("a.gz") == C("b.gz")) & (C(f"a.{key}") != C(f"b.{key}"))
    for c in by:
        same = same & (C(f"a.{c}") == C(f"b.{c}"))
    touched = a.join(b, same & motion.shrunk_overlap(C("a.at"), C("a.size"), C("b.at"), C("b.size"), shrink), "left_semi").select(key).distinct()
    return low.filter("high").join(touched, key, "left_anti").drop("high")
