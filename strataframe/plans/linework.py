"""Registered queries: polygons of linework, slabs of drawn shapes and repaired sections, with equal SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import outline, slabs
from strataframe.functions.geometry import signed_area
from strataframe.functions.outline import OutlineParams
from strataframe.operators import linework, sections
from strataframe.plans.drawn import draw, drawn, table

C = F.col


def _point(x: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), z.cast("double").alias("z"))


def _lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, a, b: lines across each other for each supplier, at drawn places, that reach beyond the outer ones or not; in the first cell a box, loose or
    joined to a line by one segment; in the last cell a segment of which one end is loose, and some lines end in a gap."""
    m = C("m")
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    own = own.select("m", (draw(m, "nx", n=3) + 2).alias("nx"), (draw(m, "nz", n=3) + 2).alias("nz"), (draw(m, "ex", n=3) * 5).alias("ex"), (draw(m, "ez", n=3) * 5).alias("ez"), draw(m, "box", n=3).alias("box"), draw(m, "gap", n=2).alias("gap"))
    x = lambda i: i * 20 + draw(m, "x", i, n=7)
    z = lambda j: j * 20 + draw(m, "z", j, n=7)
    first, last = F.lit(0), lambda n: C(n) - 1
    ends = own.withColumns({"x0": x(first), "x1": x(last("nx")), "z0": z(first), "z1": z(last("nz"))})
    up = ends.withColumn("i", F.explode(F.sequence(F.lit(0), last("nx")))).select("m", _point(x(C("i")), C("z0") - C("ez")).alias("a"), _point(x(C("i")), C("z1") + C("ez")).alias("b"))
    level = ends.withColumn("j", F.explode(F.sequence(F.lit(0), last("nz"))))
    # the first level line of some has a gap of two, which the seam closes
    split = F.when((C("j") == 0) & (C("gap") == 1), F.array(F.struct((C("x0") - C("ex")).alias("s"), (C("x0") + 6).alias("e")), F.struct((C("x0") + 8).alias("s"), (C("x1") + C("ex")).alias("e")))).otherwise(F.array(F.struct((C("x0") - C("ex")).alias("s"), (C("x1") + C("ex")).alias("e"))))
    across = level.withColumn("p", F.explode(split)).select("m", _point(C("p.s"), z(C("j"))).alias("a"), _point(C("p.e"), z(C("j"))).alias("b"))
    bx, bz = C("x0") + 4, C("z0") + 4
    corner = lambda u, v: _point(bx + u, bz + v)
    sides = F.array(*(F.struct(corner(*p).alias("a"), corner(*q).alias("b")) for p, q in (((0, 0), (5, 0)), ((5, 0), (5, 6)), ((5, 6), (0, 6)), ((0, 6), (0, 0)))))
    boxes = ends.filter("box > 0").select("m", F.inline(sides))
    joint = ends.filter("box = 2").select("m", corner(5, 3).alias("a"), _point(x(F.lit(1)), bz + 3).alias("b"))
    spur = ends.select("m", _point(C("x1"), C("z1") - 5).alias("a"), _point(C("x1") - 3, C("z1") - 6).alias("b"))
    return reduce(DataFrame.unionByName, [up, across, boxes, joint, spur])


def noded_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each supplier's lines: faces and their areas, holes, and what encloses nothing."""
    found, figures = linework.polygonised(_lattice(spark, sf_dir), ["m"])
    sums = found.groupBy("m").agg(F.round(F.sum("area"), 4).alias("area"), F.round(F.min("area"), 4).alias("least"), F.round(F.max("area"), 4).alias("most"), F.sum(F.size("holes")).alias("holes"))
    return figures.join(sums, "m").select("m", "segments", "closed", "seam_count", *(F.round(c, 4).alias(c) for c in ("seam_length", "cut_length", "dangle_length")), "invalid", "large", "area", "least", "most", "holes")


FACES_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'nx'", 3)} + 2 AS nx, {drawn("s_suppkey, 'nz'", 3)} + 2 AS nz, {drawn("s_suppkey, 'ex'", 3)} * 5 AS ex, {drawn("s_suppkey, 'ez'", 3)} * 5 AS ez, {drawn("s_suppkey, 'box'", 3)} AS box, {drawn("s_suppkey, 'gap'", 2)} AS gap FROM supplier),
xs AS (SELECT m, i, i * 20 + {drawn("m, 'x', i", 7)} AS x FROM (SELECT m, unnest(generate_series(0, nx - 1)) AS i FROM o)),
zs AS (SELECT m, j, j * 20 + {drawn("m, 'z', j", 7)} AS z FROM (SELECT m, unnest(generate_series(0, nz - 1)) AS j FROM o)),
w AS (SELECT m, i, lead(x) OVER (PARTITION BY m ORDER BY i) - x AS w FROM xs), h AS (SELECT m, j, lead(z) OVER (PARTITION BY m ORDER BY j) - z AS h FROM zs),
c AS (SELECT w.m, CAST(w.w * h.h - CASE WHEN i = 0 AND j = 0 AND box > 0 THEN 30 ELSE 0 END AS DOUBLE) AS area FROM w JOIN h ON h.m = w.m JOIN o ON o.m = w.m WHERE w.w IS NOT NULL AND h.h IS NOT NULL UNION ALL SELECT m, 30.0 FROM o WHERE box > 0),
f AS (SELECT m, count(*) AS closed, count(*) FILTER (area >= 150) AS large, sum(area) AS area, min(area) AS least, max(area) AS most FROM c GROUP BY m)
SELECT o.m, CAST(nx + nz + gap + 1 + CASE box WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 5 END AS BIGINT) AS segments, f.closed, CAST(gap AS BIGINT) AS seam_count, 2.0::DOUBLE * gap AS seam_length,
  CASE WHEN box = 2 THEN CAST((SELECT b.x - a.x FROM xs a JOIN xs b ON b.m = a.m AND b.i = 1 WHERE a.m = o.m AND a.i = 0) - 9 AS DOUBLE) ELSE 0.0::DOUBLE END AS cut_length, round(2 * nx * ez + 2 * nz * ex + sqrt(10::DOUBLE), 4) AS dangle_length, CAST(0 AS BIGINT) AS invalid, f.large,
  round(f.area, 4) AS area, round(f.least, 4) AS least, round(f.most, 4) AS most, CAST(CASE WHEN box > 0 THEN 1 ELSE 0 END AS BIGINT) AS holes
FROM o JOIN f ON f.m = o.m
"""

def _stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, ring of each supplier: 5 to 14 vertices around a middle, at drawn distances."""
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    n = draw(C("m"), "n", n=10) + 5
    far = lambda k: draw(C("m"), "far", k, n=900) / 10.0 + 10
    turn = lambda k: (k + draw(C("m"), "turn", k, n=600) / 1000.0) * 2 * F.pi() / C("n")
    rows = own.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), C("n") - 1)))
    at = F.struct("k", (far(C("k")) * F.cos(turn(C("k")))).alias("x"), (far(C("k")) * F.sin(turn(C("k")))).alias("z"))
    return rows.groupBy("m").agg(F.array_sort(F.collect_list(at)).alias("v")).select("m", F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z"))).alias("ring"))


def ear_slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slabs of drawn star shapes: triangles, wedges and their areas."""
    rows = _stars(spark, sf_dir).withColumn("s", slabs.as_slab("ring"))
    area = lambda r: F.abs(signed_area(r))
    wedge = F.aggregate("s.value.pieces", F.lit(0.0), lambda n, p: n + area(p["ring"]))
    right = F.forall("s.value.pieces", lambda p: F.abs((p["ring"][1]["x"] - p["ring"][0]["x"]) * (p["ring"][2]["x"] - p["ring"][0]["x"]) + (p["ring"][1]["z"] - p["ring"][0]["z"]) * (p["ring"][2]["z"] - p["ring"][0]["z"])) < 1e-6)
    return rows.select("m", F.size("ring").alias("vertices"), "s.value.triangles", F.round(area(C("ring")), 4).alias("area"), F.round(wedge, 4).alias("built"), right.alias("right"), (F.size("s.value.pieces") <= 2 * C("s.value.triangles") + 4 * C("s.value.splits")).alias("few"))


STARS_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'n'", 10)} + 5 AS n FROM supplier), k AS (SELECT m, n, unnest(generate_series(0, n - 1)) AS k FROM o),
p AS (SELECT m, n, k, {drawn("m, 'far', k", 900)} / 10.0::DOUBLE + 10 AS r, (k + {drawn("m, 'turn', k", 600)} / 1000.0::DOUBLE) * 2 * pi() / n AS a FROM k),
v AS (SELECT m, n, k, r * cos(a) AS x, r * sin(a) AS z FROM p),
e AS (SELECT p.m, p.n, p.x * q.z - q.x * p.z AS c FROM v p JOIN v q ON q.m = p.m AND q.k = (p.k + 1) % p.n)
SELECT m, CAST(n AS INTEGER) AS vertices, CAST(n - 2 AS INTEGER) AS triangles, round(abs(sum(c)) / 2, 4) AS area, round(abs(sum(c)) / 2, 4) AS built, true AS right, true AS few FROM e GROUP BY m, n
"""

PIECE = 7.0


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, a, b: the outline of a box of each supplier in segments of PIECE; the upper side has a gap of a drawn length, the lower left corner is missing by
    drawn lengths, and some have a spur, a box inside or a box beside."""
    m = C("m")
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    own = own.select("m", (draw(m, "w", n=60) + 30.0).alias("w"), (draw(m, "d", n=60) + 30.0).alias("d"), F.greatest(draw(m, "gap", n=9) - 4, F.lit(0)).cast("double").alias("gap"), *((F.greatest(draw(m, v, n=80) - 30, F.lit(0)) / 10.0).alias(v) for v in ("cx", "cz")), draw(m, "kind", n=8).alias("kind"))
    side = lambda x0, z0, x1, z1: F.struct(*(v.alias(n) for v, n in ((x0, "x0"), (z0, "z0"), (x1, "x1"), (z1, "z1"))))
    zero, w, d = F.lit(0.0), C("w"), C("d")
    sides = F.array(side(C("cx"), zero, w, zero), side(w, zero, w, d), side(w, d, w - 10, d), side(w - 10 - C("gap"), d, zero, d), side(zero, d, zero, C("cz")))
    box = lambda x, z, a, b: F.array(side(x, z, x + a, z), side(x + a, z, x + a, z + b), side(x + a, z + b, x, z + b), side(x, z + b, x, z))
    more = F.when(C("kind") == 0, F.array(side(w, d, w + 5, d + 5))).when(C("kind") == 1, box(F.lit(10.0), F.lit(10.0), F.lit(6.0), F.lit(6.0))).when(C("kind") == 2, box(w + 5, zero, F.lit(9.0), F.lit(9.0))).when(C("kind") == 3, box(w + 5, zero, F.lit(2.0), F.lit(2.0))).otherwise(F.array().cast("array<struct<x0:double,z0:double,x1:double,z1:double>>"))
    lines = own.select("m", F.inline(F.concat(sides, more)))
    n = F.greatest(F.lit(1), F.ceil(F.hypot(C("x1") - C("x0"), C("z1") - C("z0")) / PIECE).cast("int"))
    steps = lines.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), C("n") - 1)))
    at = lambda t: _point(C("x0") + (C("x1") - C("x0")) * t / C("n"), C("z0") + (C("z1") - C("z0")) * t / C("n"))
    return steps.select("m", at(C("k")).alias("a"), at(C("k") + 1).alias("b"))


def mended_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of each supplier's box after its gaps were closed, or why it has none."""
    found = sections.outlines(sections.mended_loops(_gapped(spark, sf_dir), ["m"]), ["m"])
    return found.select("m", F.round("area", 4).alias("area"), "reason", "branches", "open", "seams", "corners")


_O = OutlineParams()
MENDED_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'w'", 60)} + 30 AS w, {drawn("s_suppkey, 'd'", 60)} + 30 AS d, greatest({drawn("s_suppkey, 'gap'", 9)} - 4, 0) AS gap, greatest({drawn("s_suppkey, 'cx'", 80)} - 30, 0) / 10.0::DOUBLE AS cx, greatest({drawn("s_suppkey, 'cz'", 80)} - 30, 0) / 10.0::DOUBLE AS cz,
  {drawn("s_suppkey, 'kind'", 8)} AS kind FROM supplier),
p AS (SELECT *, sqrt(cx * cx + cz * cz) AS away FROM o),
q AS (
  -- a corner within the weld of an end is that end
  SELECT *, kind = 0 AS branched, gap > {_O.weld} AS has_gap, away > {_O.weld} AS has_corner, gap > {_O.weld} AND gap <= {_O.seam} AS seam,
    -- beyond the reach, or too much of the straight run that is left of the side
    away > {_O.weld} AND away < {_O.corner_gap} AND cx <= {_O.corner_reach} AND cz <= {_O.corner_reach} AND cx <= greatest({min(outline.AT_LEAST, _O.corner_reach)}, {outline.OF_RUN} * (w - cx)) AND cz <= greatest({min(outline.AT_LEAST, _O.corner_reach)}, {outline.OF_RUN} * (d - cz)) AS corner FROM p),
r AS (SELECT *, CASE WHEN branched THEN 'branched cross-section' WHEN (has_gap AND NOT seam) OR (has_corner AND NOT corner) THEN 'open cross-section' WHEN kind = 1 THEN '{sections.ALONE[0]}' WHEN kind = 2 AND 81 > least({sections.SECOND}, {sections.SECOND_SHARE} * w * d) THEN '{sections.ALONE[2]}' WHEN kind = 3 AND 4 > least({sections.SECOND}, {sections.SECOND_SHARE} * w * d) THEN '{sections.ALONE[2]}' END AS reason FROM q)
SELECT m, CASE WHEN reason IS NULL THEN round(CASE WHEN least(cx, cz) > {_O.weld} THEN w * d ELSE w * d - cx * cz / 2 END, 4) END AS area, reason, CAST(branched AS INTEGER) AS branches, CAST(CASE WHEN has_gap THEN 2 ELSE 0 END + CASE WHEN has_corner THEN 2 ELSE 0 END + CASE WHEN branched THEN 1 ELSE 0 END AS INTEGER) AS open,
  CAST(seam AND NOT branched AS INTEGER) AS seams, CAST(corner AND NOT branched AS INTEGER) AS corners FROM r
"""

SQL = {noded_faces: FACES_SQL, ear_slabs: STARS_SQL, mended_sections: MENDED_SQL}
