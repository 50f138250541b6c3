"""Registered queries: meshes, polygon kernels, joins of scenes, tracking and plans on the star-schema tables, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe import sinks
from strataframe.functions import motion, polygons, rings, slabs
from strataframe.functions.geometry import signed_area
from strataframe.operators import graph, meshes, scenes, sections
from strataframe.plans.drawn import draw, drawn, table
from strataframe.plans.levels import BOXES
from strataframe.plans.scalars import ELLS, _ells, _view
from strataframe.storage import stored
from strataframe.streaming import tracking

C = F.col
R = 6

#: Faces by customer in 8 meshes; the corners of neighbours round to the same place, or not.
CORNERS = """SELECT c_custkey AS f, c_custkey % 8 AS mesh, j, c_custkey * 3 + j AS id, CAST((c_custkey // 8 + j) % 150 AS DOUBLE) * 9 + CAST(c_custkey % 7 AS DOUBLE) / 200 AS x,
  CAST((c_custkey // 8 + j) // 5 % 17 AS DOUBLE) * 8 AS y, CAST((c_custkey // 8 + j) * 3 % 11 AS DOUBLE) * 8 + CAST(j AS DOUBLE) / 1000 AS z FROM {t}, (SELECT unnest([0, 1, 2]) AS j)"""


def _corners(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    text = CORNERS.replace("//", "div").replace(", (SELECT unnest([0, 1, 2]) AS j)", " LATERAL VIEW explode(array(0, 1, 2)) AS j")
    vertices = _view(spark, sf_dir, text, "customer")
    faces = vertices.select("mesh", "f").distinct().select("mesh", *((C("f") * 3 + k).alias(v) for k, v in enumerate("abc")))
    return vertices.select("mesh", "id", "x", "y", "z"), faces


def weld_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected parts of the meshes after welding, and those with the size of a building."""
    vertices, faces = _corners(spark, sf_dir)
    found = stored(meshes.mesh_components(vertices, faces), "components")
    sized = meshes.scan(vertices, faces, found=found).select("component", F.lit(True).alias("building"))
    parts = found.groupBy("component").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    return parts.join(sized, "component", "left").select(C("component.mesh").alias("mesh"), C("component.id").alias("first"), "n", "last", F.coalesce("building", F.lit(False)).alias("building"))


WELDED_SQL = f"""
WITH RECURSIVE v AS ({CORNERS.format(t="customer")}), k AS (SELECT *, CAST(round(x / 0.05::DOUBLE) AS BIGINT) AS kx, CAST(round(y / 0.05::DOUBLE) AS BIGINT) AS ky, CAST(round(z / 0.05::DOUBLE) AS BIGINT) AS kz FROM v),
w AS (SELECT mesh, id, min(id) OVER (PARTITION BY mesh, kx, ky, kz) AS first FROM k),
e AS (SELECT id AS a, first AS b FROM w WHERE id <> first UNION SELECT id, id - j FROM v WHERE j > 0), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
c(node, component) USING KEY (node) AS (SELECT a, a FROM u GROUP BY a
  UNION SELECT u.b, min(c.component) FROM c JOIN u ON u.a = c.node JOIN recurring.c AS r ON r.node = u.b WHERE c.component < r.component GROUP BY u.b),
b AS (SELECT component, any_value(mesh) AS mesh, count(*) AS n, max(id) AS last, max(x) - min(x) AS w, max(y) - min(y) AS h, max(z) - min(z) AS d FROM c JOIN v ON v.id = c.node GROUP BY component)
SELECT mesh, component AS first, n, last, h >= 25 AND w >= 12 AND d >= 12 AND w < 900 AND d < 900 AS building FROM b
"""


def radius_weld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all customers as points that steps of at most 150 connect, and their middles."""
    points = _view(spark, sf_dir, "SELECT c_custkey AS id, CAST(c_custkey * 37 % 9973 AS DOUBLE) AS x, CAST(c_custkey * 91 % 9967 AS DOUBLE) AS z FROM {t}", "customer")
    return meshes.radius_weld(points, 150.0).groupBy("cluster").agg(F.count("*").alias("n"), *(F.round(F.first(v), 4).alias(v) for v in "xz"))


RADIUS_SQL = """
WITH RECURSIVE p AS (SELECT c_custkey AS id, CAST(c_custkey * 37 % 9973 AS DOUBLE) AS x, CAST(c_custkey * 91 % 9967 AS DOUBLE) AS z FROM customer),
u AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id <> b.id AND abs(a.x - b.x) <= 150 AND pow(a.x - b.x, 2) + pow(a.z - b.z, 2) <= 22500),
c(node, component) USING KEY (node) AS (SELECT id, id FROM p UNION SELECT u.b, min(c.component) FROM c JOIN u ON u.a = c.node JOIN recurring.c AS r ON r.node = u.b WHERE c.component < r.component GROUP BY u.b)
SELECT component AS cluster, count(*) AS n, round(avg(x), 4) AS x, round(avg(z), 4) AS z FROM c JOIN p ON p.id = node GROUP BY component
"""


def tile_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tiles of each supplier against the same tiles in another order, with drawn signs, scaled and moved; up to two of them have changed sizes."""
    m, t = C("s_suppkey"), C("t")
    base = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("t"))
    base = base.select(m, t.alias("id"), *((draw(m, t, v, n=900) / 10.0 + 10).alias(v) for v in ("dx", "dy", "dz", "x", "y", "z")))
    i = C("id")
    sign = lambda v: draw(m, v, "sign", n=2) * 2 - 1
    changed = F.when((i < 2) & (draw(m, i, "change", n=3) == 0), 1.05).otherwise(1.0)
    there = base.select(m, ((i * 2 + draw(m, "turn", n=5)) % 5).alias("id"), (C("dx") * 4 * changed).alias("dx"), (C("dy") * 4).alias("dy"), (C("dz") * 4).alias("dz"), *((C(v) * sign(v) * 4 + draw(m, v, "offset", n=1000)).alias(v) for v in "xyz"))
    found = meshes.aligned(base, there, ["s_suppkey"])
    return found.select("s_suppkey", "source", "target", F.round("cost", R).alias("cost"), F.round("scale", R).alias("scale"), "intact", "sx", "sy", "sz", *(F.round(c, 4).alias(c) for c in ("ox", "oy", "oz", "error")), "reason")


_TILE = ", ".join(f"{drawn(f"s_suppkey, t, '{v}'", 900)} / 10.0::DOUBLE + 10 AS {v}" for v in ("dx", "dy", "dz", "x", "y", "z"))
_GAPS = ", ".join(f"tb.{v} - ta.{v} * s{v} * scale AS g{v}" for v in "xyz")
ALIGN_SQL = f"""
WITH a AS (SELECT s_suppkey, t AS id, {_TILE} FROM supplier, (SELECT unnest([0, 1, 2, 3, 4]) AS t)),
b AS (SELECT s_suppkey, (id * 2 + {drawn("s_suppkey, 'turn'", 5)}) % 5 AS id, dx * 4 * CASE WHEN id < 2 AND {drawn("s_suppkey, id, 'change'", 3)} = 0 THEN 1.05::DOUBLE ELSE 1 END AS dx, dy * 4 AS dy, dz * 4 AS dz,
  {", ".join(f"{v} * ({drawn(f"s_suppkey, '{v}', 'sign'", 2)} * 2 - 1) * 4 + {drawn(f"s_suppkey, '{v}', 'offset'", 1000)} AS {v}" for v in "xyz")} FROM a),
c AS (SELECT a.s_suppkey, a.id AS i, b.id AS j, b.dx / a.dx AS r0, b.dy / a.dy AS r1, b.dz / a.dz AS r2 FROM a JOIN b ON a.s_suppkey = b.s_suppkey),
e AS (SELECT *, (r0 + r1 + r2) / 3 AS mean FROM c),
f AS (SELECT *, sqrt((pow(r0 - mean, 2) + pow(r1 - mean, 2) + pow(r2 - mean, 2)) / 3) / mean AS cost FROM e),
n AS (SELECT unnest([0, 1, 2, 3, 4]) AS v),
p AS (SELECT row_number() OVER () AS p, [a.v, b.v, c.v, d.v, e.v] AS o FROM n a, n b, n c, n d, n e WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
q AS (SELECT p, unnest([0, 1, 2, 3, 4]) AS i, unnest(o) AS j FROM p),
s AS (SELECT f.s_suppkey, q.p, sum(f.cost) AS total FROM f JOIN q ON q.i = f.i AND q.j = f.j GROUP BY ALL),
w AS (SELECT s_suppkey, arg_min(p, total) AS p FROM s GROUP BY s_suppkey),
g AS (SELECT f.*, cost < 1e-5 AS whole FROM f JOIN w ON w.s_suppkey = f.s_suppkey JOIN q ON q.p = w.p AND q.i = f.i AND q.j = f.j),
h AS (SELECT s_suppkey, quantile_cont(r, 0.5) AS scale FROM (SELECT s_suppkey, unnest([r0, r1, r2]) AS r FROM g) GROUP BY s_suppkey),
k AS (SELECT g.s_suppkey, sx, sy, sz, {_GAPS} FROM g JOIN h ON h.s_suppkey = g.s_suppkey JOIN a ta ON ta.s_suppkey = g.s_suppkey AND ta.id = g.i JOIN b tb ON tb.s_suppkey = g.s_suppkey AND tb.id = g.j,
  (SELECT unnest([-1, 1]) AS sx), (SELECT unnest([-1, 1]) AS sy), (SELECT unnest([-1, 1]) AS sz) WHERE whole),
l AS (SELECT s_suppkey, sx, sy, sz, quantile_cont(gx, 0.5) AS ox, quantile_cont(gy, 0.5) AS oy, quantile_cont(gz, 0.5) AS oz, count(*) AS intact FROM k GROUP BY ALL),
o AS (SELECT l.*, (SELECT max(sqrt(pow(gx - ox, 2) + pow(gy - oy, 2) + pow(gz - oz, 2))) FROM k WHERE k.s_suppkey = l.s_suppkey AND k.sx = l.sx AND k.sy = l.sy AND k.sz = l.sz) AS error FROM l),
z AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY error, sx, sy, sz) AS rk FROM o)
SELECT g.s_suppkey, CAST(g.i AS INTEGER) AS source, CAST(g.j AS INTEGER) AS target, round(g.cost, {R}) AS cost, round(h.scale, {R}) AS scale, CAST(intact AS INTEGER) AS intact, sx, sy, sz, round(ox, 4) AS ox, round(oy, 4) AS oy, round(oz, 4) AS oz, round(error, 4) AS error,
  CASE WHEN intact < 4 THEN 'too few intact tiles' WHEN error >= 0.02 THEN 'the alignment is not exact' END AS reason
FROM g JOIN h ON h.s_suppkey = g.s_suppkey JOIN z ON z.s_suppkey = g.s_suppkey AND rk = 1
"""


def triangle_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn of the longest level edge of each supplier's triangles."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    tilt = F.when(C("l_linenumber") % 2 == 0, 0.05).otherwise(3.0)
    corner = lambda x, y, z: motion.vector(x, y, z)
    rows = lines.select("l_suppkey", corner(F.lit(0), F.lit(0), F.lit(0)).alias("a"), corner(C("l_quantity"), tilt, C("l_partkey") % 31).alias("b"), corner(C("l_quantity") / 2, F.lit(9), F.lit(1)).alias("c"))
    return meshes.triangle_frame(rows, ["l_suppkey"]).select("l_suppkey", F.round("yaw", R).alias("yaw"))


FRAMES_SQL = """
WITH e AS (SELECT l_suppkey, l_quantity AS dx, CAST(l_partkey % 31 AS DOUBLE) AS dz FROM lineitem WHERE l_linenumber % 2 = 0)
SELECT s.l_suppkey, round(coalesce(max(CASE WHEN e.dx IS NOT NULL THEN {'n': sqrt(dx * dx + dz * dz), 'y': -atan2(dz, dx)} END).y, 0), 6) AS yaw FROM (SELECT DISTINCT l_suppkey FROM lineitem) s LEFT JOIN e ON e.l_suppkey = s.l_suppkey GROUP BY s.l_suppkey
"""


def section_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the sections of each mesh at three heights: segments, vertices by degree after welding, and length."""
    vertices, faces = _corners(spark, sf_dir)
    cut = sections.at_heights(sections.triangles(vertices, faces), F.array(*map(F.lit, (20.0, 60.0, 100.0))))
    return sections.degrees(cut, ["mesh", "y"], 0.5).select("mesh", "y", "segments", "loose", "joined", "branching", F.round("length", 4).alias("length"))


_CUT = """CASE WHEN (t[{a}].y <= h) <> (t[{b}].y <= h) THEN struct_pack(x := t[{a}].x + (h - t[{a}].y) / (t[{b}].y - t[{a}].y) * (t[{b}].x - t[{a}].x), z := t[{a}].z + (h - t[{a}].y) / (t[{b}].y - t[{a}].y) * (t[{b}].z - t[{a}].z)) END"""
DEGREES_SQL = f"""
WITH v AS ({CORNERS.format(t="customer")}), t AS (SELECT mesh, f, list(struct_pack(x := x, y := y, z := z) ORDER BY j) AS t FROM v GROUP BY mesh, f),
g AS (SELECT mesh, h, list_filter([{_CUT.format(a=1, b=2)}, {_CUT.format(a=2, b=3)}, {_CUT.format(a=3, b=1)}], lambda p: p IS NOT NULL) AS s FROM t, (SELECT unnest([20.0::DOUBLE, 60.0::DOUBLE, 100.0::DOUBLE]) AS h)),
c AS (SELECT mesh, h, s[1] AS p, s[2] AS q, sqrt(pow(s[1].x - s[2].x, 2) + pow(s[1].z - s[2].z, 2)) AS l FROM g WHERE len(s) = 2),
o AS (SELECT mesh, h, p, l FROM c WHERE l > 1e-5 UNION ALL SELECT mesh, h, q, 0 FROM c WHERE l > 1e-5),
d AS (SELECT mesh, h, CAST(round(p.x / 0.5::DOUBLE) AS BIGINT) AS x, CAST(round(p.z / 0.5::DOUBLE) AS BIGINT) AS z, count(*) AS n, sum(l) AS l FROM o GROUP BY ALL)
SELECT mesh, h AS y, CAST(sum(n) / 2 AS BIGINT) AS segments, count(*) FILTER (n = 1) AS loose, count(*) FILTER (n = 2) AS joined, count(*) FILTER (n > 2) AS branching, round(sum(l), 4) AS length FROM d GROUP BY mesh, h
"""


def section_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with a smaller box in them and one beside, cut to loops: nesting, holes, area, and middle."""
    rows = _ells(spark, sf_dir)
    box = lambda x, z, w, d: rings.box_ring(x, z, x + w, z + d)
    x0, z0, w, d = C("x0"), C("z0"), C("w"), C("d")
    every = F.array(box(x0, z0, w, d), box(x0 + w / 4, z0 + d / 4, w / 2, d / 2), box(x0 + w + 5, z0, w / 3, d))
    segments = rows.select("id", F.explode(every).alias("r")).select("id", F.explode(rings.edges(C("r"))).alias("e")).select("id", C("e.a").alias("a"), C("e.b").alias("b"))
    found = sections.loops(segments, ["id"], weld=0.1)
    return found.filter("reason IS NULL").select("id", "loop", "depth", "hole", F.round("area", R).alias("area"), F.round("centre.x", R).alias("x"), F.round("centre.z", R).alias("z"))


LOOPS_SQL = f"""WITH e AS ({ELLS.format(t="customer")})
SELECT id, 1 AS loop, 0 AS depth, false AS hole, round(w * d, 6) AS area, round(x0 + w / 2, 6) AS x, round(z0 + d / 2, 6) AS z FROM e
UNION ALL SELECT id, 2, 1, true, round(w * d / 4, 6), round(x0 + w / 2, 6), round(z0 + d / 2, 6) FROM e UNION ALL SELECT id, 3, 0, false, round(w / 3 * d, 6), round(x0 + w + 5 + w / 6, 6), round(z0 + d / 2, 6) FROM e"""


def convex_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of each brand's parts as points: vertices and area."""
    points = _view(spark, sf_dir, "SELECT p_brand, CAST(p_partkey * 53 % 421 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM {t}", "part")
    own = points.groupBy("p_brand").agg(F.collect_set(F.struct("x", "z")).alias("points")).withColumn("h", polygons.as_hull("points"))
    return own.select("p_brand", F.size("h.value").alias("n"), F.round(signed_area(C("h.value")), R).alias("area"))


HULL_SQL = """
WITH p AS (SELECT DISTINCT p_brand, CAST(p_partkey * 53 % 421 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM part),
s AS (SELECT a.p_brand, a.x AS ax, a.z AS az, b.x AS bx, b.z AS bz FROM p a JOIN p b ON a.p_brand = b.p_brand AND (a.x <> b.x OR a.z <> b.z)),
h AS (SELECT s.* FROM s JOIN p c ON c.p_brand = s.p_brand GROUP BY ALL
  HAVING bool_and((bx - ax) * (c.z - az) - (bz - az) * (c.x - ax) > 0 OR ((bx - ax) * (c.z - az) - (bz - az) * (c.x - ax) = 0 AND (c.x - ax) * (c.x - bx) + (c.z - az) * (c.z - bz) <= 0)))
SELECT p_brand, CAST(count(*) AS INTEGER) AS n, round(sum(ax * bz - bx * az) / 2, 6) AS area FROM h GROUP BY p_brand
"""


def polygon_slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-shapes, boxes and bow ties as slabs: pieces and their area, or why there are none; and the box of least area around them."""
    rows = _ells(spark, sf_dir)
    box = rings.box_ring(C("x0"), C("z0"), C("x0") + C("w"), C("z0") + C("d"))
    tie = F.array(box[0], box[2], box[1], box[3])
    rows = rows.select("id", F.when(C("id") % 3 == 0, C("ring")).when(C("id") % 3 == 1, F.reverse(box)).otherwise(tie).alias("r"))
    rows = rows.withColumns({"p": slabs.as_slab("r"), "b": polygons.as_box("r")})
    total = F.aggregate(F.coalesce("p.value.pieces", F.array().cast(f"array<struct<kind:string,ring:{polygons.RING}>>")), F.lit(0.0), lambda s, x: s + F.abs(signed_area(x["ring"])))
    return rows.select("id", C("p.reason").alias("reason"), F.round(total, R).alias("area"), F.coalesce("p.value.triangles", F.lit(0)).alias("triangles"), F.round(C("b.value.width") * C("b.value.depth"), R).alias("box"))


SLABS_SQL = f"""WITH e AS ({ELLS.format(t="customer")})
SELECT id, CASE WHEN id % 3 = 2 THEN 'edges cross or touch' END AS reason, round(CASE id % 3 WHEN 0 THEN w * d * 3 / 4 WHEN 1 THEN w * d ELSE 0 END, 6) AS area, CASE id % 3 WHEN 0 THEN 4 ELSE 0 END AS triangles, round(w * d, 6) AS box FROM e WHERE id % 3 < 2
UNION ALL SELECT id, 'edges cross or touch', 0, 0, round(w * d, 6) FROM e WHERE id % 3 = 2"""


def polygon_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each L-shape lies in a window over its upper left half, and its overlap with the box of its right half."""
    rows = _ells(spark, sf_dir)
    x0, z0, w, d = C("x0"), C("z0"), C("w"), C("d")
    window, right = rings.box_ring(x0 - 1, z0 + d / 4, x0 + w / 4, z0 + d + 1), rings.box_ring(x0 + w / 2, z0, x0 + w, z0 + d)
    rows = rows.select("id", polygons.as_clipped("ring", window).alias("c"), polygons.as_overlap("ring", right).alias("o"))
    return rows.select("id", F.round(signed_area(C("c.value")), R).alias("clipped"), F.round("o.value", R).alias("shared"))


CLIPS_SQL = f"""WITH e AS ({ELLS.format(t="customer")}) SELECT id, round(w / 4 * d * 3 / 4, 6) AS clipped, round(w * d / 4, 6) AS shared FROM e"""


def ring_simplified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with a vertex in the middle of each side that is moved out a little, or much, simplified with a tolerance of 0.5; the vertex that the walk begins at stays."""
    rows = _ells(spark, sf_dir)
    x0, z0, w, d, by = C("x0"), C("z0"), C("w"), C("d"), F.when(C("id") % 2 == 0, 0.01).otherwise(2.0)
    p = rings.point
    ring = F.array(p(x0, z0), p(x0 + w / 2, z0 - by), p(x0 + w, z0), p(x0 + w + by, z0 + d / 2), p(x0 + w, z0 + d), p(x0 + w / 2, z0 + d + by), p(x0, z0 + d), p(x0 - by, z0 + d / 2))
    return rows.select("id", F.size(polygons.as_simplified(ring, F.lit(0.5))["value"]).alias("n"))


SIMPLE_SQL = f"""SELECT id, CASE WHEN id % 2 = 0 THEN 5 ELSE 8 END AS n FROM ({ELLS.format(t="customer")})"""


def _boxes(spark: SparkSession, sf_dir: str, name: str = "customer") -> DataFrame:
    return spark.sql(BOXES.format(t="{c}"), c=table(spark, sf_dir, name))


TRACKS = """SELECT s_suppkey AS id, CAST(s_suppkey * 53 % 397 + floor(s_suppkey / 100) * 4000 AS DOUBLE) AS x0, CAST(s_suppkey * 53 % 397 + 20 + s_suppkey % 30 + floor(s_suppkey / 100) * 4000 AS DOUBLE) AS x1, CAST(s_suppkey % 30 AS DOUBLE) AS y0, CAST(s_suppkey % 30 + 25 AS DOUBLE) AS y1,
  CAST(s_suppkey * 29 % 211 AS DOUBLE) AS z0, CAST(s_suppkey * 29 % 211 + 15 AS DOUBLE) AS z1 FROM {t}"""


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, TRACKS, "supplier")
    return rows.withColumn("ring", rings.box_ring(C("x0"), C("z0"), C("x1"), C("z1")))


_TOUCH = "l.x0 {p} <= r.x1 AND r.x0 <= l.x1 {q} AND l.z0 {p} <= r.z1 AND r.z0 <= l.z1 {q} AND l.y0 <= r.y1 AND r.y0 <= l.y1"


def nearby_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many components lie near each track, padded by 12."""
    pairs = scenes.touching(_tracks(spark, sf_dir).drop("ring"), _boxes(spark, sf_dir), cell=64.0, padding=12.0)
    return pairs.groupBy(C("l_id").alias("track")).agg(F.count("*").alias("n"), F.min("r_id").alias("first"))


NEARBY_SQL = f"""WITH l AS ({TRACKS.format(t="supplier")}), r AS ({BOXES.format(t="customer")})
SELECT l.id AS track, count(*) AS n, min(r.id) AS first FROM l JOIN r ON {_TOUCH.format(p="- 12", q="+ 12")} GROUP BY l.id"""


def track_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models bound to tracks by the share of their cells (a grid of 3 by 2 by 3 in each) that a track covers, and whole tracks."""
    models = _boxes(spark, sf_dir)
    part = lambda v, n: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: C(f"{v}0") + (C(f"{v}1") - C(f"{v}0")) * (k + 0.5) / n))
    cells = models.withColumn("x", part("x", 3)).withColumn("y", part("y", 2)).withColumn("z", part("z", 3)).select(C("id").alias("model"), "x", "y", "z")
    bound, whole = scenes.bindings(models, _tracks(spark, sf_dir).drop("ring"), cells, cell=64.0)
    return bound.join(whole.select(C("id").alias("track"), "complete"), "track").select("model", "track", F.round("coverage", R).alias("coverage"), "complete")


_THIRDS = "(SELECT unnest([0.5::DOUBLE, 1.5::DOUBLE, 2.5::DOUBLE]) / 3 AS {n})"
BINDING_SQL = f"""WITH l AS ({BOXES.format(t="customer")}), r AS ({TRACKS.format(t="supplier")}),
p AS (SELECT l.id AS model, r.id AS track, l.x0 AS a0, l.x1 AS a1, l.y0 AS b0, l.y1 AS b1, l.z0 AS c0, l.z1 AS c1, r.* FROM l JOIN r ON {_TOUCH.format(p="", q="")}),
c AS (SELECT model, track, count(*) FILTER (a0 + (a1 - a0) * i BETWEEN x0 AND x1 AND b0 + (b1 - b0) * j BETWEEN y0 AND y1 AND c0 + (c1 - c0) * k BETWEEN z0 AND z1) / count(*) AS coverage
  FROM p, {_THIRDS.format(n="i")}, (SELECT unnest([0.25::DOUBLE, 0.75::DOUBLE]) AS j), {_THIRDS.format(n="k")} GROUP BY ALL)
SELECT model, track, round(coverage, 6) AS coverage, bool_and(coverage >= 0.72::DOUBLE) OVER (PARTITION BY track) AS complete FROM c WHERE coverage >= 0.05::DOUBLE"""


def scene_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that block tracks, tracks that are ambiguous, plans that are crowded, and components where nothing is built yet."""
    models, tracks = _boxes(spark, sf_dir), _tracks(spark, sf_dir)
    kind = lambda df, name, a, b: df.select(F.lit(name).alias("kind"), C(a).alias("a"), (C(b) if b else F.lit(None).cast("long")).alias("b"))
    built = tracks.select((C("id") * 10).alias("key"), ((C("x0") + C("x1")) / 2).alias("x"), C("y0").alias("y"), ((C("z0") + C("z1")) / 2).alias("z"))
    out = kind(scenes.blockers(models, tracks, 64.0), "blocker", "id", None)
    out = out.unionByName(kind(scenes.ambiguous(tracks, 64.0), "ambiguous", "a", "b")).unionByName(kind(scenes.crowded(models, tracks.drop("ring"), 64.0), "crowded", "a", "b"))
    return out.unionByName(kind(scenes.unbuilt(models.withColumn("key", C("id")), built, 64.0), "free", "id", None))


_MID = "({s}.x0 + {s}.x1) / 2 BETWEEN {o}.x0 AND {o}.x1 AND ({s}.z0 + {s}.z1) / 2 BETWEEN {o}.z0 AND {o}.z1"
CONFLICT_SQL = f"""WITH l AS ({BOXES.format(t="customer")}), r AS ({TRACKS.format(t="supplier")}),
p AS (SELECT l.id AS a, r.id AS b, greatest(0, least(l.y1, r.y1) - greatest(l.y0, r.y0)) AS dy, greatest(1, least(l.y1 - l.y0, r.y1 - r.y0)) AS h,
  ({_MID.format(s="r", o="l")}) OR ({_MID.format(s="l", o="r")}) OR ((r.x0 BETWEEN l.x0 AND l.x1 OR r.x1 BETWEEN l.x0 AND l.x1) AND (r.z0 BETWEEN l.z0 AND l.z1 OR r.z1 BETWEEN l.z0 AND l.z1)) AS over_,
  greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) * greatest(0, least(l.z1, r.z1) - greatest(l.z0, r.z0)) AS area, least((l.x1 - l.x0) * (l.z1 - l.z0), (r.x1 - r.x0) * (r.z1 - r.z0)) AS least_ FROM l JOIN r ON {_TOUCH.format(p="", q="")})
SELECT DISTINCT 'blocker' AS kind, a, CAST(NULL AS BIGINT) AS b FROM p WHERE dy > 0 AND dy / h >= 0.2::DOUBLE AND over_
UNION ALL SELECT 'ambiguous', l.id, r.id FROM r AS l JOIN r ON l.id < r.id AND {_TOUCH.format(p="", q="")} AND (({_MID.format(s="r", o="l")}) OR ({_MID.format(s="l", o="r")}) OR (r.x0 BETWEEN l.x0 AND l.x1 AND r.z0 BETWEEN l.z0 AND l.z1) OR (l.x0 BETWEEN r.x0 AND r.x1 AND l.z0 BETWEEN r.z0 AND r.z1))
UNION ALL SELECT 'crowded', a, b FROM p WHERE area > least_ * 0.05::DOUBLE
UNION ALL SELECT 'free', l.id, NULL FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.id * 10 = l.id OR ((r.x0 + r.x1) / 2 BETWEEN l.x0 AND l.x1 AND r.y0 BETWEEN l.y0 AND l.y1 AND (r.z0 + r.z1) / 2 BETWEEN l.z0 AND l.z1))"""


def piece_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of one level that overlap, and the neighbours of boxes within 2."""
    boxes = _boxes(spark, sf_dir).withColumn("level", (C("y0") % 4).cast("int"))
    over = scenes.overlap_areas(boxes, ["level"], 32.0).select("a", "b", F.round("area", R).alias("figure"), F.lit("overlap").alias("kind"))
    near = scenes.neighbours(_boxes(spark, sf_dir), 32.0, 2.0).select(C("id").alias("a"), C("near").alias("b"), F.round("distance", R).alias("figure"), F.lit("near").alias("kind"))
    return over.unionByName(near)


PIECES_SQL = f"""WITH x AS (SELECT *, CAST(y0 AS BIGINT) % 4 AS level FROM ({BOXES.format(t="customer")})),
o AS (SELECT l.id AS a, r.id AS b, greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) * greatest(0, least(l.z1, r.z1) - greatest(l.z0, r.z0)) AS area FROM x l JOIN x r ON l.id < r.id AND l.level = r.level AND {_TOUCH.format(p="", q="")})
SELECT a, b, round(area, 6) AS figure, 'overlap' AS kind FROM o WHERE area > 0
UNION ALL SELECT l.id, r.id, round(sqrt(pow(l.x0 + l.x1 - r.x0 - r.x1, 2) + pow(l.y0 + l.y1 - r.y0 - r.y1, 2) + pow(l.z0 + l.z1 - r.z0 - r.z1, 2)) / 2, 6), 'near' FROM x l JOIN x r ON l.id <> r.id
  AND l.x0 - 2 <= r.x1 AND r.x0 <= l.x1 + 2 AND l.z0 - 2 <= r.z1 AND r.z0 <= l.z1 + 2 AND l.y0 - 2 <= r.y1 AND r.y0 <= l.y1 + 2"""


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, dst: parts of one size whose keys are less than 60 apart; met by stretches of 60 keys, of which such two lie in one or in two beside each other."""
    stretch = F.floor(C("p_partkey") / 60)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    a, b = p.withColumn("at", F.explode(F.array(stretch, stretch + 1))).alias("a"), p.withColumn("at", stretch).alias("b")
    key = (C("a.p_size") == C("b.p_size")) & (C("a.at") == C("b.at")) & (C("a.p_partkey") < C("b.p_partkey")) & (C("b.p_partkey") - C("a.p_partkey") < 60)
    return a.join(b, key).select(C("a.p_partkey").alias("src"), C("b.p_partkey").alias("dst"))


def connected_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of two to four parts that are connected, of parts that share a size and lie next to each other by key."""
    return graph.connected_subsets(neighbours(spark, sf_dir), 4).select(F.array_join(F.transform("members", lambda m: m.cast("string")), ":").alias("members"), F.size("members").alias("n"))


SUBSETS_SQL = """
WITH RECURSIVE e AS (SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND b.p_partkey - a.p_partkey < 60), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
s(m) AS (SELECT DISTINCT [a, b] FROM e UNION SELECT list_sort(list_append(m, u.b)) FROM s JOIN u ON list_contains(m, u.a) AND NOT list_contains(m, u.b) WHERE len(m) < 4)
SELECT array_to_string(m, ':') AS members, CAST(len(m) AS INTEGER) AS n FROM s
"""

SAMPLES = """SELECT event_id, user_id AS target, epoch(ts) AS ts, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id * 7 % 13 AS DOUBLE) END AS ground, value / 4 AS speed, CAST(event_id * 11 % 40 AS DOUBLE) - 4 AS y FROM {t} WHERE user_id IS NOT NULL"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements of the events' users: one sample a second."""
    seconds = "CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS DOUBLE) / 1000000"
    rows = _view(spark, sf_dir, SAMPLES.replace("epoch(ts)", f"floor({seconds} / 100)"), "events")
    return rows.groupBy("target", "ts").agg(*(F.min_by(c, "event_id").alias(c) for c in ("event_id", "ground", "speed", "y"))).withColumn("ts", C("ts").cast("double"))


_SAMPLES = f"""s AS (SELECT target, ts, arg_min_null(event_id, event_id) AS event_id, arg_min_null(ground, event_id) AS ground, arg_min_null(speed, event_id) AS speed, arg_min_null(y, event_id) AS y FROM ({SAMPLES.format(t="events").replace("epoch(ts)", "floor(epoch(ts) / 100)")}) GROUP BY target, ts)"""


def ground_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.ground_state(_samples(spark, sf_dir))


STATE_SQL = f"""WITH {_SAMPLES}, c AS (SELECT *, min(ts) FILTER (ground < 4) OVER (PARTITION BY target) AS c FROM s), b AS (SELECT *, min(ts) FILTER (ground < 4 AND ts - c >= 0.75::DOUBLE) OVER (PARTITION BY target) AS b FROM c),
x AS (SELECT target, any_value(c) AS c, any_value(b) AS b, min(ts) FILTER (speed < 1 AND (b IS NULL OR ts < b)) AS early, min(ts) FILTER (ts > b AND speed < 8) AS late FROM b GROUP BY target),
y AS (SELECT target, CASE WHEN early IS NULL OR c <= early THEN c END AS contact, CASE WHEN early IS NULL THEN b END AS braced, coalesce(early, late) AS recovered FROM x)
SELECT *, CASE WHEN recovered IS NOT NULL THEN 'recovered' WHEN braced IS NOT NULL THEN 'braced' WHEN contact IS NOT NULL THEN 'contact' ELSE 'airborne' END AS state FROM y"""


def hit_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dust and craters of each target at least 250 apart, since when a crater runs, and when its trail is flushed."""
    emitted = tracking.emissions(_samples(spark, sf_dir), 250.0)
    out = tracking.side_outputs(emitted).select("target", "ts", "kind", "since")
    return out.unionByName(tracking.flushes(emitted).select("target", C("due").alias("ts"), F.lit("flush").alias("kind"), C("first").alias("since")))


COOLDOWN_SQL = f"""WITH RECURSIVE {_SAMPLES}, o AS (SELECT target, ts, coalesce(ground < 4, false) AS on_, row_number() OVER (PARTITION BY target ORDER BY ts) AS n FROM s),
r(target, n, ts, last, since, due, began) AS (SELECT target, n, ts, CASE WHEN on_ THEN ts END, CASE WHEN on_ THEN ts END, on_, CAST(NULL AS DOUBLE) FROM o WHERE n = 1
  UNION ALL SELECT o.target, o.n, o.ts, CASE WHEN on_ AND (last IS NULL OR o.ts - last >= 250) THEN o.ts ELSE last END, CASE WHEN on_ AND (last IS NULL OR o.ts - last >= 250) THEN o.ts WHEN on_ THEN since END, on_ AND (last IS NULL OR o.ts - last >= 250), since FROM r JOIN o ON o.target = r.target AND o.n = r.n + 1),
e AS (SELECT target, ts, began FROM r WHERE due), t AS (SELECT *, count(*) FILTER (began IS NULL) OVER (PARTITION BY target ORDER BY ts) AS trail FROM e)
SELECT target, ts, 'dust' AS kind, CAST(NULL AS DOUBLE) AS since FROM e UNION ALL SELECT target, ts, 'crater', coalesce(began, ts) FROM e UNION ALL SELECT target, max(ts) + 3, 'flush', min(ts) FROM t GROUP BY target, trail"""


def hit_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with their generation, work for each hit 50 and 500 later that is not stale by then; and the sweeps of fallen targets."""
    hits = _samples(spark, sf_dir).select("target", "event_id", "ts")
    made = tracking.generations(hits)
    work = made.select("generation", F.explode(F.array(C("ts") + 0.5, C("ts") + 5.0)).alias("at"))
    alive = tracking.live_work(work, made).groupBy("generation").agg(F.count("*").alias("n")).select(F.lit("work").alias("kind"), C("generation").cast("long").alias("id"), C("n").cast("double").alias("figure"))
    swept = tracking.sweeps(_samples(spark, sf_dir), every=1000.0).groupBy("target").agg(F.count("*").alias("n"), F.sum("y").alias("y")).select(F.lit("sweep").alias("kind"), C("target").alias("id"), F.round(C("n") * 1000 + C("y"), R).alias("figure"))
    return alive.unionByName(swept)


WORK_SQL = f"""WITH {_SAMPLES}, g AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS g, ts, lead(ts) OVER (ORDER BY ts, event_id) AS next FROM s), w AS (SELECT g, next, ts + unnest([0.5::DOUBLE, 5.0::DOUBLE]) AS due FROM g),
l AS (SELECT target, CAST(floor(ts / 1000) AS BIGINT) + 1 AS tick, arg_max(y, ts) AS y FROM s GROUP BY ALL)
SELECT 'work' AS kind, g AS id, CAST(count(*) AS DOUBLE) AS figure FROM w WHERE next IS NULL OR due < next GROUP BY g UNION ALL SELECT 'sweep', target, round(count(*) * 1000 + sum(y), 6) FROM l WHERE y < 0 GROUP BY target"""


def plan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans written as JSON and read again, some of them broken; digests of snapshots by the first identity that is there."""
    n = C("s_suppkey")
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(z)).alias("z")) for x, z in ((0, 0), (9, 0), (9, 9))))
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(n % 3 == 0, C("s_name")).alias("alias"), F.concat(F.lit("k"), n.cast("string")).alias("key"), F.array_repeat(F.lit(1.0), F.when(n % 7 == 1, 11).otherwise(12)).alias("frame"), F.array(*map(F.lit, (9.0, 30.0, 9.0))).alias("size"),
        F.when(n % 5 != 2, F.array(F.struct(F.lit(0.0).alias("bottom"), ring.alias("ring")))).otherwise(F.array().cast(f"array<struct<bottom:double,ring:{polygons.RING}>>")).alias("tiers"),
    )
    text = sinks.encode_plan(rows)
    text = text.withColumn("plan", F.when(n % 11 == 3, F.regexp_replace("plan", '"version":1', '"version":2')).when(n % 13 == 4, F.lit("[")).when(n % 17 != 5, C("plan")))
    read = sinks.decode_plan(text)
    shot = sinks.snapshot(rows, ["alias", "s_suppkey"], ["s_name", "alias"])
    back = read.select("s_suppkey", "reason", F.when(C("reason").isNull(), C("plan.key")).alias("key"), F.coalesce("alias", n.cast("string")).alias("identity"))
    return back.join(shot, "identity").select("s_suppkey", "reason", "key", "digest")


TEXTS_SQL = r"""
SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 3 THEN 'unsupported plan version' WHEN s_suppkey % 13 = 4 THEN 'invalid plan' WHEN s_suppkey % 17 = 5 THEN 'missing plan' WHEN s_suppkey % 7 = 1 THEN 'invalid frame' WHEN s_suppkey % 5 = 2 THEN 'no tiers' END AS reason,
  CASE WHEN s_suppkey % 11 <> 3 AND s_suppkey % 13 <> 4 AND s_suppkey % 17 <> 5 AND s_suppkey % 7 <> 1 AND s_suppkey % 5 <> 2 THEN concat('k', s_suppkey) END AS key,
  sha256(concat(s_name, chr(31), CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE chr(0) END)) AS digest FROM supplier
"""

SQL = {
    weld_points: WELDED_SQL, radius_weld: RADIUS_SQL, tile_alignment: ALIGN_SQL, triangle_frames: FRAMES_SQL, section_degrees: DEGREES_SQL, section_loops: LOOPS_SQL, convex_hull: HULL_SQL, polygon_slabs: SLABS_SQL, polygon_clips: CLIPS_SQL,
    ring_simplified: SIMPLE_SQL, nearby_components: NEARBY_SQL, track_bindings: BINDING_SQL, scene_conflicts: CONFLICT_SQL, piece_overlaps: PIECES_SQL, connected_subsets: SUBSETS_SQL, ground_state: STATE_SQL, hit_cooldown: COOLDOWN_SQL, hit_work: WORK_SQL, plan_texts: TEXTS_SQL,
}
