"""Registered queries over places: sampled grids, bodies, ground, rays, tracks and contracts, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import geometry, motion, rings
from strataframe.operators import masks, meshes, places
from strataframe.plans.levels import BOXES
from strataframe.plans.occupancy import CELLS, FLOODED, SIDE, _cells
from strataframe.plans.scalars import TURNED, _turned, _view
from strataframe.plans.drawn import draw, drawn, table
from strataframe.plans.scenes import _segments, _SEGMENTS
from strataframe.plans.works import FRAMES_SQL, _boxes

C = F.col
R = 6

#: A building for each supplier with three floors; two boxes in it, the upper one smaller.
SHELLS = """SELECT s_suppkey AS m, CAST(20 + s_suppkey % 31 AS DOUBLE) AS sx, 60.0D AS sy, CAST(15 + s_suppkey % 23 AS DOUBLE) AS sz, 3 AS floors, 15.0D AS ground, 10.0D AS upper FROM {t}"""
_SHELLS = SHELLS.replace("60.0D", "60.0::DOUBLE").replace("15.0D", "15.0::DOUBLE").replace("10.0D", "10.0::DOUBLE").format(t="supplier")


def sampled_solids(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _view(spark, sf_dir, SHELLS, "supplier")
    box = lambda x, y0, y1, z: F.struct(motion.vector(-x, y0, -z).alias("lo"), motion.vector(x, y1, z).alias("hi"))
    solids = models.select("m", F.inline(F.array(box(C("sx") / 2, F.lit(-30.0), F.lit(-2.0), C("sz") / 2), box(C("sx") / 4, F.lit(-2.0), F.lit(25.0), C("sz") / 4))))
    found = places.sampled_solids(models, solids)
    return found.groupBy("m", "k").agg(F.count("*").alias("n"), F.count_if("tight").alias("tight"), F.sum(C("i") * 100 + C("j")).alias("where"))


_S = "(1.5::DOUBLE * (1::DOUBLE / 0.28::DOUBLE))"
_GRID = "g AS (SELECT *, greatest({c}, greatest(sx, sz) / {n}) AS cell FROM s), c AS (SELECT *, unnest(generate_series(1, CAST(ceil(sx / cell) AS BIGINT))) AS i FROM g), d AS (SELECT *, unnest(generate_series(1, CAST(ceil(sz / cell) AS BIGINT))) AS j FROM c)"
SOLIDS_SQL = f"""WITH s AS ({_SHELLS}), {_GRID.format(c="2.5::DOUBLE", n=18)}, k AS (SELECT *, unnest([1, 2, 3]) AS k, -sx / 2 + (i - 0.5::DOUBLE) * cell AS x, -sz / 2 + (j - 0.5::DOUBLE) * cell AS z FROM d),
y AS (SELECT *, -30 + {_S} + CASE WHEN k = 1 THEN 0 ELSE {_S} + 15 + (k - 2) * (10 + {_S}) END AS base, CASE WHEN k = 1 THEN 15 ELSE 10 END AS clear FROM k),
p AS (SELECT m, k, i, j, (base + clear * 0.15::DOUBLE BETWEEN -30 AND -2 AND abs(x) <= sx / 2 AND abs(z) <= sz / 2) OR (base + clear * 0.15::DOUBLE BETWEEN -2 AND 25 AND abs(x) <= sx / 4 AND abs(z) <= sz / 4) AS loose,
  (base + clear * 0.95::DOUBLE BETWEEN -30 AND -2 AND abs(x) <= sx / 2 AND abs(z) <= sz / 2) OR (base + clear * 0.95::DOUBLE BETWEEN -2 AND 25 AND abs(x) <= sx / 4 AND abs(z) <= sz / 4) AS tight FROM y)
SELECT m, k, count(*) AS n, count(*) FILTER (tight) AS tight, CAST(sum(i * 100 + j) AS BIGINT) AS "where" FROM p WHERE loose GROUP BY m, k"""


def sampled_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of sections that are boxes, narrower on each floor and on the last a bare line; and why some are no buildings."""
    models = _view(spark, sf_dir, SHELLS, "supplier").select("m", "sx", "sz", "floors")
    w = F.transform(F.array(*map(F.lit, (1.0, 0.7, 0.0))), lambda f, k: F.struct((k + 1).alias("k"), f.alias("f")))
    slices = models.select("m", "sx", "sz", F.inline(w))
    ring = rings.box_ring(-C("sx") * C("f") / 2, -C("sz") / 2, C("sx") * C("f") / 2, C("sz") / 2)
    slices = slices.select("m", "k", F.transform(rings.edges(ring), lambda e: F.array(e["a"], e["b"])).alias("segments"))
    cells = places.sampled_sections(models, slices)
    reasons = places.sample_reasons(models, cells)
    return reasons.join(cells.groupBy("m").agg(F.count("*").alias("n"), F.sum(C("k") * 10000 + C("i") * 100 + C("j")).alias("where")), "m", "left").select("m", "reason", "n", "where")


SECTIONS_SQL = f"""WITH s AS ({_SHELLS}), {_GRID.format(c="3.0::DOUBLE", n=24)}, f AS (SELECT *, unnest([1.0::DOUBLE, 0.7::DOUBLE]) AS f, -sx / 2 + (i - 0.5::DOUBLE) * cell AS x, -sz / 2 + (j - 0.5::DOUBLE) * cell AS z FROM d),
p AS (SELECT *, CASE WHEN f = 1 THEN 1 ELSE 2 END AS k FROM f WHERE abs(x) + cell * 0.4::DOUBLE < sx * f / 2 AND abs(z) + cell * 0.4::DOUBLE < sz / 2), n AS (SELECT m, k, count(*) AS n, sum(k * 10000 + i * 100 + j) AS w FROM p GROUP BY m, k),
a AS (SELECT m, count(*) FILTER (n >= 4) AS good, sum(n) AS n, sum(w) AS w FROM n GROUP BY m)
SELECT g.m, CASE WHEN least(sx, sz) < 12 THEN 'too narrow' WHEN coalesce(good, 0) < 1.8::DOUBLE THEN 'too few floors' WHEN coalesce(n, 0) * cell * cell / 3 < 150 THEN 'too small' END AS reason, CAST(n AS BIGINT) AS n, CAST(w AS BIGINT) AS "where" FROM g LEFT JOIN a ON a.m = g.m"""


def body_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertical bodies as grids of their own, or why not."""
    cells = _cells(spark, sf_dir)
    flat = masks.components(cells, SIDE)
    bodies = masks.components(cells, SIDE, vertical=True).select(*masks.CELL, C("component").alias("body"))
    return places.cropped(flat.join(bodies, masks.CELL)).select("m", "body", "first", "last", "i0", "i1", "j0", "j1", "reason")


CROPS_SQL = f"""{FLOODED},
l AS (SELECT DISTINCT a.component AS x, b.component AS y FROM f a JOIN f b ON a.m = b.m AND a.i = b.i AND a.j = b.j AND b.k = a.k + 1), u AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
p AS (SELECT component AS x, component AS seed FROM f UNION SELECT u.y, p.seed FROM p JOIN u ON p.x = u.x AND p.seed < u.y), b AS (SELECT x, min(seed) AS body FROM p GROUP BY x),
q AS (SELECT m, body, k, count(DISTINCT component) AS n, min(i) AS i0, max(i) AS i1, min(j) AS j0, max(j) AS j1 FROM f JOIN b ON f.component = b.x GROUP BY ALL)
SELECT m, body, min(k) AS first, max(k) AS last, min(i0) AS i0, max(i1) AS i1, min(j0) AS j0, max(j1) AS j1,
  CASE WHEN max(n) > 1 THEN 'body branches or merges' WHEN min(k) <> 1 THEN 'substantial body does not begin on the ground floor' WHEN count(*) <> max(k) - min(k) + 1 THEN 'body has an unsupported vertical gap' END AS reason FROM q GROUP BY m, body"""


def cell_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = places.cell_corners(_cells(spark, sf_dir), 3.0, 29.0, 28.5)
    return found.groupBy("m", "k").agg(F.count("*").alias("n"), F.round(F.sum("x"), R).alias("x"), F.round(F.sum("z"), R).alias("z"))


CORNER_SQL = f"""{CELLS}, p AS (SELECT DISTINCT m, k, i - 1 + a AS i, j - 1 + b AS j FROM c, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))
SELECT m, k, count(*) AS n, round(sum(least(-14.5::DOUBLE + i * 3, 14.5::DOUBLE)), 6) AS x, round(sum(least(-14.25::DOUBLE + j * 3, 14.25::DOUBLE)), 6) AS z FROM p GROUP BY m, k"""


def ground_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ground below each part as a point: the highest top of the boxes of customers at most 10 above it."""
    points = _view(spark, sf_dir, "SELECT p_partkey AS id, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y, CAST(p_partkey * 29 % 229 AS DOUBLE) AS z FROM {t}", "part")
    return places.ground_below(points, _boxes(spark, sf_dir), 32.0, rise=10.0, depth=25.0).select("id", "ground")


GROUND_SQL = f"""WITH b AS ({BOXES.format(t="customer")}), p AS (SELECT p_partkey AS id, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y, CAST(p_partkey * 29 % 229 AS DOUBLE) AS z FROM part)
SELECT p.id, max(b.y1) AS ground FROM p LEFT JOIN b ON p.x BETWEEN b.x0 AND b.x1 AND p.z BETWEEN b.z0 AND b.z1 AND b.y1 BETWEEN p.y - 25 AND p.y + 10 GROUP BY p.id"""

TRIANGLES = """SELECT c_custkey AS triangle, CAST(c_custkey * 37 % 2999 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x, CAST(c_custkey % 60 AS DOUBLE) AS y, CAST(c_custkey * 91 % 2971 AS DOUBLE) AS z, CAST(10 + c_custkey % 23 AS DOUBLE) AS w, CAST(5 + c_custkey % 19 AS DOUBLE) AS h FROM {t}"""


def ray_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest triangle that each hit's segment goes through."""
    rows = _view(spark, sf_dir, TRIANGLES, "customer")
    v = motion.vector
    triangles = rows.select("triangle", v(C("x"), C("y"), C("z")).alias("a"), v(C("x") + C("w"), C("y") + C("h"), C("z")).alias("b"), v(C("x"), C("y") - C("h"), C("z") + C("w")).alias("c"))
    return places.ray_picks(_segments(spark, sf_dir), triangles, 64.0).select("hit", "triangle", F.round("t", R).alias("t"))


PICKS_SQL = f"""WITH {_SEGMENTS}, r AS ({TRIANGLES.format(t="customer")}),
q AS (SELECT hit, triangle, ex - sx AS dx, ey - sy AS dy, ez - sz AS dz, w, h AS g, sx - x AS px, sy - y AS py, sz - z AS pz FROM h JOIN r ON x <= greatest(sx, ex) AND x + w >= least(sx, ex) AND z <= greatest(sz, ez) AND z + w >= least(sz, ez)),
d AS (SELECT *, w * (dy * w + dz * g) + g * -(dx * w) AS det FROM q),
u AS (SELECT hit, triangle, (px * (dy * w + dz * g) + py * -(dx * w) + pz * (-dx * g)) / det AS u, (dx * (-pz * g) + dy * (pz * w) + dz * (px * g - py * w)) / det AS v, (-g * (pz * w) + w * (px * g - py * w)) / det AS t FROM d WHERE det <> 0)
SELECT hit, arg_min(triangle, (t, triangle)) AS triangle, round(min(t), 6) + 0 AS t FROM u WHERE u >= 0 AND v >= 0 AND u + v <= 1 AND t BETWEEN 0 AND 1 GROUP BY hit"""


def loop_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes over eight samples of each supplier, of drawn places and sizes, near enough to compete for a track; some are missing."""
    rows = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("sample"))
    rows = rows.withColumn("loop", F.explode(F.array(*map(F.lit, (1, 2, 3, 4))))).filter(draw(C("m"), C("sample"), C("loop"), "miss", n=12) > 0)
    at = lambda name, n: draw(C("m"), C("sample"), C("loop"), name, n=n) / 10.0
    rows = rows.withColumns({"x0": C("loop") * 12 + at("x", 90), "z0": at("z", 90)}).withColumns({"x1": C("x0") + 20 + at("w", 30), "z1": C("z0") + 20 + at("d", 30)})
    loops = rows.select("m", "sample", "loop", rings.box_ring(C("x0"), C("z0"), C("x1"), C("z1")).alias("ring"), ((C("x1") - C("x0")) * (C("z1") - C("z0"))).alias("area"), ((C("x0") + C("x1")) / 2).alias("x"), ((C("z0") + C("z1")) / 2).alias("z"))
    return places.tracked(loops)


def _away(p: str, q: str) -> str:
    """The largest of the distances of the corners and edge middles of box p to the border of box q."""
    mid = {"x": f"(({p}.x0 + {p}.x1) / 2)", "z": f"(({p}.z0 + {p}.z1) / 2)"}
    points = [(f"{p}.x{i}", f"{p}.z{j}") for i in (0, 1) for j in (0, 1)] + [(mid["x"], f"{p}.z{j}") for j in (0, 1)] + [(f"{p}.x{i}", mid["z"]) for i in (0, 1)]
    inner = "least({0} - {q}.x0, {q}.x1 - {0}, {1} - {q}.z0, {q}.z1 - {1})"
    outer = "sqrt(pow(greatest({q}.x0 - {0}, 0, {0} - {q}.x1), 2) + pow(greatest({q}.z0 - {1}, 0, {1} - {q}.z1), 2))"
    return "greatest(" + ", ".join(f"CASE WHEN {inner.format(x, z, q=q)} >= 0 THEN {inner.format(x, z, q=q)} ELSE {outer.format(x, z, q=q)} END" for x, z in points) + ")"


TRACKS_SQL = f"""
WITH RECURSIVE k AS (SELECT s_suppkey AS m, sample, loop FROM supplier, (SELECT unnest(generate_series(1, 8)) AS sample), (SELECT unnest([1, 2, 3, 4]) AS loop)),
a AS (SELECT m, sample, loop, loop * 12 + {drawn("m, sample, loop, 'x'", 90)} / 10.0::DOUBLE AS x0, {drawn("m, sample, loop, 'z'", 90)} / 10.0::DOUBLE AS z0, {drawn("m, sample, loop, 'w'", 30)} / 10.0::DOUBLE AS w, {drawn("m, sample, loop, 'd'", 30)} / 10.0::DOUBLE AS d
  FROM k WHERE {drawn("m, sample, loop, 'miss'", 12)} > 0),
b AS (SELECT *, x0 + 20 + w AS x1, z0 + 20 + d AS z1, (20 + w) * (20 + d) AS area FROM a),
p AS (SELECT l.m, l.sample, l.loop, e.loop AS prev, least(l.area, e.area) / greatest(l.area, e.area) AS ratio, sqrt(pow((l.x0 + l.x1 - e.x0 - e.x1) / 2, 2) + pow((l.z0 + l.z1 - e.z0 - e.z1) / 2, 2)) AS shift, greatest({_away("l", "e")}, {_away("e", "l")}) AS apart
  FROM b l JOIN b e ON e.m = l.m AND e.sample = l.sample - 1),
o AS (SELECT m, sample, loop, prev, row_number() OVER (PARTITION BY m, sample ORDER BY loop, apart + shift / 4 + (1 - ratio) * 10, prev) AS n FROM p WHERE ratio >= 0.78 AND shift <= 18 AND apart <= 8),
r(m, sample, n, loops, prevs) AS (
  SELECT m, sample, 0, CAST([] AS INTEGER[]), CAST([] AS INTEGER[]) FROM b GROUP BY m, sample
  UNION ALL SELECT r.m, r.sample, r.n + 1, CASE WHEN list_contains(loops, o.loop) OR list_contains(prevs, o.prev) THEN loops ELSE list_append(loops, o.loop) END, CASE WHEN list_contains(loops, o.loop) OR list_contains(prevs, o.prev) THEN prevs ELSE list_append(prevs, o.prev) END
  FROM r JOIN o ON o.m = r.m AND o.sample = r.sample AND o.n = r.n + 1),
t AS (SELECT m, sample, unnest(arg_max(loops, n)) AS loop, unnest(arg_max(prevs, n)) AS prev FROM r GROUP BY m, sample),
h(m, sample, loop, s, l) AS (
  SELECT b.m, b.sample, b.loop, b.sample, b.loop FROM b LEFT JOIN t ON t.m = b.m AND t.sample = b.sample AND t.loop = b.loop WHERE t.loop IS NULL
  UNION ALL SELECT t.m, t.sample, t.loop, h.s, h.l FROM h JOIN t ON t.m = h.m AND t.sample = h.sample + 1 AND t.prev = h.loop)
SELECT m, sample, loop, CAST(dense_rank() OVER (PARTITION BY m ORDER BY s, l) AS INTEGER) AS track FROM h
"""


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer as a part: whether its stored box agrees, whether it is deleted when hit, and whether it is below a building."""
    n = C("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.array(F.when(n % 3 == 0, "NoCSG").otherwise("Wall")).alias("tags"), F.when(n % 5 == 0, "mesh").otherwise("block").alias("kind"),
        F.concat(F.when(n % 4 == 0, "Buildings/Building_7/Floor1/").when(n % 4 == 1, "Trees/").otherwise("x/MyBuilding/"), F.when(n % 7 == 0, "Building_part").otherwise("Slab")).alias("path"),
        motion.vector(-(n % 9) / 10 - 5, F.lit(-10.0), F.lit(-4.0)).alias("lo"), motion.vector(F.lit(5.2), F.lit(10.3), (n % 11) / 20 + 4).alias("hi"),
    )
    size = motion.vector(F.lit(10.5), F.lit(20.0), F.lit(8.2))
    return rows.select("c_custkey", places.same_envelope(C("lo"), C("hi"), size).alias("same"), places.removable(C("kind"), C("tags")).alias("removed"), places.in_building(C("path")).alias("inside"))


RULES_SQL = """SELECT c_custkey, greatest(abs(-(c_custkey % 9) / 10 - 5 + 5.25::DOUBLE), abs(5.2::DOUBLE - 5.25::DOUBLE), abs(10.3::DOUBLE - 10), abs((c_custkey % 11) / 20 + 4 - 4.1::DOUBLE), abs(-4 + 4.1::DOUBLE)) <= 0.35::DOUBLE AS same,
  c_custkey % 5 = 0 OR c_custkey % 3 = 0 AS removed, c_custkey % 4 = 0 AS inside FROM customer"""


def section_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as authored buildings of turned boxes: which of them keep the contract."""
    n = C("c_nationkey")
    sections = _turned(spark, sf_dir).withColumns({
        "building": (C("id") / 4).cast("long"), "name": F.when(C("id") % 36 == 8, "House").otherwise("Building_1"), "floors": F.when(n % 6 == 1, 2.5).when(n % 6 == 2, 3.0),
        "size": motion.vector(C("size.x") + 0.5, C("size.y") + 25, F.when(n == 3, 1.0).otherwise(C("size.z"))), "at": motion.vector(F.when(n == 4, float("nan")).otherwise(C("at.x") / 3), C("at.y"), C("at.z") / 3),
    })
    return places.section_contract(sections.drop("c_nationkey"), 32.0)


CONTRACTS_SQL = f"""
WITH t AS (SELECT id, id // 4 AS building, c_nationkey AS n, x / 3 AS x, y, z / 3 AS z, sx + 0.5::DOUBLE AS sx, sy + 25 AS sy, CASE WHEN c_nationkey = 3 THEN 1 ELSE sz END AS sz, yaw FROM ({TURNED.format(t="customer")})),
p AS (SELECT a.building, b.x - a.x AS dx, b.z - a.z AS dz, a.yaw AS ya, b.yaw AS yb, a.sx AS ax, a.sz AS az, b.sx AS bx, b.sz AS bz, abs(cos(b.yaw - a.yaw)) AS c, abs(sin(b.yaw - a.yaw)) AS s FROM t a JOIN t b ON a.building = b.building AND a.id < b.id AND a.n <> 4 AND b.n <> 4 AND abs(a.y - b.y) < (a.sy + b.sy) / 2 - 0.001::DOUBLE),
o AS (SELECT DISTINCT building FROM p WHERE abs(dx * cos(ya) - dz * sin(ya)) < (ax + bx * c + bz * s) / 2 - 0.001::DOUBLE AND abs(dx * sin(ya) + dz * cos(ya)) < (az + bx * s + bz * c) / 2 - 0.001::DOUBLE
  AND abs(dx * cos(yb) - dz * sin(yb)) < (bx + ax * c + az * s) / 2 - 0.001::DOUBLE AND abs(dx * sin(yb) + dz * cos(yb)) < (bz + ax * s + az * c) / 2 - 0.001::DOUBLE)
SELECT t.building, count(*) AS n, CASE WHEN bool_or(id % 36 = 8) THEN 'Name must begin with Building' WHEN bool_or(n = 4) THEN 'Nonfinite frame' WHEN bool_or(n = 3 OR sx <= 4 OR sy < 6.5::DOUBLE / 0.28::DOUBLE) THEN 'Section is too small for interior floors' WHEN bool_or(n % 6 = 1) THEN 'Invalid floors' WHEN any_value(o.building) IS NOT NULL THEN 'Sections overlap' END AS reason
FROM t LEFT JOIN o ON o.building = t.building GROUP BY t.building"""


def plan_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned areas of orders' lines against what was built: missing, unplanned and wrong pieces."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    planned = lines.filter("l_partkey % 50 <> 0").withColumn("area", C("l_quantity"))
    built = lines.filter("l_partkey % 41 <> 0").withColumn("area", C("l_quantity") + F.when(C("l_partkey") % 37 == 0, 0.5).otherwise(0.0))
    found = places.plan_audit(planned, built, ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber", F.round("expected", R).alias("expected"), F.round("found", R).alias("found"), "reason")


PLANS_SQL = """
WITH a AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS expected FROM lineitem WHERE l_partkey % 50 <> 0 GROUP BY ALL), b AS (SELECT l_orderkey, l_linenumber, sum(l_quantity + CASE WHEN l_partkey % 37 = 0 THEN 0.5::DOUBLE ELSE 0 END) AS found FROM lineitem WHERE l_partkey % 41 <> 0 GROUP BY ALL),
c AS (SELECT *, CASE WHEN found IS NULL THEN 'missing piece' WHEN expected IS NULL THEN 'unplanned piece' WHEN abs(expected - found) > 0.001::DOUBLE * greatest(expected, 1) THEN 'area disagrees with plan' END AS reason FROM a FULL JOIN b USING (l_orderkey, l_linenumber))
SELECT l_orderkey, l_linenumber, round(expected, 6) AS expected, round(found, 6) AS found, reason FROM c WHERE reason IS NOT NULL"""


def mesh_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes around suppliers' triangles in the frame of their longest level edge; and that frame after its model has moved."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    tilt = F.when(C("l_linenumber") % 2 == 0, 0.05).otherwise(3.0)
    v = motion.vector
    rows = lines.select("l_suppkey", v(F.lit(0), F.lit(0), F.lit(0)).alias("a"), v(C("l_quantity"), tilt, C("l_partkey") % 31).alias("b"), v(C("l_quantity") / 2, F.lit(9), F.lit(1)).alias("c"))
    found = places.frame_of(rows, meshes.triangle_frame(rows, ["l_suppkey"]), ["l_suppkey"])
    at, yaw = places.moved_frame(C("at"), C("yaw"), v(F.lit(1), F.lit(2), F.lit(3)), F.lit(0.5), v(F.lit(10), F.lit(0), F.lit(-5)), F.lit(0.9))
    return found.select("l_suppkey", *(F.round(f"size.{a}", 4).alias(f"s{a}") for a in "xyz"), *(F.round(at[a], 4).alias(a) for a in "xyz"), F.round(yaw, R).alias("yaw"))


MESH_FRAMES_SQL = f"""
WITH f AS ({FRAMES_SQL}), w AS (SELECT s.l_suppkey, coalesce(max(CASE WHEN l_linenumber % 2 = 0 THEN {{'n': sqrt(l_quantity * l_quantity + CAST(l_partkey % 31 AS DOUBLE) * (l_partkey % 31)), 'y': -atan2(CAST(l_partkey % 31 AS DOUBLE), l_quantity)}} END).y, 0) AS t FROM lineitem s GROUP BY 1),
p AS (SELECT l_suppkey, 0 AS x, 0 AS y, 0 AS z FROM lineitem UNION ALL SELECT l_suppkey, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN 0.05::DOUBLE ELSE 3 END, l_partkey % 31 FROM lineitem UNION ALL SELECT l_suppkey, l_quantity / 2, 9, 1 FROM lineitem),
q AS (SELECT l_suppkey, t, x * cos(t) - z * sin(t) AS u, y, x * sin(t) + z * cos(t) AS v FROM p JOIN w USING (l_suppkey)),
b AS (SELECT l_suppkey, t, min(u) AS u0, max(u) AS u1, min(y) AS y0, max(y) AS y1, min(v) AS v0, max(v) AS v1 FROM q GROUP BY ALL),
c AS (SELECT *, (u0 + u1) / 2 * cos(t) + (v0 + v1) / 2 * sin(t) AS cx, (y0 + y1) / 2 AS cy, (v0 + v1) / 2 * cos(t) - (u0 + u1) / 2 * sin(t) AS cz FROM b),
d AS (SELECT *, (cx - 1) * cos(0.5::DOUBLE) - (cz - 3) * sin(0.5::DOUBLE) AS lx, (cx - 1) * sin(0.5::DOUBLE) + (cz - 3) * cos(0.5::DOUBLE) AS lz FROM c)
SELECT l_suppkey, round(u1 - u0, 4) AS sx, round(CAST(y1 - y0 AS DOUBLE), 4) AS sy, round(v1 - v0, 4) AS sz, round(10 + lx * cos(0.9::DOUBLE) + lz * sin(0.9::DOUBLE), 4) AS x, round(CAST(cy - 2 AS DOUBLE), 4) AS y, round(-5 - lx * sin(0.9::DOUBLE) + lz * cos(0.9::DOUBLE), 4) AS z, round(t + 0.4::DOUBLE, 6) AS yaw FROM d"""


def segment_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two segments for each line: whether they meet, how far a point is from the first, whether it is enclosed by four, its key, and what is a number."""
    q, p, s = C("l_quantity").cast("long") % 9, C("l_partkey") % 9, C("l_suppkey") % 9
    pt = rings.point
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", q.alias("q"), p.alias("p"), s.alias("s"))
    q, p, s = C("q"), C("p"), C("s")
    meet = geometry.segments_meet(pt(q, p), pt(s, q), pt(p, s), pt(F.lit(4), F.lit(4)))
    walls = F.array(*(F.array(a, b) for a, b in ((pt(F.lit(1), F.lit(1)), pt(F.lit(7), F.lit(1))), (pt(F.lit(7), F.lit(1)), pt(F.lit(7), F.lit(7))), (pt(F.lit(7), F.lit(7)), pt(F.lit(1), F.lit(7))), (pt(F.lit(1), F.lit(7)), pt(F.lit(1), F.lit(1))))))
    far = geometry.segment_distance(s, s, q, p, s, q)
    number = geometry.finite(F.when(q == 3, float("nan")).when(q == 4, float("inf")).when(q != 5, q.cast("double")))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", meet.alias("meet"), F.round(far, R).alias("far"), geometry.enclosed(walls, q + 0.5, p + 0.5).alias("enclosed"), geometry.grid_key(q / 2, p / 4, step=0.5).alias("key"), number.alias("number"))


_T = "(({bx}) - ({ax})) * (({cz}) - ({az})) - (({bz}) - ({az})) * (({cx}) - ({ax}))"
_ABC, _ABD = _T.format(ax="q", az="p", bx="s", bz="q", cx="p", cz="s"), _T.format(ax="q", az="p", bx="s", bz="q", cx="4", cz="4")
_CDA, _CDB = _T.format(ax="p", az="s", bx="4", bz="4", cx="q", cz="p"), _T.format(ax="p", az="s", bx="4", bz="4", cx="s", cz="q")
_ON = "({t} = 0 AND ({x}) BETWEEN least({ax}, {bx}) AND greatest({ax}, {bx}) AND ({z}) BETWEEN least({az}, {bz}) AND greatest({az}, {bz}))"
SEGMENT_SQL = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) % 9 AS q, l_partkey % 9 AS p, l_suppkey % 9 AS s FROM lineitem),
d AS (SELECT *, pow(s - q, 2) + pow(q - p, 2) AS n FROM l), f AS (SELECT *, CASE WHEN n > 0 THEN greatest(0, least(1, ((s - q) * (s - q) + (s - p) * (q - p)) / n)) ELSE 0 END AS t FROM d)
SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, l_suppkey, (sign({_ABC}) * sign({_ABD}) < 0 AND sign({_CDA}) * sign({_CDB}) < 0) OR {_ON.format(t=_ABC, x="p", z="s", ax="q", az="p", bx="s", bz="q")} OR {_ON.format(t=_ABD, x="4", z="4", ax="q", az="p", bx="s", bz="q")}
  OR {_ON.format(t=_CDA, x="q", z="p", ax="p", az="s", bx="4", bz="4")} OR {_ON.format(t=_CDB, x="s", z="q", ax="p", az="s", bx="4", bz="4")} AS meet,
  round(sqrt(pow(s - q - t * (s - q), 2) + pow(s - p - t * (q - p), 2)), 6) AS far, q BETWEEN 1 AND 6 AND p BETWEEN 1 AND 6 AS enclosed, concat(q, ':', CAST(round(p / 4 / 0.5::DOUBLE) AS BIGINT)) AS key, q NOT IN (3, 4, 5) AS number FROM f"""


def part_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the template of their type, or the default one, and their colour or the ground's; shells of blocks only."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    templates = parts.filter("p_size > 25").groupBy("p_type").agg(F.max("p_size").alias("size"))
    colour = F.coalesce(F.when(C("p_partkey") % 3 == 0, C("p_partkey") % 256), F.when(C("p_partkey") % 5 > 0, C("p_size")), F.lit(128))
    return parts.join(templates, "p_type", "left").select("p_partkey", F.coalesce("size", F.lit(10)).alias("size"), colour.cast("long").alias("colour"))


TEMPLATES_SQL = """WITH t AS (SELECT p_type, max(p_size) AS size FROM part WHERE p_size > 25 GROUP BY p_type)
SELECT p_partkey, coalesce(size, 10) AS size, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 256 WHEN p_partkey % 5 > 0 THEN p_size ELSE 128 END AS BIGINT) AS colour FROM part LEFT JOIN t USING (p_type)"""

def measured_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turned boxes from three corners of their roofs, the third beside the first or the second, on either side; some roofs are uneven."""
    rows = _turned(spark, sf_dir).withColumn("flip", F.when(C("id") % 2 == 0, 1.0).otherwise(-1.0))
    rise = F.when(C("id") % 11 == 3, 6.0).otherwise(0.3)
    corner = lambda i, j, up: motion.to_world(motion.vector(C("size.x") * i / 2, C("size.y") / 2 + up, C("size.z") * j / 2), C("at"), C("yaw"))
    a, b = corner(F.lit(-1.0), C("flip"), F.lit(0.0)), corner(F.lit(1.0), C("flip"), F.lit(0.0))
    c = corner(F.when(C("id") % 3 == 0, -1.0).otherwise(1.0), -C("flip"), rise)
    ground = F.when(C("id") % 13 != 5, C("at.y") - C("size.y") / 2)
    rows = rows.select("id", places.measured_box(a, b, c, ground).alias("m"))
    return rows.select("id", *(F.round(f"m.at.{v}", 4).alias(v) for v in "xyz"), *(F.round(f"m.size.{v}", 4).alias(f"s{v}") for v in "xyz"), "m.reason")


MEASURED_SQL = f"""WITH t AS (SELECT *, CASE WHEN id % 11 = 3 THEN 'corners are on different roofs' WHEN id % 13 = 5 THEN 'ground missing' END AS reason FROM ({TURNED.format(t="customer")}))
SELECT id, CASE WHEN reason IS NULL THEN round(x, 4) END AS x, CASE WHEN reason IS NULL THEN round(y + 0.05::DOUBLE, 4) END AS y, CASE WHEN reason IS NULL THEN round(z, 4) END AS z, CASE WHEN reason IS NULL THEN round(sx, 4) END AS sx, CASE WHEN reason IS NULL THEN round(sy + 0.1::DOUBLE, 4) END AS sy, CASE WHEN reason IS NULL THEN round(sz, 4) END AS sz, reason FROM t"""


def shell_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as authored shells of turned boxes; those with a part that is no block are refused."""
    parts = _turned(spark, sf_dir).select("c_nationkey", C("id").alias("part"), "at", "size", "yaw", F.when(C("id") % 2 == 0, C("id") % 9).alias("floors"), (C("id") % 3 == 0).alias("core"), F.when(C("id") % 97 == 5, "wedge").otherwise("block").alias("kind"))
    found = places.shell_sections(parts, ["c_nationkey"])
    total = F.aggregate("sections", F.lit(0.0), lambda s, x: s + x["size"]["x"] * x["size"]["z"])
    return found.select("c_nationkey", F.when(C("reason").isNull(), F.size("sections")).alias("n"), F.round(total, R).alias("area"), "reason")


SHELL_SQL = f"""WITH t AS ({TURNED.format(t="customer")})
SELECT c_nationkey, CASE WHEN NOT bool_or(id % 97 = 5) THEN CAST(count(*) AS INTEGER) END AS n, CASE WHEN NOT bool_or(id % 97 = 5) THEN round(sum(sx * sz), 6) END AS area, CASE WHEN bool_or(id % 97 = 5) THEN 'only block parts are accepted' END AS reason FROM t GROUP BY c_nationkey"""

SQL = {
    sampled_solids: SOLIDS_SQL, sampled_sections: SECTIONS_SQL, body_crops: CROPS_SQL, cell_corners: CORNER_SQL, ground_probes: GROUND_SQL, ray_picks: PICKS_SQL, loop_tracks: TRACKS_SQL, part_rules: RULES_SQL,
    section_contracts: CONTRACTS_SQL, plan_audits: PLANS_SQL, mesh_frames: MESH_FRAMES_SQL, segment_tests: SEGMENT_SQL, measured_boxes: MEASURED_SQL, shell_sections: SHELL_SQL, part_templates: TEMPLATES_SQL,
}
