"""Registered queries: arithmetic of buildings, movement, frames and rings on the star-schema tables, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import building, motion, rings
from strataframe.operators import rings as ring_ops
from strataframe.plans.drawn import table

C = F.col
R = 6


def _view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text.format(t="{t}"), t=table(spark, sf_dir, name))


def _round(*names: str) -> list:
    return [F.round(n, R).alias(n.split(".")[-1]) for n in names]


def floor_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floors of heights up to 500, a third of them with a requested number."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select("o_orderkey", (C("o_totalprice") / 1000).alias("h"), F.when(C("o_orderkey") % 3 == 0, C("o_orderkey") % 40).alias("asked"))
    return rows.withColumn("f", building.floor_plan(C("h"), C("asked"))).select("o_orderkey", "f.floors", *_round("f.ground", "f.upper"))


_SLAB, _CLEAR, _LEAST = "(1.5::DOUBLE * (1::DOUBLE / 0.28::DOUBLE))", "(3.5::DOUBLE * (1::DOUBLE / 0.28::DOUBLE))", "(2.0::DOUBLE * (1::DOUBLE / 0.28::DOUBLE))"
FLOOR_SQL = f"""
WITH o AS (SELECT o_orderkey, o_totalprice / 1000 AS h, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 40 END AS asked FROM orders),
n AS (SELECT *, CASE WHEN asked >= 1 THEN CASE WHEN (h - (asked + 1) * {_SLAB}) / asked < {_LEAST} THEN greatest(1, floor((h - {_SLAB}) / ({_LEAST} + {_SLAB}))) ELSE asked END
  WHEN h < 2 * {_SLAB} + {_CLEAR} THEN 1 ELSE floor((h - 2 * {_SLAB} - {_CLEAR}) / ({_CLEAR} + {_SLAB})) + 1 END AS n FROM o)
SELECT o_orderkey, CAST(n AS INTEGER) AS floors,
  round(CASE WHEN asked >= 1 THEN (h - (n + 1) * {_SLAB}) / n WHEN h < 2 * {_SLAB} + {_CLEAR} THEN greatest(h - 2 * {_SLAB}, {_CLEAR} / 2) ELSE h - 2 * {_SLAB} - (n - 1) * ({_CLEAR} + {_SLAB}) END, 6) AS ground,
  round(CASE WHEN asked >= 1 THEN (h - (n + 1) * {_SLAB}) / n ELSE {_CLEAR} END, 6) AS upper
FROM n
"""


def line_bottoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slab lines of each supplier's building, from its middle, with the clear height above each."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", (F.abs("s_acctbal") / 50 + 30).alias("h")).withColumn("f", building.floor_plan(C("h"), F.lit(None)))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1), C("f.floors") + 1)))
    bottom = building.line_bottom(C("h"), C("f.ground"), C("f.upper"), C("k"))
    clear = F.when(C("k") <= C("f.floors"), building.clear_of(C("f.ground"), C("f.upper"), C("k")))
    return rows.select("s_suppkey", "k", F.round(bottom, R).alias("bottom"), F.round(clear, R).alias("clear"))


LINES_SQL = f"""
WITH b AS (SELECT s_suppkey, abs(s_acctbal) / 50 + 30 AS h FROM supplier),
n AS (SELECT *, CASE WHEN h < 2 * {_SLAB} + {_CLEAR} THEN 1 ELSE floor((h - 2 * {_SLAB} - {_CLEAR}) / ({_CLEAR} + {_SLAB})) + 1 END AS n FROM b),
g AS (SELECT *, CASE WHEN h < 2 * {_SLAB} + {_CLEAR} THEN greatest(h - 2 * {_SLAB}, {_CLEAR} / 2) ELSE h - 2 * {_SLAB} - (n - 1) * ({_CLEAR} + {_SLAB}) END AS ground FROM n),
k AS (SELECT *, unnest(generate_series(1, CAST(n AS BIGINT) + 1)) AS k FROM g)
SELECT s_suppkey, CAST(k AS INTEGER) AS k, round(CASE WHEN k = 1 THEN 0 ELSE {_SLAB} + ground + (k - 2) * ({_CLEAR} + {_SLAB}) END - h / 2, 6) AS bottom, round(CASE WHEN k = 1 THEN ground WHEN k <= n THEN {_CLEAR} END, 6) AS clear FROM k
"""

SHOTS = """SELECT event_id, CAST(event_id * 37 % 2999 + floor(event_id / 10000) * 4000 AS DOUBLE) AS sx, CAST(event_id % 90 AS DOUBLE) AS sy, CAST(event_id * 91 % 2971 AS DOUBLE) AS sz,
  CAST(event_id % 7 AS DOUBLE) - 3 AS dx, CAST(event_id % 3 AS DOUBLE) - 1 AS dy, CAST(event_id % 5 AS DOUBLE) - 2 AS dz FROM {t}"""


def _shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, SHOTS, "events")
    return rows.select("event_id", motion.vector(C("sx"), C("sy"), C("sz")).alias("start"), motion.vector(C("dx"), C("dy"), C("dz")).alias("direction"))


def trajectory_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where hits end and what speed they give; none for a direction of no length."""
    rows = _shots(spark, sf_dir).select("event_id", motion.endpoint(C("start"), C("direction")).alias("p"), motion.launch(C("direction")).alias("v"))
    return rows.select("event_id", *_round("p.x", "p.y", "p.z"), *(F.round(f"v.{a}", R).alias(f"v{a}") for a in "xyz"))


ENDPOINT_SQL = f"""
WITH s AS ({SHOTS.format(t="events")}), u AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS n FROM s),
d AS (SELECT event_id, sx, sy, sz, CASE WHEN n > 0 THEN dx / n END AS x, CASE WHEN n > 0 THEN dy / n END AS y, CASE WHEN n > 0 THEN dz / n END AS z FROM u),
e AS (SELECT *, sy + y * 600 < 0 AND y < 0 AS below, CASE WHEN y <> 0 THEN sy / -y END AS met, sqrt(x * x + z * z) AS flat FROM d),
o AS (SELECT *, CASE WHEN flat > 0.01 AND 600 > met THEN (600 - met) / flat ELSE 0 END AS on_ FROM e)
SELECT event_id, round(CASE WHEN below THEN sx + x * met + x * on_ ELSE sx + x * 600 END, 6) AS x, round(CASE WHEN below THEN 0 ELSE sy + y * 600 END, 6) AS y, round(CASE WHEN below THEN sz + z * met + z * on_ ELSE sz + z * 600 END, 6) AS z,
  round(x * 600, 6) AS vx, round(y * 600, 6) AS vy, round(z * 600, 6) AS vz FROM o
"""

TURNED = """SELECT c_custkey AS id, c_nationkey, CAST(c_custkey * 37 % 397 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x, CAST(c_custkey % 50 AS DOUBLE) AS y, CAST(c_custkey * 91 % 401 AS DOUBLE) AS z,
  CAST(4 + c_custkey % 17 AS DOUBLE) AS sx, CAST(3 + c_custkey % 11 AS DOUBLE) AS sy, CAST(5 + c_custkey % 13 AS DOUBLE) AS sz, CAST(c_custkey % 24 AS DOUBLE) / 24 * 3 AS yaw FROM {t}"""


def _turned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, TURNED, "customer")
    return rows.select("id", "c_nationkey", motion.vector(C("x"), C("y"), C("z")).alias("at"), motion.vector(C("sx"), C("sy"), C("sz")).alias("size"), "yaw")


def turned_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World bounds of turned boxes by their corners; the half extents and the vertical reach give the same."""
    rows = _turned(spark, sf_dir).withColumn("half", motion.half_extents(C("size"), C("yaw")))
    corner = F.explode(F.array(*(motion.to_world(motion.mapped(lambda v: v / 2, motion.vector(C("size.x") * i, C("size.y"), C("size.z") * j)), C("at"), C("yaw")) for i in (-1, 1) for j in (-1, 1))))
    upright = motion.vertical_reach(C("size"), motion.vector(F.lit(0), F.lit(1), F.lit(0)))
    found = rows.select("id", "at", "half", upright.alias("reach"), corner.alias("p")).groupBy("id", "at", "half", "reach").agg(F.min("p.x").alias("x0"), F.max("p.x").alias("x1"), F.min("p.z").alias("z0"), F.max("p.z").alias("z1"))
    same = (F.abs(C("x1") - C("at.x") - C("half.x")) < 1e-9) & (F.abs(C("z0") - C("at.z") + C("half.z")) < 1e-9)
    return found.select("id", *_round("x0", "x1", "z0", "z1"), same.alias("same"), F.round(C("at.y") - C("reach"), R).alias("bottom"), F.round(C("at.y") + C("reach"), R).alias("top"))


TURNED_SQL = f"""
WITH t AS ({TURNED.format(t="customer")}), h AS (SELECT *, (sx * abs(cos(yaw)) + sz * abs(sin(yaw))) / 2 AS hx, (sx * abs(sin(yaw)) + sz * abs(cos(yaw))) / 2 AS hz FROM t)
SELECT id, round(x - hx, 6) AS x0, round(x + hx, 6) AS x1, round(z - hz, 6) AS z0, round(z + hz, 6) AS z1, true AS same, round(y - sy / 2, 6) AS bottom, round(y + sy / 2, 6) AS top FROM h
"""


def oriented_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box around each nation's boxes in the frame of its largest one: local sizes and the world middle."""
    found = ring_ops.oriented_box(_turned(spark, sf_dir), ["c_nationkey"])
    return found.select("c_nationkey", *_round("yaw"), *(F.round(f"size.{a}", R).alias(f"s{a}") for a in "xyz"), *(F.round(f"at.{a}", R).alias(a) for a in "xyz"))


ORIENTED_SQL = f"""
WITH t AS ({TURNED.format(t="customer")}), l AS (SELECT c_nationkey, arg_max(yaw, (sx * sy * sz, -id)) AS f FROM t GROUP BY c_nationkey),
q AS (SELECT c_nationkey, f, y, sy, x * cos(f) - z * sin(f) AS u, x * sin(f) + z * cos(f) AS w, (sx * abs(cos(yaw - f)) + sz * abs(sin(yaw - f))) / 2 AS hu, (sx * abs(sin(yaw - f)) + sz * abs(cos(yaw - f))) / 2 AS hw FROM t JOIN l USING (c_nationkey)),
b AS (SELECT c_nationkey, f, min(u - hu) AS u0, max(u + hu) AS u1, min(w - hw) AS w0, max(w + hw) AS w1, min(y - sy / 2) AS y0, max(y + sy / 2) AS y1 FROM q GROUP BY ALL)
SELECT c_nationkey, round(f, 6) AS yaw, round(u1 - u0, 6) AS sx, round(y1 - y0, 6) AS sy, round(w1 - w0, 6) AS sz,
  round((u0 + u1) / 2 * cos(f) + (w0 + w1) / 2 * sin(f), 6) AS x, round((y0 + y1) / 2, 6) AS y, round((w0 + w1) / 2 * cos(f) - (u0 + u1) / 2 * sin(f), 6) AS z FROM b
"""


def turned_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_ops.turned_overlaps(_turned(spark, sf_dir), cell=32.0)


OVERLAP_SQL = f"""
WITH t AS ({TURNED.format(t="customer")}),
p AS (SELECT a.id AS a, b.id AS b, b.x - a.x AS dx, b.z - a.z AS dz, a.yaw AS ya, b.yaw AS yb, a.sx AS ax, a.sz AS az, b.sx AS bx, b.sz AS bz, abs(cos(b.yaw - a.yaw)) AS c, abs(sin(b.yaw - a.yaw)) AS s
  FROM t a JOIN t b ON a.id < b.id AND abs(a.y - b.y) < (a.sy + b.sy) / 2 - 0.001::DOUBLE AND abs(a.x - b.x) < 40 AND abs(a.z - b.z) < 40)
SELECT a, b FROM p WHERE abs(dx * cos(ya) - dz * sin(ya)) < (ax + bx * c + bz * s) / 2 - 0.001::DOUBLE AND abs(dx * sin(ya) + dz * cos(ya)) < (az + bx * s + bz * c) / 2 - 0.001::DOUBLE
  AND abs(dx * cos(yb) - dz * sin(yb)) < (bx + ax * c + az * s) / 2 - 0.001::DOUBLE AND abs(dx * sin(yb) + dz * cos(yb)) < (bz + ax * s + az * c) / 2 - 0.001::DOUBLE
"""


def core_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cores of rectangles as wide as a part's size and price say, and their six pieces."""
    rows = table(spark, sf_dir, "part").select("p_partkey", (C("p_size") + 5.0).alias("w"), (C("p_retailprice") / 10 + 5).alias("d"))
    small = (C("w") < 150) & (C("d") < 150)
    rows = rows.select("p_partkey", *(building.core_size(C(v), small, F.lit(20.0)).alias(v) for v in "wd"))
    pieces = building.core_pieces(F.lit(1.0), F.lit(-2.0), C("w"), C("d"))
    return rows.select("p_partkey", F.inline(pieces)).select("p_partkey", "name", *_round("x", "z", "sx", "sz"))


_M = "(1::DOUBLE / 0.28::DOUBLE)"
CORE_SQL = f"""
WITH r AS (SELECT p_partkey, p_size + 5.0::DOUBLE AS w, p_retailprice / 10 + 5 AS d FROM part), s AS (SELECT *, CASE WHEN w < 150 AND d < 150 THEN 0.35::DOUBLE ELSE 0.4::DOUBLE END AS q FROM r),
c AS (SELECT p_partkey, greatest(2, least(greatest(w * q, w - 40, least(4 * {_M}, w * 0.5::DOUBLE)), greatest(2, w - 2))) AS w, greatest(2, least(greatest(d * q, d - 40, least(4 * {_M}, d * 0.5::DOUBLE)), greatest(2, d - 2))) AS d FROM s),
p AS (SELECT p_partkey, 'CoreWallFront' AS name, 0 AS dx, d / 2 AS dz, w + 1 AS sx, 1 AS sz FROM c UNION ALL SELECT p_partkey, 'CoreWallBack', 0, -d / 2, w + 1, 1 FROM c
  UNION ALL SELECT p_partkey, 'CoreWallRight', w / 2, 0, 1, d - 1 FROM c UNION ALL SELECT p_partkey, 'CoreWallLeft', -w / 2, 0, 1, d - 1 FROM c
  UNION ALL SELECT p_partkey, 'CoreDividerX', 0, 0, w - 1, 1 FROM c UNION ALL SELECT p_partkey, 'CoreDividerZ', 0, 0, 1, d - 1 FROM c)
SELECT p_partkey, name, round(1 + dx, 6) AS x, round(-2 + dz, 6) AS z, round(CAST(sx AS DOUBLE), 6) AS sx, round(CAST(sz AS DOUBLE), 6) AS sz FROM p
"""


def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of positions, their suffixes and seeds; and what names and messages say."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", (C("c_custkey") % 16).alias("mesh"), (C("c_acctbal") / 7).alias("x"), (C("c_nationkey") / 4 + 0.05).alias("y"), (-C("c_acctbal") / 3).alias("z"))
    rows = rows.withColumn("key", F.when(C("c_custkey") % 5 > 0, building.source_key(C("mesh"), C("x"), C("y"), C("z"))).otherwise("Global_1"))
    name = F.concat(F.lit("Floor"), C("c_custkey").cast("string"), F.when(C("c_custkey") % 3 == 0, "x").otherwise(""))
    message = F.concat(F.when(C("c_custkey") % 2 == 0, "Workspace.Module:12: ").otherwise(""), F.lit("too few floors: "), C("c_nationkey").cast("string"))
    return rows.select("c_custkey", "key", building.key_suffix(C("key")).alias("suffix"), building.position_seed(C("x"), C("y"), C("z")).alias("seed"), building.floor_number(name).alias("floor"), building.plain_reason(message).alias("reason"))


KEYS_SQL = r"""
WITH r AS (SELECT c_custkey, c_nationkey, c_acctbal / 7 AS x, c_nationkey / 4 + 0.05::DOUBLE AS y, -c_acctbal / 3 AS z FROM customer),
k AS (SELECT *, CASE WHEN c_custkey % 5 > 0 THEN concat_ws('_', c_custkey % 16, CAST(round(x * 10) AS BIGINT), CAST(round(y * 10) AS BIGINT), CAST(round(z * 10) AS BIGINT)) ELSE 'Global_1' END AS key FROM r)
SELECT c_custkey, key, CASE WHEN c_custkey % 5 > 0 THEN substr(key, strpos(key, '_') + 1) END AS suffix,
  CAST((CAST(floor(x * 73856093 + y * 19349663 + z * 83492791) AS HUGEINT) % 2147483648 + 2147483648) % 2147483648 AS BIGINT) AS seed,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS INTEGER) END AS floor, concat('too few floors: ', c_nationkey) AS reason FROM k
"""


def plan_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", (C("p_size") / 50).alias("c"), C("p_retailprice").alias("a"), (C("p_partkey") % 300 + 1).alias("h"), (C("p_partkey") % 6 + 1).alias("n"))
    rows = rows.withColumn("confidence", building.cluster_confidence(C("c"), C("n")))
    return rows.select("p_partkey", F.round("confidence", R).alias("confidence"), F.round(building.selection_score(C("confidence"), C("a"), C("h"), C("n")), 4).alias("score"), F.round(building.clamped(C("c") * 1.5 - 0.2, 0.0, 1.0), R).alias("clamped"))


SCORES_SQL = """
WITH r AS (SELECT p_partkey, greatest(0, p_size / 50 - greatest(0, p_partkey % 6 + 1 - 2) * 0.005::DOUBLE) AS confidence, p_size / 50 AS c, p_retailprice AS a, p_partkey % 300 + 1 AS h, p_partkey % 6 + 1 AS n FROM part)
SELECT p_partkey, round(confidence, 6) AS confidence, round(pow(confidence, 3) * sqrt(a) * h * (1 + n * 0.05::DOUBLE), 4) AS score, round(greatest(0, least(1, c * 1.5::DOUBLE - 0.2::DOUBLE)), 6) AS clamped FROM r
"""

SOLIDS = """SELECT c_custkey AS id, CAST(c_custkey % 21 AS DOUBLE) - 10 AS x, CAST(c_custkey * 3 % 17 AS DOUBLE) - 8 AS y, CAST(c_custkey * 7 % 19 AS DOUBLE) - 9 AS z,
  CAST(8 + c_nationkey AS DOUBLE) AS sx, CAST(6 + c_custkey % 9 AS DOUBLE) AS sy, CAST(7 + c_custkey % 10 AS DOUBLE) AS sz, c_custkey % 2 = 0 AS wedge FROM {t}"""


def solid_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, SOLIDS, "customer")
    return rows.select("id", motion.in_solid(motion.vector(C("x"), C("y"), C("z")), motion.vector(C("sx"), C("sy"), C("sz")), C("wedge")).alias("inside"))


SOLIDS_SQL = f"""WITH s AS ({SOLIDS.format(t="customer")})
SELECT id, abs(x) <= sx / 2 AND abs(y) <= sy / 2 AND abs(z) <= sz / 2 AND (NOT wedge OR y / sy <= z / sz) AS inside FROM s"""

#: A box without its upper right quarter, for each customer.
ELLS = """SELECT c_custkey AS id, CAST(c_custkey * 37 % 397 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x0, CAST(c_custkey * 91 % 401 AS DOUBLE) AS z0, CAST(8 + c_custkey % 17 AS DOUBLE) AS w, CAST(6 + c_custkey % 13 AS DOUBLE) AS d FROM {t}"""


def _ells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lambda i, j: rings.point(C("x0") + C("w") * i / 2, C("z0") + C("d") * j / 2)
    rows = _view(spark, sf_dir, ELLS, "customer")
    return rows.withColumn("ring", F.array(p(0, 0), p(2, 0), p(2, 1), p(1, 1), p(1, 2), p(0, 2)))


def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each L-shaped ring how many supplier points it covers, borders included; and the share of points in any."""
    points = _view(spark, sf_dir, "SELECT p_partkey AS pid, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM {t}", "part")
    covered = ring_ops.covered_points(points, "pid", _ells(spark, sf_dir), "id", cell=16.0)
    return covered.groupBy("id").agg(F.count("*").alias("n"), F.min("pid").alias("first"))


_IN_ELL = "p.x BETWEEN e.x0 AND e.x0 + e.w AND p.z BETWEEN e.z0 AND e.z0 + e.d AND NOT (p.x > e.x0 + e.w / 2 + 1e-5 AND p.z > e.z0 + e.d / 2 + 1e-5)"
POINTS_SQL = f"""
WITH e AS ({ELLS.format(t="customer")}), p AS (SELECT p_partkey AS pid, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM part)
SELECT id, count(*) AS n, min(pid) AS first FROM e JOIN p ON {_IN_ELL} GROUP BY id
"""


def point_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each brand's points that any ring covers; a point counts once."""
    points = _view(spark, sf_dir, "SELECT p_partkey AS pid, p_brand, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM {t}", "part")
    return ring_ops.coverage(points, "pid", ["p_brand"], _ells(spark, sf_dir), "id", cell=16.0).withColumn("coverage", F.round("coverage", R))


COVERAGE_SQL = f"""
WITH e AS ({ELLS.format(t="customer")}), p AS (SELECT p_partkey AS pid, p_brand, CAST(p_partkey * 53 % 421 + floor(p_partkey / 2000) * 4000 AS DOUBLE) AS x, CAST(p_partkey * 29 % 419 AS DOUBLE) AS z FROM part),
h AS (SELECT DISTINCT pid FROM p JOIN e ON {_IN_ELL})
SELECT p_brand, count(*) AS points, count(h.pid) AS covered, round(count(h.pid) / count(*), 6) AS coverage FROM p LEFT JOIN h ON p.pid = h.pid GROUP BY p_brand
"""


def ring_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds, middle, simplicity and squareness of L-shapes, boxes and bow ties."""
    rows = _ells(spark, sf_dir)
    box = rings.box_ring(C("x0"), C("z0"), C("x0") + C("w"), C("z0") + C("d"))
    tie = F.array(box[0], box[2], box[1], box[3])
    ring = F.when(C("id") % 3 == 0, C("ring")).when(C("id") % 3 == 1, box).otherwise(tie)
    rows = rows.withColumn("r", ring).withColumn("b", rings.bounds(C("r"))).withColumn("m", rings.centroid(C("r")))
    tip = rings.in_triangle(rings.point(C("x0") + 2, C("z0") + 2), box[0], box[1], box[3])
    return rows.select("id", "b.x0", "b.z0", "b.x1", "b.z1", *(F.round(f"m.{v}", R).alias(f"m{v}") for v in "xz"), rings.simple(C("r")).alias("simple"), rings.is_rectangle(C("r")).alias("rectangle"), tip.alias("tip"))


MEASURES_SQL = f"""WITH e AS ({ELLS.format(t="customer")})
SELECT id, x0, z0, x0 + w AS x1, z0 + d AS z1, round(x0 + w / 2 * CASE WHEN id % 3 = 0 THEN 6.0::DOUBLE / 6 ELSE 1 END, 6) AS mx, round(z0 + d / 2, 6) AS mz, id % 3 < 2 AS simple, id % 3 = 1 AS rectangle, 2 / w + 2 / d <= 1 AS tip FROM e"""


def ring_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of three sizes against the L-shape they stand in: by probes, exactly, and as cells."""
    s = F.explode(F.array(*map(F.lit, (0.25, 0.5, 0.6))))
    rows = _ells(spark, sf_dir).withColumn("s", s)
    x0, z0, x1, z1 = C("x0") + C("w") * (1 - C("s")) * (C("id") % 3) / 2, C("z0") + C("d") * (1 - C("s")) * (F.floor(C("id") / 3) % 3) / 2, C("w") * C("s"), C("d") * C("s")
    rows = rows.select("id", "s", "ring", x0.alias("a0"), z0.alias("c0"), (x0 + x1).alias("a1"), (z0 + z1).alias("c1"))
    inner = rings.box_ring(C("a0"), C("c0"), C("a1"), C("c1"))
    return rows.select("id", "s", rings.contains_probe(C("ring"), inner).alias("probe"), rings.contains_ring(C("ring"), inner).alias("exact"), rings.contains_box(C("ring"), C("a0"), C("c0"), C("a1"), C("c1")).alias("cell"))


CONTAIN_SQL = f"""
WITH e AS (SELECT *, unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.6::DOUBLE]) AS s FROM ({ELLS.format(t="customer")})),
c AS (SELECT id, s, (1 - s) * (id % 3) / 2 + s <= 0.5000001 OR (1 - s) * (id // 3 % 3) / 2 + s <= 0.5000001 AS inside FROM e)
SELECT id, s, inside AS probe, inside AS exact, inside AS cell FROM c
"""


def shape_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each box against itself moved to the right by a part of its width, and whether the two are alike."""
    rows = _ells(spark, sf_dir).withColumn("by", C("w") * (C("id") % 4) / 20)
    box = lambda by: rings.box_ring(C("x0") + by, C("z0"), C("x0") + C("w") + by, C("z0") + C("d"))
    shape = lambda by: F.struct(box(by).alias("ring"), (C("w") * C("d")).alias("area"), F.least("w", "d").alias("width"))
    rows = rows.select("id", shape(F.lit(0.0)).alias("p"), shape(C("by")).alias("q"))
    return rows.select("id", F.round(rings.shape_distance(C("p.ring"), C("q.ring")), R).alias("apart"), rings.similar(C("p"), C("q")).alias("alike"))


SHAPES_SQL = f"""WITH e AS (SELECT *, w * (id % 4) / 20 AS by_ FROM ({ELLS.format(t="customer")}))
SELECT id, round(by_, 6) AS apart, by_ <= greatest(1.5::DOUBLE, least(w, d) * 0.035::DOUBLE) AS alike FROM e"""

SQL = {
    floor_math: FLOOR_SQL, line_bottoms: LINES_SQL, trajectory_endpoint: ENDPOINT_SQL, turned_bounds: TURNED_SQL, oriented_boxes: ORIENTED_SQL, turned_overlaps: OVERLAP_SQL, core_parts: CORE_SQL,
    source_keys: KEYS_SQL, plan_scores: SCORES_SQL, solid_probes: SOLIDS_SQL, point_in_polygon: POINTS_SQL, point_coverage: COVERAGE_SQL, ring_measures: MEASURES_SQL, ring_containment: CONTAIN_SQL, shape_distances: SHAPES_SQL,
}
