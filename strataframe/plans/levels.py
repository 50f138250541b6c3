"""Registered queries: nearest joins and the levels of models, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import floors, nearest
from strataframe.plans.drawn import table


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


POINT = "CAST({k} * 37 % 9973 AS DOUBLE) AS x, CAST({k} * 91 % 9967 AS DOUBLE) AS z"


def _points(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return _t(spark, sf_dir, name).selectExpr(f"{key} AS id", *POINT.format(k=key).split(", "))


def nearest_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_within(_points(spark, sf_dir, "customer", "c_custkey"), _points(spark, sf_dir, "supplier", "s_suppkey"), 200.0)


NEAREST_SQL = f"""
WITH p AS (SELECT c_custkey AS id, {POINT.format(k="c_custkey")} FROM customer), t AS (SELECT s_suppkey AS id, {POINT.format(k="s_suppkey")} FROM supplier),
j AS (SELECT p.id, t.id AS target, (p.x - t.x) * (p.x - t.x) + (p.z - t.z) * (p.z - t.z) AS d2 FROM p, t),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, target) AS k FROM j WHERE d2 <= 40000)
SELECT id, target, d2 FROM r WHERE k = 1
"""


def mutual_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.mutual_nearest(_points(spark, sf_dir, "customer", "c_custkey"), 150.0)


MUTUAL_SQL = f"""
WITH p AS (SELECT c_custkey AS id, {POINT.format(k="c_custkey")} FROM customer),
j AS (SELECT p.id, t.id AS near, (p.x - t.x) * (p.x - t.x) + (p.z - t.z) * (p.z - t.z) AS d2 FROM p, p AS t WHERE p.id <> t.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, near) AS k FROM j WHERE d2 <= 22500), n AS (SELECT * FROM r WHERE k = 1)
SELECT a.id AS a, a.near AS b, a.d2 FROM n AS a JOIN n AS b ON a.near = b.id AND b.near = a.id WHERE a.id < b.id
"""
BOXES = """SELECT c_custkey AS id, CAST(c_custkey * 37 % 397 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x0, CAST(c_custkey * 37 % 397 + 3 + c_custkey % 23 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x1,
  CAST(c_custkey % 40 AS DOUBLE) AS y0, CAST(c_custkey % 40 + 20 + c_custkey % 31 AS DOUBLE) AS y1, CAST(c_custkey * 91 % 211 AS DOUBLE) AS z0, CAST(c_custkey * 91 % 211 + 9 AS DOUBLE) AS z1 FROM {t}"""


def cluster_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.cluster_pairs(spark.sql(BOXES.format(t="{c}"), c=_t(spark, sf_dir, "customer")))


CLUSTER_SQL = f"""
WITH b AS ({BOXES.format(t="customer")})
SELECT a.id AS a, b.id AS b FROM b AS a, b WHERE a.id < b.id AND least(a.y1, b.y1) > greatest(a.y0, b.y0)
  AND least(a.y1, b.y1) - greatest(a.y0, b.y0) >= 0.55::DOUBLE * least(a.y1 - a.y0, b.y1 - b.y0) AND (abs(a.y0 - b.y0) <= 12 OR abs(a.y1 - b.y1) <= 30)
  AND sqrt(greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.z0 - b.z1, b.z0 - a.z1) ** 2) <= 6
"""


def same_line_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", (F.col("l_linenumber") % 2).alias("odd"))
    return nearest.same_sets(lines, "l_orderkey", "l_linestatus", "odd")


SETS_SQL = """
WITH s AS (SELECT l_orderkey, l_linestatus, list_sort(list_distinct(list(l_linenumber % 2))) AS members FROM lineitem GROUP BY ALL)
SELECT l_orderkey, count(DISTINCT members) = 1 AS same FROM s GROUP BY l_orderkey
"""


def loose_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    return nearest.loose_ends(lines, [[F.col("l_partkey"), F.col("l_linenumber")], [F.col("l_suppkey"), F.col("l_linenumber")]], ["x", "z"])


LOOSE_SQL = """
SELECT x, z FROM (SELECT l_partkey AS x, l_linenumber AS z FROM lineitem UNION ALL SELECT l_suppkey, l_linenumber FROM lineitem) GROUP BY x, z HAVING count(*) = 1
"""


def roof_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return floors.anchored_bands(_t(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_quantity") / 4).alias("y")), ["l_suppkey"], "y")


BANDS_SQL = """
WITH RECURSIVE d AS (SELECT l_suppkey AS k, l_quantity / 4 AS v, count(*) AS n FROM lineitem GROUP BY ALL),
b(k, low) AS (SELECT k, min(v) FROM d GROUP BY k UNION ALL SELECT b.k, min(d.v) FROM b JOIN d ON d.k = b.k AND d.v - b.low > 0.6 GROUP BY b.k, b.low)
SELECT k AS l_suppkey, low, max(v) AS high, CAST(sum(n) AS BIGINT) AS n FROM (SELECT d.k, d.v, d.n, max(b.low) AS low FROM d JOIN b ON d.k = b.k AND b.low <= d.v GROUP BY ALL) GROUP BY k, low
"""


def tier_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return floors.tier_floors(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), ["l_orderkey"], "l_quantity", 3.0, 16)


TIER_SQL = """
WITH RECURSIVE u AS (SELECT DISTINCT l_orderkey, l_quantity FROM lineitem WHERE l_quantity IS NOT NULL),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS INTEGER) AS tier, count(*) OVER (PARTITION BY l_orderkey) AS n FROM u),
f AS (SELECT l_orderkey, l_quantity, tier, n, CAST(1 AS BIGINT) AS first_floor FROM t WHERE tier = 1 AND n <= 16
  UNION ALL SELECT t.l_orderkey, t.l_quantity, t.tier, t.n, least(greatest(CAST(ceil(t.l_quantity / 3.0::DOUBLE + 0.5::DOUBLE - 1e-9) AS BIGINT), f.first_floor + 1), 16 - (t.n - t.tier)) FROM f JOIN t ON t.l_orderkey = f.l_orderkey AND t.tier = f.tier + 1)
SELECT l_orderkey, tier, l_quantity, first_floor FROM f
"""


def flag_oscillation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("l_returnflag"))
    return floors.oscillating(lines, ["l_orderkey"], "l_linenumber", "l_returnflag")


OSCILLATION_SQL = """
WITH u AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS f FROM lineitem GROUP BY ALL),
l AS (SELECT l_orderkey, f, CASE WHEN lag(f) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = f THEN 0 ELSE 1 END AS new FROM u)
SELECT l_orderkey, max(runs) > 1 AS oscillates FROM (SELECT l_orderkey, f, sum(new) AS runs FROM l GROUP BY ALL) GROUP BY l_orderkey
"""


def event_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return floors.drift(_t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"], "value", 0.03)


DRIFT_SQL = """
WITH f AS (SELECT user_id, abs(value - first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS off FROM events)
SELECT user_id, max(off) AS drift, count(*) FILTER (off > 0.03::DOUBLE) AS n_off FROM f WHERE user_id IS NOT NULL GROUP BY user_id
"""


def supported_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return floors.highest_supported(lines, ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R", "l_quantity")


SUPPORTED_SQL = """
WITH m AS (SELECT *, max(l_linenumber) FILTER (l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS top FROM lineitem)
SELECT l_orderkey, any_value(top) AS top, count(*) FILTER (top IS NULL OR l_linenumber > top) AS tail,
  CASE WHEN any_value(top) IS NULL THEN 'no repeated major footprint' WHEN max(l_quantity) FILTER (l_linenumber > top) > max(l_quantity) FILTER (l_linenumber = top) * 0.65::DOUBLE THEN 'unsupported substantial upper body' END AS reason FROM m GROUP BY l_orderkey
"""


def wall_orientations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    found = floors.orientations(parts, ["p_brand"], (F.col("p_partkey") % 17 - 8).cast("double"), (F.col("p_size") - 25).cast("double"), "p_partkey")
    return found.select("p_brand", "key", "weight", F.round("ux", 6).alias("ux"), F.round("uz", 6).alias("uz"))


ORIENTATION_SQL = """
WITH v AS (SELECT p_partkey, p_brand, CAST(p_partkey % 17 - 8 AS DOUBLE) AS dx, CAST(p_size - 25 AS DOUBLE) AS dz FROM part),
a AS (SELECT *, sqrt(dx * dx + dz * dz) AS len, (atan2(dz, dx) % (pi() / 2) + pi() / 2) % (pi() / 2) AS angle FROM v),
g AS (SELECT p_brand, CAST(round(angle * 720 / pi()) AS BIGINT) AS key, round(sum(len), 6) AS weight, round(arg_min(dx / len, p_partkey), 6) AS ux, round(arg_min(dz / len, p_partkey), 6) AS uz FROM a WHERE len > 1 GROUP BY 1, 2)
SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY weight DESC, key) <= 12
"""


def facade_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turned rectangles of edges, some with a side cut short or with an edge inside, and what of them four covered sides support."""
    rows = spark.sql(WALLS, c=_t(spark, sf_dir, "customer"))
    found = floors.supported_rectangles(rows, ["id"], "n")
    return found.select("id", F.round(F.greatest(F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")), 4).alias("long"), F.round(F.least(F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")), 4).alias("short"))


#: Four sides and one edge inside for each customer, w by d and turned; the first side is cut for each fourth, the inner edge is long for each seventh.
WALLS = """WITH b AS (SELECT c_custkey AS id, 10.0D + c_custkey % 17 AS w, 6.0D + c_custkey % 4 AS d, c_custkey % 5 * 0.6D AS t, CASE WHEN c_custkey % 4 = 1 THEN 0.9D ELSE 1.0D END AS cut, CASE WHEN c_custkey % 7 = 2 THEN 4.0D ELSE 0.5D END AS n5 FROM {c}),
s AS (SELECT id, t, stack(5, 1, 0D, 0D, w * cut, 0D, 2, w, 0D, w, d, 3, w, d, 0D, d, 4, 0D, d, 0D, 0D, 5, 3D, 2.5D, 3 + n5, 2.5D) AS (n, p, q, r, s) FROM b)
SELECT id, n, p * cos(t) - q * sin(t) AS ax, p * sin(t) + q * cos(t) AS az, r * cos(t) - s * sin(t) AS bx, r * sin(t) + s * cos(t) AS bz FROM s"""
FACADE_SQL = """SELECT c_custkey AS id, 10.0::DOUBLE + c_custkey % 17 AS long, 6.0::DOUBLE + c_custkey % 4 AS short FROM customer WHERE c_custkey % 4 <> 1
AND CASE WHEN c_custkey % 7 = 2 THEN 4 ELSE 0.5 END <= 2 * (16 + c_custkey % 17 + c_custkey % 4) * 0.045"""


def part_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of sizes around the thresholds, and which of them are fragments."""
    rows = spark.sql(SECTIONS.format(t="{p}"), p=_t(spark, sf_dir, "part"))
    return floors.fragments(rows, floors.fragment_rules()).select("p_partkey", F.array_join("reasons", ",").alias("reasons"), "fragment")


SECTIONS = """SELECT p_partkey, CAST(p_size * 10 AS DOUBLE) AS floor_area, p_retailprice * 24 AS envelope_volume, CAST(p_size * p_partkey % 13000 AS DOUBLE) AS slab_volume,
  CASE WHEN p_partkey % 5 > 0 THEN CAST(p_partkey % 41 AS DOUBLE) END AS clearance, CAST(p_partkey % 90 AS DOUBLE) AS height, p_partkey % 3 > 0 AS has_core FROM {t}"""
FRAGMENT_SQL = f"""
WITH r AS (SELECT p_partkey, floor_area <= 250 AS a, envelope_volume <= 24000 AS e, slab_volume <= 6000 AS s, coalesce(clearance >= 20, false) AS v, height <= 35 AS h, NOT has_core AS c FROM ({SECTIONS.format(t="part")}))
SELECT p_partkey, concat_ws(',', CASE WHEN a THEN 'area' END, CASE WHEN e THEN 'envelope' END, CASE WHEN s THEN 'slabs' END, CASE WHEN v THEN 'elevated' END, CASE WHEN h THEN 'short' END, CASE WHEN c THEN 'no_core' END) AS reasons,
  a AND (e OR s) AND (v OR h OR c) AS fragment FROM r
"""

def fragment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the sections, and of the fragments among them, fall in each bucket of each figure."""
    rows = spark.sql(SECTIONS.format(t="{p}"), p=_t(spark, sf_dir, "part"))
    judged = floors.fragments(rows, floors.fragment_rules()).withColumnRenamed("clearance", "ground_clearance").withColumn("floors", F.floor(F.col("height") / 4))
    return floors.fragment_report(judged)


_BUCKETS = ", ".join(f"('{name}', {k}, {bounds[k - 1] if k else '-1e308'}::DOUBLE, {b if b is not None else 1e308}::DOUBLE, {b if b is not None else 'NULL'}::DOUBLE)" for name, bounds in floors.CLEANUP_BOUNDS.items() for k, b in enumerate([*bounds, None]))
_FIGURES = " UNION ALL ".join(f"SELECT '{name}' AS name, CAST({column} AS DOUBLE) AS v, p_partkey FROM s" for name, column in (("floor_area", "floor_area"), ("envelope_volume", "envelope_volume"), ("slab_volume", "slab_volume"), ("height", "height"), ("ground_clearance", "clearance"), ("floors", "floor(height / 4)")))
REPORT_SQL = f"""
WITH s AS ({SECTIONS.format(t="part")}), f AS (SELECT p_partkey, fragment FROM ({FRAGMENT_SQL})),
v AS ({_FIGURES}), b(name, bucket, low, high, upto) AS (VALUES {_BUCKETS})
SELECT b.name, CAST(b.bucket AS INTEGER) AS bucket, b.upto, count(*) AS n, count(*) FILTER (f.fragment) AS fragments FROM v JOIN b ON b.name = v.name AND v.v > b.low AND v.v <= b.high JOIN f ON f.p_partkey = v.p_partkey GROUP BY 1, 2, 3
"""

SQL = {
    fragment_report: REPORT_SQL,
    nearest_supplier: NEAREST_SQL, mutual_customers: MUTUAL_SQL, cluster_candidates: CLUSTER_SQL, same_line_sets: SETS_SQL, loose_keys: LOOSE_SQL, roof_bands: BANDS_SQL, tier_starts: TIER_SQL,
    flag_oscillation: OSCILLATION_SQL, event_drift: DRIFT_SQL, supported_lines: SUPPORTED_SQL, wall_orientations: ORIENTATION_SQL, facade_rectangles: FACADE_SQL, part_fragments: FRAGMENT_SQL,
}
