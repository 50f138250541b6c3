"""Registered queries: hits, joins of boxes, selection, audits and trees on the star-schema tables, with equal SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import building, motion
from strataframe.operators import audit, hits, nearest, select
from strataframe.plans.levels import BOXES, CLUSTER_SQL
from strataframe.plans.scalars import SHOTS, _shots, _view
from strataframe.plans.drawn import table

C = F.col
R = 6


def _box(x: str, y: str, z: str) -> Column:
    return motion.vector(C(x), C(y), C(z))


#: Buildings are boxes by customer, with three parts on top of each other; here as elsewhere the ground that shapes lie on grows with the table.
TOWERS = """SELECT c_custkey AS building, CAST(c_custkey * 37 % 2999 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(c_custkey * 91 % 2971 AS DOUBLE) AS z0,
  CAST(c_custkey * 37 % 2999 + 4 + c_custkey % 13 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x1, CAST(30 + c_custkey % 50 AS DOUBLE) AS y1, CAST(c_custkey * 91 % 2971 + 5 + c_custkey % 7 AS DOUBLE) AS z1 FROM {t}"""


def _towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TOWERS, "customer").select("building", _box("x0", "y0", "z0").alias("lo"), _box("x1", "y1", "z1").alias("hi"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of events, 90 long."""
    shots = _shots(spark, sf_dir).filter(motion.length(C("direction")) > 0)
    return shots.select(C("event_id").alias("hit"), "start", motion.mapped(lambda s, d: s + d * 90.0, C("start"), motion.unit(C("direction"))).alias("end"))


_SEGMENTS = f"""s AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS n FROM ({SHOTS.format(t="events")})),
h AS (SELECT event_id AS hit, sx, sy, sz, sx + dx / n * 90.0::DOUBLE AS ex, sy + dy / n * 90.0::DOUBLE AS ey, sz + dz / n * 90.0::DOUBLE AS ez FROM s WHERE n > 0)"""


def _sql_distance(x: str, y: str, z: str) -> str:
    """Distance of a point to the segment of h."""
    d = "((ex - sx) * (ex - sx) + (ey - sy) * (ey - sy) + (ez - sz) * (ez - sz))"
    t = f"greatest(0, least(1, (({x} - sx) * (ex - sx) + ({y} - sy) * (ey - sy) + ({z} - sz) * (ez - sz)) / {d}))"
    return f"sqrt(pow({x} - sx - {t} * (ex - sx), 2) + pow({y} - sy - {t} * (ey - sy), 2) + pow({z} - sz - {t} * (ez - sz), 2))"


def capsule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of buildings within 3 and half their diagonal of a hit's segment."""
    towers = _towers(spark, sf_dir)
    third = (C("hi.y") - C("lo.y")) / 3
    at = motion.vector((C("lo.x") + C("hi.x")) / 2, C("lo.y") + third * (C("k") + 0.5), (C("lo.z") + C("hi.z")) / 2)
    size = motion.vector(C("hi.x") - C("lo.x"), third, C("hi.z") - C("lo.z"))
    parts = towers.withColumn("k", F.explode(F.array(*map(F.lit, range(3))))).select((C("building") * 3 + C("k")).alias("part"), "building", at.alias("at"), size.alias("size"))
    found = hits.capsule_hits(_segments(spark, sf_dir), towers, parts, 3.0, cell=64.0)
    return found.groupBy("hit").agg(F.count("*").alias("n"), F.min_by("part", F.struct("distance", "part")).alias("nearest"), F.round(F.min("distance"), R).alias("distance"))


CAPSULE_SQL = f"""
WITH {_SEGMENTS}, b AS ({TOWERS.format(t="customer")}),
c AS (SELECT *, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, (z0 + z1) / 2 AS cz, sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2) + pow(z1 - z0, 2)) / 2 AS r FROM b),
n AS (SELECT * FROM h JOIN c ON abs(cx - sx) < 150 + r AND abs(cz - sz) < 150 + r WHERE {_sql_distance("cx", "cy", "cz")} <= 3 + r),
p AS (SELECT hit, building * 3 + k AS part, {_sql_distance("cx", "(y0 + (y1 - y0) / 3 * (k + 0.5::DOUBLE))", "cz")} AS d, sqrt(pow(x1 - x0, 2) + pow((y1 - y0) / 3, 2) + pow(z1 - z0, 2)) / 2 AS q FROM n, (SELECT unnest([0, 1, 2]) AS k))
SELECT hit, count(*) AS n, arg_min(part, (d, part)) AS nearest, round(min(d), 6) AS distance FROM p WHERE d <= 3 + q GROUP BY hit
"""


def ray_hits_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.surface_hits(_segments(spark, sf_dir), _towers(spark, sf_dir), cell=64.0).select("hit", C("n").cast("int").alias("n"), F.round("t", R).alias("t"))


def _slab(a: str, side: str) -> str:
    other = "e" + a
    return f"CASE WHEN {other} = s{a} THEN {'-1e308' if side == 'least' else '1e308'} ELSE {side}(({a}0 - s{a}) / (({other} - s{a}) / l), ({a}1 - s{a}) / (({other} - s{a}) / l)) END"


RAYS_SQL = f"""
WITH RECURSIVE {_SEGMENTS}, g AS (SELECT *, sqrt(pow(ex - sx, 2) + pow(ey - sy, 2) + pow(ez - sz, 2)) AS l FROM h), b AS ({TOWERS.format(t="customer")}),
q AS (SELECT hit, l, greatest(0, {", ".join(_slab(a, "least") for a in "xyz")}) AS t, least(l, {", ".join(_slab(a, "greatest") for a in "xyz")}) AS u
  FROM g JOIN b ON x0 <= greatest(sx, ex) AND x1 >= least(sx, ex) AND z0 <= greatest(sz, ez) AND z1 >= least(sz, ez) AND (sy BETWEEN y0 AND y1 OR ey <> sy)
  WHERE (ex <> sx OR sx BETWEEN x0 AND x1) AND (ez <> sz OR sz BETWEEN z0 AND z1) AND NOT (sx BETWEEN x0 AND x1 AND sy BETWEEN y0 AND y1 AND sz BETWEEN z0 AND z1)),
o AS (SELECT DISTINCT hit, l, t FROM q WHERE t <= u),
r(hit, l, n, t) AS (SELECT hit, l, 1, min(t) FROM o GROUP BY hit, l
  UNION ALL SELECT r.hit, r.l, r.n + 1, min(o.t) FROM r JOIN o ON o.hit = r.hit AND o.t >= r.t + 1 WHERE r.n < 20 AND r.l - r.t - 1 > 1 GROUP BY r.hit, r.l, r.n)
SELECT hit, n, round(t, 6) AS t FROM r
"""

PIECES = """SELECT l_orderkey AS trail, l_orderkey * 8 + l_linenumber AS piece, CAST(l_partkey % 23 AS DOUBLE) AS x, CAST(l_quantity AS DOUBLE) / 4 AS y, CAST(l_suppkey % 19 AS DOUBLE) AS z,
  CAST(2 + l_partkey % 5 AS DOUBLE) AS sx, CAST(1 + l_suppkey % 4 AS DOUBLE) AS sy, CAST(2 + l_linenumber AS DOUBLE) AS sz FROM {t}"""


def debris_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of an order's trail that stand high above its ground and touch no other."""
    rows = _view(spark, sf_dir, PIECES, "lineitem").groupBy("trail", "piece").agg(*(F.max(c).alias(c) for c in ("x", "y", "z", "sx", "sy", "sz")))
    pieces = rows.select("trail", "piece", _box("x", "y", "z").alias("at"), _box("sx", "sy", "sz").alias("size"))
    return hits.isolated_high(pieces, ["trail"], "piece").select("trail", "piece", F.round("ground", R).alias("ground"))


DEBRIS_SQL = f"""
WITH p AS (SELECT trail, piece, max(x) AS x, max(y) AS y, max(z) AS z, max(sx) AS sx, max(sy) AS sy, max(sz) AS sz FROM ({PIECES.format(t="lineitem")}) GROUP BY ALL),
g AS (SELECT trail, min(y - sy / 2) AS ground FROM p GROUP BY trail), h AS (SELECT p.*, ground FROM p JOIN g ON p.trail = g.trail WHERE y - sy / 2 > ground + 3.5::DOUBLE)
SELECT trail, piece, round(ground, 6) AS ground FROM h WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.trail = h.trail AND p.piece <> h.piece
  AND abs(p.x - h.x) < (p.sx + h.sx) * 0.375::DOUBLE AND abs(p.y - h.y) < (p.sy + h.sy) * 0.375::DOUBLE AND abs(p.z - h.z) < (p.sz + h.sz) * 0.375::DOUBLE)
"""


def box_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of compatible boxes: members, the box around them, and a key with a checksum over the members' keys in order."""
    boxes = spark.sql(BOXES.format(t="{c}"), c=table(spark, sf_dir, "customer"))
    found = nearest.clusters(boxes, "id").join(boxes, "id")
    return nearest.cluster_keys(found, "cluster", C("id").cast("string"))


CLUSTERS_SQL = f"""
WITH RECURSIVE e AS ({CLUSTER_SQL}), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), x AS ({BOXES.format(t="customer")}),
r AS (SELECT id, id AS seed FROM x UNION SELECT u.b, r.seed FROM r JOIN u ON u.a = r.id AND r.seed < u.b), m AS (SELECT id, min(seed) AS cluster FROM r GROUP BY id),
g AS (SELECT cluster, count(*) AS n, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1, min(z0) AS z0, max(z1) AS z1, string_agg(CAST(id AS VARCHAR), '' ORDER BY CAST(id AS VARCHAR)) AS keys FROM m JOIN x USING (id) GROUP BY cluster)
SELECT cluster, n, x0, x1, y0, y1, z0, z1, concat('Global', n, '_', CAST(list_reduce(list_prepend(0, list_transform(string_split(keys, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda s, c: (s * 131 + c) % 1000000007) AS BIGINT), '_',
  CAST(round((x0 + x1) / 2 * 10) AS BIGINT), '_', CAST(round((y0 + y1) / 2 * 10) AS BIGINT), '_', CAST(round((z0 + z1) / 2 * 10) AS BIGINT)) AS key FROM g
"""


def disjoint_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as plans over three sources each, by score: those whose sources no better plan has."""
    p = C("p_partkey")
    plans = table(spark, sf_dir, "part").select(p, building.selection_score(C("p_size") / 50, C("p_retailprice"), p % 300 + 1, F.lit(3)).alias("score"), F.array(p % 997, p * 7 % 997, p * 31 % 997).alias("sources"))
    return select.disjoint(plans, "p_partkey", "score", "sources").select("p_partkey", F.round("score", 4).alias("score"))


DISJOINT_SQL = """
WITH RECURSIVE p AS (SELECT p_partkey, pow(p_size / 50, 3) * sqrt(p_retailprice) * (p_partkey % 300 + 1) * 1.15::DOUBLE AS score, [p_partkey % 997, p_partkey * 7 % 997, p_partkey * 31 % 997] AS sources FROM part),
o AS (SELECT *, row_number() OVER (ORDER BY score DESC, p_partkey) AS n FROM p),
w(n, used, taken, k) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), false, CAST(NULL AS BIGINT)
  UNION ALL SELECT o.n, CASE WHEN list_has_any(used, sources) THEN used ELSE list_concat(used, sources) END, NOT list_has_any(used, sources), p_partkey FROM w JOIN o ON o.n = w.n + 1)
SELECT p_partkey, round(score, 4) AS score FROM w JOIN o ON o.n = w.n WHERE taken
"""


def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would happen to each order, and how often by status and reason."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(C("o_orderstatus") == "F", "skipped").when(C("o_totalprice") < 30000, "failed").when(C("o_orderkey") % 2 == 0, "ready").otherwise("generated")
    rows = orders.withColumn("status", status).withColumn("reason", F.when(C("status") == "failed", building.plain_reason(F.lit("Builder:40: too small"))).when(C("status") == "skipped", "done before"))
    by = select.counts(rows, "status").withColumnRenamed("status", "name").withColumn("kind", F.lit("status"))
    return by.unionByName(select.counts(rows, "reason").withColumnRenamed("reason", "name").withColumn("kind", F.lit("reason")))


STATUS_SQL = """
WITH s AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'skipped' WHEN o_totalprice < 30000 THEN 'failed' WHEN o_orderkey % 2 = 0 THEN 'ready' ELSE 'generated' END AS status FROM orders),
r AS (SELECT *, CASE status WHEN 'failed' THEN 'too small' WHEN 'skipped' THEN 'done before' END AS reason FROM s)
SELECT status AS name, count(*) AS n, 'status' AS kind FROM r GROUP BY 1 UNION ALL SELECT reason, count(*), 'reason' FROM r GROUP BY 1
"""


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 11 to 40 of a report by falling price and key, and the first two parts of each brand by size."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    rows = select.page(parts, [F.desc("p_retailprice"), C("p_partkey")], 11, 40).withColumn("kind", F.lit("page"))
    return rows.unionByName(select.examples(parts, ["p_brand"], [C("p_size"), C("p_partkey")], 2).withColumn("kind", F.lit("example"))).drop("p_retailprice")


PAGES_SQL = """
SELECT p_partkey, p_brand, p_size, 'page' AS kind FROM (SELECT *, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n BETWEEN 11 AND 40
UNION ALL SELECT p_partkey, p_brand, p_size, 'example' FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part) WHERE n <= 2
"""


def repeated_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities that several lines have, edges given either way, and orders with the same set of suppliers, each counted once."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    twice = select.repeated(lines, ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("n"), F.sum("n").alias("total")).withColumn("kind", F.lit("identity"))
    edges = select.distinct_edges(lines.select((C("l_suppkey") % 50).alias("a"), (C("l_partkey") % 50).alias("b")), "a", "b").agg(F.count("*").alias("n"), F.sum(C("a") * 50 + C("b")).alias("total")).withColumn("kind", F.lit("edge"))
    sets = select.distinct_sets(lines.groupBy("l_orderkey").agg(F.collect_list(C("l_suppkey") % 10).alias("m")), "m").agg(F.count("*").alias("n"), F.sum(F.size(F.array_distinct("m"))).alias("total")).withColumn("kind", F.lit("set"))
    return twice.unionByName(edges).unionByName(sets)


REPEATED_SQL = """
WITH r AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
e AS (SELECT DISTINCT least(l_suppkey % 50, l_partkey % 50) AS a, greatest(l_suppkey % 50, l_partkey % 50) AS b FROM lineitem WHERE l_suppkey % 50 <> l_partkey % 50),
s AS (SELECT DISTINCT m FROM (SELECT list_sort(list_distinct(list(l_suppkey % 10))) AS m FROM lineitem GROUP BY l_orderkey))
SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS total, 'identity' AS kind FROM r UNION ALL SELECT count(*), CAST(sum(a * 50 + b) AS BIGINT), 'edge' FROM e UNION ALL SELECT count(*), CAST(sum(len(m)) AS BIGINT), 'set' FROM s
"""


def points_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each supplier's lines as points on a line, those that are more than 2 from the last one kept."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    own = lines.groupBy("l_suppkey").agg(F.collect_set(F.struct(C("l_quantity").alias("x"), F.lit(0.0).alias("z"))).alias("p"))
    return own.select("l_suppkey", F.explode(select.apart(C("p"), 2.0)).alias("p")).select("l_suppkey", "p.x")


APART_SQL = """
WITH RECURSIVE d AS (SELECT DISTINCT l_suppkey, l_quantity AS x FROM lineitem),
k(l_suppkey, x) AS (SELECT l_suppkey, min(x) FROM d GROUP BY l_suppkey UNION ALL SELECT k.l_suppkey, min(d.x) FROM k JOIN d ON d.l_suppkey = k.l_suppkey AND d.x - k.x > 2 GROUP BY k.l_suppkey, k.x)
SELECT l_suppkey, x FROM k
"""


def tree_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a tree (a part is below the one of its key without the last digit), and the buildings in it: what is below one is its own."""
    rows = table(spark, sf_dir, "part").select(C("p_partkey").alias("id"), F.when(C("p_partkey") > 9, (C("p_partkey") / 10).cast("long")).alias("parent"), F.concat(F.when(C("p_partkey") % 7 == 3, "BuildingAuto_").otherwise("Folder_"), C("p_partkey").cast("string")).alias("name"))
    found = select.tree_scan(rows, "id", "parent", C("parent").isNull(), C("name").rlike(building.GENERATED))
    return found.select("id", "depth", "name")


TREE_SQL = """
WITH RECURSIVE t AS (SELECT p_partkey AS id, CASE WHEN p_partkey > 9 THEN p_partkey // 10 END AS parent, p_partkey % 7 = 3 AS stop FROM part),
r AS (SELECT id, stop, 0 AS depth FROM t WHERE parent IS NULL UNION ALL SELECT t.id, t.stop, r.depth + 1 FROM r JOIN t ON t.parent = r.id WHERE NOT r.stop)
SELECT id, depth, concat('BuildingAuto_', id) AS name FROM r WHERE stop
"""

#: Parts of buildings by order: core pieces, slabs and others by line, a floor for every third line.
BUILT = """SELECT l_orderkey % 400 AS model, CAST(CASE WHEN l_linenumber % 7 = 6 AND l_suppkey % 9 = 0 THEN NULL ELSE l_partkey % 4 END AS INT) AS floor, l_orderkey * 8 + l_linenumber AS part,
  CASE WHEN l_linenumber = 1 THEN 'Slab' WHEN l_linenumber = 2 THEN 'CoreWallFront' WHEN l_linenumber = 3 THEN 'CoreWallBack' WHEN l_linenumber = 4 THEN 'CoreWallRight' WHEN l_linenumber = 5 THEN 'CoreWallLeft' WHEN l_linenumber = 6 THEN 'CoreDividerX' ELSE 'CoreDividerZ' END AS name,
  CASE WHEN l_suppkey % 97 = 0 THEN 'mesh' WHEN l_partkey % 5 = 0 THEN 'wedge' ELSE 'block' END AS kind, l_returnflag <> 'R' OR l_linenumber < 7 AS structural, l_linenumber > 1 AS core, l_partkey % 211 <> 0 AS anchored, l_suppkey % 89 <> 1 AS collides,
  CAST(l_quantity AS DOUBLE) / 20 AS sx, CAST(2 AS DOUBLE) AS sy, CAST(l_linenumber AS DOUBLE) / 2 AS sz, CAST(l_partkey % 3 AS DOUBLE) / 50 AS x, CAST(l_linenumber AS DOUBLE) AS z, CAST(l_partkey % 4 AS DOUBLE) * 5 AS y FROM {t}"""


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a part, the least of its lines. Hardly a part has two, so lines are dealt by part before they are compared: nothing would come of doing so in part before."""
    rows = _view(spark, sf_dir, BUILT, "lineitem").repartition("part")
    return rows.groupBy("part").agg(F.min(F.struct(*(c for c in rows.columns if c != "part"))).alias("least")).select("part", "least.*")


_BUILT = f"""q AS ({BUILT.format(t="lineitem")}), p AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY part ORDER BY model NULLS FIRST, floor NULLS FIRST, name, kind, structural, core, anchored, collides, sx, sy, sz, x, z, y) = 1)"""


def structure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.structure_counts(_built(spark, sf_dir))
    area = audit.floor_areas(_built(spark, sf_dir)).groupBy("model").agg(F.max(F.when(C("floor") > 0, C("area"))).alias("largest"), F.sum(F.when(C("floor") == 0, C("area"))).alias("roof"))
    return found.join(area, "model", "left").select("model", "parts", "structural", "cores", "wedges", "slabs", "levels", *(F.round(c, R).alias(c) for c in ("slab_volume", "largest", "roof")))


COUNTS_SQL = f"""
WITH {_BUILT}, s AS (SELECT *, CASE WHEN kind = 'wedge' THEN 0.5::DOUBLE ELSE 1 END AS share FROM p),
a AS (SELECT model, floor, sum(sx * sz * share) AS area FROM s WHERE structural AND name = 'Slab' GROUP BY ALL), b AS (SELECT model, max(area) FILTER (floor > 0) AS largest, sum(area) FILTER (floor = 0) AS roof FROM a GROUP BY model),
c AS (SELECT model, count(*) AS parts, count(*) FILTER (structural) AS structural, count(*) FILTER (structural AND core) AS cores, count(*) FILTER (structural AND kind = 'wedge') AS wedges, count(*) FILTER (structural AND name = 'Slab') AS slabs,
  count(DISTINCT CASE WHEN structural AND name = 'Slab' THEN round(y * 1000) END) AS levels, coalesce(sum(sx * sy * sz * share) FILTER (structural AND name = 'Slab'), 0) AS v FROM s GROUP BY model)
SELECT c.model, parts, structural, cores, wedges, slabs, levels, round(v, 6) AS slab_volume, round(largest, 6) AS largest, round(roof, 6) AS roof FROM c LEFT JOIN b ON c.model = b.model
"""


def structure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each model: by its parts, and by its three floors and the roof."""
    parts = _built(spark, sf_dir)
    models = parts.select("model").distinct().withColumn("floors", F.lit(3))
    return audit.structure_audit(parts, models).select("model", F.array_join("reasons", ",").alias("reasons"))


_N = ", ".join(f"count(*) FILTER (core AND name = '{n}') = 1" for n in audit.CORE_NAMES).replace(", ", " AND ")
STRUCTURE_SQL = f"""
WITH {_BUILT}, f AS (SELECT *, first_value(CASE WHEN structural AND core THEN x END IGNORE NULLS) OVER w AS fx, first_value(CASE WHEN structural AND core THEN z END IGNORE NULLS) OVER w AS fz FROM p WINDOW w AS (PARTITION BY model, name ORDER BY part)),
w AS (SELECT model, bool_or(NOT anchored) AS r1, bool_or(structural AND NOT collides) AS r2, bool_or(structural AND kind = 'mesh') AS r3, bool_or(structural AND least(sx, sy, sz) < 0.05::DOUBLE - 1e-6) AS r4, bool_or(structural AND floor IS NULL) AS r5,
  bool_or(structural AND core AND coalesce(floor, 0) < 1) AS r6, bool_or(structural AND core AND sqrt(pow(x - fx, 2) + pow(z - fz, 2)) > 0.03::DOUBLE) AS r8, count(*) FILTER (structural AND core) AS cores FROM f GROUP BY model),
l AS (SELECT model, floor, count(*) FILTER (name = 'Slab') > 0 AS slab, count(*) FILTER (core) AS n, {_N} AS complete FROM p WHERE structural AND floor IS NOT NULL GROUP BY ALL),
v AS (SELECT m.model, k.floor, slab, n, complete FROM (SELECT DISTINCT model FROM p) m, (SELECT unnest([0, 1, 2, 3]) AS floor) k LEFT JOIN l ON l.model = m.model AND l.floor = k.floor),
d AS (SELECT model, bool_or(floor > 0 AND slab IS NULL) AS f1, coalesce(bool_or(floor > 0 AND NOT slab), false) AS f2, coalesce(bool_or(floor > 0 AND n <> 6), false) AS f3, coalesce(bool_or(floor > 0 AND NOT complete), false) AS f4, bool_or(floor = 0 AND slab IS NULL) AS f5, coalesce(bool_or(floor = 0 AND NOT slab), false) AS f6 FROM v GROUP BY model)
SELECT w.model, array_to_string(list_sort(list_filter([CASE WHEN r1 THEN 'Unanchored part' END, CASE WHEN r2 THEN 'Non-collidable structural part' END, CASE WHEN r3 THEN 'Unexpected structural class' END, CASE WHEN r4 THEN 'Invalid/minimum size' END,
  CASE WHEN r5 THEN 'Structural part outside a named floor/roof' END, CASE WHEN r6 THEN 'Core part outside an occupied floor' END, CASE WHEN r8 THEN 'Core shifts between floors' END, CASE WHEN f1 THEN 'Missing floor' END, CASE WHEN f2 THEN 'Floor has no slab' END,
  CASE WHEN f3 THEN 'Floor does not have all six core pieces' END, CASE WHEN f4 THEN 'Missing or duplicate core piece' END, CASE WHEN f5 THEN 'Missing Roof' END, CASE WHEN f6 THEN 'Roof has no slab' END, CASE WHEN cores <> 18 THEN 'Total core count does not match generated floors' END], lambda s: s IS NOT NULL)), ',') AS reasons
FROM w JOIN d ON w.model = d.model
"""

#: Triangles by line: nearly level ones and some that are steep.
FACES = """SELECT l_suppkey AS g, l_orderkey * 8 + l_linenumber AS part, CAST(l_quantity AS DOUBLE) / 8 AS y, CAST(2 + l_linenumber AS DOUBLE) AS w, CAST(1 + l_partkey % 6 AS DOUBLE) AS d, CASE WHEN l_partkey % 4 = 0 THEN 3.0 ELSE CAST(l_partkey % 3 AS DOUBLE) / 20 END AS rise FROM {t}"""


def roof_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of level faces by supplier, and faces by quarter heights with the first one's height."""
    rows = _view(spark, sf_dir, FACES, "lineitem").withColumn("rise", C("rise").cast("double"))
    corner = lambda x, y, z: motion.vector(x, y, z)
    zero = F.lit(0.0)
    face = motion.flat_face(corner(zero, C("y"), zero), corner(C("w"), C("y") + C("rise"), zero), corner(zero, C("y"), C("d")), 0.99, 0.7)
    faces = rows.withColumn("f", face).filter("f IS NOT NULL").select("g", F.struct("part", "f.y", "f.area").alias("part"), F.round("f.y", R).alias("y"), "f.area")
    bands = audit.roof_bands(faces, ["g"]).select("g", F.lit("band").alias("kind"), F.round("low", R).alias("at"), F.round("y", 4).alias("y"), F.round("area", R).alias("area"))
    planes = audit.roof_planes(faces, ["g"], "part").select("g", F.lit("plane").alias("kind"), C("quarter").cast("double").alias("at"), F.round("y", 4).alias("y"), F.round("area", R).alias("area"))
    return bands.unionByName(planes)


ROOF_SQL = f"""
WITH RECURSIVE r AS (SELECT g, part, y + CAST(rise AS DOUBLE) / 3 AS fy, w * d / 2 AS area, rise, w, d FROM ({FACES.format(t="lineitem")})),
f AS (SELECT g, part, round(fy, 6) AS y, fy, area, row_number() OVER () AS rid FROM r WHERE rise <= 0.7 AND w * d > 0.1 AND w * d / sqrt(pow(w * d, 2) + pow(rise * d, 2)) >= 0.99::DOUBLE),
b(g, low) AS (SELECT g, min(y) FROM f GROUP BY g UNION ALL SELECT b.g, min(f.y) FROM b JOIN f ON f.g = b.g AND f.y - b.low > 0.6::DOUBLE GROUP BY b.g, b.low),
p AS (SELECT f.g, f.y, f.area, max(b.low) AS low, rid FROM f JOIN b ON f.g = b.g AND b.low <= f.y GROUP BY f.g, f.y, f.area, rid)
SELECT g, 'band' AS kind, round(low, 6) AS at, round(sum(y * area) / sum(area), 4) AS y, round(sum(area), 6) AS area FROM p GROUP BY g, low
UNION ALL SELECT g, 'plane', round(y * 4), round(arg_min(y, (part, fy, area)), 4), round(sum(area), 6) FROM f GROUP BY g, round(y * 4)
"""

SQL = {
    capsule_hits: CAPSULE_SQL, ray_hits_ordered: RAYS_SQL, debris_dropped: DEBRIS_SQL, box_clusters: CLUSTERS_SQL, disjoint_plans: DISJOINT_SQL, status_report: STATUS_SQL, report_pages: PAGES_SQL, repeated_identities: REPEATED_SQL,
    points_apart: APART_SQL, tree_buildings: TREE_SQL, structure_counts: COUNTS_SQL, structure_audit: STRUCTURE_SQL, roof_faces: ROOF_SQL,
}
