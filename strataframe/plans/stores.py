"""Registered queries: versions of a store, archives of meshes, plans of slices and plans traced to their sources, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe import sinks
from strataframe.functions import motion, rings
from strataframe.functions.geometry import signed_area
from strataframe.operators import meshes, places, scenes, slices, smooth
from strataframe.plans.drawn import draw, drawn, table
from strataframe.plans.works import CORNERS, _corners
from strataframe.sources import meshes as archives
from strataframe.storage import fresh_path, stored

C = F.col


def store_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers as a store: staged changes of whole sources, what a preview shows, what is applied and archived, and what is current after an undo."""
    n = C("c_custkey")
    live = table(spark, sf_dir, "customer").select("c_custkey", C("c_nationkey").alias("source"), F.lit("old").alias("state_of"))
    plans = live.filter(n % 3 == 0).select("c_custkey", "source", F.lit("new").alias("state_of"), F.when((C("source") % 7 == 2) & (n % 2 == 0), "bad").alias("reason"))
    staged, failures = sinks.staged_batch(plans, "source")
    store = sinks.Store(spark, fresh_path(spark, "store"))
    first = store.begin(live)
    version = store.stage(staged.select(live.columns), failures)
    own = store.read(version, "staged")
    seen = sinks.previewed(live, own, ["c_custkey"]).groupBy("source", C("state").alias("kind")).agg(F.count("*").alias("n"))
    now = store.apply(version, first, ["c_custkey"], check=C("state_of") == "new")
    kinds = {"live": store.read(now), "archive": store.read(now, "archive"), "failures": store.read(now, "failures")}
    store.undo()
    kinds["undone"] = store.read()
    for name, rows in kinds.items():
        if name == "failures":
            seen = seen.unionByName(rows.select("source", F.lit(name).alias("kind"), C("failed").alias("n")))
        else:
            seen = seen.unionByName(rows.groupBy("source").agg(F.count_if(C("state_of") == ("old" if name in ("archive", "undone") else "new")).alias("n")).select("source", F.lit(name).alias("kind"), "n"))
    return seen


VERSIONS_SQL = """
WITH l AS (SELECT c_custkey AS k, c_nationkey AS source FROM customer), p AS (SELECT *, source % 7 = 2 AND k % 2 = 0 AS bad FROM l WHERE k % 3 = 0),
w AS (SELECT source, bool_or(bad) AS bad, count(*) FILTER (bad) AS failed FROM p GROUP BY source), s AS (SELECT p.* FROM p JOIN w ON w.source = p.source AND NOT w.bad)
SELECT source, kind, count(*) AS n FROM (SELECT source, unnest(['after', 'before', 'archive']) AS kind FROM s UNION ALL SELECT source, 'kept' FROM l WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT source, 'undone' FROM l) GROUP BY ALL
UNION ALL SELECT l.source, 'live', count(*) FILTER (l.k IN (SELECT k FROM s)) FROM l GROUP BY l.source UNION ALL SELECT source, 'failures', failed FROM w WHERE bad
"""


def mesh_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meshes of customers written as array archives and read again: vertices and faces of each, their sums after a swap of axes, and the first of the vertex numbers that run through all."""
    vertices, faces = _corners(spark, sf_dir)
    folder = fresh_path(spark, "archives")
    archives.write_npz(vertices, faces, folder)
    v, f = archives.archived_meshes(spark, folder)
    swapped = meshes.moved(v, "xzy", (1, -1, 1), 2.0, (1.0, 0.0, -1.0))
    sums = swapped.groupBy("mesh").agg(F.count("*").alias("vertices"), *(F.round(F.sum(c), 4).alias(f"sum_{c}") for c in "xyz"))
    running = meshes.concatenated(f, v).groupBy("mesh").agg(F.count("*").alias("faces"), F.min(F.least("a", "b", "c")).alias("first"), F.max(F.greatest("a", "b", "c")).alias("last"))
    return sums.join(running, "mesh")


ARCHIVES_SQL = f"""
WITH v AS ({CORNERS.format(t="customer")}), n AS (SELECT mesh, count(*) AS vertices, sum(x) AS x, sum(y) AS y, sum(z) AS z FROM v GROUP BY mesh),
o AS (SELECT *, sum(vertices) OVER (ORDER BY CAST(mesh AS VARCHAR)) - vertices AS before FROM n)
SELECT CAST(mesh AS VARCHAR) AS mesh, vertices, round(2 * x + vertices, 4) AS sum_x, round(-2 * z, 4) AS sum_y, round(2 * y - vertices, 4) AS sum_z, CAST(vertices / 3 AS BIGINT) AS faces, CAST(before AS BIGINT) AS first, CAST(before + vertices - 1 AS BIGINT) AS last FROM o
"""


def traced_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans accepted for parts as proxies, back to the suppliers that the proxies stand for."""
    parts = table(spark, sf_dir, "part").select(C("p_partkey").alias("proxy"), "p_size")
    proxies = parts.select("proxy", F.when(C("proxy") % 9 != 4, C("proxy") % 130).alias("source"))
    sources = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("source"), "s_nationkey")
    found = scenes.traced(parts.filter(C("p_size") % 4 == 1), proxies, sources)
    return found.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.min("proxy").alias("first"), F.sum("p_size").alias("size"))


TRACED_SQL = """
SELECT s_nationkey, count(*) AS n, min(p_partkey) AS first, CAST(sum(p_size) AS BIGINT) AS size FROM part JOIN supplier ON s_suppkey = p_partkey % 130 WHERE p_size % 4 = 1 AND p_partkey % 9 <> 4 GROUP BY s_nationkey
"""

SQL = {store_versions: VERSIONS_SQL, mesh_archives: ARCHIVES_SQL, traced_plans: TRACED_SQL}


def _slice_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey, plan: plans as JSON of two or more levels of two pieces each about a core, most with a fault of a drawn kind."""
    n = C("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(n, draw(n, "fault", n=14).alias("fault"), (draw(n, "w", n=30) + 20.0).alias("w"), (draw(n, "d", n=30) + 20.0).alias("d"), (draw(n, "n", n=4) + 2).alias("n"))
    fault = lambda k: C("fault") == k
    point = lambda x, z: F.array(x.cast("double"), z.cast("double"))
    ring = lambda x0, z0, x1, z1: F.array(point(x0, z0), point(x1, z0), point(x1, z1), point(x0, z1))
    zero, half = F.lit(0.0), C("w") / 2
    left = ring(zero, zero, half, C("d"))
    tie = F.array(point(half, zero), point(C("w"), C("d")), point(C("w"), zero), point(half, C("d")))
    ell = F.array(point(half, zero), point(C("w"), zero), point(C("w"), C("d") / 2), point(C("w") - 2, C("d") / 2), point(C("w") - 2, C("d")), point(half, C("d")))
    right = F.when(fault(0), ring(half - 1, zero, C("w"), C("d"))).when(fault(1), tie).when(fault(2), F.array(point(half, zero), F.array(F.lit(1.0)), point(C("w"), zero))).when(fault(3), ring(half + 1, zero, C("w"), C("d"))).when(fault(12), ell).otherwise(ring(half, zero, C("w"), C("d")))
    level = lambda k: F.struct((k * F.when(fault(4) & (k == 1), 9.0).otherwise(20.0)).alias("y"), F.when(fault(5), F.lit(0.01)).otherwise(F.lit(5.0)).alias("thickness"), F.when(fault(6) & (k == 1), F.array().cast("array<array<array<double>>>")).otherwise(F.array(left, right)).alias("pieces"))
    size = F.when(fault(7), 1.5).otherwise(3.0)
    core = F.struct((half - size).alias("minX"), (C("d") / 2 - size).alias("minZ"), (half + size).alias("maxX"), (C("d") / 2 + size).alias("maxZ"))
    plan = F.struct(F.when(fault(8), 2).otherwise(1).alias("version"), F.when(fault(9), "").otherwise(F.concat(F.lit("plan"), n.cast("string"))).alias("id"), F.struct(*(F.lit(1.0).alias(v) for v in "xyz")).alias("origin"), core.alias("core"), F.transform(F.sequence(F.lit(0), F.when(fault(10), 0).otherwise(C("n") - 1)), level).alias("levels"))
    return rows.select(n, F.when(fault(11), F.lit("[1,")).otherwise(F.to_json(plan)).alias("plan"))


def slice_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of slices read from JSON, checked, built and audited: parts and area, or the first breach of contract."""
    verdicts, pieces = slices.checked(slices.decoded(_slice_texts(spark, sf_dir)), "s_suppkey")
    pieces = stored(pieces, "pieces")
    parts = stored(slices.built(pieces, "s_suppkey"), "parts")
    volume = parts.groupBy("s_suppkey").agg(F.round(F.sum(F.when(C("name") != "Slab", C("sx") * C("sz") * (C("y1") - C("y0")))), 4).alias("core_volume"))
    audit = slices.audited(parts, pieces, "s_suppkey").select("s_suppkey", "slabs", "cores", C("reason").alias("audit"))
    return verdicts.join(audit, "s_suppkey", "left").join(volume, "s_suppkey", "left").withColumn("area", F.round("area", 4)).withColumn("slabs", F.when(C("slabs") > 2 * C("levels"), F.lit(None)).otherwise(C("slabs")))


_S = slices.REASONS
SLICES_SQL = f"""
WITH o AS (SELECT s_suppkey, {drawn("s_suppkey, 'fault'", 14)} AS fault, {drawn("s_suppkey, 'w'", 30)} + 20.0::DOUBLE AS w, {drawn("s_suppkey, 'd'", 30)} + 20.0::DOUBLE AS d, {drawn("s_suppkey, 'n'", 4)} + 2 AS n FROM supplier),
r AS (
  SELECT *, CASE fault WHEN 11 THEN '{_S[1]}' WHEN 8 THEN '{_S[2]}' WHEN 9 THEN '{_S[3]}' WHEN 10 THEN '{_S[5]}' WHEN 7 THEN '{_S[7]}' WHEN 5 THEN '{_S[9]}' WHEN 4 THEN '{_S[10]}' WHEN 6 THEN '{_S[11]}' WHEN 2 THEN '{_S[12]}' WHEN 1 THEN 'edges cross or touch' WHEN 0 THEN '{_S[14]}' WHEN 3 THEN '{_S[15]}' END AS reason FROM o)
SELECT s_suppkey, CASE WHEN reason IS NULL THEN CAST(n AS BIGINT) END AS levels, CASE WHEN reason IS NULL THEN CAST(2 * n AS BIGINT) END AS pieces, CASE WHEN reason IS NULL THEN round(n * (w * d - CASE WHEN fault = 12 THEN d ELSE 0 END), 4) END AS area, reason, CASE WHEN reason IS NULL AND fault <> 12 THEN CAST(2 * n AS BIGINT) END AS slabs,
  CASE WHEN reason IS NULL THEN CAST(6 * (n - 1) AS BIGINT) END AS cores, NULL::VARCHAR AS audit, CASE WHEN reason IS NULL THEN round(15 * (n - 1) * (6 + 6 + 4 + 4 + 4 + 4)::DOUBLE, 4) END AS core_volume FROM r
"""

SQL |= {slice_plans: SLICES_SQL}


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers changed in two batches of the nations with the most to change, each staged, audited and applied as a whole."""
    n = C("c_custkey")
    live = table(spark, sf_dir, "customer").select("c_custkey", C("c_nationkey").alias("source"), F.lit(0).alias("batch"))
    store = sinks.Store(spark, fresh_path(spark, "store"))
    store.begin(live)
    for k in (1, 2):
        plans = store.read().filter((C("batch") == 0) & (n % 5 < 2)).select("c_custkey", "source", F.lit(k).alias("batch"), F.lit(None).cast("string").alias("reason"))
        sinks.run_next(store, plans, "source", ["c_custkey"], [-F.count("*")], 4, C("batch") == k)
    return store.read().groupBy("source", "batch").agg(F.count("*").alias("n"))


RUNS_SQL = """
WITH p AS (SELECT c_nationkey AS source, count(*) AS n FROM customer WHERE c_custkey % 5 < 2 GROUP BY 1), r AS (SELECT source, (row_number() OVER (ORDER BY n DESC, source) - 1) // 4 + 1 AS batch FROM p)
SELECT c_nationkey AS source, CAST(CASE WHEN c_custkey % 5 < 2 AND r.batch <= 2 THEN r.batch ELSE 0 END AS INTEGER) AS batch, count(*) AS n FROM customer LEFT JOIN r ON r.source = c_nationkey GROUP BY 1, 2
"""


def smooth_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of one to three tiers of drawn heights and setbacks as floors, or why not; some tiers leave a gap, overhang, or end too early."""
    n = C("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(n, (draw(n, "tiers", n=3) + 1).alias("tiers"), (draw(n, "w", n=30) + 40.0).alias("w"), draw(n, "fault", n=9).alias("fault"), *((draw(n, f"h{k}", n=90) / 2.0 + 2.5).alias(f"h{k}") for k in (1, 2, 3)), *((draw(n, f"s{k}", n=9) - 1.0).alias(f"s{k}") for k in (2, 3)))
    zero = F.lit(0.0)
    spans, base, inset = [], zero, zero
    for k in (1, 2, 3):
        inset = inset + (zero if k == 1 else C(f"s{k}"))
        low = base + F.when((C("fault") == 0) & F.lit(k == 2), 0.5).otherwise(0.0)
        spans.append(F.struct(low.alias("bottom"), (base + C(f"h{k}")).alias("top"), rings.box_ring(inset, inset, C("w") - inset, C("w") - inset).alias("ring")))
        base = base + C(f"h{k}")
    every = F.slice(F.array(*spans), F.lit(1), C("tiers"))
    height = F.element_at(every, -1)["top"] + F.when(C("fault") == 1, 3.0).otherwise(0.0)
    plans = rows.select(n, height.alias("height"), every.alias("tiers"))
    floors = smooth.tiered_floors(smooth.normalized(plans, "s_suppkey"), "s_suppkey")
    return floors.groupBy("s_suppkey", "reason").agg(F.max("n").alias("n"), F.max("tier").alias("tiers"), F.round(F.sum("bottom"), 4).alias("bottoms"), F.round(F.sum(F.abs(signed_area(C("ring")))), 4).alias("area"))


_FP = smooth.FloorParams()
_EDGE = f"{_FP.slab!r}::DOUBLE"
FLOORS_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'tiers'", 3)} + 1 AS t, {drawn("s_suppkey, 'w'", 30)} + 40.0::DOUBLE AS w, {drawn("s_suppkey, 'fault'", 9)} AS fault, {", ".join(f"{drawn(f"s_suppkey, 'h{k}'", 90)} / 2.0::DOUBLE + 2.5 AS h{k}" for k in (1, 2, 3))}, {", ".join(f"{drawn(f"s_suppkey, 's{k}'", 9)} - 1.0::DOUBLE AS s{k}" for k in (2, 3))} FROM supplier),
h AS (SELECT *, h1 + CASE WHEN t > 1 THEN h2 ELSE 0 END + CASE WHEN t > 2 THEN h3 ELSE 0 END AS top, CASE WHEN fault = 1 THEN 3 ELSE 0 END AS more FROM o),
i AS (SELECT *, top + more AS height, [0.0::DOUBLE, h1, h1 + h2] AS b, [0.0::DOUBLE, s2, s2 + s3] AS s FROM h),
r AS (
  SELECT *, CASE WHEN height < 2 * {_EDGE} + {_FP.least_clear!r}::DOUBLE THEN '{smooth.WHOLE[1]}' WHEN fault = 0 AND t > 1 THEN '{smooth.TIER[1]}' WHEN t > 1 AND s2 < 0 THEN '{smooth.TIER[4]}' WHEN t > 2 AND s3 < 0 THEN '{smooth.TIER[4]}' WHEN fault = 1 THEN '{smooth.LAST}' END AS why,
    greatest(1, floor((height - {_EDGE}) / {(_FP.clear + _FP.slab)!r}::DOUBLE)) AS wish FROM i),
n AS (SELECT *, CASE WHEN t > wish AND (height - {_EDGE}) / t - {_EDGE} >= {_FP.least_clear!r}::DOUBLE THEN t ELSE wish END AS n FROM r),
p AS (SELECT *, (height - {_EDGE}) / n AS pitch FROM n),
q AS (SELECT *, coalesce(why, CASE WHEN pitch - {_EDGE} < {_FP.least_clear!r}::DOUBLE THEN '{smooth.CLEAR}' WHEN t > n THEN '{smooth.MANY}' END) AS reason FROM p),
a AS (SELECT *, greatest(2, least(ceil(b[2] / pitch + 0.5 - 1e-9), n - (t - 2))) AS f2 FROM q),
c AS (SELECT *, greatest(f2 + 1, least(ceil(b[3] / pitch + 0.5 - 1e-9), n - (t - 3))) AS f3 FROM a),
f AS (SELECT *, unnest(generate_series(1, CAST(n AS BIGINT))) AS k FROM c WHERE reason IS NULL),
g AS (SELECT *, CASE WHEN t > 2 AND k >= f3 THEN 3 WHEN t > 1 AND k >= f2 THEN 2 ELSE 1 END AS tier FROM f)
SELECT m AS s_suppkey, NULL::VARCHAR AS reason, CAST(max(n) AS INTEGER) AS n, CAST(max(tier) AS INTEGER) AS tiers, round(sum(CASE WHEN k = 1 THEN 0 ELSE (k - 1) * pitch END), 4) AS bottoms, round(sum(pow(w - 2 * s[tier], 2)), 4) AS area FROM g GROUP BY m
UNION ALL SELECT m, reason, NULL, NULL, NULL, NULL FROM q WHERE reason IS NOT NULL
"""

SQL |= {batch_runs: RUNS_SQL, smooth_floors: FLOORS_SQL}


def exact_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of exact boxes of suppliers, with a requested number of floors or none; and of which parts, in a tree, they are made."""
    n = C("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(n, (draw(n, "x", n=700) / 10.0 + 5).alias("sx"), (draw(n, "y", n=900) / 10.0 + 10).alias("sy"), (draw(n, "z", n=700) / 10.0 + 5).alias("sz"), F.when(n % 4 == 1, (draw(n, "r", n=5)).cast("double")).when(n % 4 == 2, 1.5).alias("requested"))
    found = places.exact_boxes(rows)
    return found.select(n, "reason", "nx", "nz", "floors", F.round("cell", 6).alias("cell"), F.round("ground", 6).alias("ground"), F.round("upper", 6).alias("upper"), F.length("mask").alias("cells"))


_GAP = f"(sy - (n + 1) * {_EDGE}) / n"
EXACT_SQL = f"""
WITH o AS (SELECT s_suppkey, {drawn("s_suppkey, 'x'", 700)} / 10.0::DOUBLE + 5 AS sx, {drawn("s_suppkey, 'y'", 900)} / 10.0::DOUBLE + 10 AS sy, {drawn("s_suppkey, 'z'", 700)} / 10.0::DOUBLE + 5 AS sz, CASE s_suppkey % 4 WHEN 1 THEN CAST({drawn("s_suppkey, 'r'", 5)} AS DOUBLE) WHEN 2 THEN 1.5 END AS r FROM supplier),
c AS (SELECT *, CASE WHEN sy < 2 * {_EDGE} + {_FP.clear!r}::DOUBLE THEN 'box is too small' WHEN r < 1 OR r <> floor(r) THEN 'invalid floor count' END AS reason, greatest(2.5, greatest(sx, sz) / 18) AS cell FROM o),
m AS (SELECT *, greatest(1, floor((sy - {_EDGE}) / ({_FP.least_clear!r}::DOUBLE + {_EDGE}))) AS most, floor((sy - 2 * {_EDGE} - {_FP.clear!r}::DOUBLE) / ({_FP.clear!r}::DOUBLE + {_EDGE})) + 1 AS free FROM c),
f AS (SELECT *, CASE WHEN r >= 1 THEN CASE WHEN (sy - (r + 1) * {_EDGE}) / r < {_FP.least_clear!r}::DOUBLE THEN most ELSE r END ELSE free END AS n FROM m)
SELECT s_suppkey, reason, CASE WHEN reason IS NULL THEN CAST(ceil(sx / cell) AS INTEGER) END AS nx, CASE WHEN reason IS NULL THEN CAST(ceil(sz / cell) AS INTEGER) END AS nz, CASE WHEN reason IS NULL THEN CAST(n AS INTEGER) END AS floors, CASE WHEN reason IS NULL THEN round(cell, 6) END AS cell,
  CASE WHEN reason IS NULL THEN round(CASE WHEN r >= 1 THEN {_GAP} ELSE sy - 2 * {_EDGE} - (n - 1) * ({_FP.clear!r}::DOUBLE + {_EDGE}) END, 6) END AS ground, CASE WHEN reason IS NULL THEN round(CASE WHEN r >= 1 THEN {_GAP} ELSE {_FP.clear!r}::DOUBLE END, 6) END AS upper,
  CASE WHEN reason IS NULL THEN CAST(ceil(sx / cell) * ceil(sz / cell) AS INTEGER) END AS cells FROM f
"""


def slab_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What turned parts, direct children of their orders, cover from above; protected ones are left out."""
    n = C("p_partkey")
    rows = table(spark, sf_dir, "part").select(n, F.when(n % 11 > 0, n % 40).alias("parent"), F.concat(F.when(n % 3 == 0, "Slab").otherwise("Wall"), n.cast("string")).alias("name"), F.when(n % 2 == 0, "wedge").otherwise("block").alias("kind"), F.when(n % 13 == 5, "kept").alias("lock"),
        motion.vector((n % 97).cast("double"), (n % 31).cast("double"), (n % 89).cast("double")).alias("at"), motion.vector((n % 7 + 1).cast("double"), (n % 5 + 2).cast("double"), (n % 9 + 1).cast("double")).alias("size"), (n % 60 / 10.0).alias("yaw"))
    own = places.children(rows, "parent", "name", "^Slab", "kind", ("wedge", "block"), ("lock",))
    found = places.slab_shapes(own)
    middle = lambda v: F.round(F.aggregate("ring", F.lit(0.0), lambda s, q: s + q[v]) / F.size("ring"), 4)
    return found.select(n, F.size("ring").alias("corners"), F.round(signed_area(C("ring")), 4).alias("area"), middle("x").alias("x"), middle("z").alias("z"), "low", "high")


OUTLINES_SQL = """
WITH p AS (SELECT p_partkey, p_partkey % 2 = 0 AS wedge, CAST(p_partkey % 97 AS DOUBLE) AS x, CAST(p_partkey % 31 AS DOUBLE) AS y, CAST(p_partkey % 89 AS DOUBLE) AS z, CAST(p_partkey % 7 + 1 AS DOUBLE) AS sx, CAST(p_partkey % 5 + 2 AS DOUBLE) AS sy, CAST(p_partkey % 9 + 1 AS DOUBLE) AS sz, p_partkey % 60 / 10.0::DOUBLE AS yaw
  FROM part WHERE p_partkey % 11 > 0 AND p_partkey % 3 = 0 AND p_partkey % 13 <> 5)
SELECT p_partkey, CASE WHEN wedge THEN 3 ELSE 4 END AS corners, round(CASE WHEN wedge THEN sy * sz / 2 ELSE sx * sz END, 4) AS area, round(CASE WHEN wedge THEN x - sy / 6 * cos(yaw) - sz / 6 * sin(yaw) ELSE x END, 4) AS x, round(CASE WHEN wedge THEN z - sy / 6 * sin(yaw) + sz / 6 * cos(yaw) ELSE z END, 4) AS z,
  y - CASE WHEN wedge THEN sx ELSE sy END / 2 AS low, y + CASE WHEN wedge THEN sx ELSE sy END / 2 AS high FROM p
"""

SQL |= {exact_boxes: EXACT_SQL, slab_outlines: OUTLINES_SQL}
