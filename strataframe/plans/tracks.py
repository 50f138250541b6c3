"""Registered queries: verdicts on tracks, stitched clusters and nearest neighbours at any distance, with equal SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.config import CLUSTER_MASSING, FRACTIONS, TRACK_FRACTIONS, Clusters, Massing, Tracks, configured
from strataframe.functions import motion
from strataframe.operators import graph, nearest, samples, tracks
from strataframe.plans.drawn import draw, drawn, table
from strataframe.plans.works import neighbours

C = F.col


def _walls(lines: list[tuple], low: Column, high: Column) -> Column:
    """Triangles of upright walls over lines (x, z, x, z)."""
    v = lambda x, y, z: motion.vector(x, y, z)
    return F.array(*(f for a, b, c, d in lines for f in (F.array(v(a, low, b), v(c, low, d), v(c, high, d)), F.array(v(a, low, b), v(c, high, d), v(a, high, b)))))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, k, x0, x1, z0, z1, y0, y1: for each supplier three blocks side by side of drawn heights, on drawn bases."""
    m, k = C("m"), C("k")
    rows = _suppliers(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    rows = rows.select("m", "k", (k * 60.0).alias("x0"), (k * 60.0 + draw(m, k, "w", n=25) + 15).alias("x1"), F.lit(0.0).alias("z0"), (draw(m, k, "d", n=25) + 15.0).alias("z1"), (F.greatest(draw(m, k, "y", n=60) - 30, F.lit(0)) * 1.0).alias("y0"), (draw(m, k, "h", n=90) + 10.0).alias("h"))
    return rows.withColumn("y1", C("y0") + C("h")).drop("h")


def track_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each supplier's blocks as one model: the tracks of its loops with their verdicts, and how much of its cells they hold."""
    blocks = _blocks(spark, sf_dir)
    models = blocks.groupBy("m").agg(*((F.min if e == "0" else F.max)(f"{v}{e}").alias(f"{v}{e}") for v in "xyz" for e in "01"))
    x0, x1, z0, z1 = (C(c) for c in ("x0", "x1", "z0", "z1"))
    faces = blocks.select("m", F.explode(_walls([(x0, z0, x1, z0), (x1, z0, x1, z1), (x1, z1, x0, z1), (x0, z1, x0, z0)], C("y0"), C("y1"))).alias("points"))
    cells = blocks.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(9)))).join(models.select("m", C("y0").alias("b"), C("y1").alias("t")).hint("merge"), "m").withColumn("y", C("b") + (C("t") - C("b")) * C("y") / 10)
    cells = cells.filter((C("y") >= C("y0")) & (C("y") < C("y1"))).select("m", ((x0 + x1) / 2).alias("x"), "y", ((z0 + z1) / 2).alias("z"))
    found, verdicts = tracks.diagnosed(tracks.sampled_loops(faces, models), models, cells)
    shown = F.when(C("reason").isNull(), F.round("confidence", 4))
    rows = found.select("m", "samples", F.when(C("reason").isNull(), F.round("area", 4)).alias("area"), F.round("base", 4).alias("base"), F.round("top", 4).alias("top"), shown.alias("confidence"), "reason")
    return rows.join(verdicts.select("m", "tracks", "accepted", F.round("volume", 4).alias("volume"), "overlaps", "complete").hint("merge"), "m")


_T = Tracks()
_F = "SELECT unnest([" + ", ".join(f"{f}::DOUBLE" for f in TRACK_FRACTIONS) + "]) AS f"
VERDICT_SQL = f"""
WITH b AS (SELECT s_suppkey AS m, k, {drawn("s_suppkey, k, 'w'", 25)} + 15.0::DOUBLE AS w, {drawn("s_suppkey, k, 'd'", 25)} + 15.0::DOUBLE AS d, CAST(greatest({drawn("s_suppkey, k, 'y'", 60)} - 30, 0) AS DOUBLE) AS y0, {drawn("s_suppkey, k, 'h'", 90)} + 10.0::DOUBLE AS h FROM supplier, (SELECT unnest([0, 1, 2]) AS k)),
e AS (SELECT m, min(y0) AS lo, max(y0 + h) AS hi FROM b GROUP BY m),
s AS (SELECT b.m, b.k, b.w * b.d AS area, f, lo + (hi - lo) * f AS y, lo, hi FROM b JOIN e ON e.m = b.m, ({_F}) WHERE b.w * b.d >= 150 AND b.y0 <= lo + (hi - lo) * f AND lo + (hi - lo) * f < b.y0 + b.h),
t AS (SELECT m, k, any_value(area) AS area, count(*) AS samples, min(f) AS f0, max(f) AS f1, min(y) AS low, max(y) AS high, any_value(lo) AS lo, any_value(hi) AS hi FROM s GROUP BY m, k),
u AS (SELECT *, greatest(lo, low - (hi - lo) * {tracks.BEYOND}::DOUBLE) AS base, least(hi, high + (hi - lo) * {tracks.BEYOND}::DOUBLE) AS top FROM t),
v AS (
  SELECT *, CASE WHEN samples < {_T.min_track_samples} THEN '{tracks.TRACK[0]}' WHEN f1 - f0 < {_T.min_track_span}::DOUBLE THEN '{tracks.TRACK[1]}' WHEN high - low < {_T.min_track_height} THEN '{tracks.TRACK[2]}' WHEN f0 > {_T.max_first_fraction}::DOUBLE THEN '{tracks.TRACK[3]}'
    WHEN f1 < {_T.min_last_fraction}::DOUBLE THEN '{tracks.TRACK[4]}' END AS fault FROM u),
w AS (SELECT *, coalesce(fault, CASE WHEN top - base < {tracks.LEAST_PLAN} THEN '{tracks.TRACK[5]}' END) AS reason FROM v),
c AS (SELECT b.m, b.k, lo + (hi - lo) * i / 10 AS y FROM b JOIN e ON e.m = b.m, (SELECT unnest(generate_series(0, 9)) AS i) WHERE lo + (hi - lo) * i / 10 >= b.y0 AND lo + (hi - lo) * i / 10 < b.y0 + b.h),
x AS (SELECT c.m, avg(CASE WHEN w.k IS NOT NULL AND c.y BETWEEN w.base AND w.top THEN 1.0 ELSE 0.0 END) AS volume FROM c LEFT JOIN w ON w.m = c.m AND w.k = c.k AND w.fault IS NULL GROUP BY c.m),
n AS (SELECT m, count(*) AS tracks, count(*) FILTER (fault IS NULL) AS accepted, count(*) FILTER (reason IS NULL) AS plans FROM w GROUP BY m)
SELECT w.m, CAST(samples AS INTEGER) AS samples, CASE WHEN reason IS NULL THEN round(area, 4) END AS area, round(base, 4) AS base, round(top, 4) AS top, CASE WHEN reason IS NULL THEN round(least(0.9, 0.55 + samples / {len(TRACK_FRACTIONS)} * 0.3 + (f1 - f0) * 0.15), 4) END AS confidence, reason, tracks, accepted, round(volume, 4) AS volume, CAST(0 AS BIGINT) AS overlaps,
  accepted > 0 AND volume >= {_T.min_volume_coverage} AND plans = accepted AS complete FROM w JOIN x ON x.m = w.m JOIN n ON n.m = w.m
"""


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(triangles, components): for each supplier a box in one part, or in two that are open to each other, some of them at other heights or of one source."""
    m = C("m")
    own = _suppliers(spark, sf_dir).select("m", draw(m, "kind", n=5).alias("kind"), (draw(m, "w", n=40) + 30.37).alias("w"), (draw(m, "d", n=40) + 30.37).alias("d"), (draw(m, "h", n=60) + 40.0).alias("h"), (m * 1000.0).alias("x"))
    parts = own.withColumn("k", F.explode(F.when(C("kind") == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    lift = F.when((C("kind") == 1) & (C("k") == 1), 200.0).otherwise(0.0)
    parts = parts.withColumns({"id": m * 2 + C("k"), "source": F.when(C("kind") == 2, m * 2).otherwise(m * 2 + C("k")), "y0": lift, "y1": lift + C("h"), "z0": F.lit(0.0), "z1": C("d")})
    left, mid, right = C("x"), C("x") + C("w"), C("x") + C("w") * 2
    one = C("kind") == 0
    parts = parts.withColumns({"x0": F.when(one | (C("k") == 0), left).otherwise(mid), "x1": F.when(~one & (C("k") == 0), mid).otherwise(right)})
    x0, x1, z0, z1 = (C(c) for c in ("x0", "x1", "z0", "z1"))
    closed = [(x0, z0, x1, z0), (x1, z0, x1, z1), (x1, z1, x0, z1), (x0, z1, x0, z0)]
    faces = parts.select("id", "k", "kind", F.posexplode(_walls(closed, C("y0"), C("y1"))).alias("t", "points"))
    # the wall between the two parts is open on both sides
    between = (C("kind") > 0) & (((C("k") == 0) & C("t").isin(2, 3)) | ((C("k") == 1) & C("t").isin(6, 7)))
    return faces.filter(~between).select("id", "t", "points"), parts.select("id", "source", C("id").cast("string").alias("key"), "x0", "x1", "y0", "y1", "z0", "z1")


def stitched_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers' parts stitched to buildings, or why not."""
    faces, components = _halves(spark, sf_dir)
    found = tracks.stitched(faces, components)
    return found.select("cluster", "n", "key", *(F.round(c, 4).alias(c) for c in ("height", "area")), F.round("confidence", 3).alias("confidence"), "method", "reason")


_C, _M = Clusters(), configured(Massing, CLUSTER_MASSING)
STITCH_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'kind'", 5)} AS kind, {drawn("s_suppkey, 'w'", 40)} + 30.37::DOUBLE AS w, {drawn("s_suppkey, 'd'", 40)} + 30.37::DOUBLE AS d, {drawn("s_suppkey, 'h'", 60)} + 40.0::DOUBLE AS h FROM supplier),
c AS (SELECT *, m * 2 AS cluster, CASE WHEN kind < 2 THEN 1 ELSE 2 END AS n FROM o UNION ALL SELECT *, m * 2 + 1, 1 FROM o WHERE kind = 1),
r AS (SELECT *, CASE WHEN n < {_C.min_components} THEN '{tracks.CLUSTER[0]}' WHEN kind = 2 THEN '{tracks.CLUSTER[3]}' END AS reason, CAST(m * 2 AS VARCHAR) || CAST(m * 2 + 1 AS VARCHAR) AS names FROM c)
SELECT cluster, CAST(n AS BIGINT) AS n, CASE WHEN reason IS NULL THEN concat('Global2_', CAST(list_reduce(list_prepend(0, list_transform(string_split(CASE WHEN CAST(m * 2 AS VARCHAR) < CAST(m * 2 + 1 AS VARCHAR) THEN names ELSE CAST(m * 2 + 1 AS VARCHAR) || CAST(m * 2 AS VARCHAR) END, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda s, c: (s * 131 + c) % 1000000007) AS BIGINT), '_',
    CAST(round((m * 1000 + w) * 10) AS BIGINT), '_', CAST(round(h / 2 * 10) AS BIGINT), '_', CAST(round(d / 2 * 10) AS BIGINT)) END AS key,
  CASE WHEN reason IS NULL THEN h END AS height, CASE WHEN reason IS NULL THEN round(2 * w * d, 4) END AS area, CASE WHEN reason IS NULL THEN CAST(round(0.52 + 0.35 + 0.13 * {FRACTIONS[-1] - FRACTIONS[0]}, 3) AS DOUBLE) END AS confidence, CASE WHEN reason IS NULL THEN 'contours' END AS method, reason FROM r
"""

def nearest_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest supplier of each customer on a wide ground, however far."""
    n, s = C("c_custkey"), C("s_suppkey")
    customers = table(spark, sf_dir, "customer").select(n.alias("id"), (draw(n, "x", n=60000) / 4.0).alias("x"), (draw(n, "z", n=40000) / 4.0).alias("z"))
    suppliers = table(spark, sf_dir, "supplier").select(s.alias("id"), (draw(s, "sx", n=6000) / 1.0).alias("x"), (draw(s, "sz", n=4000) / 1.0).alias("z"))
    return nearest.nearest_any(customers, suppliers, 64.0).select("id", "target", F.round("d2", 4).alias("d2"))


ANY_SQL = f"""
WITH c AS (SELECT c_custkey AS id, {drawn("c_custkey, 'x'", 60000)} / 4.0::DOUBLE AS x, {drawn("c_custkey, 'z'", 40000)} / 4.0::DOUBLE AS z FROM customer), s AS (SELECT s_suppkey AS id, {drawn("s_suppkey, 'sx'", 6000)} / 1.0::DOUBLE AS x, {drawn("s_suppkey, 'sz'", 4000)} / 1.0::DOUBLE AS z FROM supplier),
p AS (SELECT c.id, s.id AS target, pow(c.x - s.x, 2) + pow(c.z - s.z, 2) AS d2 FROM c, s)
SELECT id, arg_min(target, (d2, target)) AS target, round(min(d2), 4) AS d2 FROM p GROUP BY id
"""


def mutual_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers on a wide ground that are each other's nearest, however far."""
    n = C("c_custkey")
    customers = table(spark, sf_dir, "customer").select(n.alias("id"), (draw(n, "x", n=60000) / 4.0).alias("x"), (draw(n, "z", n=40000) / 4.0).alias("z"))
    return nearest.mutual_any(customers, 32.0).select("a", "b", F.round("d2", 4).alias("d2"))


MUTUAL_SQL = f"""
WITH c AS (SELECT c_custkey AS id, {drawn("c_custkey, 'x'", 60000)} / 4.0::DOUBLE AS x, {drawn("c_custkey, 'z'", 40000)} / 4.0::DOUBLE AS z FROM customer),
p AS (SELECT a.id, arg_min(b.id, (pow(a.x - b.x, 2) + pow(a.z - b.z, 2), b.id)) AS near, min(pow(a.x - b.x, 2) + pow(a.z - b.z, 2)) AS d2 FROM c a JOIN c b ON a.id <> b.id GROUP BY a.id)
SELECT p.id AS a, p.near AS b, round(p.d2, 4) AS d2 FROM p JOIN p AS q ON q.id = p.near AND q.near = p.id WHERE p.id < p.near
"""

def sampled_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of suppliers' towers of one or two boxes, turned, from cuts near the bottom and the top of each floor; some lack a wall."""
    m = C("m")
    own = _suppliers(spark, sf_dir).select("m", (draw(m, "w", n=40) + 31.3).alias("w"), (draw(m, "d", n=24) + 6.1).alias("d"), (draw(m, "h1", n=50) + 8.17).alias("h1"), (draw(m, "h2", n=60) - 20.0).alias("h2"), (draw(m, "s", n=6) + 1.7).alias("s"), (draw(m, "open", n=6) == 0).alias("open"), (draw(m, "yaw", n=900) / 1000.0).alias("yaw"))
    box = lambda s, low, high: F.struct(s.alias("s"), low.alias("low"), high.alias("high"))
    tiers = own.withColumn("b", F.explode(F.when(C("h2") > 0, F.array(box(F.lit(0.0), F.lit(3.0), C("h1") + 3), box(C("s"), C("h1") + 3, C("h1") + C("h2") + 3))).otherwise(F.array(box(F.lit(0.0), F.lit(3.0), C("h1") + 3)))))
    tiers = tiers.select("m", "open", "yaw", (C("w") / 2 - C("b.s")).alias("x"), (C("d") / 2 - C("b.s")).alias("z"), "b.low", "b.high").filter("z > 0")
    at = lambda sx, sz: (sx * C("x") * F.cos("yaw") - sz * C("z") * F.sin("yaw") + 50, sx * C("x") * F.sin("yaw") + sz * C("z") * F.cos("yaw"))
    corners = [at(*c) for c in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    faces = tiers.select("m", "open", F.posexplode(_walls([(*p, *q) for p, q in zip(corners, corners[1:] + corners[:1])], C("low"), C("high"))).alias("t", "points"))
    models, floors = samples.sampled_models(faces.filter(~C("open") | (C("t") > 1)).select("m", "points"))
    tight = floors.groupBy("m").agg(F.sum(F.regexp_count("tight", F.lit("1"))).cast("long").alias("tight"))
    shown = lambda c: F.when(C("reason").isNull(), c)
    return models.join(tight, "m", "left").select("m", "reason", shown(C("floors")).alias("floors"), shown(C("cells")).alias("cells"), "tight", shown(C("nx")).alias("nx"), shown(C("nz")).alias("nz"), shown(F.round("at.x", 4)).alias("x"), shown(F.round(F.abs(F.sin("yaw")), 4)).alias("turn"))


_FP = samples.building.FloorParams()
_SL, _CL = f"{_FP.slab!r}::DOUBLE", f"{_FP.clear!r}::DOUBLE"
GRIDS_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'w'", 40)} + 31.3::DOUBLE AS w, {drawn("s_suppkey, 'd'", 24)} + 6.1::DOUBLE AS d, {drawn("s_suppkey, 'h1'", 50)} + 8.17::DOUBLE AS h1, {drawn("s_suppkey, 'h2'", 60)} - 20.0::DOUBLE AS h2, {drawn("s_suppkey, 's'", 6)} + 1.7::DOUBLE AS s, {drawn("s_suppkey, 'open'", 6)} = 0 AS open, {drawn("s_suppkey, 'yaw'", 900)} / 1000.0::DOUBLE AS yaw FROM supplier),
p AS (SELECT *, h1 + CASE WHEN h2 > 0 AND d / 2 - s > 0 THEN h2 ELSE 0 END AS h, h2 > 0 AND d / 2 - s > 0 AS two FROM o),
q AS (SELECT *, CASE WHEN open THEN CASE WHEN two THEN 12 ELSE 6 END ELSE CASE WHEN two THEN 16 ELSE 8 END END AS n, floor((h - 2 * {_SL} - {_CL}) / ({_SL} + {_CL})) + 1 AS floors, greatest({samples.CELL}, w / {samples.AXIS}) AS cell FROM p),
r AS (SELECT *, h - 2 * {_SL} - (floors - 1) * ({_SL} + {_CL}) AS ground, CASE WHEN n < {samples.TRIANGLES} THEN '{samples.REASONS[0]}' WHEN least(w, d) < {samples.WIDTH} OR h < 2 * {_SL} + {_CL} THEN '{samples.REASONS[1]}' END AS why FROM q),
k AS (SELECT *, unnest(generate_series(1, CAST(floors AS BIGINT))) AS k FROM r WHERE why IS NULL),
y AS (SELECT *, CASE WHEN k = 1 THEN 0 ELSE {_SL} + ground + (k - 2) * ({_SL} + {_CL}) END + {_SL} AS base, CASE WHEN k = 1 THEN ground ELSE {_CL} END AS clear FROM k),
z AS (SELECT *, base + {samples.OFF} AS low, least(h - {samples.OFF}, base + clear + {_SL} - {samples.OFF}) AS high FROM y),
a AS (SELECT z.*, CASE WHEN low >= h1 THEN s ELSE 0 END AS sl, CASE WHEN high >= h1 THEN s ELSE 0 END AS sh FROM z),
i AS (SELECT m, unnest(generate_series(0, CAST(ceil(w / cell) AS BIGINT) - 1)) AS i FROM r WHERE why IS NULL), j AS (SELECT m, unnest(generate_series(0, CAST(ceil(d / cell) AS BIGINT) - 1)) AS j FROM r WHERE why IS NULL),
c AS (
  SELECT a.m, a.k, greatest(abs(-w / 2 + i * cell + {samples.INSET}), abs(least(-w / 2 + (i + 1) * cell, w / 2) - {samples.INSET})) AS x, greatest(abs(-d / 2 + j * cell + {samples.INSET}), abs(least(-d / 2 + (j + 1) * cell, d / 2) - {samples.INSET})) AS z, w, d, sl, sh, open FROM a JOIN i ON i.m = a.m JOIN j ON j.m = a.m),
f AS (SELECT m, k, count(*) FILTER (NOT open AND x < w / 2 - sl AND z < d / 2 - sl) AS loose, count(*) FILTER (NOT open AND x < w / 2 - greatest(sl, sh) AND z < d / 2 - greatest(sl, sh)) AS tight FROM c GROUP BY m, k),
g AS (SELECT m, sum(loose) AS cells, sum(tight) AS tight, count(*) FILTER (loose >= {samples.SOME}) AS filled, max(loose) FILTER (k = 1) AS first FROM f GROUP BY m),
v AS (SELECT r.*, g.cells, g.tight, coalesce(why, CASE WHEN filled < ceil(floors * {samples.FILLED}) OR first = 0 THEN '{samples.REASONS[2]}' WHEN g.cells * cell * cell / floors < {samples.AREA} THEN '{samples.REASONS[3]}' END) AS reason FROM r LEFT JOIN g ON g.m = r.m)
SELECT m, reason, CASE WHEN reason IS NULL THEN CAST(floors AS INTEGER) END AS floors, CASE WHEN reason IS NULL THEN CAST(cells AS BIGINT) END AS cells, CASE WHEN reason IS NULL THEN CAST(tight AS BIGINT) END AS tight, CASE WHEN reason IS NULL THEN CAST(ceil(w / cell) AS INTEGER) END AS nx, CASE WHEN reason IS NULL THEN CAST(ceil(d / cell) AS INTEGER) END AS nz,
  CASE WHEN reason IS NULL THEN 50.0::DOUBLE END AS x, CASE WHEN reason IS NULL THEN round(abs(sin(yaw)), 4) END AS turn FROM v
"""

def bounded_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By component of neighbouring parts how many connected sets of two to four they have, and which have too many."""
    found, refused = graph.bounded_subsets(neighbours(spark, sf_dir), 4, 12)
    kept = found.groupBy("component").agg(F.count("*").alias("sets"), F.max(F.size("members")).alias("most"))
    return kept.unionByName(refused.select("component", F.lit(None).cast("long").alias("sets"), F.lit(None).cast("int").alias("most")))


BOUNDED_SQL = """
WITH RECURSIVE e AS (SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND b.p_partkey - a.p_partkey < 60), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
s(m) AS (SELECT DISTINCT [a, b] FROM e UNION SELECT list_sort(list_append(m, u.b)) FROM s JOIN u ON list_contains(m, u.a) AND NOT list_contains(m, u.b) WHERE len(m) < 4),
c(node, component) USING KEY (node) AS (SELECT a, a FROM u GROUP BY a UNION SELECT u.b, min(c.component) FROM c JOIN u ON u.a = c.node JOIN recurring.c AS r ON r.node = u.b WHERE c.component < r.component GROUP BY u.b),
n AS (SELECT c.component, count(*) AS sets, max(len(m)) AS most FROM s JOIN c ON c.node = m[1] GROUP BY c.component)
SELECT component, CASE WHEN sets <= 12 THEN sets END AS sets, CASE WHEN sets <= 12 THEN CAST(most AS INTEGER) END AS most FROM n
"""

SQL = {bounded_subsets: BOUNDED_SQL, sampled_grids: GRIDS_SQL, track_verdicts: VERDICT_SQL, stitched_clusters: STITCH_SQL, nearest_any: ANY_SQL, mutual_any: MUTUAL_SQL}
