"""Registered queries: buildings from contours and roofs of drawn towers, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.config import FRACTIONS, Massing
from strataframe.functions import motion, rings
from strataframe.operators import boxes, contours, roofs, sections
from strataframe.plans.drawn import draw, drawn, table

C = F.col
BASE = 5.0


def _towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, t, points: for each supplier one to three boxes on each other, set back by drawn lengths, turned; walls and level tops."""
    m = C("m")
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    own = own.select("m", (draw(m, "n", n=3) + 1).alias("n"), (draw(m, "w", n=40) + 60.0).alias("w"), (draw(m, "d", n=40) + 60.0).alias("d"), (draw(m, "yaw", n=700) / 1000.0).alias("yaw"), *((draw(m, v, n=k) + a * 1.0).alias(v) for v, k, a in (("h1", 60, 20), ("h2", 50, 10), ("h3", 30, 2), ("s2", 12, 0), ("s3", 12, 0))))
    box = lambda k, s, low, high: F.struct(F.lit(k).alias("k"), s.alias("s"), low.alias("low"), high.alias("high"))
    y1, y2, zero = BASE + C("h1"), BASE + C("h1") + C("h2"), F.lit(0.0)
    tiers = own.withColumn("b", F.explode(F.slice(F.array(box(1, zero, F.lit(BASE), y1), box(2, C("s2"), y1, y2), box(3, C("s2") + C("s3"), y2, y2 + C("h3"))), F.lit(1), C("n")))).select("m", "yaw", "w", "d", "b.*")
    x, z = C("w") / 2 - C("s"), C("d") / 2 - C("s")
    at = lambda sx, sz, y: motion.vector(sx * x * F.cos("yaw") - sz * z * F.sin("yaw") + 100, y, sx * x * F.sin("yaw") + sz * z * F.cos("yaw") - 50)
    corners = ((-1, -1), (1, -1), (1, 1), (-1, 1))
    walls = [[at(*p, C("low")), at(*q, C("low")), at(*q, C("high"))] for p, q in zip(corners, corners[1:] + corners[:1])] + [[at(*p, C("low")), at(*q, C("high")), at(*p, C("high"))] for p, q in zip(corners, corners[1:] + corners[:1])]
    tops = [[at(*corners[0], C("high")), at(*corners[k], C("high")), at(*corners[k + 1], C("high"))] for k in (1, 2)]
    faces = F.array(*(F.array(*f) for f in walls + tops))
    return tiers.select("m", "k", F.posexplode(faces).alias("f", "points")).select("m", (C("k") * 100 + C("f")).alias("t"), "points")


def contour_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiers of each supplier's tower, to the plane of each setback, or why it has none."""
    found = contours.contour_plans(_towers(spark, sf_dir))
    total = lambda f: F.round(F.aggregate("tiers", F.lit(0.0), lambda n, t: n + t[f]), 4)
    return found.select("m", F.size("tiers").alias("tiers"), total("bottom").alias("bottoms"), total("top").alias("tops"), *(F.round(c, 4).alias(c) for c in ("height", "area", "roof_trim")), F.round("confidence", 3).alias("confidence"), "samples", F.aggregate("tiers", F.lit(0), lambda n, t: n + F.size(t["ring"])).alias("corners"), F.round("at.x", 4).alias("x"), "reason")


_P = Massing()
#: Whether boxes of one middle, w by d and v by e, are alike: in area, and the corners of one in distance to the other.
_LIKE = "least({a}.w * {a}.d, {b}.w * {b}.d) >= 0.92::DOUBLE * greatest({a}.w * {a}.d, {b}.w * {b}.d) AND abs({a}.w - {b}.w) / 2 * sqrt(2::DOUBLE) <= greatest(1.5, 0.035::DOUBLE * least({a}.w, {a}.d, {b}.w, {b}.d))"
_SHARES = ", ".join(f"{{'i': {i}, 'f': {f}::DOUBLE}}" for i, f in enumerate(FRACTIONS))
_G = contours.GATES
CONTOUR_SQL = f"""
WITH RECURSIVE o AS (
  SELECT s_suppkey AS m, {drawn("s_suppkey, 'n'", 3)} + 1 AS n, {drawn("s_suppkey, 'w'", 40)} + 60.0::DOUBLE AS w, {drawn("s_suppkey, 'd'", 40)} + 60.0::DOUBLE AS d, {drawn("s_suppkey, 'h1'", 60)} + 20.0::DOUBLE AS h1, {drawn("s_suppkey, 'h2'", 50)} + 10.0::DOUBLE AS h2, {drawn("s_suppkey, 'h3'", 30)} + 2.0::DOUBLE AS h3,
    {drawn("s_suppkey, 's2'", 12)} AS s2, {drawn("s_suppkey, 's3'", 12)} AS s3 FROM supplier),
t AS (
  SELECT m, 1 AS k, w, d, {BASE}::DOUBLE AS low, {BASE} + h1 AS high FROM o UNION ALL SELECT m, 2, w - 2 * s2, d - 2 * s2, {BASE} + h1, {BASE} + h1 + h2 FROM o WHERE n > 1 UNION ALL SELECT m, 3, w - 2 * (s2 + s3), d - 2 * (s2 + s3), {BASE} + h1 + h2, {BASE} + h1 + h2 + h3 FROM o WHERE n > 2),
e AS (SELECT m, max(high) AS y1 FROM t GROUP BY m),
f AS (SELECT m, y1, u.i AS i, u.f AS share, {BASE} + (y1 - {BASE}) * u.f AS y FROM (SELECT m, y1, unnest([{_SHARES}]) AS u FROM e WHERE y1 - {BASE} >= {_P.min_height})),
s AS (SELECT f.m, f.i, f.share, f.y, t.k, t.w, t.d FROM f JOIN t ON t.m = f.m AND t.low <= f.y AND f.y < t.high),
n AS (SELECT b.m, b.i, list(a.i) FILTER (a.i < b.i AND {_LIKE.format(a="a", b="b")}) AS near FROM s a JOIN s b ON a.m = b.m GROUP BY b.m, b.i),
r(m, i, heads) AS (SELECT DISTINCT m, -1, CAST([] AS INTEGER[]) FROM s UNION ALL SELECT r.m, r.i + 1, CASE WHEN len(list_intersect(r.heads, coalesce(n.near, []))) = 0 THEN list_append(r.heads, CAST(r.i + 1 AS INTEGER)) ELSE r.heads END FROM r JOIN n ON n.m = r.m AND n.i = r.i + 1),
h AS (SELECT s.*, coalesce((SELECT min(z) FROM unnest(list_intersect(r.heads, coalesce(n.near, []))) AS q(z)), s.i) AS g FROM s JOIN n ON n.m = s.m AND n.i = s.i JOIN r ON r.m = s.m AND r.i = s.i - 1),
w AS (SELECT *, row_number() OVER (PARTITION BY m, g ORDER BY w * d, i) AS rk, count(*) OVER (PARTITION BY m, g) AS members, min(share) OVER (PARTITION BY m, g) AS f0, max(share) OVER (PARTITION BY m, g) AS f1 FROM h),
g AS (SELECT m, g, members, f0, f1, w, d, row_number() OVER (PARTITION BY m ORDER BY members DESC, g) = 1 AS main FROM w WHERE rk = (members + 1) // 2),
v AS (SELECT *, main OR (members >= 2 AND f1 - f0 >= {contours.SPAN}) AS supported FROM g),
k AS (SELECT h.m, h.i, h.y, h.share, h.g, CASE WHEN lag(h.g) OVER (PARTITION BY h.m ORDER BY h.i) = h.g THEN 0 ELSE 1 END AS fresh FROM h JOIN v ON v.m = h.m AND v.g = h.g AND v.supported),
l AS (SELECT *, sum(fresh) OVER (PARTITION BY m ORDER BY i) AS run FROM k),
u0 AS (SELECT l.m, run, any_value(l.g) AS g, min(y) AS y0, max(y) AS yl, min(share) AS f0, any_value(v.w) AS w, any_value(v.d) AS d FROM l JOIN v ON v.m = l.m AND v.g = l.g GROUP BY l.m, run),
u1 AS (SELECT *, lag(w) OVER y AS uw, lag(d) OVER y AS ud, lag(yl) OVER y AS uy, row_number() OVER (PARTITION BY m ORDER BY run DESC) AS back, row_number() OVER (PARTITION BY m, g ORDER BY run) AS time FROM u0 WINDOW y AS (PARTITION BY m ORDER BY run)),
pl AS (SELECT m, high AS y, w * d AS area FROM t),
bare AS (SELECT u1.m, u1.run, min(pl.y) AS y FROM u1 JOIN pl ON pl.m = u1.m WHERE back = 1 AND uw IS NOT NULL AND w * d < uw * ud * {contours.SMALL} AND f0 >= {contours.ABOVE} AND pl.y > uy AND pl.y <= y0 AND pl.area >= uw * ud * {contours.BROAD} GROUP BY ALL),
u AS (SELECT u1.* FROM u1 LEFT JOIN bare ON bare.m = u1.m AND bare.run = u1.run WHERE bare.m IS NULL),
la AS (SELECT m, arg_max(w * d, run) AS area, arg_max(yl, run) AS yl FROM u GROUP BY m),
ro AS (SELECT e.m, e.y1, coalesce(bare.y, e.y1) AS roof, la.area, la.yl FROM e LEFT JOIN bare ON bare.m = e.m LEFT JOIN la ON la.m = e.m),
rf AS (SELECT ro.*, coalesce((SELECT min(pl.y) FROM pl WHERE pl.m = ro.m AND pl.y >= {BASE} + (ro.y1 - {BASE}) * {contours.HIGH} AND pl.y >= ro.yl - {contours.SLACK} AND pl.y < ro.roof - {contours.SLACK} AND pl.area >= ro.area * {contours.ROOF}), ro.roof) AS top FROM ro),
st AS (SELECT m, run, yl AS low, lead(y0) OVER y AS high, w, d, lead(w) OVER y AS nw, lead(d) OVER y AS nd FROM u WINDOW y AS (PARTITION BY m ORDER BY run)),
b(m, run, n, low, high, live) AS (
  SELECT m, run, 0, low, high, true FROM st WHERE high IS NOT NULL
  UNION ALL SELECT b.m, b.run, b.n + 1, CASE WHEN b.live AND {_LIKE.format(a="t", b="x")} THEN (b.low + b.high) / 2 ELSE b.low END, CASE WHEN b.live AND NOT ({_LIKE.format(a="t", b="x")}) AND {_LIKE.format(a="t", b="z")} THEN (b.low + b.high) / 2 ELSE b.high END,
    b.live AND (({_LIKE.format(a="t", b="x")}) OR ({_LIKE.format(a="t", b="z")}))
  FROM b JOIN (SELECT m, run, w, d FROM st) AS x ON x.m = b.m AND x.run = b.run JOIN (SELECT m, run, nw AS w, nd AS d FROM st) AS z ON z.m = b.m AND z.run = b.run JOIN t ON t.m = b.m AND t.low <= (b.low + b.high) / 2 AND (b.low + b.high) / 2 < t.high WHERE b.n < {contours.ROUNDS}),
c AS (SELECT b.m, b.run, (b.low + b.high) / 2 AS half, greatest(1, (b.high - b.low) / 2) AS reach, abs(st.w * st.d - st.nw * st.nd) AS change FROM b JOIN st ON st.m = b.m AND st.run = b.run WHERE b.n = {contours.ROUNDS}),
ld AS (SELECT c.m, c.run, arg_min(pl.y, abs(pl.y - half)) AS y FROM c JOIN pl ON pl.m = c.m WHERE abs(pl.y - half) < reach AND pl.area > change * {contours.LEDGE} GROUP BY c.m, c.run),
ti AS (SELECT u.m, u.run, u.w, u.d, coalesce(ld.y, c.half, rf.top) AS top FROM u JOIN rf ON rf.m = u.m LEFT JOIN c ON c.m = u.m AND c.run = u.run LEFT JOIN ld ON ld.m = u.m AND ld.run = u.run),
tb AS (SELECT *, coalesce(lag(top) OVER (PARTITION BY m ORDER BY run), {BASE}) AS bottom FROM ti),
gg AS (SELECT m, count(*) FILTER (supported) AS kinds, max(members) FILTER (main) AS members, max(f1 - f0) FILTER (main) AS span FROM v GROUP BY m),
z AS (
  SELECT rf.m, rf.y1, rf.top, gg.span, (SELECT count(*) FROM s WHERE s.m = rf.m) AS samples,
    CASE WHEN rf.y1 - {BASE} < {_P.min_height} THEN '{_G[1]}' WHEN gg.members IS NULL OR gg.members < {_P.min_support_samples} OR gg.span < {_P.min_support_span} THEN '{_G[3]}' WHEN kinds > {_P.max_tiers} THEN '{_G[4]}' WHEN EXISTS (SELECT 1 FROM u1 WHERE u1.m = rf.m AND time > 1) THEN '{_G[5]}'
      WHEN rf.yl IS NULL THEN '{_G[6]}' WHEN rf.top - {BASE} < {_P.min_height} THEN '{_G[7]}' WHEN EXISTS (SELECT 1 FROM tb WHERE tb.m = rf.m AND tb.top - tb.bottom < {contours.THIN}) THEN '{contours.TIER[1]}' END AS why FROM rf LEFT JOIN gg ON gg.m = rf.m),
q AS (SELECT m, count(*) AS tiers, sum(bottom - {BASE}) AS bottoms, sum(top - {BASE}) AS tops, arg_min(w * d, run) AS area FROM tb GROUP BY m)
SELECT z.m, CASE WHEN why IS NULL THEN CAST(tiers AS INTEGER) END AS tiers, CASE WHEN why IS NULL THEN round(bottoms, 4) END AS bottoms, CASE WHEN why IS NULL THEN round(tops, 4) END AS tops, CASE WHEN why IS NULL THEN round(top - {BASE}, 4) END AS height, CASE WHEN why IS NULL THEN round(area, 4) END AS area,
  CASE WHEN why IS NULL THEN round(y1 - top, 4) END AS roof_trim, CASE WHEN why IS NULL THEN round(0.52 + 0.35 * samples / {len(FRACTIONS)} + 0.13 * span, 3) END AS confidence, CASE WHEN why IS NULL THEN CAST(samples AS INTEGER) END AS samples, CASE WHEN why IS NULL THEN CAST(4 * tiers AS INTEGER) END AS corners,
  CASE WHEN why IS NULL THEN 100.0::DOUBLE END AS x, why AS reason FROM z LEFT JOIN q ON q.m = z.m
"""

TOP = 60.0


def _roofed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, t, points: for each supplier the walls of a box of which some are missing, and a roof of strips that meet in T-junctions, with a drawn opening."""
    m = C("m")
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    own = own.select("m", (draw(m, "w", n=60) + 40.0).alias("w"), (draw(m, "d", n=60) + 40.0).alias("d"), draw(m, "miss", n=6).alias("miss"), (draw(m, "hw", n=16) - 5.0).alias("hw"), (draw(m, "hd", n=14) + 2.0).alias("hd"))
    v = lambda x, y, z: motion.vector(x, y, z)
    zero, top, w, d = F.lit(0.0), F.lit(TOP), C("w"), C("d")
    corners = [(zero, zero), (w, zero), (w, d), (zero, d)]
    pairs = list(zip(corners, corners[1:] + corners[:1]))
    walls = [F.array(v(p[0], zero, p[1]), v(q[0], zero, q[1]), v(q[0], top, q[1])) for p, q in pairs] + [F.array(v(p[0], zero, p[1]), v(q[0], top, q[1]), v(p[0], top, p[1])) for p, q in pairs]
    # without a wall: the first for 1, the second for 2, and for 3 the first and the third
    gone = lambda k: ((C("miss") == 1) & (k == 0)) | ((C("miss") == 2) & (k == 1)) | ((C("miss") == 3) & (k % 2 == 0))
    side = own.select("m", "miss", F.posexplode(F.array(*walls)).alias("t", "points")).filter(~gone(C("t") % 4)).select("m", "t", "points")
    x0, z0, hw = F.lit(12.0), F.lit(15.0), F.greatest(C("hw"), zero)
    flat = lambda a, b, c, e: [F.array(v(a, top, b), v(c, top, b), v(c, top, e)), F.array(v(a, top, b), v(c, top, e), v(a, top, e))]
    strips = [*flat(zero, zero, x0, d), *flat(x0 + hw, zero, w, d)]
    middle = [*flat(x0, zero, x0 + hw, z0), *flat(x0, z0 + C("hd"), x0 + hw, d)]
    roof = F.concat(F.array(*strips), F.when(hw > 0, F.array(*middle)).otherwise(F.array().cast("array<array<struct<x:double,y:double,z:double>>>")))
    return side.unionByName(own.select("m", F.posexplode(roof).alias("t", "points")).select("m", (C("t") + 100).alias("t"), "points"))


def roof_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each supplier's box whether its contours or its roof make it a building, or why neither does."""
    found = roofs.analysed(_roofed(spark, sf_dir))
    return found.select("m", "method", "reason", "roof_reason", *(F.round(c, 4).alias(c) for c in ("area", "height", "roof_trim")), F.round("confidence", 3).alias("confidence"), "samples")


ROOF_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'w'", 60)} + 40.0::DOUBLE AS w, {drawn("s_suppkey, 'd'", 60)} + 40.0::DOUBLE AS d, {drawn("s_suppkey, 'miss'", 6)} AS miss, {drawn("s_suppkey, 'hw'", 16)} - 5.0::DOUBLE AS hw, {drawn("s_suppkey, 'hd'", 14)} + 2.0::DOUBLE AS hd FROM supplier),
p AS (SELECT *, greatest(hw, 0) * hd AS hole, w * d AS area, 2 * (w + d) AS per, CASE miss WHEN 1 THEN w WHEN 2 THEN d WHEN 3 THEN 2 * w ELSE 0 END AS gone, CASE miss WHEN 3 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS sides FROM o),
q AS (
  SELECT *, miss NOT IN (1, 2, 3) AS closed, hole <= {sections.HOLE} * area AND (area - hole) / area BETWEEN {roofs.COVERED[0]} AND {roofs.COVERED[1]} AS whole,
    1 - gone / per >= {roofs.SUPPORT} AND gone / per <= {roofs.BARE} AND sides <= 1 AS borne FROM p),
r AS (SELECT *, CASE WHEN closed THEN 'contours' WHEN whole AND borne THEN 'roof' END AS method FROM q)
SELECT m, method, CASE WHEN method IS NULL THEN '{_G[3]}' END AS reason, CASE WHEN method IS NULL THEN '{roofs.NO_ROOF}' END AS roof_reason, CASE WHEN method IS NOT NULL THEN round(area, 4) END AS area, CASE WHEN method IS NOT NULL THEN {TOP}::DOUBLE END AS height, CASE WHEN method IS NOT NULL THEN 0.0::DOUBLE END AS roof_trim,
  CASE method WHEN 'contours' THEN round(0.52 + 0.35 + 0.13 * {FRACTIONS[-1] - FRACTIONS[0]}, 3) WHEN 'roof' THEN round(least(0.95, 0.67 + (1 - gone / per) * 0.18 + 0.1), 3) END AS confidence, CASE method WHEN 'contours' THEN {len(FRACTIONS)} WHEN 'roof' THEN 6 END AS samples FROM r
"""

def _prisms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """m, x, z, points: for each supplier a box whose top is shifted and narrower by drawn lengths, turned; some lack a wall."""
    m = C("m")
    own = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))
    own = own.select("m", (draw(m, "w", n=60) + 16.0).alias("w"), (draw(m, "d", n=60) + 16.0).alias("d"), (draw(m, "h", n=80) + 30.0).alias("h"), (F.greatest(draw(m, "shift", n=12) - 6, F.lit(0)) / 1.0).alias("shift"), (F.greatest(draw(m, "taper", n=20) - 12, F.lit(0)) / 1.0).alias("taper"), (draw(m, "yaw", n=700) / 1000.0).alias("yaw"), (draw(m, "miss", n=8) == 0).alias("miss"),
        (draw(m, "x", n=500) * 1.0 + F.floor(m / 25) * 1000).alias("x"), (draw(m, "z", n=300) * 1.0).alias("z"), (draw(m, "base", n=60) - 20.0).alias("base"))

    def at(sx: int, sz: int, top: bool):
        w, d, off = (C("w") - C("taper"), C("d") - C("taper"), C("shift")) if top else (C("w"), C("d"), F.lit(0.0))
        x, z = sx * w / 2 + off, sz * d / 2
        return motion.vector(x * F.cos("yaw") - z * F.sin("yaw") + C("x"), C("base") + (C("h") if top else 0.0), x * F.sin("yaw") + z * F.cos("yaw") + C("z"))

    corners = ((-1, -1), (1, -1), (1, 1), (-1, 1))
    walls = [f for p, q in zip(corners, corners[1:] + corners[:1]) for f in (F.array(at(*p, False), at(*q, False), at(*q, True)), F.array(at(*p, False), at(*q, True), at(*p, True)))]
    return own.select("*", F.posexplode(F.array(*walls)).alias("t", "points")).filter(~C("miss") | (C("t") > 1))


def box_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the suppliers' boxes are buildings: five like slices, level ground of drawn height below, and room beside the larger ones."""
    shapes = _prisms(spark, sf_dir)
    grounds = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("g")).filter("g % 25 = 0").select((F.floor(C("g") / 25) * 1000 - 200.0).alias("x0"), (F.floor(C("g") / 25) * 1000 + 799.0).alias("x1"), F.lit(-200.0).alias("z0"), F.lit(480.0).alias("z1"), (draw(C("g"), "ground", n=30) - 15.0).alias("y1"))
    kept = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("g")).filter("g % 25 = 3").select(rings.box_ring(F.floor(C("g") / 25) * 1000 + 100.0, F.lit(40.0), F.floor(C("g") / 25) * 1000 + 220.0, F.lit(120.0)).alias("ring"))
    found = boxes.grounded(boxes.classified(shapes.select("m", "points")), grounds)
    done = boxes.clear(found, kept)
    side = lambda f: F.round(f("width", "depth"), 4)
    overlap = C("reason") == boxes.GROUND[3]
    return done.select("m", F.when(overlap, F.lit(None)).otherwise(C("reason")).alias("reason"), side(F.least).alias("narrow"), side(F.greatest).alias("wide"), F.round("confidence", 6).alias("confidence"), F.round("base", 4).alias("base"))


_SLICE = "SELECT unnest([" + ", ".join(f"{f}::DOUBLE" for f in boxes.SLICES) + "]) AS f"
BOX_SQL = f"""
WITH o AS (
  SELECT s_suppkey AS m, {drawn("s_suppkey, 'w'", 60)} + 16.0::DOUBLE AS w, {drawn("s_suppkey, 'd'", 60)} + 16.0::DOUBLE AS d, {drawn("s_suppkey, 'h'", 80)} + 30.0::DOUBLE AS h, CAST(greatest({drawn("s_suppkey, 'shift'", 12)} - 6, 0) AS DOUBLE) AS shift, CAST(greatest({drawn("s_suppkey, 'taper'", 20)} - 12, 0) AS DOUBLE) AS taper,
    {drawn("s_suppkey, 'miss'", 8)} = 0 AS miss, {drawn("s_suppkey, 'base'", 60)} - 20.0::DOUBLE AS base FROM supplier),
g AS (SELECT s_suppkey // 25 AS g, {drawn("s_suppkey, 'ground'", 30)} - 15.0::DOUBLE AS ground FROM supplier WHERE s_suppkey % 25 = 0),
s AS (SELECT o.*, f, w - taper * f AS wf, d - taper * f AS df, shift * f AS off, w - taper / 2 AS wm, d - taper / 2 AS dm FROM o, ({_SLICE})),
j AS (
  SELECT *, wf * df / (wm * dm) AS ratio, greatest(abs(off - shift / 2 - (wf - wm) / 2), abs(off - shift / 2 + (wf - wm) / 2), abs(df - dm) / 2) AS away, least({boxes.DRIFT}, {boxes.DRIFT_SHARE}::DOUBLE * least(wm, dm)) AS near FROM s),
k AS (SELECT m, min(ratio) AS least_ratio, arg_min(CASE WHEN ratio NOT BETWEEN {boxes.RATIO[0]} AND {boxes.RATIO[1]} THEN '{boxes.REASONS[4]}' ELSE '{boxes.REASONS[5]}' END, f) FILTER (ratio NOT BETWEEN {boxes.RATIO[0]} AND {boxes.RATIO[1]} OR away > near) AS fault FROM j GROUP BY m),
c AS (SELECT o.*, g.ground, w - taper / 2 AS wm, d - taper / 2 AS dm, least_ratio, fault, g.g IS NOT NULL AS known FROM o JOIN k ON k.m = o.m LEFT JOIN g ON g.g = o.m // 25),
r AS (SELECT *, CASE WHEN h < {boxes.LEAST_HEIGHT} OR (miss AND 6 < {boxes.LEAST_TRIANGLES}) THEN '{boxes.REASONS[0]}' WHEN wm * dm < {boxes.LEAST_AREA} THEN '{boxes.REASONS[2]}' WHEN least(wm, dm) < {boxes.SIDES[0]} THEN '{boxes.REASONS[3]}' ELSE fault END AS why FROM c),
z AS (SELECT *, CASE WHEN why IS NOT NULL THEN why WHEN NOT known THEN '{boxes.GROUND[0]}' WHEN base - ground > least({boxes.ABOVE}, h) OR base - ground < -{boxes.BELOW} THEN '{boxes.GROUND[1]}' WHEN base + h - ground < {boxes.LEAST_HEIGHT} THEN '{boxes.GROUND[2]}' END AS reason FROM r)
SELECT m, reason, CASE WHEN why IS NULL THEN round(least(wm, dm), 4) END AS narrow, CASE WHEN why IS NULL THEN round(greatest(wm, dm), 4) END AS wide, CASE WHEN why IS NULL THEN round(least(1, least_ratio), 6) END AS confidence, CASE WHEN why IS NULL THEN round(ground, 4) END AS base FROM z
"""


def boxes_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level boxes of customers, walked by falling ground area: those that share no more than a twentieth of the smaller area with one taken before, nor with what is kept."""
    n = C("c_custkey")
    rows = table(spark, sf_dir, "customer").select(n.alias("m"), (n * 37 % 397 + F.floor(n / 1500) * 4000.0).alias("x"), (n * 91 % 401 * 1.0).alias("z"), (n % 17 + 8.0).alias("width"), (n % 13 + 6.0).alias("depth"))
    ring = rings.box_ring(C("x"), C("z"), C("x") + C("width"), C("z") + C("depth"))
    own = rows.filter("m % 50 > 0").withColumns({"ring": ring, "reason": F.lit(None).cast("string")})
    return boxes.clear(own, rows.filter("m % 50 = 0").withColumn("ring", ring), cell=32.0).select("m", "reason")


CLEAR_SQL = f"""
WITH RECURSIVE b AS (SELECT c_custkey AS m, CAST(c_custkey * 37 % 397 + floor(c_custkey / 1500) * 4000 AS DOUBLE) AS x, CAST(c_custkey * 91 % 401 AS DOUBLE) AS z, c_custkey % 17 + 8.0::DOUBLE AS w, c_custkey % 13 + 6.0::DOUBLE AS d FROM customer),
p AS (SELECT a.m AS a, b.m AS b FROM b a JOIN b ON a.m <> b.m AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.z < b.z + b.d AND b.z < a.z + a.d
  WHERE (least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * (least(a.z + a.d, b.z + b.d) - greatest(a.z, b.z)) > {boxes.SHARED} * least(a.w * a.d, b.w * b.d)),
f AS (SELECT * FROM b WHERE m % 50 > 0 AND m NOT IN (SELECT a FROM p WHERE b % 50 = 0)),
o AS (SELECT f.*, row_number() OVER (ORDER BY w * d DESC, m) AS n FROM f),
q AS (SELECT o.n, o.m, coalesce(list(p.b) FILTER (p.b IS NOT NULL), []) AS others FROM o LEFT JOIN p ON p.a = o.m GROUP BY o.n, o.m),
w(n, taken) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT q.n, CASE WHEN list_has_any(w.taken, q.others) THEN w.taken ELSE list_append(w.taken, CAST(q.m AS BIGINT)) END FROM w JOIN q ON q.n = w.n + 1),
t AS (SELECT unnest(taken) AS m FROM (SELECT arg_max(taken, n) AS taken FROM w))
SELECT b.m, CASE WHEN t.m IS NULL THEN '{boxes.GROUND[3]}' END AS reason FROM b LEFT JOIN t ON t.m = b.m WHERE b.m % 50 > 0
"""

def contour_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contours of each supplier's box with missing walls show: samples, groups and failures."""
    found = contours.diagnosis(_roofed(spark, sf_dir))
    failed = F.array_join(F.transform("failures", lambda f: F.concat_ws(":", f["reason"], f["n"].cast("string"))), ",")
    return found.select("m", "samples", "groups", "persistent", "most", F.round("span", 4).alias("span"), failed.alias("failures"), "reason")


DIAGNOSIS_SQL = f"""
WITH o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 'miss'", 6)} NOT IN (1, 2, 3) AS closed FROM supplier)
SELECT m, CAST(CASE WHEN closed THEN {len(FRACTIONS)} ELSE 0 END AS BIGINT) AS samples, CAST(closed AS BIGINT) AS groups, CAST(closed AS BIGINT) AS persistent, CAST(CASE WHEN closed THEN {len(FRACTIONS)} ELSE 0 END AS BIGINT) AS most,
  CASE WHEN closed THEN {round(FRACTIONS[-1] - FRACTIONS[0], 4)}::DOUBLE ELSE 0 END AS span, CASE WHEN NOT closed THEN 'open cross-section:{len(FRACTIONS)}' END AS failures, CASE WHEN NOT closed THEN '{_G[3]}' END AS reason FROM o
"""

SQL = {contour_diagnosis: DIAGNOSIS_SQL, contour_tiers: CONTOUR_SQL, roof_analysis: ROOF_SQL, box_buildings: BOX_SQL, boxes_clear: CLEAR_SQL}
