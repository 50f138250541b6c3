"""Registered queries: buildings from whole floors and from the bodies that floors are split into, with equal SQL.

The made floors are rectangles whose sides, setbacks and faults come from MD5 numbers of model and floor, so that groups, runs
and gates of all kinds occur; the SQL makes the same rectangles and computes the rest by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import massing
from strataframe.plans.drawn import draw, drawn, table

C = F.col
SIDE, CELL, SIZE, GROUND, UPPER = 20, 3.0, 60.0, 15.0, 12.5
SLAB = massing.FloorParams().slab


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("m"))


def _each(name: str, low: Column | int, high: Column | int) -> Column:
    return F.explode(F.when(F.lit(low) <= F.lit(high), F.sequence(F.lit(low), F.lit(high)))).alias(name)


def _models(floors: DataFrame) -> DataFrame:
    """floors: m, floors; with the sizes that all models share, as high as their floors."""
    height = SLAB + GROUND + (C("floors") - 1) * (UPPER + SLAB) + SLAB
    return floors.select("m", F.lit(CELL).alias("cell"), F.lit(SIZE).alias("size_x"), height.alias("size_y"), F.lit(SIZE).alias("size_z"), F.lit(GROUND).alias("ground"), F.lit(UPPER).alias("upper"), "floors")


def _stacks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(models, cells): for each supplier 2 to 9 floors of a rectangle, set back from a drawn floor on; some are empty or shortened, have a hole of one
    cell, a cell apart, a courtyard or a gap."""
    m, k = C("m"), C("k")
    own = _suppliers(spark, sf_dir).select(
        "m", (draw(m, "f", n=8) + 2).alias("floors"), (draw(m, "a", n=2) + 1).alias("a0"), (20 - draw(m, "b", n=2)).alias("a1"), (draw(m, "c", n=2) + 1).alias("j0"), (20 - draw(m, "d", n=2)).alias("j1"),
        (draw(m, "e", n=12) + 1).alias("cut"), (draw(m, "s", n=8) + 1).alias("back"), (draw(m, "y", n=6) == 0).alias("odd"),
    )
    rows = own.withColumn("k", _each("k", 1, C("floors"))).withColumn("mode", draw(m, k, "x", n=30))
    back = F.when(k > C("cut"), C("back")).otherwise(0)
    rows = rows.withColumns({"i0": C("a0") + back, "i1": C("a1") - back})
    short = F.when(C("mode") == 1, 1).when(C("mode") == 2, 3).otherwise(0)
    rows = rows.withColumn("i1", F.when(C("mode") == 4, F.least(C("i1"), F.lit(17))).otherwise(C("i1") - short)).withColumn("wide", (C("i0") <= 8) & (C("i1") >= 12)).filter("mode <> 0")
    cells = rows.withColumn("i", _each("i", C("i0"), C("i1"))).withColumn("j", _each("j", C("j0"), C("j1")))
    hole = (C("mode") == 3) & C("wide") & (C("i") == 10) & (C("j") == 10)
    yard = (C("mode") == 5) & C("odd") & C("wide") & C("i").between(9, 11) & C("j").between(9, 11)
    gap = (C("mode") == 6) & C("odd") & C("wide") & (C("i") == 10)
    speck = rows.filter("mode = 4 AND i0 <= i1").select("m", "k", F.lit(20).alias("i"), F.lit(10).alias("j"))
    return _models(own.select("m", "floors")), cells.filter(~(hole | yard | gap)).select("m", "k", "i", "j").unionByName(speck)


def grid_massing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each supplier's floors are as a building and by which evidence, or why they are none."""
    models, cells = _stacks(spark, sf_dir)
    found = massing.grid_plans(cells, models, SIDE)
    total = lambda f: F.round(F.aggregate("tiers", F.lit(0.0), lambda n, t: n + t[f]), 6)
    e = lambda c, to: C(f"evidence.{c}").alias(to)
    return found.select(
        "m", F.size("tiers").alias("tiers"), total("bottom").alias("bottoms"), total("top").alias("tops"), F.round("height", 6).alias("height"), F.round("area", 6).alias("area"), F.round("confidence", 6).alias("confidence"), "reason",
        e("valid_floors", "valid"), e("base_support_floors", "base_floors"), e("regularized_floors", "regularized"), e("bridged_missing_floors", "bridged"), F.round("evidence.max_regularized_area_change", 6).alias("regular_change"),
        F.round("evidence.removed_island_area", 6).alias("islands"), F.round("evidence.filled_hole_area", 6).alias("holes"), F.round("evidence.envelope_coverage", 6).alias("coverage"),
    )


_BOTTOM = f"CASE WHEN {{0}} <= 1 THEN 0.0 ELSE {SLAB!r}::DOUBLE + {GROUND} + ({{0}} - 2) * ({UPPER} + {SLAB!r}::DOUBLE) END"
_P = massing.GridMassing()
_G, _WALK, _FLOOR = massing.GATES, massing.WALK, massing.FLOOR
MASSING_SQL = f"""
WITH RECURSIVE o AS (
  SELECT s_suppkey AS m, {drawn("s_suppkey, 'f'", 8)} + 2 AS floors, {drawn("s_suppkey, 'a'", 2)} + 1 AS a0, 20 - {drawn("s_suppkey, 'b'", 2)} AS a1, {drawn("s_suppkey, 'c'", 2)} + 1 AS j0, 20 - {drawn("s_suppkey, 'd'", 2)} AS j1,
    {drawn("s_suppkey, 'e'", 12)} + 1 AS cut, {drawn("s_suppkey, 's'", 8)} + 1 AS back, {drawn("s_suppkey, 'y'", 6)} = 0 AS odd FROM supplier),
l AS (SELECT *, unnest(generate_series(1, floors)) AS k FROM o),
d AS (SELECT *, {drawn("m, k, 'x'", 30)} AS mode, CASE WHEN k > cut THEN back ELSE 0 END AS b FROM l),
s AS (SELECT m, k, floors, mode, odd, j0, j1, a0 + b AS i0, CASE mode WHEN 4 THEN least(a1 - b, 17) WHEN 1 THEN a1 - b - 1 WHEN 2 THEN a1 - b - 3 ELSE a1 - b END AS i1 FROM d),
t AS (SELECT *, mode = 0 OR i0 > i1 AS none, i0 <= 8 AND i1 >= 12 AS wide, (i1 - i0 + 1) * (j1 - j0 + 1) AS n, (j1 - j0 + 1) AS deep FROM s),
u AS (SELECT *, CASE WHEN mode = 3 AND wide THEN 1 WHEN mode = 5 AND odd AND wide THEN 9 ELSE 0 END AS hole, CASE WHEN mode = 6 AND odd AND wide THEN (10 - i0) * deep ELSE 0 END AS part, CASE WHEN mode = 6 AND odd AND wide THEN (i1 - 10) * deep WHEN mode = 4 THEN 1 ELSE 0 END AS other FROM t),
x AS (
  SELECT *, CASE WHEN part > 0 THEN greatest(part, other) ELSE n - hole END AS most, CASE WHEN part > 0 THEN least(part, other) ELSE other END AS least_part FROM u),
f AS (
  SELECT m, k, floors, i0, i1, j0, j1, none, 9.0::DOUBLE * n AS raw, CASE WHEN mode = 4 THEN 9.0::DOUBLE ELSE 0.0::DOUBLE END AS island, 9.0::DOUBLE * hole AS hole_area,
    CASE WHEN none THEN 'empty floor' WHEN least_part > 0 AND most < {_P.min_dominant_area} * (most + least_part) THEN 'substantial disconnected floor bodies'
      WHEN least_part > {_P.max_island_cells} OR 9 * least_part > {_P.max_island_area} THEN 'detached floor body exceeds fragment bounds'
      WHEN hole > {_P.max_hole_cells} OR 9 * hole > {_P.max_hole_area} THEN 'courtyard exceeds small-hole bounds' WHEN hole > (most + least_part) * {_P.max_hole_fraction} THEN 'too much enclosed empty area'
      WHEN 9.0 * n < {_P.min_area} THEN '{_FLOOR[0]}' WHEN 3 * least(i1 - i0 + 1, deep) < {_P.min_width} THEN '{_FLOOR[4]}' END AS reason FROM x),
v AS (SELECT * FROM f WHERE reason IS NULL),
c AS (
  SELECT a.m, a.k AS a, b.k AS b, a.raw AS ra, b.raw AS rb, 9.0 * greatest(0, least(a.i1, b.i1) - greatest(a.i0, b.i0) + 1) * greatest(0, least(a.j1, b.j1) - greatest(a.j0, b.j0) + 1) AS inter FROM v a JOIN v b ON a.m = b.m),
j AS (SELECT m, a, b, inter / (ra + rb - inter) AS jac FROM c),
n AS (SELECT m, b AS k, list(a) FILTER (a < b AND jac >= {_P.similarity}) AS near FROM j GROUP BY m, b),
r(m, k, heads) AS (
  SELECT m, 0, CAST([] AS INTEGER[]) FROM o
  UNION ALL SELECT r.m, r.k + 1, CASE WHEN n.k IS NOT NULL AND len(list_intersect(r.heads, coalesce(n.near, []))) = 0 THEN list_append(r.heads, CAST(r.k + 1 AS INTEGER)) ELSE r.heads END
  FROM r JOIN o ON o.m = r.m AND r.k < o.floors LEFT JOIN n ON n.m = r.m AND n.k = r.k + 1),
h AS (SELECT v.*, coalesce((SELECT min(z) FROM unnest(list_intersect(r.heads, coalesce(n.near, []))) AS q(z)), v.k) AS g FROM v JOIN n ON n.m = v.m AND n.k = v.k JOIN r ON r.m = v.m AND r.k = v.k - 1),
w AS (SELECT *, row_number() OVER (PARTITION BY m, g ORDER BY raw, k) AS rk, count(*) OVER (PARTITION BY m, g) AS members, count(*) OVER (PARTITION BY m) AS valid FROM h),
e AS (SELECT m, g, k AS mid, raw, i0, i1, j0, j1, members, members >= {_P.min_support_floors} OR (floors = 3 AND members >= 2 AND valid = 3) AS supported FROM w WHERE rk = (members + 1) // 2),
p AS (SELECT h.m, h.k, min(e.g) AS g FROM h JOIN e own ON own.m = h.m AND own.g = h.g AND NOT own.supported JOIN e ON e.m = h.m AND e.supported JOIN j ON j.m = h.m AND j.a = h.k AND j.b = e.mid
  WHERE h.raw / e.raw BETWEEN {massing.NEAR_AREA[0]} AND {massing.NEAR_AREA[1]} AND j.jac >= {_P.nearby_similarity} GROUP BY h.m, h.k),
a AS (SELECT f.*, coalesce(e.g, p.g) AS given FROM f LEFT JOIN h ON h.m = f.m AND h.k = f.k LEFT JOIN e ON e.m = h.m AND e.g = h.g AND e.supported LEFT JOIN p ON p.m = f.m AND p.k = f.k),
b AS (SELECT *, CASE WHEN given IS NOT NULL THEN given WHEN reason IS NOT NULL AND lag(given) OVER y = lead(given) OVER y THEN lag(given) OVER y END AS home, max(CASE WHEN given IS NOT NULL THEN k END) OVER (PARTITION BY m) AS last FROM a WINDOW y AS (PARTITION BY m ORDER BY k)),
i AS (SELECT *, CASE WHEN lag(home) OVER (PARTITION BY m ORDER BY k) = home THEN 0 ELSE 1 END AS fresh FROM b WHERE k <= last AND home IS NOT NULL),
q AS (SELECT i.m, i.k, i.home, e.raw, e.i0, e.i1, e.j0, e.j1, e.members, row_number() OVER (PARTITION BY i.m ORDER BY i.k) AS run, row_number() OVER (PARTITION BY i.m, i.home ORDER BY i.k) AS time FROM i JOIN e ON e.m = i.m AND e.g = i.home WHERE fresh = 1),
z AS (SELECT *, lead(k) OVER y AS after, lag(i0) OVER y > i0 OR lag(i1) OVER y < i1 OR lag(j0) OVER y > j0 OR lag(j1) OVER y < j1 AS off FROM q WINDOW y AS (PARTITION BY m ORDER BY run)),
ma AS (
  SELECT m, any_value(floors) AS floors, count(*) FILTER (reason IS NULL) AS valid, any_value(last) AS last, max(given) FILTER (k = 1) AS base, bool_or(k = 1 AND reason IS NULL) AS ground, arg_min(reason, k) FILTER (regexp_matches(reason, '{massing.AMBIGUOUS}')) AS odd FROM b GROUP BY m),
mb AS (
  SELECT ma.*, e.raw AS base_raw, e.members, 3 * (e.i1 - e.i0 + 1) < {_P.min_envelope_span * SIZE} OR 3 * (e.j1 - e.j0 + 1) < {_P.min_envelope_span * SIZE} OR e.raw < {_P.min_envelope_area * SIZE * SIZE} AS low, {_BOTTOM.format("(floors + 1)")} + {SLAB!r}::DOUBLE AS size_y,
    {_BOTTOM.format("(ma.last + 1)")} + {SLAB!r}::DOUBLE AS height, (SELECT count(*) FROM e WHERE e.m = ma.m AND e.supported) AS tiers FROM ma LEFT JOIN e ON e.m = ma.m AND e.g = ma.base),
mc AS (
  SELECT mb.*, (SELECT {{'k': b.k, 't': 0}} FROM b WHERE b.m = mb.m AND b.k <= b.last AND b.home IS NULL ORDER BY b.k LIMIT 1) AS e0, (SELECT {{'k': min(z.k), 't': 1}} FROM z WHERE z.m = mb.m AND time > 1) AS e1, (SELECT {{'k': min(z.k), 't': 2}} FROM z WHERE z.m = mb.m AND off) AS e2,
    (SELECT arg_max(z.raw, z.run) FROM z WHERE z.m = mb.m) AS last_raw FROM mb),
md AS (
  SELECT mc.*, (SELECT arg_min(t, k * 10 + t) FROM (SELECT e0.k AS k, e0.t AS t UNION ALL SELECT e1.k, e1.t UNION ALL SELECT e2.k, e2.t) WHERE k IS NOT NULL) AS walk, EXISTS (SELECT 1 FROM b WHERE b.m = mc.m AND b.k > b.last AND b.reason IS NULL AND b.raw > mc.last_raw * {massing.UPPER_SHARE}) AS above FROM mc),
me AS (
  SELECT *, CASE WHEN floors < {_P.min_floors} THEN '{_G["few"]}' WHEN odd IS NOT NULL THEN '{_G["ambiguous"]}' || odd WHEN NOT ground THEN '{_G["ground"]}' WHEN valid < {_P.min_valid_fraction} * floors THEN '{_G["valid"]}' WHEN tiers = 0 THEN '{_G["repeated"]}'
    WHEN tiers > {_P.max_tiers} THEN '{_G["distinct"]}' WHEN base IS NULL THEN '{_G["base"]}' WHEN low THEN '{_G["envelope"]}' WHEN least(size_y, height) < {_P.min_height_coverage} * size_y THEN '{_G["height"]}'
    WHEN walk = 0 THEN '{_WALK[0]}' WHEN walk = 1 THEN '{_WALK[1]}' WHEN walk = 2 THEN '{_WALK[2]}' WHEN last < {_P.min_valid_fraction} * floors THEN '{_G["supported"]}' WHEN above THEN '{_G["upper"]}' END AS why FROM md),
mf AS (
  SELECT z.m, count(*) AS tiers, sum(CASE WHEN run = 1 THEN 0.0 ELSE {_BOTTOM.format("k")} END) AS bottoms, sum(CASE WHEN after IS NULL THEN least(me.size_y, me.height) ELSE {_BOTTOM.format("after")} END) AS tops, arg_min(z.raw, run) AS area FROM z JOIN me ON me.m = z.m GROUP BY z.m),
mg AS (SELECT b.m, CAST(count(*) FILTER (given IS NOT NULL AND (b.i0, b.i1, b.j0, b.j1) <> (e.i0, e.i1, e.j0, e.j1)) AS INTEGER) AS regularized, max(abs(e.raw / b.raw - 1)) FILTER (given IS NOT NULL) AS regular_change, CAST(count(*) FILTER (given IS NULL) AS INTEGER) AS bridged FROM b JOIN e ON e.m = b.m AND e.g = b.home WHERE b.k <= b.last GROUP BY b.m),
mh AS (SELECT m, sum(island) AS islands, sum(hole_area) AS holes FROM v GROUP BY m)
SELECT me.m, CASE WHEN why IS NULL THEN CAST(mf.tiers AS INTEGER) END AS tiers, CASE WHEN why IS NULL THEN round(bottoms, 6) END AS bottoms, CASE WHEN why IS NULL THEN round(tops, 6) END AS tops, CASE WHEN why IS NULL THEN round(least(size_y, height), 6) END AS height,
  CASE WHEN why IS NULL THEN round(area, 6) END AS area, CASE WHEN why IS NULL THEN round(least(0.85, 0.60 + 0.20 * valid / floors), 6) END AS confidence, why AS reason, CASE WHEN why IS NULL THEN CAST(valid AS INTEGER) END AS valid, CASE WHEN why IS NULL THEN CAST(members AS INTEGER) END AS base_floors,
  CASE WHEN why IS NULL THEN regularized END AS regularized, CASE WHEN why IS NULL THEN bridged END AS bridged, CASE WHEN why IS NULL THEN round(regular_change, 6) END AS regular_change, CASE WHEN why IS NULL THEN round(islands, 6) END AS islands,
  CASE WHEN why IS NULL THEN round(holes, 6) END AS holes, CASE WHEN why IS NULL THEN round(base_raw / {SIZE * SIZE}, 6) END AS coverage
FROM me LEFT JOIN mf ON mf.m = me.m LEFT JOIN mg ON mg.m = me.m LEFT JOIN mh ON mh.m = me.m
"""


def _towers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(models, cells): for each supplier a tower, or two side by side of drawn widths and heights, some of them on a podium."""
    m = C("m")
    own = _suppliers(spark, sf_dir).select("m", (draw(m, "t", n=4) > 0).alias("two"), (draw(m, "p", n=14) + 2).alias("p"), (draw(m, "l", n=6) + 1).alias("hl"), (draw(m, "r", n=6) + 1).alias("hr"), (draw(m, "w", n=10) + 10).alias("j1"), F.greatest(draw(m, "q", n=7) - 2, F.lit(0)).alias("q"))
    own = own.withColumn("q", F.when(C("two"), C("q")).otherwise(0)).withColumn("floors", C("q") + F.when(C("two"), F.greatest("hl", "hr")).otherwise(C("hl")))
    rows = own.withColumn("k", _each("k", 1, C("floors"))).withColumn("i", _each("i", 1, SIDE)).withColumn("j", _each("j", 1, C("j1")))
    left, right = (C("i") <= C("p")) & (C("k") <= C("q") + C("hl")), C("two") & (C("i") >= C("p") + 2) & (C("k") <= C("q") + C("hr"))
    return _models(own.select("m", "floors")), rows.filter((C("k") <= C("q")) | left | right).select("m", "k", "i", "j")


def split_massing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertical bodies of each supplier's towers, each as a building, and why a source is not split."""
    models, cells = _towers(spark, sf_dir)
    found = massing.split_plans(cells, models, SIDE)
    return found.select("m", "cells", "first", "tiny", F.round("area", 6).alias("area"), F.round("height", 6).alias("height"), "reason", "source_reason")


_TOWERS = f"""o AS (SELECT s_suppkey AS m, {drawn("s_suppkey, 't'", 4)} > 0 AS two, {drawn("s_suppkey, 'p'", 14)} + 2 AS p, {drawn("s_suppkey, 'l'", 6)} + 1 AS hl, {drawn("s_suppkey, 'r'", 6)} + 1 AS hr, {drawn("s_suppkey, 'w'", 10)} + 10 AS j1, greatest({drawn("s_suppkey, 'q'", 7)} - 2, 0) AS q0 FROM supplier),
own AS (SELECT *, CASE WHEN two THEN q0 ELSE 0 END AS q, CASE WHEN two THEN greatest(hl, hr) + q0 ELSE hl END AS floors FROM o)"""
#: Of a body of n equal rectangles of w by d cells: why it is no building, and its height, which its own envelope bounds.
_BODY = f"CASE WHEN n < {{0}} THEN '{_G['few']}' WHEN 9.0 * w * d < {_P.min_area} OR 3 * least(w, d) < {_P.min_width} THEN '{_G['ground']}' END"
SPLIT_SQL = f"""
WITH {_TOWERS},
b AS (
  SELECT m, 1 AS body, p AS w, j1 AS d, hl AS n, 1 AS first, false AS mixed, p * j1 AS most, p * j1 * hl AS cells FROM own WHERE q = 0 UNION ALL SELECT m, 2, 19 - p, j1, hr, 1, false, (19 - p) * j1, (19 - p) * j1 * hr FROM own WHERE two AND q = 0
  UNION ALL SELECT m, 1, 20, j1, floors, 1, true, 20 * j1, j1 * (20 * q + p * hl + (19 - p) * hr) FROM own WHERE q > 0),
c AS (SELECT *, most <= {massing.Split().max_tiny_cells} AND cells <= {massing.Split().max_tiny_fraction} * sum(cells) OVER (PARTITION BY m) AS tiny, CASE WHEN mixed THEN 'body branches or merges' ELSE {_BODY.format(_P.min_floors)} END AS reason FROM b)
SELECT m, CAST(cells AS BIGINT) AS cells, first, tiny, CASE WHEN reason IS NULL THEN 9.0::DOUBLE * w * d END AS area, CASE WHEN reason IS NULL THEN round({_BOTTOM.format("(n + 1)")} + {SLAB!r}::DOUBLE, 6) END AS height, reason,
  CASE WHEN count(*) FILTER (NOT tiny) OVER y < 2 THEN 'one body only' WHEN count(*) FILTER (NOT tiny) OVER y > {massing.Split().max_bodies} THEN 'too many bodies' ELSE min(CASE WHEN NOT tiny THEN reason END) OVER y END AS source_reason
FROM c WINDOW y AS (PARTITION BY m)
"""


def residual_massing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of floors that are taken as buildings, and how many cells are left."""
    models, cells = _towers(spark, sf_dir)
    accepted, rest = massing.residual_plans(cells, models, SIDE)
    taken = accepted.groupBy("m").agg(F.count("*").alias("plans"), F.sum("cells").alias("taken"), F.round(F.sum("area"), 6).alias("area"))
    left = rest.groupBy("m").agg(F.count("*").alias("left"))
    return models.select("m").join(taken, "m", "left").join(left, "m", "left").select("m", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("plans", "taken", "left")), F.coalesce("area", F.lit(0.0)).alias("area"))


_R = massing.configured(massing.GridMassing, massing.RESIDUAL_GRID)
RESIDUAL_SQL = f"""
WITH {_TOWERS},
b AS (SELECT m, 20 AS w, j1 AS d, q AS n FROM own WHERE q > 0 UNION ALL SELECT m, p, j1, hl FROM own UNION ALL SELECT m, 19 - p, j1, hr FROM own WHERE two),
c AS (SELECT *, w * d * n AS cells, sum(w * d * n) OVER (PARTITION BY m) AS total, {_BODY.format(_R.min_floors)} AS reason FROM b),
e AS (SELECT *, reason IS NULL AND w * d > {massing.Residual().max_tiny_cells} AND cells >= {massing.Residual().min_extract_fraction} * total AS ok FROM c)
SELECT m, count(*) FILTER (ok) AS plans, CAST(coalesce(sum(cells) FILTER (ok), 0) AS BIGINT) AS taken, CAST(coalesce(sum(cells) FILTER (NOT ok), 0) AS BIGINT) AS "left", round(coalesce(sum(9.0::DOUBLE * w * d) FILTER (ok), 0), 6) AS area FROM e GROUP BY m
"""

def final_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan for each supplier's towers, by the first of three ways that gives one; some are too small for all but the last."""
    models, cells = _towers(spark, sf_dir)
    thin = cells.filter((C("m") % 9 != 4) | ((C("i") <= 2) & (C("j") <= 5)))
    return massing.final_plans(thin, models, SIDE).select("m", "n", "method", *(F.round(c, 4).alias(c) for c in ("bottom", "top", "area")), "confidence", F.size("ring").alias("corners"))


_A = massing.Final()
_WAYS = list(massing.WAYS)
FINAL_SQL = f"""
WITH {_TOWERS},
g AS (SELECT own.*, m % 9 = 4 AS thin, {_BOTTOM.format("(floors + 1)")} + {SLAB!r}::DOUBLE AS size_y FROM own),
s AS (SELECT m, 0 AS body, size_y, q AS n, 1 AS first, 20 AS w, j1 AS d, thin FROM g WHERE q > 0 UNION ALL SELECT m, 1, size_y, hl, q + 1, p, j1, thin FROM g UNION ALL SELECT m, 2, size_y, hr, q + 1, 19 - p, j1, thin FROM g WHERE two),
-- only the cells of the first two rows and five columns are left of some: the left tower, over the podium where there is one
t AS (SELECT m, body, size_y, n, first, w, d FROM s WHERE NOT thin UNION ALL SELECT m, 1, size_y, q + hl, 1, 2, 5 FROM g WHERE thin),
u AS (SELECT *, {_BOTTOM.format("first")} AS bottom, least(size_y, {_BOTTOM.format("(first + n)")} + {SLAB!r}::DOUBLE) AS top FROM t),
v AS (SELECT *, w * d * n >= {_A.min_segment_cells} AND 3 * least(w, d) >= {_A.min_width} AND top - bottom >= {_A.min_height} AS large FROM u),
f AS (SELECT m, count(*) FILTER (large) AS n FROM v GROUP BY m),
a AS (SELECT m, size_y, max(CASE WHEN thin THEN 2 WHEN two OR q > 0 THEN 20 ELSE p END) AS w, max(CASE WHEN thin THEN 5 ELSE j1 END) AS d FROM g GROUP BY m, size_y)
SELECT v.m, CAST(row_number() OVER (PARTITION BY v.m ORDER BY first, body) AS INTEGER) AS n, '{_WAYS[0]}' AS method, round(bottom, 4) AS bottom, round(top, 4) AS top, 9.0::DOUBLE * w * d AS area, {massing.WAYS[_WAYS[0]]}::DOUBLE AS confidence, 4 AS corners
FROM v JOIN f ON f.m = v.m AND f.n BETWEEN 1 AND {_A.max_bodies} WHERE large
UNION ALL SELECT a.m, 1, CASE WHEN ok THEN '{_WAYS[1]}' ELSE '{_WAYS[2]}' END, 0.0, round(CASE WHEN ok THEN size_y ELSE greatest({massing.ENVELOPE[1]}, size_y) END, 4), CASE WHEN ok THEN 9.0::DOUBLE * w * d ELSE {SIZE * SIZE} END, CASE WHEN ok THEN {massing.WAYS[_WAYS[1]]}::DOUBLE ELSE {massing.WAYS[_WAYS[2]]}::DOUBLE END, 4
FROM (SELECT *, 3 * least(w, d) >= {_A.min_width} AND size_y >= {_A.min_height} AS ok FROM a) AS a JOIN f ON f.m = a.m AND f.n NOT BETWEEN 1 AND {_A.max_bodies}
"""

SQL = {final_cascade: FINAL_SQL, grid_massing: MASSING_SQL, split_massing: SPLIT_SQL, residual_massing: RESIDUAL_SQL}
