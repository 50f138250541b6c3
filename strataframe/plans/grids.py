"""Registered queries over whole floors of occupancy grids (the cells of plans/occupancy.py), with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import building
from strataframe.operators import masks, tables
from strataframe.plans.occupancy import CELLS, FLOODED, SIDE, _cells
from strataframe.sources import meshes
from strataframe.plans.drawn import table

C = F.col
#: Of the grids in these queries: the cell, and the sizes of their boxes, so that the last row and column are cut.
CELL, SIZE_X, SIZE_Z = 3.0, 29.0, 28.5
_AREA = f"CASE WHEN i = 10 THEN {SIZE_X - 27} ELSE 3 END * CASE WHEN j = 10 THEN {SIZE_Z - 27} ELSE 3 END"


def occ_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of floors and back to cells; the occupied count, the first cell, and what a point of the floor is in."""
    cells = _cells(spark, sf_dir)
    coded = masks.to_masks(cells, SIDE)
    back = masks.from_masks(coded, SIDE).groupBy("m", "k").agg(F.count("*").alias("n"))
    x, z = (C("m") % 30) - 2.0, (C("m") % 17) + 0.5
    i, j = (building.cell_of(F.lit(0.0), F.lit(CELL), v) for v in (x, z))
    side = F.lit(SIDE)
    rows = coded.join(back, ["m", "k"]).withColumns({"i": i, "j": j})
    return rows.select("m", "k", "mask", "n", F.instr("mask", "1").alias("first"), building.occupied(C("mask"), C("i"), C("j"), side, side).alias("hit"), building.cell_centre(F.lit(0.0), F.lit(CELL), C("i")).alias("centre"))


MASKS_SQL = f"""{CELLS},
f AS (SELECT DISTINCT m, k FROM c), g AS (SELECT m, k, i, j FROM f, (SELECT unnest(generate_series(1, 10)) AS i), (SELECT unnest(generate_series(1, 10)) AS j)),
b AS (SELECT g.m, g.k, string_agg(CASE WHEN c.m IS NULL THEN '0' ELSE '1' END, '' ORDER BY g.i, g.j) AS mask, count(c.m) AS n FROM g LEFT JOIN c ON g.m = c.m AND g.k = c.k AND g.i = c.i AND g.j = c.j GROUP BY g.m, g.k),
p AS (SELECT *, CAST(floor((m % 30 - 2) / 3.0::DOUBLE) AS INTEGER) + 1 AS pi, CAST(floor((m % 17 + 0.5::DOUBLE) / 3) AS INTEGER) + 1 AS pj FROM b)
SELECT m, k, mask, n, CAST(strpos(mask, '1') AS INTEGER) AS first, pi BETWEEN 1 AND 10 AND pj BETWEEN 1 AND 10 AND coalesce(mask[(pi - 1) * 10 + pj] = '1', false) AS hit, (pi - 0.5::DOUBLE) * 3 AS centre FROM p
"""


def mask_dedupe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantities of an order as a mask of one row: each distinct mask is measured once, and all orders that have it get the figure."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cells = masks.cells(lines.select(C("l_orderkey").alias("m"), F.lit(1).alias("k"), F.lit(1).alias("i"), ((C("l_quantity").cast("long") % SIDE).cast("int") + 1).alias("j")))
    coded = masks.to_masks(cells, SIDE)
    uses = coded.groupBy("mask").agg(F.count("*").alias("uses"))
    ones = lambda df: df.withColumn("n", F.length(F.translate("mask", "0", "")))
    return masks.reused(coded, ones).join(uses, "mask").select("m", "n", "uses")


REUSE_SQL = """WITH d AS (SELECT DISTINCT l_orderkey AS m, CAST(l_quantity AS BIGINT) % 10 AS j FROM lineitem), s AS (SELECT m, list_sort(list(j)) AS mask FROM d GROUP BY m)
SELECT m, CAST(len(mask) AS INTEGER) AS n, count(*) OVER (PARTITION BY mask) AS uses FROM s"""


def vertical_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = masks.chains(_cells(spark, sf_dir), SIDE)
    return found.groupBy("m", "chain").agg(F.count("*").alias("floors"), F.sum("cells").alias("cells"), F.max("cells").alias("most"), F.min("k").alias("first"), F.max("k").alias("last"))


CHAINS_SQL = f"""{FLOODED}, n AS (SELECT m, component, k, count(*) AS cells FROM f GROUP BY ALL),
l AS (SELECT DISTINCT a.component AS x, b.component AS y FROM f a JOIN f b ON a.m = b.m AND a.i = b.i AND a.j = b.j AND b.k = a.k + 1),
o AS (SELECT x, y FROM l QUALIFY count(*) OVER (PARTITION BY x) = 1 AND count(*) OVER (PARTITION BY y) = 1),
w AS (SELECT component AS x, component AS chain FROM n WHERE component NOT IN (SELECT y FROM o) UNION ALL SELECT o.y, w.chain FROM w JOIN o ON o.x = w.x)
SELECT m, chain, count(*) AS floors, CAST(sum(cells) AS BIGINT) AS cells, max(cells) AS most, min(k) AS first, max(k) AS last FROM n JOIN w ON w.x = n.component GROUP BY m, chain""".replace(", n AS (SELECT *, m *", ", z AS (SELECT *, m *").replace("FROM n\n", "FROM z\n").replace("JOIN n ON n.m", "JOIN z AS n ON n.m")


def occ_holes_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids that are nearly full (the places that the cells leave), cleaned of small islands and holes."""
    cells = _cells(spark, sf_dir)
    full = masks.holes(cells, SIDE).select(*masks.CELL)
    found, kept = masks.cleaned(full, SIDE, CELL, SIZE_X, SIZE_Z)
    left = kept.groupBy("m", "k").agg(F.count("*").alias("cells"))
    names = ["bodies", "islands", "holes", *(F.round(c, 6).alias(c) for c in ("area", "dominant", "island_area", "hole_area")), "reason", "cells"]
    return found.join(left, ["m", "k"], "left").select("m", "k", *names)


def _flood(name: str, cells: str) -> str:
    """The least node that each of the cells reaches on its floor."""
    return f"""{name}_r AS (SELECT m, k, i, j, node, node AS seed FROM {cells} UNION SELECT n.m, n.k, n.i, n.j, n.node, r.seed FROM {name}_r AS r JOIN {cells} AS n ON n.m = r.m AND n.k = r.k AND abs(n.i - r.i) + abs(n.j - r.j) = 1 AND r.seed < n.node),
{name} AS (SELECT m, k, i, j, node, min(seed) AS component FROM {name}_r GROUP BY ALL)"""


_NODE = f"m * {masks.PER_MODEL} + k * 100 + (i - 1) * 10 + j - 1 AS node"
CLEAN_SQL = f"""{CELLS},
g AS (SELECT m, k, i, j, {_NODE} FROM (SELECT DISTINCT m, k FROM c), (SELECT unnest(generate_series(1, 10)) AS i), (SELECT unnest(generate_series(1, 10)) AS j)),
s AS (SELECT g.* FROM g ANTI JOIN c ON g.m = c.m AND g.k = c.k AND g.i = c.i AND g.j = c.j),
{_flood("t", "s")},
b AS (SELECT m, k, component, count(*) AS n, sum({_AREA}) AS area FROM t GROUP BY ALL),
d AS (SELECT *, row_number() OVER (PARTITION BY m, k ORDER BY area DESC, component) AS rank FROM b),
x AS (SELECT m, k, count(*) AS bodies, sum(area) AS area, max(area) / sum(area) AS dominant, count(*) FILTER (rank > 1) AS islands, coalesce(sum(area) FILTER (rank > 1), 0) AS island_area, coalesce(bool_or(rank > 1 AND (n > 4 OR area > 200)), false) AS big FROM d GROUP BY ALL),
y AS (SELECT t.* FROM t JOIN d ON t.component = d.component AND rank = 1),
e AS (SELECT g.* FROM g ANTI JOIN y ON g.node = y.node SEMI JOIN x ON g.m = x.m AND g.k = x.k),
{_flood("h", "e")},
q AS (SELECT m, k, component, count(*) AS n, sum({_AREA}) AS area FROM h GROUP BY ALL HAVING NOT bool_or(i IN (1, 10) OR j IN (1, 10))),
z AS (SELECT m, k, count(*) AS holes, sum(n) AS hole_cells, sum(area) AS hole_area, bool_or(n > 1 OR area > 36) AS yard FROM q GROUP BY ALL),
o AS (SELECT x.*, coalesce(holes, 0) AS holes, coalesce(hole_area, 0) AS hole_area, coalesce(hole_cells, 0) AS hole_cells, CASE WHEN bodies > 1 AND dominant < 0.95::DOUBLE THEN 'substantial disconnected floor bodies' WHEN big THEN 'detached floor body exceeds fragment bounds'
  WHEN coalesce(yard, false) THEN 'courtyard exceeds small-hole bounds' WHEN coalesce(hole_area, 0) > area * 0.01::DOUBLE THEN 'too much enclosed empty area' END AS reason FROM x LEFT JOIN z ON x.m = z.m AND x.k = z.k)
SELECT m, k, bodies, islands, holes, round(CAST(area AS DOUBLE), 6) AS area, round(CAST(dominant AS DOUBLE), 6) AS dominant, round(CAST(island_area AS DOUBLE), 6) AS island_area, round(CAST(hole_area AS DOUBLE), 6) AS hole_area, reason,
  CASE WHEN reason IS NULL THEN CAST((SELECT count(*) FROM y WHERE y.m = o.m AND y.k = o.k) + hole_cells AS BIGINT) END AS cells FROM o"""


def occ_incomplete_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = table(spark, sf_dir, "supplier").select(
        C("s_suppkey").alias("m"), F.lit(CELL).alias("cell"), F.lit(SIZE_X).alias("size_x"), (F.abs("s_acctbal") / 60).alias("size_y"), F.lit(SIZE_Z).alias("size_z"), F.lit(9).alias("floors"),
    )
    # half of the models are a narrow strip
    cells = masks.cells(_cells(spark, sf_dir).withColumn("i", F.when(C("m") % 2 == 1, (C("i") - 1) % 3 + 1).otherwise(C("i"))))
    found = masks.audited(cells, models, SIDE)
    return found.select("m", *(F.round(c, 6).alias(c) for c in ("occupied", "largest_body", "complete")), "empty_floors", "disconnected_floors", F.array_join("reasons", ",").alias("reasons"))


AUDIT_SQL = f"""{CELLS}, s AS (SELECT DISTINCT m, k, CASE WHEN m % 2 = 1 THEN (i - 1) % 3 + 1 ELSE i END AS i, j FROM c), sn AS (SELECT *, {_NODE} FROM s),
{_flood("t", "sn")},
b AS (SELECT m, k, component, sum({_AREA}) AS body FROM t GROUP BY ALL), l AS (SELECT m, k, sum(body) AS area, max(body) AS body, count(*) AS n FROM b GROUP BY ALL),
a AS (SELECT m, max(area) AS occupied, max(body) AS largest_body, coalesce(max(area) FILTER (n = 1), 0) AS complete, count(*) AS filled, count(*) FILTER (n > 1) AS disconnected_floors FROM l GROUP BY m),
v AS (SELECT s_suppkey AS m, abs(s_acctbal) / 60 AS h, coalesce(occupied, 0) AS occupied, coalesce(largest_body, 0) AS largest_body, coalesce(complete, 0) AS complete, coalesce(filled, 0) AS filled, coalesce(disconnected_floors, 0) AS disconnected_floors FROM supplier LEFT JOIN a ON m = s_suppkey)
SELECT m, round(CAST(occupied AS DOUBLE), 6) AS occupied, round(CAST(largest_body AS DOUBLE), 6) AS largest_body, round(CAST(complete AS DOUBLE), 6) AS complete, 9 - filled AS empty_floors, disconnected_floors,
  concat_ws(',', CASE WHEN occupied <= {SIZE_X * SIZE_Z * 0.25} AND complete <= {SIZE_X * SIZE_Z * 0.25} THEN 'sparse floors' END, CASE WHEN largest_body < 150 AND h >= 60 THEN 'tiny bodies' END) AS reasons FROM v"""


def largest_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each floor: the area of the largest rectangle, and of all rectangles, which is that of the cells."""
    found = masks.rectangles(_cells(spark, sf_dir), SIDE).withColumn("area", (C("i1") - C("i0") + 1) * (C("j1") - C("j0") + 1))
    return found.groupBy("m", "k").agg(F.max(F.when(C("n") == 1, C("area"))).alias("largest"), F.sum("area").alias("total"))


RECTANGLE_SQL = f"""{CELLS},
p AS (SELECT a.m, a.k, a.i AS i0, b.i AS i1, a.j AS j0, b.j AS j1 FROM (SELECT DISTINCT m, k, i, j FROM c) a JOIN c b ON a.m = b.m AND a.k = b.k AND b.i >= a.i AND b.j >= a.j),
r AS (SELECT p.m, p.k, i0, i1, j0, j1, count(*) AS n FROM p JOIN c ON c.m = p.m AND c.k = p.k AND c.i BETWEEN i0 AND i1 AND c.j BETWEEN j0 AND j1 GROUP BY ALL HAVING count(*) = (i1 - i0 + 1) * (j1 - j0 + 1)),
t AS (SELECT m, k, count(*) AS total FROM c GROUP BY ALL)
SELECT r.m, r.k, CAST(max(n) AS INTEGER) AS largest, any_value(total) AS total FROM r JOIN t ON r.m = t.m AND r.k = t.k GROUP BY ALL"""


def boundary_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The borders of each floor walked to rings: edges and enclosed area, which is that of the cells; corners turn."""
    found = masks.loops(_cells(spark, sf_dir), SIDE)
    return found.groupBy("m", "k").agg(F.sum("edges").alias("edges"), F.sum("area").alias("area"), F.count_if(C("area") > 0).alias("outer"), F.min(F.size("corners") % 2).alias("odd"))


LOOPS_SQL = f"""{FLOODED}, e AS (SELECT m, k, i - 1 AS i, j FROM c UNION ALL SELECT m, k, i + 1, j FROM c UNION ALL SELECT m, k, i, j - 1 FROM c UNION ALL SELECT m, k, i, j + 1 FROM c),
b AS (SELECT m, k, count(*) AS edges FROM e ANTI JOIN c USING (m, k, i, j) GROUP BY ALL), a AS (SELECT m, k, count(*) AS n, count(DISTINCT component) AS outer_ FROM f GROUP BY ALL)
SELECT a.m, a.k, edges, CAST(n AS DOUBLE) AS area, outer_ AS outer, 0 AS odd FROM a JOIN b ON a.m = b.m AND a.k = b.k"""


def grid_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids written as JSON, some of them broken, and read again: defaults, and why one is refused."""
    s = C("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit(30.0).alias("size_x"), F.lit(60.0).alias("size_y"), F.lit(30.0).alias("size_z"))
    grid = F.struct(
        F.when(s % 11 != 0, F.lit(3.0)).otherwise(-1.0).alias("cell"), F.lit(10).alias("nx"), F.when(s % 7 == 1, F.lit(2000)).otherwise(10).alias("nz"), F.when(s % 13 == 2, F.lit(200)).otherwise(2).alias("floors"),
        F.when(s % 5 == 3, F.lit(-9.0)).otherwise(-15.0).alias("minX"), F.lit(-15.0).alias("minZ"), F.when(s % 9 != 4, F.lit(13.0)).alias("ground"), F.when(s % 2 == 0, F.lit(10.0)).alias("clearUpper"),
        F.when(s % 17 != 5, F.array(F.repeat(F.lit("1"), F.lit(100)), F.repeat(F.lit("0"), F.lit(100)))).alias("occ"),
    )
    raw = F.when(s % 19 == 6, "{oops").when(s % 23 != 8, meshes.encode_grid(grid))
    found = meshes.read_grids(rows.withColumn("grid", raw), size=("size_x", "size_y", "size_z"))
    g = C("grid")
    return found.select("s_suppkey", "reason", F.when(C("reason").isNull(), g["clearUpper"]).alias("upper"), F.when(C("reason").isNull(), F.length(g["occTight"][0])).alias("tight"))


CONTRACT_SQL = """
WITH s AS (SELECT s_suppkey AS s FROM supplier),
r AS (SELECT s, CASE WHEN s % 19 = 6 THEN 'invalid saved grid' WHEN s % 23 = 8 THEN 'missing saved grid' WHEN s % 9 = 4 THEN 'invalid grid values' WHEN s % 11 = 0 OR s % 7 = 1 THEN 'invalid grid dimensions'
  WHEN s % 13 = 2 OR s % 17 = 5 THEN 'invalid floor masks' WHEN s % 5 = 3 THEN 'grid origin does not match source envelope' END AS reason FROM s)
SELECT s AS s_suppkey, reason, CASE WHEN reason IS NULL THEN CASE WHEN s % 2 = 0 THEN 10.0::DOUBLE ELSE 3.5::DOUBLE / 0.28::DOUBLE END END AS upper, CASE WHEN reason IS NULL THEN 100 END AS tight FROM r
"""


def key_match_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys against old ones: by key, by a suffix that is unique on both sides where the sizes agree, and refused duplicates."""
    rows = table(spark, sf_dir, "customer").select(C("c_custkey").alias("id"), (C("c_custkey") % 10).alias("r"), (C("c_custkey") / 10).cast("long").alias("g"))
    key = lambda mesh, n: F.concat_ws("_", mesh.cast("string"), n.cast("string"), F.lit("-5"), n.cast("string"))
    n = C("id")
    # by the last digit: 0 to 5 keep their key, 6 to 8 get another mesh, 9 repeats a neighbour's key or suffix
    new = rows.select("id", F.when(C("r") < 6, key(F.lit(1), n)).when(C("r") < 9, key(F.lit(2), n)).when(C("g") % 2 == 0, key(F.lit(1), n - 9)).otherwise(key(F.lit(3), n - 1)).alias("key"), (n % 40).cast("double").alias("h"))
    old = rows.filter("r < 9").select("id", key(F.lit(1), n).alias("key"), (n % 40 + F.when(C("r") == 7, 0.5).otherwise(0.2)).alias("h"))
    coded = lambda df: df.withColumn("suffix", building.key_suffix(C("key")))
    found = tables.verified_match(coded(new), coded(old), "key", "suffix", F.abs(C("h") - C("r_h")) <= 0.35)
    return found.select("id", C("r_id").alias("old"), "match_method", "reason")


MATCH_SQL = """
WITH c AS (SELECT c_custkey AS id, c_custkey % 10 AS r, c_custkey // 10 AS g FROM customer),
n AS (SELECT id, CASE WHEN r < 6 THEN 1 WHEN r < 9 THEN 2 WHEN g % 2 = 0 THEN 1 ELSE 3 END AS mesh, CASE WHEN r < 9 THEN id WHEN g % 2 = 0 THEN id - 9 ELSE id - 1 END AS suffix, id % 40 AS h FROM c),
o AS (SELECT id, id % 40 + CASE WHEN r = 7 THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END AS h FROM c WHERE r < 9),
m AS (SELECT *, count(*) OVER (PARTITION BY mesh, suffix) AS keys, count(*) OVER (PARTITION BY suffix) AS suffixes FROM n)
SELECT m.id, o.id AS old, CASE WHEN mesh = 1 THEN 'key' ELSE 'suffix' END AS match_method, CASE WHEN mesh = 1 AND keys > 1 THEN 'duplicate source key' END AS reason
FROM m JOIN o ON o.id = suffix WHERE mesh = 1 OR (suffixes = 1 AND abs(m.h - o.h) <= 0.35::DOUBLE)
"""

SQL = {
    occ_masks: MASKS_SQL, mask_dedupe_reuse: REUSE_SQL, vertical_chains: CHAINS_SQL, occ_holes_islands: CLEAN_SQL, occ_incomplete_audit: AUDIT_SQL, largest_rectangles: RECTANGLE_SQL, boundary_loops: LOOPS_SQL,
    grid_contracts: CONTRACT_SQL, key_match_fallback: MATCH_SQL,
}
