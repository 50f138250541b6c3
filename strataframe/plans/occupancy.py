"""Registered queries over occupancy grids (a 10 x 10 grid for each supplier, a floor for each line number), with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import masks

SIDE = 10
CELLS = """WITH RECURSIVE c AS (
  SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS m, CAST(l_linenumber AS INT) AS k, CAST(l_partkey % 10 AS INT) + 1 AS i, CAST(CAST(l_quantity AS BIGINT) % 10 AS INT) + 1 AS j
  FROM lineitem)"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    place = lambda c: (c % SIDE).cast("int") + 1
    return masks.cells(lines.select(F.col("l_suppkey").alias("m"), F.col("l_linenumber").alias("k"), place(F.col("l_partkey")).alias("i"), place(F.col("l_quantity").cast("long")).alias("j")))


def occ_floor_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    floors = _cells(spark, sf_dir).groupBy("m", "k").agg(F.count("*").alias("n"))
    return floors.groupBy("m").agg(F.sum("n").alias("cells"), F.max("n").alias("largest"), F.count("*").alias("floors"))


FLOOR_AREA_SQL = f"""{CELLS}, f AS (SELECT m, k, count(*) AS n FROM c GROUP BY ALL)
SELECT m, CAST(sum(n) AS BIGINT) AS cells, max(n) AS largest, count(*) AS floors FROM f GROUP BY m"""


def occ_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    border = F.col("i").isin(1, SIDE) | F.col("j").isin(1, SIDE)
    found = masks.components(_cells(spark, sf_dir), SIDE)
    return found.groupBy("m", "k", "component").agg(F.count("*").alias("area"), F.bool_or(border).alias("at_border"))


FLOODED = f"""{CELLS}, n AS (SELECT *, m * {masks.PER_MODEL} + k * 100 + (i - 1) * 10 + j - 1 AS node FROM c),
r AS (SELECT m, k, i, j, node, node AS seed FROM n
  UNION SELECT n.m, n.k, n.i, n.j, n.node, r.seed FROM r JOIN n ON n.m = r.m AND n.k = r.k AND abs(n.i - r.i) + abs(n.j - r.j) = 1 AND r.seed < n.node),
f AS (SELECT m, k, i, j, node, min(seed) AS component FROM r GROUP BY ALL)"""
COMPONENTS_SQL = f"{FLOODED} SELECT m, k, component, count(*) AS area, bool_or(i IN (1, 10) OR j IN (1, 10)) AS at_border FROM f GROUP BY m, k, component"


def vertical_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = masks.components(_cells(spark, sf_dir), SIDE, vertical=True)
    return found.groupBy("m", F.col("component").alias("body")).agg(F.count("*").alias("cells"), F.min("k").alias("first"), F.max("k").alias("last"))


BODIES_SQL = f"""{FLOODED},
l AS (SELECT DISTINCT a.component AS x, b.component AS y FROM f a JOIN f b ON a.m = b.m AND a.i = b.i AND a.j = b.j AND b.k = a.k + 1),
u AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
p AS (SELECT component AS x, component AS seed FROM f UNION SELECT u.y, p.seed FROM p JOIN u ON p.x = u.x AND p.seed < u.y),
b AS (SELECT x, min(seed) AS body FROM p GROUP BY x)
SELECT m, body, count(*) AS cells, min(k) AS first, max(k) AS last FROM f JOIN b ON f.component = b.x GROUP BY m, body"""


def mask_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.floor_jaccard(_cells(spark, sf_dir)).withColumn("jaccard", F.round("jaccard", 6))


JACCARD_SQL = f"""{CELLS}, s AS (SELECT m, k, count(*) AS n FROM c GROUP BY ALL),
q AS (SELECT a.m, a.k AS a, b.k AS b, count(*) AS n FROM c a JOIN c b ON a.m = b.m AND a.i = b.i AND a.j = b.j AND a.k < b.k GROUP BY ALL)
SELECT q.m, a, b, round(q.n / (x.n + y.n - q.n), 6) AS jaccard FROM q JOIN s x ON x.m = q.m AND x.k = a JOIN s y ON y.m = q.m AND y.k = b"""


def mask_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a floor that the floor below has not."""
    own = _cells(spark, sf_dir)
    return masks.difference(own, own.withColumn("k", F.col("k") + 1)).groupBy("m", "k").agg(F.count("*").alias("remaining"))


RESIDUAL_SQL = f"""{CELLS}, d AS (SELECT m, k, i, j FROM c EXCEPT SELECT m, k + 1, i, j FROM c)
SELECT m, k, count(*) AS remaining FROM d GROUP BY ALL"""


def mask_union_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.lines(_cells(spark, sf_dir)).groupBy("m", "k").agg(F.count("*").alias("cells"))


LINE_SQL = f"""{CELLS}, d AS (SELECT m, k, i, j FROM c UNION SELECT m, k + 1, i, j FROM c)
SELECT m, k, count(*) AS cells FROM d GROUP BY ALL"""


def boundary_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.boundary(_cells(spark, sf_dir)).groupBy("m", "k").agg(F.count("*").alias("edges"))


BOUNDARY_SQL = f"""{CELLS}, e AS (
  SELECT m, k, i - 1 AS i, j FROM c UNION ALL SELECT m, k, i + 1, j FROM c UNION ALL SELECT m, k, i, j - 1 FROM c UNION ALL SELECT m, k, i, j + 1 FROM c)
SELECT m, k, count(*) AS edges FROM e ANTI JOIN c USING (m, k, i, j) GROUP BY ALL"""


def core_span_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floors from the lowest on that all have the cell (5, 5)."""
    floors = _cells(spark, sf_dir).groupBy("m", "k").agg(F.bool_or((F.col("i") == 5) & (F.col("j") == 5)).alias("core"))
    return masks.leading(floors, ["m"], "k", "core")


SPAN_SQL = f"""{CELLS}, f AS (SELECT m, k, bool_or(i = 5 AND j = 5) AS core FROM c GROUP BY ALL),
g AS (SELECT m, min(k) FILTER (NOT core) AS stop FROM f GROUP BY m)
SELECT f.m, count(*) FILTER (stop IS NULL OR k < stop) AS span FROM f JOIN g ON f.m = g.m GROUP BY f.m"""


def gap_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    floors = _cells(spark, sf_dir).groupBy("m", "k").agg((F.count("*") % 3).alias("grp"))
    return masks.bridged(floors, ["m"], "k", "grp")


BRIDGE_SQL = f"""{CELLS}, f AS (SELECT m, k, count(*) % 3 AS grp FROM c GROUP BY m, k),
g AS (SELECT *, lag(grp) OVER w AS p, lead(grp) OVER w AS q FROM f WINDOW w AS (PARTITION BY m ORDER BY k))
SELECT m, k, CASE WHEN p = q THEN p ELSE grp END AS grp FROM g"""

SQL = {
    occ_floor_area: FLOOR_AREA_SQL, occ_components: COMPONENTS_SQL, vertical_bodies: BODIES_SQL, mask_jaccard: JACCARD_SQL, mask_residual: RESIDUAL_SQL,
    mask_union_line: LINE_SQL, boundary_edges: BOUNDARY_SQL, core_span_floors: SPAN_SQL, gap_bridge: BRIDGE_SQL,
}
