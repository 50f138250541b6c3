"""Registered queries over boxes, triangles, hits and versions of a table, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import geometry
from strataframe.operators import spatial
from strataframe.streaming import hits
from strataframe.plans.drawn import table

BOXES = """SELECT c_custkey AS id,
  CAST(c_custkey % 97 AS DOUBLE) * 10 + floor(c_custkey / 1500) * 4000 AS x0, CAST(c_custkey % 97 AS DOUBLE) * 10 + 5 + c_nationkey + floor(c_custkey / 1500) * 4000 AS x1,
  CAST(c_custkey % 89 AS DOUBLE) * 10 AS z0, CAST(c_custkey % 89 AS DOUBLE) * 10 + 5 + abs(c_acctbal) / 1000 AS z1
FROM {customer}"""
HITS = """SELECT event_id, ts, user_id % 8 AS target,
  CAST(event_id % 7 AS DOUBLE) - 3 AS dx, CAST(event_id % 3 AS DOUBLE) - 1 AS dy, CAST(event_id % 5 AS DOUBLE) - 2 AS dz
FROM {events}"""


def _view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name)})


def box_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.overlapping_boxes(_view(spark, sf_dir, BOXES, "customer"), cell=32.0)


BOX_SQL = f"""WITH b AS ({BOXES.format(customer="customer")})
SELECT p.id AS a, q.id AS b FROM b p JOIN b q ON p.id < q.id AND p.x0 <= q.x1 AND q.x0 <= p.x1 AND p.z0 <= q.z1 AND q.z0 <= p.z1"""


def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = lambda x, z: F.struct(F.col(x).alias("x"), F.col(z).alias("z"))
    ring = F.array(corner("x0", "z0"), corner("x1", "z0"), corner("x1", "z1"), corner("x0", "z1"))
    probe = geometry.inside_ring(F.col("ring"), F.col("x0") + F.col("id") % 30, F.col("z0") + F.col("id") % 11)
    boxes = _view(spark, sf_dir, BOXES, "customer").withColumn("ring", ring)
    return boxes.select("id", F.round(geometry.signed_area(F.col("ring")), 6).alias("area"), probe.alias("probe_inside"))


AREA_SQL = f"""WITH b AS ({BOXES.format(customer="customer")})
SELECT id, round((x1 - x0) * (z1 - z0), 6) AS area, id % 30 < x1 - x0 AND id % 11 < z1 - z0 AS probe_inside FROM b"""


def top_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 best by confidence, area and key."""
    customer = table(spark, sf_dir, "customer")
    rows = customer.select(F.col("c_custkey").alias("id"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("c_acctbal") / 5000)), 1).alias("confidence"), (F.col("c_nationkey") * 10).alias("area"))
    return rows.orderBy(F.desc("confidence"), F.desc("area"), "id").limit(25)


TOP_SQL = """SELECT c_custkey AS id, round(greatest(0.0, least(1.0, c_acctbal / 5000)), 1) AS confidence, c_nationkey * 10 AS area
FROM customer ORDER BY confidence DESC, area DESC, id LIMIT 25"""


def triangle_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles of three successive vectors, cut at height 0."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    at = lambda k, name: F.round(F.col("embedding")[k].cast("double"), 6).alias(name)
    points = vectors.select(F.expr("vec_id div 3").alias("tri"), F.struct(F.col("vec_id").alias("id"), at(0, "x"), at(1, "y"), at(2, "z")).alias("p"))
    triangles = points.groupBy("tri").agg(F.array_sort(F.collect_list("p")).alias("points")).filter(F.size("points") == 3)
    cut = triangles.withColumn("s", spatial.section(F.col("points"), F.lit(0.0))).filter("s IS NOT NULL")
    return cut.select("tri", *(F.round(F.col("s")[i][v], 6).alias(f"{v}{i}") for i in (0, 1) for v in "xz"))


_HIT = "CASE WHEN (t[{a}].y <= 0) <> (t[{b}].y <= 0) THEN struct_pack(x := t[{a}].x + (0 - t[{a}].y) / (t[{b}].y - t[{a}].y) * (t[{b}].x - t[{a}].x), z := t[{a}].z + (0 - t[{a}].y) / (t[{b}].y - t[{a}].y) * (t[{b}].z - t[{a}].z)) END"
SECTION_SQL = f"""
WITH p AS (SELECT vec_id AS id, round(CAST(embedding[1] AS DOUBLE), 6) AS x, round(CAST(embedding[2] AS DOUBLE), 6) AS y, round(CAST(embedding[3] AS DOUBLE), 6) AS z FROM embeddings),
g AS (SELECT id // 3 AS tri, list(struct_pack(x := x, y := y, z := z) ORDER BY id) AS t FROM p GROUP BY 1 HAVING count(*) = 3),
h AS (SELECT tri, list_filter([{_HIT.format(a=1, b=2)}, {_HIT.format(a=2, b=3)}, {_HIT.format(a=3, b=1)}], lambda v: v IS NOT NULL) AS s FROM g)
SELECT tri, round(s[1].x, 6) AS x0, round(s[1].z, 6) AS z0, round(s[2].x, 6) AS x1, round(s[2].z, 6) AS z1 FROM h WHERE len(s) = 2
"""


def hit_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.latest_generation(hits.valid_hits(_view(spark, sf_dir, HITS, "events")))


GENERATION_SQL = f"""WITH h AS ({HITS.format(events="events")})
SELECT target, count(*) AS generation, arg_max(event_id, (ts, event_id)) AS event_id FROM h WHERE target IS NOT NULL AND dx * dx + dy * dy + dz * dz >= 0.0001 GROUP BY target"""

STAGED = """SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 1 AS s_acctbal FROM {supplier} WHERE s_suppkey % 5 = 0
UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM {supplier} WHERE s_suppkey % 7 = 0"""
_LIVE = f"""WITH g AS ({STAGED.format(supplier="supplier")}), v AS (SELECT * FROM supplier ANTI JOIN g USING (s_suppkey) UNION ALL SELECT * FROM g)"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "supplier"), _view(spark, sf_dir, STAGED, "supplier")


def apply_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, staged = _versions(spark, sf_dir)
    now = spatial.applied(live, staged, ["s_suppkey"]).withColumn("place", F.lit("live"))
    return now.unionByName(spatial.archived(live, staged, ["s_suppkey"]).withColumn("place", F.lit("archive")))


APPLY_SQL = f"{_LIVE} SELECT *, 'live' AS place FROM v UNION ALL SELECT *, 'archive' FROM supplier SEMI JOIN g USING (s_suppkey)"


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, staged = _versions(spark, sf_dir)
    return spatial.snapshot_diff(live, spatial.applied(live, staged, ["s_suppkey"]), ["s_suppkey"])


DIFF_SQL = f"""{_LIVE} SELECT s_suppkey, CASE WHEN s_suppkey >= 1000000000 THEN 'added' ELSE 'changed' END AS change FROM g"""

SQL = {
    box_overlap_pairs: BOX_SQL, polygon_area: AREA_SQL, top_plans: TOP_SQL, triangle_sections: SECTION_SQL, hit_generation: GENERATION_SQL,
    apply_archive: APPLY_SQL, snapshot_diff: DIFF_SQL,
}
