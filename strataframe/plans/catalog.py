"""The registered queries over the spatial operators, on the star-schema tables, with equal SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.functions import geometry
from strataframe.operators import graph, tables
from strataframe.plans import contours, grids, levels, linework, massing, occupancy, places, scalars, scenes, solids, stores, tracks, works
from strataframe.storage import tasks

FLAGSHIP = "weld_components"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def weld_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of an order weld; components of the graph with their sizes."""
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").filter("l_orderkey IS NOT NULL AND l_partkey IS NOT NULL")
    # every line to the first of its order: a star joins what a chain or all pairs would; orders are dealt to tasks whose share does not grow
    first = F.first("l_partkey").over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    edges = lines.repartition(tasks(lines, graph.CHUNK), "l_orderkey").select(F.col("l_partkey").alias("src"), first.alias("dst"))
    found = graph.connected_components(edges)
    return found.groupBy("component").agg(F.count("*").alias("n_nodes"), F.max("node").alias("last_node"))


WELD_SQL = """
WITH RECURSIVE f AS (SELECT l_orderkey AS o, arg_min(l_partkey, (l_linenumber, l_partkey)) AS d FROM lineitem GROUP BY 1),
e AS (SELECT DISTINCT l_partkey AS a, d AS b FROM lineitem JOIN f ON f.o = l_orderkey WHERE l_partkey <> d), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
c(node, component) USING KEY (node) AS (SELECT a, a FROM u GROUP BY a
  UNION SELECT u.b, min(c.component) FROM c JOIN u ON u.a = c.node JOIN recurring.c AS r ON r.node = u.b WHERE c.component < r.component GROUP BY u.b)
SELECT component, count(*) AS n_nodes, max(node) AS last_node FROM c GROUP BY component
"""


def covered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.datediff("l_shipdate", F.lit("1970-01-01")).cast("long").alias("lo"))
    return tables.covered_length(lines.withColumn("hi", F.col("lo") + 5), ["l_suppkey"], "lo", "hi")


COVERED_SQL = """
WITH i AS (SELECT l_suppkey, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS lo FROM lineitem),
w AS (SELECT l_suppkey, lo, lo + 5 AS hi, max(lo + 5) OVER (PARTITION BY l_suppkey ORDER BY lo, lo + 5 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i)
SELECT l_suppkey, CAST(sum(greatest(hi - greatest(lo, coalesce(reach, lo)), 0)) AS BIGINT) AS covered FROM w GROUP BY l_suppkey
"""


def median_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return tables.lower_median(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"]).select("o_custkey", "o_orderkey")


MEDIAN_SQL = """
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey FROM r WHERE k = (n + 1) // 2
"""


def quantity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("q"))
    return tables.nearest_rank(lines, ["l_returnflag"], "q", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


PROFILE_SQL = """
SELECT l_returnflag, quantile_disc(CAST(l_quantity AS DOUBLE), 0.1) AS p10, quantile_disc(CAST(l_quantity AS DOUBLE), 0.5) AS p50, quantile_disc(CAST(l_quantity AS DOUBLE), 0.9) AS p90,
  min(CAST(l_quantity AS DOUBLE)) AS least, max(CAST(l_quantity AS DOUBLE)) AS most, count(*) FILTER (l_quantity IS NULL) AS missing
FROM lineitem GROUP BY l_returnflag
"""


def quantity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.histogram(_t(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("double").alias("q")), "q", [5.0, 10.0, 25.0, 40.0])


HISTOGRAM_SQL = """
SELECT CASE WHEN l_quantity <= 5 THEN 0 WHEN l_quantity <= 10 THEN 1 WHEN l_quantity <= 25 THEN 2 WHEN l_quantity <= 40 THEN 3 ELSE 4 END AS bucket, count(*) AS n
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1
"""


def flag_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.runs(_t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("l_returnflag")), ["l_orderkey"], "l_linenumber", "l_returnflag")


RUNS_SQL = """
WITH u AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL),
l AS (SELECT l_orderkey, l_linenumber, l_returnflag, lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS p FROM u),
r AS (SELECT *, CAST(sum(CASE WHEN p <> l_returnflag THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS BIGINT) AS run FROM l)
SELECT l_orderkey, run, l_returnflag, min(l_linenumber) AS first, max(l_linenumber) AS last, count(*) AS n FROM r GROUP BY ALL
"""


def key_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _t(spark, sf_dir, "part").select("p_partkey")
    return parts.select("p_partkey", geometry.rolling_checksum(F.concat_ws("_", F.col("p_partkey").cast("string"), (F.col("p_partkey") * 7).cast("string"))).alias("checksum"))


CHECKSUM_SQL = """
SELECT p_partkey, CAST(list_reduce(list_prepend(0, list_transform(string_split(concat(p_partkey, '_', p_partkey * 7), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda s, c: (s * 131 + c) % 1000000007) AS BIGINT) AS checksum
FROM part
"""


SQL = {
    weld_components: WELD_SQL, covered_days: COVERED_SQL, median_order: MEDIAN_SQL, quantity_profile: PROFILE_SQL, quantity_histogram: HISTOGRAM_SQL, flag_runs: RUNS_SQL, key_checksum: CHECKSUM_SQL,
} | occupancy.SQL | solids.SQL | levels.SQL | grids.SQL | scalars.SQL | scenes.SQL | works.SQL | places.SQL | massing.SQL | linework.SQL | contours.SQL | stores.SQL | tracks.SQL


def queries() -> dict:
    return {f.__name__: f for f in SQL}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in SQL.items() if sql}
