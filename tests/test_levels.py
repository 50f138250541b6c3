import random

from pyspark.sql import functions as F

from strataframe.operators import floors, nearest

POINT = "id int, x double, z double"


def test_nearest_of_places_with_many_points(spark):
    rng = random.Random(5)
    rows = [(i, float(rng.randrange(12)), float(rng.randrange(12))) for i in range(60)] + [(90, None, 1.0), (91, -3.0, -3.0)]
    d2 = lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2
    placed = [r for r in rows if r[1] is not None]
    near = {}
    for a in placed:
        best = min(((d2(a, b), b[0]) for b in placed if b[0] != a[0] and d2(a, b) <= 4), default=None)
        if best:
            near[a[0]] = best
    want = {(a, b, d) for a, (d, b) in near.items() if a < b and near.get(b, (0, None))[1] == a}
    assert {tuple(r) for r in nearest.mutual_nearest(spark.createDataFrame(rows, POINT), 2.0).collect()} == want
    targets = [(i, float(i % 5) * 3, float(i % 7)) for i in range(40)]
    got = nearest.nearest_within(spark.createDataFrame(rows, POINT), spark.createDataFrame(targets, POINT), 2.0).collect()
    assert {r["id"]: (r["d2"], r["target"]) for r in got} == {a[0]: min((d2(a, t), t[0]) for t in targets if d2(a, t) <= 4) for a in placed if any(d2(a, t) <= 4 for t in targets)}


def test_nothing_gives_nothing(spark):
    none = spark.createDataFrame([], POINT)
    assert nearest.mutual_nearest(none, 1.0).count() == 0 and nearest.nearest_within(none, none, 1.0).count() == 0
    assert floors.anchored_bands(none, ["id"], "x").count() == 0 and floors.tier_floors(none, ["id"], "x", 1.0, 3).count() == 0


def test_bands_are_anchored(spark):
    rows = [("a", v) for v in (0.0, 0.4, 0.8, 1.2, 1.5, None, 0.4)]
    got = floors.anchored_bands(spark.createDataFrame(rows, "k string, y double"), ["k"], "y").orderBy("low").collect()
    assert [tuple(r) for r in got] == [("a", 0.0, 0.4, 3), ("a", 0.8, 1.2, 2), ("a", 1.5, 1.5, 1)]


def test_tiers_rise_and_leave_room(spark):
    rows = [(1, v) for v in (0.0, 1.0, 30.0, 31.0)] + [(2, float(v)) for v in range(6)]
    got = floors.tier_floors(spark.createDataFrame(rows, "m int, y double"), ["m"], "y", 4.0, 5).orderBy("tier").collect()
    assert [(r["m"], r["first_floor"]) for r in got] == [(1, 1), (1, 2), (1, 4), (1, 5)]


def test_groups_that_come_back(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (2, 1, "a"), (2, 2, "a"), (2, 3, "b"), (3, 1, None), (3, 2, "b"), (3, 3, None)]
    got = floors.oscillating(spark.createDataFrame(rows, "m int, k int, g string"), ["m"], "k", "g").collect()
    assert dict(map(tuple, got)) == {1: True, 2: False, 3: True}


def test_fragments_need_area_bulk_and_stand(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, size int")
    small = F.col("size") < 10
    got = floors.fragments(df, {"area": small, "envelope": small, "slabs": F.lit(False), "elevated": F.lit(False), "short": small, "no_core": F.lit(False)}).orderBy("id").collect()
    assert [(r["reasons"], r["fragment"]) for r in got] == [([], False), (["area", "envelope", "short"], True)]


def test_short_tables_are_dealt(spark):
    """A small file is one task: what is made of its rows is made in many, and groups of a key need no further shuffle."""
    from pyspark.sql import functions as F

    from strataframe.plans.drawn import table

    rows = table(spark, "/root/testdata/sf0.001", "supplier")
    assert rows.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism and rows.count() == spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").count()
    made = rows.select(F.col("s_suppkey").alias("m"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k")).groupBy("m", "k").count()
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and made.count() == 3 * rows.count()


def test_a_crowd_within_reach_is_not_paired(spark):
    """All points lie in one cell of the reach: the nearest are found without comparing each with each, which a join on cells of the reach would do."""
    rows = spark.range(3000).selectExpr("id", "CAST(id * 37 % 97 AS DOUBLE) AS x", "CAST(id * 91 % 89 AS DOUBLE) AS z")
    for found in (nearest.nearest_within(rows, rows, 500.0), nearest.mutual_nearest(rows, 500.0)):
        assert "__cx" not in found._jdf.queryExecution().toString() and found.count() > 0
    assert nearest.nearest_within(rows, rows, 500.0).filter("d2 > 0").count() == 0
