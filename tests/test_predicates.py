from pyspark.sql import functions as F

from strataframe.functions import geometry


def _point(p):
    return F.struct(F.lit(float(p[0])).alias("x"), F.lit(float(p[1])).alias("z"))


def test_segments_meet(spark):
    cases = [
        ((0, 0), (2, 2), (0, 2), (2, 0), True), ((0, 0), (1, 0), (1, 0), (1, 5), True), ((0, 0), (4, 0), (2, 0), (6, 0), True), ((0, 0), (4, 0), (2, 0), (2, 3), True),
        ((0, 0), (1, 0), (2, 0), (3, 0), False), ((0, 0), (1, 1), (0, 1), (1, 2), False), ((0, 0), (1, 1), (3, 0), (0, 3), False), ((1, 1), (1, 1), (0, 0), (2, 2), True),
    ]
    got = spark.range(1).select(*(geometry.segments_meet(*map(_point, c[:4])).alias(str(i)) for i, c in enumerate(cases))).first()
    assert list(got) == [c[4] for c in cases]


def test_finite(spark):
    rows = [(1.0, 2.0), (float("nan"), 1.0), (float("inf"), 1.0), (None, 1.0)]
    got = spark.createDataFrame(rows, "a double, b double").select(geometry.finite(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [True, False, False, False]


def test_enclosed_needs_all_four_sides(spark):
    corners = [(0, 0), (4, 0), (4, 4), (0, 4)]
    sides = [F.array(_point(a), _point(b)) for a, b in zip(corners, corners[1:] + corners[:1])]
    inside = lambda s, x, z: geometry.enclosed(F.array(*s), F.lit(float(x)), F.lit(float(z)))
    got = spark.range(1).select(inside(sides, 1, 2).alias("a"), inside(sides, 5, 2).alias("b"), inside(sides[:3], 1, 2).alias("c"), inside(sides, 2, -1).alias("d")).first()
    assert list(got) == [True, False, False, False]
