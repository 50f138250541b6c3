import random

from pyspark.sql import functions as F

from strataframe.functions import geometry
from strataframe.operators import graph, tables


def test_components_equal_a_walk(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3), (5, None)]
    near = {}
    for a, b in edges:
        if None not in (a, b) and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    got = graph.connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_components_of_no_edges(spark):
    assert graph.connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_covered_length_and_runs(spark):
    rows = spark.createDataFrame([("a", 0, 5), ("a", 3, 4), ("a", 4, 9), ("b", 1, 1)], "g string, lo int, hi int")
    assert {tuple(r) for r in tables.covered_length(rows, ["g"], "lo", "hi").collect()} == {("a", 9), ("b", 0)}
    steps = spark.createDataFrame([(1, i, c) for i, c in enumerate("aabba")], "k int, i int, c string")
    assert sorted((r["first"], r["last"], r["c"]) for r in tables.runs(steps, ["k"], "i", "c").collect()) == [(0, 1, "a"), (2, 3, "b"), (4, 4, "a")]


def test_match(spark):
    """By key, by a suffix that is unique over all rows of both sides and checked, and refused where a key repeats."""
    schema = "key string, suffix string, h double"
    left = spark.createDataFrame([("1_9", "9", 1.0), ("2_9", "9", 1.0), ("2_8", "8", 1.0), ("3_7", "7", 1.0), ("1_6", "6", 1.0), ("1_6", "6", 2.0), (None, None, 1.0)], schema)
    right = spark.createDataFrame([("1_9", "9", 5.0), ("5_9", "9", 1.0), ("5_8", "8", 1.1), ("6_7", "7", 3.0), ("1_6", "6", 1.0), (None, None, 1.0)], schema)
    got = tables.verified_match(left, right, "key", "suffix", F.abs(F.col("h") - F.col("r_h")) <= 0.35).collect()
    refused = "duplicate source key"
    assert sorted((r["key"], r["h"], r["match_method"], r["reason"]) for r in got) == [("1_6", 1.0, "key", refused), ("1_6", 2.0, "key", refused), ("1_9", 1.0, "key", None), ("2_8", 1.0, "suffix", None)]
    assert not [r for r in got if r["key"] == "2_9"]  # the suffix 9 stands twice on both sides
    assert tables.verified_match(left.limit(0), right, "key", "suffix", F.lit(True)).count() == 0


def test_rings(spark):
    square = "array(named_struct('x', 0D, 'z', 0D), named_struct('x', 2D, 'z', 0D), named_struct('x', 2D, 'z', 2D), named_struct('x', 0D, 'z', 2D))"
    df = spark.sql(f"SELECT {square} AS ring")
    one = F.lit(1.0)
    row = df.select(geometry.signed_area(F.col("ring")), geometry.inside_ring(F.col("ring"), one, one), geometry.inside_ring(F.col("ring"), F.lit(3.0), one)).first()
    assert tuple(row) == (4.0, True, False)


def test_entry_has_equal_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
