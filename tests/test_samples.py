"""Grids sampled from meshes, and points that segments enclose on all sides."""

import random

import numpy as np
import pytest

from strataframe.functions import geometry
from strataframe.operators import samples
from test_contours import BOX, ELL, SCHEMA, moved, tower


def test_enclosed_equals_the_expression(spark):
    rng = random.Random(8)
    from pyspark.sql import functions as F

    lines = [[(rng.uniform(0, 9), rng.uniform(0, 9)), (rng.uniform(0, 9), rng.uniform(0, 9))] for _ in range(25)] + [[(2.0, 3.0), (7.0, 3.0)], [(2.0, 2.0), (2.0, 8.0)]]
    points = [(rng.uniform(-1, 10), rng.uniform(-1, 10)) for _ in range(300)]
    a, b = (np.array([s[k] for s in lines]) for k in (0, 1))
    got = samples.enclosed(a, b, *np.array(points).T)
    rows = spark.createDataFrame([(i, x, z, lines) for i, (x, z) in enumerate(points)], "i int, x double, z double, s array<array<struct<x:double,z:double>>>")
    want = rows.select("i", geometry.enclosed(F.col("s"), F.col("x"), F.col("z")).alias("e")).orderBy("i").collect()
    assert got.tolist() == [r["e"] for r in want] and 0 < got.sum() < 300


def test_grids_of_models(spark):
    cases = {
        "box": [([BOX], 0, 60)], "ell": [([ELL], 0, 60)], "set back": [([BOX], 0, 40), ([moved(BOX, 0, 0, 0.5)], 40, 80)], "low": [([BOX], 0, 20)], "narrow": [([[(0, 0), (40, 0), (40, 10), (0, 10)]], 0, 60)],
        "small": [([[(0, 0), (12, 0), (12, 12), (0, 12)]], 0, 60)],
    }
    names = list(cases)
    rows = [r for m, n in enumerate(names) for r in tower(m, cases[n], caps=False)]
    rows += [r for r in tower(20, cases["box"], caps=False) if r[1] != 0] + tower(21, cases["box"], caps=False)[:7]
    models, floors = samples.sampled_models(spark.createDataFrame(rows, SCHEMA).repartition(3).select("m", "points"))
    got = {(names[r["m"]] if r["m"] < 20 else r["m"]): r for r in models.collect()}
    assert {n: r["reason"] for n, r in got.items()} == {"box": None, "ell": None, "set back": None, "low": samples.REASONS[1], "narrow": samples.REASONS[1], "small": samples.REASONS[3], 20: samples.REASONS[0], 21: samples.REASONS[0]}
    assert (got["box"]["nx"], got["box"]["nz"], got["box"]["floors"]) == (14, 10, 3) and got["box"]["cells"] == 3 * 140
    masks = {(names[r["m"]], r["k"]): (r["loose"], r["tight"]) for r in floors.collect()}
    assert masks["box", 1] == ("1" * 140, "1" * 140)
    ell = np.array(list(masks["ell", 2][0])).reshape(got["ell"]["nx"], got["ell"]["nz"])
    assert 0.4 < (ell == "1").mean() < 0.7 and (ell == "1").any(axis=0).all() and (ell == "1").any(axis=1).all()
    steps = [masks["set back", k][0].count("1") for k in range(1, got["set back"]["floors"] + 1)]
    assert steps == sorted(steps, reverse=True) and steps[0] == 140 and steps[-1] < 50
    assert all(t <= o for loose, tight in masks.values() for o, t in zip(loose, tight))
    with pytest.raises(Exception, match="floors or more"):
        samples.sampled_models(spark.createDataFrame(tower(1, [([BOX], 0, 4000)], caps=False), SCHEMA).select("m", "points"))


def test_no_models(spark):
    models, floors = samples.sampled_models(spark.createDataFrame([], SCHEMA).select("m", "points"))
    assert models.count() == floors.count() == 0


def test_one_upright_block_is_all_cells(spark):
    from strataframe.operators import places

    models = spark.createDataFrame([(m, 10.0, 40.0, 10.0, 2, 15.0, 12.5) for m in (1, 2, 3, 4)], "m int, sx double, sy double, sz double, floors int, ground double, upper double")
    p = "struct<x:double,y:double,z:double>"
    small = ((-1.0, -20.0, -1.0), (1.0, 20.0, 1.0))
    solids = spark.createDataFrame([(1, *small, True), (2, *small, False), (3, *small, True), (3, *small, True), (4, *small, None)], f"m int, lo {p}, hi {p}, upright boolean")
    got = {r["m"]: (r["n"], r["t"]) for r in places.sampled_solids(models, solids).groupBy("m").agg({"tight": "count"}).withColumnRenamed("count(tight)", "n").selectExpr("m", "n", "n AS t").collect()}
    assert got[1] == (32, 32) and 2 not in got and 3 not in got and 4 not in got  # no cell's middle lies in the small block
    assert places.sampled_solids(models, solids.drop("upright")).count() == 0


def test_lines_of_two_layers(spark):
    from strataframe.operators import masks

    cells = lambda *rows: spark.createDataFrame(list(rows), "m long, k int, i int, j int")
    loose, tight = cells((1, 1, 1, 1), (1, 1, 1, 2), (1, 2, 3, 3)), cells((1, 1, 1, 2))
    assert sorted(tuple(r) for r in masks.lines(loose, tight).collect()) == [(1, 1, 1, 1), (1, 1, 1, 2), (1, 2, 1, 2), (1, 2, 3, 3)]
    assert masks.lines(loose).count() == 6
