import json
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from strataframe.operators import masks, spatial
from strataframe.plans import catalog
from strataframe.sources import meshes
from strataframe.streaming import hits

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    found = catalog.queries()[name](spark, SF)
    wanted = db.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, wanted.fetchall()))


def test_weld_reads_all_lines(spark, tmp_path):
    rows = [(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 4, 12), (2, 6, 13), (3, 1, 20), (3, 2, 20), (3, 7, 21), (4, 1, 30)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(map(tuple, catalog.weld_components(spark, str(tmp_path)).collect())) == [(10, 4, 13), (20, 2, 21)]


def test_masks_of_no_cells(spark):
    none = masks.cells(spark.createDataFrame([(None, 1, 1, 1)], "m long, k int, i int, j int"))
    for found in (masks.components(none, 10), masks.floor_jaccard(none), masks.lines(none), masks.boundary(none)):
        assert found.count() == 0


def test_boxes_on_cell_borders(spark):
    rows = [(1, 0.0, 32.0, 0.0, 32.0), (2, 32.0, 64.0, 32.0, 40.0), (3, -5.0, 200.0, -40.0, 90.0), (4, 32.1, 33.0, 0.0, 1.0), (5, None, 1.0, 0.0, 1.0), (6, 3.0, 1.0, 0.0, 1.0)]
    boxes = spark.createDataFrame(rows, "id int, x0 double, x1 double, z0 double, z1 double")
    assert sorted(map(tuple, spatial.overlapping_boxes(boxes, 32.0).collect())) == [(1, 2), (1, 3), (2, 3), (3, 4)]


def test_sources_are_whole_or_absent(spark):
    staged = spark.createDataFrame([(1, "a", None), (1, "b", "gap"), (2, "c", None), (None, "d", None)], "source int, output string, reason string")
    assert sorted(r["output"] for r in spatial.whole_sources(staged, "source").collect()) == ["c", "d"]


def test_array_archives(spark, tmp_path):
    np.savez(tmp_path / "a.npz", v0=np.arange(6.0).reshape(2, 3), f0=np.array([[0, 1, 2]]), other=np.arange(3))
    got = meshes.read_npz(spark, str(tmp_path)).orderBy("array", "row").collect()
    assert [(r["array"], r["row"], r["a"], r["c"]) for r in got] == [("f0", 0, 0.0, 2.0), ("v0", 0, 0.0, 2.0), ("v0", 1, 3.0, 5.0)]


def test_grids(spark):
    good = {"nx": 2, "nz": 1, "cell": 3.0, "floors": 1, "minX": -3, "minZ": -1.5, "ground": 13, "occ": ["10"]}
    cases = [good, good | {"occ": ["1x"]}, good | {"occ": ["1"]}, good | {"floors": 2}, good | {"cell": 0}, good | {"nx": 20000}, good | {"minX": 0}, good | {"ground": None}, {"nx": 1}, None]
    rows = spark.createDataFrame([(i, None if c is None else json.dumps(c), 6.0, 20.0, 3.0) for i, c in enumerate(cases)], "id int, grid string, w double, h double, d double")
    got = meshes.read_grids(rows, size=("w", "h", "d")).orderBy("id").collect()
    masks_, sizes, origin, values = "invalid floor masks", "invalid grid dimensions", "grid origin does not match source envelope", "invalid grid values"
    assert [r["reason"] for r in got] == [None, masks_, masks_, masks_, sizes, sizes, origin, values, values, "missing saved grid"]
    assert got[0]["grid"]["occTight"] == ["10"] and got[0]["grid"]["clearUpper"] == 3.5 / 0.28
    assert [tuple(r) for r in meshes.explode_masks(meshes.read_grids(rows), "id").orderBy("m").collect()] == [(0, 1, 1, 1), (6, 1, 1, 1)]


def test_cells_outside_the_grid_are_refused(spark):
    for cell in ((1, 1, 11, 1), (1, 200, 1, 1), (1, 1, 0, 1)):
        with pytest.raises(Exception, match="outside a grid"):
            masks.components(spark.createDataFrame([cell], "m long, k int, i int, j int"), 10).collect()


def test_cooldown_over_batches(spark, tmp_path):
    start = pd.Timestamp("2024-01-01")
    rows = [(i % 2, i, (start + pd.Timedelta(milliseconds=70 * i)).to_pydatetime()) for i in range(40)]
    schema = "target long, event_id long, ts timestamp_ntz"
    for part in range(2):
        spark.createDataFrame(rows[20 * part : 20 * part + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = hits.cooled_down(stream).writeStream.format("memory").queryName("cooled").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    want = set()
    for target in (0, 1):
        last = None
        for t, i, ts in rows:
            if t == target and (last is None or (ts - last).total_seconds() >= 0.3):
                last = ts
                want.add(i)
    assert {r["event_id"] for r in spark.table("cooled").collect()} == want
