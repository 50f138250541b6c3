"""Scans of array archives, record files and grids in JSON; archives are written as well."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.geometry import finite
from strataframe.operators.kernels import by_sorted_group
from strataframe.operators.masks import MOST_CELLS, MOST_FLOORS

C = F.col

GRID = "version int, cell double, nx double, nz double, floors double, minX double, minZ double, ground double, clearUpper double, occ array<string>, occTight array<string>"


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """file, array, row, a, b, c: the rows of every two-dimensional array with three columns in the .npz files under path.

    Files are read by Spark, from any store it reaches; one file is one task's memory. Other arrays give no rows.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
                    for name in arrays.files:
                        v = arrays[name]
                        if v.ndim == 2 and v.shape[1] == 3:
                            yield pd.DataFrame({"file": file, "array": name, "row": np.arange(len(v)), "a": v[:, 0].astype(float), "b": v[:, 1].astype(float), "c": v[:, 2].astype(float)})

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")
    return found.mapInPandas(rows, "file string, array string, row long, a double, b double, c double")


def write_npz(vertices: DataFrame, faces: DataFrame, folder: str) -> list[str]:
    """One archive a mesh, <mesh>.npz with the arrays v (x, y, z by id) and f (a, b, c: positions in v), under folder; the names that were committed.

    vertices: mesh, id, x, y, z; faces: mesh, a, b, c (ids). A mesh is one task's memory. Tasks write to names of their own; the driver moves those of the
    attempts that succeeded to their places, so a lost or repeated task leaves no archive, or one. A face with an id that isn't there is an error.
    """
    staging = f"{folder}/.staged-{uuid.uuid4().hex}"
    corner = lambda c: C(c).cast("double")
    own = vertices.select("mesh", F.lit(0).alias("kind"), C("id").cast("long").alias("a"), *(corner(v).alias(v) for v in "xyz"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("long").alias("c"))
    both = own.unionByName(faces.select("mesh", F.lit(1).alias("kind"), *(C(v).cast("long").alias(v) for v in "abc"), *(F.lit(None).cast("double").alias(v) for v in "xyz")))

    def write(group: pa.Table) -> list[dict]:
        kind = group.column("kind").to_numpy()
        get = lambda c, k: group.column(c).to_numpy(zero_copy_only=False)[kind == k]
        ids = get("a", 0)
        order = np.argsort(ids, kind="stable")
        place = np.column_stack([get(c, 1) for c in "abc"]).astype(np.int64)
        at = np.minimum(np.searchsorted(ids[order], place), max(len(ids) - 1, 0))
        if len(place) and (not len(ids) or (ids[order][at] != place).any()):
            raise ValueError("a face has a vertex that is missing")
        content = io.BytesIO()
        np.savez_compressed(content, v=np.column_stack([get(c, 0) for c in "xyz"])[order].astype(np.float64).reshape(-1, 3), f=at.reshape(-1, 3))
        fs, root = _store(staging)
        name = uuid.uuid4().hex
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(content.getvalue())
        return [{"name": name}]

    made = by_sorted_group(both, ["mesh"], write, [("name", "string")]).select(C("mesh").cast("string").alias("mesh"), "name").collect()  # a row a mesh
    fs, root = _store(staging)
    for r in made:
        fs.move(f"{root}/{r['name']}", f"{root.rsplit('/', 1)[0]}/{r['mesh']}.npz")
    if made:
        fs.delete_dir(root)
    return sorted(f"{r['mesh']}.npz" for r in made)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if urlsplit(uri).scheme else (pafs.LocalFileSystem(), uri)


def archived_meshes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(vertices: mesh, id, x, y, z; faces: mesh, a, b, c) of the archives <mesh>.npz under folder, as write_npz made them."""
    rows = read_npz(spark, folder).withColumn("mesh", F.regexp_extract("file", r"([^/]+)\.npz$", 1))
    vertices = rows.filter("array = 'v'").select("mesh", C("row").alias("id"), *(C(c).alias(v) for c, v in zip("abc", "xyz")))
    return vertices, rows.filter("array = 'f'").select("mesh", *(C(c).cast("long").alias(c) for c in "abc"))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of JSON files, each an array of objects, with reason: null where a record has every field of schema in its kind. A file that is
    no array gives one row without fields. A file is one task's memory."""
    bad = "__bad"
    texts = spark.read.option("wholetext", True).text(path)
    each = texts.select(F.explode_outer(F.from_json("value", "array<string>")).alias("r"))
    rows = each.select(F.from_json("r", f"{schema}, {bad} string", {"columnNameOfCorruptRecord": bad}).alias("s")).select("s.*")
    fields = [c for c in rows.columns if c != bad]
    missing = F.array_compact(F.array(*(F.when(C(c).isNull(), F.lit(c)) for c in fields)))
    reason = F.when(C(bad).isNotNull(), "not a record of the schema").when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
    return rows.withColumn("reason", reason).drop(bad)


def encode_grid(grid: Column) -> Column:
    """A grid, a struct with fields as in GRID, as JSON."""
    return F.to_json(grid)


def read_grids(df: DataFrame, raw: str = "grid", size: tuple[str, str, str] | None = None) -> DataFrame:
    """df with grid (decoded, with defaults: clearUpper is 3.5 metres and occTight is occ where they are missing) and reason,
    null where it keeps the contract: numbers that are finite, whole dimensions and floors within the bounds, a mask for each floor of
    the right length and of 0 and 1 only, and an origin at the corner of the box, whose three sizes the columns of size name."""
    df = df.withColumn("__g", F.from_json(raw, GRID))
    g = C("__g")
    tight = F.coalesce(g["occTight"], g["occ"])
    upper = F.coalesce(g["clearUpper"], F.lit(3.5 / 0.28))
    whole = lambda v: v == F.floor(v)
    given = [g[k] for k in ("cell", "nx", "nz", "floors", "minX", "minZ", "ground")]
    masks = lambda a: F.coalesce((F.size(a) == g["floors"]) & F.forall(a, lambda v: v.isNotNull() & (F.length(v) == g["nx"] * g["nz"]) & ~v.rlike("[^01]")), F.lit(False))
    reason = F.when(C(raw).isNull(), "missing saved grid").when(g.isNull() | (g["nx"].isNull() & g["cell"].isNull() & g["occ"].isNull()), "invalid saved grid")
    if size:
        reason = reason.when(~finite(*map(C, size)) | (F.least(*map(C, size)) <= 0), "invalid source dimensions")
    reason = reason.when(~finite(*given) | (g["ground"] <= 0) | (upper <= 0), "invalid grid values")
    bad = (g["cell"] <= 0) | (g["nx"] < 1) | (g["nz"] < 1) | ~whole(g["nx"]) | ~whole(g["nz"]) | (g["nx"] * g["nz"] > MOST_CELLS)
    reason = reason.when(bad, "invalid grid dimensions")
    reason = reason.when((g["floors"] < 1) | (g["floors"] >= MOST_FLOORS) | ~whole(g["floors"]) | ~masks(g["occ"]) | ~masks(tight), "invalid floor masks")
    if size:
        reason = reason.when((F.abs(g["minX"] + C(size[0]) / 2) >= 0.05) | (F.abs(g["minZ"] + C(size[2]) / 2) >= 0.05), "grid origin does not match source envelope")
    grid = F.struct(*((upper if f == "clearUpper" else tight if f == "occTight" else g[f]).alias(f) for f in (x.split()[0] for x in GRID.split(", "))))
    return df.withColumns({raw: grid, "reason": reason}).drop("__g")


def explode_masks(grids: DataFrame, key: str, layer: str = "occ") -> DataFrame:
    """m, k, i, j of the occupied cells of the grids without a reason; rows of a mask run along x."""
    floors = grids.filter("reason IS NULL").select(C(key).alias("m"), F.posexplode(f"grid.{layer}").alias("k", "mask"), C("grid.nz").cast("int").alias("nz"))
    cells = floors.select("m", (C("k") + 1).alias("k"), "nz", F.posexplode(F.split("mask", "")).alias("at", "c")).filter("c = '1'")
    return cells.select("m", "k", (F.floor(C("at") / C("nz")) + 1).cast("int").alias("i"), (C("at") % C("nz") + 1).cast("int").alias("j"))
