"""Centroid clustering in whole numbers, screened in single precision.

Vectors and centroids are integers, so every assignment has one right answer. A float32 matrix product gives each squared
distance within a proven interval; a vector whose least interval overlaps no other is assigned by it, and the centroids
whose intervals overlap are compared again in exact integers, ties going to the lowest number. The centroids (k rows) are
all that the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataframe.llm.batches import bound_batches
from strataframe.storage import stored

LARGEST = 2**63 - 1
#: Unit roundoff of single precision.
ROUNDOFF = 2.0**-24


@dataclass(frozen=True)
class CentroidParams:
    """k centroids, rounds of assignment and move, dims of a vector, scale of its components, seed of the first centroids."""

    k: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: str = "3"


@dataclass(frozen=True)
class Clustering:
    """rows: the kept vectors with cluster and distance, stored. centroids: the last ones, in order."""

    rows: DataFrame
    centroids: list[list[int]]


def exact_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each point to the centroid of its row, in long integers where these hold them, else in Python's."""
    most = max([1, *(int(np.abs(x).max()) for x in (points, centroids) if x.size)])
    if points.shape[1] * (2 * most) ** 2 > LARGEST:
        points, centroids = points.astype(object), centroids.astype(object)
    gap = points - centroids
    return (gap * gap).sum(axis=1)


def screen(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Whether each centroid may be a nearest one of each point.

    A dot product of d terms in single precision, of operands rounded to it, is off by at most g(d + 2) times the sum of the
    products' sizes, in any order of summation, where g(n) = n u / (1 - n u); that sum is at most the product of the lengths.
    Integers don't underflow, and where they overflow the interval is no number, which rules nothing out. What double
    precision adds is bounded in the same way.
    """
    d = points.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        return _screen(points, centroids, d)


def _screen(points: np.ndarray, centroids: np.ndarray, d: int) -> np.ndarray:
    dots = (points.astype(np.float32) @ centroids.astype(np.float32).T).astype(np.float64)
    p, c = points.astype(np.float64), centroids.astype(np.float64)
    pp, cc = (p * p).sum(axis=1), (c * c).sum(axis=1)
    lengths = np.sqrt(pp)[:, None] * np.sqrt(cc)[None, :]
    bound = (d + 2) * ROUNDOFF / (1 - (d + 2) * ROUNDOFF) * lengths
    score = cc[None, :] - 2 * dots  # the squared distance without the point's own square
    slack = (2 * bound + (cc[None, :] + np.abs(score) + lengths) * (d + 8) * 2.0**-53) * (1 + 2.0**-20)
    return ~(score - slack > (score + slack).min(axis=1)[:, None])


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each point, the lowest of several."""
    near = screen(points, centroids)
    label = near.argmax(axis=1)
    rows = np.flatnonzero(near.sum(axis=1) > 1)
    if len(rows):
        best: list = [None] * len(rows)
        for j in range(len(centroids)):  # in order, so that only a lesser distance moves a point
            own = np.flatnonzero(near[rows, j])
            for i, x in zip(own.tolist(), exact_distances(points[rows[own]], centroids[j][None, :]).tolist()):
                if best[i] is None or x < best[i]:
                    best[i] = x
                    label[rows[i]] = j
    return label


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def whole_vectors(vectors: DataFrame, p: CentroidParams, key: str, vector: str) -> DataFrame:
    """(row, key, vec): vectors of p.dims components, none null or not finite, as integers floor(p.scale * x)."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    fit = F.coalesce(F.size(vector) == p.dims, F.lit(False)) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    far = F.exists(x, lambda v: F.abs(v * p.scale) >= 2.0**62)
    vec = F.when(far, F.raise_error(F.lit("a component whose integer doesn't fit 62 bits"))).otherwise(F.transform(x, lambda v: F.floor(v * p.scale)))
    return vectors.filter(F.col(vector).isNotNull()).filter(fit).select(F.struct(*(F.col(f"`{c}`") for c in vectors.columns)).alias("row"), F.col(key).alias("key"), vec.cast("array<long>").alias("vec"))


def first_centroids(whole: DataFrame, p: CentroidParams) -> np.ndarray:
    """The p.k vectors with the smallest SHA-256 of '<seed>:<key>'; equal ones by their components."""
    name = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    taken = whole.select(name.alias("name"), "vec").orderBy("name", "vec").limit(p.k).collect()
    return np.array([r["vec"] for r in taken], np.int64).reshape(-1, p.dims)


def moved(whole: DataFrame, centroids: np.ndarray, p: CentroidParams) -> np.ndarray:
    """Each centroid at the floor of the mean of the vectors nearest to it; those without vectors stay."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(centroids.shape, object), np.zeros(len(centroids), np.int64)
        for batch in batches:
            points = matrix(batch.column(0), p.dims)
            if len(points) * max(1, int(np.abs(points).max(initial=0))) > LARGEST:
                points = points.astype(object)
            label = nearest(points.astype(np.int64), centroids)
            for j in np.unique(label).tolist():
                own = points[label == j]
                total[j] += own.sum(axis=0).astype(object)
                count[j] += len(own)
        used = np.flatnonzero(count)
        cells = [pa.array(np.repeat(used, p.dims), pa.int32()), pa.array(np.tile(np.arange(p.dims), len(used)), pa.int32()), pa.array([Decimal(int(x)) for x in total[used].ravel()], pa.decimal128(38, 0)), pa.array(np.repeat(count[used], p.dims), pa.int64())]
        yield pa.RecordBatch.from_arrays(cells, names=["cluster", "dim", "total", "n"])

    found = whole.select("vec").mapInArrow(gather, "cluster int, dim int, total decimal(38, 0), n long")
    cells = found.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # k * dims rows at most
    out = centroids.copy()
    for r in cells:
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def cluster(vectors: DataFrame, params: CentroidParams = CentroidParams(), key: str = "vec_id", vector: str = "embedding", cluster_out: str = "cluster", distance_out: str = "distance") -> Clustering:
    """The vectors with their cluster and squared distance after params.rounds rounds, and the last centroids.

    Only vectors of params.dims components, none null or not finite, are kept (none of a null array); their integers must fit 62 bits, or an
    error says so. A null key counts as empty text, rows that repeat count each, equal distances go to the lowest number, and fewer
    vectors than params.k make as many centroids as there are. A distance that doesn't fit a long is null. Other columns pass through;
    columns named like an output are replaced. No rows give none, and no centroids.
    """
    bound_batches(vectors.sparkSession)
    whole = stored(whole_vectors(vectors, params, key, vector), "vectors")
    centroids = first_centroids(whole, params)
    for _ in range(params.rounds if len(centroids) else 0):
        centroids = moved(whole, centroids, params)
    schema = T.StructType([whole.schema["row"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    row_type = to_arrow_type(whole.schema["row"].dataType)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1), params.dims)
            label = nearest(points, centroids) if len(points) else np.zeros(0, np.int64)
            far = exact_distances(points, centroids[label]) if len(points) else label
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(row_type), pa.array(label, pa.int32()), pa.array([x if x <= LARGEST else None for x in far.tolist()], pa.int64())], names=schema.names)

    rows = stored(whole.select("row", "vec").mapInArrow(assign, schema), "clusters")
    kept = [F.col(f"row.`{c}`") for c in vectors.columns if c not in (cluster_out, distance_out)]
    return Clustering(rows.select(*kept, F.col("cluster").alias(cluster_out), F.col("distance").alias(distance_out)), centroids.tolist())
