"""Centroid clustering against whole-number arithmetic in plain Python."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from strataframe.llm import centroids, queries

RNG = random.Random(17)
SCHEMA = "vec_id long, embedding array<double>, cluster string, row int, vec int"


def plain(rows, p):
    kept = [(i, [math.floor(p.scale * x) for x in v]) for i, v in rows if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[: p.k]
    cs = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(cs))[1]
    for _ in range(p.rounds):
        own = [[v for _, v in kept if near(v) == j] for j in range(len(cs))] if len(kept) < 50 else None
        if own is None:
            own = [[] for _ in cs]
            for _, v in kept:
                own[near(v)].append(v)
        cs = [[sum(col) // len(o) for col in zip(*o)] if o else c for o, c in zip(own, cs)]
    return [(i, near(v), far(v, cs[near(v)])) for i, v in kept], cs


def random_rows(dims, n, spread):
    base = [[RNG.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + RNG.gauss(0, spread) for x in RNG.choice(base)]) for i in range(n)]
    rows += [(n + i, list(base[0])) for i in range(9)] + [(n, list(base[1])), (None, list(base[2]))]
    bad = [None, [], base[0][:-1], base[0] + [1.0], [None, *base[0][1:]], [math.nan, *base[0][1:]], [math.inf, *base[0][1:]], [-math.inf, *base[0][1:]]]
    return rows + [(10 * n + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize(("dims", "n", "spread", "scale"), [(64, 120, 0.5, 1024), (3, 300, 2.0, 2), (2, 200, 1.0, 1), (4, 60, 1.0, 10**9), (5, 40, 1.0, 10**17)])
def test_clusters_equal_a_plain_version(spark, dims, n, spread, scale):
    p = centroids.CentroidParams(dims=dims, scale=scale, rounds=4, k=6)
    rows = random_rows(dims, n, spread)
    want, cs = plain([(i, v) for i, v in rows], p)
    found = centroids.cluster(spark.createDataFrame([(i, v, "own", 3, 4) for i, v in rows], SCHEMA).repartition(3), p)
    assert found.rows.columns == ["vec_id", "embedding", "row", "vec", "cluster", "distance"] and found.centroids == cs
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["vec_id"], r["cluster"], r["distance"] if r["distance"] is not None else -1) for r in found.rows.collect()], key=key) == sorted([(i, c, d if d <= centroids.LARGEST else -1) for i, c, d in want], key=key)


def test_screening_never_loses_the_nearest():
    rng = np.random.default_rng(3)
    for scale in (1, 30, 10**4, 10**9, 2**61):
        cs = rng.integers(-scale, scale, (8, 64), endpoint=True)
        cs[3] = cs[1]  # a tie
        mid = (cs[0].astype(object) + cs[2].astype(object)) // 2
        points = np.concatenate([rng.integers(-scale, scale, (200, 64), endpoint=True), cs, np.array([mid, mid + 1], np.int64), np.zeros((1, 64), np.int64)])
        far = ((points.astype(object)[:, None, :] - cs.astype(object)[None]) ** 2).sum(axis=2)
        best = [min(range(8), key=lambda j: (row[j], j)) for row in far.tolist()]
        assert centroids.nearest(points, cs).tolist() == best
        if scale == 10**4:
            assert centroids.screen(points, cs).sum(axis=1).mean() < 1.2  # and rules out nearly all others


def test_no_vectors(spark):
    found = centroids.cluster(spark.createDataFrame([(1, None, "a", 1, 1), (2, [1.0], "a", 1, 1)], SCHEMA))
    assert found.rows.count() == 0 and found.centroids == []
    one = centroids.cluster(spark.createDataFrame([(1, [0.5] * 64, "a", 1, 1)], SCHEMA))
    assert [(r["cluster"], r["distance"]) for r in one.rows.collect()] == [(0, 0)] and one.centroids == [[512] * 64]
    with pytest.raises(Exception, match="62 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e300] * 64, "a", 1, 1)], SCHEMA))


def test_query_equals_plain_and_sql(spark, tmp_path):
    rows = [r for r in random_rows(64, 150, 0.4) if r[0] is not None]
    rows = list({i: (i, v) for i, v in rows}.values())
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    stored = [(r[0], r[1]) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    want, cs = plain(stored, centroids.CentroidParams())
    sums = [sum(d for _, j, d in want if j == c) for c in range(8)]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    expected = {(i, j, d, sums[j], sum(sums), sha[j]) for i, j, d in want}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert {tuple(r) for r in queries.op13_centroids(spark, str(tmp_path)).collect()} == expected == set(db.execute(queries.OP13_SQL).fetchall())
