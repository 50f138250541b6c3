"""Graph operators over edge tables: everything stays distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.operators.kernels import labelled
from strataframe.storage import checkpointed, restored, share

#: Edges that a task contracts together.
CHUNK = 1_000_000


def contracted(pairs: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the same nodes as pairs: within a chunk of a partition, each node to the least it is connected with.
    No shuffle; a chunk's edges are in memory."""

    def forest(chunk: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(chunk)
        ends = [table.column(c).combine_chunks() for c in ("u", "v")]
        kind = ends[0].type
        if pa.types.is_integer(kind):
            values, at = np.unique(np.concatenate([e.to_numpy() for e in ends]), return_inverse=True)
            back = lambda k: pa.array(values[k], kind)
        elif pa.types.is_struct(kind) and all(pa.types.is_integer(f.type) for f in kind) and not any(c.null_count for e in ends for c in e.flatten()):
            parts = [np.concatenate(c) for c in zip(*([x.to_numpy() for x in e.flatten()] for e in ends))]
            order = np.lexsort(parts[::-1])
            new = np.zeros(len(order), bool)
            for c in parts:
                new[1:] |= c[order][1:] != c[order][:-1]
            at = np.empty(len(order), np.int64)
            at[order] = np.cumsum(new)
            values = [c[order][new | (np.arange(len(order)) == 0)] for c in parts]
            back = lambda k: pa.StructArray.from_arrays([pa.array(v[k], f.type) for v, f in zip(values, kind)], fields=list(kind))
        else:  # texts and structs by Python's order, which is Spark's for those without nulls
            plain = [tuple(x.values()) if isinstance(x, dict) else x for e in ends for x in e.to_pylist()]
            known = sorted(set(plain))
            place = {x: k for k, x in enumerate(known)}
            at = np.fromiter((place[x] for x in plain), np.int64, len(plain))
            names = [f.name for f in kind] if pa.types.is_struct(kind) else None
            back = lambda k: pa.array([dict(zip(names, known[i])) if names else known[i] for i in k.tolist()], kind)
        n = len(at) // 2
        label = labelled(int(at.max()) + 1, at[:n], at[n:])
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([back(own), back(label[own])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                chunk.append(batch)
                rows += batch.num_rows
            if rows >= CHUNK:
                yield forest(chunk)
                chunk, rows = [], 0
        if chunk:
            yield forest(chunk)

    return pairs.mapInArrow(run, pairs.schema)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node on an edge; component is the least node reachable.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each written to the shared folder: a round is a few shuffles of
    at most one row per edge, the number of rounds grows with the logarithm of the longest path, and no group of a
    node's neighbours is ever gathered. Before the first round and at the end of each, every partition contracts its own edges, so
    that what one partition holds is done in one round. Beyond a million, edges are dealt to as many tasks as there are millions. Null ends and loops are ignored as edges. An empty table gives none.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    pairs, path = restored(contracted(pairs), None, "edges")
    figures = lambda: pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = figures()
    for _ in range(max_rounds):
        if not before[0]:
            break
        # a task's tables and sorts hold about a chunk, however many edges there are
        dealt = (lambda df, n=share(pairs.sparkSession, before[0], CHUNK): df.repartition(n, "u")) if before[0] > CHUNK else (lambda df: df)
        # large star: every neighbour above u points to the least of u's neighbourhood
        both = dealt(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = dealt(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        # small star: u and its lesser neighbours point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs, path = restored(contracted(dealt(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")).distinct()), path, "edges")
        now = figures()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def connected_subsets(edges: DataFrame, most: int, src: str = "src", dst: str = "dst") -> DataFrame:
    """members (sorted array) of the sets of two to `most` nodes that edges connect, each once.

    A set of n is one of n - 1 and a neighbour of a member, so that each round is one join and a distinct. The number of sets grows
    with the power of a node's degree: for small `most` and small degrees.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    both = checkpointed(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    level = checkpointed(both.filter("u < v").select(F.array("u", "v").alias("members")))
    found = level
    for _ in range(most - 2):
        grown = level.withColumn("u", F.explode("members")).join(both, "u").filter(~F.array_contains("members", F.col("v")))
        level = checkpointed(grown.select(F.array_sort(F.array_append("members", F.col("v"))).alias("members")).distinct())
        found = found.unionByName(level)
    return found


def bounded_subsets(edges: DataFrame, most: int, states: int, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """(subsets, refused): connected_subsets with their component (its least node), of the components that have at most `states` of them; and the component of each other, with n, how
    many it had when it went beyond. A component is taken whole or not at all, so the result depends on no order; one that is refused grows no further, which bounds every round."""
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    both = checkpointed(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    part = checkpointed(connected_components(pairs, "u", "v").withColumnRenamed("node", "u"))
    level = checkpointed(both.filter("u < v").join(part, "u").select("component", F.array("u", "v").alias("members")))
    found, refused = level, []
    for size in range(2, most + 1):
        counts = found.groupBy("component").agg(F.count("*").alias("n"))
        over = checkpointed(counts.filter(F.col("n") > states))
        refused.append(over)
        found, level = found.join(over, "component", "left_anti"), level.join(over, "component", "left_anti")
        if size == most:
            break
        grown = level.withColumn("u", F.explode("members")).join(both, "u").filter(~F.array_contains("members", F.col("v")))
        level = checkpointed(grown.select("component", F.array_sort(F.array_append("members", F.col("v"))).alias("members")).distinct())
        found = checkpointed(found.unionByName(level))
    gone = refused[0]
    for more in refused[1:]:
        gone = gone.unionByName(more)
    return found, gone
