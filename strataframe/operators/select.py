"""Selection: disjoint plans, reports in order, duplicates, trees, and points that are apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.storage import fresh_path, removed, restored, stored

C = F.col


def disjoint(plans: DataFrame, key: str, score: str, sources: str, max_rounds: int = 10_000) -> DataFrame:
    """The plans that a walk by falling score (then rising key) takes: each whose sources no plan before it has used.

    plans: key, score, sources (array). Round by round the plans that come first for every source they have are taken, and all that
    share a source with these go; that gives the same set as the walk, with a few shuffles a round. The number of rounds is that of
    the longest chain of plans that wait for each other. Plans without sources are all taken.
    """
    spark = plans.sparkSession
    path = fresh_path(spark, "chosen")
    rows = plans.select(key, score, C(sources).alias("__s"))
    chosen = rows.filter(F.coalesce(F.size("__s"), F.lit(0)) <= 0).select(key)
    chosen.write.parquet(path)
    open_, old = restored(rows.select(key, score, F.explode(F.array_distinct("__s")).alias("__s")), None, "open")
    for _ in range(max_rounds):
        if open_.isEmpty():
            break
        first = open_.groupBy("__s").agg(F.max_by(key, F.struct(score, _falling(key, open_))).alias("__first"))
        led = open_.join(first, "__s").groupBy(key).agg(F.bool_and(C(key) == C("__first")).alias("__ok")).filter("__ok").select(key)
        led, taken = restored(led, None, "taken")
        led.write.mode("append").parquet(path)
        used = open_.join(led, key, "left_semi").select("__s").distinct()
        gone = open_.join(used, "__s", "left_semi").select(key).distinct()
        open_, old = restored(open_.join(gone, key, "left_anti"), old, "open")
        removed(spark, taken)
    else:
        raise RuntimeError(f"plans were left after {max_rounds} rounds")
    return plans.join(spark.read.schema(chosen.schema).parquet(path), key, "left_semi")


def accepted(items: DataFrame, key: str, rank: str, conflicts: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """The items (key, rank, both unique) that a walk by rank accepts: each that is in no conflict (a, b: keys) with one accepted before. Round by round what comes
    before all that it conflicts with is accepted, and these go; the number of rounds is that of the longest chain of items that wait for each other."""
    spark = items.sparkSession
    path = fresh_path(spark, "accepted")
    ranks = items.select(C(key).alias("__k"), C(rank).alias("__r"))
    both = conflicts.select("a", "b").unionByName(conflicts.select(C("b").alias("a"), C("a").alias("b"))).filter("a <> b").distinct()
    pairs = both.join(ranks.select(C("__k").alias("a"), C("__r").alias("ra")), "a").join(ranks.select(C("__k").alias("b"), C("__r").alias("rb")), "b")
    open_, old = restored(pairs.select("a", "b", "ra", "rb"), None, "open")
    alone = ranks.select(C("__k").alias("a")).join(open_.select("a"), "a", "left_anti")
    alone.write.parquet(path)
    for _ in range(max_rounds):
        if open_.isEmpty():
            break
        led, taken = restored(open_.groupBy("a").agg(F.min("rb").alias("rb"), F.first("ra").alias("ra")).filter("ra < rb").select("a"), None, "taken")
        led.write.mode("append").parquet(path)
        gone = open_.join(led, "a", "left_semi").select(C("b").alias("a")).distinct().unionByName(led)
        left = open_.join(gone, "a", "left_anti")
        rest = left.join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b", "ra", "rb")
        # what has lost all that it was in conflict with is accepted too
        free = left.select("a").distinct().join(rest.select("a"), "a", "left_anti")
        free.write.mode("append").parquet(path)
        open_, old = restored(rest, old, "open")
        removed(spark, taken)
    else:
        raise RuntimeError(f"items were left after {max_rounds} rounds")
    return items.join(spark.read.schema(alone.schema).parquet(path).withColumnRenamed("a", key), key, "left_semi")


def _falling(key: str, df: DataFrame) -> Column:
    """What is the greater the less the key is."""
    kind = df.schema[key].dataType.typeName()
    return -C(key) if kind != "string" else F.translate(F.hex(C(key)), "0123456789ABCDEF", "FEDCBA9876543210")


def page(df: DataFrame, order: list[Column], first: int, last: int) -> DataFrame:
    """The rows from first to last, counted from 1, in an order that should end with a key."""
    return df.orderBy(*order).offset(first - 1).limit(max(last - first + 1, 0))


def examples(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("__n", rank).filter(C("__n") <= n).drop("__n")


def counts(df: DataFrame, by: str) -> DataFrame:
    """by, n: how often each reason, method or key occurs, null among them."""
    return df.groupBy(by).agg(F.count("*").alias("n"))


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n: the identities that several rows have; rows with a null in one have none."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def distinct_edges(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b with a < b: each edge once, whichever way it was given; loops are no edges."""
    return df.filter(C(a) != C(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def distinct_sets(df: DataFrame, members: str) -> DataFrame:
    """One row of those whose arrays have the same members."""
    return df.withColumn("__m", F.array_sort(F.array_distinct(members))).dropDuplicates(["__m"]).drop("__m")


def apart(points: Column, tolerance: float) -> Column:
    """Of an array of struct<x, z>, sorted by x then z, those farther than the tolerance from the last one that was kept."""
    empty = F.slice(points, 1, 0)
    far = lambda acc, p: F.hypot(p["x"] - F.element_at(acc, -1)["x"], p["z"] - F.element_at(acc, -1)["z"]) > tolerance
    return F.aggregate(F.array_sort(points), empty, lambda acc, p: F.when(F.size(acc) == 0, F.array(p)).when(far(acc, p), F.array_append(acc, p)).otherwise(acc))


def tree_scan(df: DataFrame, key: str, parent: str, root: Column, stop: Column, max_depth: int = 100) -> DataFrame:
    """The rows below those where root holds that stop holds for, and depth: children are followed, but not those of a row that stops.

    One join a level, each level written; the tree's depth bounds them. Rows that no root reaches are left out.
    """
    rows = df.withColumn("__stop", F.coalesce(stop, F.lit(False)))
    level = rows.filter(root).withColumn("depth", F.lit(0))
    found = []
    for depth in range(max_depth + 1):
        level = stored(level, "level")
        if level.isEmpty():
            break
        found.append(level.filter("__stop"))
        open_ = level.filter("NOT __stop").select(C(key).alias("__up"))
        level = rows.join(open_, C(parent) == C("__up"), "left_semi").withColumn("depth", F.lit(depth + 1))
    else:
        raise RuntimeError(f"the tree is deeper than {max_depth}")
    out = found[0] if found else rows.limit(0).withColumn("depth", F.lit(0))
    for f in found[1:]:
        out = out.unionByName(f)
    return out.drop("__stop")
