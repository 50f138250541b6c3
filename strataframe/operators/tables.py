"""Grouped, ordered and set operators of the spatial pipeline, as DataFrame compositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def covered_length(df: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """keys, covered: length of the union of the intervals [low, high] of each group."""
    before = W.partitionBy(*keys).orderBy(low, high).rowsBetween(W.unboundedPreceding, -1)
    reach = F.max(high).over(before)
    added = F.greatest(F.col(high) - F.greatest(F.col(low), F.coalesce(reach, F.col(low))), F.lit(0))
    return df.withColumn("__added", added).groupBy(*keys).agg(F.sum("__added").alias("covered"))


def lower_median(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The real row in the middle of each group, the lower one of two."""
    group = W.partitionBy(*keys)
    ranked = df.withColumns({"__rank": F.row_number().over(group.orderBy(*order)), "__size": F.count("*").over(group)})
    return ranked.filter(F.col("__rank") == F.ceil(F.col("__size") / 2)).drop("__rank", "__size")


def nearest_rank(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """keys, one column per quantile (an occurring value), least, most, missing."""
    picks = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})").alias(name) for name, q in quantiles.items()]
    return df.groupBy(*keys).agg(*picks, F.min(value).alias("least"), F.max(value).alias("most"), F.count_if(F.col(value).isNull()).alias("missing"))


def histogram(df: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """bucket, n: values at most bounds[bucket] and above the bound before; the last bucket is overflow."""
    bucket = F.coalesce(*(F.when(F.col(value) <= b, F.lit(i)) for i, b in enumerate(bounds)), F.lit(len(bounds)))
    return df.filter(F.col(value).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def runs(df: DataFrame, keys: list[str], order: str, group: str) -> DataFrame:
    """keys, group, run, first, last, n: maximal stretches of equal group along order."""
    w = W.partitionBy(*keys).orderBy(order)
    start = F.coalesce((F.col(group) != F.lag(group).over(w)).cast("int"), F.lit(0))
    numbered = df.withColumn("__new", start).withColumn("run", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "run", group).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def verified_match(left: DataFrame, right: DataFrame, key: str, suffix: str, check: Column) -> DataFrame:
    """Left rows with the right row of their key; else that of their suffix, if one row of all left and one of all right
    rows has it and check holds; with match_method (key or suffix) and reason.

    check may use the columns of left, and those of right with the prefix r_. A match by a key that several rows of either side
    have is refused: reason says so, and the columns of right are those of the one with the least values. Rows without
    a match are left out; null keys and suffixes match nothing.
    """
    counted = lambda df, c: df.withColumn(f"__{c}", F.when(F.col(c).isNotNull(), F.count("*").over(W.partitionBy(c))))
    own = counted(counted(left, key), suffix)
    other = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    other = counted(counted(other, f"r_{key}"), f"r_{suffix}")
    one = other.groupBy(f"r_{key}", f"__r_{key}").agg(F.min(F.struct(*(c for c in other.columns if not c.startswith("__") and c != f"r_{key}"))).alias("__r"))
    exact = own.join(one, F.col(key) == F.col(f"r_{key}")).select(*own.columns, f"r_{key}", "__r.*", f"__r_{key}").withColumn("match_method", F.lit("key"))
    alone = lambda df, c: df.filter(F.col(f"__{c}") == 1)
    rest = alone(own, suffix).join(right.select(key), key, "left_anti")
    fallback = rest.join(alone(other, f"r_{suffix}").drop(f"__r_{suffix}"), F.col(suffix) == F.col(f"r_{suffix}")).filter(check).withColumn("match_method", F.lit("suffix"))
    both = exact.unionByName(fallback.select(exact.columns))
    reason = F.when((F.col(f"__{key}") > 1) | (F.col(f"__r_{key}") > 1), "duplicate source key")
    return both.withColumn("reason", reason).drop(f"__{key}", f"__{suffix}", f"__r_{key}")


def first_like(items: DataFrame, by: str, item: str, near: DataFrame) -> DataFrame:
    """by, item, group: in order of item, a whole number, each joins the first group whose first member it is like, or begins one. near: by, a, b with a < b, the
    items that are alike. The items of one by are folded in one row."""
    before = near.groupBy(by, F.col("b").alias(item)).agg(F.collect_list("a").alias("__near"))
    row = F.struct(F.col(item).cast("int").alias("item"), F.coalesce(F.col("__near").cast("array<int>"), F.array().cast("array<int>")).alias("near"))
    kind = "array<struct<item:int,group:int>>"

    def add(done: Column, x: Column) -> Column:
        first = F.transform(F.filter(done, lambda d: d["item"] == d["group"]), lambda d: d["item"])
        group = F.coalesce(F.array_min(F.array_intersect(first, x["near"])), x["item"])
        return F.concat(done, F.array(F.struct(x["item"].alias("item"), group.alias("group")))).cast(kind)

    folded = items.select(by, item).join(before, [by, item], "left").groupBy(by).agg(F.array_sort(F.collect_list(row)).alias("xs"))
    return folded.select(by, F.explode(F.aggregate("xs", F.array().cast(kind), add)).alias("d")).select(by, F.col("d.item").alias(item), "d.group")
