"""Joins of boxes, sections of triangles, and versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions.geometry import crossings


def overlapping_boxes(boxes: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """(a, b), a < b: boxes whose closed rectangles [x0, x1] x [z0, z1] meet; null or turned bounds meet nothing.

    Boxes are dealt to the grid cells they touch and joined by cell. A pair counts in one cell only, that of the lower
    corner of what it shares, so that nothing is made distinct afterwards. cell should be near the usual box size.
    """
    at = lambda v: F.floor(v / F.lit(cell))
    rows = boxes.select(F.col(key).alias("id"), "x0", "x1", "z0", "z1").filter("x0 <= x1 AND z0 <= z1")
    rows = rows.withColumn("bx", F.explode(F.sequence(at(F.col("x0")), at(F.col("x1")))))
    rows = rows.withColumn("bz", F.explode(F.sequence(at(F.col("z0")), at(F.col("z1")))))
    a, b = rows.alias("a"), rows.alias("b")
    meet = (F.col("a.bx") == F.col("b.bx")) & (F.col("a.bz") == F.col("b.bz")) & (F.col("a.id") < F.col("b.id"))
    for v in "xz":
        meet &= (F.col(f"a.{v}0") <= F.col(f"b.{v}1")) & (F.col(f"b.{v}0") <= F.col(f"a.{v}1"))
        meet &= F.col(f"a.b{v}") == at(F.greatest(f"a.{v}0", f"b.{v}0"))
    return a.join(b, meet).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def section(points: Column, height: Column) -> Column:
    """The segment, array of two struct<x, z>, in which a triangle (array of struct<x, y, z>) meets a plane, or null.

    Heights are half-open: a vertex on the plane belongs to the side below.
    """

    def hit(a: Column, b: Column) -> Column:
        t = (height - a["y"]) / (b["y"] - a["y"])
        place = F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["z"] + t * (b["z"] - a["z"])).alias("z"))
        return F.when(crossings(a["y"], b["y"], height), place)

    hits = F.array_compact(F.array(*(hit(points[i], points[(i + 1) % 3]) for i in range(3))))
    return F.when(F.size(hits) == 2, hits)


def _print_of(df: DataFrame, keys: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*(c for c in df.columns if c not in keys)), {"ignoreNullFields": "false"}), 256)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change: added, removed or changed rows of two versions with unique keys and the same columns."""
    a = before.select(*keys, _print_of(before, keys).alias("__a"))
    b = after.select(*keys, _print_of(before, keys).alias("__b"))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed")
    return a.join(b, keys, "full").select(*keys, change.alias("change")).filter("change IS NOT NULL")


def applied(live: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """live with the rows of staged in place of those with the same keys."""
    return live.join(staged.select(*keys).distinct(), keys, "left_anti").select(live.columns).unionByName(staged.select(live.columns))


def archived(live: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of live that applied() replaces."""
    return live.join(staged.select(*keys), keys, "left_semi").select(live.columns)


def whole_sources(staged: DataFrame, source: str, reason: str = "reason") -> DataFrame:
    """The rows of staged whose source has no row with a reason: all outputs of a source, or none."""
    failed = staged.filter(F.col(reason).isNotNull()).select(source).distinct()
    return staged.join(failed, source, "left_anti").select(staged.columns)
