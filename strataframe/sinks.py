"""Versions of a table in a shared folder: staged, checked, applied by one new pointer, and undone.

A store is a folder with one sub-folder per version and numbered pointers, of which the last names the current one. Writers stage into a new
sub-folder, and `apply` creates the pointer after the one that they began with, which the file system lets one writer do; so a lost job leaves
only files that nothing points to. Plans and grids are JSON texts; snapshots are rows with a digest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.operators.spatial import applied, archived, whole_sources
from strataframe.storage import stored

C = F.col
PLAN = "version int, key string, frame array<double>, size array<double>, tiers array<struct<bottom:double,ring:array<struct<x:double,z:double>>>>"
VERSION = 1


class Conflict(RuntimeError):
    """What was to be applied no longer fits what is there."""


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    folder: str

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _latest(self) -> tuple[int, list[str]]:
        """(number of the last pointer, the versions that it names, the current one first); (0, []) before the first."""
        fs = self._fs()
        if not fs.exists(self._path("")):
            return 0, []
        names = sorted((f.getPath().getName() for f in fs.listStatus(self._path(""))), reverse=True)
        numbers = [n for n in names if n.startswith("pointer-")]
        for name in numbers:
            line = self.spark.read.text(f"{self.folder}/{name}").first()
            if line and line[0]:  # an empty one was claimed and never written: its writer was lost, and the one before holds
                return int(numbers[0].split("-")[1]), line[0].split("\t")
        return (int(numbers[0].split("-")[1]) if numbers else 0), []

    def current(self) -> str | None:
        """The name of the current version, null before the first."""
        return next(iter(self._latest()[1]), None)

    def history(self) -> list[str]:
        """The versions that were current, the latest first."""
        return self._latest()[1]

    def read(self, version: str | None = None, part: str = "live") -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{version or self.current()}/{part}")

    def _point(self, last: int, names: list[str]) -> None:
        """Writes the pointer after the last one that was seen; of several writers that saw the same one, one succeeds."""
        try:
            out = self._fs().create(self._path(f"pointer-{last + 1:08d}"), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception.getClass().getName()) or "already exists" in str(e.java_exception.getMessage()):
                raise Conflict("another version has been applied") from e
            raise
        out.write(bytearray("\t".join(names), "utf-8"))
        out.close()

    def begin(self, live: DataFrame) -> str:
        """The first version; Conflict where there is one."""
        version = uuid.uuid4().hex
        last, names = self._latest()
        if names:
            raise Conflict("the store has a version")
        live.write.parquet(f"{self.folder}/{version}/live")
        self._point(last, [version])
        return version

    def stage(self, staged: DataFrame, failures: DataFrame) -> str:
        """Writes what was built and what failed; nothing points to it yet."""
        version = uuid.uuid4().hex
        staged.write.parquet(f"{self.folder}/{version}/staged")
        failures.write.parquet(f"{self.folder}/{version}/failures")
        return version

    def apply(self, staged: str, base: str, keys: list[str], expected: DataFrame | None = None, check: Column | None = None) -> str:
        """Installs a staged version over base, and archives what it replaces; returns the new version.

        Raises Conflict, and changes nothing, where base is no longer current, a staged key occurs twice, the staged keys are not those of
        `expected`, or a staged row does not pass check.
        """
        own, live = self.read(staged, "staged"), self.read(base)
        last, names = self._latest()
        if names[:1] != [base]:
            raise Conflict("another version has been applied")
        if not own.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise Conflict("a staged key is not unique")
        if expected is not None and not same_rows(own.select(*keys), expected.select(*keys)):
            raise Conflict("the staged set is not complete")
        if check is not None and not own.filter(~F.coalesce(check, F.lit(False))).isEmpty():
            raise Conflict("a staged row does not pass the audit")
        applied(live, own, keys).write.parquet(f"{self.folder}/{staged}/live")
        archived(live, own, keys).write.parquet(f"{self.folder}/{staged}/archive")
        self._point(last, [staged, *names])
        return staged

    def undo(self) -> str:
        """Makes the version before the current one current again."""
        last, names = self._latest()
        if len(names) < 2:
            raise Conflict("there is no version before")
        self._point(last, names[1:])
        return names[1]


def previewed(live: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """What applying staged would show: its rows, state "after", beside the live rows that they replace, state "before", and the others, state "kept"; nothing is written."""
    own = staged.select(*keys)
    parts = [(staged, "after"), (live.join(own, keys, "left_semi"), "before"), (live.join(own, keys, "left_anti"), "kept")]
    return reduce(DataFrame.unionByName, [df.select(*live.columns).withColumn("state", F.lit(name)) for df, name in parts])


def shown(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The n-th row, from 1, of each group in an order: one to look at."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(C("__n") == n).drop("__n")


def run_next(store: Store, plans: DataFrame, source: str, keys: list[str], rank: list[Column], n: int, check: Column, stage_only: bool = False) -> tuple[str, str | None]:
    """One batch: of the plans (the rows of the store, source and reason) the n sources that come first by rank are staged, whole or not at all, audited and applied; (staged
    version, applied one). rank orders sources by aggregates of their plans. Raises Conflict, and applies nothing, where no source is left, one of them failed, or a row does not pass check."""
    best = plans.groupBy(source).agg(*(c.alias(f"__r{k}") for k, c in enumerate(rank)))
    chosen = best.orderBy(*(f"__r{k}" for k in range(len(rank))), source).limit(n).select(source)
    own = stored(plans.join(F.broadcast(chosen), source), "batch")  # n rows are broadcast
    staged, failures = staged_batch(own, source)
    base = store.current()
    columns = store.read(base).columns
    version = store.stage(staged.select(columns), failures)
    if store.read(version, "staged").isEmpty():
        raise Conflict("no plan is left")
    if stage_only:
        return version, None
    if not store.read(version, "failures").isEmpty():
        raise Conflict("the staged batch has failures")
    return version, store.apply(version, base, keys, check=check)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames have the same rows, as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def staged_batch(plans: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(staged, failures) of plans with reason: those of sources all of whose plans have none, and per source how many failed and why first."""
    failures = plans.filter("reason IS NOT NULL").groupBy(source).agg(F.count("*").alias("failed"), F.min("reason").alias("reason"))
    return whole_sources(plans, source), failures


def snapshot(rows: DataFrame, identity: list[str], columns: list[str]) -> DataFrame:
    """identity (the first of these columns that is not null, as text), digest of the columns, their nulls included."""
    shown = [F.coalesce(C(c).cast("string"), F.lit("\x00")) for c in columns]
    return rows.select(F.coalesce(*(C(c).cast("string") for c in identity)).alias("identity"), F.sha2(F.concat_ws("\x1f", *shown), 256).alias("digest"))


def source_links(outputs: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """output, source, expected: which source each output stands for, and how many outputs it should have."""
    expected = outputs.groupBy(key).agg(F.count("*").alias("expected"))
    return outputs.join(sources.select(key), key, "left_semi").join(expected, key).select("output", C(key).alias("source"), "expected")


def encode_plan(df: DataFrame, out: str = "plan") -> DataFrame:
    """df with out: key, frame, size and tiers as JSON of the current version."""
    return df.withColumn(out, F.to_json(F.struct(F.lit(VERSION).alias("version"), "key", "frame", "size", "tiers")))


def decode_plan(df: DataFrame, raw: str = "plan") -> DataFrame:
    """df with plan decoded and reason: null where it is of the version known here, with a frame of 12 numbers, 3 sizes and a tier."""
    p = F.from_json(raw, PLAN)
    df = df.withColumn("__p", p)
    g = C("__p")
    reason = F.when(C(raw).isNull(), "missing plan").when(g.isNull() | g["key"].isNull(), "invalid plan").when(~F.coalesce(g["version"] == VERSION, F.lit(False)), "unsupported plan version")
    reason = reason.when((F.coalesce(F.size(g["frame"]), F.lit(0)) != 12) | (F.coalesce(F.size(g["size"]), F.lit(0)) != 3), "invalid frame").when(F.coalesce(F.size(g["tiers"]), F.lit(0)) < 1, "no tiers")
    return df.withColumns({raw: g, "reason": reason}).drop("__p")


def report_row(df: DataFrame, name: str, **figures: Column) -> DataFrame:
    """One row: name, and the figures as JSON, for a log."""
    return df.agg(*(c.alias(k) for k, c in figures.items())).select(F.lit(name).alias("name"), F.to_json(F.struct(*figures)).alias("figures"))
