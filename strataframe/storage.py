"""Places that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where the setting is absent and all runs on one machine (tests)."""
    sc = spark.sparkContext
    there = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strataframe-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """df written to the shared folder and read back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def restored(df: DataFrame, old: str | None, name: str = "round") -> tuple[DataFrame, str]:
    """(df as stored() gives it, its path); then what it was made of, the files under old, are removed. For loops that read their last round only."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if old:
        removed(spark, old)
    return spark.read.schema(df.schema).parquet(path), path


#: Rows of a table that one task is dealt.
DEALT = 250_000


def share(spark: SparkSession, rows: int, each: int = DEALT) -> int:
    """How many tasks rows are to be dealt to: a number that grows with them, so that a task's share does not."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def tasks(df: DataFrame, each: int = DEALT) -> int:
    """share() of df, which is counted."""
    return share(df.sparkSession, df.count(), each)


def removed(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder; the files go when the driver drops the frame."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def released(spark: SparkSession, path: str | None = None) -> None:
    """Lets go of what is no longer read: the files under path, and shuffles whose frames the driver has dropped."""
    if path:
        removed(spark, path)
    gc.collect()
    spark._jvm.System.gc()
