"""Numbers that MD5 draws from keys, the same in Spark and in SQL, for made-up shapes that follow no formula; and the tables whose keys they are drawn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def draw(*parts, n: int) -> Column:
    """A number below n that MD5 makes of the parts."""
    text = F.concat_ws(":", *((p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % n).cast("int")


def drawn(parts: str, n: int) -> str:
    """The same in SQL; parts are its arguments."""
    digits = f"md5(concat_ws(':', {parts}))"
    value = " + ".join(f"(instr('0123456789abcdef', substr({digits}, {k + 1}, 1)) - 1) * {16 ** (5 - k)}" for k in range(6))
    return f"CAST(({value}) % {n} AS INTEGER)"


#: Tables with one short row for each key: small files, however much is made of a row.
KEYS = {"supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, dealt by its key where a row is short: a small file is one task, and all that is made of its rows would be made in that task."""
    rows, key = spark.read.parquet(f"{sf_dir}/{name}.parquet"), KEYS.get(name)
    if key is None:
        return rows
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), key)
