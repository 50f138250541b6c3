"""What Arrow kernels over groups share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def labelled(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the edges a to b connect it with."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while True:  # every node to the end of its path
            further = label[label]
            if (further == label).all():
                break
            label = further


def by_group(df: DataFrame, keys: list[str], kernel: Callable[[pa.Table], pa.Table], fields: list) -> DataFrame:
    """kernel over each group of keys, a group as one table; fields: of the result, struct fields or (name, type). One shuffle,
    and a group's rows in one task: for groups with a bound."""
    made = [f if isinstance(f, T.StructField) else T.StructField(f[0], T.DataType.fromDDL(f[1])) for f in fields]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in made])

    def run(group: pa.Table) -> pa.Table:
        out = kernel(group)
        return out.select(schema.names).cast(to_arrow_schema(schema))

    return df.groupBy(*keys).applyInArrow(run, schema)


def by_sorted_group(df: DataFrame, keys: list[str], kernel: Callable[[pa.Table], list[dict]], fields: list) -> DataFrame:
    """kernel over each group of keys, for many small groups: partitions are sorted by key and read batch by batch, so a group costs no
    stream of its own. kernel gives a group's rows without its keys. One shuffle, and a group in memory at a time."""
    made = [f if isinstance(f, T.StructField) else T.StructField(f[0], T.DataType.fromDDL(f[1])) for f in fields]
    schema = T.StructType([*df.select(*keys).schema.fields, *(T.StructField(f.name, f.dataType, True) for f in made)])
    arrow = to_arrow_schema(schema)

    def rows(group: pa.Table) -> pa.RecordBatch | None:
        own = group.slice(0, 1).select(keys).to_pylist()[0]
        found = [own | r for r in kernel(group)]
        return pa.RecordBatch.from_pylist(found, schema=arrow) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            own = batch.select(keys).to_pylist()
            cuts = [i for i in range(len(own)) if own[i] != (own[i - 1] if i else last)]
            if own and last is not None and cuts[:1] != [0]:
                held.append(batch.slice(0, cuts[0] if cuts else len(own)))
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                if held and (out := rows(pa.Table.from_batches(held))) is not None:
                    yield out
                held = [batch.slice(a, b - a)]
            last = own[-1] if own else last
        if held and (out := rows(pa.Table.from_batches(held))) is not None:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
